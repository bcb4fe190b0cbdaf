"""Operator 12: Zstandard WARC archives, written from pages and read back.

Writing: pages get a row key and the digest of their payload once and are
stored; payloads that occur more than once are found by grouping the digests
(map-side combined) and stored as well, so that Spark knows their size when
they are joined back: few of them are sent to the pages, which then stay
where they are; of many, a payload that a third of all pages share is one
small row on one side and a skewed key, which Spark splits, on the other. Each task writes archives of about ``ARCHIVE_BYTES``
through ``pyarrow.fs`` under names of its own attempt and returns their
names; only names that reach the stored list are ever read, so a task that
was lost or ran twice leaves no record twice.

Reading: tasks open the archives of the list (or take the contents that
Spark's ``binaryFile`` source read, for stores that only Spark reaches), load
the dictionary from the leading skippable frame, decode one frame per record
and check version, mandatory headers, lengths and digests
(``warc_frames``). What does not hold is a row with its ``problem``;
``strict`` readers fail instead.

Defined results: a null html is an empty payload; a null or empty url leaves
the target out; blanks and control characters in it are percent-encoded;
repeated rows are records of their own, also with equal page_ids (one of them
is the response); a null page_id counts as smallest and comes back null;
payloads of any length are one record (an archive holds at least one); an
empty table writes nothing and reads no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.config import scratch_path, store
from shoplens.llm.common import BATCH_BYTES, with_row_key
from shoplens.llm.warc_frames import (PROFILE, SAMPLE_BYTES, ArchiveFrames, BadArchive, Record, base32_sha1, format_record,
                                      frames, http_response, parse_record, train)

#: Compressed bytes after which a task begins another archive, and that a reading task takes.
ARCHIVE_BYTES = 16 << 20
TASK_BYTES = 64 << 20
#: Pages have no time of their own.
DATE = "1970-01-01T00:00:00Z"

RECORDS = ("path string, offset long, record_id string, record_type string, target_uri string, refers_to string, "
           "payload binary, payload_bytes long, payload_digest string, problem string")
_ARROW = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
                    ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("problem", pa.string())])


def record_id(page_id: Column, row: Column) -> Column:
    """``<urn:page:ID:ROW>``; the id is empty where it is null."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), row.cast("string"),
                    F.lit(">"))


def page_of(uri: Column) -> Column:
    """The page_id of a record id."""
    return F.regexp_extract(uri, "^<urn:page:(-?[0-9]*):", 1).try_cast("bigint")


def records_of(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(record_id, url, html, refers_to): what becomes of each page.

    Of pages with equal payloads of at least ``min_bytes`` the one with the
    largest page_id keeps its payload; the others refer to its record.
    """
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = store(with_row_key(pages.select(F.col("page_id").cast("bigint"), "url", html.alias("html")), "row")
                 .withColumn("digest", F.sha2("html", 256)), "warc_pages")
    key = F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "row")
    shared = store(rows.filter(F.octet_length("html") >= min_bytes).groupBy("digest")
                   .agg(F.count(F.lit(1)).alias("n"), F.max(key).alias("first")).filter("n > 1")
                   .select("digest", "first"), "warc_shared")
    own = record_id(F.col("page_id"), F.col("row"))
    first = record_id(F.col("first.page_id"), F.col("first.row"))
    return (rows.join(shared, "digest", "left")
            .select(own.alias("record_id"), "url", "html",
                    F.when(F.col("first.row") != F.col("row"), first).alias("refers_to")))


def _page_record(name: str, url: str | None, html: bytes, refers_to: str | None) -> bytes:
    headers = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", name), ("WARC-Date", DATE),
               ("WARC-Target-URI", url), ("WARC-Payload-Digest", "sha1:" + base32_sha1(html)),
               ("WARC-Refers-To", refers_to), ("WARC-Profile", PROFILE if refers_to else None),
               ("Content-Type", "application/http;msgtype=response")]
    return format_record(headers, http_response(len(html), b"" if refers_to else html))


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records of ``records_of`` under ``folder``; (path, n_records, n_bytes) of every archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
            fs.LocalFileSystem(), folder)
        attempt, written = uuid.uuid4().hex, []

        def pages() -> Iterator[tuple[str, str | None, bytes, str | None]]:
            for batch in batches:
                columns = [batch.column(i) for i in range(4)]
                for i in range(batch.num_rows):
                    yield tuple(c[i].as_py() for c in columns)

        rows = pages()
        head = next(rows, None)
        while head is not None:
            files.create_dir(root, recursive=True)
            name = f"{attempt}-{len(written):05d}.warc.zst"
            held, size = [head], len(head[2])                    # what the dictionary is trained on
            while size < SAMPLE_BYTES and (row := next(rows, None)) is not None:
                held.append(row)
                size += len(row[2])
            out = ArchiveFrames(train([r[2] for r in held if not r[3]]))
            n, total = 0, len(out.head)
            with files.open_output_stream(f"{root}/{name}", compression=None) as f:
                f.write(out.head)
                at = iter(held)
                head = next(at)
                while head is not None:
                    frame = out.frame(_page_record(*head))
                    f.write(frame)
                    n, total = n + 1, total + len(frame)
                    head = next(at, None)
                    if head is None:
                        head = next(rows, None)
                        if total >= archive_bytes:
                            break
            written.append({"path": f"{folder}/{name}", "n_records": n, "n_bytes": total})
        yield pa.RecordBatch.from_pylist(written, schema=pa.schema([("path", pa.string()), ("n_records", pa.int64()),
                                                                    ("n_bytes", pa.int64())]))

    return store(records.mapInArrow(run, "path string, n_records long, n_bytes long"), "warc_list")


def archives_at(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of archives in any store that Spark reads."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _row(path: str, at: int, found: Record | None, problem: str | None) -> dict:
    head = found.headers if found else {}
    return {"path": path, "offset": at, "record_id": head.get("warc-record-id"), "record_type": head.get("warc-type"),
            "target_uri": head.get("warc-target-uri"), "refers_to": head.get("warc-refers-to"),
            "payload": found and found.payload, "payload_bytes": found and found.payload_bytes,
            "payload_digest": found and found.payload_digest, "problem": problem}


def read_archives(archives: DataFrame, strict: bool = False) -> DataFrame:
    """The records (``RECORDS``) of archives given by ``path``, or by ``path`` and ``content``."""
    columns = ["path", "content"] if "content" in archives.columns else ["path"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        out, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                path = batch.column(0)[i].as_py()
                if len(columns) == 2:
                    data = batch.column(1)[i].as_py()
                else:
                    files, name = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
                    with files.open_input_stream(name, compression=None) as f:
                        data = f.read()
                for at, frame in frames(data):
                    try:
                        if isinstance(frame, BadArchive):
                            raise frame
                        out.append(_row(path, at, parse_record(frame), None))
                        size += 200 + len(out[-1]["payload"] or b"")
                    except BadArchive as e:
                        if strict:
                            raise
                        out.append(_row(path, at, None, str(e)))
                    if size >= BATCH_BYTES or len(out) >= 10_000:
                        yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
                        out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    return archives.select(*columns).mapInArrow(run, RECORDS)


def with_payloads(records: DataFrame) -> DataFrame:
    """Records with the payload of the one that they refer to, where they have none."""
    kept = records.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to"),
                                                             F.col("payload").alias("referred"))
    return (records.join(kept, "refers_to", "left").withColumn("payload", F.coalesce("payload", "referred"))
            .drop("referred"))


def dealt(archives: DataFrame) -> DataFrame:
    """The list of ``write_archives`` over enough tasks: by number, as Spark would merge so few rows into one."""
    n, size = archives.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    tasks = max(archives.sparkSession.sparkContext.defaultParallelism, size // TASK_BYTES)
    return archives.repartition(max(1, min(n, tasks)), "path")


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write every page as a record and read the archives back; (``RECORDS``, page_id, refers_to_page)."""
    folder = scratch_path(pages.sparkSession, "warc")
    listed = write_archives(records_of(pages, min_bytes), folder)
    found = read_archives(dealt(listed), strict=True)
    return found.withColumn("page_id", page_of(F.col("record_id"))).withColumn("refers_to_page", page_of(F.col("refers_to")))
