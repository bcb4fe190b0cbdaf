"""Registered queries of the training-data operators.

Each query applies its operator with production parameters to a whole
table; ``ORACLES`` holds DuckDB SQL for those that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import (chunk_dedup, host_rules, line_dedup, ngram_quality, packing, piece_bpe, pii_votes,
                          ranked_search, set_join, token_counts, turn_repair, url_templates,
                          warc_archive)
from shoplens.llm.common import lower_ascii
from shoplens.sources.tables import table


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file; the files stay outside the repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select(
        F.col("doc_id").alias("page_id"),
        ((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int").alias("bad"))
    return url_templates.judge_urls(table(spark, sf, "pages").select("page_id", "url"), labels, URL_RULES)


def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return token_counts.length_histogram(table(spark, sf, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"),
                                         public_tokenizers.PATTERN)


def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf, "documents"), tokenizer_file("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op4_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = line_dedup.repeated_units(table(spark, sf, "documents").select("doc_id", "text"))

    def listed(spans: str) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["start"].cast("string"), s["end"].cast("string")))).alias(spans)

    return found.select("doc_id", "n_pieces", "n_removed", listed("removed"), listed("repeated"))


def op5_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rows, decisions, names = chunk_dedup.exact_duplicates(docs)
    digests = rows.select(F.col(names["row"]).alias("row"), "doc_id",
                          F.sha2(F.encode(lower_ascii(F.col("text")), "UTF-8"), 256).alias("text_sha256"))
    return digests.join(decisions, "row").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP5_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


def op6_ngram_quality(spark: SparkSession, sf: str) -> DataFrame:
    trusted = table(spark, sf, "labels").filter("quality = 1 AND coalesce(toxic, 0) = 0")
    return ngram_quality.perplexities(table(spark, sf, "documents"), trusted)


def _kind(k: int) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == k


def op7_pii(spark: SparkSession, sf: str) -> DataFrame:
    found, spans = pii_votes.find_spans(table(spark, sf, "documents"), carry=["doc_id"])
    names = F.array(*[F.lit(k) for k in pii_votes.KINDS])

    def listed(a: Column) -> Column:
        return F.concat_ws(",", F.transform(a, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))

    counts = [F.size(F.filter(spans, _kind(k))).cast("bigint").alias(f"n_{kind}")
              for k, kind in enumerate(pii_votes.KINDS)]
    return found.select("doc_id", *counts, F.sha2(F.encode(listed(F.filter(spans, lambda s: s["base"])), "UTF-8"), 256)
                        .alias("base_sha256"), listed(F.col(spans)).alias("spans"))


def op8_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    done = piece_bpe.encode_decode(table(spark, sf, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return done.select("doc_id", F.expr("CAST(octet_length(ids) div 4 AS BIGINT)").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    judged, names = host_rules.judge(docs, carry=["doc_id"])
    return judged.select("doc_id", *[f"{names['metrics']}.{m}" for m in host_rules.METRICS[:5]],
                         F.col(names["base_failed"]).alias("base_failed"), F.col(names["kept"]).alias("kept"))


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
five AS (SELECT r, i, five FROM (SELECT r, unnest(range(1, len(ws) - 3)) AS i, unnest(list_transform(
             range(1, len(ws) - 3), lambda k: array_to_string(list_slice(ws, k, k + 4), ' '))) AS five FROM w WHERE len(ws) >= 5)),
twice AS (SELECT r, five FROM five GROUP BY r, five HAVING count(*) > 1),
seen AS (SELECT r, i FROM five JOIN twice USING (r, five)),
again AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM seen, range(5) o(k) GROUP BY r),
m AS (SELECT w.r, doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN again ON again.r = w.r),
f AS (SELECT *, n_words < 10 AS short, 100 * n_repeat_words > 20 * n_words AS repeats,
             n_symbols > 0.1::DOUBLE * n_words AS symbols, n_dup_lines > 0.3::DOUBLE * greatest(n_lines, 1) AS dup_lines,
             n_words > 0 AND (word_chars / greatest(n_words, 1) < 2 OR word_chars / greatest(n_words, 1) > 15) AS odd FROM m),
rule AS (SELECT source, unnest([short, repeats, symbols, dup_lines, odd]) AS bad, unnest(range(5)) AS rule FROM f),
host AS (SELECT source, rule, count(*) AS n, count(*) FILTER (WHERE bad) AS bad FROM rule GROUP BY ALL),
prior AS (SELECT rule, sum(bad) / sum(n) AS p, sum(bad * bad / n) / sum(n) AS square FROM host GROUP BY rule),
strength AS (SELECT rule, p, greatest(p * (1 - p) / greatest(square - p * p, 1e-9) - 1, 1.0) AS s FROM prior),
rate AS (SELECT source, n + s AS ns, (bad + s * p) / (n + s) AS rate FROM host JOIN strength USING (rule)),
verdict AS (SELECT source, bool_or(rate - 2 * sqrt(rate * (1 - rate) / (ns + 1)) > 0.5) AS rejected FROM rate GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed,
       NOT (short OR repeats) AND NOT rejected AS kept
FROM f JOIN verdict v ON f.source IS NOT DISTINCT FROM v.source
"""


def op10_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    docs = set_join.keyed(table(spark, sf, "documents"), ["doc_id", "text"])
    return set_join.set_components(docs).select("doc_id", "n_shingles", "component_id")


OP10_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingle AS (SELECT DISTINCT r, array_to_string(list_slice(ws, i, i + 3), ' ') AS s
            FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM d WHERE len(ws) > 0)),
size AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
shared AS (SELECT a.r AS x, b.r AS y, count(*) AS n FROM shingle a JOIN shingle b USING (s) WHERE a.r <> b.r GROUP BY ALL),
link AS (SELECT x, y FROM shared JOIN size p ON p.r = x JOIN size q ON q.r = y WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)),
reach(x, y) AS (SELECT r, r FROM d UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y)
SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles, min(o.doc_id) AS component_id
FROM reach JOIN d ON d.r = reach.x JOIN d o ON o.r = reach.y LEFT JOIN size ON size.r = d.r
GROUP BY d.r, d.doc_id, size.n
"""


def op11_turn_repair(spark: SparkSession, sf: str) -> DataFrame:
    damaged = turn_repair.damage(table(spark, sf, "conversations"))
    return turn_repair.repair(damaged, absent="absent").filter("repaired_sha256 IS NOT NULL").drop("part", "turns")


def _base32(hexed: Column) -> Column:
    """Base32 of 40 hex digits: every five become four."""
    digits = [F.lpad(F.conv(F.substring(hexed, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def op12_warc(spark: SparkSession, sf: str) -> DataFrame:
    found = warc_archive.round_trip(table(spark, sf, "pages").select("page_id", "url", "html"))
    return found.select(
        "page_id", F.coalesce(F.octet_length("payload").cast("bigint"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(_base32(F.sha1("payload")), "payload_digest").alias("payload_digest"), "record_type",
        F.col("refers_to_page").alias("refers_to"))


OP12_SQL = """
WITH p AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS h FROM pages),
k AS (SELECT page_id, h, sha1(h) AS s, row_number() OVER g AS rank, first_value(page_id) OVER g AS first
      FROM p WINDOW g AS (PARTITION BY h ORDER BY page_id DESC NULLS LAST, r))
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
           ((CAST('0x' || substr(s, CAST(i // 4 * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1
           AS INT), 1)), '') AS payload_digest,
       CASE WHEN rank = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN rank > 1 THEN first END AS refers_to
FROM k
"""


def op13_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    return ranked_search.search(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))


OP13_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM documents WHERE text IS NOT NULL),
docs AS (SELECT row_number() OVER () AS r, doc_id, ws, len(ws) AS n FROM words WHERE len(ws) > 0),
corpus AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM docs),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(ws) AS term FROM docs) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
items AS (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark),
asked AS (SELECT i, item_id, term, count(*) AS times FROM items GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, corpus),
scored AS (SELECT i, item_id, r, doc_id,
                  CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // nt)))) AS BIGINT) AS score
           FROM asked JOIN w USING (term) JOIN tf USING (term), corpus GROUP BY ALL),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                  doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_url_filter, op2_token_counts, op3_packing, op4_line_dedup, op5_exact_dedup, op6_ngram_quality, op7_pii,
    op8_sentencepiece, op9_quality_rules, op10_jaccard_join, op11_turn_repair, op12_warc, op13_ranked_search)}

ORACLES: dict[str, str] = {
    "op5_exact_dedup": OP5_SQL, "op9_quality_rules": OP9_SQL, "op10_jaccard_join": OP10_SQL, "op12_warc": OP12_SQL,
    "op13_ranked_search": OP13_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
