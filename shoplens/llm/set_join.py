"""Operator 10: n-gram Jaccard join with set-relation skipping.

Sets are the distinct 4-word shingles of a text, told apart by 128-bit hashes
made of their words' digests; 64 bits of them order and index the sets, all
128 name classes and verify links. Two sets link when ``100 * |x & y| >= 85 * |x | y|``. The result is every row's set
size and its component. ``drop_near_copies`` is told width and limit by its
caller.

Classes.   Rows with equal sets form a class (grouped by a 128-bit digest
           with map-side combining); one row of it stands for all.
Order.     Shingles are ordered by (common, hash). ``common`` are those that
           more than ``COMMON`` sets hold; they are counted over all texts in
           the hash range that prefixes can reach, and reach the tasks as a
           bitmap of fixed size. A shingle the bitmap marks by accident is
           merely ordered later: any order gives the same links.
Index      A set is listed under the first shingles of its order, as many as
lists.     a partner may lack. A list holds (set, size, position). If x and y
           link, the first shingle they share stands at positions i and j with
           ``i + j <= |x ^ y| <= slack(|x|, |y|)``.
Short      Lists of up to ``COMMON`` rows give their pairs directly.
Pivots     In a longer list the ``PIVOTS`` most listed sets are compared with
(answers   the others (a few pairs per row, not all pairs). A set linked to a
reused).   pivot is connected with all that the pivot links to, so the pivot's
           answers serve for it: the components of the links found so far are
           settled. All keep their distance to a pivot.
Skipping   What is left open in long lists is compared in parts of ``PART``
by         rows. Skipped without a look at the sets: pairs already connected,
position.  positions or sizes that rule a link out, pairs whose distances d to
           the same pivot p differ by more than a link allows
           (``d(x, y) >= |d(p, x) - d(p, y)|``), and pairs whose parity maps
           differ too much. Only the rest leaves the task.

Verification first compares parity bitmaps (a lower bound of the
distance, as exact as their length allows), then the sets themselves,
computed again from the two texts.

Defined results: null or empty text, or one without words, has an empty
set, ``n_shingles`` 0, and stands alone; repeated rows and repeated doc_ids
are classes like any other; a null doc_id never names a component that has
another; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.config import release, store, tracked_scratch
from shoplens.llm.common import free_name, row_slices, texts_of, with_row_key
from shoplens.llm.components import connected_components
from shoplens.llm.list_compare import near_pairs, parity_bits, parity_distance
from shoplens.llm.shingles import in_common, shingle_halves, shingle_set

WIDTH = 4
#: Similarity as a ratio of integers: at least NUM / DEN.
NUM, DEN = 85, 100
#: Sets that may hold a shingle before it counts as common; rows of a short list.
COMMON = 8
#: Pivots of a list of at least ``PIVOT_ROWS`` rows; what their answers leave
#: open, and lists below that, is compared in full.
PIVOTS = 16
PIVOT_ROWS = 64
#: Rows of a long list that one comparison holds.
PART = 2048
#: Bits of the map of common shingles (8 MB).
MAP_BITS = 1 << 26
#: Share of the hash range whose shingles are counted: 1 / 2 ** RANGE_BITS.
RANGE_BITS = 3


def prefix_length(n: int, num: int = NUM, den: int = DEN) -> int:
    """Shingles of a set of ``n`` that a linked set may lack, plus one."""
    return n - -(-num * n // den) + 1


def slack(a: Column, b: Column, num: int, den: int) -> Column:
    """Largest symmetric difference of linked sets of sizes ``a`` and ``b``."""
    both = a + b
    return both - 2 * F.ceil(both * F.lit(num) / F.lit(num + den)).cast("bigint")


def _sizes_fit(small: Column, large: Column, num: int, den: int) -> Column:
    return small * den >= large * num


def low_hashes(texts: DataFrame, width: int, range_bits: int) -> DataFrame:
    """(shingle) of every text's set below the counted range, as signed longs."""
    limit = np.uint64(1 << (64 - range_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(0))
            for lo, hi in row_slices([len(t) for t in texts]):
                sets = [s[:np.searchsorted(s, limit)] for s in (shingle_set(t, width) for t in texts[lo:hi])]
                if sets:
                    found = np.concatenate(sets).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(found)], ["shingle"])

    return texts.mapInArrow(run, "shingle long")


def common_map(shingles: DataFrame, common: int, bits: int) -> np.ndarray:
    """Bitmap of the shingles that more than ``common`` rows hold."""
    words = (shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > common)
             .select(F.pmod("shingle", F.lit(bits)).alias("slot"))
             .groupBy(F.expr("slot div 64").cast("int").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, CAST(slot % 64 AS INT)))").alias("mask")))
    out = np.zeros(bits // 64, np.uint64)
    found = words.toArrow()                            # at most bits / 64 rows
    out[found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return out


def sets_table(docs: DataFrame, marked: np.ndarray, width: int, num: int, den: int) -> DataFrame:
    """(doc_id, text, n, digest, parity, prefix) of every row."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(marked)        # MAP_BITS / 8 bytes, whatever the corpus
    bits = np.uint64(len(marked) * 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lo, hi in row_slices([len(t) for t in texts]):
                sizes, digests, parities, prefixes = [], [], [], []
                for t in texts[lo:hi]:
                    s, second = shingle_halves(t, width)
                    sizes.append(len(s))
                    if not len(s):
                        digests.append(None), parities.append(None), prefixes.append([])
                        continue
                    slot = s % bits
                    often = (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)
                    k = prefix_length(len(s), num, den)
                    first = s[often == 0][:k]
                    if len(first) < k:
                        first = np.concatenate((first, s[often == 1][:k - len(first)]))
                    digests.append(blake2b(s.tobytes() + second.tobytes(), digest_size=16).digest())
                    parities.append(parity_bits(s))
                    prefixes.append(first.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(parities, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))],
                    ["doc_id", "n", "digest", "parity", "prefix"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id long, n long, digest binary, parity binary, prefix array<long>")


def bounded(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The candidate pairs (a, b, flag) whose parity maps leave a link possible."""
    side = lambda k: sets.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("parity").alias(f"p{k}"))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parity_distance(x, y) for x, y in zip(batch["pa"].to_pylist(), batch["pb"].to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("a", "b", "flag", "na", "nb")),
                                              pa.array(found, pa.int64())], ["a", "b", "flag", "na", "nb", "low"])

    near = pairs.select("a", "b", "flag").join(side("a"), "a").join(side("b"), "b").mapInArrow(
        bound, "a long, b long, flag boolean, na long, nb long, low long")
    return near.filter(F.col("low") <= slack(F.col("na"), F.col("nb"), num, den)).select("a", "b", "flag")


def distances(pairs: DataFrame, texts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(a, b, flag, d, linked) of the pairs; ``d`` is the exact symmetric difference.

    Of the texts, those of the pairs are picked once and then met by them.
    """
    near = store(pairs, "near_pairs")
    asked = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct()
    picked = store(texts.join(asked, "node", "left_semi"), "near_texts")
    text = lambda k: picked.select(F.col("node").alias(k), F.col("text").alias(f"t{k}"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, x = None, None                           # pairs mostly come with the same first set in a row
        for batch in batches:
            found, linked = [], []
            for a, s, t in zip(batch["a"].to_pylist(), batch["ta"].to_pylist(), batch["tb"].to_pylist()):
                if a != last:
                    last, x = a, shingle_halves(s or "", width)
                y = shingle_halves(t or "", width)
                both, sizes = in_common(x, y), len(x[0]) + len(y[0])
                found.append(sizes - 2 * both)
                linked.append(den * both >= num * (sizes - both))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], batch["flag"], pa.array(found, pa.int64()),
                                              pa.array(linked, pa.bool_())], ["a", "b", "flag", "d", "linked"])

    return store(near.join(text("b"), "b").join(text("a"), "a").mapInArrow(
        verify, "a long, b long, flag boolean, d long, linked boolean"), "set_distances")


def _pivot_pairs(long: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): each long list's pivots a against its other rows.

    Pivots are the ``PIVOTS`` rows listed most often: of a family of near
    copies the ones with the fewest words of their own. Ties fall to a hash.
    A row's pivots are gathered over its lists (no more than its prefix
    length times ``PIVOTS``), so that each pair is formed once.
    """
    first = Window.partitionBy("shingle").orderBy(F.desc("score"), F.xxhash64("node"))
    long = long.filter(F.col("held") >= PIVOT_ROWS)
    heads = long.select("shingle", "node", "n", "pos", "score", F.row_number().over(first).alias("k")).filter(
        F.col("k") <= PIVOTS)
    heads = store(heads.groupBy("shingle").agg(F.collect_list(F.struct("node", "n", "pos")).alias("heads")), "list_heads")

    def may_link(h: Column) -> Column:
        return ((h["node"] != F.col("node"))
                & _sizes_fit(F.least(F.col("n"), h["n"]), F.greatest(F.col("n"), h["n"]), num, den)
                & (F.col("pos") + h["pos"] <= slack(F.col("n"), h["n"], num, den)))

    met = long.join(heads, "shingle").select(
        "node", F.array_sort(F.transform(F.filter("heads", may_link), lambda h: h["node"])).alias("pivots"))
    return (met.filter(F.size("pivots") > 0).groupBy("node").agg(F.collect_set("pivots").alias("pivots"))
            .select(F.explode(F.array_distinct(F.flatten("pivots"))).alias("a"), F.col("node").alias("b")))


def _answers(met: DataFrame) -> DataFrame:
    """(node, anchor, dist): a pivot at a known distance, from the verified pivot pairs."""
    own = met.select(F.col("a").alias("node"), F.col("a").alias("pivot"), F.lit(0).cast("bigint").alias("d")).distinct()
    rows = met.select(F.col("b").alias("node"), F.col("a").alias("pivot"), "d").unionByName(own)
    best = rows.groupBy("node").agg(F.min(F.struct(F.xxhash64("pivot").alias("h"), "pivot", "d")).alias("near"))
    return best.select("node", F.col("near.pivot").alias("anchor"), F.col("near.d").alias("dist"))


def _open_pairs(long: DataFrame, labels: DataFrame, answers: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): pairs of sets in long lists that neither labels, positions, sizes, known
    distances nor parity maps settle.

    Lists are dealt in parts of about ``PART`` rows; a task compares one
    part, or two parts with each other, at a time.
    """
    rows = long.join(labels, "node", "left").join(answers, "node", "left").select(
        "shingle", "node", "n", "pos", F.coalesce("component", "node").alias("label"),
        F.coalesce("anchor", "node").alias("anchor"), F.coalesce("dist", F.lit(0)).alias("dist"), "parity")
    rows = store(rows, "open_rows")
    lists = (rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("held"), F.min("pos").alias("first"),
                                         F.min("label").alias("l0"), F.max("label").alias("l1"))
             .filter("l0 <> l1").select("shingle", F.ceil(F.col("held") / PART).cast("int").alias("parts"), "first"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = (rows.join(store(lists, "open_lists"), "shingle")
             .filter(F.col("pos") + F.col("first") <= F.floor(F.col("n") * ((den - num) / num)))
             .withColumn("part", part)
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("shingle", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j"),
                     "part", "node", "n", "pos", "label", "anchor", "dist", "parity"))
    key = ["shingle", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None                                    # rows of a group that may go on in the next batch
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            left, full = _cut_last(rows if left is None else pa.concat_tables([left, rows]).combine_chunks(), key)
            yield from _compared(full, key, num, den)
        if left is not None:
            yield from _compared(left, key, num, den)

    return (dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(compare, "a long, b long").distinct())


def _group_ends(rows: pa.Table, key: list[str]) -> np.ndarray:
    change = np.zeros(max(len(rows) - 1, 0), bool)
    for k in key:
        x = rows[k].to_numpy()
        change |= x[1:] != x[:-1]
    return np.flatnonzero(change) + 1


def _cut_last(rows: pa.Table, key: list[str]) -> tuple[pa.Table, pa.Table]:
    """(rows of the last group, the rows before it)."""
    ends = _group_ends(rows, key)
    at = int(ends[-1]) if len(ends) else 0
    return rows.slice(at), rows.slice(0, at)


def _compared(rows: pa.Table, key: list[str], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Open pairs of each group of ``rows``."""
    if not len(rows):
        return
    columns = {c: rows[c].to_numpy() for c in ("i", "j", "part", "node", "n", "pos", "label", "anchor", "dist")}
    parity = rows["parity"].to_pylist()
    ends = _group_ends(rows, key).tolist() + [len(rows)]
    lo, out = 0, set()
    for hi in ends:
        c = {k: v[lo:hi] for k, v in columns.items()}
        out.update((min(p), max(p)) for p in near_pairs(
            c["node"], c["n"], c["pos"], c["label"], c["anchor"], c["dist"], parity[lo:hi], c["part"],
            bool(c["i"][0] != c["j"][0]), num, den))
        lo = hi
    a, b = ([p[k] for p in out] for k in (0, 1))
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def set_components(docs: DataFrame, width: int = WIDTH, num: int = NUM, den: int = DEN, common: int = COMMON,
                   map_bits: int = MAP_BITS, range_bits: int = RANGE_BITS) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, links_found) of every row of ``docs``.

    ``docs`` needs doc_id, text and a stable long column ``row``.
    """
    marked = common_map(low_hashes(docs.select("text"), width, range_bits), common, map_bits)
    rows = docs.select(F.col("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    keyed = rows.select(F.col("row").alias("doc_id"), "text")          # the row key takes the id's place
    with tracked_scratch() as first:
        sets = store(sets_table(keyed, marked, width, num, den).withColumnRenamed("doc_id", "row"), "shingle_sets")
        classes = store(sets.filter("n > 0").groupBy("digest").agg(F.min("row").alias("node")), "set_classes")
    nodes = store(sets.filter("n > 0").join(classes, "digest").filter("row = node")
                  .select("node", "n", "parity", "prefix"), "set_nodes")
    names = store(sets.join(classes, "digest", "left").select(
        "row", F.col("n").alias("n_shingles"), F.coalesce("node", "row").alias("node")), "set_members")
    release(docs.sparkSession, first)                  # read by what has been written, no more needed
    texts = rows.select(F.col("row").alias("node"), "text")

    with tracked_scratch() as lists:
        listed = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "shingle"))
        held = listed.groupBy("shingle").agg(F.count(F.lit(1)).alias("held"))
        live = store(listed.join(held.filter("held > 1"), "shingle").select("shingle", "node", "n", "pos", "held"),
                     "index_lists")

        # Short lists: a few pairs of sets each, where position and size allow.
        short = live.filter(F.col("held") <= common).drop("held")
        other = short.select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "pos")])
        pairs = short.join(other, "shingle").filter(
            (F.col("node") < F.col("node_b"))
            & _sizes_fit(F.least("n", "n_b"), F.greatest("n", "n_b"), num, den)
            & (F.col("pos") + F.col("pos_b") <= slack(F.col("n"), F.col("n_b"), num, den))).select(
            F.col("node").alias("a"), F.col("node_b").alias("b"))

        # Long lists: pivots first, then whatever their answers leave open.
        long = live.filter(F.col("held") > common)
        listings = long.groupBy("node").agg(F.count(F.lit(1)).alias("score"))
        long = store(long.join(listings, "node").join(nodes.select("node", "parity"), "node"), "long_lists")
        flagged = pairs.withColumn("flag", F.lit(False)).unionByName(
            _pivot_pairs(long.drop("parity"), num, den).withColumn("flag", F.lit(True)))
        flagged = flagged.groupBy("a", "b").agg(F.max("flag").alias("flag"))
        met = distances(bounded(flagged, nodes, num, den), texts, width, num, den)
    labels = connected_components(store(met.filter("linked").select("a", "b"), "set_links"))
    with tracked_scratch() as parts:
        rest = _open_pairs(long, labels, _answers(met.filter("flag")), num, den).withColumn("flag", F.lit(False))
        found = distances(rest, texts, width, num, den)
    name = lambda k: labels.select(F.col("node").alias(k), F.col("component").alias(f"c{k}"))
    bridges = found.filter("linked").join(name("a"), "a", "left").join(name("b"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    joined = connected_components(store(bridges, "component_links")).select(
        F.col("node").alias("label"), F.col("component").alias("whole"))
    release(docs.sparkSession, lists + parts)

    named = (names.join(labels, "node", "left")
             .select("row", "n_shingles", F.coalesce("component", "node").alias("label")).join(joined, "label", "left")
             .select("row", "n_shingles", F.coalesce("whole", "label").alias("component")))
    full = store(named.join(rows.select("row", "doc_id"), "row"), "set_rows")
    smallest = store(full.groupBy("component").agg(F.min("doc_id").alias("component_id"),
                                                   F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
                     .select("component", "component_id", F.col("first.row").alias("first_row")), "set_names")
    return full.join(smallest, "component").select("row", "doc_id", "n_shingles", "component_id", "first_row")


def keyed(docs: DataFrame, columns: list[str], row: str = "row") -> DataFrame:
    """The given columns of ``docs`` stored with a stable row key."""
    return store(with_row_key(docs.select(*columns), row), "keyed_documents")


def drop_near_copies(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``docs`` with one document of each component: the smallest doc_id, then the first row.

    Texts link when their ``width``-word sets are alike by at least ``num / den``.
    """
    key = free_name(docs.columns, "row")
    table = keyed(docs, docs.columns, key)
    found = set_components(table.select(F.col(key).alias("row"), "doc_id", "text"), width, num, den)
    kept = found.filter("row = first_row").select(F.col("row").alias(key))
    return table.join(kept, key, "left_semi").select(*docs.columns)
