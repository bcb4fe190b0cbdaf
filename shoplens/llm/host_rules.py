"""Operator 9: quality rules with host-level verdicts (built-in functions only).

Per document (no shuffle): word and symbol counts, repeated lines and the
words inside repeated five-word windows, each a built-in expression over
the document's own arrays, linear or sort-based in its length.

Per host (the ``source`` column): failures of every rule are summed with
map-side sums, so a host with a third of all rows sends one row per task.
A host's failure rate is shrunk by an empirical beta prior whose mean and
strength come from the hosts' rates by the method of moments. A host is
rejected when, for some rule, the lower end of the shrunk rate (posterior
mean minus ``Z`` posterior deviations) is above ``MAX_RATE``; the verdicts,
one row per host, are joined back to the documents.

Defined results: null or empty text has no words, so it fails the base
rule; a null host is a host; repeated rows count each; an empty table gives
no rows; extra columns are carried by ``judge`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.config import store
from shoplens.llm.common import SPACE_CLASS, free_name, let

WINDOW = 5
MIN_WORDS = 10
MAX_RATE = 0.5
Z = 2.0
#: Further document rules that only count towards a host: limits on ratios.
MAX_SYMBOLS_PER_WORD = 0.1
MAX_DUP_LINE_SHARE = 0.3
WORD_LENGTH = (2.0, 15.0)
RULES = ("short", "repeats", "symbols", "dup_lines", "word_length")
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """The words of a text: runs of anything but the six white-space characters."""
    return F.filter(F.split(text, f"[{SPACE_CLASS}]+"), lambda w: w != "")


def _covered(starts: Column) -> Column:
    """Number of positions covered by windows at the ascending ``starts``."""
    first = F.struct(F.lit(-WINDOW).cast("int").alias("last"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        starts, first,
        lambda a, p: F.struct(p.alias("last"),
                              (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).cast("bigint").alias("n")),
        lambda a: a["n"])


def repeat_words(words: Column) -> Column:
    """Words inside five-word windows found twice or more in the text.

    Windows are compared by 64-bit hashes. Texts without a repeated window
    stop after one hash-set pass; the others sort (hash, position) and keep
    the positions whose neighbour has the same hash.
    """
    def by_words(hashes: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW), lambda i: F.xxhash64(
            *[F.get(hashes, i + k) for k in range(WINDOW)]))
        return F.when(F.size(hashes) < WINDOW, F.lit(0).cast("bigint")).otherwise(let(windows, by_windows))

    def by_windows(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return (F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint"))
                .otherwise(let(pairs, by_pairs)))

    def by_pairs(pairs: Column) -> Column:
        twice = F.filter(pairs, lambda p, k: p["h"].eqNullSafe(F.get(pairs, k - 1)["h"])
                         | p["h"].eqNullSafe(F.get(pairs, k + 1)["h"]))
        return _covered(F.sort_array(F.transform(twice, lambda p: p["i"])))

    return let(F.transform(words, lambda w: F.xxhash64(w)), by_words)


def metrics(text: Column) -> Column:
    """Struct of ``METRICS`` for one text."""
    long = lambda c: c.cast("bigint")

    def of(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: F.translate(x, _SPACES, "") != "")
        n_lines = let(lines, lambda x: F.struct(
            long(F.size(x)).alias("all"), long(F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
        n_words = let(words_of(t), lambda w: F.struct(
            long(F.size(w)).alias("n"), repeat_words(w).alias("repeat")))
        return F.struct(
            n_words.alias("w"), n_lines.alias("l"),
            long(F.length(F.translate(t, _SPACES, ""))).alias("word_chars"),
            long(F.length(t) - F.length(F.translate(t, _SYMBOLS, ""))).alias("n_symbols"))

    return let(F.coalesce(text, F.lit("")), of)


def failures(m: dict[str, Column]) -> dict[str, Column]:
    """Rule name -> failed, from metric columns."""
    n = F.greatest(m["n_words"], F.lit(1))
    mean = m["word_chars"] / n
    return {
        "short": m["n_words"] < MIN_WORDS,
        "repeats": 100 * m["n_repeat_words"] > 20 * m["n_words"],
        "symbols": m["n_symbols"] > MAX_SYMBOLS_PER_WORD * m["n_words"],
        "dup_lines": m["n_dup_lines"] > MAX_DUP_LINE_SHARE * F.greatest(m["n_lines"], F.lit(1)),
        "word_length": (m["n_words"] > 0) & ((mean < WORD_LENGTH[0]) | (mean > WORD_LENGTH[1])),
    }


def measure(docs: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with one more column: a struct of the metrics."""
    raw = free_name([*docs.columns, name], "raw")
    flat = F.struct(F.col(f"{raw}.w.n").alias("n_words"), F.col(f"{raw}.word_chars").alias("word_chars"),
                    F.col(f"{raw}.n_symbols").alias("n_symbols"), F.col(f"{raw}.l.dup").alias("n_dup_lines"),
                    F.col(f"{raw}.w.repeat").alias("n_repeat_words"), F.col(f"{raw}.l.all").alias("n_lines"))
    return (docs.withColumn(raw, metrics(F.col(text_col))).withColumn(name, flat).drop(raw))


def host_verdicts(measured: DataFrame, name: str, host_col: str = "source") -> DataFrame:
    """(host, n_docs, rejected, rate_<rule>...): shrunk failure rates per host.

    The prior of a rule: with host rates of mean p and variance v (weighted
    by documents), strength s = p (1 - p) / v - 1, at least 1; a host with f
    failures in n documents has rate (f + s p) / (n + s).
    """
    failed = failures({k: F.col(f"{name}.{k}") for k in METRICS})
    hosts = measured.groupBy(F.col(host_col).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(c.cast("int")).alias(f"f_{r}") for r, c in failed.items()])
    hosts = store(hosts, "host_failures")
    total = F.sum("n_docs")
    moments = []
    for r in RULES:
        p = F.sum(f"f_{r}") / total
        square = F.sum(F.col(f"f_{r}") * F.col(f"f_{r}") / F.col("n_docs")) / total
        variance = F.greatest(square - p * p, F.lit(1e-9))
        moments += [p.alias(f"p_{r}"), F.greatest(p * (1 - p) / variance - 1, F.lit(1.0)).alias(f"s_{r}")]
    prior = hosts.agg(*moments).first()                # two numbers per rule
    out, reject = hosts, F.lit(False)
    for r in RULES:
        mean, strength = (F.lit(0.0 if prior[k] is None else prior[k]) for k in (f"p_{r}", f"s_{r}"))
        n = F.col("n_docs") + strength
        rate = (F.col(f"f_{r}") + strength * mean) / n
        low = rate - Z * F.sqrt(rate * (1 - rate) / (n + 1))
        out = out.withColumn(f"rate_{r}", rate)
        reject = reject | (low > MAX_RATE)
    return out.select("host", "n_docs", reject.alias("rejected"), *[f"rate_{r}" for r in RULES])


def judge(docs: DataFrame, host_col: str = "source", text_col: str = "text",
          carry: list[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` (its columns ``carry``, by default all) plus metrics (a struct),
    base_failed and kept, under free names."""
    names = {k: free_name(docs.columns, k) for k in ("metrics", "base_failed", "kept", "host_key", "host_rejected")}
    carry = docs.columns if carry is None else carry
    measured = measure(docs, names["metrics"], text_col).select(
        *carry, F.col(host_col).alias(names["host_key"]), names["metrics"])
    measured = store(measured, "quality_metrics")
    verdicts = store(host_verdicts(measured, names["metrics"], names["host_key"]), "host_verdicts").select(
        "host", F.col("rejected").alias(names["host_rejected"]))
    failed = failures({k: F.col(f"{names['metrics']}.{k}") for k in METRICS})
    base = failed["short"] | failed["repeats"]
    left = measured.withColumn(names["base_failed"], base)
    out = left.join(verdicts, left[names["host_key"]].eqNullSafe(verdicts["host"]), "left").select(
        *[left[c] for c in (*carry, names["metrics"], names["base_failed"])],
        (~left[names["base_failed"]] & ~F.coalesce(names["host_rejected"], F.lit(False))).alias(names["kept"]))
    return out, names


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that the rules or their host's verdict reject."""
    judged, names = judge(docs)
    return judged.filter(names["kept"]).select(*docs.columns)
