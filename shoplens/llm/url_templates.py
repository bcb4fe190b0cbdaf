"""Operator 1: url filters by path-template trees (built-in functions only).

Per host, paths form a tree of segments. Segments that look like numbers
or hashes become wildcards at once; then, level by level, a node with more
than ``FANOUT`` different children has its rarer children replaced by one
wildcard. From the deepest level up, siblings whose share of bad pages does
not differ from that of all of them by more than ``Z`` standard errors are
merged; those that differ stay groups of their own and leave the pool. A
group's bad share is shrunk by a beta prior fitted to the hosts' shares, as
in operator 9; its templates are rejected when the shrunk share minus ``Z``
posterior deviations lies above the corpus's share. There is one round per
level of the deepest path.

Pages are first summed per (host, template), with map-side sums, so a host
with a third of all pages is a few rows from there on. Pages meet their
template's verdict in a join of two stored tables.

Defined results: a null url, or one without ``://``, has empty host and path
and is judged like any host; unlabelled templates have the share of the
siblings they are merged with, the corpus's if none has labels; repeated rows are judged alike; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.config import store
from shoplens.llm.common import UPPER

#: Last segment of a template's node; no real segment holds a slash.
END = "/"
FANOUT = 20
#: Share of a node's pages from which a child stays a branch of its own.
OWN_SHARE = 0.05
Z = 1.96


def host_of(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")), F.substring_index(url, "://", 1)).otherwise(None)
    after = F.substring(url, F.length(rest) + 4, F.length(url))
    return F.coalesce(F.translate(F.regexp_extract(after, "^[^/?#]*", 0), UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")), F.substring_index(url, "://", 1)).otherwise(None)
    after = F.substring(url, F.length(rest) + 4, F.length(url))
    return F.coalesce(F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule string, verdict) of the longest rule that fits; null without one.

    A rule (verdict, domain, path) fits its domain and all subdomains where
    the url's path starts with the rule's.
    """
    name = verdict = F.lit(None).cast("string")
    for kind, domain, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(prefix))
        name, verdict = F.when(fits, domain + prefix).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def segments(path: Column) -> Column:
    """Path segments; variable-looking ones as wildcards."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/")

    def shape(s: Column) -> Column:
        return (F.when(s.rlike("^[0-9]+$"), F.lit("{n}"))
                .when(s.rlike("^[0-9]+[.][A-Za-z0-9]{1,5}$"), F.concat(F.lit("{n}."), F.substring_index(s, ".", -1)))
                .when(s.rlike("^[0-9a-fA-F-]{8,}$") & s.rlike("[0-9]"), F.lit("{h}")).otherwise(s))

    return F.transform(parts, shape)


def generalise(templates: DataFrame) -> DataFrame:
    """(host, segs, path_template, n, labelled, bad): wildcards for rare children, level by level."""
    t = templates.withColumn("path_template", F.col("segs"))
    deepest = t.agg(F.max(F.size("segs")).alias("d")).first()["d"] or 0
    for level in range(deepest):
        node = [F.col("host"), F.slice("path_template", 1, level).alias("node")]
        child = F.get("path_template", F.lit(level))
        kids = t.filter(F.size("path_template") > level).groupBy(*node, child.alias("child")).agg(F.sum("n").alias("kid_n"))
        nodes = kids.groupBy("host", "node").agg(F.count(F.lit(1)).alias("kids"), F.sum("kid_n").alias("node_n"))
        wide = nodes.filter(F.col("kids") > FANOUT)
        rare = store(kids.join(wide, ["host", "node"]).filter(F.col("kid_n") < OWN_SHARE * F.col("node_n"))
                     .select("host", "node", "child", F.lit(True).alias("rare")), "rare_children")
        if rare.isEmpty():
            continue
        left = t.withColumn("node", F.slice("path_template", 1, level)).withColumn("child", child)
        wild = F.transform("path_template", lambda s, i: F.when(i == level, F.lit("*")).otherwise(s))
        t = store(left.join(rare, ["host", "node", "child"], "left").withColumn(
            "path_template", F.when(F.col("rare"), wild).otherwise(F.col("path_template")))
            .drop("node", "child", "rare"), "templates")
    return t


def template_groups(leaves: DataFrame) -> DataFrame:
    """(host, group_node, labelled, bad): siblings alike merged bottom-up, level by level.

    A node's children that differ from all its children together stay groups
    of their own and leave the pool; the rest is the node, one level up. Paths
    end with ``END``, so a template and the branch below it are different nodes.
    """
    deepest = leaves.agg(F.max(F.size("node")).alias("d")).first()["d"] or 0
    pools, groups = None, []
    for level in range(deepest, 0, -1):
        own = leaves.filter(F.size("node") == level)
        nodes = own if pools is None else own.unionByName(pools)
        nodes = nodes.withColumn("parent", F.slice("node", 1, level - 1))
        parents = nodes.groupBy("host", "parent").agg(F.sum("labelled").alias("p_labelled"), F.sum("bad").alias("p_bad"))
        pooled = (F.col("p_bad") + 1) / (F.col("p_labelled") + 2)
        off = F.col("bad") - F.col("labelled") * pooled
        alike = off * off <= Z * Z * F.col("labelled") * pooled * (1 - pooled)
        judged = store(nodes.join(parents, ["host", "parent"]).select(
            "host", "node", "parent", "labelled", "bad", alike.alias("alike")), "sibling_templates")
        groups.append(judged.filter(~F.col("alike")).select("host", "node", "labelled", "bad"))
        # A pool that is empty remains as a node without labels.
        kept = [F.coalesce(F.sum(F.when(F.col("alike"), F.col(c))), F.lit(0)).cast("bigint").alias(c) for c in ("labelled", "bad")]
        pools = judged.groupBy("host", F.col("parent").alias("node")).agg(*kept)
    for g in groups:
        pools = g if pools is None else pools.unionByName(g)
    pools = leaves if pools is None else pools
    return store(pools.select("host", F.col("node").alias("group_node"), "labelled", "bad"), "template_groups")


def host_prior(hosts: DataFrame) -> tuple[float, float]:
    """(mean, strength) of the beta prior of the hosts' bad shares, by the method of moments."""
    share = F.col("bad") * F.col("bad") / F.col("labelled")
    m = hosts.filter("labelled > 0").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("bad"), F.sum(share).alias("square")).first()
    n = m["n"] or 0
    if not n:
        return 0.5, 1.0
    p = (m["bad"] + 1) / (n + 2)
    variance = max(m["square"] / n - (m["bad"] / n) ** 2, 1e-9)
    return p, max(p * (1 - p) / variance - 1, 1.0)


def judged_templates(templates: DataFrame) -> DataFrame:
    """(host, segs, template, merged, bad_share, rejected) of every raw template."""
    t = generalise(templates)
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("labelled", "bad")]
    leaves = store(t.groupBy("host", F.concat("path_template", F.array(F.lit(END))).alias("node")).agg(*sums), "template_leaves")
    p, strength = host_prior(leaves.groupBy("host").agg(*sums))
    groups = template_groups(leaves)
    # A template belongs to the first group on its way up.
    way = leaves.select("host", "node", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("node")), lambda k: F.slice("node", 1, k))).alias("group_node"))
    best = way.join(groups, ["host", "group_node"]).groupBy("host", "node").agg(
        F.max(F.struct(F.size("group_node").alias("size"), "labelled", "bad")).alias("g"))
    total = F.col("g.labelled") + strength
    share = (F.col("g.bad") + p * strength) / total
    low = share - Z * F.sqrt(share * (1 - share) / (total + 1))
    leaves = store(best.select("host", F.slice("node", 1, F.size("node") - 1).alias("path_template"),
                               (F.col("g.size") < F.size("node")).alias("merged"), share.alias("bad_share"),
                               (low > p).alias("rejected")), "template_purity")
    return t.join(leaves, ["host", "path_template"]).select(
        "host", "segs", F.concat(F.lit("/"), F.concat_ws("/", "path_template")).alias("template"), "merged", "bad_share",
        "rejected")


def judge_urls(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, bad_share) of every page.

    ``labels``: (page_id, bad 0/1); where a page has several, it is bad if one says so.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    label = labels.groupBy("page_id").agg(F.max("bad").alias("bad"))
    rows = store(rows.join(label, "page_id", "left").withColumn("segs", segments(F.col("path"))), "url_rows")
    templates = store(rows.groupBy("host", "segs").agg(
        F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")),
        "url_templates")
    verdicts = store(judged_templates(templates), "template_verdicts")
    rule, given = matching_rule(F.col("host"), F.col("path"), rules)
    return rows.join(verdicts, ["host", "segs"]).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(given, F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"), "template", "bad_share")
