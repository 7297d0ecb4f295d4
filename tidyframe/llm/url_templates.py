"""URL filter by rules and by a path-template tree [native].

Rules decide first.  The other urls are judged by the template of their path:
per host a tree of path segments is built level by level, as deep as the paths go;
under a parent whose children are many and mostly rare (ids, slugs), the children
become one ``*``, where a child is rare by the distinct paths below it, however many
rows they have;
sibling branches whose rule labels do not differ significantly (and that have
labels at all) share one pool of labels; a template is rejected when its
smoothed share of blocked labels reaches ``threshold``.  Smoothing draws a
branch with few labels towards its parent, the parent towards its host, the host
towards ``PRIOR``; a template without labels has ``PRIOR``.

Everything is counted per distinct (host, path), with map-side sums, and joined
back by key; no step needs all urls of a host in one task.

Defined results: a null url, or one without ``://``, has an empty host and path
and the verdict ``allow``; host and path of a url are its own even if repeated;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyframe.llm.common import materialize
from tidyframe.session import scratch_path

#: (rule, verdict); a rule is host/path
Rule = tuple[str, str]

MIN_CHILDREN = 8     # a parent with fewer distinct children keeps them
MAX_MEAN_URLS = 4.0  # ... and so does one whose children hold more distinct paths on average,
RARE_SHARE = 0.5     # unless this share of them does not
STRENGTH = 4.0       # pseudo-labels drawn from the parent
PRIOR = 0.1          # blocked share expected where there are no labels
Z_SIMILAR = 1.96     # sibling branches closer than this many standard errors merge


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): what stands after the first ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def match_rules(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule whose host is ``host`` or a
    parent domain of it and whose path starts ``path``; null if there is none.
    The rule list is a parameter and becomes one literal map keyed by host."""
    kind = "array<struct<size:int,rule:string,path:string,verdict:string>>"
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    by_host: dict[str, list[Rule]] = {}
    for rule, verdict in rules:
        by_host.setdefault(rule.partition("/")[0].lower(), []).append((rule, verdict))
    entries = []
    for h, own in by_host.items():
        entries += [F.lit(h), F.array(*[
            F.struct(F.lit(len(r)).alias("size"), F.lit(r).alias("rule"),
                     F.lit("/" + r.partition("/")[2]).alias("path"), F.lit(v).alias("verdict"))
            for r, v in own])]
    table = F.create_map(*entries)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda k: F.concat_ws(".", F.slice(labels, k, F.size(labels))))
    found = F.flatten(F.transform(
        domains, lambda d: F.coalesce(F.try_element_at(table, d), F.array().cast(kind))))
    fits = F.filter(found, lambda r: F.startswith(path, r["path"]))
    best = F.try_element_at(F.sort_array(fits, asc=False), F.lit(1))
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"),
                                             best["verdict"].alias("verdict")))


def template_tree(paths: DataFrame) -> DataFrame:
    """``paths(host, path, n, n_labelled, n_blocked)``, one row per distinct host
    and path -> the same rows with ``template`` (segments joined by ``/``).  Each
    level is written before the next reads it twice; only rows that a deeper level can
    still change go on to it."""
    spark, folder, levels = paths.sparkSession, scratch_path(paths.sparkSession, "url-levels"), []
    left = materialize(paths.select(
        "*", F.filter(F.split("path", "/"), lambda s: s != "").alias("_seg"),
        F.lit("").alias("template")), "url-paths")
    while not levels or not left.isEmpty():
        level = len(levels)
        seg, below = F.get("_seg", F.lit(level)), F.size("_seg") - level
        children = (left.filter(below > 0).groupBy("host", "template", seg.alias("_s"))
                    .agg(F.count("*").alias("_paths")))
        rare = F.avg((F.col("_paths") <= MAX_MEAN_URLS).cast("int")) >= RARE_SHARE
        # under a parent of fewer paths no level can become "*" any more
        parents = (children.groupBy("host", "template").agg(
            F.sum("_paths").alias("_all"), ((F.count("*") >= MIN_CHILDREN) & (
                (F.avg("_paths") <= MAX_MEAN_URLS) | rare)).alias("_wild"))
            .filter(F.col("_all") >= MIN_CHILDREN).select("host", "template", "_wild"))
        rest = F.array_join(F.slice("_seg", F.lit(level + 1), F.greatest(below, F.lit(0))), "/")
        step = F.when(F.col("_wild").isNull(), rest).when(F.col("_wild"), "*").otherwise(seg)
        out = (left.join(parents, ["host", "template"], "left")
               .withColumn("_done", F.col("_wild").isNull() | (below <= 1))
               .withColumn("template", F.when(below > 0, F.concat("template", F.lit("/"), step))
                           .otherwise(F.col("template"))).drop("_wild"))
        levels.append(f"{folder}/{level}")
        out.write.parquet(levels[-1])
        left = spark.read.schema(out.schema).parquet(levels[-1]).filter("NOT _done").drop("_done")
    return spark.read.schema(out.schema).parquet(*levels).filter("_done").drop("_seg", "_done")


def template_verdicts(tree: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(host, template, branch, purity, verdict), one row per template."""
    own = materialize(tree.groupBy("host", "template").agg(
        F.sum("n").alias("n"), F.sum("n_labelled").alias("n_labelled"),
        F.sum("n_blocked").alias("n_blocked"))
        .withColumn("parent", F.regexp_replace("template", "/[^/]*$", "")), "url-templates")
    rate = lambda blocked, labels, prior: (blocked + STRENGTH * prior) / (labels + STRENGTH)
    host = own.groupBy("host").agg(rate(
        F.sum("n_blocked"), F.sum("n_labelled"), F.lit(PRIOR)).alias("_host"))
    above = own.groupBy("host", "parent").agg(
        F.sum("n_blocked").alias("_pb"), F.sum("n_labelled").alias("_pl"))
    above = above.join(host, "host").select(
        "host", "parent", rate(F.col("_pb"), F.col("_pl"), F.col("_host")).alias("_parent"),
        (F.col("_pb") / F.nullif(F.col("_pl"), F.lit(0))).alias("_raw"))
    judged = own.join(above, ["host", "parent"])
    share = F.col("n_blocked") / F.nullif(F.col("n_labelled"), F.lit(0))
    error = F.sqrt(F.greatest(F.col("_raw") * (1 - F.col("_raw")), F.lit(1e-4))
                   / F.nullif(F.col("n_labelled"), F.lit(0)))
    # a branch like the pool of its siblings joins that pool; an odd one stands alone
    merged = F.coalesce(F.abs(share - F.col("_raw")) <= Z_SIMILAR * error, F.lit(False))
    judged = judged.withColumn("branch", F.when(merged, F.lit("pool")).otherwise(F.col("template")))
    pool = judged.groupBy("host", "parent", "branch").agg(
        F.sum("n_blocked").alias("_gb"), F.sum("n_labelled").alias("_gl"))
    # labels of other branches say nothing about a template that has none itself
    prior = F.when(F.col("_gl") > 0, F.col("_parent")).otherwise(F.lit(PRIOR))
    return (judged.join(pool, ["host", "parent", "branch"])
            .withColumn("purity", 1 - rate(F.col("_gb"), F.col("_gl"), prior))
            .withColumn("verdict", F.when(1 - F.col("purity") >= threshold, "block").otherwise("allow"))
            .select("host", "template", "parent", "branch", "n", "n_labelled", "n_blocked",
                    "purity", "verdict"))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], threshold: float = 0.5) -> DataFrame:
    """``pages(page_id, url)`` -> page_id, host, path, rule, verdict, template, purity."""
    host, path = split_url(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = urls.withColumn("_hit", match_rules(F.col("host"), F.col("path"), rules))
    hit = F.col("_hit.verdict")
    paths = urls.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count(hit).alias("n_labelled"),
        F.count(F.when(hit == "block", 1)).alias("n_blocked"))
    tree = template_tree(paths)
    verdicts = template_verdicts(tree, threshold).select(
        "host", "template", "purity", F.col("verdict").alias("_verdict"))
    per_path = tree.join(verdicts, ["host", "template"]).select(
        "host", "path", "template", "purity", "_verdict")
    return urls.join(per_path, ["host", "path"]).select(
        "page_id", "host", "path", F.col("_hit.rule").alias("rule"),
        F.coalesce(hit, F.when(F.col("host") == "", "allow"), F.col("_verdict")).alias("verdict"),
        "template", "purity")
