"""URL filters with DataFrame operations only: fixed rules, and a tree of path templates per host.

Paths are first reduced to shapes (segments that are numbers, hashes or dates
become typed wildcards), and pages are counted per host and shape.  From then
on the tree is grown on those counts, one level of segments at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Levels that are always grown; deeper ones only where that can change a verdict, else they share the tail "**".
DEPTH = 8
# A child keeps its literal segment if it holds this share of its parent's pages, or its parent has few children.
LITERAL_SHARE, FEW_CHILDREN = 0.02, 12
# Two-sided z beyond which a branch's rate of bad labels differs from that of its siblings together.
SIMILAR_Z = 1.96
# Pseudo-labels (at the overall rate of bad labels) that each template starts with, and the purity that rejects it.
PRIOR, PURITY = 4.0, 0.8
# Templates (some 200 bytes each) that may be broadcast to the pages.
BROADCAST_ROWS = 100_000


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/ ? #``, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest of ``rules`` (verdict, host, path) that fits as a struct (rule, verdict); null if none does."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def shape_of(path: Column) -> Column:
    """The path's segments with those that are plainly variable replaced by typed wildcards; extensions stay."""
    def shape(s: Column) -> Column:
        extension = F.regexp_extract(s, r"(\.[A-Za-z][A-Za-z0-9]{0,4})$", 1)
        stem = F.regexp_replace(s, r"\.[A-Za-z][A-Za-z0-9]{0,4}$", "")
        kind = (F.when(stem.rlike(r"^[0-9]+$"), "{num}")
                .when(stem.rlike(r"^[0-9]{2,4}[-_.][0-9]{1,2}[-_.][0-9]{1,4}$"), "{date}")
                .when(stem.rlike(r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"), "{uuid}")
                .when(stem.rlike(r"^(?=.*[0-9])[0-9a-fA-F]{8,}$"), "{hex}"))
        return F.coalesce(F.concat(kind, extension), s)

    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(segments, shape)


NODE, SUMS = ["host", "template"], ("pages", "labelled", "bad")


def grown(rows: DataFrame) -> DataFrame:
    """``rows(host, template, segment, pages, labelled, bad)`` with each template one level longer, where there is a segment.

    Labels come first: a child whose rate of bad labels differs from its
    siblings' keeps its segment however rare it is (for rare children the
    difference is smoothed by ``PRIOR``, so a stray label tells nothing), and
    so does the only child with labels.  Of the others, a node's frequent
    children that are alike become ``{alike}`` and its rare ones ``*``; a rare
    child much more of which is labelled than of its siblings was not labelled
    by chance, so it says nothing about them and joins ``{alike}``.
    """
    child = rows.where("segment is not null").groupBy(*NODE, "segment").agg(*[F.sum(c).alias(c) for c in SUMS])
    parent = child.groupBy(*NODE).agg(F.count(F.lit(1)).alias("children"), *[F.sum(c).alias("all_" + c) for c in SUMS])
    child = child.join(parent, NODE)
    literal = (F.col("children") <= FEW_CHILDREN) | (F.col("pages") >= LITERAL_SHARE * F.col("all_pages"))

    def apart(part: str, of: str) -> tuple[Column, Column]:
        """The gap between the child's share and its siblings', and the error by which it is judged."""
        part_all, of_all = F.col("all_" + part), F.col("all_" + of)
        n, other = F.col(of), of_all - F.col(of)
        share = part_all / of_all
        gap = F.try_divide(F.col(part), n) - F.try_divide(part_all - F.col(part), other)
        return gap, F.sqrt(share * (1 - share) * (F.try_divide(F.lit(1), n) + F.try_divide(F.lit(1), other)))

    labelled = F.col("labelled") > 0
    gap, error = apart("bad", "labelled")
    alike = F.coalesce(labelled & ((gap == 0) | (F.abs(gap) <= SIMILAR_Z * error)), F.lit(False))
    tells = labelled & F.coalesce(F.abs(gap) * F.col("labelled") / (F.col("labelled") + PRIOR) > SIMILAR_Z * error, F.lit(True))
    more, chance = apart("labelled", "pages")
    chosen = labelled & F.coalesce(more * F.col("pages") / (F.col("pages") + PRIOR) > SIMILAR_Z * chance, F.lit(False))
    name = (F.when(literal, F.when(alike, F.lit("{alike}")).otherwise(F.col("segment")))
            .when(tells, F.col("segment")).when(chosen, F.lit("{alike}")).otherwise(F.lit("*")))
    child = child.select(*NODE, "segment", F.concat_ws("/", "template", name).alias("grown"))
    return (rows.join(child, [*NODE, "segment"], "left")
            .withColumn("template", F.coalesce("grown", "template")).drop("grown", "segment"))


def template_tree(counts: DataFrame) -> DataFrame:
    """``(host, shape, template)`` for counts ``(host, shape, pages, labelled, bad)``.

    Level by level, the children of each node are aggregated from the counts
    and named by ``grown``.  Nodes are keyed by host and template so far, so a
    hot host spreads over its nodes.  Each level ends in a checkpoint.  Below
    ``DEPTH`` levels only nodes are grown whose verdict could differ inside:
    some of their labels are bad, but not all their pages.  Such a node's
    segments up to its first fork are taken in one step, so the number of
    steps follows the forks and not the length of the paths.
    """
    rows = settle(counts.withColumn("template", F.lit("")))
    depth = rows.agg(F.max(F.size("shape"))).first()[0] or 0
    for level in range(min(depth, DEPTH)):
        rows = settle(grown(rows.withColumn("segment", F.get("shape", F.lit(level)))))
    if depth <= DEPTH:
        return rows
    rest = F.slice("shape", DEPTH + 1, F.greatest(F.size("shape") - DEPTH, F.lit(0)))
    rows = rows.withColumn("rest", rest)
    columns = [*counts.columns, "template"]
    finished = rows.where(F.size("rest") == 0).select(*columns)
    rows = settle(rows.where(F.size("rest") > 0))
    while rows.take(1):
        node = rows.groupBy(*NODE).agg(*[F.sum(c).alias("all_" + c) for c in SUMS], F.min("rest").alias("low"), F.max("rest").alias("high"))
        mixed = (F.col("all_bad") > 0) & (F.col("all_bad") < F.col("all_pages")) & (F.col("low") != F.col("high"))
        fork = F.array_position(F.zip_with("low", "high", lambda a, b: F.coalesce(a == b, F.lit(False))), False) - 1
        rows = settle(rows.join(node.select(*NODE, F.when(mixed, fork.cast("int")).alias("fork")), NODE))
        finished = finished.unionByName(rows.where("fork is null").withColumn("template", F.concat_ws("/", "template", F.lit("**"))).select(*columns))
        rows = rows.where("fork is not null").withColumn("segment", F.get("rest", F.col("fork")))
        shared = F.concat_ws("/", "template", F.array_join(F.slice("rest", F.lit(1), F.col("fork")), "/"))
        rows = rows.withColumn("template", F.when(F.col("fork") > 0, shared).otherwise(F.col("template"))) \
            .withColumn("rest", F.slice("rest", F.col("fork") + 2, F.greatest(F.size("rest") - F.col("fork") - 1, F.lit(0)))).drop("fork")
        rows = settle(grown(rows))
        finished = finished.unionByName(rows.where(F.size("rest") == 0).select(*columns))
        rows = rows.where(F.size("rest") > 0)
    return finished


def judge_templates(tree: DataFrame, prior: float = PRIOR, purity: float = PURITY) -> DataFrame:
    """``(host, shape, template, purity, rejected)``: each template's share of bad labels, smoothed to the overall share.

    A template is rejected on bad labels of its own only: where most labels are
    bad everywhere, those without one (how deep they lie is then of no
    concern) keep their pages.
    """
    total = tree.agg(F.sum("labelled"), F.sum("bad")).first()
    overall = (total[1] or 0) / total[0] if total[0] else 0.0
    judged = tree.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"))
    share = (F.col("bad") + prior * overall) / (F.col("labelled") + prior)
    judged = judged.select("host", "template", share.alias("purity"), ((F.col("bad") > 0) & (share >= purity)).alias("rejected"))
    return tree.select("host", "shape", "template").join(judged, ["host", "template"])


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], labels: DataFrame | None = None,
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, purity)`` of every row of ``pages``.

    A page is judged by its longest fitting rule, else by its template.
    Templates learn from ``labels(page_id, bad)`` if given (one row per
    page_id; null is no label), else from the pages that a rule decides.  A null url and one without
    ``://`` have an empty host and path; repeated rows count, and come back,
    as often as they are there.  An empty table gives an empty result.
    """
    url = F.col(url_col).cast("string")
    parts = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    parts = parts.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules)).withColumn("shape", shape_of(F.col("path")))
    if labels is None:
        known = parts.withColumn("is_bad", (F.col("fit.verdict") == "block").cast("int"))
    else:
        known = parts.join(labels.select(F.col("page_id"), F.col("bad").cast("int").alias("is_bad")), "page_id", "left")
    counts = known.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("pages"), F.count("is_bad").alias("labelled"),
                                                F.coalesce(F.sum("is_bad"), F.lit(0)).alias("bad"))
    judged = settle(judge_templates(template_tree(counts)))
    judged = F.broadcast(judged) if judged.count() <= BROADCAST_ROWS else judged
    verdict = F.coalesce("fit.verdict", F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow")))
    return parts.join(judged, ["host", "shape"], "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), "template", "purity")
