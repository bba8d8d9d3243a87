"""Allow or block URLs by rules, and by templates learned from what rules judge.

Each host has a tree of path segments. Segments that vary become wildcards,
branches that are blocked about equally often are merged, and what is left are
the host's templates. A URL that no rule fits is blocked if its template is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmetrics.llm.common import lower_ascii
from trailmetrics.runtime import Scratch

ALLOW, BLOCK = "allow", "block"
_KEY = ["host", "path"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both parts of a URL; empty if it is null or has no `://`."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return lower_ascii(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def apply_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """`urls` (host, path, n) with the longest rule that fits and its verdict.

    `rules` has rule_host, rule_path and verdict. A rule fits its host, all
    subdomains, and the paths that start with its own; of rules equally long the
    first by name wins. Each host is looked up with all its endings, so a long
    list of rules is joined like any table.
    """
    labels = F.split("host", r"\.", -1)
    endings = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda first: F.array_join(F.slice(labels, first, F.size(labels)), "."),
    )
    rule = F.concat("rule_host", "rule_path")
    best = (
        urls.select(*_KEY, F.explode(endings).alias("rule_host"))
        .join(rules, "rule_host")
        .where(F.col("path").startswith(F.col("rule_path")))
        .groupBy(*_KEY)
        .agg(
            F.min(F.struct((-F.length(rule)).alias("longest"), rule.alias("rule"), "verdict")).alias(
                "best"
            )
        )
        .select(*_KEY, "best.rule", F.col("best.verdict").alias("ruled"))
    )
    return urls.join(best, _KEY, "left")


def _agreeing(first: Column, last: Column) -> Column:
    """How many leading segments two lists have in common."""
    same = F.zip_with(first, last, lambda a, b: a.eqNullSafe(b))
    differs = F.array_position(same, False)
    return F.when(differs == 0, F.size(first)).otherwise(differs.cast("int") - 1)


def _templates(urls: DataFrame, scratch: Scratch, fanout: int) -> DataFrame:
    """`urls` with `pieces`, the segments of the path with the variable ones as wildcards.

    Segments that differ only in their digits are of one shape, and variable if
    there are two or more of them under the same parent. All segments of a parent
    are variable if they have at least `fanout` shapes.

    Each round takes the segments that all URLs of a parent have in common as they
    are (the least and the greatest rest tell how many), and then those at which
    they part. So there are as many rounds as a path has places where URLs part,
    however long it is, and each starts from a table that the one before wrote.
    """
    segments = F.slice(F.split("path", "/", -1), 2, 1 << 30)
    nothing = F.array().cast("array<string>")
    left = scratch.write(urls.withColumns({"rest": segments, "pieces": nothing}), "level_0")
    parent, done, number = ["host", "pieces"], [], 0
    while True:
        done.append(left.where(F.size("rest") == 0).drop("rest"))
        active = left.where(F.size("rest") > 0)
        if active.isEmpty():
            return reduce(DataFrame.unionAll, done)
        together = active.groupBy(*parent).agg(
            _agreeing(F.min("rest"), F.max("rest")).alias("agreeing")
        )
        shape = F.regexp_replace("segment", "[0-9]+", "*")
        parting = (
            active.join(together, parent)
            .withColumn("segment", F.get("rest", F.col("agreeing")))
            .withColumn("shape", shape)
        )
        shapes = (
            parting.where("segment IS NOT NULL")
            .groupBy(*parent, "shape")
            .agg(F.count_distinct("segment").alias("alike"))
        )
        parents = shapes.groupBy(*parent).agg(F.count("*").alias("children"))
        piece = (
            F.when(F.col("segment").isNull(), nothing)
            .when(F.col("children") >= fanout, F.array(F.lit("*")))
            .when(
                F.contains("shape", F.lit("*")) & (F.col("alike") > 1), F.array(F.col("shape"))
            )
            .otherwise(F.array("segment"))
        )
        begun = F.slice("rest", F.lit(1), F.col("agreeing"))
        number += 1
        left = scratch.write(
            parting.join(shapes, [*parent, "shape"], "left")
            .join(parents, parent, "left")
            .select(
                *urls.columns,
                F.slice("rest", F.col("agreeing") + 2, F.size("rest")).alias("rest"),
                F.concat("pieces", begun, piece).alias("pieces"),
            ),
            f"level_{number}",
        )


def _merged(templates: DataFrame, scratch: Scratch, deviation: float) -> DataFrame:
    """`templates` (host, pieces, n, blocked) with `merged`, the pieces after merging.

    From the deepest segment up, siblings whose count of blocked URLs lies within
    `deviation` standard deviations of what their common rate gives are merged;
    siblings without labelled URLs join them. Only segments are looked at in which
    templates of one host differ; the driver gets the list of these depths.
    """
    templates = scratch.write(templates.withColumn("merged", F.col("pieces")), "templates")
    levels = (
        templates.select("host", F.size("pieces").alias("size"), F.posexplode("pieces"))
        .groupBy("host", "size", "pos")
        .agg((F.min("col") != F.max("col")).alias("differs"))
        .where("differs")
        .select("pos")
        .distinct()
    )
    for at in sorted((row["pos"] for row in levels.collect()), reverse=True):
        siblings = F.transform(
            "merged", lambda piece, i: F.when(i == at, F.lit("*")).otherwise(piece)
        )
        branches = (
            templates.groupBy("host", "merged")
            .agg(F.sum("n").alias("branch_n"), F.sum("blocked").alias("branch_blocked"))
            .where(F.size("merged") > at)
            .withColumn("together", siblings)
        )
        groups = branches.groupBy("host", "together").agg(
            F.try_divide(F.sum("branch_blocked"), F.sum("branch_n")).alias("rate"),
            F.count("*").alias("members"),
        )
        rate, n = F.coalesce("rate", F.lit(0.0)), F.col("branch_n")
        room = deviation * F.sqrt(n * rate * (1 - rate)) + 1e-9
        alike = F.abs(F.col("branch_blocked") - n * rate) <= room
        moved = (
            branches.join(groups, ["host", "together"])
            .where(alike & (F.col("members") > 1))
            .select("host", "merged", "together")
        )
        templates = scratch.write(
            templates.join(moved, ["host", "merged"], "left")
            .withColumn("merged", F.coalesce("together", "merged"))
            .drop("together"),
            f"templates_{at}",
        )
    return templates


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    scratch: Scratch,
    fanout: int = 30,
    deviation: float = 2.0,
    strength: float = 5.0,
    reject_at: float = 0.8,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of each row of `pages`.

    `rule` and its verdict come from `apply_rules`. For the other URLs, the
    verdict is `block` if the purity of the template reaches `reject_at`. Purity
    is the share of blocked URLs among the template's labelled ones, smoothed
    with `strength` URLs at the host's share, which is smoothed in the same way
    at the share of all. URLs are labelled by the rules that fit them.

    Everything is counted over distinct (host, path), so a URL that many pages
    repeat is one row with a count. A null URL, or one without `://`, has an empty
    host and path and is judged like any other. A path of any length is taken
    whole. Of rules equally long the first by name wins. Repeated rows each get
    their verdict; other columns are ignored; an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = parsed.groupBy(*_KEY).agg(F.count("*").alias("all"))
    ruled = apply_rules(scratch.write(urls, "urls"), rules)
    labelled = scratch.write(
        _templates(ruled, scratch, fanout)
        .withColumn("n", F.when(F.col("ruled").isNotNull(), F.col("all")).otherwise(0))
        .withColumn("blocked", F.when(F.col("ruled") == BLOCK, F.col("all")).otherwise(0)),
        "labelled_urls",
    )
    templates = labelled.groupBy("host", "pieces").agg(
        F.sum("n").alias("n"), F.sum("blocked").alias("blocked")
    )
    merged = _merged(templates, scratch, deviation)
    sums = [F.sum("n").alias("n"), F.sum("blocked").alias("blocked")]
    everywhere = merged.agg(
        ((F.coalesce(F.sum("blocked"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias(
            "all_share"
        )
    )
    hosts = (
        merged.groupBy("host")
        .agg(*sums)
        .join(F.broadcast(everywhere))
        .select(
            "host",
            ((F.col("blocked") + strength * F.col("all_share")) / (F.col("n") + strength)).alias(
                "host_share"
            ),
        )
    )
    purity = (
        merged.groupBy("host", "merged")
        .agg(*sums)
        .join(hosts, "host")
        .select(
            "host",
            "merged",
            ((F.col("blocked") + strength * F.col("host_share")) / (F.col("n") + strength)).alias(
                "purity"
            ),
        )
    )
    judged = scratch.write(
        labelled.join(merged.select("host", "pieces", "merged"), ["host", "pieces"])
        .join(purity, ["host", "merged"])
        .withColumn(
            "verdict",
            F.coalesce(
                "ruled", F.when(F.col("purity") >= reject_at, BLOCK).otherwise(ALLOW)
            ),
        )
        .withColumn("template", F.concat(F.lit("/"), F.array_join("merged", "/")))
        .select(*_KEY, "rule", "verdict", "template", "purity"),
        "judged_urls",
    )
    return parsed.join(judged, _KEY)
