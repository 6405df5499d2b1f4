"""URL filters: explicit rules first, then a tree of path templates for each host.

Path segments that vary become wildcards, level by level; branches under one node whose labelled pages do
not differ significantly are merged from the leaves up; a merged template is rejected if the smoothed share
of good pages among its labelled pages is too low.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import LOWER, UPPER, landed


MERGE_CHILDREN = 4096  # of a node that one task compares


@dataclass(frozen=True)
class Settings:
    """What makes a segment variable, branches alike and a template bad.

    A child with ``own_pages`` pages or ``own_labels`` labelled ones stays literal, whatever its siblings are. The
    other, thin children of a node become wildcards if there are more than ``most_children`` of them, or at least
    ``few_children`` that on average have fewer than ``pages_each`` pages. Segments from ``depth`` on count as one.
    """

    few_children: int = 8
    pages_each: float = 4.0
    most_children: int = 64
    own_pages: int = 64
    own_labels: int = 8
    depth: int = 8
    alike: float = 1.96
    prior: float = 8.0
    least_purity: float = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for urls without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does. Of equally long ones the longer host wins.

    A rule ``example.org/es/`` fits the host example.org and its subdomains, and paths that start with /es/.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1]), -r[1].find("/"), r[1]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in reversed(ordered):
        own, start = text.split("/", 1)
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{start}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def wildcard(segment: Column) -> Column:
    """The shape of a variable segment: number, hexadecimal, other; a file ending stays."""
    ending = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    kind = F.when(stem.rlike("^[0-9]+$"), "{number}").when(stem.rlike("^[0-9a-fA-F-]{8,}$"), "{hex}").otherwise("{text}")
    return F.when(segment == "", "").otherwise(F.concat(kind, ending))


def generalise(paths: DataFrame, settings: Settings) -> DataFrame:
    """host, path, n, good, bad -> with ``template``, the segments with the variable ones replaced."""
    cut = F.split(F.regexp_replace("path", "^/", ""), "/", settings.depth)
    nodes = landed(paths.withColumns({"rest": F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(cut), "template": F.array().cast("array<string>")}), "url-nodes")
    deepest = nodes.agg(F.max(F.size("rest"))).first()[0] or 0
    for level in range(1, deepest + 1):
        node = nodes.withColumn("child", F.get("rest", F.lit(level - 1)))
        children = node.where("child is not null").groupBy("host", "template", "child").agg(F.sum("n").alias("n"), F.sum(F.col("good") + F.col("bad")).alias("labels"))
        children = landed(children.withColumn("own", (F.col("n") >= settings.own_pages) | (F.col("labels") >= settings.own_labels)), "url-children")
        per_node = children.where("not own").groupBy("host", "template").agg(F.count("*").alias("children"), F.sum("n").alias("n"))
        many = F.col("children") > settings.most_children
        vary = per_node.where(many | (F.col("children") >= settings.few_children) & (F.col("n") < settings.pages_each * F.col("children")))
        vary = landed(vary.select("host", "template", F.lit(True).alias("vary")), "url-variable")
        own = children.where("own").select("host", "template", "child", "own")
        found = node.join(vary, ["host", "template"], "left").join(own, ["host", "template", "child"], "left")
        segment = F.when(F.col("vary") & F.col("own").isNull(), wildcard(F.col("child"))).otherwise(F.col("child"))
        found = found.withColumn("template", F.when(F.col("child").isNull(), F.col("template")).otherwise(F.array_append("template", segment)))
        nodes = landed(found.drop("child", "vary", "own"), "url-nodes")
    return nodes.drop("rest")


def alike_groups(good: np.ndarray, bad: np.ndarray, prior: float, limit: float) -> np.ndarray:
    """Groups of branches: in the order of their purity each joins the group before it unless they differ significantly."""
    total, rate = good + bad, good.sum() / max((good + bad).sum(), 1)
    order = np.lexsort((np.arange(len(good)), (good + prior * rate) / (total + prior)))
    groups, now, g, b = np.zeros(len(good), dtype=int), 0, 0.0, 0.0
    for place, i in enumerate(order):
        n, m = g + b, total[i]
        if place and n and m:
            pooled = (g + good[i]) / (n + m)
            error = np.sqrt(max(pooled * (1 - pooled), 1e-12) * (1 / n + 1 / m))
            if abs(g / n - good[i] / m) > limit * error:
                now, g, b = now + 1, 0.0, 0.0
        groups[i], g, b = now, g + good[i], b + bad[i]
    return groups


def merge_branches(templates: DataFrame, settings: Settings) -> DataFrame:
    """host, template, good, bad -> with ``branch``, the template after alike branches are merged, deepest first.

    A node with more than MERGE_CHILDREN children is looked at in parts, by a hash of the child, so that no task
    has to hold all of a node. A branch of more than ``most_children`` is named by its first child and their number.
    """

    def grouped(frame):
        import pandas as pd

        frame = frame.sort_values("child").reset_index(drop=True)
        groups = alike_groups(frame["good"].to_numpy(float), frame["bad"].to_numpy(float), settings.prior, settings.alike)
        own = frame["child"].groupby(groups)
        names = {g: "|".join(c) if len(c) <= settings.most_children else f"{c.iloc[0]}|+{len(c) - 1}" for g, c in own}
        return pd.DataFrame({"host": frame["host"], "parent": frame["parent"], "child": frame["child"], "merged": [names[g] for g in groups]})

    out = landed(templates.withColumn("branch", F.col("template")), "url-branches")
    deepest = out.agg(F.max(F.size("template"))).first()[0] or 0
    for level in range(deepest, 0, -1):
        node = out.withColumns({"parent": F.concat_ws("/", F.slice("branch", 1, level - 1)) if level > 1 else F.lit(""), "child": F.get("branch", F.lit(level - 1))})
        children = node.where("child is not null").groupBy("host", "parent", "child").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        children = landed(children, "url-siblings")
        parts = children.groupBy("host", "parent").agg(F.ceil(F.count("*") / MERGE_CHILDREN).alias("parts")).where("parts > 1")
        dealt = children.join(parts, ["host", "parent"], "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("child"), F.col("parts")), F.lit(0))).drop("parts")
        merged = landed(dealt.groupBy("host", "parent", "part").applyInPandas(grouped, "host string, parent string, child string, merged string"), "url-merged")
        joined = node.join(merged, ["host", "parent", "child"], "left")
        branch = F.concat(F.slice("branch", 1, level - 1) if level > 1 else F.array().cast("array<string>"), F.array("merged"), F.slice("branch", level + 1, settings.depth + 1))
        out = landed(joined.withColumn("branch", F.when(F.col("merged").isNull(), F.col("branch")).otherwise(branch)).drop("parent", "child", "merged"), "url-branches")
    return out


def judged_branches(branches: DataFrame, settings: Settings) -> DataFrame:
    """host, branch, purity: the share of good labelled pages, smoothed towards the host's, itself smoothed towards all."""
    sums = landed(branches.groupBy("host", "branch").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), "url-sums")
    all_good, all_bad = (sums.agg(F.coalesce(F.sum(c), F.lit(0))).first()[0] for c in ("good", "bad"))
    overall = (all_good + 1) / (all_good + all_bad + 1)
    hosts = sums.groupBy("host").agg(((F.sum("good") + settings.prior * overall) / (F.sum("good") + F.sum("bad") + settings.prior)).alias("usual"))
    purity = (F.col("good") + settings.prior * F.col("usual")) / (F.col("good") + F.col("bad") + settings.prior)
    return sums.join(hosts, "host").select("host", "branch", purity.alias("purity"))


def judge_urls(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str]], settings: Settings = Settings()) -> DataFrame:
    """page_id, host, path, rule, verdict, template and purity for every row of ``pages`` (page_id, url).

    ``labelled`` has page_id and bad (0 or 1). Pages with the same host and path share a template. Without
    labels every purity is 1 and all pages that no rule blocks are allowed. Repeated rows come out repeated.
    """
    host, path = host_and_path(F.col("url"))
    known = labelled.where("bad in (0, 1)").groupBy("page_id").agg(F.max("bad").alias("bad"))
    urls = landed(pages.select("page_id", host.alias("host"), path.alias("path")), "urls")
    counted = urls.join(known, "page_id", "left").groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count_if(F.col("bad") == 0).alias("good"), F.count_if(F.col("bad") == 1).alias("bad"))
    tree = generalise(counted, settings)
    branches = merge_branches(tree.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), settings)
    purity = landed(branches.select("host", "template", "branch").join(judged_branches(branches, settings), ["host", "branch"]), "url-purity")
    by_path = landed(tree.select("host", "path", "template").join(purity, ["host", "template"]).select("host", "path", F.concat_ws("/", "branch").alias("template"), "purity"), "url-paths")
    rule, says = matching_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("purity") < settings.least_purity, "block").otherwise("allow")
    return urls.join(by_path, ["host", "path"]).select("page_id", "host", "path", rule.alias("rule"), F.coalesce(says, method).alias("verdict"), "template", "purity")
