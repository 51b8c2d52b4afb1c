"""URL filter by a path-template tree per host (DataFrame functions only).

Paths of a host form a tree of segments. Level by level

1. segments that look variable (numbers, long hex, numbers in a name) become typed wildcards;
2. a branching point whose children are many and rarely repeat becomes ``*``;
3. sibling branches with enough labels are merged where they are statistically alike: each
   one's share of bad labels is tested against that of all siblings together (z test), and
   those clearly above, clearly below and not different form one branch each, ``{bad}``,
   ``{good}`` and ``{}``; branches with few labels stay apart.

A template is rejected if its labelled purity ``(good + m * p) / (labelled + m)``, smoothed by
``m`` pseudo-observations at the overall share ``p`` of good labels, is below ``min_purity``.
Templates without any label are allowed: there is no evidence against them.

An explicit rule list comes first: a rule fits its host and all subdomains where the path
starts with the rule's, the longest fitting rule decides, and what it decides is the label.

Distinct (host, path) pairs are counted before any join; every step is an aggregate or an
equi-join (AQE splits skewed ones), so a host with a third of all pages is no single task.

Defined cases: a null url or one without ``://`` has empty host and path, no rule and is
allowed; ids play no role, null and repeated ones give one row each; ties between rules of one
length go to the first listed; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradmesh.llm.common import written

MAX_DEPTH = 4  # levels of the tree; what lies deeper is one "**"
MIN_CHILDREN = 8  # a branching point with as many children that rarely repeat is variable
MAX_REPEAT = 2.0  # mean pages per child up to which children "rarely repeat"
MIN_LABELLED = 5  # labels a branch needs to be merged with siblings
Z = 1.96
PSEUDO = 4.0
MIN_PURITY = 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class UrlRule(NamedTuple):
    action: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules: Sequence[UrlRule]) -> tuple[Column, Column]:
    """Text and action of the longest fitting rule; null if none fits."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):  # the last one asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, action = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.action)).otherwise(action)
    return text, action


def masked(segment: Column) -> Column:
    """Typed wildcards for segments that vary by their form."""
    return (
        F.when(segment.rlike(r"^[0-9]+$"), "<n>")
        .when(segment.rlike(r"^[0-9a-f-]{16,}$"), "<hex>")
        .otherwise(F.regexp_replace(segment, r"[0-9]+", "<n>"))
    )


def _level(paths: DataFrame, depth: int) -> DataFrame:
    """Fixes the branch of each path at one level: the segment, ``*`` or a merged branch."""
    seg = F.get(F.col("segments"), F.lit(depth))
    paths = paths.withColumn("branch", F.when(seg.isNull(), "").otherwise(masked(seg)))
    key = ["host", "template"]
    branches = paths.groupBy(*key, "branch").agg(*(F.sum(c).alias(c) for c in ("n", "good", "bad")))
    points = branches.groupBy(*key).agg(
        F.count("*").alias("children"), F.sum("n").alias("total"), F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad")
    )
    near = branches.join(points, key)
    labelled = F.col("good") + F.col("bad")
    share = F.try_divide(F.col("all_bad"), F.col("all_good") + F.col("all_bad"))
    # where all labels of the siblings agree the spread is 0 and nothing differs
    z = F.coalesce(F.try_divide(F.try_divide("bad", labelled) - share, F.sqrt(F.try_divide(share * (1 - share), labelled))), F.lit(0.0))
    merged = F.when(z > Z, "{bad}").when(z < -Z, "{good}").otherwise("{}")
    variable = (F.col("children") >= MIN_CHILDREN) & (F.col("total") <= MAX_REPEAT * F.col("children"))
    fixed = F.when(F.col("branch") == "", "").when(variable, "*").when(labelled >= MIN_LABELLED, merged).otherwise(F.col("branch"))
    joined = paths.join(near.select(*key, "branch", fixed.alias("fixed")), [*key, "branch"])
    return joined.withColumn("template", F.when(F.col("fixed") == "", F.col("template")).otherwise(F.concat("template", F.lit("/"), "fixed"))).drop("branch", "fixed")


def template_verdicts(urls: DataFrame, max_depth: int = MAX_DEPTH, min_purity: float = MIN_PURITY) -> DataFrame:
    """``host, path, template, purity, rejected`` of each distinct pair of
    ``urls(host, path, label)``; label 1 is good, 0 bad, null unknown.

    The table of distinct paths is written after each level, so that a level's plan reads
    it twice instead of repeating all levels before it.
    """
    paths = urls.groupBy("host", "path").agg(F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad"))
    paths = written(paths.withColumn("segments", F.array_remove(F.split("path", "/"), "")).withColumn("template", F.lit("")), "url-paths")
    seen = paths.agg(F.max(F.size("segments")), F.try_divide(F.sum("good"), F.sum(F.col("good") + F.col("bad")))).first()
    prior = 1.0 if seen[1] is None else seen[1]
    for depth in range(min(max_depth, seen[0] or 0)):
        paths = written(_level(paths, depth), f"url-level-{depth}")
    paths = paths.withColumn("template", F.when(F.size("segments") > max_depth, F.concat("template", F.lit("/**"))).otherwise(F.col("template")))
    labelled = F.col("good") + F.col("bad")
    purity = F.when(labelled > 0, (F.col("good") + PSEUDO * prior) / (labelled + PSEUDO))
    templates = paths.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    judged = templates.select("host", "template", purity.alias("purity"), F.coalesce(purity < min_purity, F.lit(False)).alias("rejected"))
    return paths.select("host", "path", "template").join(judged, ["host", "template"])


def url_filter(pages: DataFrame, rules: Sequence[UrlRule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, template, purity, verdict`` of every page."""
    host, path = parts(pages[url_col])
    split = pages.select(pages[id_col].alias("page_id"), host.alias("host"), path.alias("path"))
    text, action = rule_columns(F.col("host"), F.col("path"), rules)
    ruled = split.withColumns({"rule": text, "action": action})
    urls = ruled.select("host", "path", F.when(F.col("action") == "allow", 1).when(F.col("action") == "block", 0).alias("label"))
    found = ruled.join(template_verdicts(urls), ["host", "path"])
    verdict = F.coalesce("action", F.when(F.col("rejected"), "block").otherwise("allow"))
    return found.select("page_id", "host", "path", "rule", "template", "purity", verdict.alias("verdict"))
