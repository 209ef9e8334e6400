"""URL verdicts from a tree of path templates per host.

The segments of every path form a tree below its host. Going down level by level, segments are
generalised in three steps: numbers, hexadecimal names and dates become their kind; children that are
each seen seldom become ``*``; siblings that are alike, in what follows them and in how often their
labelled urls are bad (within two standard errors of all labelled siblings), are merged into one
branch. What remains of a path is its template.

Whether a child is seen seldom is its own affair, not that of its parent: a child with many urls stays
a branch. Of the seldom ones, those without labels become ``*`` together. Those with labels join them only
where labels are the rule among the seldom children, by more than chance (two standard errors above
one half of them); else a few labelled children would speak for many that nobody has judged.

A template's purity is the share of bad ones among its labelled urls, smoothed towards ``prior``
with the weight of ``strength`` urls; templates above ``reject`` are blocked. Templates without a
labelled url have the purity ``prior`` and are allowed.

Explicit rules (host with all subdomains, beginning of the path; the longest wins) come first and
are the labels in ``judge``. All of it is grouping and joining; urls are first counted by host and
generalised path, so a host with a third of all urls is many small rows. All levels of a path count;
what comes after ``MOST_LEVELS`` of them is taken as one last level, by its whole text.

Defined results: a null url, or one without ``://``, has an empty host and path, and the template
of the empty host. Repeated rows get the same verdict; extra columns are passed over.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stored
from .joins import join_hot

MOST_LEVELS = 32
SELDOM = 5


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """The host after the first ``://``, A-Z lower-cased; empty where there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to a query or fragment."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def kind_of(segment: Column) -> Column:
    """A segment with its variable parts named by kind; endings stay."""
    stem = F.regexp_extract(segment, r"(?s)^(.*?)(\.[A-Za-z]{1,5})?$", 1)
    ending = F.regexp_extract(segment, r"(?s)^(.*?)(\.[A-Za-z]{1,5})?$", 2)
    kind = (
        F.when(stem.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.lit("{date}"))
        .when(stem.rlike(r"^[0-9]+$"), F.lit("{n}"))
        .when(stem.rlike(r"^(?=.*[0-9])[0-9A-Fa-f-]{8,}$"), F.lit("{hex}"))
        .otherwise(stem))
    return F.concat(kind, ending)


def _segments(path: Column) -> Column:
    """The generalised segments, one for each level."""
    parts = F.array_remove(F.split(path, "/"), "")
    first = F.transform(F.slice(parts, 1, MOST_LEVELS), kind_of)
    rest = F.array_join(F.slice(parts, MOST_LEVELS + 1, 2147483647), "/")
    return F.when(F.size(parts) > MOST_LEVELS, F.concat(first, F.array(rest))).otherwise(first)


def _level(leaves: DataFrame, depth: int) -> DataFrame:
    """``leaves``, all with a segment number ``depth``, with it moved into the template."""
    here = F.get("segments", F.lit(depth))
    after = F.coalesce(F.get("segments", F.lit(depth + 1)), F.lit(""))
    # What may follow, by kind only: nothing, a variable part, or a name.
    shape = F.when(after == "", F.lit(".")).when(after.startswith("{"), F.lit("{}")).otherwise("a")
    kids = leaves.groupBy("template", here.alias("segment")).agg(
        F.sum("size").alias("size"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"),
        F.sort_array(F.collect_set(shape)).alias("shape"))
    few = F.col("size") < SELDOM
    parents = kids.groupBy("template").agg(
        F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad"),
        F.count_if(few).alias("seldom"), F.count_if(few & (F.col("labelled") > 0)).alias("judged"))
    rate = F.col("all_bad") / F.col("all_labelled")
    off = F.when(F.col("labelled") > 0, F.col("bad") - F.col("labelled") * rate)
    wide = 2 * F.sqrt(F.col("labelled") * rate * (1 - rate))
    side = (
        F.when(off.isNull(), F.lit("unknown")).when(off > wide, F.lit("worse"))
        .when(off < -wide, F.lit("better")).otherwise("usual"))
    ruled = 2 * F.col("judged") - F.col("seldom") > 2 * F.sqrt("seldom")
    fold = (
        F.when(few & side.isin("unknown", "usual") & ruled, F.lit("*"))
        .when(few & (side == "unknown"), F.lit("*")).when(few & ruled, F.concat(F.lit("*"), side)))
    judged = kids.join(parents, "template").select(
        "template", "segment", fold.alias("fold"), F.to_json(
            F.struct(side.alias("side"), "shape")).alias("like"))
    groups = judged.filter("fold is null").groupBy("template", "like").agg(
        F.min("segment").alias("least"), F.count("*").alias("members"))
    named = judged.join(groups, ["template", "like"], "left").select(
        "template", "segment",
        F.coalesce("fold", F.when(
            F.col("members") > 1, F.concat("least", F.lit("|.."))).otherwise(F.col("segment")))
        .alias("name"))
    moved = leaves.withColumn("segment", here).join(named, ["template", "segment"])
    return moved.withColumn("template", F.concat_ws("/", "template", "name")).drop("segment", "name")


def _generalised(leaves: DataFrame) -> DataFrame:
    """``leaves`` with their templates. A level only takes the leaves that reach down to it."""
    done, depth = None, 0
    while True:
        ended = leaves.filter(F.size("segments") <= depth)
        done = ended if done is None else done.union(ended)
        deeper = leaves.filter(F.size("segments") > depth)
        if deeper.isEmpty():
            return done
        # A level reads the one before it more than once, so each is written.
        leaves = stored(_level(deeper, depth).select(*leaves.columns), "level")
        depth += 1


def purities(
    urls: DataFrame, strength: float = 2.0, prior: float = 0.2, reject: float = 0.5
) -> DataFrame:
    """Per leaf (host and generalised path) its template, purity and whether it is rejected.

    ``urls`` has (leaf, host, segments, bad), ``bad`` null where there is no label.
    """
    leaves = urls.groupBy("leaf").agg(
        F.first("host").alias("template"), F.first("segments").alias("segments"),
        F.count("*").alias("size"), F.count("bad").alias("labelled"),
        F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad"))
    leaves = _generalised(stored(leaves, "leaves"))
    known = leaves.groupBy("template").agg(
        F.sum("labelled").alias("known"), F.sum("bad").alias("known_bad"))
    purity = (F.col("known_bad") + strength * prior) / (F.col("known") + strength)
    return stored(leaves.join(known, "template").select(
        "leaf", "size", "template", purity.alias("purity"), (purity > reject).alias("rejected")),
        "purities")


def judge(
    pages: DataFrame, rules: Sequence[Rule], id_column: str = "page_id", url: str = "url",
    **settings,
) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``purity``."""
    parsed = pages.select(
        F.col(id_column).alias("id"), host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"))
    name, verdict = rule_of(rules, F.col("host"), F.col("path"))
    keyed = stored(parsed.select(
        "*", name.alias("rule"), verdict.alias("ruled"), _segments(F.col("path")).alias("segments"),
    ).withColumn("leaf", F.concat_ws("/", "host", "segments")), "urls")
    templates = purities(
        keyed.select("leaf", "host", "segments", (F.col("ruled") == "block").alias("bad")), **settings)
    joined = join_hot(keyed.drop("segments"), templates, "leaf", "size")
    return joined.select(
        F.col("id").alias(id_column), "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"),
        "template", "purity")
