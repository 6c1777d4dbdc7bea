"""URL filter: host rules, then a path-template tree with labelled purity.

Pages are reduced to distinct (host, path shape) rows first: numbers, hex runs
and mixed segments become wildcards, so every later step works on far fewer rows
and a hot host is combined before any shuffle. The tree is then built from the
root down. Where paths part, a branch whose share of bad labels is larger than its
siblings' by more than ``Z`` standard errors stays by itself; the others are compared
among each other, and those that can't be told apart are merged into one
wildcard branch. Shares are only compared where both sides have ``LEAST`` labels.

A template's badness is the share of bad labels below it, smoothed as if ``WEIGHT``
more labelled pages had been seen with the share found outside of it: in the rest of its
parent, itself smoothed by what lies outside the parent, and so on up to all other hosts and
``BASE``. So every label counts once, and a template's badness does not depend on how
many segments its path has. Templates at ``REJECT`` or above are blocked.

Segments that all shapes under a node share are walked at once (the least and the greatest
of the lists share what all share), so rounds are as many as the places where one path
parts from others, however long the paths are.

Only DataFrame functions. No window or list per host: branch and sibling figures
are sums joined back, and every level is written to the shared folder.

Defined results: a null url, or one without ``://``, has empty host and path and
follows the template of the empty host; repeated rows get a verdict each; null ids are
kept; labels with null id or value don't count, and a page labelled twice counts
twice; without labels the method allows everything; a segment ``*`` of a url is written
``{*}`` in a template.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import discard, written

Z = 1.96
#: Labels that both sides of a comparison need: below, the standard error means little.
LEAST = 5
WEIGHT = 5.0
#: Share of bad pages assumed before any label is seen.
BASE = 0.25
REJECT = 0.5
#: (action, host, path prefix); hosts include their subdomains, the longest rule wins.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def shape(path: Column) -> Column:
    """The path's segments with variable parts generalised."""
    kind = lambda s: (
        F.when(s.rlike(r"^\d+$"), F.lit("{n}"))
        .when(s.rlike(r"^\d+\.\w+$"), F.concat(F.lit("{n}."), F.regexp_extract(s, r"\.(\w+)$", 1)))
        .when(s.rlike(r"^[0-9a-fA-F-]{16,}$"), F.lit("{hex}"))
        .when(s.rlike(r"\d"), F.regexp_replace(s, r"\d+", "{n}"))
        .when(s == "*", F.lit("{*}"))
        .otherwise(s))
    segments = F.transform(F.filter(F.split(path, "/", -1), lambda s: s != ""), kind)
    slash = F.when(path.endswith("/"), F.array(F.lit("/"))).otherwise(
        F.array().cast("array<string>"))
    return F.array_join(F.concat(segments, slash), "\n")


def _smooth(bad: Column, labelled: Column, prior: Column) -> Column:
    return (bad + WEIGHT * prior) / (labelled + WEIGHT)


def _extended(template: Column, segments: Column) -> Column:
    """``template`` with further segments; '/' is the slash at a path's end."""
    return F.aggregate(segments, template, lambda t, x: F.when(
        x == "/", F.concat(t, x)).otherwise(F.concat(t, F.lit("/"), x)))


def _siblings(branches: DataFrame) -> DataFrame:
    """Labels of all branches of a node together."""
    return branches.groupBy("host", "template").agg(
        F.sum("_l").alias("all_l"), F.sum("_b").alias("all_b"))


def _differs(all_l: Column, all_b: Column) -> tuple[Column, Column]:
    """(whether a branch's bad share differs from its siblings', whether it is larger):
    two shares against ``Z`` standard errors of the pooled one."""
    one = F.lit(1)
    rest_l, rest_b = all_l - F.col("_l"), all_b - F.col("_b")
    share = all_b / F.greatest(all_l, one)
    error = F.sqrt(share * (1 - share) * (1 / F.greatest(F.col("_l"), one)
                                          + 1 / F.greatest(rest_l, one)))
    gap = F.col("_b") / F.greatest(F.col("_l"), one) - rest_b / F.greatest(rest_l, one)
    enough = (F.col("_l") >= LEAST) & (rest_l >= LEAST)
    return enough & (F.abs(gap) > Z * error), gap > 0


def _walked(level: DataFrame) -> DataFrame:
    """Rows of nodes (host, template) taken to where their shapes part.

    Adds the node's labels ``tl`` and ``tb`` and ``alone``: all its shapes end alike."""
    alike = F.array_position(F.zip_with("lo", "hi", lambda a, b: a.eqNullSafe(b)), F.lit(False))
    nodes = level.groupBy("host", "template").agg(
        F.sum("labelled").alias("tl"), F.sum("bad").alias("tb"),
        F.min("rest").alias("lo"), F.max("rest").alias("hi"))
    nodes = nodes.select("host", "template", "tl", "tb", (F.col("lo") == F.col("hi")).alias("alone"),
                         F.when(alike == 0, F.size("lo")).otherwise(alike - 1).cast("int").alias("n"))
    return level.join(nodes, ["host", "template"]).select(
        "host", "shape", "labelled", "bad", "prior", "tl", "tb", "alone",
        _extended(F.col("template"), F.slice("rest", F.lit(1), F.col("n"))).alias("template"),
        F.slice("rest", F.col("n") + 1, F.greatest(F.size("rest"), F.lit(1))).alias("rest"))


def _parted(level: DataFrame) -> DataFrame:
    """Rows of nodes whose shapes part, as rows of their branches, merged or not."""
    level = level.withColumn("segment", F.coalesce(F.get("rest", F.lit(0)), F.lit("")))
    branch = level.groupBy("host", "template", "segment").agg(
        F.sum("labelled").alias("_l"), F.sum("bad").alias("_b"),
        F.first("tl").alias("tl"), F.first("tb").alias("tb"), F.first("prior").alias("prior"))
    differs, worse = _differs(F.col("tl"), F.col("tb"))
    # Worse branches stand out first, so that they don't make their siblings look
    # better than each other; the rest is compared among itself.
    judged = branch.withColumn("worse", differs & worse)
    judged = judged.join(_siblings(judged.filter("NOT worse")), ["host", "template"], "left")
    apart, _ = _differs(F.col("all_l"), F.col("all_b"))
    # A path's end ('') and its trailing slash stay apart from deeper branches.
    keeps = F.col("segment").isin("", "/") | F.col("worse") | F.coalesce(apart, F.lit(False))
    judged = judged.withColumn("merged", F.when(keeps, F.col("segment")).otherwise(F.lit("*")))
    # What lies outside a branch: the rest of its node, smoothed by what lies outside that.
    merged = judged.groupBy("host", "template", "merged").agg(
        F.sum("_l").alias("_l"), F.sum("_b").alias("_b"), F.first("tl").alias("tl"),
        F.first("tb").alias("tb"), F.first("prior").alias("prior"))
    outside = merged.select("host", "template", "merged", _smooth(
        F.col("tb") - F.col("_b"), F.col("tl") - F.col("_l"), F.col("prior")).alias("outside"))
    choice = judged.select("host", "template", "segment", "merged").join(
        outside, ["host", "template", "merged"])
    step = F.when(F.col("merged") == "", F.array().cast("array<string>")).otherwise(F.array("merged"))
    return level.join(choice, ["host", "template", "segment"]).select(
        "host", "shape", "labelled", "bad", F.col("outside").alias("prior"),
        _extended(F.col("template"), step).alias("template"),
        F.slice("rest", F.lit(2), F.greatest(F.size("rest"), F.lit(1))).alias("rest"))


def template_tree(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host, shape -> template and its smoothed badness.

    ``pages``: page_id, host, shape. ``labels``: page_id, bad (0 or 1).
    """
    clean = labels.filter("page_id IS NOT NULL AND bad IS NOT NULL")
    marks = clean.groupBy("page_id").agg(F.count(F.lit(1)).alias("labelled"),
                                         F.sum(F.col("bad").cast("long")).alias("bad"))
    nodes = written(
        pages.join(marks, "page_id", "left").groupBy("host", "shape")
        .agg(F.coalesce(F.sum("labelled"), F.lit(0)).alias("labelled"),
             F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "url-shapes")
    every = nodes.agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b")).first()  # one row
    hosts = nodes.groupBy("host").agg(F.sum("labelled").alias("_l"), F.sum("bad").alias("_b"))
    hosts = hosts.select("host", _smooth(F.lit(every["b"] or 0) - F.col("_b"),
                                         F.lit(every["l"] or 0) - F.col("_l"),
                                         F.lit(BASE)).alias("prior"))
    # An empty shape splits into one empty segment, which is none.
    rest = F.filter(F.split("shape", "\n", -1), lambda x: x != "")
    level = nodes.join(hosts, "host").withColumns({"rest": rest, "template": F.lit("")})
    done = []
    for k in count():
        step = written(_walked(level), f"url-level{k}")
        done.append(step.filter("alone").select(
            "host", "shape", "template",
            _smooth(F.col("tb"), F.col("tl"), F.col("prior")).alias("badness")))
        if k == 0:
            discard(nodes)
        parting = step.filter("NOT alone")
        if parting.isEmpty():
            return reduce(DataFrame.unionByName, done)
        level = _parted(parting)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as ``host/path``, its action) of the longest rule that fits; nulls if none."""
    name = action = None
    for act, rhost, rpath in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == rhost) | host.endswith("." + rhost)) & path.startswith(rpath)
        name = F.when(fits, rhost + rpath) if name is None else name.when(fits, rhost + rpath)
        action = F.when(fits, act) if action is None else action.when(fits, act)
    if name is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return name, action


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, template, badness for every page."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    base = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"),
                        path_of(url).alias("path"))
    base = base.withColumn("shape", shape(F.col("path")))
    tree = template_tree(base.select("page_id", "host", "shape"), labels)
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("badness") >= REJECT, "block").otherwise("allow")
    return base.join(tree, ["host", "shape"], "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(action, own).alias("verdict"), "template", "badness")
