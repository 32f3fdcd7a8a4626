"""URL filtering by a tree of path templates for each host.

A url's path is cut into segments, and segments that are variable by their form
(numbers, hexadecimal, dates, with or without a file ending) become wildcards.
What is left of a corpus is counted by (host, typed path), so the tree is built
from far fewer rows than there are urls.  Level by level, below each node:

* branches that labelled urls do not tell apart are merged: one whose share of
  blocked urls does not differ from that of all its siblings by a two-proportion
  test, or that has no labelled url, goes into the wildcard `*`;
* a segment is variable by its statistics if the node has many different
  children and this one has few of the urls: it needs some more labelled urls to
  be told apart, and is a wildcard otherwise;
* the purity of a node is its share of blocked among labelled urls, smoothed
  towards its parent's, which starts from the host's and that from all hosts'.

A template is rejected if its smoothed purity is above the threshold.  Labels
come from rules on hosts and paths, which also decide the urls they fit.

Everything is built-in functions: joins and aggregates over counted rows.  What
all urls of a node share is passed in one step, so a round ends at the next
branching, not at the next segment, and urls whose path has ended take no further
part.  A last join gives the urls their template.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contraluz.llm.common import ship, stored, without

MANY_CHILDREN = 12  # children from which a node's rare segments are variable
RARE_SHARE = 0.05
FEW = 5  # labelled urls from which a rare segment's own share of blocked counts
Z = 1.96
WEIGHT = 2.0  # labelled urls that the parent's purity counts for
REJECT = 0.75

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rule = tuple[str, str, str]  # verdict, host, path


def behind_scheme(url: Column) -> Column:
    """What follows the first `://`; null where there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    """From behind the first `://` to `/`, `?`, `#` or the end, A-Z lower-cased."""
    found = F.regexp_extract(behind_scheme(url), r"^[^/?#]*+", 0)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From behind the host to `?`, `#` or the end."""
    found = F.regexp_extract(behind_scheme(url), r"^[^/?#]*+([^?#]*+)", 1)
    return F.coalesce(found, F.lit(""))


def fitting(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, at, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1:])):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(start)
        name, verdict = F.when(fits, at + start).otherwise(name), F.when(
            fits, kind).otherwise(verdict)
    return name, verdict


def typed(segment: Column) -> Column:
    """A wildcard for a segment that is variable by its form, else the segment."""
    ending = F.regexp_extract(segment, r"(\.[A-Za-z][A-Za-z0-9]{0,4})$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z][A-Za-z0-9]{0,4}$", "")
    kind = (F.when(stem.rlike(r"^\d+$"), "{number}")
            .when(stem.rlike(r"^\d{4}-\d{2}(-\d{2})?$"), "{date}")
            .when(stem.rlike(r"^[0-9a-fA-F]{8,}$|^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"),
                  "{hex}")
            .when(stem.rlike(r"\d") & (F.length(stem) >= 16), "{id}"))
    return F.when(kind.isNotNull(), F.concat(kind, ending)).otherwise(segment)


def template_tree(counted: DataFrame) -> DataFrame:
    """(host, typed, template, purity) from (host, typed, n, labelled, blocked).

    `typed` is the array of typed segments.
    """
    share = lambda b, n, up: (b + F.lit(WEIGHT) * up) / (n + F.lit(WEIGHT))
    everything = counted.agg(F.sum("labelled"), F.sum("blocked")).first()
    labelled, blocked = (x or 0 for x in everything)
    overall = (blocked + WEIGHT * 0.5) / (labelled + WEIGHT)
    hosts = counted.groupBy("host").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    rows = stored(counted.join(hosts, "host").select(
        "host", "typed", "n", "labelled", "blocked", F.lit("").alias("template"),
        share(F.col("b"), F.col("l"), F.lit(overall)).alias("purity"),
        F.col("typed").alias("rest")))
    ended = []
    while not rows.isEmpty():
        # what all urls of a node go on with is taken in one step, level by level
        nodes = rows.groupBy("host", "template").agg(
            F.sum("n").alias("node_n"), F.sum("labelled").alias("node_l"),
            F.sum("blocked").alias("node_b"), F.min("rest").alias("least"),
            F.max("rest").alias("most"))
        nodes = nodes.select("host", "template", "node_n", "node_l", "node_b",
                             common_length("least", "most").alias("along"), "least")
        common = F.slice("least", 1, F.col("along"))
        moved = rows.join(nodes, ["host", "template"]).withColumns({
            "template": F.concat("template", F.array_join(
                F.transform(common, lambda s: F.concat(F.lit("/"), s)), "")),
            "purity": F.aggregate(F.transform(common, lambda s: F.lit(0.0)), F.col("purity"),
                                  lambda p, _: share(F.col("node_b"), F.col("node_l"), p)),
            "rest": F.slice("rest", F.col("along") + 1, F.size("rest"))}).drop("along", "least")
        moved = stored(moved)
        columns = ["host", "typed", "template", "purity"]
        ended.append(moved.where(F.size("rest") == 0).select(*columns))
        here = moved.where(F.size("rest") > 0).withColumn("segment", F.get("rest", F.lit(0)))
        branches = here.groupBy("host", "template", "segment").agg(
            F.sum("n").alias("n"), F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
        # ended urls of a node are no branch of it
        going = branches.groupBy("host", "template").agg(
            F.count("*").alias("children"), F.sum("n").alias("node_n"),
            F.sum("l").alias("node_l"), F.sum("b").alias("node_b"))
        joined = branches.join(going, ["host", "template"])
        pooled = F.try_divide("node_b", "node_l")
        apart = F.abs(F.try_divide("b", "l") - pooled) > Z * F.sqrt(
            pooled * (1 - pooled) * (F.try_divide(F.lit(1), "l") - F.try_divide(F.lit(1), "node_l")))
        rare = (F.col("children") >= MANY_CHILDREN) & (
            F.col("n") < RARE_SHARE * F.col("node_n"))
        own = F.col("segment").startswith("{") | (F.col("children") == 1) | (
            F.coalesce(apart, F.lit(False)) & (F.col("l") >= F.when(rare, FEW).otherwise(1)))
        named = stored(joined.select(
            "host", "template", "segment", "l", "b",
            F.when(own, F.col("segment")).otherwise("*").alias("name")))
        purities = named.groupBy("host", "template", "name").agg(
            F.sum("l").alias("l"), F.sum("b").alias("b"))
        step = named.select("host", "template", "segment", "name").join(
            purities, ["host", "template", "name"])
        rows = stored(here.join(step, ["host", "template", "segment"]).select(
            "host", "typed", "n", "labelled", "blocked",
            F.concat("template", F.lit("/"), "name").alias("template"),
            share(F.col("b"), F.col("l"), F.col("purity")).alias("purity"),
            F.slice("rest", 2, F.size("rest")).alias("rest")))
    tree = reduce(DataFrame.unionByName, ended) if ended else rows
    return tree.select("host", "typed", "template", "purity")


def common_length(a: str, b: str) -> Column:
    """How many first entries two arrays share.

    The least and the largest of several arrays share what all of them share.
    """
    differ = F.array_position(F.zip_with(
        F.slice(a, 1, F.least(F.size(a), F.size(b))), F.slice(b, 1, F.least(F.size(a), F.size(b))),
        lambda x, y: x == y), False)
    return F.when(differ > 0, differ - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int")


def judge(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Adds host, path, rule, verdict, template and purity to every row.

    `rule` is the longest fitting rule as host and path, else null; `verdict`
    is that rule's, else `block` where the template's smoothed purity is above
    REJECT, else `allow`.  A null url, or one without `://`, has an empty host
    and path and is judged with the others of that kind.  Equal urls get equal
    results.  Columns of the added names are replaced, all others kept.
    """
    names = ["host", "path", "rule", "verdict", "template", "purity"]
    kept = [F.col(f"`{c}`") for c in without(pages, names)]
    link = F.col(f"`{url}`")
    parsed = pages.select(*kept, host_of(link).alias("host"), path_of(link).alias("path"))
    rule, given = fitting(F.col("host"), F.col("path"), rules)
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    marked = parsed.withColumns({
        "rule": rule, "__given": given,
        "__typed": F.transform(segments, typed)})
    counted = stored(marked.groupBy("host", F.col("__typed").alias("typed")).agg(
        F.count("*").alias("n"), F.count("__given").alias("labelled"),
        F.count_if(F.col("__given") == "block").alias("blocked")))
    tree = template_tree(counted).select(
        F.col("host").alias("__host"), F.col("typed").alias("__path"), "template", "purity")
    both = marked.join(tree, (F.col("host") == F.col("__host"))
                       & (F.col("__typed") == F.col("__path")), "left")
    method = F.when(F.col("purity") > REJECT, "block").otherwise("allow")
    return both.select(*kept, "host", "path", "rule", F.coalesce("__given", method).alias("verdict"),
                       "template", "purity")


ship(__name__)
