"""Benchmark decontamination by size-partitioned MinHash containment.

A test item is short and a document long, so their Jaccard similarity is near
zero even where the item stands in the document word for word.  What matters is
containment: the share of the item's five-word shingles that the document has.
MinHash estimates it from the item's side.  Each of k hash functions picks the
item's least shingle, a uniform draw, and the share of picked shingles that a
document holds estimates its containment.  Items are partitioned by size: a
partition has its own k, and the number of hits below which an item of the
sought containment is found in no more than one case of a million is left out.
Candidates are then verified by the exact containment of their shingle texts.

Everything is built-in functions.  Documents are scanned once to look up their
shingle hashes in the sketch; only hits leave the scan.  The sketch is broadcast
while its counted size is below a bound, beyond it the join shuffles.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contraluz.llm.common import few, ship, stored

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-6
FUNCTIONS = {0: 16, 16: 32, 64: 64}  # hash functions from a number of shingles on


def words(text: str | Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_texts(listed: str) -> Column:
    """Distinct shingles of a word array; up to four words are one shingle."""
    w = F.col(listed)
    return F.when(F.size(w) >= SHINGLE, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1)),
        lambda i: F.array_join(F.slice(w, i, SHINGLE), " ")))
    ).when(F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(F.array().cast("array<string>"))


def shingle_hashes(listed: str) -> Column:
    """A hash for each shingle of a word array, in the order of the text."""
    w = F.col(listed)
    full = F.transform(
        F.sequence(F.lit(0), F.size(w) - SHINGLE),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
    short = F.array(F.xxhash64(*[F.get(w, F.lit(k)) for k in range(SHINGLE)]))
    return F.when(F.size(w) >= SHINGLE, full).when(F.size(w) > 0, short)


def least_hits(functions: int, containment: float, miss: float = MISS) -> int:
    """The most hits that all but `miss` of items of that containment reach."""
    below, hits = 0.0, 0
    while hits < functions:
        below += (math.comb(functions, hits) * containment ** hits
                  * (1 - containment) ** (functions - hits))
        if below > miss:
            break
        hits += 1
    return max(1, hits)


def sketch(items: DataFrame, containment: float) -> DataFrame:
    """(item_id, hash, picks, least): the shingles that an item's functions pick."""
    sizes = items.select("item_id", F.size("hashes").alias("n"), "hashes")
    functions, least = F.lit(None), F.lit(None)
    for start, k in sorted(FUNCTIONS.items(), reverse=True):
        functions = F.coalesce(functions, F.when(F.col("n") >= start, k))
        least = F.coalesce(least, F.when(F.col("n") >= start, least_hits(k, containment)))
    drawn = sizes.select("item_id", least.alias("least"), F.explode("hashes").alias("hash"),
                         functions.alias("k")).select(
        "item_id", "least", "hash", F.explode(F.sequence(F.lit(1), "k")).alias("f"))
    picked = drawn.groupBy("item_id", "least", "f").agg(
        F.min_by("hash", F.xxhash64("hash", "f")).alias("hash"))
    return picked.groupBy("item_id", "least", "hash").agg(F.count("*").alias("picks"))


def matches(rows: DataFrame, items: DataFrame, key: str, item_id: str = "item_id",
            item_text: str = "text", containment: float = CONTAINMENT,
            copies: bool = False) -> DataFrame:
    """(key, item_id, best) of the rows (key, text), best by the key's texts.

    `copies` says that rows of one key have one text, which is read once.
    """
    some = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"),
                        words(F.col(f"`{item_text}`")).alias("w")).where(
        "item_id IS NOT NULL AND size(w) > 0").select(
            "item_id", shingle_texts("w").alias("shingles"),
            F.array_distinct(shingle_hashes("w")).alias("hashes"))
    some = stored(some.distinct())
    drawn = stored(sketch(some, containment))
    found = rows.select(key, words("text").alias("w")).select(
        key, F.explode(shingle_hashes("w")).alias("hash")).join(few(drawn), "hash")
    candidates = stored(
        found.distinct().groupBy(key, "item_id").agg(
            F.sum("picks").alias("hits"), F.min("least").alias("least"))
        .where("hits >= least").select(key, "item_id"))
    texts = rows.join(few(candidates.select(key).distinct()), key, "left_semi")
    if copies:
        texts = texts.groupBy(key).agg(F.any_value("text").alias("text"))
    pairs = candidates.join(
        texts.select(key, words("text").alias("w")).select(
            key, shingle_texts("w").alias("have")), key).join(
        some.select("item_id", "shingles"), "item_id")
    shared = F.size(F.array_intersect("shingles", "have"))
    return pairs.select(
        key, "item_id", shared.cast("long").alias("n_shared"),
        F.size("shingles").cast("long").alias("n_shingles"),
        (shared / F.size("shingles")).alias("containment")).where(
        F.col("containment") >= containment).groupBy(key, "item_id").agg(
        F.max(F.struct("containment", "n_shared", "n_shingles")).alias("best"))


def contained(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
              item_id: str = "item_id", item_text: str = "text",
              containment: float = CONTAINMENT) -> DataFrame:
    """Pairs (doc_id, item_id, n_shared, n_shingles, containment) from that containment on.

    Words are lower-cased runs of letters and digits.  An item of fewer than
    five words is one shingle, which only a document of the same words has.
    Null or wordless texts and null ids take part on neither side.  Equal items
    are found each on its own; of several texts of one document id the largest
    containment counts, and of several texts of an item id each is tried and the
    largest counts.  Other columns are not used.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").alias("text")).where(
        "doc_id IS NOT NULL AND text IS NOT NULL")
    return matches(rows, items, "doc_id", item_id, item_text, containment).select(
        "doc_id", "item_id", "best.n_shared", "best.n_shingles", "best.containment")


def clean(docs: DataFrame, items: DataFrame, text: str = "text", **more) -> DataFrame:
    """The rows whose own text contains no item, whatever their id."""
    digest = F.unhex(F.md5(F.col(f"`{text}`")))
    rows = docs.select(digest.alias("digest"), F.col(f"`{text}`").alias("text")).where(
        "text IS NOT NULL")
    found = stored(matches(rows, items, "digest", copies=True, **more).select(
        F.col("digest").alias("__leaked")).distinct())
    return docs.join(few(found), digest == F.col("__leaked"), "left_anti")


def oracle(containment: float = CONTAINMENT) -> str:
    """The exact containment join in SQL."""
    def side(table: str, key: str, name: str) -> str:
        return f"""{name}_w AS MATERIALIZED (
  SELECT {key}, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'),
                            lambda x: x <> '') AS w FROM {table}),
{name} AS MATERIALIZED (
  SELECT {key}, unnest(list_distinct(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3),
                                         lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM {name}_w)"""
    return f"""WITH {side("documents", "doc_id", "d")}, {side("benchmark", "item_id", "b")},
sizes AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY 1),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles::DOUBLE AS containment
FROM shared JOIN sizes USING (item_id) WHERE n_shared >= {containment} * n_shingles"""


ship(__name__)
