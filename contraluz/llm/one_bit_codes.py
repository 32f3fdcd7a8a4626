"""Nearest neighbours by randomly rotated one-bit codes with error bounds.

Vectors are rotated by one random orthogonal matrix.  A vector's code is the
sign of each rotated component, packed to bits; with it go two scalars, its norm
and the inner product of its direction with the code's.  From the code alone the
inner product with a query is estimated without bias: the rotated query, summed
with the code's signs, divided by the code's own inner product.  The error of
one estimate is bounded, but for one case in thousands, by EPSILON times
sqrt((1 - o * o) / o * o / (d - 1)) times both norms, o being that inner product.

The index rows are dealt into blocks, the stated queries likewise, and every
block of queries meets every block of the index in one task: the estimates of
all pairs come from one multiplication of unpacked signs.  The likeliest vectors
of a query's k likeliest ids are reranked first, and the least of their exact
scores is its threshold; vectors whose upper bound reaches it are reranked
with their exact inner product in double precision, and the block's k best ids
leave the task, each with its best vector.  The k best over blocks are the
result.  No pair of rows is ever a row of a table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contraluz.llm.common import ship, stored

EPSILON = 3.0
SEED = 20240229
INDEX_BLOCK, QUERY_BLOCK = 8_192, 4_096
PART = 64  # queries whose estimates are held at once
CELLS = 1 << 20  # numbers of the vectors that are reranked at once

FOUND = "query_id long, vec_id long, score double"


def rotation(d: int) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is made."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def codes(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, norms, and the inner products of directions and codes."""
    rotated = vectors @ turn
    norms = np.linalg.norm(vectors, axis=1)
    overlap = np.abs(rotated).sum(axis=1) / (norms * np.sqrt(vectors.shape[1]))
    return np.packbits(rotated >= 0, axis=1), norms, overlap


def bounds(bits: np.ndarray, norms: np.ndarray, overlap: np.ndarray,
           rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of the inner products with rotated queries, and their error bounds."""
    d = rotated.shape[1]
    signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32) * 2 - 1
    scale = (norms / (overlap * np.sqrt(d))).astype(np.float32)
    estimate = (rotated.astype(np.float32) @ signs.T) * scale
    spread = EPSILON * norms * np.sqrt(np.maximum(1 - overlap ** 2, 0)) / (
        overlap * np.sqrt(max(d - 1, 1)))
    return estimate, np.linalg.norm(rotated, axis=1)[:, None] * spread[None, :].astype(np.float32)


def best_of_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray,
                  ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best ids of a block for each query, itself left out, by their best vectors."""
    turn = rotation(vectors.shape[1])
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    new = np.r_[True, ids[1:] != ids[:-1]][:len(ids)]
    starts, group = np.flatnonzero(new), np.cumsum(new) - 1
    several = len(starts) < len(ids)  # an id has more than one vector
    bits, norms, overlap = codes(vectors, turn)
    rotated = queries @ turn
    out_q, out_v, out_s = [], [], []
    for a in range(0, len(queries), PART):
        estimate, error = bounds(bits, norms, overlap, rotated[a:a + PART])
        own = query_ids[a:a + PART, None] == ids[None, :]
        estimate[own] = -np.inf
        if k < len(starts):  # the k likeliest ids, reranked first, set the threshold
            likely = np.maximum.reduceat(estimate, starts, axis=1) if several else estimate
            top = np.argpartition(likely, len(starts) - k, axis=1)[:, len(starts) - k:]
            if several:  # from ids to the likeliest vector of each
                at = np.where(estimate == likely[:, group], np.arange(len(ids)), len(ids) - 1)
                top = np.take_along_axis(np.minimum.reduceat(at, starts, axis=1), top, axis=1)
            exact = np.einsum("ij,ikj->ik", queries[a:a + PART], vectors[top])
            exact[np.take_along_axis(own, top, axis=1)] = -np.inf
            least = exact.min(axis=1, keepdims=True)
        else:
            least = np.full((len(estimate), 1), -np.inf)
        row, column = np.nonzero((estimate + error >= least) & ~own)
        scores = np.empty(len(row))
        step = max(1, CELLS // vectors.shape[1])
        for b in range(0, len(row), step):
            part = slice(b, b + step)
            scores[part] = np.einsum("ij,ij->i", queries[a + row[part]], vectors[column[part]])
        if several:  # the best vector of each id
            order = np.lexsort((-scores, group[column], row))
            row, column, scores = row[order], column[order], scores[order]
            same = (row[1:] == row[:-1]) & (group[column[1:]] == group[column[:-1]])
            lead = np.r_[True, ~same][:len(row)]
            row, column, scores = row[lead], column[lead], scores[lead]
        order = np.lexsort((ids[column], -scores, row))
        row, column, scores = row[order], column[order], scores[order]
        begin = np.searchsorted(row, np.arange(len(estimate)))
        kept = np.arange(len(row)) - begin[row] < k
        out_q.append(query_ids[a + row[kept]])
        out_v.append(ids[column[kept]])
        out_s.append(scores[kept])
    empty = [np.zeros(0, np.int64)]
    return (np.concatenate(out_q or empty), np.concatenate(out_v or empty),
            np.concatenate(out_s or [np.zeros(0)]))


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite, and not all zero."""
    def bad(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return (vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, bad)
            & F.exists(vector, lambda x: x != 0))


def neighbours(vectors: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id",
               embedding: str = "embedding", index_block: int = INDEX_BLOCK,
               query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest rows but itself.

    Nearness is the largest inner product in double precision, ties go to the
    smaller id.  Vectors that are null, empty, zero or not finite take no part,
    nor do rows without an id; queries meet the vectors of their own length.
    Repeated rows of an id and vector count once; different vectors of one id
    are tried each, the best one counts.  A query with fewer candidates has
    fewer rows.
    """
    values = F.transform(F.col(f"`{embedding}`"), lambda x: x.cast("double"))
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), values.alias("v"),
        is_query.alias("query")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows = stored(rows.groupBy("vec_id", "v").agg(F.max("query").alias("query")).withColumn(
        "d", F.size("v")))
    total, asked = rows.agg(F.count("*"), F.count_if("query")).first()
    index_parts, query_parts = total // index_block + 1, asked // query_block + 1

    def dealt(df: DataFrame, parts: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", "v", F.lit(salt)), F.lit(parts)).cast("int")

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    index = rows.select("vec_id", "v", "d", dealt(rows, index_parts, 1).alias("i"),
                        numbers(query_parts).alias("q"))
    queries = rows.where("query").select(
        "vec_id", "v", "d", dealt(rows, query_parts, 2).alias("q"),
        numbers(index_parts).alias("i"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        def read(table):
            v = table.column("v").combine_chunks()
            flat = v.flatten().to_numpy(zero_copy_only=False)
            return flat.reshape(table.num_rows, -1), table.column("vec_id").to_numpy()
        if left.num_rows and right.num_rows:
            found = best_of_block(*read(left), *read(right), k)
        else:
            found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"query_id": found[0], "vec_id": found[1], "score": found[2]})

    keys = ["q", "i", "d"]
    near = queries.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInArrow(meet, FOUND)
    near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ship(__name__)
