"""Nearest neighbours by inner product with a hash-prefix forest.

Equal vectors count as one: only the ``k`` + 1 smallest ids of each can stand in a list, as ties go to smaller ids, so
the others are left out without loss. Distinct vectors are dealt into blocks. For each block a forest is built: in each
of ``TREES`` trees every vector has a hash string of ``BITS`` signs of random projections, and the strings are sorted. Inner
products become angles by a further coordinate, which gives all vectors the block's largest norm. A query descends in
each tree, by binary search, to the vectors of the longest common prefix; then all trees ascend together, one level of
prefix length after the other, until ``SHARE`` of the block, ``CANDIDATES`` at least, are found as distinct vectors. These
are scored exactly, in double precision on the original vectors. Lists of the blocks are merged by rank.

All vectors are indexed. A query meets each block, as its neighbours may be in any. A block is one task's: its trees are
built once and queries stream past them, so memory is bounded by one block; only for each ``QUERIES`` queries more there is a
further copy of it.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows
without id. With fewer candidates than k all are returned. Repeated rows of one id count once, with the first vector in
order. Vectors of another length than the most frequent one (the shortest of ties) have no inner product with the others
and take no part; a warning tells their number. Extra columns are ignored.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Scratch, table

#: Candidates of a block: so many, or that share of it, whichever is more. BITS of a hash string, 32 at most.
K, TREES, CANDIDATES, SHARE, BITS = 20, 512, 800, 0.15, 24
#: Vectors of a block, queries that one copy of it serves, queries that descend together.
BLOCK, QUERIES, TOGETHER = 1 << 14, 1 << 13, 64


class Forest:
    """The trees of one block of vectors: for each tree the sorted hash strings, and the rows in that order."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, seed: int = 7):
        self.vectors, self.least = vectors, max(CANDIDATES, int(np.ceil(SHARE * len(vectors))))
        norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        lifted = np.column_stack([vectors, np.sqrt(np.maximum(float(norms.max(initial=0.0)) ** 2 - norms**2, 0.0))])
        lifted = (lifted / max(float(norms.max(initial=0.0)), 1e-300)).astype(np.float32)
        self.planes = np.random.default_rng(seed).standard_normal((trees, lifted.shape[1], BITS)).astype(np.float32)
        self.strings = np.empty((trees, len(vectors)), np.uint32)
        self.rows = np.empty((trees, len(vectors)), np.int32)
        for t in range(trees):
            strings = self._strings(lifted, t)
            self.rows[t] = np.argsort(strings, kind="stable")
            self.strings[t] = strings[self.rows[t]]

    def _strings(self, lifted: np.ndarray, t: int) -> np.ndarray:
        return (lifted @ self.planes[t] > 0) @ (np.uint32(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint32))

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each tree, query and prefix length from 0 to BITS, the range of the sorted strings that share that much of
        the query's own. Queries have nothing in the added coordinate."""
        norms = np.sqrt(np.einsum("ij,ij->i", queries, queries))[:, None]
        lifted = np.column_stack([queries / np.where(norms > 0, norms, 1), np.zeros(len(queries))]).astype(np.float32)
        keep = (BITS - np.arange(BITS + 1)).astype(np.uint32)
        start, stop = (np.empty((len(self.strings), len(queries), BITS + 1), np.int32) for _ in range(2))
        for t, strings in enumerate(self.strings):
            low = (self._strings(lifted, t)[:, None] >> keep) << keep
            start[t] = np.searchsorted(strings, low, "left")
            stop[t] = np.searchsorted(strings, low + ((np.uint32(1) << keep) - np.uint32(1)), "right")
        return start, stop

    def candidates(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Rows found by one query, given its ranges in each tree: from the longest prefix that any tree shares, all trees
        ascend together until ``least`` rows are distinct, or the roots are reached."""
        n = len(self.vectors)
        found = (stop - start).sum(axis=0)
        level = int(np.flatnonzero(found >= min(self.least, n))[-1])  # no longer prefix can have as many distinct rows
        for level in range(level, -1, -1):
            m = (stop - start)[:, level]
            at = np.repeat(start[:, level] + np.arange(len(m)) * n - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
            seen = np.zeros(n, bool)
            seen[self.rows.ravel()[at]] = True
            if np.count_nonzero(seen) >= self.least:
                break
        return np.flatnonzero(seen)

    def search(self, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query rows and scores of the k best candidates, and of all that tie with the last."""
        for a in range(0, len(queries), TOGETHER):
            some = queries[a : a + TOGETHER]
            start, stop = self.ranges(some)
            for i, query in enumerate(some):
                rows = self.candidates(start[:, i], stop[:, i])
                scores = np.einsum("ij,j->i", self.vectors[rows], query)
                if len(rows) > k:
                    keep = scores >= np.partition(scores, -k)[-k]
                    rows, scores = rows[keep], scores[keep]
                yield rows, scores


def _searched(k: int):
    """Rows (cell, query, key, v), sorted by cell and vectors before queries -> (of, key, score). One block of vectors
    is held at a time, queries stream past it."""
    schema = pa.schema([("of", pa.string()), ("key", pa.string()), ("score", pa.float64())])

    def matrix(rows: pa.RecordBatch) -> np.ndarray:
        return np.array(rows.column(3).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(rows.num_rows, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, forest, names = None, [], None, None
        for batch in batches:
            cells, is_query = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(cells) != 0) | (np.diff(is_query) != 0)) + 1).tolist(), batch.num_rows]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if x == y:
                    continue
                if cells[x] != cell:
                    cell, held, forest = cells[x], [], None
                rows = batch.slice(x, y - x)
                if not is_query[x]:
                    held.append((rows.column(2).to_pylist(), matrix(rows)))
                    continue
                if not held:
                    continue
                if forest is None:
                    names, forest = np.array([n for some, _ in held for n in some], object), Forest(np.concatenate([m for _, m in held]))
                of, key, score = [], [], []
                for name, (found, scores) in zip(rows.column(2).to_pylist(), forest.search(matrix(rows), k), strict=True):
                    of += [name] * len(found)
                    key += names[found].tolist()
                    score += scores.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((of, key, score), schema, strict=True)], schema=schema)

    return run


def _usable(df: DataFrame, vector: str) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.col(vector).isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def nearest(spark: SparkSession, rows: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows (vec_id, embedding) where ``is_query``, a condition on vec_id, holds."""
    scratch = Scratch(spark, "ann")
    clean = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(F.col("vec_id").isNotNull()).where(_usable(rows, "v"))
    sizes = clean.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "d")
    sizes = sizes.select("d", "n", F.sum("n").over(W.orderBy(F.col("n").desc(), "d").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("all")).limit(1).collect()  # a row for each length
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not sizes:
        return spark.createDataFrame([], schema)
    if sizes[0].all > sizes[0].n:
        warnings.warn(f"{sizes[0].all - sizes[0].n} vectors of other lengths than {sizes[0].d} take no part", stacklevel=2)
    clean = clean.where(F.size("v") == sizes[0].d).groupBy("vec_id").agg(F.min("v").alias("v"))
    # The key stands for the vector: two 64-bit hashes, minus zero as zero.
    plain = F.transform("v", lambda x: x + F.lit(0.0))
    clean = clean.withColumn("key", F.concat_ws(":", F.xxhash64(plain), F.xxhash64(F.lit(1), plain)))
    keyed = scratch.write(clean.select("vec_id", "key", "v"), "vectors")
    smallest = W.partitionBy("key").orderBy("vec_id")
    firsts = scratch.write(keyed.select("vec_id", "key").withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= k + 1).select("key", "vec_id"), "ids")
    asked = keyed.where(is_query).select(F.col("vec_id").alias("query_id"), "key")
    distinct = keyed.join(firsts.groupBy("key").agg(F.min("vec_id").alias("rep")), "key").where("vec_id = rep").select("key", "v").withColumn("h", F.xxhash64("key", F.lit(3)))
    distinct = scratch.write(distinct, "distinct")
    n = distinct.count()
    queries = scratch.write(distinct.join(asked.select("key").distinct(), "key", "left_semi"), "queries")
    blocks, copies = max(1, -(-n // BLOCK)), max(1, -(-queries.count() // QUERIES))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = distinct.select(F.pmod("h", F.lit(blocks)).cast("int").alias("b"), every(copies).alias("c"), F.lit(0).alias("query"), "key", "v")
    right = queries.select(every(blocks).alias("b"), F.pmod(F.xxhash64("h"), F.lit(copies)).cast("int").alias("c"), F.lit(1).alias("query"), "key", "v")
    cells = left.unionByName(right).select((F.col("b").cast("bigint") * copies + F.col("c")).alias("cell"), "query", "key", "v")
    cells = cells.repartition(blocks * copies, "cell").sortWithinPartitions("cell", "query")
    hits = cells.mapInArrow(_searched(k + 1), "of string, key string, score double")
    # The k + 1 best ids of each distinct query vector, then of each query those but itself.
    best = W.partitionBy("of").orderBy(F.col("score").desc(), "vec_id")
    listed = scratch.write(hits.join(firsts, "key").withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).select("of", "vec_id", "score"), "lists")
    own = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    pairs = asked.join(listed, F.col("key") == F.col("of")).where("vec_id <> query_id")
    return pairs.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
