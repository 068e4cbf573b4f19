"""Exact top-k by inner product with Fagin's threshold algorithm.

Vectors are quantised to integers and dealt into blocks by id. In a block every dimension has a list of
its vectors sorted by that component. A query reads the lists of its non-zero components in step,
from the top for a positive weight and from the bottom for a negative one; each vector first met is
scored by random access. After ``depth`` reads no unseen vector can score more than the sum of the
weighted values the lists have come to; once that bound is below the k-th best score so far, the
block is done. Ties with the bound are read on, as an unseen vector with a smaller id may win them.

Every query meets every block, as the contract asks for (a stated query set against all rows): the
pairs of blocks are the groups of the shuffle, each of bounded size on both sides. A first pass over
one block gives each query a score that k vectors reach, and all other blocks stop against it. Blocks
return at most k rows per query, merged in two steps so that no task holds all of a query's blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.session import cut_lineage

SCALE = 64
K = 20
BLOCK_ROWS = 4096
BLOCK_QUERIES = 512
FIRST_DEPTH = 32


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * component) as long of every usable row of (vec_id, embedding).

    A null id, a null vector and a null or non-finite component take a row out. A vec_id names one
    vector: of rows that repeat it, the greatest in array order stays.
    """
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("bigint"))
    sound = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(sound, F.lit(False))) \
        .select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("v")) \
        .groupBy("vec_id").agg(F.max("v").alias("v"))


class Block:
    """One block with its sorted lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.vectors = ids[order], vectors[order]
        self.lists = np.argsort(self.vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(self.vectors, self.lists, axis=0)
        # Sums below 2 ** 53 are exact in floating point, where products are fast.
        self.largest = int(np.abs(self.vectors).max(initial=0))
        self.floats = self.vectors.astype(np.float64)

    def top(self, query: np.ndarray, k: int, at_least: int | None, skip: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and scores of the best ``k`` (fewer where ``at_least`` rules the rest out), best
        first, without id ``skip``; and the depth read."""
        n = len(self.ids)
        exact = self.largest * int(np.abs(query).sum()) < 1 << 53
        matrix, weights = (self.floats, query.astype(np.float64)) if exact else (self.vectors, query)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = np.zeros(n, bool)
        own = np.searchsorted(self.ids, skip)
        if own < n and self.ids[own] == skip:
            seen[own] = True
        rows, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        low, depth = 0, min(n, FIRST_DEPTH if len(up) + len(down) else n)

        def bound(depth: int) -> int:
            return int(query[up] @ self.values[n - depth, up] + query[down] @ self.values[depth - 1, down])

        # Reads that a score known from elsewhere already asks for are made at once.
        while at_least is not None and depth < n and bound(depth) >= at_least:
            depth *= 2
        while True:
            depth = min(depth, n)
            fresh = np.zeros(n, bool)
            if len(up) + len(down):
                fresh[self.lists[n - depth:n - low, up]] = True
                fresh[self.lists[low:depth, down]] = True
            else:
                fresh[:] = True
            new = np.flatnonzero(fresh & ~seen)
            seen |= fresh
            rows = np.append(rows, new)
            scores = np.append(scores, (matrix[new] @ weights).astype(np.int64))
            if len(rows) > k:
                best = np.lexsort((rows, -scores))[:k]
                rows, scores = rows[best], scores[best]
            if depth == n:
                break
            floor = max((x for x in (int(scores.min()) if len(rows) == k else None, at_least) if x is not None), default=None)
            if floor is not None and bound(depth) < floor:
                break
            low, depth = depth, depth * 2
        best = np.lexsort((rows, -scores))
        return self.ids[rows[best]], scores[best], depth


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def search(groups: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best of every group of ``groups`` (rb, qb, width, is_query, id, v, floor)."""
    def run(table: pa.Table) -> pa.Table:
        width = table["width"][0].as_py()
        is_query = table["is_query"].to_numpy().astype(bool)
        ids, floors = table["id"].to_numpy(), table["floor"].to_pylist()
        vectors = _matrix(table["v"].combine_chunks(), width)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if is_query.any() and not is_query.all():
            block = Block(ids[~is_query], vectors[~is_query])
            for i in np.flatnonzero(is_query).tolist():
                found, scores, _ = block.top(vectors[i], k, floors[i], int(ids[i]))
                out.append((np.full(len(found), ids[i]), found, scores))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 3
        return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    return groups.groupBy("rb", "qb", "width").applyInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def _best(rows: DataFrame, k: int, *keys: str | Column) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE,
          block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best other rows of ``vectors`` (vec_id, embedding) for
    every row that ``is_query`` (a condition on vec_id) holds for; all of them, if there are fewer.

    Ties go to the smaller vec_id. Vectors of different lengths have no product and do not meet. An
    empty table, or one without queries, gives no rows.
    """
    data = cut_lineage(quantized(vectors, scale).withColumn("width", F.size("v")).withColumn("is_query", is_query))
    sizes = data.agg(F.count("*"), F.count(F.when(F.col("is_query"), 1))).first()
    blocks, query_blocks = max(1, -(-sizes[0] // block_rows)), max(1, -(-sizes[1] // block_queries))
    hashed = F.xxhash64("vec_id")
    rows = data.select(
        F.pmod(hashed, F.lit(blocks)).cast("int").alias("rb"), "width", F.lit(False).alias("is_query"),
        F.col("vec_id").alias("id"), "v", F.lit(None).cast("bigint").alias("floor"))
    queries = data.filter("is_query").select(
        F.pmod(F.shiftright(hashed, 20), F.lit(query_blocks)).cast("int").alias("qb"), "width",
        F.lit(True).alias("is_query"), F.col("vec_id").alias("id"), "v")

    def meet(rows: DataFrame, queries: DataFrame, first: int, last: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
        return search(rows.withColumn("qb", every).unionByName(
            queries.withColumn("rb", F.explode(F.sequence(F.lit(first), F.lit(last))))), k)

    ahead = cut_lineage(meet(rows.filter("rb = 0"), queries.withColumn("floor", F.lit(None).cast("bigint")), 0, 0))
    found = ahead
    if blocks > 1:
        floors = ahead.groupBy(F.col("query_id").alias("id")).agg(
            F.when(F.count("*") >= k, F.min("score")).alias("floor"))
        found = found.unionByName(meet(rows.filter("rb > 0"), queries.join(floors, "id", "left"), 1, blocks - 1))
    salt = max(1, int(np.sqrt(blocks)))
    partly = _best(found.withColumn("salt", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(salt))), k, "query_id", "salt")
    return _best(partly.drop("rank"), k, "query_id").select("query_id", "rank", "vec_id", "score")
