"""Index payloads and dense, lexical and fused search.

A search takes a batch of queries, a stated set, and a table of points. Both become blocks, the
queries written once and the points read once, and every block of points meets every block of
queries (see ``operators/blocks.py``). A task keeps the best ``k`` points of each query it has seen;
only those reach the shuffle, and are merged in two steps, so that no task ranks what all found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from docloom.operators.access import acl_principals
from docloom.operators.blocks import in_blocks, meet, unpacked
from docloom.operators.tables import active, live
from docloom.session import bounded_batches, cut_lineage

SCORE_DIGITS = 9
QUERY_BYTES = 2 << 20  # vectors and terms of one block of queries
CELLS = 500_000  # scores, or products of weights, made at a time
HELD = 500_000  # best points a task holds before it sends them on
BATCH_BYTES = 8 << 20  # of points, or of blocks, that a task takes at a time
SLICES = 64  # of the first step of the merge
RRF_K = 60  # rank constant of Cormack, Clarke and Buettcher (2009)

# A column of a block of queries to a function that scores the same column of a block of points. It
# yields (query, row, score) arrays in order of the query; what is no candidate is left out.
Triples = Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]
Scorer = Callable[[pa.Array], Callable[[pa.Array], Triples]]

LEXICAL_BREAK = r"[^\p{L}\p{N}]+"


# Index side -------------------------------------------------------------------------------------


def point_payload(
    chunks: DataFrame, versions: DataFrame, documents: DataFrame, acl: DataFrame, indexed_at
) -> DataFrame:
    """The filterable payload of every active chunk of a live document and version; no text, no paths.
    Chunks of documents without an access list get an empty one, which matches no caller."""
    version = live(versions).select(
        "tenant_id", F.col("id").alias("document_version_id"), "document_id", "mime_type",
        "language_code")
    document = live(documents).select(
        "tenant_id", F.col("id").alias("document_id"), "source_system", "classification")
    lists = acl_principals(acl)
    enriched = version.join(document, ["tenant_id", "document_id"]) \
        .join(lists, ["tenant_id", "document_id"], "left")
    return active(chunks).join(enriched, ["tenant_id", "document_version_id"]).select(
        "point_id", "tenant_id", "document_id", "document_version_id",
        F.col("id").alias("chunk_id"), "source_system", "mime_type", "language_code",
        "classification",
        F.coalesce("acl_principals", F.array().cast("array<string>")).alias("acl_principals"),
        "is_active", F.lit(indexed_at).cast("timestamp").alias("indexed_at"),
        "embedding_model", "content_sha256", "section_path",
    )


def point_rows(payload: DataFrame, vectors: DataFrame) -> DataFrame:
    """Points ready to store: payload with both vectors (point_id, embedding, weights).

    The index is a projection: running the payload join and this again over the tables rebuilds
    it. Chunks without vectors are left for a later run; ``lineage_gaps`` counts them.
    """
    return payload.join(vectors.select("point_id", "embedding", "weights"), "point_id")


def terms(text: str | Column) -> Column:
    """Lower-case letter-and-digit terms of a text, repeats kept."""
    return F.filter(F.split(F.lower(text), LEXICAL_BREAK), lambda t: t != "")


def term_weights(text: str | Column) -> Column:
    """Sparse vector of a text: term to number of occurrences.

    Counting inside the row avoids exploding and shuffling every term of every text: in the sorted
    terms every distinct one has a first place, and the next first place tells how often it stands.
    """
    def counted(found: Column) -> Column:
        n = F.size(found)
        firsts = F.filter(
            F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")),
            lambda i: (i == 1) | (F.get(found, i - 1) != F.get(found, i - 2)))
        entries = F.zip_with(
            firsts, F.concat(F.slice(firsts, 2, F.greatest(n, F.lit(1))), F.array(n + 1)),
            lambda at, after: F.struct(F.get(found, at - 1).alias("term"), (after - at).cast("double").alias("n")))
        return F.map_from_entries(F.filter(entries, lambda e: e["term"].isNotNull()))

    # A map over one element binds the sorted terms, so that they are made once.
    return F.get(F.transform(F.array(F.array_sort(terms(text))), counted), 0)


# Search -----------------------------------------------------------------------------------------


class _Best:
    """Best ``k`` points of every query of a block so far; ties go to the smaller id."""

    def __init__(self, count: int, k: int) -> None:
        self.k = k
        self.least = np.full(count, -np.inf)  # a score below it is out
        self.kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def offer(self, query: np.ndarray, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Scores of points, in order of the query."""
        fit = score >= self.least[query]
        query, row, score = query[fit], row[fit], score[fit]
        cuts = np.flatnonzero(query[1:] != query[:-1]) + 1 if len(query) else []
        for low, high in zip([0, *cuts], [*cuts, len(query)]):
            if low == high:
                continue
            q, scores, points = int(query[low]), score[low:high], ids[row[low:high]]
            if len(scores) > self.k:
                keep = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
                scores, points = scores[keep], points[keep]
            if q in self.kept:
                scores, points = (np.concatenate(x) for x in zip(self.kept[q], (scores, points)))
            order = np.lexsort((points, -scores))[:self.k]
            self.kept[q] = scores[order], points[order]
            if len(order) == self.k:
                self.least[q] = scores[order[-1]]

    def size(self) -> int:
        return sum(len(scores) for scores, _ in self.kept.values())


class _Asked:
    """A block of queries, ready to score points, with what it has found."""

    def __init__(self, payload, k: int, scorers: dict[str, tuple[str, Scorer]]) -> None:
        table = unpacked(payload)
        self.ids = table["query_id"].combine_chunks()
        self.lists = []
        for name, (column, make) in scorers.items():
            asked = pc.indices_nonzero(pc.is_valid(table[column]))
            if len(asked):
                rows = table[column].combine_chunks().take(asked)
                self.lists.append((name, column, asked.to_numpy(), make(rows), _Best(len(rows), k)))

    def score(self, points: pa.Table) -> None:
        for _, column, _, score, best in self.lists:
            there = pc.indices_nonzero(pc.is_valid(points[column]))
            if len(there):
                ids = np.asarray(points["point_id"].take(there).to_pylist())
                for query, row, scores in score(points[column].combine_chunks().take(there)):
                    best.offer(query, row, scores, ids)

    def size(self) -> int:
        return sum(best.size() for *_, best in self.lists)

    def found(self, here: int, point_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        for name, _, asked, _, best in self.lists:
            kept = list(best.kept.items())
            if kept:
                n = [len(scores) for _, (scores, _) in kept]
                query = np.repeat(asked[[q for q, _ in kept]], n)
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * len(query)), pa.array(np.full(len(query), here % SLICES, np.int32)),
                    self.ids.take(pa.array(query)),
                    pa.array([p for _, (_, points) in kept for p in points.tolist()], point_type),
                    pa.array(np.concatenate([scores for _, (scores, _) in kept]))],
                    names=["list", "slice", "query_id", "point_id", "score"])


def _query_blocks(queries: DataFrame, columns: list[str]) -> tuple[DataFrame, int, int]:
    """Blocks (part, payload) of the batch, their number and size. One row reaches the driver."""
    asked = cut_lineage(queries.select("query_id", *columns).dropna("all", subset=columns))
    weight = sum((F.coalesce(F.size(c).cast("bigint"), F.lit(0)) * 16 for c in columns), F.lit(64))
    size = asked.agg(F.sum(weight)).first()[0] or 0
    count = max(1, -(-size // QUERY_BYTES))
    dealt = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(count)).cast("int")) \
        .repartition(count, "part").sortWithinPartitions("part")
    return in_blocks(dealt, "part", 4 * QUERY_BYTES), count, size


def _search(points: DataFrame, queries: DataFrame, k: int, scorers: dict[str, tuple[str, Scorer]]) -> DataFrame:
    """(list, query_id, point_id, score, rank): the best ``k`` per list and query."""
    columns = [column for column, _ in scorers.values()]
    bounded_batches(points.sparkSession, BATCH_BYTES)
    asked, count, size = _query_blocks(queries, columns)
    point_field, query_field = points.schema["point_id"].dataType, queries.schema["query_id"].dataType
    point_type = to_arrow_type(point_field)
    rows = points.select(F.lit(0).alias("part"), "point_id", *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        here = TaskContext.get().partitionId()
        held: dict[int, list[_Asked]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.column("part")[i].as_py()
                other = batch.column("other")[i].as_buffer()
                known = held.setdefault(part, [])
                one = next((a for payload, a in known if payload.equals(other)), None)
                if one is None:
                    one = _Asked(other, k, scorers)
                    known.append((pa.py_buffer(other.to_pybytes()), one))
                one.score(unpacked(batch.column("payload")[i].as_buffer()))
                if len(held) > SLICES or sum(a.size() for own in held.values() for _, a in own) > HELD:
                    for own in held.values():
                        for _, a in own:
                            yield from a.found(here, point_type)
                    held.clear()
        for own in held.values():
            for _, a in own:
                yield from a.found(here, point_type)

    schema = T.StructType([
        T.StructField("list", T.StringType()), T.StructField("slice", T.IntegerType()),
        T.StructField("query_id", query_field), T.StructField("point_id", point_field),
        T.StructField("score", T.DoubleType())])
    found = meet(in_blocks(rows, "part").drop("part"), asked, count, size).mapInArrow(run, schema)
    return _top(_top(found, k, ["list", "slice", "query_id"]), k, ["list", "query_id"])


def _top(candidates: DataFrame, k: int, keys: list[str]) -> DataFrame:
    """Rank the candidates of each list and keep ``k``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "point_id")
    return candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select(*keys, "point_id", "score", F.col("rank").cast("bigint").alias("rank"))


def _unit(vectors: pa.Array) -> np.ndarray:
    matrix = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(lengths == 0, 1.0, lengths)


def _cosine(asked: pa.Array):
    """Cosine of every point vector with the asked vectors. A vector of length zero has no
    direction and scores 0; one with a null or a NaN is no candidate."""
    wanted = _unit(asked)
    rows = max(1, CELLS // len(wanted))

    def score(vectors: pa.Array) -> Triples:
        unit = _unit(vectors)
        for start in range(0, len(unit), rows):
            cosine = np.round(wanted @ unit[start:start + rows].T, SCORE_DIGITS) + 0.0
            query, row = np.nonzero(~np.isnan(cosine))
            yield query, row + start, cosine[query, row]

    return score


def _sparse_rows(weights: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(row, term, weight) of every entry of a map or list column; in a list each entry weighs 1."""
    offsets = weights.offsets.to_numpy()
    keys, items = (weights.keys, weights.items) if pa.types.is_map(weights.type) else (weights.values, None)
    low, high = int(offsets[0]), int(offsets[-1])
    row = np.repeat(np.arange(len(weights)), np.diff(offsets))
    weight = np.ones(high - low) if items is None else items.slice(low, high - low).to_numpy(zero_copy_only=False).astype(np.float64)
    return row, keys.slice(low, high - low), weight


def _summed(major: np.ndarray, minor: np.ndarray, width: int, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of ``value`` over equal (major, minor), in their order."""
    cell, place = np.unique(major * width + minor, return_inverse=True)
    return cell // width, cell % width, np.bincount(place, value, len(cell))


def _lexical(asked: pa.Array):
    """Sum of weight products over shared terms; without a shared term no candidate.

    The queries are an inverted list: each term's postings name the queries that ask for it. A point's
    term meets its postings only, so memory follows the products that are not zero; ``CELLS`` of them
    are made at a time.
    """
    row, term, weight = _sparse_rows(asked)
    vocabulary = pc.unique(term)
    number = pc.index_in(term, value_set=vocabulary).to_numpy(zero_copy_only=False)
    listed, query, value = _summed(number.astype(np.int64), row, len(asked), weight)
    listed, query, value = (x[value != 0] for x in (listed, query, value))
    first = np.searchsorted(listed, np.arange(len(vocabulary) + 1))

    def score(column: pa.Array) -> Triples:
        row, term, weight = _sparse_rows(column)
        known = pc.fill_null(pc.index_in(term, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        hit = known >= 0
        row, known, weight = _summed(row[hit], known[hit], max(1, len(vocabulary)), weight[hit])
        row, known, weight = (x[weight != 0] for x in (row, known, weight))
        length = first[known + 1] - first[known]
        done = np.append(0, np.cumsum(length))
        low, ends = 0, np.append(np.flatnonzero(row[1:] != row[:-1]) + 1, len(row)) if len(row) else []
        while low < len(row):
            # Whole rows up to ``CELLS`` products, one row at least.
            last = np.searchsorted(done[ends], done[low] + CELLS, side="right") - 1
            high = int(ends[max(last, np.searchsorted(ends, low, side="right"))])
            own = np.repeat(np.arange(low, high), length[low:high])
            at = first[known[own]] + np.arange(len(own)) - (done[own] - done[low])
            q, r, total = _summed(query[at], row[own], int(row[-1]) + 1, weight[own] * value[at])
            yield q, r, np.round(total, SCORE_DIGITS) + 0.0
            low = high

    return score


DENSE = {"dense": ("embedding", _cosine)}
LEXICAL = {"sparse": ("weights", _lexical)}


def dense_topk(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Exact cosine search: (query_id, point_id, score, rank).

    ``points``: point_id, embedding; ``queries``: query_id, embedding.
    """
    return _search(points, queries, k, DENSE).drop("list")


def sparse_topk(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Lexical search: (query_id, point_id, score, rank); no shared term, no candidate.

    ``points``: point_id, weights; ``queries``: query_id, weights. The weights are a map from term
    to weight, or a list of terms in which every occurrence weighs 1.
    """
    return _search(points, queries, k, LEXICAL).drop("list")


def fuse(ranked: DataFrame, k: int, rank_constant: int = RRF_K) -> DataFrame:
    """Reciprocal-rank fusion of (query_id, point_id, rank) rows of several lists. Scores of the
    lists are never added: they are not on one scale."""
    fused = ranked.groupBy("query_id", "point_id").agg(
        F.round(F.sum(F.lit(1.0) / (F.lit(rank_constant) + F.col("rank"))), SCORE_DIGITS)
        .alias("score"))
    return _top(fused, k, ["query_id"])


def hybrid_topk(
    points: DataFrame, queries: DataFrame, k: int, prefetch: int, rank_constant: int = RRF_K
) -> DataFrame:
    """Dense and lexical candidates under the same filter, fused by rank. Both lists come from the
    same pass over the points."""
    return fuse(_search(points, queries, prefetch, {**DENSE, **LEXICAL}), k, rank_constant)
