import math
from collections import Counter

import numpy as np
import pytest

from docloom.operators import blocks, retrieval
from docloom.plans import all_queries
from docloom.plans.views import _TYPES as TYPES


@pytest.fixture(scope="module")
def space():
    rng = np.random.default_rng(5)
    points = {f"p{i:03}": rng.normal(size=8).round(3).tolist() for i in range(60)}
    points["p010"] = points["p005"]  # a tie, settled by id
    queries = {i: rng.normal(size=8).round(3).tolist() for i in range(7)}
    return points, queries


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)
                                                       * sum(y * y for y in b))


def best(scores, k):
    return [p for p, s in sorted(scores.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]]


def listed(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r.point_id)
    return out


def test_dense_against_brute_force(rows, space, monkeypatch):
    points, queries = space
    p = rows("point_id string, embedding array<double>", *points.items()).repartition(5)
    q = rows("query_id bigint, embedding array<double>", *queries.items())
    want = {i: best({n: cosine(v, x) for n, v in points.items()}, 4) for i, x in queries.items()}
    assert listed(retrieval.dense_topk(p, q, 4)) == want
    # Many blocks of queries and of points, sent to every task or dealt by shuffle, little held.
    monkeypatch.setattr(retrieval, "QUERY_BYTES", 300)
    monkeypatch.setattr(retrieval, "HELD", 10)
    assert listed(retrieval.dense_topk(p, q, 4)) == want
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", 0)
    assert listed(retrieval.dense_topk(p, q, 4)) == want


def test_zero_vector_scores_zero(rows):
    p = rows("point_id string, embedding array<double>", ("z", [0.0, 0.0]), ("a", [-1.0, 0.0]))
    q = rows("query_id bigint, embedding array<double>", (1, [1.0, 0.0]))
    got = retrieval.dense_topk(p, q, 2).orderBy("rank").collect()
    assert [(r.point_id, r.score) for r in got] == [("z", 0.0), ("a", -1.0)]


def test_rebuilt_index_keeps_chunks_without_terms(spark, tmp_path):
    spark.createDataFrame([(1, "one two", "en", "s", 7), (2, "--- !!!", "en", "s", 7)],
                          "doc_id bigint, text string, lang string, source string, n_chars bigint") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, [1.0], 0), (2, [2.0], 0)],
                          "vec_id bigint, embedding array<float>, label int") \
        .write.parquet(str(tmp_path / "embeddings.parquet"))
    for name in TYPES:
        if name not in ("documents", "embeddings"):
            spark.createDataFrame([], TYPES[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = all_queries()["index_rebuild"](spark, str(tmp_path)).collect()
    assert sorted((r.dimensions, r.terms, r.term_weight) for r in got) == [(1, 0, 0), (1, 2, 2)]


def test_sparse_against_brute_force(rows, monkeypatch):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(12)]
    bags = {f"p{i:02}": [words[j] for j in rng.integers(0, 12, 9)] for i in range(40)}
    asks = {i: [words[j] for j in rng.integers(0, 12, 3)] for i in range(5)}
    want = {}
    for i, ask in asks.items():
        scores = {n: sum(Counter(b)[t] * c for t, c in Counter(ask).items())
                  for n, b in bags.items()}
        want[i] = best({n: s for n, s in scores.items() if s > 0}, 6)
    lists = rows("point_id string, weights array<string>", *bags.items()).repartition(4)
    maps = rows("point_id string, weights map<string,double>",
                *[(n, {t: float(c) for t, c in Counter(b).items()}) for n, b in bags.items()])
    q = rows("query_id bigint, weights array<string>", *asks.items())
    assert listed(retrieval.sparse_topk(lists, q, 6)) == want
    assert listed(retrieval.sparse_topk(maps, q, 6)) == want
    monkeypatch.setattr(retrieval, "CELLS", 30)  # many small slices of products
    assert listed(retrieval.sparse_topk(lists, q, 6)) == want
    monkeypatch.setattr(retrieval, "QUERY_BYTES", 100)
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", 0)
    assert listed(retrieval.sparse_topk(lists, q, 6)) == want
    assert listed(retrieval.sparse_topk(maps, q, 6)) == want


def test_no_shared_term_is_no_candidate(rows):
    p = rows("point_id string, weights map<string,double>", ("a", {"x": 1.0}), ("b", {"y": 2.0}))
    q = rows("query_id bigint, weights map<string,double>", (1, {"x": 1.0}))
    assert listed(retrieval.sparse_topk(p, q, 5)) == {1: ["a"]}


def test_no_queries(rows, spark):
    p = rows("point_id string, weights map<string,double>", ("a", {"x": 1.0}))
    q = spark.createDataFrame([], "query_id bigint, weights map<string,double>")
    assert retrieval.sparse_topk(p, q, 5).count() == 0


def test_fusion_adds_reciprocal_ranks(rows):
    ddl = "query_id bigint, point_id string, rank bigint"
    a = rows(ddl, (1, "x", 1), (1, "y", 2))
    b = rows(ddl, (1, "y", 1), (1, "z", 2))
    got = retrieval.fuse(a.union(b), 2).orderBy("rank").collect()
    assert [r.point_id for r in got] == ["y", "x"]
    assert got[0].score == round(1 / 62 + 1 / 61, 9) and got[1].score == round(1 / 61, 9)


def test_terms(rows):
    df = rows("s string", ("Été, l'été! x2",), ("",))
    got = [r[0] for r in df.select(retrieval.terms("s")).collect()]
    assert got == [["été", "l", "été", "x2"], []]
    weights = [r[0] for r in df.select(retrieval.term_weights("s")).collect()]
    assert weights == [{"été": 2.0, "l": 1.0, "x2": 1.0}, {}]


def test_hybrid_reads_both_lists_in_one_pass(rows):
    p = rows("point_id string, embedding array<double>, weights array<string>",
             ("a", [1.0, 0.0], ["x"]), ("b", [0.0, 1.0], ["y"]), ("c", None, ["x", "x"]),
             ("d", [0.9, 0.1], None))
    q = rows("query_id bigint, embedding array<double>, weights array<string>",
             (1, [1.0, 0.0], ["x"]), (2, None, ["y"]))
    got = retrieval.hybrid_topk(p, q, 4, 3)
    assert listed(got) == {1: ["a", "c", "d", "b"], 2: ["b"]}


@pytest.mark.parametrize("limit", [0, 32 << 20])
def test_a_thousand_queries_read_the_points_once(spark, rows, tmp_path, monkeypatch, limit):
    """Both ways: one scan, and no row of points or queries on the driver before the result."""
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(retrieval, "QUERY_BYTES", 1 << 15)
    frame = type(spark.range(1))
    collect, seen = frame.collect, []
    monkeypatch.setattr(frame, "collect", lambda df: seen.append(collect(df)) or seen[-1])
    monkeypatch.setattr(frame, "toPandas", None)
    rng = np.random.default_rng(2)
    points = rng.normal(size=(300, 4)).round(2)
    rows("point_id int, embedding array<double>", *[(i, v.tolist()) for i, v in enumerate(points)]) \
        .repartition(3).write.parquet(str(tmp_path / "points"))
    asked = rng.normal(size=(1000, 4)).round(2)
    found = retrieval.dense_topk(
        spark.read.parquet(str(tmp_path / "points")),
        rows("query_id string, embedding array<double>", *[(f"q{i}", v.tolist()) for i, v in enumerate(asked)]), 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and ("xxhash64(payload" in plan) == (limit == 0)
    monkeypatch.undo()
    assert all(len(got) <= 1 for got in seen)
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    score = np.round(unit @ (asked / np.linalg.norm(asked, axis=1)[:, None]).T, 9)
    want = {f"q{q}": sorted(range(300), key=lambda i: (-score[i, q], i))[:3] for q in range(1000)}
    assert listed(found) == want


def test_one_query_of_very_many_terms(rows, monkeypatch):
    """Products of a row above the limit are made in one slice; the rest follow it."""
    monkeypatch.setattr(retrieval, "CELLS", 8)
    words = [f"w{i}" for i in range(50)]
    p = rows("point_id string, weights array<string>", ("all", words * 2), ("none", ["x"]), ("few", words[:3]), ("void", []))
    q = rows("query_id bigint, weights map<string,double>", (1, {w: 0.5 for w in words}), (2, {"x": 0.0}), (3, {}))
    got = retrieval.sparse_topk(p, q, 5).collect()
    assert sorted((r.query_id, r.point_id, r.score) for r in got) == [(1, "all", 50.0), (1, "few", 1.5)]


def test_merge_has_two_steps(rows):
    p = rows("point_id string, weights array<string>", ("a", ["x"]))
    q = rows("query_id bigint, weights array<string>", (1, ["x"]))
    plan = retrieval.sparse_topk(p, q, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("windowspecdefinition(list") >= 2 and "slice" in plan


def test_points_come_in_batches_of_bounded_bytes(spark, rows):
    from docloom.session import BATCH_BYTES

    before = spark.conf.get(BATCH_BYTES)
    try:
        spark.conf.set(BATCH_BYTES, str(64 << 20))
        points = rows("point_id string, weights array<string>", ("p", ["a"]))
        found = retrieval.sparse_topk(points, rows("query_id int, weights array<string>", (1, ["a"])), 1)
        assert int(spark.conf.get(BATCH_BYTES)) <= 8 << 20
        assert [r.point_id for r in found.collect()] == ["p"]
    finally:
        spark.conf.set(BATCH_BYTES, before)
