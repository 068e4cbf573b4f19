import random

import pytest
from pyspark.sql import functions as F

from docloom.operators.graph import components
from docloom.operators.ranking import previous, ranked
from docloom.operators.uniqueness import _settled, admit_first, first_per_key, repeated_keys


def one_at_a_time(data):
    exts, shas, accepted = set(), set(), []
    for seq, tenant, ext, sha in sorted(data):
        if (tenant, ext) in exts or (tenant, sha) in shas:
            continue
        exts.add((tenant, ext))
        shas.add((tenant, sha))
        accepted.append(seq)
    return accepted


KEYS = (("tenant", "ext"), ("tenant", "sha"))
DDL = "seq bigint, tenant string, ext string, sha string"


def admitted(rows, data):
    return sorted(r.seq for r in admit_first(rows(DDL, *data), KEYS, "seq").collect())


def test_refused_row_blocks_nobody(rows):
    data = [(1, "t", "a", "x"), (2, "t", "a", "y"), (3, "t", "b", "y"), (4, "t", "b", "z")]
    assert admitted(rows, data) == [1, 3]


def test_long_chain(rows):
    # Each row shares one key with the one before it, so every second row is accepted.
    data = [(i, "t", f"e{i // 2}", f"s{(i + 1) // 2}") for i in range(9)]
    assert admitted(rows, data) == one_at_a_time(data) == [0, 2, 4, 6, 8]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_sequential_insertion(rows, seed):
    rng = random.Random(seed)
    data = [(i, rng.choice("tu"), f"e{rng.randrange(25)}", f"s{rng.randrange(25)}")
            for i in range(80)]
    assert admitted(rows, data) == one_at_a_time(data)


def test_hot_key(rows):
    data = [(i, "t", "hot" if i % 3 == 0 else f"e{i}", f"s{i}") for i in range(90)]
    assert admitted(rows, data) == one_at_a_time(data)


def test_a_chain_of_ten_thousand_rows_needs_few_jobs(spark, rows):
    data = [(i, "t", f"e{i // 2}", f"s{(i + 1) // 2}") for i in range(10_000)]
    data += [(20_000 + i, "t", f"x{(i * 37) % 500}", f"y{(i * 53) % 700}") for i in range(3_000)]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("chain", "chain")
    try:
        got = admitted(rows, data)
        jobs = len(tracker.getJobIdsForGroup("chain"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == one_at_a_time(data)
    assert jobs < 400, jobs


def test_groups_of_open_rows_settle_in_their_order(rows):
    rng = random.Random(4)
    data = [(i, rng.choice("tu"), f"e{rng.randrange(60)}", f"s{rng.randrange(60)}") for i in range(300)]
    got = _settled(rows(DDL, *data), KEYS, "seq").collect()
    assert sorted(r.seq for r in got) == one_at_a_time(data)


def test_components(rows):
    links = [(i, i + 1) for i in range(1, 200) if i % 50] + [(7, 7), (300, 1), (3, 1), (400, 401)]
    got = {r.node: r.root for r in components(rows("x bigint, y bigint", *links), "x", "y").collect()}
    want = {i: (i - 1) // 50 * 50 + 1 for i in range(1, 201)} | {300: 1, 401: 400}
    assert got == {n: r for n, r in want.items() if n != r}


def test_first_per_key(rows):
    df = rows("k string, o bigint, v string", ("a", 2, "y"), ("a", 1, "x"), ("b", 5, "z"))
    assert {(r.k, r.v) for r in first_per_key(df, ["k"], "o").collect()} == {("a", "x"), ("b", "z")}
    assert [(r.k, r.copies) for r in repeated_keys(df, ["k"]).collect()] == [("a", 2)]


def test_first_per_key_is_cut_before_the_shuffle(rows):
    plan = first_per_key(rows("k string, o bigint", ("a", 2)), ["k"], "o") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_ranked_equals_row_number(spark, rows, ranges):
    """A group of most rows lies over many ranges, and small groups share one."""
    rng = random.Random(7)
    data = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), n) for n in rng.sample(range(1000), 300)]
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        got = ranked(rows("g string, o bigint", *data), ["g"], [F.desc("o")], "place")
        found = {(r.g, r.o): r.place for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    want = {}
    for g in {g for g, _ in data}:
        for i, o in enumerate(sorted((o for x, o in data if x == g), reverse=True), 1):
            want[(g, o)] = i
    assert found == want


def test_one_group_lies_over_all_ranges(spark, rows):
    """Ranges of a table whose rows are all one group: none holds most of it, and places run on."""
    df = spark.range(0, 40_000, 1, 7).selectExpr("'all' AS g", "id * 7919 % 40009 AS o")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranked(df, ["g"], ["o"], "place")
        sizes = [r[0] for r in got.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert len(sizes) == 16 and max(sizes) < 40_000 / 4
        again = sorted((r.o, r.place) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [p for _, p in again] == list(range(1, 40_001))


def test_rank_without_keys_and_of_nothing(rows):
    df = rows("o bigint, p string", *[(i % 5, f"{i:03}") for i in range(50)])
    got = sorted((r.o, r.p, r.place) for r in ranked(df, [], [F.desc("o"), "p"], "place").collect())
    want = sorted((o, p, i) for i, (o, p) in enumerate(sorted(((i % 5, f"{i:03}") for i in range(50)), key=lambda x: (-x[0], x[1])), 1))
    assert got == want
    assert ranked(df.filter("o > 9"), [], ["o"], "place").collect() == []
    assert ranked(df.filter("o > 9"), ["p"], ["o"], "place").columns == ["o", "p", "place"]


@pytest.mark.parametrize("ranges", [1, 30])
def test_previous_equals_lag(spark, rows, ranges):
    rng = random.Random(9)
    data = [(rng.choice(["hot", "hot", "a"]), f"e{i:03}", rng.randrange(0, 5 * 86400, 997))
            for i in range(150)] + [("null", "x", None), ("null", "y", 5), (None, "n", 1), (None, "m", 2)]
    df = rows("g string, e string, s bigint", *data).selectExpr(
        "g", "e", "timestamp_seconds(s) AS at")
    df.createOrReplaceTempView("lag_input")
    want = spark.sql("SELECT g, e, lag(at) OVER (PARTITION BY g ORDER BY at, e) AS before "
                     "FROM lag_input").collect()
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        got = previous(df, ["g"], ["at", "e"], "at", "before").select("g", "e", "before").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert sorted(map(str, got)) == sorted(map(str, want))
