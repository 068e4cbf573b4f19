"""Integrity checks. Each returns rows of (table, rule, violations)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import schemas


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_checks(
    table: str, df: DataFrame, predicates: Mapping[str, str], not_null: Sequence[str] = ()
) -> DataFrame:
    """All row rules of a table in one scan: one counter per rule, then one row per rule."""
    rules = {name: f"NOT ({valid})" for name, valid in predicates.items()}
    rules |= {f"{column}_not_null": f"{column} IS NULL" for column in not_null}
    counters = df.agg(*[F.count_if(F.expr(broken)).alias(name) for name, broken in rules.items()])
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations"))
                      for name in rules])
    return counters.select(F.lit(table).alias("table"), F.inline(pairs))


def key_check(table: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Surplus rows per unique key; keys with a null part never collide."""
    copies = df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")).select(
        F.lit(table).alias("table"), F.lit("unique_" + "_".join(columns)).alias("rule"),
        "violations")


def reference_check(
    table: str, df: DataFrame, columns: Sequence[str], parent: DataFrame,
    parent_columns: Sequence[str], parent_name: str,
) -> DataFrame:
    """Rows whose complete reference names no parent row.

    Child keys are counted first, so the join sees each key once, however many rows hold it.
    """
    counted = df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    targets = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_columns, columns)])
    return counted.join(targets, list(columns), "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("violations")
    ).select(
        F.lit(table).alias("table"),
        F.lit(f"{'_'.join(columns)}_in_{parent_name}").alias("rule"), "violations")


def _key(columns: Sequence[str]) -> tuple[Column, Column]:
    """128 bits of a key, equal for equal values whatever their integer type."""
    parts = [F.col(c).cast("string") for c in columns]
    return F.xxhash64(F.lit("a"), *parts), F.xxhash64(F.lit("b"), *parts)


def _entries(name: str, df: DataFrame, numbers: Mapping[tuple[str, str], int]) -> DataFrame:
    """(rule, a, b, parent): one row for each broken row rule, key, reference and referred-to key."""
    found = []

    def entry(rule: tuple[str, str], when: Column, key: Sequence[str] = (), parent: bool = False) -> None:
        a, b = _key(key) if key else (F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))
        found.append(F.when(when, F.struct(
            F.lit(numbers[rule]).alias("rule"), a.alias("a"), b.alias("b"), F.lit(parent).alias("parent"))))

    def whole(columns: Sequence[str]) -> Column:
        return reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in columns])

    for check in schemas.CHECKS:
        if check.table == name:
            entry((name, check.rule), ~F.expr(check.valid))
    for column in schemas.NOT_NULL[name]:
        entry((name, f"{column}_not_null"), F.col(column).isNull())
    for key in schemas.UNIQUE_KEYS:
        if key.table == name:
            entry((name, "unique_" + "_".join(key.columns)), whole(key.columns), key.columns)
    for reference in schemas.FOREIGN_KEYS:
        rule = (reference.table, f"{'_'.join(reference.columns)}_in_{reference.parent}")
        if rule not in numbers:
            continue
        if reference.table == name:
            entry(rule, whole(reference.columns), reference.columns)
        if reference.parent == name:
            entry(rule, whole(reference.parent_columns), reference.parent_columns, parent=True)
    return df.select(F.inline(F.filter(F.array(*found), lambda x: x.isNotNull())))


def declared_rules(tables: Iterable[str]) -> list[tuple[str, str, str]]:
    """(table, rule, kind) of every rule whose tables are given; kind is check, unique or reference."""
    names = list(tables)
    out = []
    for name in names:
        out += [(name, c.rule, "check") for c in schemas.CHECKS if c.table == name]
        out += [(name, f"{c}_not_null", "check") for c in schemas.NOT_NULL[name]]
        out += [(name, "unique_" + "_".join(k.columns), "unique") for k in schemas.UNIQUE_KEYS if k.table == name]
        out += [(name, f"{'_'.join(f.columns)}_in_{f.parent}", "reference") for f in schemas.FOREIGN_KEYS
                if f.table == name and f.parent in names]
    return out


def audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared rule whose tables are given, with its violations, zeros too.

    Each table is scanned once. A row gives an entry for each rule it breaks by itself and for each of
    its complete keys and references; entries of all rules and tables are stacked and counted in one
    shuffle, and the counts of a rule in a second. Counting starts before the first shuffle, so a key
    that holds a large share of the rows is one entry a task there.
    """
    rules = declared_rules(tables)
    numbers = {(table, rule): i for i, (table, rule, _) in enumerate(rules)}
    stacked = union_all(_entries(name, df, numbers) for name, df in tables.items())
    keys = stacked.groupBy("rule", "a", "b").agg(
        F.count_if(~F.col("parent")).alias("n"), F.max("parent").alias("known"))
    spark = keys.sparkSession
    named = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rules)], "number int, table string, rule string, kind string")
    counted = keys.join(F.broadcast(named.select(F.col("number").alias("rule"), "kind")), "rule") \
        .groupBy(F.col("rule").alias("number")).agg(F.sum(
            F.when(F.col("kind") == "unique", F.col("n") - 1)
            .when((F.col("kind") == "reference") & F.col("known"), F.lit(0)).otherwise(F.col("n"))).alias("violations"))
    return named.join(counted, "number", "left").select(
        "table", "rule", F.coalesce("violations", F.lit(0)).alias("violations"))


def chunk_violations(chunks: DataFrame) -> DataFrame:
    """Chunks that break any chunk rule, with the names of the broken rules."""
    rules = [c for c in schemas.CHECKS if c.table == "chunks"]
    broken = F.filter(
        F.array(*[F.when(~F.expr(c.valid), F.lit(c.rule)) for c in rules]),
        lambda rule: rule.isNotNull())
    return chunks.withColumn("broken_rules", broken).filter(F.size("broken_rules") > 0)


def lineage_gaps(points: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count of each lineage column, one scan."""
    return row_checks("points", points, {}, columns)


def unfinished(rows: DataFrame, status: str, final: Sequence[str]) -> DataFrame:
    """Rows that have not ended in a final state."""
    return rows.filter(~F.coalesce(F.col(status).isin(*final), F.lit(False)))


def duplicate_effects(effects: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Artifacts, chunks or points stored more than once under one key."""
    return union_all(key_check(name, df, keys) for name, (df, keys) in effects.items())
