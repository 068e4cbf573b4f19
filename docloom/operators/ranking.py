"""Order-based work inside groups of any size: a distributed prefix scan.

A window over a group puts the whole group into one task. Here the rows are dealt by ranges of
(key, order), so that a group of all rows spreads over all tasks. Each task scans its sorted range
once, row after row, and knows everything but what comes before its first row; that is one carried
row per range, which a prefix sum over the ranges gives. There is no size from which on a group is
treated differently.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.session import cut_lineage

RANGE, ROW, PLACE, BEFORE, OPENING = "_range", "_row", "_place", "_before", "_opening"


def _breaks(batch: pa.RecordBatch, names: Sequence[str], last: dict) -> np.ndarray:
    """Which rows of a sorted batch begin a group; ``last`` is the key of the row before it."""
    found = np.zeros(batch.num_rows, bool)
    for name in names:
        column = batch.column(name)
        before = pa.concat_arrays([pa.array([last[name]] if last else [None], column.type), column.slice(0, len(column) - 1)])
        differ = pc.or_(pc.fill_null(pc.not_equal(column, before), False),
                        pc.not_equal(pc.is_null(column), pc.is_null(before)))
        found |= differ.to_numpy(zero_copy_only=False)
    found[0] |= not last
    return found


def _scanned(ordered: DataFrame, keys: Sequence[str], value: str | None) -> DataFrame:
    """Each range's rows with their place in the range's part of their group.

    ``_before`` is ``value`` of the row before, null at the first row of a group's part, and
    ``_opening`` marks the rows of the group that a range begins with: it may have begun earlier.
    """
    kind = ordered.schema[value].dataType if value else T.NullType()
    added = [T.StructField(RANGE, T.IntegerType()), T.StructField(ROW, T.LongType()), T.StructField(PLACE, T.LongType()),
             T.StructField(OPENING, T.BooleanType()), *([T.StructField(BEFORE, kind)] if value else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        here = TaskContext.get().partitionId()
        last: dict = {}
        rows, place, groups, held = 0, 0, 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            first = _breaks(batch, keys, last) if keys else np.arange(n) == (0 if not rows else -1)
            starts = np.flatnonzero(first)
            at = np.arange(n, dtype=np.int64)
            start = np.where(np.cumsum(first) > 0, starts[np.maximum(np.cumsum(first) - 1, 0)] if len(starts) else 0, -place)
            places = at - start + 1
            group = groups + np.cumsum(first)
            columns = [pa.array(np.full(n, here, np.int32)), pa.array(at + rows), pa.array(places),
                       pa.array(group == 1)]
            if value:
                own = batch.column(value)
                moved = pa.concat_arrays([held if held is not None else pa.nulls(1, own.type), own.slice(0, n - 1)])
                columns.append(pc.if_else(pa.array(first), pa.nulls(n, own.type), moved))
                held = own.slice(n - 1)
            last = {k: batch.column(k)[n - 1] for k in keys} or {"": None}
            rows, place, groups = rows + n, int(places[-1]), int(group[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *(f.name for f in added)])

    return ordered.mapInArrow(run, T.StructType([*ordered.schema.fields, *added]))


def _scan(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str | None = None) -> DataFrame:
    """``df`` with ``_place``, its 1-based place in its group, and ``_before``, ``value`` one row before.

    The scanned rows are written to the shared folder: ranges are drawn by sampling, so the carried
    rows must come from the very ranges that were scanned.
    """
    by = [*keys, *order]
    spread = df.repartitionByRange(*by) if keys else df.repartitionByRange(*order)
    scanned = cut_lineage(_scanned(spread.sortWithinPartitions(*by), keys, value))
    key = F.struct(F.lit(0).alias("_"), *keys)
    ends = scanned.groupBy(RANGE).agg(
        F.min_by(key, ROW).alias("first"), F.max_by(key, ROW).alias("last"),
        F.max_by(PLACE, ROW).alias("length"),
        *([F.max_by(F.struct(F.col(value).alias("v")), ROW).alias("end")] if value else []))
    # One row per range: this window is as long as the list of tasks, never as the data.
    so_far = Window.partitionBy("last").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, 0)
    in_turn = Window.orderBy(RANGE)
    carried = ends.withColumn("sum", F.sum("length").over(so_far)) \
        .withColumn("same", F.lag("last").over(in_turn).eqNullSafe(F.col("first"))) \
        .select(RANGE, F.when(F.col("same"), F.lag("sum").over(in_turn)).otherwise(F.lit(0)).alias("_carry"),
                *([F.when(F.col("same"), F.lag("end").over(in_turn)["v"]).alias("_end")] if value else []))
    joined = scanned.join(F.broadcast(carried), RANGE) \
        .withColumn(PLACE, F.col(PLACE) + F.when(F.col(OPENING), F.col("_carry")).otherwise(F.lit(0)))
    if value:
        # Only the very first row of a range can follow a row of another one.
        joined = joined.withColumn(BEFORE, F.when(F.col(ROW) == 0, F.col("_end")).otherwise(F.col(BEFORE))).drop("_end")
    return joined.drop(RANGE, ROW, OPENING, "_carry")


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str) -> DataFrame:
    """1-based position of each row in its group, equal to ``row_number()`` over the group.

    Without ``keys`` the whole table is one group. ``order`` should leave no ties; tied rows take
    consecutive numbers in any order. An empty table stays empty.
    """
    return _scan(df, keys, order).withColumnRenamed(PLACE, name)


def previous(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """``lag(value)`` over the group in ``order``: null for a group's first row."""
    return _scan(df, keys, order, value).drop(PLACE).withColumnRenamed(BEFORE, name)
