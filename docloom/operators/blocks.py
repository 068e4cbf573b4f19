"""Tables in blocks: many rows travel as one row with an Arrow payload, and two tables meet by blocks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20
BROADCAST_BYTES = 32 << 20  # measured size up to which the smaller side goes to every task


def written(rows: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write(rows)
    return sink.getvalue().to_pybytes()


def unpacked(payload) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(payload)).read_all().combine_chunks()


def in_blocks(df: DataFrame, key: str, limit: int = BLOCK_BYTES) -> DataFrame:
    """(key, payload): the other columns of ``df``, rows of one key that follow each other together.

    A payload holds about ``limit`` bytes; one row above that is a block of its own.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, now = [], 0, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now], keys), pa.array([written(pa.Table.from_batches(held))], pa.binary())], names=[key, "payload"])

        for batch in batches:
            own, keys = batch.column(key), batch.schema.field(key).type
            rest = batch.drop_columns([key])
            rows = max(1, int(limit * rest.num_rows / max(1, rest.nbytes)))
            low = 0
            while low < batch.num_rows:
                first, high = own[low].as_py(), min(low + rows, batch.num_rows)
                while own[high - 1].as_py() != first:
                    high -= 1
                if held and (first != now or size >= limit):
                    yield out()
                    held, size = [], 0
                now = first
                held.append(rest.slice(low, high - low))
                size += rest.nbytes * (high - low) // batch.num_rows
                low = high
        if held:
            yield out()

    return df.mapInArrow(run, f"{key} {kind}, payload binary")


def meet(blocks: DataFrame, others: DataFrame, count: int, size: int) -> DataFrame:
    """Every payload of ``blocks`` beside every one of ``others`` (part, payload): (part, payload, other).

    ``others`` has parts 0 to ``count`` - 1 of ``size`` bytes in all. Up to ``BROADCAST_BYTES`` they go
    to every task and no block moves. Beyond, both sides are dealt by (part, slice): ``blocks``, the
    larger side, moves once per part and ``others`` once per slice.
    """
    parts = F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    other = others.withColumnRenamed("payload", "other")
    if size <= BROADCAST_BYTES:
        return blocks.select(parts.alias("part"), "payload").join(F.broadcast(other), "part")
    slices = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.select(parts.alias("part"), F.pmod(F.xxhash64("payload"), F.lit(slices)).alias("slice"), "payload") \
        .join(other.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slices - 1).cast("bigint")))),
              ["part", "slice"]).select("part", "payload", "other")
