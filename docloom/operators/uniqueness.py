"""First-wins admission under one or more unique keys."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.operators.graph import components
from docloom.session import cut_lineage


def first_per_key(df: DataFrame, keys: Sequence[str], *order) -> DataFrame:
    """First row per key. Each map partition keeps one row per key before the shuffle."""
    place = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(place)).filter("_place = 1").drop("_place")


def repeated_keys(df: DataFrame, keys: Sequence[str], count: str = "copies") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


ACCEPTED, REFUSED, OPEN = "accepted", "refused", "open"


def _round(rows: DataFrame, unique_keys: Sequence[Sequence[str]], order: str) -> DataFrame:
    """One round of admission: every row with its ``state``.

    A row that is first on all its keys is accepted. Only the first row of a key can be accepted
    for it in this round, so any other row is refused exactly if the first row of one of its keys
    is accepted. First rows come from partial aggregates of the keys that two or more rows share:
    a hot key is one row there, and the joins see a small side.
    """
    marked, leads = rows, []
    for number, keys in enumerate(unique_keys):
        lead = f"_lead{number}"
        shared = rows.groupBy(*keys) \
            .agg(F.min(order).alias(lead), F.count(F.lit(1)).alias("_n")) \
            .filter("_n > 1").drop("_n")
        marked = marked.join(shared, list(keys), "left") \
            .withColumn(lead, F.coalesce(lead, order))
        leads.append(lead)
    is_first = reduce(lambda a, b: a & b, [F.col(lead) == F.col(order) for lead in leads])
    firsts = marked.filter(is_first).select(order)
    blocked = F.lit(False)
    settled = marked.withColumn("_first", is_first)
    for lead in leads:
        hit = f"{lead}_hit"
        settled = settled.join(
            firsts.select(F.col(order).alias(lead), F.lit(True).alias(hit)), lead, "left")
        blocked = blocked | F.col(hit).isNotNull()
    state = F.when(F.col("_first"), F.lit(ACCEPTED)).when(blocked, F.lit(REFUSED)) \
        .otherwise(F.lit(OPEN))
    return settled.select(*rows.columns, state.alias("state"))


def _settled(rows: DataFrame, unique_keys: Sequence[Sequence[str]], order: str) -> DataFrame:
    """Order values accepted among ``rows``, each connected group by itself and in its order.

    A row is linked to the first row of each of its keys, which connects all that share one. The rows
    of a group follow each other through one task, which holds the keys taken so far and no rows.
    """
    links = None
    for keys in unique_keys:
        lead = rows.groupBy(*keys).agg(F.min(order).alias("_lead"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        own = rows.join(lead, list(keys)).select(F.col(order).alias("_row"), "_lead")
        links = own if links is None else links.unionByName(own)
    roots = components(links, "_row", "_lead")
    columns = sorted({c for keys in unique_keys for c in keys})
    grouped = rows.join(roots, F.col(order) == F.col("node"), "left") \
        .select(F.coalesce("root", order).alias("_root"), F.col(order).alias("_order"), *columns) \
        .repartition("_root").sortWithinPartitions("_root", "_order")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, taken = None, set()
        for batch in batches:
            rows = {name: batch.column(name).to_pylist() for name in batch.schema.names}
            kept = []
            for i, root in enumerate(rows["_root"]):
                if root != group:
                    group, taken = root, set()
                held = [(n, *(rows[c][i] for c in keys)) for n, keys in enumerate(unique_keys)]
                if taken.isdisjoint(held):
                    taken.update(held)
                    kept.append(i)
            yield pa.RecordBatch.from_arrays([batch.column("_order").take(pa.array(kept, pa.int64()))], names=[order])

    return grouped.mapInArrow(run, T.StructType([rows.schema[order]]))


def admit_first(rows: DataFrame, unique_keys: Sequence[Sequence[str]], order: str) -> DataFrame:
    """Order values of the rows that one-at-a-time insertion would accept.

    A row is refused only when an earlier *accepted* row holds one of its keys; a refused row
    blocks nobody. The outcome therefore depends on chains of rows linked through different keys.
    Rounds over the rows still open settle hot keys and random orders, at least half of the rows in
    each; when a round leaves more, as along a sorted chain, the connected groups that are left are
    settled by themselves. Jobs grow with the logarithm of the rows, whatever the chains.

    ``rows`` carries ``order`` (unique) and the key columns, all non-null. No rows give none.
    """
    state = cut_lineage(_round(rows, unique_keys, order))
    accepted = state.filter(F.col("state") == ACCEPTED).select(order)
    still_open = state.filter(F.col("state") == OPEN).drop("state")
    left = still_open.count()
    while left:
        state = cut_lineage(_round(still_open, unique_keys, order))
        accepted = accepted.union(state.filter(F.col("state") == ACCEPTED).select(order))
        still_open = state.filter(F.col("state") == OPEN).drop("state")
        before, left = left, still_open.count()
        if left > before // 2:
            return accepted.union(_settled(still_open, unique_keys, order))
    return accepted
