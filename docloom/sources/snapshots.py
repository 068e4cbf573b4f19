"""Tables in a shared folder: immutable base generations plus logs of changes and additions.

Every write goes to its own folder, named by the writing stage, its run and its batch. A replayed
batch overwrites only its own folder, so each batch takes effect once; a micro-batch never rewrites
a large table. ``current`` lays the changes over the newest base, ``compact`` folds logs into the
next base, which lists the batches it holds: their folders are not read again. The last batch of a
run may be replayed and must not see itself, so it is never folded.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import schemas
from docloom.operators.tables import last_per_key, upsert

ROW_KEY = ("tenant_id", "id")
_FOLDED = "stage string, run string, batch bigint"


@dataclass(frozen=True)
class Batch:
    """One micro-batch. ``run`` tells apart queries with different checkpoints, whose batch numbers
    both start at zero."""

    stage: str
    run: str
    number: int

    @property
    def path(self) -> str:
        return f"stage={self.stage}/run={self.run}/batch={self.number}"


@dataclass(frozen=True)
class TableStore:
    spark: SparkSession
    root: str

    def _exists(self, path: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def _generation(self, table: str) -> int:
        """Newest published base: the highest generation whose write finished."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}/base")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return -1
        done = [
            int(status.getPath().getName().split("=")[1])
            for status in fs.listStatus(folder)
            if self._exists(status.getPath().toString() + "/_SUCCESS")
        ]
        return max(done, default=-1)

    def _folded(self, table: str) -> dict[tuple[str, str], int]:
        """Last batch of each (stage, run) that the newest base holds; one row per run."""
        path = f"{self.root}/{table}/folded/generation={self._generation(table)}"
        if not self._exists(path):
            return {}
        rows = self.spark.read.schema(_FOLDED).parquet(path).collect()
        return {(r["stage"], r["run"]): r["batch"] for r in rows}

    def _folders(self, table: str, kind: str) -> list[tuple[Batch, str]]:
        """Folders of the batches that were written whole."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}/{kind}/stage=*/run=*/batch=*/_SUCCESS")
        found = []
        for status in root.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(root) or ():
            folder = status.getPath().getParent().toString()
            stage, run, number = (part.split("=", 1)[1] for part in folder.split("/")[-3:])
            found.append((Batch(stage, run, int(number)), folder))
        return found

    def put_base(self, table: str, df: DataFrame, folded: dict[tuple[str, str], int] | None = None) -> None:
        """Publish ``df`` as the next base generation, laid out by tenant, with the batches in it."""
        generation = self._generation(table) + 1
        self.spark.createDataFrame([(*key, n) for key, n in (folded or {}).items()], _FOLDED).coalesce(1) \
            .write.mode("overwrite").parquet(f"{self.root}/{table}/folded/generation={generation}")
        target = f"{self.root}/{table}/base/generation={generation}"
        df.write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .partitionBy("tenant_id").parquet(target)

    def base(self, table: str) -> DataFrame:
        ddl = schemas.STORED[table]
        newest = self._generation(table)
        if newest < 0:
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl) \
            .parquet(f"{self.root}/{table}/base/generation={newest}") \
            .select(*table_columns(table))

    def put(self, table: str, kind: str, df: DataFrame, batch: Batch) -> None:
        """Write one batch of ``added`` or ``changed`` rows, replacing an earlier try of it."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .parquet(f"{self.root}/{table}/{kind}/{batch.path}")

    def _log(self, table: str, kind: str, columns: str, skip: Batch | None,
             upto: dict[tuple[str, str], int] | None = None) -> DataFrame:
        """Rows of the batches that the base does not hold; ``upto`` bounds them from above."""
        ddl = f"{columns}, stage string, run string, batch bigint"
        folded = self._folded(table)
        paths = [path for batch, path in self._folders(table, kind)
                 if batch != skip and batch.number > folded.get((batch.stage, batch.run), -1)
                 and (upto is None or batch.number <= upto.get((batch.stage, batch.run), -1))]
        if not paths:
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).option("basePath", f"{self.root}/{table}/{kind}").parquet(*paths)

    def added(self, table: str, skip: Batch | None = None,
              upto: dict[tuple[str, str], int] | None = None) -> DataFrame:
        """Base and all added rows. ``skip`` leaves out one batch: a batch must not see itself."""
        log = self._log(table, "added", schemas.STORED[table], skip, upto).select(*table_columns(table))
        return log if self._generation(table) < 0 else self.base(table).unionByName(log)

    def current(self, table: str, skip: Batch | None = None, only: DataFrame | None = None,
                upto: dict[tuple[str, str], int] | None = None) -> DataFrame:
        """Added rows with the latest change per column laid over them.

        ``only`` names the rows wanted by some of their columns. It is applied before anything is
        shuffled: a small batch of keys prunes tenants and leaves the rest of the table unread.

        A change row carries ``applied_at`` and ``event_offset``; later ones win column by column.
        At the same instant the later stage wins.
        """
        ddl = schemas.STORED[table]
        rows = self.added(table, skip, upto)
        if only is not None:
            rows = rows.join(only, only.columns, "left_semi").select(*table_columns(table))
        if not self._exists(f"{self.root}/{table}/changed"):
            return rows
        changes = self._log(
            table, "changed", f"{ddl}, applied_at timestamp, event_offset bigint", skip, upto)
        if only is not None:
            changes = changes.join(rows.select(*ROW_KEY), list(ROW_KEY), "left_semi")
        columns = [c for c in table_columns(table)
                   if c not in (*ROW_KEY, "created_at", "updated_at", "deleted_at")]
        order = F.array(*[F.lit(name) for name in schemas.STAGES])
        stage = F.array_position(order, F.col("stage"))
        latest = last_per_key(
            changes.withColumn("_at", F.struct("applied_at", stage, "event_offset"))
            .drop("updated_at").withColumnRenamed("applied_at", "updated_at"),
            ROW_KEY, "_at", columns + ["updated_at"])
        return upsert(rows, latest, ROW_KEY).select(*table_columns(table))

    def compact(self, table: str) -> None:
        """Fold the base and every batch but the last of each run into the next base."""
        folded = self._folded(table)
        last: dict[tuple[str, str], int] = {}
        for kind in ("added", "changed"):
            for batch, _ in self._folders(table, kind):
                key = (batch.stage, batch.run)
                last[key] = max(last.get(key, -1), batch.number)
        upto = {**folded, **{key: max(n - 1, folded.get(key, -1)) for key, n in last.items()}}
        self.put_base(table, self.current(table, upto=upto), {key: n for key, n in upto.items() if n >= 0})


def table_columns(table: str) -> Sequence[str]:
    return schemas.field_names(schemas.STORED[table])
