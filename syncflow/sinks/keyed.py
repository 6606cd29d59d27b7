"""Keyed mirror: one row per key, replaced or removed by later changes.

Parquet has no MERGE, so rows live in hash buckets and a load writes new files for the
buckets it touches: either the bucket as it is afterwards (merge on write), or just its
changes, which readers then merge (merge on read) until the bucket has so many of them that
it is written anew. Which files make up a bucket is in the commit log, as are schema, keys,
order and the number of buckets; nothing that is being read is ever overwritten, and a load
that breaks off leaves the old state valid. Deleted keys stay behind as marked rows, so that
an older change arriving late cannot bring them back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow import storage
from syncflow.operators.changelog import DELETE, UPSERT, latest_per_key
from syncflow.operators.partitions import BUCKETS, bucket_of
from syncflow.sinks.commits import CommitLog, widened

# Internal columns; a table that has one of its own by such a name is refused.
_KIND, _BUCKET, _VERSION = "_mirror_kind", "_mirror_bucket", "_mirror_version"


class KeyedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        order: Sequence[str],
        buckets: int = BUCKETS,
        kind: str | None = "kind",
        owner: str | None = None,
    ):
        """``order`` names the columns that tell which of two versions of a row is later.

        Choose ``buckets`` by size: a touched bucket is rewritten as a whole. ``kind`` names the
        column of changes that says ``upsert`` or ``delete``; with None every row is an upsert and
        a column of that name is data. ``owner`` names the flow that writes.
        """
        self.spark, self.path = spark, path
        self.keys, self.order, self.buckets = list(keys), list(order), buckets
        self.kind, self.owner = kind, owner
        self.log = CommitLog(spark, path)

    def state(self) -> dict:
        """What the last commit says of the table; it has to agree with how it was opened."""
        last = self.log.last()
        for name in ("keys", "order", "buckets") if last else ():
            if last[name] != getattr(self, name):
                raise ValueError(f"{self.path} has {name} {last[name]}, not {getattr(self, name)}")
        return last

    def files(self, state: dict | None = None) -> dict[int, list[int]]:
        """Versions that make up each bucket, oldest first."""
        state = self.state() if state is None else state
        return {int(b): v for b, v in state.get("files", {}).items()}

    def _scan(self, schema: T.StructType, held: dict[int, list[int]]) -> DataFrame:
        """Stored rows of the given buckets with their marks and versions."""
        inner = [T.StructField(_KIND, T.StringType()), T.StructField(_VERSION, T.LongType())]
        whole = T.StructType([*schema.fields, *inner, T.StructField(_BUCKET, T.IntegerType())])
        paths = [f"{self.path}/data/{_VERSION}={v}/{_BUCKET}={b}" for b, vs in sorted(held.items()) for v in vs]
        if not paths:
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).option("basePath", f"{self.path}/data").parquet(*paths)

    def _latest(self, rows: DataFrame) -> DataFrame:
        """One row per key. Of two with the same place in the order, that of the later load."""
        return latest_per_key(rows, [_BUCKET, *self.keys], [*self.order, _VERSION])

    def read(self) -> DataFrame:
        """Live rows."""
        state = self.state()
        if not state:
            raise FileNotFoundError(f"no load was recorded in {self.path}")
        schema, held = T.StructType.fromJson(state["schema"]), self.files(state)
        waiting = {b: v for b, v in held.items() if len(v) > 1}
        settled = {b: v for b, v in held.items() if len(v) == 1}
        parts = [self._scan(schema, settled)] if settled or not waiting else []
        if waiting:
            parts.append(self._latest(self._scan(schema, waiting)))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return rows.where(F.col(_KIND) != DELETE).select(*schema.names)

    def upsert(
        self, changes: DataFrame, label: str, enable_delete: bool = True, max_deltas: int = 0
    ) -> bool:
        """Apply a load of changes; a label that is in already changes nothing.

        The load is reduced to one row per key first. With ``max_deltas`` the load is only
        added to buckets that have fewer changes than that waiting, which makes a small load on
        a large table cheap; the other buckets it touches are read once, shuffled once by
        bucket and rewritten.
        """
        if self.log.has(label, self.owner):
            return False
        clash = {_KIND, _BUCKET, _VERSION} & set(changes.columns)
        if clash:
            raise ValueError(f"columns of these names are not possible: {sorted(clash)}")
        state = self.state()
        if self.kind in changes.columns:
            changes = changes.withColumnRenamed(self.kind, _KIND)
        else:
            changes = changes.withColumn(_KIND, F.lit(UPSERT))
        if not enable_delete:
            changes = changes.where(F.col(_KIND) != DELETE)
        offered = T.StructType([f for f in changes.schema if f.name != _KIND])
        schema = widened(state.get("schema"), offered)
        version, held = self.log.head() + 1, self.files(state)
        batch = changes.select(
            *[
                (F.col(f"`{f.name}`") if f.name in offered.names else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema
            ],
            _KIND, F.lit(version).cast("bigint").alias(_VERSION), self._bucket(schema),
        )
        full = {b: v for b, v in held.items() if len(v) > max_deltas}
        if not full:
            self._write(self._latest(batch).hint("rebalance", _BUCKET), version)
        else:
            batch = self._latest(batch).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                # At most one number per bucket comes to the driver.
                touched = [r[0] for r in batch.select(_BUCKET).distinct().collect()]
                full = {b: full[b] for b in touched if b in full}
                self._write(self._merged(schema, full, batch), version)
            finally:
                batch.unpersist()
        written = self._written(version)
        files = held | {b: [version] if b in full else [*held.get(b, []), version] for b in written}
        self.log.record(
            label, self.owner, schema=schema.jsonValue(), keys=self.keys, order=self.order,
            buckets=self.buckets, files=files,
        )
        return True

    def _merged(self, schema: T.StructType, full: dict[int, list[int]], batch: DataFrame) -> DataFrame:
        """The reduced load, and with it the latest rows of the buckets that are written anew.

        Dealt out by bucket, the rows of a key are together, and ready to be written.
        """
        if not full:
            return batch.hint("rebalance", _BUCKET)
        names = [*schema.names, _KIND, _VERSION, _BUCKET]
        both = self._scan(schema, full).select(*names).unionByName(batch.select(*names))
        return self._latest(both.repartition(_BUCKET))

    def _bucket(self, schema: T.StructType) -> Column:
        return bucket_of(self.keys, self.buckets, schema).alias(_BUCKET)

    def _write(self, rows: DataFrame, version: int) -> None:
        (
            rows.drop(_VERSION).write.partitionBy(_BUCKET)
            # The whole version: a load that broke off may have left other buckets there.
            .mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .parquet(f"{self.path}/data/{_VERSION}={version}")
        )

    def _written(self, version: int) -> list[int]:
        names = storage.child_names(self.spark, f"{self.path}/data/{_VERSION}={version}")
        return [int(n.partition("=")[2]) for n in names if n.startswith(f"{_BUCKET}=")]

    def drop_old_versions(self) -> int:
        """Delete bucket files that a later load replaced; run it when nobody reads them."""
        held, removed = self.files(), 0
        for name in storage.child_names(self.spark, f"{self.path}/data"):
            version = name.removeprefix(f"{_VERSION}=")
            if not version.isdigit():
                continue
            for bucket in self._written(int(version)):
                if int(version) < held.get(bucket, [-1])[0]:
                    path = f"{self.path}/data/{name}/{_BUCKET}={bucket}"
                    removed += storage.delete(self.spark, path)
        return removed
