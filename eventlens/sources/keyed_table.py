"""A table of files with last-wins updates by key, folded together from time to time.

Every batch writes its last rows below ``batches``, in folders by a hash of the key. A
compaction merges the waiting batches into new base files, only for the buckets they touch,
and then commits a manifest that names each bucket's base folder and the last batch taken in.
The manifest with the highest number holds; it appears whole or not at all, and of two
compactions at the same time one commits and the other one's files stay unread. Until the
manifest is there, readers see the old one, so an interrupted compaction loses nothing.

Readers merge waiting batches with the base of the buckets they touch; the other buckets are
read as they are, without a shuffle.

Defined results
    batch ids grow; a batch that is written again replaces itself, and one that a compaction
    has taken in changes nothing any more
    ties: within a batch by ``order`` and then by the whole row, between batches the later one
    null keys are keys; rows of a key that never came are not there; no batch: no rows
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventlens.operators.upsert import latest_per_key
from eventlens.sources import files

BUCKETS = 64


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str],
                 order: Sequence[str] = (), buckets: int = BUCKETS):
        """``buckets`` counts when the table is new; afterwards the manifest says."""
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.order, self.buckets = list(key), list(order), buckets

    # --- manifests

    def manifest(self) -> dict:
        """The one that holds: number, buckets, last batch taken in, base folder by bucket."""
        found = [n for n in files.names(self.spark, f"{self.path}/manifests") if n.endswith(".json") and not n.startswith(".")]
        if not found:
            first = {"number": 0, "buckets": self.buckets, "through": -1, "base": {}}
            files.write_new(self.spark, self._manifest(0), json.dumps(first))
            return self.manifest()
        return json.loads(files.read_text(self.spark, f"{self.path}/manifests/{found[-1]}"))

    def _manifest(self, number: int) -> str:
        return f"{self.path}/manifests/{number:012d}.json"

    def _waiting(self, manifest: dict) -> list[int]:
        ids = [int(n.removeprefix("batch_id=")) for n in files.names(self.spark, f"{self.path}/batches") if n.startswith("batch_id=")]
        done = [i for i in ids if i > manifest["through"] and "_SUCCESS" in files.names(self.spark, f"{self.path}/batches/batch_id={i}")]
        return sorted(done)

    # --- writing

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """The batch's last row of each key. The cost is the batch's, not the table's."""
        manifest = self.manifest()
        if batch_id <= manifest["through"]:
            return      # taken in already
        last = latest_per_key(rows.select(*self.schema.names), self.key, self.order)
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(manifest["buckets"])).cast("int")
        (last.withColumn("_bucket", bucket).write.mode("overwrite").partitionBy("_bucket")
         .parquet(f"{self.path}/batches/batch_id={batch_id}"))

    def _stored(self, *extra: T.StructField) -> T.StructType:
        return T.StructType([*self.schema.fields, *extra])

    def _batches(self, ids: list[int]) -> DataFrame:
        """Rows of the waiting batches with ``_batch`` and ``_bucket``."""
        rows = (self.spark.read.schema(self._stored(T.StructField("_bucket", T.IntegerType()), T.StructField("batch_id", T.LongType())))
                .option("basePath", f"{self.path}/batches").parquet(*[f"{self.path}/batches/batch_id={i}" for i in ids]))
        return rows.withColumnRenamed("batch_id", "_batch")

    def _base(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def _merged(self, manifest: dict, ids: list[int]) -> tuple[DataFrame, list[str]]:
        """The rows of the touched buckets, and these buckets."""
        waiting = self._batches(ids)
        touched = sorted(str(r[0]) for r in waiting.select("_bucket").distinct().collect())
        base = self._base([manifest["base"][b] for b in touched if b in manifest["base"]])
        both = base.withColumn("_batch", F.lit(-1).cast("long")).unionByName(waiting.drop("_bucket"))
        return latest_per_key(both, self.key, ["_batch"]).drop("_batch"), touched

    def compact(self) -> bool:
        """Fold the waiting batches into the base; false if there are none, or another
        compaction was faster."""
        manifest = self.manifest()
        ids = self._waiting(manifest)
        if not ids:
            return False
        rows, touched = self._merged(manifest, ids)
        number = manifest["number"] + 1
        token = self.spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()
        folder = f"base/{number:012d}-{token}"
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(manifest["buckets"])).cast("int")
        rows.withColumn("_bucket", bucket).write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        base = manifest["base"] | {b: f"{folder}/_bucket={b}" for b in touched}
        return self._commit({"number": number, "buckets": manifest["buckets"], "through": ids[-1], "base": base})

    def _commit(self, manifest: dict) -> bool:
        return files.write_new(self.spark, self._manifest(manifest["number"]), json.dumps(manifest))

    def vacuum(self) -> None:
        """Remove what the manifest that holds does not name: for a time without readers of
        older ones and without a compaction under way."""
        manifest = self.manifest()
        used = {f.split("/")[1] for f in manifest["base"].values()}
        for name in files.names(self.spark, f"{self.path}/base"):
            if name not in used:
                files.remove(self.spark, f"{self.path}/base/{name}")
        for name in files.names(self.spark, f"{self.path}/batches"):
            if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= manifest["through"]:
                files.remove(self.spark, f"{self.path}/batches/{name}")

    # --- reading

    def read(self) -> DataFrame:
        """The last row of every key."""
        manifest = self.manifest()
        ids = self._waiting(manifest)
        if not ids:
            return self._base(list(manifest["base"].values()))
        rows, touched = self._merged(manifest, ids)
        alone = [f for b, f in manifest["base"].items() if b not in touched]
        return rows.unionByName(self._base(alone)) if alone else rows

    def lookup(self, *keys: tuple) -> DataFrame:
        """The rows of a few keys; only their buckets are read."""
        manifest = self.manifest()
        kinds = [self.schema[k] for k in self.key]
        wanted = self.spark.createDataFrame([tuple(k) for k in keys], T.StructType(kinds))
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(manifest["buckets"])).cast("int")
        buckets = {str(r[0]) for r in wanted.select(bucket).distinct().collect()}
        rows = self._base([f for b, f in manifest["base"].items() if b in buckets]).withColumn("_batch", F.lit(-1).cast("long"))
        ids = self._waiting(manifest)
        if ids:
            rows = rows.unionByName(self._batches(ids).where(F.col("_bucket").isin(*map(int, buckets))).drop("_bucket"))
        equal = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(wanted[k]) for k in self.key])
        return latest_per_key(rows.join(F.broadcast(wanted), equal, "left_semi"), self.key, ["_batch"]).drop("_batch")
