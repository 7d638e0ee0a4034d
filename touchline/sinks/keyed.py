"""A table with one row per key, whatever the time between two copies.

Rows lie in buckets of their key's hash, one folder per batch and bucket. With each of them goes a Bloom filter of its
keys. A batch asks the filters first: only keys that a filter may hold are looked up, and only in the folders whose filter
said so; all other folders stay unread. A filter never denies a key that is there, so the first copy to
arrive is kept and later ones are dropped, exactly and without a horizon.

A repeated batch replaces its own folder. ``compact`` rewrites all folders of a bucket as one, in a new
generation that readers see once it is complete. Batches of one table must not run at the same time.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import scratch_path, stored
from touchline.sinks.slots import run_of

logger = logging.getLogger(__name__)

#: Bits per key and probes of a filter: about one key in a hundred is looked up in vain.
BITS, PROBES = 10, 4
_FILTER = "slot string, bucket int, keys long, bits binary"
_NO_SLOT = "\x00"


@dataclass(frozen=True)
class Lookup:
    """What a batch cost: folders and files that were read, of how many folders; different keys in, and rows written."""

    folders: int
    folders_read: int
    files_read: int
    rows: int
    written: int


def _places(hashed: np.ndarray, size: int) -> np.ndarray:
    """Bits of each hash in a filter of ``size`` bits, by double hashing."""
    x = hashed.astype(np.int64).view(np.uint64)
    step = (x >> np.uint64(32)) | np.uint64(1)
    return (x[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) % np.uint64(size)


def bloom_bits(hashed: np.ndarray) -> bytes:
    """The filter of some keys' hashes."""
    size = max(64, len(hashed) * BITS)
    bits = np.zeros(size, dtype=bool)
    bits[_places(hashed, size).ravel().astype(np.int64)] = True
    return np.uint32(size).tobytes() + np.packbits(bits, bitorder="little").tobytes()


def may_hold(bits: bytes, hashed: np.ndarray) -> np.ndarray:
    """Whether each hash may be among the keys of a filter."""
    size = int(np.frombuffer(bits[:4], dtype=np.uint32)[0])
    words = np.frombuffer(bits, dtype=np.uint8, offset=4)
    at = _places(hashed, size).astype(np.int64)
    return ((words[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def _built(keys: pa.Table) -> pa.Table:
    hashed = keys["h"].to_numpy()
    return pa.table(
        {
            "slot": pa.array([keys["slot"][0].as_py()], pa.string()),
            "bucket": pa.array([keys["bucket"][0].as_py()], pa.int32()),
            "keys": pa.array([len(hashed)], pa.int64()),
            "bits": pa.array([bloom_bits(hashed)], pa.binary()),
        }
    )


def _asked(keys: pa.Table, filters: pa.Table) -> pa.Table:
    """(slot, bucket, h) of the keys of a bucket that a filter may hold."""
    hashed = keys["h"].to_numpy()
    out: dict[str, list] = {"slot": [], "bucket": [], "h": []}
    for row in filters.select(["slot", "bucket", "bits"]).to_pylist() if len(hashed) else []:
        found = hashed[may_hold(row["bits"], hashed)]
        out["slot"] += [row["slot"]] * len(found)
        out["bucket"] += [row["bucket"]] * len(found)
        out["h"] += found.tolist()
    return pa.table(out, schema=pa.schema([("slot", pa.string()), ("bucket", pa.int32()), ("h", pa.int64())]))


class KeyedTable:
    """``foreachBatch`` sink: of all rows with the same ``key`` the first to arrive stays; rows without key all stay.

    ``order`` decides between copies inside one batch, smallest first.
    """

    def __init__(
        self, path: str, key: str, order: Sequence[str] = (), buckets: int = 64, run: str | None = None
    ) -> None:
        self._path, self._key, self._order = path, key, list(order)
        self._buckets, self._run = buckets, run
        self.lookups: list[Lookup] = []

    # --- writing -------------------------------------------------------------------

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        slot = f"{run_of(batch_df, self._run)}-{batch_id}"
        home = self._generation(spark)
        kept = scratch_path(spark, "batch")
        try:
            self._numbered(batch_df).write.parquet(f"{kept}/rows")
            self._firsts(spark.read.parquet(f"{kept}/rows")).write.parquet(f"{kept}/firsts")
            self.lookups.append(self._merge(spark, home, slot, kept, batch_df))
        finally:
            fs, folder = self._fs(spark, kept)
            fs.delete(folder, True)
        logger.info("batch %s of %s: %s", batch_id, self._path, self.lookups[-1])

    def _merge(self, spark: SparkSession, home: str, slot: str, kept: str, batch_df: DataFrame) -> Lookup:
        """Write the rows of the stored batch whose keys are new; which they are is found on keys and row numbers alone."""
        batch, firsts = spark.read.parquet(f"{kept}/rows"), spark.read.parquet(f"{kept}/firsts")
        filters = self._filters(spark, home).where(F.col("slot") != slot)
        asked = stored(
            firsts.select("bucket", "h").where("h IS NOT NULL").groupBy("bucket")
            .cogroup(filters.groupBy("bucket"))
            .applyInArrow(_asked, "slot string, bucket int, h long"),
            "asked",
        )
        # One row per folder, so no more than the table has folders.
        folders = asked.select("slot", "bucket").distinct().collect()
        fresh, files = firsts, 0
        if folders:
            paths = [f"{home}/rows/slot={r.slot}/bucket={r.bucket}" for r in folders]
            there = spark.read.schema(batch_df.select(self._key).schema).parquet(*paths)
            files = len(there.inputFiles())
            suspects = there.withColumn("h", F.xxhash64(self._key)).join(asked.select("h").distinct(), "h", "left_semi")
            fresh = firsts.join(suspects.select(self._key).distinct(), self._key, "left_anti")
        rows = batch.join(fresh.select("_row").hint("shuffle_hash"), "_row", "left_semi")
        self._write(rows.select(*batch_df.columns, "bucket"), home, slot)
        written = spark.read.schema(batch_df.schema).parquet(f"{home}/rows/slot={slot}").count()
        return Lookup(filters.count(), len(folders), files, firsts.count(), written)

    def _numbered(self, rows: DataFrame) -> DataFrame:
        """Rows with a number, their key's hash and its bucket; rows without key are spread over the buckets."""
        h = F.when(F.col(self._key).isNotNull(), F.xxhash64(self._key))
        spread = F.pmod(F.coalesce("h", F.xxhash64("_row")), F.lit(self._buckets))
        numbered = rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("h", h)
        return numbered.withColumn("bucket", spread.cast("int"))

    def _firsts(self, numbered: DataFrame) -> DataFrame:
        """Number, key, hash and bucket of the first copy of each key, and of each row without key, which is copy of nothing."""
        first = F.min(F.struct(*(F.col(c).alias(f"_{n}") for n, c in enumerate(self._order)), "_row", "h", "bucket"))
        keyed = numbered.where(F.col(self._key).isNotNull()).groupBy(self._key).agg(first.alias("_first"))
        alone = numbered.where(F.col(self._key).isNull()).select(self._key, "_row", "h", "bucket")
        return keyed.select(self._key, "_first._row", "_first.h", "_first.bucket").unionByName(alone)

    def _write(self, rows: DataFrame, home: str, slot: str) -> None:
        """Rows first, then their filters: a folder without filter belongs to a batch that will be repeated."""
        spark, folder = rows.sparkSession, f"{home}/rows/slot={slot}"
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        back = spark.read.schema(rows.schema).parquet(folder)
        keys = back.where(F.col(self._key).isNotNull()).select(
            F.lit(slot).alias("slot"), "bucket", F.xxhash64(self._key).alias("h")
        )
        made = keys.groupBy("slot", "bucket").applyInArrow(_built, _FILTER)
        made.select("bucket", "keys", "bits").write.mode("overwrite").parquet(f"{home}/filters/slot={slot}")

    def compact(self, spark: SparkSession) -> None:
        """All rows in one folder per bucket. Call it between batches; a failed call changes nothing."""
        home = self._generation(spark)
        slots = [r.slot for r in self._filters(spark, home).select("slot").distinct().collect()]
        if not slots:
            return
        following = f"{self._path}/generation={self._number(home) + 1}"
        rows = spark.read.option("basePath", f"{home}/rows").parquet(*[f"{home}/rows/slot={s}" for s in slots])
        self._write(rows.drop("slot"), following, "compact")
        fs, ready = self._fs(spark, f"{following}/READY")
        fs.create(ready, True).close()
        fs, old = self._fs(spark, home)
        fs.delete(old, True)

    # --- reading -------------------------------------------------------------------

    def read(self, spark: SparkSession, schema: str | None = None) -> DataFrame:
        """All rows of the table; a table without rows has to be told its schema."""
        home = self._generation(spark)
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(f"{home}/rows").drop("slot", "bucket")

    def _filters(self, spark: SparkSession, home: str) -> DataFrame:
        fs, folder = self._fs(spark, f"{home}/filters")
        if not fs.exists(folder):
            return spark.createDataFrame([], _FILTER)
        return spark.read.schema(_FILTER).parquet(f"{home}/filters")

    @staticmethod
    def _fs(spark: SparkSession, path: str):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(spark._jsc.hadoopConfiguration()), at

    @staticmethod
    def _number(home: str) -> int:
        return int(home.rsplit("=", 1)[1])

    def _generation(self, spark: SparkSession) -> str:
        """The folder of the newest complete generation."""
        fs, top = self._fs(spark, self._path)
        found = [0]
        if fs.exists(top):
            for entry in fs.listStatus(top):
                name = entry.getPath().getName()
                ready = spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "READY")
                if name.startswith("generation=") and fs.exists(ready):
                    found.append(self._number(name))
        return f"{self._path}/generation={max(found)}"
