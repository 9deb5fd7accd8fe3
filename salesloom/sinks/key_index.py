"""Which landed folders may hold a key: ranges and Bloom filters beside append-only folders.

Each landed folder gets one index entry: the count, the smallest and the largest of its keys, and a Bloom filter cut into bitmaps of 32,768
bits, BITS a key. Before a batch is compared with the history, its keys are tried against the filters of the folders whose range it
meets; only folders that may hold one of them are read. A filter never misses a key it has seen, so the comparison stays exact; a
needless folder is read for some keys in a hundred at most.

An entry is a folder of its own, `folder=<name>` under the index, replaced as a whole when its batch runs again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 12
HASHES = 4
BITMAP = 32_768
_SHAPE = "pages bigint, page bigint, bits binary, low bigint, high bigint, keys bigint, folder string"


def _places(key: Column, pages: Column) -> Column:
    """Bitmap page and bit of a key for each hash, in a filter of so many pages (a power of two)."""
    spots = [F.pmod(F.xxhash64(key, F.lit(seed)), pages * BITMAP) for seed in range(HASHES)]
    return F.array(*[F.struct(F.floor(s / BITMAP).alias("page"), (s % BITMAP).alias("bit")) for s in spots])


@dataclass(frozen=True)
class KeyIndex:
    """The index at a path, over whole-number keys of one column."""

    spark: SparkSession
    path: str
    key: str

    def add(self, folder: str, rows: DataFrame) -> None:
        """Index the keys of a landed folder; an entry of the same name is replaced."""
        keys = rows.select(F.col(self.key).alias("key")).filter("key IS NOT NULL").distinct()
        stats = keys.agg(F.count("*").alias("keys"), F.min("key").alias("low"), F.max("key").alias("high"))
        # A power of two, so that a filter's size depends on little but the order of magnitude.
        pages = F.greatest(F.lit(1), F.pow(2, F.ceil(F.log2(F.greatest(F.col("keys") * BITS / BITMAP, F.lit(1.0)))))).cast("bigint")
        stats = stats.withColumn("pages", pages).first()
        spots = keys.select(F.explode(_places(F.col("key"), F.lit(stats["pages"]))).alias("s")).select("s.*")
        bitmaps = spots.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits"))
        entry = bitmaps.select(
            F.lit(stats["pages"]).cast("bigint").alias("pages"), "page", "bits",
            *[F.lit(stats[name]).cast("bigint").alias(name) for name in ("low", "high", "keys")],
        )
        entry.write.mode("overwrite").parquet(f"{self.path}/folder={folder}")

    def entries(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_SHAPE).option("basePath", self.path).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def folders_that_may_hold(self, batch: DataFrame) -> list[str]:
        """Names of the folders that may hold a key of the batch. One name a folder comes to the driver."""
        entries = self.entries()
        keys = batch.select(F.col(self.key).alias("key")).filter("key IS NOT NULL").distinct()
        bounds = keys.agg(F.min("key").alias("low"), F.max("key").alias("high")).first()
        if entries is None or bounds["low"] is None:
            return []
        met = entries.filter((F.col("low") <= bounds["high"]) & (F.col("high") >= bounds["low"]))
        # The few sizes that filters have; a key's places depend on the size.
        sizes = [r["pages"] for r in met.select("pages").distinct().collect()]
        if not sizes:
            return []
        tried = keys.select(
            "key", F.explode(F.array(*[F.struct(F.lit(s).alias("pages"), _places(F.col("key"), F.lit(s)).alias("spots")) for s in sizes])).alias("t")
        )
        tried = tried.select("key", "t.pages", F.explode(F.array_distinct("t.spots")).alias("s")).select("key", "pages", "s.*")
        needed = tried.groupBy("key", "pages").agg(F.count("*").alias("needed"))
        byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hits = tried.join(met, ["pages", "page"]).filter((F.col("key") >= F.col("low")) & (F.col("key") <= F.col("high")))
        hits = hits.filter(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1)
        whole = hits.groupBy("folder", "key", "pages").agg(F.count("*").alias("hits")).join(needed, ["key", "pages"])
        found = whole.filter("hits = needed").select("folder").distinct()
        return sorted(r["folder"] for r in found.collect())
