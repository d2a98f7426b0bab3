"""Incremental imports into partitioned tables: only touched partitions are read and written, and a replayed batch changes nothing."""

from __future__ import annotations

import graphlib
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenderlake.session import Scratch

#: The partition column of a table, by hash of its key.
BUCKET = "bucket"


def bucketed(df: DataFrame, key: list[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def merge(spark: SparkSession, path: str, batch: DataFrame, key: list[str], order: list[str], buckets: int) -> None:
    """Puts the batch into the table at path: the latest version of each key stays, by `order`; of equal versions, the largest by all columns.

    Rows are dealt to `buckets` partitions by their key, so a key's versions meet in one of them.  Partitions that the batch has no key of are neither read nor
    written.  Merged rows are stored before they replace what they were made of, so that a lost executor costs no rows; a batch that comes
    twice finds its own rows.  Rows with null keys are versions of one key.  One writer at a time.
    """
    scratch = Scratch(spark, "merge")
    fresh = scratch.save(bucketed(batch, key, buckets), "batch")
    touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]  # buckets at most
    if not touched:
        return
    old = spark.read.schema(fresh.schema).parquet(path).where(F.col(BUCKET).isin(touched)) if _exists(spark, path) else fresh.limit(0)
    both = old.unionByName(fresh)
    values = [c for c in batch.columns if c not in key]
    newest = F.max(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], *values)).alias("_last")
    merged = scratch.save(both.groupBy(BUCKET, *key).agg(newest).select(*key, *[F.col(f"_last.{c}").alias(c) for c in values], BUCKET).select(*batch.columns, BUCKET), "merged")
    merged.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    scratch.drop(fresh, merged)


def merging(path: str, key: list[str], order: list[str], buckets: int) -> Callable[[DataFrame, int], None]:
    """For foreachBatch of a stream: batches that come again after a failure change nothing."""
    return lambda batch, _: merge(batch.sparkSession, path, batch, key, order, buckets)


def import_order(contracts: dict[str, dict[str, Any]]) -> list[str]:
    """The tables in an order in which each comes after those it refers to, by name where there is a choice; a circle of references is an error."""
    graph = graphlib.TopologicalSorter({name: {r["table"] for r in c.get("references", [])} - {name} for name, c in contracts.items()})
    graph.prepare()
    out: list[str] = []
    while graph.is_active():
        ready = sorted(graph.get_ready())
        out += ready
        graph.done(*ready)
    return out


def dense_ids(df: DataFrame, order: list[str], name: str, first: int = 1) -> DataFrame:
    """df with consecutive numbers from `first` in this order, which has to tell all rows apart.

    Rows are put in ranges; each range numbers its own rows, after as many as the ranges before it hold.
    """
    scratch = Scratch(df.sparkSession, "dense")
    part = F.spark_partition_id()
    ranged = scratch.save(df.repartitionByRange(*order).withColumn("_part", part), "ranges")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each range
    offsets = sizes.select("_part", before.alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_own", own).join(F.broadcast(offsets), "_part").withColumn(name, (F.col("_before") + F.col("_own") + (first - 1)).cast("long")).drop("_part", "_own", "_before")
