"""Conflicts, upserts, review feeds, snapshots and payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest(df: DataFrame, key: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """The latest version of each natural key, by partial aggregation; an import that comes twice changes nothing."""
    when = F.struct(*order)
    return df.groupBy(*key).agg(*[F.max_by(f, when).alias(f) for f in fields], F.count(F.lit(1)).alias("n_versions"))


def conflicts(portal: DataFrame, document: DataFrame, key: list[str], value: str, order: list[str]) -> DataFrame:
    """Both values of each key, whether they differ, and the one that controls: the more recent, the document's in a tie.

    An absent or null value is unknown: whether it differs is null.  Null keys are keys like others.
    """
    when = F.struct(*order)
    side = lambda df, name: df.groupBy(*key).agg(F.max_by(value, when).alias(f"{name}_value"), F.max(order[0]).alias(f"{name}_ts"))
    # One aggregation of both sides instead of an outer join, so that null keys meet.
    none = [F.lit(None).alias(c) for c in ("portal_value", "portal_ts", "document_value", "document_ts")]
    both = side(portal, "portal").select(*key, "portal_value", "portal_ts", *none[2:]).unionByName(side(document, "document").select(*key, *none[:2], "document_value", "document_ts"))
    met = both.groupBy(*key).agg(*[F.max(c).alias(c) for c in ("portal_value", "portal_ts", "document_value", "document_ts")])
    newer = F.col("document_ts").isNull() | (F.col("portal_ts") > F.col("document_ts"))
    return met.select(*key, "portal_value", "document_value", (F.col("portal_value") != F.col("document_value")).alias("conflict"), F.when(newer, F.col("portal_value")).otherwise(F.col("document_value")).alias("controlling"))


def review_feed(feeds: dict[str, DataFrame]) -> DataFrame:
    """(id, reason) of several feeds of ids."""
    parts = [df.select("id", F.lit(reason).alias("reason")) for reason, df in feeds.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def snapshots(df: DataFrame, days: int, as_of: str) -> DataFrame:
    """Adds when a result expires and whether it is valid at as_of."""
    expires = F.col("generated_at") + F.expr(f"INTERVAL {days} DAYS")
    return df.withColumn("expires_at", expires).withColumn("valid", expires > F.lit(as_of).cast("timestamp"))


def certification(held: DataFrame, needed: list[str], most: int) -> DataFrame:
    """How many of the needed certifications each vendor holds; the weight is capped, so it is never enough alone."""
    sets = held.groupBy("vendor").agg(F.collect_set("held").alias("types"))
    met = F.size(F.array_intersect("types", F.array(*[F.lit(x) for x in needed]))).cast("long")
    return sets.select("vendor", met.alias("n_met"), (met == len(needed)).alias("compatible"), F.least(met, F.lit(most)).cast("long").alias("weight"))


def partner_payload(wins: DataFrame, top: int) -> DataFrame:
    """(place, payload): the best vendors of each place as a JSON array in order of rank."""
    ranked = wins.withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy(F.desc("wins"), "vendor"))).where(F.col("rank") <= top)
    return ranked.groupBy("place").agg(F.to_json(F.sort_array(F.collect_list(F.struct("rank", "vendor", "wins")))).alias("payload"))
