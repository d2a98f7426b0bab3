"""From raw records to canonical opportunities and a review queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.functions.expr import REQUIRED, TEXT_FIELDS, canonical_id, confidence, falsy, field, strip

OPPORTUNITY = ("canonical_id", "title", "agency", "jurisdiction", "status", "due_date", "source_ids", "source_urls", "observed_at", "confidence")


#: The fields that may be absent.
OPTIONAL = ("status", "due_date", "confidence")


def judged(records: DataFrame) -> DataFrame:
    """The records (file, pos, record, v) with the ten canonical columns and `error`, null for good ones.

    Rejections are rows: a missing field, an unparsable record, a field of the wrong type or an unusable
    confidence each has its reason, and missing fields are told first.

    Each field is taken out of its record once: a generator of one row keeps what follows from taking it anew for every use.
    """
    names = (*REQUIRED, *OPTIONAL)
    fields = F.explode(F.array(F.struct(*[field(F.col("v"), n).alias(n) for n in names])))
    once = records.select("file", "pos", "record", "v", fields.alias("f"))
    told = F.struct(*[F.struct(F.schema_of_variant(f"f.{n}").alias("kind"), F.to_json(F.col(f"f.{n}")).alias("said"), F.try_variant_get(f"f.{n}", "$", "string").alias("text")).alias(n) for n in names])
    once = once.select("*", F.explode(F.array(told)).alias("t"))
    v, text = F.col("v"), {n: F.col(f"t.{n}.text") for n in names}
    kind = {n: F.col(f"t.{n}.kind") for n in names}
    missing = F.filter(F.array(*[F.when(falsy(F.col(f"f.{n}"), kind[n], F.col(f"t.{n}.said")), F.lit(n)) for n in REQUIRED]), lambda x: x.isNotNull())
    wrong = F.filter(F.array(*[F.when(~F.coalesce(kind[n] == "STRING", F.lit(False)), F.lit(n)) for n in TEXT_FIELDS]), lambda x: x.isNotNull())
    sure = confidence(F.col("f.confidence"), kind["confidence"], text["confidence"])
    error = (
        F.when(v.isNull(), "malformed_json")
        .when(~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)), "wrong_type: record")
        .when(F.size(missing) > 0, F.concat(F.lit("missing required fields: "), F.array_join(missing, ", ")))
        .when(F.size(wrong) > 0, F.concat(F.lit("wrong_type: "), F.array_join(wrong, ", ")))
        .when(sure.isNull(), "invalid confidence")
    )
    return once.select(
        "file",
        "pos",
        "record",
        canonical_id(text["agency"], text["solicitation"]).alias("canonical_id"),
        *[strip(text[n]).alias(n) for n in ("title", "agency", "jurisdiction")],
        F.when(F.col("f.status").isNull(), "unknown").otherwise(text["status"]).alias("status"),
        text["due_date"].alias("due_date"),
        F.array(text["source_id"]).alias("source_ids"),
        F.array(text["source_url"]).alias("source_urls"),
        text["observed_at"].alias("observed_at"),
        sure.alias("confidence"),
        strip(text["solicitation"]).alias("solicitation"),
        error.alias("error"),
    )


def opportunities(rows: DataFrame) -> DataFrame:
    return rows.where("error IS NULL").select("file", "pos", *OPPORTUNITY)


def review_queue(rows: DataFrame) -> DataFrame:
    return rows.where("error IS NOT NULL").select("file", "pos", "record", "error")


def split_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_if(F.col("error").isNull()).alias("normalized"), F.count_if(F.col("error").isNotNull()).alias("review"))


def with_instants(rows: DataFrame) -> DataFrame:
    """Adds due_ts and observed_ts; texts that are no timestamps give null."""
    return rows.withColumns({"due_ts": F.try_to_timestamp("due_date"), "observed_ts": F.try_to_timestamp("observed_at")})


def plain_records(rows: DataFrame) -> DataFrame:
    """(file, pos, line): each good record as a JSON object whose fields stand in the canonical order, nulls included."""
    return opportunities(rows).select("file", "pos", F.to_json(F.struct(*OPPORTUNITY), {"ignoreNullFields": "false"}).alias("line"))
