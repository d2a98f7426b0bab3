"""Reading directories of JSON records, one row per record, with malformed files quarantined."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.functions.expr import REQUIRED
from tenderlake.operators.normalize import OPTIONAL


def parse_records(files: DataFrame) -> DataFrame:
    """(file, pos, record, v) from (file, text): an array's elements, or the single value of a file that is no array.

    v is the record as a variant, null where a file is not JSON; such rows keep the file's text as record.
    """
    elements = F.coalesce(F.from_json("text", "array<string>"), F.array(F.col("text")))
    return files.where(F.col("text").isNotNull()).select("file", F.posexplode(elements).alias("pos", "record")).withColumn("v", F.try_parse_json("record"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All *.json files of a directory (not below it); pos and file order them as the files' names do."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.json")
    name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return parse_records(files.select(name.alias("file"), F.col("value").alias("text")))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """A source registry with a header line; all fields are text."""
    return spark.read.csv(path, header=True, schema=", ".join(f"{c} string" for c in REGISTRY), enforceSchema=False, multiLine=True, escape='"')


#: One column for each thing that a registry row tells about a source.
REGISTRY = ("coverage", "portal", "official_url", "data_type", "access_method", "authentication", "public_when", "history", "cadence", "identifiers", "automation", "constraints", "samples", "gaps")


ADAPTERS: dict = {}


def adapter(name: str):
    """Registers a function from a portal's raw records to canonical ones, both (file, pos, record, v)."""

    def put(f):
        ADAPTERS[name] = f
        return f

    return put


@adapter("canonical")
def canonical(records: DataFrame) -> DataFrame:
    return records


def renamed_fields(names: dict[str, str]):
    """An adapter for portals whose fields have other names: {canonical: path of theirs, with dots}.

    A field is read from its own name, and from theirs only where its own is absent, so that a false, zero or empty value
    stays what it is.  The record that goes to review stays the portal's.
    """
    paths = {n: [n, *([names[n]] if n in names else [])] for n in (*REQUIRED, *OPTIONAL)}
    at = lambda path: "$" + "".join(f"['{x}']" for x in path.split("."))

    def adapt(records: DataFrame) -> DataFrame:
        v = F.col("v")
        found = {n: F.coalesce(*[F.try_variant_get(v, at(p), "variant") for p in own]) for n, own in paths.items()}
        parts = F.filter(F.array(*[F.concat(F.lit(f'"{n}":'), F.to_json(x)) for n, x in found.items()]), lambda x: x.isNotNull())
        own = F.try_parse_json(F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")))
        return records.withColumn("v", F.when(F.schema_of_variant(v).startswith("OBJECT"), own).otherwise(v))

    return adapt


#: Portals whose shapes are known: flat records with names of their own, and nested ones.
ADAPTERS["flat_portal"] = renamed_fields({"source_id": "id", "source_url": "link", "solicitation": "bid_number", "title": "name", "agency": "department", "jurisdiction": "state", "observed_at": "fetched", "due_date": "closes", "status": "phase"})
ADAPTERS["nested_portal"] = renamed_fields({"source_id": "meta.id", "source_url": "meta.url", "observed_at": "meta.seen", "solicitation": "notice.number", "title": "notice.title", "due_date": "notice.deadline", "agency": "buyer.name", "jurisdiction": "buyer.region"})
