"""The import-shaped exports of an analysis, with deterministic local ids, and their contracts.

Order of import: sources, records, competitors, documents, participants, document content, payloads, as each refers to earlier ones only.  Natural keys
are those of `unique`; an import that comes twice has the same ids and replaces what it brought before (see assemble.latest).  Local ids are hashes of natural keys, so a
later system can map them by joining these.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenderlake.functions.expr import local_uuid
from tenderlake.operators import documents
from tenderlake.session import table

_ID = {"required": True, "format": "uuid"}

#: Exports in the order of their import.
CONTRACTS: dict[str, dict[str, Any]] = {
    "sources": {"key": ["source_key"], "columns": {"id": _ID, "source_key": {"required": True}, "access_mode": {"enum": ["table"]}}, "unique": [["id"], ["source_key"]]},
    "records": {"key": ["source_ref"], "columns": {"id": _ID, "source_ref": {"required": True, "pattern": r"O-\d+"}, "record_type": {"required": True, "enum": ["order"]}, "status": {"enum": ["F", "O", "P"]}, "amount": {"least": 0}, "buyer": {"required": True}}, "unique": [["id"], ["source_ref"]]},
    "competitors": {"key": ["external_id"], "columns": {"id": _ID, "external_id": {"required": True}, "legal_name": {"required": True}, "aliases[]": {"required": True}}, "unique": [["id"], ["external_id"]]},
    "documents": {"key": ["source_ref"], "columns": {"id": _ID, "source_ref": {"required": True}, "sha256": {"format": "sha256"}, "state": {"required": True, "enum": ["processed", "not_attempted"]}}, "unique": [["id"]], "references": [{"columns": ["source_id"], "table": "sources", "to": ["id"]}]},
    "participants": {"key": ["id"], "columns": {"id": _ID, "role": {"required": True, "enum": ["awardee", "bidder"]}, "amount": {"least": 0}, "evidence.class": {"required": True, "enum": ["observed", "derived"]}}, "unique": [["id"]], "references": [{"columns": ["record_id"], "table": "records", "to": ["id"]}, {"columns": ["competitor_id"], "table": "competitors", "to": ["id"]}]},
    "document_content_handoff": {"key": ["document_id", "page_no"], "columns": {"document_id": _ID, "page_no": {"least": 1}, "method": {"required": True, "enum": ["native_text", "none"]}}, "unique": [["document_id", "page_no"]], "references": [{"columns": ["document_id"], "table": "documents", "to": ["id"]}]},
    "partner_match_payloads": {"key": ["place"], "columns": {"id": _ID, "payload": {"required": True, "pattern": r"\[.*\]"}}, "unique": [["id"]]},
}


def _id(kind: str, *key: str | Column) -> Column:
    return local_uuid(F.lit(kind), *[F.col(k) if isinstance(k, str) else k for k in key]).alias("id")


def exports(spark: SparkSession, sf_dir: str, awarded: DataFrame, payloads: DataFrame) -> dict[str, DataFrame]:
    """The exports of the tables; awarded: bids with `won`, payloads: (place, payload)."""
    docs, order, supplier = (table(spark, sf_dir, t) for t in ("documents", "orders", "supplier"))
    wins = awarded.groupBy("vendor").agg(F.count_if("won").alias("wins"), F.count(F.lit(1)).alias("bids"))
    # Bids with one natural key are told apart by their amounts in order.
    copies = awarded.withColumn("copy", F.row_number().over(Window.partitionBy("event", "line", "vendor", "commodity").orderBy("amount")))
    labelled = table(spark, sf_dir, "labels").select("doc_id", F.lit("processed").alias("found"))
    return {
        "sources": docs.where("source IS NOT NULL").groupBy("source").agg(F.count(F.lit(1)).alias("n_documents")).select(_id("source", "source"), F.col("source").alias("source_key"), F.lit("table").alias("access_mode"), "n_documents"),
        "records": order.select(_id("record", "o_orderkey"), F.concat(F.lit("O-"), "o_orderkey").alias("source_ref"), F.lit("order").alias("record_type"), F.col("o_custkey").alias("buyer"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("observed_at")),
        "competitors": supplier.join(wins, F.col("s_suppkey") == F.col("vendor"), "left").select(_id("competitor", "s_suppkey"), F.col("s_suppkey").alias("external_id"), F.col("s_name").alias("legal_name"), F.array("s_name").alias("aliases"), F.struct("bids", "wins").alias("profile")),
        "documents": docs.join(labelled, "doc_id", "left").select(_id("document", "doc_id"), F.concat(F.lit("D-"), "doc_id").alias("source_ref"), F.when(F.col("source").isNotNull(), local_uuid(F.lit("source"), F.col("source"))).alias("source_id"), F.sha2("text", 256).alias("sha256"), F.coalesce("found", F.lit("not_attempted")).alias("state")),
        "participants": copies.select(_id("participant", "event", "line", "vendor", "commodity", "copy"), local_uuid(F.lit("record"), F.col("event")).alias("record_id"), F.when(F.col("vendor").isNotNull(), local_uuid(F.lit("competitor"), F.col("vendor"))).alias("competitor_id"), F.when(F.col("won"), "awardee").otherwise("bidder").alias("role"), "amount", F.struct(F.when(F.col("won"), "derived").otherwise("observed").alias("class")).alias("evidence")),
        "document_content_handoff": documents.page_texts(docs, "doc_id", "text").select(local_uuid(F.lit("document"), F.col("id")).alias("document_id"), "page_no", F.when(F.col("page_no").isNull(), "none").otherwise("native_text").alias("method"), "text"),
        "partner_match_payloads": payloads.select(_id("payload", "place"), "place", "payload"),
    }
