"""One procurement event, from its history to the artifacts of an analysis.

Everything about the event is filtered before it is collected; tables that do not depend on it (manifest,
pages, import rows) are written by Spark.  JSON arrays that grow with the tables (predecessors, source coverage,
review queue) are written whole, one partition in memory at a time.  Predictions are labelled as such and never
mixed with known bidders.
"""

from __future__ import annotations

import json
from pathlib import Path
from typing import TextIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.operators import bidding, contracts, documents
from tenderlake.plans import exports, registry
from tenderlake.session import table
from tenderlake.sources.sinks import write_jsonl

#: Rows of a single event's artifact that are collected at most; more are an error.
MOST = 10_000


def _told(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))


def _rows(df: DataFrame) -> list[dict]:
    found = _told(df.limit(MOST + 1)).collect()
    if len(found) > MOST:
        raise ValueError(f"more than {MOST} rows in an artifact of a single event: {', '.join(df.columns)}")
    return [json.loads(r[0]) for r in found]


def _stream(file: TextIO, df: DataFrame, otherwise: list[dict] | None = None) -> int:
    """Writes all rows as a JSON array, or `otherwise` if there are none; returns how many were written."""
    n = 0
    for row in _told(df).toLocalIterator():
        file.write(("[\n" if n == 0 else ",\n") + row[0])
        n += 1
    if n:
        file.write("\n]")
    else:
        file.write(json.dumps(otherwise or [], indent=2))
    return n or len(otherwise or [])


def _put_stream(path: Path, df: DataFrame) -> int:
    with path.open("w") as file:
        n = _stream(file, df)
        file.write("\n")
    return n


def _put(path: Path, value) -> int:
    path.write_text(json.dumps(value, indent=2) + "\n")
    return len(value) if isinstance(value, list) else 1


def analyze_order(spark: SparkSession, sf_dir: str, order: int, out: Path) -> dict[str, int]:
    out.mkdir(parents=True, exist_ok=True)
    bids = registry.awarded(spark, sf_dir)
    mine = bids.where(F.col("event") == order)
    known = _rows(mine.select("vendor").distinct().withColumn("evidence", F.lit("observed")).orderBy("vendor"))
    likely = bidding.likely_bidders(bids, registry.CUTOFF, active=F.col("event") == order)
    predicted = _rows(likely.withColumn("evidence", F.lit("predicted")).orderBy("place"))
    why = _rows(bidding.factors(likely).orderBy("vendor"))
    incumbent = _rows(bidding.incumbents(bids, registry.CUTOFF).join(mine.select("buyer").distinct(), "buyer", "left_semi"))
    similar = _rows(bidding.similar_events(bids, mine.select("event").distinct()).orderBy("place"))
    counts = {"opportunity_intelligence": _put(out / "opportunity_intelligence.json", {"event": order, "known_bidders": known, "likely_bidders": predicted, "factors": why, "incumbent": incumbent, "similar": similar})}

    chain = registry.QUERIES["s18_lineage_chain"](spark, sf_dir).where(F.col("node") == order)
    scored = registry.QUERIES["s16_lineage_score"](spark, sf_dir).where(F.col("record") == order)
    with (out / "procurement_lineage.json").open("w") as file:
        file.write(f'{{"chain": {json.dumps(_rows(chain))}, "predecessors": ')
        _stream(file, scored.orderBy(F.desc("score"), "predecessor"), [{"record": order, "sources": "orders", "result": "no match in searched sources"}])
        file.write("}\n")
    counts["procurement_lineage"] = 1

    docs = table(spark, sf_dir, "documents")
    attempts = documents.with_outcomes(docs.select("doc_id", "source", F.sha2("text", 256).alias("sha256"), "n_chars"), table(spark, sf_dir, "labels").select("doc_id", F.lit("processed").alias("state")), "doc_id", "state").drop("state")
    write_jsonl(attempts, str(out / "documents_manifest.jsonl"))
    write_jsonl(documents.page_texts(docs, "doc_id", "text").withColumn("method", F.lit("native text")), str(out / "document_pages.jsonl"))

    vendors = likely.select("vendor").union(mine.select("vendor")).distinct()
    counts["vendor_profiles"] = _put(out / "vendor_profiles.json", _rows(bidding.vendor_profiles(bids.join(vendors, "vendor", "left_semi")).orderBy("vendor")))
    primes = _rows(registry.QUERIES["s30_prime_candidates"](spark, sf_dir).join(vendors, "vendor", "left_semi").orderBy(F.desc("n_evidence"), "vendor"))
    counts["prime_candidates"] = _put(out / "prime_candidates.json", primes)
    counts["source_coverage"] = _put_stream(out / "source_coverage.json", registry.QUERIES["s33_source_coverage"](spark, sf_dir).orderBy("source"))
    unsure = registry.QUERIES["s23_vendor_resolution"](spark, sf_dir).where("verdict = 'review'").orderBy("entity")
    counts["review_queue"] = _put_stream(out / "review_queue.json", unsure)

    handed = registry.import_exports(spark, sf_dir)
    for name, df in handed.items():
        write_jsonl(df, str(out / "import" / f"{name}.jsonl"))
    breaches = contracts.report(contracts.validate(handed, exports.CONTRACTS)).orderBy("table", "path", "rule")
    with (out / "import" / "validation_report.json").open("w") as file:
        file.write(f'{{"contracts": {json.dumps(list(exports.CONTRACTS))}, "breaches": ')
        counts["breaches"] = _stream(file, breaches)
        file.write("}\n")
    lines = [f"# Event {order}", "", f"Known bidders (observed): {', '.join(str(x['vendor']) for x in known) or 'none'}", "", "Likely bidders (predicted, not confirmed):", "", *[f"{x['place']}. vendor {x['vendor']}, score {x['score']}" for x in predicted], "", "Primes with evidence:", "", *[f"- vendor {x['vendor']}: {x['evidence']}" for x in primes]]
    (out / "report.md").write_text("\n".join(lines) + "\n")
    return counts
