"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of docs.  run() writes each stage's result to the shared folder and rereads it as the
next one's docs, so that a lost executor costs part of one stage only.

Defined cases: a null or empty text or one without letters goes in the first stage; a null lang, source or n_chars
changes nothing; rows with one doc_id are one document, so near_dedup keeps or drops them together, whatever their
texts; rows with a null doc_id have no duplicates and stay; repeated rows stay repeated but for their lines; a
document may lose all its lines and is then packed as its end id; an empty table gives no rows; extra columns pass
unchanged through all stages but the last, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm import langid, linededup, neardup, packing, secrets
from tenderlake.llm.common import Scratch, fresh, spread, table

#: A document stays if one language has this share of its words; mixed texts with a main language do.
LEAST_SCORE = 0.4
#: Near duplicates share this part of their five-word shingles, in hundredths.
SHINGLE_WORDS, SIMILARITY = 5, 80


def _with_text(docs: DataFrame, text: str, like: list[str]) -> DataFrame:
    """docs with their text replaced, n_chars counted anew where it changed, and the columns of `like`."""
    changed = ~F.col("text").eqNullSafe(F.col(text))
    new = docs.withColumn("n_chars", F.when(changed, F.char_length(text).cast("long")).otherwise(F.col("n_chars"))) if "n_chars" in like else docs
    return new.withColumn("text", F.col(text)).select(*like)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter or without a main language."""
    p = fresh(docs.columns)
    named = langid.identify(spread(docs), langid.fit(docs), prefix=p)
    return named.where((F.col(f"{p}lang_pred") != "und") & (F.col(f"{p}score") >= LEAST_SCORE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that at least three documents share, except in the largest doc_id."""
    p = fresh(docs.columns)
    return _with_text(linededup.dedup_lines(docs, prefix=p), f"{p}kept_text", docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near duplicates."""
    gone = neardup.near_duplicates(spread(docs), width=SHINGLE_WORDS, num=SIMILARITY, den=100).where(~F.col("kept"))
    return docs.join(gone.select("doc_id").distinct().hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets; the documents stay."""
    path = "source" if "source" in docs.columns else None
    p = fresh(docs.columns)
    return _with_text(secrets.scan(spread(docs), secrets.fit(spread(docs)), path=path, prefix=p), f"{p}clean_text", docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of 2048 tokens."""
    return packing.pack(spread(docs), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch, old = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline"), []
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        scratch.drop(*old)
        old = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
