"""Exact line deduplication across documents, with DataFrame operations only.

Lines become 128-bit hashes of their keys.  Hashes that may hold many rows are found by a
frequent-items sketch of fixed size and counted with partial aggregation; all others are
range-partitioned by hash with a secondary sort by document and position, and one pass over
each sorted partition sees the first occurrence in every document.  The result is a
run-length-compressed keep bitmap per document, from which the texts are rebuilt.

Defined cases: a null or empty text is one empty line; a null doc_id neither counts as a
document nor loses lines; rows with the same doc_id are one document, and rows repeated
exactly stay repeated; texts are split whole, whatever their length, a row for each line; a document may lose all lines and then has an empty text.  Other
columns pass through, whatever their names, but for those that the results' names displace.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, fresh, table

#: What is stripped from both ends of a line, and the letters whose case is ignored.
STRIP = "".join(map(chr, (0x20, *range(0x09, 0x0E))))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A hash is hot from this share of all lines on; the sketch tracks enough items to find all of them (its error is under
#: 1 / 18,000 of all). What is not hot fits a partition where there are some thousands, and its window spills.
HOT_SHARE, TRACKED = 1 / 5000, 1 << 15
#: Rows of the sketch's answer: no more than 1 / HOT_SHARE hashes can have that share.
HOT_MOST = 10_000


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased and nothing else; lower() does just that to ASCII and is far faster."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 20) -> DataFrame:
    """A row (h1, h2, doc, row_hash, pos) for each line whose key has min_chars code points."""
    line = docs.where(F.col(doc_id).isNotNull() & (F.char_length(F.col(text)) >= min_chars)).select(
        F.col(doc_id).alias("doc"), F.xxhash64(F.col(text)).alias("row_hash"), F.posexplode(_lines(F.col(text))).alias("pos", "line")
    )
    key = line.select("doc", "row_hash", "pos", F.btrim("line", F.lit(STRIP)).alias("stripped")).where(F.char_length("stripped") >= min_chars)
    key = key.select("doc", "row_hash", "pos", ascii_lower(F.col("stripped")).alias("key"))
    return key.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "row_hash", "pos")


def dropped_lines(lines: DataFrame, min_docs: int = 3) -> DataFrame:
    """(doc, row_hash, pos) of the lines that go; `lines` is read several times and must be a stored table."""
    # One row of fixed size: every hash with HOT_SHARE of the rows is in it, whatever the data.
    seen = lines.agg(F.expr(f"approx_top_k(h1, {HOT_MOST}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).select(F.explode("top").alias("top"), "n")
    hot = Scratch(lines.sparkSession, "hot").save(seen.where(F.col("top.count") >= F.col("n") * HOT_SHARE).select(F.col("top.item").alias("h1")))
    hot_keys = F.broadcast(hot)  # 1 / HOT_SHARE rows at most

    often = lines.join(hot_keys, "h1", "left_semi")
    of_hot = often.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one")).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("keeper"))
    from_hot = often.join(F.broadcast(of_hot), ["h1", "h2"]).where((F.col("n_docs") >= min_docs) & (F.col("doc") < F.col("keeper")))

    rest = lines.join(hot_keys, "h1", "left_anti").repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", "doc", "pos")
    key, stream = Window.partitionBy("h1", "h2"), Window.partitionBy("h1", "h2").orderBy("doc", "pos")
    first = F.when(F.lag("doc").over(stream).eqNullSafe(F.col("doc")), 0).otherwise(1)
    rest = rest.withColumn("first", first).withColumn("n_docs", F.sum("first").over(key)).withColumn("keeper", F.max("doc").over(key))
    from_rest = rest.where((F.col("n_docs") >= min_docs) & (F.col("doc") < F.col("keeper")))
    cols = ["doc", "row_hash", "pos"]
    return from_hot.select(cols).unionByName(from_rest.select(cols))


def keep_bitmaps(dropped: DataFrame) -> DataFrame:
    """(doc, row_hash, n_dropped, keep_runs): the runs of kept lines up to the last dropped one, as [start, length] pairs, then `rest`, where the last run starts."""
    at = F.sort_array(F.collect_set("pos"))
    runs = dropped.groupBy("doc", "row_hash").agg(at.alias("at"))
    since = lambda i: F.when(i > 0, F.get("at", i - 1) + 1).otherwise(0)
    gaps = F.transform("at", lambda x, i: F.struct(since(i).alias("start"), (x - since(i)).alias("length")))
    return runs.select("doc", "row_hash", F.size("at").alias("n_dropped"), F.filter(gaps, lambda r: r["length"] > 0).alias("keep_runs"), (F.element_at("at", -1) + 1).alias("rest"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text", prefix: str = "_") -> DataFrame:
    """docs with kept_text, n_lines and n_dropped, their names after `prefix`; columns of docs with these names give way."""
    out = {c: prefix + c for c in ("kept_text", "n_lines", "n_dropped")}
    docs = docs.drop(*out.values())
    p = fresh([*docs.columns, *out.values()])
    mark = {c: f"{p}{c}" for c in ("doc", "row_hash", "n_dropped", "keep_runs", "rest")}
    marks = bitmaps.select(*[F.col(c).alias(m) for c, m in mark.items()])
    met = docs.join(marks, (F.col(doc_id) == F.col(mark["doc"])) & (F.xxhash64(F.col(text)) == F.col(mark["row_hash"])), "left")
    # Out of a generator of one row: an expression inside a lambda would be evaluated for every run.
    lines = f"{p}lines"
    met = met.select("*", F.explode(F.array(_lines(F.col(text)))).alias(lines))
    tail = F.struct(F.col(mark["rest"]).alias("start"), (F.size(lines) - F.col(mark["rest"])).alias("length"))
    kept = F.flatten(F.transform(F.concat(mark["keep_runs"], F.array(tail)), lambda r: F.slice(lines, r["start"] + 1, r["length"])))
    kept_text = F.when(F.col(mark["doc"]).isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(F.array_join(kept, "\n"))
    met = met.withColumns({out["n_lines"]: F.size(lines).cast("long"), out["n_dropped"]: F.coalesce(mark["n_dropped"], F.lit(0)).cast("long"), out["kept_text"]: kept_text})
    return met.drop(lines, *marks.columns)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3, prefix: str = "_") -> DataFrame:
    """The documents with kept_text, n_lines, n_dropped after `prefix`: keys of min_chars code points in min_docs documents stay only in the largest doc_id."""
    scratch = Scratch(docs.sparkSession, "lines")
    lines = scratch.save(line_hashes(docs, doc_id, text, min_chars))
    return apply_bitmaps(docs, keep_bitmaps(dropped_lines(lines, min_docs)), doc_id, text, prefix)


def op6_line_dedup(spark, sf_dir):
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("_kept_text", 256).alias("kept_sha256"))


OP6_SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
r AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (
  SELECT k.doc_id, k.pos, k.line, (r.key IS NOT NULL AND k.doc_id <> r.keeper) AS gone
  FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
