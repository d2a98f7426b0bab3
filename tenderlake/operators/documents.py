"""Links, fetch validation, page texts, references and evidence."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: A link's address in double or single quotes or none, and the entities that are decoded in it, `&amp;` last (fixed values).
HREF = r"""(?i)[\s"'/]href\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
ENTITIES = {"&quot;": '"', "&#34;": '"', "&apos;": "'", "&#39;": "'", "&lt;": "<", "&gt;": ">", "&#38;": "&", "&amp;": "&"}


def links(df: DataFrame, id_col: str, html: str) -> DataFrame:
    """(id, position, href) of each link in a page: however the attribute is written, quoted or not, with the usual entities decoded."""
    one = df.select(F.col(id_col).alias("id"), F.posexplode(F.regexp_extract_all(html, F.lit(HREF), F.lit(0))).alias("pos", "said"))
    bare = F.regexp_replace(F.regexp_replace("said", r"""(?i)^[\s"'/]href\s*=\s*""", ""), r"""^["']|["']$""", "")
    for name, char in ENTITIES.items():
        bare = F.replace(bare, F.lit(name), F.lit(char))
    return one.select("id", F.col("pos").cast("long").alias("pos"), bare.alias("href"))


def fetch_verdict(content: Column, least: int, most: int, signature: str, status: Column | None = None, content_type: Column | None = None, types: tuple[str, ...] = ("text/html",)) -> Column:
    """`ok` or why a fetched file is not used; status and content type are looked at where they are given, an unknown one is not in their favour."""
    told = F.when(content.isNull(), "missing")
    if status is not None:
        told = F.when(~F.coalesce(status.between(200, 299), F.lit(False)), "bad_status").when(content.isNull(), "missing")
    if content_type is not None:
        kind = F.lower(F.btrim(F.substring_index(content_type, ";", 1)))
        told = told.when(~F.coalesce(kind.isin(*types), F.lit(False)), "bad_content_type")
    return told.when(F.octet_length(content) < least, "too_small").when(F.octet_length(content) > most, "too_large").when(~F.lower(F.substring(content, 1, len(signature))).eqNullSafe(signature.lower()), "bad_signature").otherwise("ok")


def with_outcomes(manifest: DataFrame, results: DataFrame, key: str, status: str) -> DataFrame:
    """Every manifest row with the status of its result, `not_attempted` where there is none; nothing is dropped."""
    return manifest.join(results, key, "left").withColumn("status", F.coalesce(F.col(status), F.lit("not_attempted")))


def page_texts(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, page_no, text): a document split at line feeds; the place of each text can be cited.  A document without text is a row without page and text."""
    return df.select(F.col(id_col).alias("id"), F.posexplode_outer(F.split(text, "\n", -1)).alias("p", "text")).select("id", (F.col("p") + 1).cast("long").alias("page_no"), "text")


def word_runs(df: DataFrame, text: str, width: int) -> DataFrame:
    """df with `run` in place of the text: a row for each distinct run of `width` words, without case and split at anything but a-z."""
    words = F.filter(F.split(F.lower(text), "[^a-z]+"), lambda w: w != "")
    others = [c for c in df.columns if c != text]
    once = df.select(*others, F.explode(F.array(words)).alias("_w")).where(F.size("_w") >= width)
    runs = F.transform(F.sequence(F.lit(1), F.size("_w") - width + 1), lambda i: F.array_join(F.slice("_w", i, F.lit(width)), " "))
    return once.select(*others, F.explode(F.array_distinct(runs)).alias("run"))


def references(docs: DataFrame, doc_id: str, text: str, known: DataFrame, known_id: str, known_text: str, width: int = 8) -> DataFrame:
    """(doc_id, item_id, hits): in which documents passages of known records occur, by runs of words."""
    a = word_runs(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", width)
    b = word_runs(known.select(F.col(known_id).alias("item_id"), F.col(known_text).alias("text")), "text", width)
    return a.join(b, "run").groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("hits"))


#: Characters of patterns that one automaton holds at most; a larger dictionary is searched in several parts.
AUTOMATON = 4 << 20


def mentions(pages: DataFrame, key: list[str], text: str, known: DataFrame, known_id: str, pattern: str, most: int = AUTOMATON, whole: bool = True) -> DataFrame:
    """(key, position, item, matched): every occurrence of known record numbers, names or titles in texts, overlapping ones included.

    Case does not matter.  position counts code points from 1.  whole: letters or digits may not continue a match on either side.
    A pass over the texts by an Aho-Corasick automaton finds all patterns together.  A dictionary beyond `most` characters is split by hash, as often as
    that needs, and each part is a pass of its own, so what tasks hold is bounded.  Patterns that several records have are found once and joined to them.
    Defined cases: null or empty texts and patterns match nothing; repeated rows of texts are searched each, repeated records count once; empty tables give no rows.
    """
    import ahocorasick

    named = known.select(F.col(known_id).alias("item"), F.lower(pattern).alias("matched")).where("matched <> ''").distinct()
    patterns = named.select("matched").distinct()
    size = patterns.agg(F.coalesce(F.sum(F.char_length("matched")), F.lit(0))).first()[0]
    parts = max(1, -(-2 * size // most)) if size > most else 1
    texts = pages.select(*key, F.lower(text).alias("_text")).where("_text <> ''")
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in key)

    def searched(words: list[str]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = ahocorasick.Automaton()
            for w in words:
                found.add_word(w, w)
            found.make_automaton()
            for batch in batches:
                rows, at, which = [], [], []
                for row, said in enumerate(batch.column(len(key)).to_pylist()):
                    for end, w in found.iter(said):
                        start = end + 1 - len(w)
                        if whole and (start and said[start - 1].isalnum() and w[0].isalnum() or end + 1 < len(said) and said[end + 1].isalnum() and w[-1].isalnum()):
                            continue
                        rows.append(row)
                        at.append(start + 1)
                        which.append(w)
                taken = [batch.column(i).take(pa.array(rows, pa.int64())) for i in range(len(key))]
                yield pa.record_batch([*taken, pa.array(at, pa.int64()), pa.array(which, pa.string())], names=[*key, "position", "matched"])

        return texts.mapInArrow(run, f"{schema}, position long, matched string")

    out = None
    for part in range(parts):
        words = [r[0] for r in patterns.where(F.pmod(F.xxhash64("matched"), F.lit(parts)) == part).collect()]  # at most about `most` characters
        if words or out is None:
            one = searched(words) if words else texts.select(*key, F.lit(0).cast("long").alias("position"), F.lit("").alias("matched")).where("false")
            out = one if out is None else out.unionByName(one)
    return out.join(named, "matched").select(*key, "position", "item", "matched")


def cited(claims: DataFrame, evidence: DataFrame, key: str | list[str]) -> DataFrame:
    """The claims with whether their evidence, a document or a page of one, exists."""
    names = [key] if isinstance(key, str) else key
    return claims.join(evidence.select(*names).distinct().withColumn("cited", F.lit(True)), names, "left").withColumn("cited", F.coalesce("cited", F.lit(False)))
