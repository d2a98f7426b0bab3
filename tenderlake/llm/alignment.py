"""Alignment of the tokens of two tokenizers, relationally.

Tokens are exploded with their positions, their ends are windowed sums of lengths, an equi-join on the end finds where both
tokenizers cut, and the running count of cuts is a token's group.  The groups of a word come in order, and Arrow batches link their ids.

Both tokenizers cut before a space that follows anything but white space: pieces of the first begin there, and no piece of
the second has a space after another character.  What lies between is a word here.  A word has the same tokens, groups and links
wherever it occurs, so the relational work is done once for each distinct word of all documents; documents
hold words by code (see `coded`), and what is known of these is added up, counted and strung together for them in Arrow batches.

Defined cases: a null or empty text, and one that either tokenizer doesn't give back byte for byte, has no tokens: zeros and '';
it holds no pair either.  Texts are read whole; one of any length may be a single word.  Repeated rows are documents each; ties
for the highest count are all best; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tenderlake.session import Scratch

from .coded import ROW_GROUPS, coded, for_chunks, save, words_of
from .common import frugal, gather, plain, spread, table, units

#: Texts that are not simply split at all spaces: with white space before one, or one at an end.
GAP = r"[\p{Z}\x09-\x0d\x1c-\x1f\x85] |^ | $"
BORDER = re.compile(r"(?<=\S) (?!\Z)")
#: Bytes of text of a chunk: the larger, the fewer words stand in several.
CHUNK = 12 << 20
#: Words that are tokenised at a time; links from which on a group's ids are counted; the lower half of a long.
AT_ONCE, LARGE = 5_000, 256
#: Words of documents that are put together at a time.
BLOCK = 1 << 18
#: Pairs that are sent to all tasks at most; more are shuffled.
SENT = 1_000_000
#: Parts of the chunks whose words are sent to them one after the other; the shuffles of one part are gone before the next.
ROUNDS = 4
#: Rows that Python looks at together at least; where a word's number says in which round it is sent.
ROWS, ROUND_BIT = 100_000, 56
TOKENS = "wid long, ok boolean, a array<int>, a_len array<int>, b array<int>, b_len array<int>, chunks array<long>, at array<int>"
LINKS = "wid long, n_a long, n_b long, n_groups long, groups string, pairs array<long>, many array<struct<pair: long, m: long>>, chunks array<long>, at array<int>"


def split_at_borders(col: pa.Array):
    """Codes of what lies between the spaces at which both tokenizers cut."""
    col = plain(col)
    odd = pc.match_substring_regex(col, GAP)
    rows = np.flatnonzero(np.asarray(odd))
    if not len(rows):
        return units(col)
    codes, offsets, words = units(pc.if_else(odd, "", col))
    known = {w: i for i, w in enumerate(words.to_pylist())}
    parts, new = [], {int(r): BORDER.split(col[int(r)].as_py()) for r in rows}
    for r in range(len(col)):
        parts.append(np.array([known.setdefault(w, len(known)) for w in new[r]], np.int64) if r in new else codes[offsets[r] : offsets[r + 1]])
    return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts]))), pa.array(list(known), pa.large_string())


class Tokens:
    """One tokenizer's ids with the bytes of each."""

    def __init__(self, encode, bytes_of: list[bytes]):
        self.encode = encode
        self.lengths = np.array([len(x) for x in bytes_of], np.int64)
        self.starts, self.flat = np.cumsum(self.lengths) - self.lengths, np.frombuffer(b"".join(bytes_of), np.uint8)

    def of(self, words: list[str], data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Whether each word, with a space before it, is the bytes of its ids; ids and their lengths.  data and ends: the words with their spaces."""
        found = self.encode(words)
        ids = np.fromiter(chain.from_iterable(found), np.int64)
        offsets = np.concatenate(([0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))))
        sizes = self.lengths[ids]
        upto = np.concatenate(([0], np.cumsum(sizes)))[offsets]
        good = np.diff(upto) == np.diff(ends, prepend=0)
        own, _ = gather(self.starts, self.lengths, self.flat, ids)
        # Where the lengths agree, so must the bytes.
        n = np.diff(upto)[good]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        here, there = np.repeat(upto[:-1][good], n) + at, np.repeat((ends - np.diff(ends, prepend=0))[good], n) + at
        wrong = np.bincount(np.repeat(np.flatnonzero(good), n), weights=own[here] != data[there], minlength=len(words))
        lists = lambda x: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, pa.int32()))
        return good & (wrong == 0), lists(ids), lists(sizes)


def both_tokenizers(a_path: str, b_path: str) -> tuple[Tokens, Tokens]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core, and threads keep memory of their own
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True  # their strings in texts are plain text
    # Byte-level tokens show bytes as characters: printable ones of Latin-1 as themselves, the others from U+0100 on.
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(x): x for x in shown} | {chr(0x100 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
    vocab = a.get_vocab()
    a_bytes = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    pieces = ((i, b.id_to_piece(i)) for i in range(b.get_piece_size()))
    b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in pieces]
    first = lambda words: [e.ids for e in a.encode_batch_fast([f" {w}" for w in words], add_special_tokens=False)]
    return Tokens(first, a_bytes), Tokens(lambda words: b.encode(words, num_threads=1), b_bytes)


def together(batches: Iterator[pa.RecordBatch], key: str, least: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, in which equal keys stand together, as batches of at least so many rows that part no key's rows."""
    held, n = [], 0
    joined = lambda: pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= least:
            col = batch.column(batch.schema.get_field_index(key))
            if cut := pc.index(pc.equal(col, col[-1]), True).as_py():
                held[-1] = batch.slice(0, cut)
                yield joined()
                held, n = [batch.slice(cut)], batch.num_rows - cut
    if held:
        yield joined()


def ranges(starts: np.ndarray, values: pa.Array) -> pa.ListArray:
    """The values by lists that begin there."""
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), values)


def strung(lists: pa.ListArray, between: str) -> pa.Array:
    """The large_strings of each list in one."""
    return pc.binary_join(lists, pa.scalar(between, pa.large_string()))


def tokens_of(words: DataFrame, a_path: str, b_path: str, bounds: list[int]) -> DataFrame:
    """TOKENS of the distinct words of (chunk, pos, word), with all chunks and where each stands there; the numbers are those of one run.

    A number begins with the round whose chunks, from one of the bounds to the next, have all places of the word, or with how many rounds there are.
    """

    def told(batches):
        two, number = both_tokenizers(a_path, b_path), TaskContext.get().partitionId() << 33
        for rows in together(batches, "word", ROWS):
            runs = pc.run_end_encode(plain(rows["word"]))
            ends, names, chunk = np.asarray(runs.run_ends, dtype=np.int64), runs.values, np.asarray(rows["chunk"])
            starts, rounds = ends - np.diff(ends, prepend=0), np.searchsorted(bounds[1:], chunk, side="right")
            first, last = np.minimum.reduceat(rounds, starts), np.maximum.reduceat(rounds, starts)
            wid = (np.where(first == last, first, len(bounds) - 1).astype(np.int64) << ROUND_BIT) + number + np.arange(len(ends))
            number += len(ends)
            places = [ranges(starts, rows["chunk"]), ranges(starts, rows["pos"])]
            for at in range(0, len(ends), AT_ONCE):
                some = plain(names.slice(at, AT_ONCE))
                spaced = pc.binary_join_element_wise(pa.scalar("", some.type), some, pa.scalar(" ", some.type))
                data, upto = np.frombuffer(spaced.buffers()[2], np.uint8), np.asarray(pc.binary_length(spaced)).cumsum()
                (good_a, *a), (good_b, *b) = (t.of(some.to_pylist(), data, upto) for t in two)
                ok = good_a & good_b & np.asarray(pc.not_equal(some, ""))
                yield pa.record_batch([pa.array(wid[at : at + AT_ONCE]), pa.array(ok), *a, *b, *(x.slice(at, AT_ONCE) for x in places)], names=["wid", "ok", "a", "a_len", "b", "b_len", "chunks", "at"])

    def run(batches):
        with frugal():
            yield from told(batches)

    return words.select("chunk", "pos", "word").repartition("word").sortWithinPartitions("word").mapInArrow(run, TOKENS)


def aligned(tokens: DataFrame) -> DataFrame:
    """(wid, end, a, b, chunks, at, grp) of TOKENS: the ids that end at each byte offset where one does, and the number of cuts before it.

    The rows of a word stand together in the order of their ends; one has its places.
    """
    order = Window.partitionBy("wid").orderBy("pos")

    def ends(side: str, *places: str) -> DataFrame:
        one = tokens.where("ok").select("wid", side, f"{side}_len", *places).repartition("wid")  # the arrays, not the tokens
        one = one.select("wid", *places, F.posexplode(F.arrays_zip(F.col(side).alias("id"), F.col(f"{side}_len").alias("len"))).alias("pos", "t"))
        one = one.select("wid", "pos", "t", *[F.when(F.col("pos") == 0, F.col(x)).alias(x) for x in places])
        return one.select("wid", F.sum("t.len").over(order).alias("end"), F.col("t.id").alias(side), *places)

    met = ends("a", "chunks", "at").join(ends("b"), ["wid", "end"], "full").repartition("wid")
    before = Window.partitionBy("wid").orderBy("end").rowsBetween(Window.unboundedPreceding, -1)
    cut = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1).otherwise(0)
    return met.select("wid", "end", "a", "b", "chunks", "at", F.coalesce(F.sum(cut).over(before), F.lit(0)).alias("grp")).sortWithinPartitions("wid", "end")


def word_links(rows: DataFrame) -> DataFrame:
    """LINKS of aligned().

    groups is `a1,a2|b1;a3|b2,b3`; pairs has the linked pairs of small groups (two ids as one number), each as often as it is linked; many
    those of large ones as structs (pair, m), whose ids are counted first, so that no group is squared by its occurrences.
    """
    large = LARGE

    def linked(rows: pa.RecordBatch) -> pa.RecordBatch:
        wid, grp = np.asarray(rows["wid"]), np.asarray(rows["grp"])
        new_word = np.diff(wid, prepend=wid[0] - 1) != 0
        new = new_word | (np.diff(grp, prepend=-1) != 0)
        group, words = np.cumsum(new) - 1, np.flatnonzero(new_word[new])  # of each row; the first group of each word
        sides = []
        for side in "ab":
            has = np.asarray(rows[side].is_valid())
            ids, of = np.asarray(rows[side].drop_null(), dtype=np.int64), group[has]
            n = np.bincount(of, minlength=group[-1] + 1)
            sides.append((ids, of, n, np.cumsum(n) - n))
        (a, a_of, n_a, a_at), (b, _, n_b, b_at) = sides
        said = [strung(ranges(at, pa.array(ids).cast(pa.large_string())), ",") for ids, _, _, at in sides]
        groups = strung(ranges(words, pc.binary_join_element_wise(*said, pa.scalar("|", pa.large_string()))), ";")
        n = n_a * n_b
        met = np.where(n <= large, n_b, 0)
        pairs = (np.repeat(a, met[a_of]) << 32) + gather(b_at, met, b, a_of)[0]
        sums = lambda x: np.add.reduceat(x, words)
        n_pairs, n_many, many = sums(n_a * met), np.zeros(len(n), np.int64), [(np.zeros(0, np.int64),) * 2]
        for g in np.flatnonzero(n > large):
            (ids_a, m_a), (ids_b, m_b) = (np.unique(ids[at[g] : at[g] + n[g]], return_counts=True) for ids, _, n, at in sides)
            many.append((((ids_a << 32)[:, None] + ids_b).ravel(), (m_a[:, None] * m_b).ravel()))
            n_many[g] = len(many[-1][0])
        many = pa.StructArray.from_arrays([pa.array(np.concatenate(x)) for x in zip(*many, strict=True)], ["pair", "m"])
        begin = lambda n: np.cumsum(n) - n
        numbers = [pa.array(x) for x in (wid[new_word], sums(n_a), sums(n_b), sums(np.ones_like(n)))]
        return pa.record_batch([*numbers, groups.cast(pa.string()), ranges(begin(n_pairs), pa.array(pairs)), ranges(begin(sums(n_many)), many), rows["chunks"].drop_null(), rows["at"].drop_null()], names=["wid", "n_a", "n_b", "n_groups", "groups", "pairs", "many", "chunks", "at"])

    def run(batches):
        with frugal():
            yield from map(linked, together(batches, "wid", ROWS))

    return rows.mapInArrow(run, LINKS)


def _blocks(docs: pa.StructArray, ok: np.ndarray) -> Iterator[tuple[pa.StructArray, np.ndarray, np.ndarray, np.ndarray]]:
    """By blocks of the documents of a chunk: these, their codes and offsets, and which have tokens; ok: which words have."""
    lists = docs.field("codes")
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    start = 0
    while start < len(docs):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + BLOCK, side="right")) - 1)
        codes, own = np.asarray(lists.values.slice(offsets[start], offsets[end] - offsets[start]), dtype=np.int64), offsets[start : end + 1] - offsets[start]
        yield docs.slice(start, end - start), codes, own, np.logical_and.reduceat(ok[codes], own[:-1])
        start = end


def once(ids: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """The ids, each once; mark has room for all there are."""
    at = np.arange(len(ids))
    mark[ids] = at
    return ids[mark[ids] == at]


def document_counts(docs: DataFrame, words: DataFrame) -> DataFrame:
    """(pair, n): how many documents hold each pair linked; words are (of, pos, ok, pairs).  Chunks count first."""

    def made(docs: pa.StructArray, words: pa.Table) -> Iterator[pa.RecordBatch]:
        lists = words.column("pairs").combine_chunks()
        lengths, pairs = np.asarray(pc.list_value_length(lists), dtype=np.int64), pc.dictionary_encode(lists.flatten())
        starts, number = np.cumsum(lengths) - lengths, np.asarray(pairs.indices)
        n, word, pair = np.zeros(len(pairs.dictionary), np.int64), np.zeros(len(lengths), np.int64), np.zeros(len(pairs.dictionary), np.int64)
        for _, codes, offsets, good in _blocks(docs, np.asarray(words.column("ok"))):
            for at in np.flatnonzero(good).tolist():
                n[once(gather(starts, lengths, number, once(codes[offsets[at] : offsets[at + 1]], word))[0], pair)] += 1
        yield pa.record_batch([pairs.dictionary.filter(pa.array(n > 0)), pa.array(n[n > 0])], names=["pair", "n"])

    return for_chunks(docs, words, made, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def documents_of(docs: DataFrame, words: DataFrame, sums: list[str]) -> DataFrame:
    """(doc_id, sums, groups) of the documents; words are (of, pos, ok, sums, groups)."""
    key = docs.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()

    def made(docs: pa.StructArray, words: pa.Table) -> Iterator[pa.RecordBatch]:
        numbers, groups = {s: np.asarray(words.column(s), dtype=np.int64) for s in sums}, words.column("groups").combine_chunks().cast(pa.large_string())
        for some, codes, offsets, good in _blocks(docs, np.asarray(words.column("ok"))):
            totals = [np.where(good, np.add.reduceat(n[codes], offsets[:-1]), 0) for n in numbers.values()]
            n = np.diff(offsets)
            whole = strung(ranges(np.cumsum(n * good) - n * good, groups.take(pa.array(codes[np.repeat(good, n)]))), ";")
            yield pa.record_batch([some.field("doc_id"), *map(pa.array, totals), whole.cast(pa.string())], names=["doc_id", *sums, "groups"])

    return for_chunks(docs, words, made, f"doc_id {key}, {', '.join(f'{s} long' for s in sums)}, groups string")


def bounds_of(chunked: DataFrame) -> list[int]:
    """Bounds of ROUNDS ranges of the partitions that the chunks come from, or of as many as there are partitions."""
    parts = (chunked.agg(F.max("chunk")).first()[0] or 0) // (1 << 33) + 1
    return sorted({parts * k // ROUNDS << 33 for k in range(ROUNDS + 1)})


def sent_in(words: DataFrame, k: int, bounds: list[int]) -> DataFrame:
    """The words at their places (of, pos) in the chunks of round k.  Their numbers say who has any, and stand in order in the files."""
    own = (F.col("wid") >= k << ROUND_BIT) & (F.col("wid") < k + 1 << ROUND_BIT)
    some = words.where(own | (F.col("wid") >= len(bounds) - 1 << ROUND_BIT))
    placed = some.select(*[c for c in words.columns if c not in ("wid", "chunks", "at")], F.inline(F.arrays_zip(F.col("chunks").alias("of"), F.col("at").alias("pos"))))
    return placed.where((F.col("of") >= bounds[k]) & (F.col("of") < bounds[k + 1]))


def in_rounds(scratch: Scratch, docs: DataFrame, words: DataFrame, bounds: list[int], made: Callable[[DataFrame, DataFrame], DataFrame], name: str) -> DataFrame:
    """made(docs, words at their places) of all chunks, written by the ranges between the bounds."""
    saved = []
    for k, (lo, hi) in enumerate(pairwise(bounds)):
        some = docs.where((F.col("chunk") >= lo) & (F.col("chunk") < hi))
        saved.append(save(scratch, made(some, sent_in(words, k, bounds)), name))
    return reduce(DataFrame.unionByName, saved)


def align(docs: DataFrame, doc_id: str, text: str, a_path: str, b_path: str, kept: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups): the alignment of each document, as written by word_links().

    A pair's count is the number of documents that hold it linked; n_best is how many links have the highest count of their first id.
    kept(these rows) is what is written of them and returned.
    """
    scratch = Scratch(docs.sparkSession, "alignment")
    chunked = save(scratch, coded(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", split_at_borders, CHUNK), "chunks", ROW_GROUPS)
    bounds = bounds_of(chunked)
    tokens = save(scratch, tokens_of(words_of(chunked), a_path, b_path, bounds), "tokens")
    # From here on words are numbers.
    coded_docs = chunked.select("chunk", "docs")
    several = F.col("wid") >= len(bounds) - 1 << ROUND_BIT
    words = []
    for some in (tokens.where(several), tokens.where(~several)):  # those with most places, then those with most tokens: the shuffles of one part go before the next
        told = word_links(aligned(some)).withColumn("ok", F.lit(True)).unionByName(some.where(~F.col("ok")).select("wid", "ok", "chunks", "at"), allowMissingColumns=True)
        # Partitions by word number serve joins on number and end as well.
        words.append(save(scratch, told, "words", requireAllClusterKeysForCoPartition="false"))
    scratch.drop(tokens)
    parts, words = words, reduce(DataFrame.unionByName, words)
    named = words.select("wid", "ok", "chunks", "at", F.when(F.col("ok"), F.concat("pairs", F.col("many.pair"))).otherwise(F.array().cast("array<long>")).alias("pairs"))
    counts = in_rounds(scratch, coded_docs, named, bounds, document_counts, "held")
    counts = save(scratch, counts.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.shiftright("pair", 32)), "counts")

    best = counts.join(counts.groupBy("a").agg(F.max("n").alias("most")), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("top"))
    best = F.broadcast(best) if counts.count() <= SENT else best
    held = words.select("wid", F.explode("pairs").alias("pair"), F.lit(1).cast("long").alias("m")).unionByName(words.select("wid", F.inline("many")))
    weighed = held.join(best, "pair").groupBy("wid").agg(F.sum(F.when(F.col("top"), F.col("m")).otherwise(0)).alias("n_best"), F.sum(F.col("m") * F.col("n")).alias("count_sum"))
    sums = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    n_links = F.size("pairs") + F.aggregate("many", F.lit(0).cast("long"), lambda n, x: n + x["m"])
    told = words.withColumn("n_links", n_links).join(weighed, "wid", "left").select("wid", "ok", "chunks", "at", *[F.coalesce(s, F.lit(0)).cast("long").alias(s) for s in sums], F.coalesce("groups", F.lit("")).alias("groups"))
    told = save(scratch, told, "told")
    scratch.drop(*parts, counts)
    return in_rounds(scratch, coded_docs, told, bounds, lambda docs, words: kept(documents_of(docs, words, sums)), "documents")


def op13_token_alignment(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda df: df.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")
    return align(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), digest)
