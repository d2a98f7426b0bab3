"""Packing tokenised documents into sequences of fixed capacity by minimum bin slack.

A document is its ids and the end id.  Full windows of it are sequences of their own; what
remains of it waits in a bounded pool.  A bin starts with the longest waiting piece, and a
bitset subset-sum over the lengths of all waiting pieces (bit s of a Python integer: the sum
s can be had) finds the multiset that comes closest to the capacity; the counts of each
length are traced back through the bitsets.  Where no multiset fills the bin, one piece is cut
to do it.  At the end of a partition less than one sequence is left, which is cut at powers
of two, so nothing is padded.

Packing needs no shuffle: each partition packs its own documents, and a partition that runs
again after a loss gives the same rows.

Defined cases: a null or empty text is just the end id; repeated rows are packed each; a
document of any length is tokenised whole; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import deque
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from tokenizers import Tokenizer

from .common import Pool, chunks, frugal, spread, table, units

#: Pieces that wait in a partition before bins are made, and that are left for the next ones.
WAITING, LEFT = 4096, 2048
#: Bytes of text that are tokenised at a time: each distinct word once.
CHUNK = 16 << 20
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordPieces:
    """Ids of whole texts by a tokenizer whose white space only separates, put together from those of units between spaces."""

    #: Up to here lower-casing is by character and normalising does nothing, so that Python's functions give the library's results.
    SIMPLE = re.compile("[^\0-ɏ]")
    #: The tokenizer's own rule for pieces, over these characters. Fixed by the tokenizer file.
    PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\w\t-\r \x85\xa0]|_)+")

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        # Bytes as the characters that stand for them: printable ones for themselves, the others from U+0100 on, in order.
        own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
        self.shown = {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in own)}
        self.pieces: dict[str, list[int]] = {}
        self.pool = Pool(self._encode_all, np.uint32, most=300_000)

    def _encode_all(self, texts: list[str]) -> list[list[int]]:
        simple, find, known, tokenize, out = self.SIMPLE.search, self.PIECE.findall, self.pieces, self.model.tokenize, []
        if len(known) > 200_000:
            known.clear()
        for text in texts:
            if text.isascii() and text.isalpha():  # one piece, as most are
                low = text.lower()
                got = known.get(low)
                if got is None:
                    got = [t.id for t in tokenize(low)]
                    if len(low) <= 32:
                        known[low] = got
                out.append(got)
                continue
            if not text.isascii() and simple(text):
                out.append(self.tokenizer.encode(text, add_special_tokens=False).ids)
                continue
            ids: list[int] = []
            low = text.lower()
            for piece in (low,) if low.isalpha() else find(low):
                got = known.get(piece)
                if got is None:
                    shown = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.shown)
                    got = [t.id for t in tokenize(shown)]
                    if len(piece) <= 32:
                        known[piece] = got
                ids += got
            out.append(ids)
        return out

    def encode_column(self, col: pa.Array, end: int):
        """Yields the ids of each text with the end id after them."""
        codes, offsets, distinct = units(col)
        starts, lengths, ids = self.pool.of(distinct.to_pylist())
        n = lengths[codes]
        ends = np.cumsum(n)
        flat = ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[codes] - (ends - n), n)]
        bounds = np.concatenate(([0], ends))[offsets]
        last = np.array([end], np.uint32)
        for row in range(len(col)):
            yield np.concatenate((flat[bounds[row] : bounds[row + 1]], last))


def closest_sum(counts: Mapping[int, int], target: int, lengths: list[int] | None = None) -> dict[int, int]:
    """How many of each length to take so that their sum comes closest to target from below; counts has the lengths at hand, `lengths` them in order if known."""
    reach, trail, full = 1, [], (1 << (target + 1)) - 1
    lengths = sorted(counts) if lengths is None else lengths
    for i in range(bisect.bisect_right(lengths, target) - 1, -1, -1):
        length = lengths[i]
        trail.append((length, reach))
        left, some = counts[length], 1
        while left > 0 and some * length <= target:  # 1, 2, 4, ... of this length together, up to as many as there are
            some = min(some, left)
            reach |= reach << (some * length)
            left, some = left - some, some * 2
        reach &= full
        if reach >> target & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, before in reversed(trail):
        n = 0
        while not before >> (total - n * length) & 1:
            n += 1
        if n:
            taken[length] = n
        total -= n * length
    return taken


class Packer:
    """Packs (doc_id, ids) and yields rows of SCHEMA, for the partition of this number."""

    def __init__(self, capacity: int, partition: int):
        self.capacity, self.next = capacity, partition << 40
        self.waiting: dict[int, deque] = {}
        self.lengths: list[int] = []  # of what waits, in order
        self.counts: dict[int, int] = {}
        self.size = 0

    def _put(self, piece) -> None:
        length = len(piece[2])
        if length not in self.waiting:
            self.waiting[length] = deque()
            self.counts[length] = 0
            bisect.insort(self.lengths, length)
        self.waiting[length].append(piece)
        self.counts[length] += 1
        self.size += 1

    def _take(self, length: int):
        self.size -= 1
        self.counts[length] -= 1
        piece = self.waiting[length].popleft()
        if not self.counts[length]:
            del self.waiting[length], self.counts[length]
            del self.lengths[bisect.bisect_left(self.lengths, length)]
        return piece

    def _rows(self, pieces) -> list[tuple]:
        number, at, rows = self.next, 0, []
        self.next += 1
        for doc_id, start, ids, total in pieces:
            rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4", copy=False).tobytes()), total, number, at))
            at += len(ids)
        return rows

    def add(self, doc_id, ids: np.ndarray) -> list[tuple]:
        rows, whole = [], len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            rows += self._rows([(doc_id, start, ids[start : start + self.capacity], len(ids))])
        if whole < len(ids):
            self._put((doc_id, whole, ids[whole:].copy(), len(ids)))
        if self.size > WAITING:
            while self.size > LEFT:
                rows += self._bin(self.capacity)
        return rows

    def _bin(self, capacity: int) -> list[tuple]:
        """One full sequence of what waits, which holds at least capacity ids."""
        fit = bisect.bisect_right(self.lengths, capacity)
        longest = self.lengths[fit - 1] if fit else 0
        pieces = [self._take(longest)] if longest else []
        gap = capacity - longest
        if gap:
            for length, n in closest_sum(self.counts, gap, self.lengths).items():
                pieces += [self._take(length) for _ in range(n)]
                gap -= n * length
        if gap:  # every piece that waits is longer than the gap
            doc_id, start, ids, total = self._take(self.lengths[bisect.bisect_right(self.lengths, gap)])
            pieces.append((doc_id, start, ids[:gap], total))
            self._put((doc_id, start + gap, ids[gap:], total))
        return self._rows(pieces)

    def finish(self) -> list[tuple]:
        rows, left = [], sum(x * len(q) for x, q in self.waiting.items())
        while left:
            fits = min(self.capacity, 1 << (left.bit_length() - 1))
            rows += self._bin(fits)
            left -= fits
        return rows


def pack(docs, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048, end: int = 1):
    """A row of SCHEMA for each piece of each document."""

    def out(rows):
        cols = zip(*rows, strict=True) if rows else [[]] * 7
        return pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=[f.split()[0] for f in SCHEMA.split(", ")])

    def packed(batches):
        own, packer = WordPieces(path), Packer(capacity, TaskContext.get().partitionId())
        for batch in batches:
            for part in chunks(batch, text, CHUNK):
                rows = []
                for key, ids in zip(part.column(0).to_pylist(), own.encode_column(part.column(1), end), strict=True):
                    rows += packer.add(key, ids)
                yield out(rows)
        yield out(packer.finish())

    def run(batches):
        with frugal():  # outside packed(), whose tokenizer and pools are gone by then
            yield from packed(batches)

    return docs.select(doc_id, text).mapInArrow(run, SCHEMA)


def op8_minimum_bin_slack(spark, sf_dir):
    return pack(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), public_tokenizers.path("word_bpe_49k.json"))
