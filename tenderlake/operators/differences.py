"""What changed between two versions of a text: runs of words or lines that were kept, deleted or inserted.

Spark joins the versions; a task compares one pair at a time.  The comparison is exact: a longest common subsequence, by Hirschberg's
division with bit-parallel rows.  It holds a bit for each word of one side and each distinct word, never a table of both sides.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What separates the parts that are compared.
WORDS, LINES = r"\s+", "\n"


def row_lengths(a: Sequence[int], b: Sequence[int]) -> np.ndarray:
    """The length of the longest common subsequence of a with each prefix of b, the empty one first.

    Bit j of `row` is 0 where the length grows with b[j]; one element of a is a few operations on the whole row.
    """
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        met = row & where.get(x, 0)
        row = ((row + met) | (row - met)) & full
    bits = np.unpackbits(np.frombuffer((row ^ full).to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate(([0], np.cumsum(bits, dtype=np.int64)))


def common(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence in both, in order."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        tail = []
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            tail.append((a1, b1))
        if a0 < a1 and b0 < b1:
            if a1 - a0 == 1:
                at = next((j for j in range(b0, b1) if b[j] == a[a0]), None)
                tail += [(a0, at)] if at is not None else []
            else:
                mid = (a0 + a1) // 2
                left, right = row_lengths(a[a0:mid], b[b0:b1]), row_lengths(a[mid:a1][::-1], b[b0:b1][::-1])
                cut = b0 + int(np.argmax(left + right[::-1]))
                work += [(mid, a1, cut, b1), (a0, mid, b0, cut)]
        out += tail
    return sorted(out)


def runs(a: Sequence[int], b: Sequence[int]) -> Iterator[tuple[str, int, int, int, int]]:
    """(change, a_from, a_to, b_from, b_to), ends excluded, from the beginning to the end of both."""
    at_a = at_b = 0
    matched = [*common(a, b), (len(a), len(b))]
    k = 0
    while k < len(matched):
        i, j = matched[k]
        if i > at_a:
            yield "deleted", at_a, i, at_b, at_b
        if j > at_b:
            yield "inserted", i, i, at_b, j
        n = 0
        while k < len(matched) - 1 and matched[k] == (i + n, j + n):
            k, n = k + 1, n + 1
        if n:
            yield "kept", i, i + n, j, j + n
        else:
            return
        at_a, at_b = i + n, j + n


def text_changes(pairs: DataFrame, versions: DataFrame, version_id: str, text: str, separator: str = WORDS) -> DataFrame:
    """(old, new, run, change, old_from, old_to, new_from, new_to, said) of pairs (old, new): the runs of each pair in order, with their words.

    Places count from 0, ends excluded.  Words are what lies between separators (a regular expression); white space around a text is none.
    Defined cases: a null or empty text has no words, so all of the other side is inserted or deleted, and two such texts have no runs; pairs
    with a version that isn't there are left out; repeated pairs count once; texts are compared whole, whatever their length; where several longest
    common subsequences exist, one is taken, always the same; empty tables give no rows.
    """
    # Texts are cut where they have met: as words they would take more than twice the place in the shuffles.
    side = lambda name: versions.select(F.col(version_id).alias(name), F.col(text).alias(f"{name}_text"))
    words = lambda name: F.split(F.btrim(f"{name}_text"), separator).alias(f"{name}_words")
    met = pairs.select("old", "new").distinct().join(side("old"), "old").join(side("new"), "new").select("old", "new", words("old"), words("new"))
    names = ["run", "change", "old_from", "old_to", "new_from", "new_to", "said"]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                old, new = ([w for w in batch.column(c)[row].as_py() or [] if w] for c in (2, 3))
                number: dict[str, int] = {}
                a, b = ([number.setdefault(w, len(number)) for w in side] for side in (old, new))
                found = [(k, change, i, j, x, y, " ".join(old[i:j] if change == "deleted" else new[x:y])) for k, (change, i, j, x, y) in enumerate(runs(a, b))]
                if found:
                    ids = [batch.column(c).take(pa.array([row] * len(found))) for c in (0, 1)]
                    cols = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int64(), pa.string(), *[pa.int64()] * 4, pa.string()), strict=True)]
                    yield pa.record_batch([*ids, *cols], names=["old", "new", *names])

    kinds = {c: met.schema[c].dataType.simpleString() for c in ("old", "new")}
    return met.mapInArrow(compared, f"old {kinds['old']}, new {kinds['new']}, run long, change string, old_from long, old_to long, new_from long, new_to long, said string")
