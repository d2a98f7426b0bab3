"""Spelling variants by anagram hashing.

A word's key is the sum of a power of each of its letters, so it does not depend on their order.  Adding, removing or
exchanging a letter changes the key by that letter's value or by the difference of two.  Words are near if the keys that
remain after taking one letter out meet: the whole key of the shorter word with a reduced one of the longer (a
letter added or removed), or reduced keys of both (a letter exchanged).  Keys say nothing of the order: of two words one edit apart, the
letters before or those after their middle are the same, which is part of the join, and the words that meet are compared in full.

Defined cases: a null text has no words; a null doc_id is the text `null` in the noise; texts are read whole, whatever
their length, and words may be of any length; repeated rows count each; ties go to the smallest word in the order of code
points; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.session import Scratch

from .coded import CHUNK, byte_table, with_bytes, without
from .common import chunks, frugal, spread, table, units

#: Keys are sums of this power of code points, modulo a prime that no real word's sum reaches.
POWER, PRIME = 5, (1 << 61) - 1
#: A word counts if it has so many code points and so many occurrences; a form has FACTOR times the occurrences of the word.
LETTERS, LEAST, FACTOR = 6, 5, 5
#: One in so many runs of a document loses a letter (the query's planted noise).
NOISE = 199


def split_runs(col: pa.Array):
    """Codes of the maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case."""
    lower = byte_table(space=" ")
    letters = np.zeros(256, bool)
    letters[ord("a") : ord("z") + 1] = True

    def change(data):
        """Each of U+00C0 to U+00FF is the byte C3 and one more."""
        out = lower[data]
        lead = data == 0xC3
        stay = letters[out] | lead
        stay[1:] |= lead[:-1]
        return np.where(stay, out, 32).astype(np.uint8)

    codes, offsets, words = units(with_bytes(col, change))
    mark = words.index("").as_py()
    return (*(without(codes, offsets, mark) if mark >= 0 else (codes, offsets)), words)


def word_counts(docs: DataFrame, doc_id: str, text: str, letters: int = LETTERS, noise: int | None = None) -> DataFrame:
    """(word, n) over all documents of words of at least so many code points; chunks count first, so only distinct words are shuffled."""

    def told(batches):
        for batch in batches:
            for part in chunks(batch, text, CHUNK):
                codes, offsets, words = split_runs(part.column(1))
                runs = words.to_pylist()
                # Occurrences of each distinct pair of document and run.
                of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
                pairs, n = np.unique(of * max(1, len(runs)) + codes, return_counts=True)
                row, code = np.divmod(pairs, max(1, len(runs)))
                total = np.bincount(code, weights=n, minlength=len(runs)).astype(np.int64)
                made: dict[str, int] = {}
                if noise:
                    encoded = [r.encode() for r in runs]
                    starts = [zlib.crc32(f"{'null' if d is None else d}:".encode()) for d in part.column(0).to_pylist()]
                    hashes = np.fromiter((zlib.crc32(encoded[c], starts[r]) for r, c in zip(row.tolist(), code.tolist(), strict=True)), np.uint32, len(row))
                    for i in np.flatnonzero(hashes % noise == 0).tolist():
                        c = int(code[i])
                        at = int(hashes[i]) % len(runs[c])
                        new = runs[c][:at] + runs[c][at + 1 :]
                        total[c] -= n[i]
                        made[new] = made.get(new, 0) + int(n[i])
                found = [(r, int(t)) for r, t in zip(runs, total.tolist(), strict=True) if t and len(r) >= letters] + [(r, t) for r, t in made.items() if len(r) >= letters]
                yield pa.record_batch([pa.array([r for r, _ in found], pa.string()), pa.array([t for _, t in found], pa.int64())], names=["word", "n"])

    def run(batches):
        with frugal():
            yield from told(batches)

    return docs.select(F.col(doc_id).cast("string"), text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def anagram_key(word: str):
    """The sum of a power of each letter, by arithmetic on columns."""
    letters = F.transform(F.split(word, ""), lambda c: F.pow(F.ascii(c), F.lit(POWER)).cast("long"))
    return F.aggregate(letters, F.lit(0).cast("long"), lambda a, b: (a + b) % PRIME)


def near_words(words: DataFrame) -> DataFrame:
    """(word, other) of (word, ...): both directions of all pairs one inserted, deleted or replaced code point apart.

    A row of `keys` is a word's key without one of its letters, under half of the word: with the letters before its middle or those
    after it.  A word of L letters meets words of L letters with one taken out of each, and, as it is, words of L + 1 letters.
    """
    base = words.select("word", anagram_key("word").alias("key"), F.char_length("word").alias("size"))
    letter = F.explode(F.array_distinct(F.split("word", "")))
    out = F.pow(F.ascii("letter"), F.lit(POWER)).cast("long")
    reduced = base.select("word", "key", "size", letter.alias("letter")).select("word", "size", ((F.col("key") - out) % PRIME).alias("key"))

    def halves(df: DataFrame, left, right) -> DataFrame:
        """left letters from the beginning, or right letters to the end; 0 of either say nothing."""
        side = lambda name, part: F.struct(F.lit(name).alias("side"), F.xxhash64(part).alias("half"))
        return df.select("word", "size", "key", F.explode(F.array(side("l", F.left("word", left)), side("r", F.right("word", right)))).alias("x")).select("word", "size", "key", "x.*")

    # Words of equal length: the change is before the middle or after it.
    middle = F.floor(F.col("size") / 2).cast("int")
    same = halves(reduced, middle, F.col("size") - middle)
    a = same.select(F.col("word").alias("a"), "size", "key", "side", "half")
    b = same.select(F.col("word").alias("b"), "size", "key", "side", "half")
    changed = a.join(b, ["size", "key", "side", "half"]).where("a < b AND levenshtein(a, b, 1) = 1").select("a", "b")
    # The longer word without a letter before its middle has the shorter one's end, without a later one its beginning.
    shorter = F.floor((F.col("size") - 1) / 2).cast("int")
    longer = halves(reduced, shorter, F.col("size") - 1 - shorter).withColumn("size", F.col("size") - 1)
    whole = halves(base.select("word", "size", "key"), middle, F.col("size") - middle)
    c = longer.select(F.col("word").alias("a"), "size", "key", "side", "half")
    d = whole.select(F.col("word").alias("b"), "size", "key", "side", "half")
    cut = c.join(d, ["size", "key", "side", "half"]).where("levenshtein(a, b, 1) = 1").select("a", "b")
    pairs = changed.unionByName(cut).distinct()
    return pairs.select(F.inline(F.array(*[F.struct(F.col(x).alias("word"), F.col(y).alias("other")) for x, y in ("ab", "ba")])))


def group_variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n).

    The form is the near word of largest n, if that is factor times the word's.  Forms grow by that factor, so following them ends; steps
    double over stored tables until all words have reached their roots.
    """
    scratch = Scratch(words.sparkSession, "spelling", sent=False)
    words = scratch.save(words.select("word", "n"), "words")
    near = scratch.save(near_words(words), "near")
    counted = near.join(words.select(F.col("word").alias("other"), F.col("n").alias("m")), "other")
    best = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("rank"), "other")).alias("best"))
    fits = -F.col("best.rank") >= factor * F.col("n")
    formed = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, F.col("best.other")).alias("form"), F.when(fits, -F.col("best.rank")).alias("form_n"))
    formed = scratch.save(formed, "formed")
    climbing = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # each root is 2^k forms away, or the last
        up = climbing.select(F.col("word").alias("root"), F.col("root").alias("next"))
        climbed = scratch.save(climbing.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("more")), "roots")
        climbing = climbed.select("word", "root")
        if climbed.where("more").isEmpty():
            break
    return formed.join(climbing, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_anagram_variants(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return group_variants(word_counts(docs, "doc_id", "text", noise=NOISE).where(F.col("n") >= LEAST))


#: The hash of each run is folded over its bytes; words near each other meet under what is left without one letter, at the same place.
OP12_SQL = r"""WITH t AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS crc),
r AS (SELECT doc_id, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS x FROM documents) GROUP BY ALL),
b AS (SELECT *, flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [195, ord(c) - 64] END)) AS bytes FROM r),
h AS (SELECT run, n, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, crc[CAST(xor(c & 255, x) AS BIGINT) + 1]), 4294967295), 4294967295) AS h FROM b, t),
s AS (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM h),
w AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM s WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
d AS MATERIALIZED (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM w)),
p AS (SELECT DISTINCT word, rest AS other FROM d WHERE rest IN (SELECT word FROM w)),
near AS (SELECT word, other FROM p UNION SELECT other, word FROM p UNION SELECT x.word, y.word FROM d x JOIN d y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word),
best AS (SELECT near.word, count(*) AS n_near, arg_min(other, (-m.n, other)) AS other, max(m.n) AS m FROM near JOIN w m ON m.word = other GROUP BY near.word),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * w.n THEN other END AS form, CASE WHEN m >= 5 * w.n THEN m END AS form_n FROM w LEFT JOIN best USING (word)),
up AS (WITH RECURSIVE c(word, here, form) AS (SELECT word, word, form FROM f UNION ALL SELECT c.word, f.word, f.form FROM c JOIN f ON f.word = c.form) SELECT word, here AS root FROM c WHERE form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN up USING (word)"""
