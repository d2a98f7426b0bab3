"""Language identification by a linear-chain conditional random field over the words of a text.

Features of a word are its character n-grams of 1 to 4 with marks at both ends (those with a
mark are its affixes), hashed to WEIGHTS rows of weights, and the languages whose learned
lexicon has the word.  Transitions between the languages of neighbouring words and the first
word's language are learned with them, by gradient on the exact likelihood.  A chain ends at
a full stop, exclamation or question mark (see ENDS) or line feed.  Words are labelled by
forward-backward over all chains of a chunk of texts at once; a text's language is that with
the largest sum of posteriors over its words, and the score is its share.

Every non-null language is learned.  Training rows are a bounded sample: DOCS documents of each
language, chosen by a hash, and WINDOWS windows of WIDTH words of each language from them;
chains for training join windows of two languages now and then, so that switches are learned.

Defined cases: `und` with score 0 for a null text or one without a letter, and for all texts
if nothing could be learned; ties go to the language that sorts first; a null doc_id is
neither held out nor learned from; repeated rows are predicted each; a text of any length is
labelled whole, in blocks of its words; other columns pass through but for those that
the results' names displace; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import chunks, frugal, hash_limit, spread, table, units

#: Bounds of the training sample and size of the model.
DOCS, WINDOWS, WIDTH, LEXICON, WEIGHTS = 300, 3000, 24, 4000, 1 << 17
EPOCHS, BATCH, RATE, SWITCHES = 6, 256, 0.15, 0.3
GRAMS = (1, 2, 3, 4)
#: Bytes of text whose words are worked on at a time, and numbers that a step over words or characters and languages holds.
CHUNK, CELLS = 4 << 20, 1 << 20
#: What ends a sentence, in several scripts.
ENDS = frozenset(".!?\n\u0964\u0965\u061f\u06d4\u3002\uff01\uff1f\u0589\u1362")
MARKS = "".join(sorted(ENDS))
TOKEN = re.compile(rf"[^\W\d_]+|[{MARKS}]")
#: Letters and the marks that combine with them.
WORDS = regex.compile(rf"[\p{{L}}\p{{M}}]+|[{MARKS}]")


def words_of(text: str) -> list[str]:
    """Lower-cased words with a letter, and the marks that end chains."""
    if text.isascii():
        return TOKEN.findall(text.lower())
    return [w for w in WORDS.findall(text.lower()) if w in ENDS or any(map(str.isalpha, w))]


def gram_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The weight rows of all n-grams of all words, and where each word's begin."""
    joined = "".join(f"\x02{w}\x03" for w in words)
    c = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.repeat(np.cumsum(lengths), lengths)
    at, rows = np.arange(len(c)), np.full((len(c), len(GRAMS)), -1, np.int64)
    acc = np.zeros(len(c), np.uint64)
    for j in range(max(GRAMS)):
        shifted = np.zeros_like(c)
        shifted[: len(c) - j] = c[j:]
        acc = (acc + shifted + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(29)
        if j + 1 in GRAMS:
            rows[:, GRAMS.index(j + 1)] = np.where(at + j < ends, (acc >> np.uint64(20)) % np.uint64(WEIGHTS), WEIGHTS)
    return rows, np.cumsum(lengths) - lengths


@dataclass
class Crf:
    languages: list[str]
    weights: np.ndarray  # (WEIGHTS + 1, K); the last row stands for no feature and stays 0
    lexicon: dict[str, bytes]  # bits of the languages that have the word, the first language's lowest
    in_lexicon: np.ndarray  # (K, K): what being in a language's lexicon says for each language
    first: np.ndarray
    then: np.ndarray  # (K, K): from, to

    def _lexical(self, words: list[str]) -> np.ndarray:
        k = len(self.languages)
        none = bytes(-(-k // 8))
        bits = np.frombuffer(b"".join(self.lexicon.get(w, none) for w in words), np.uint8).reshape(len(words), len(none))
        return np.unpackbits(bits, axis=1, count=k, bitorder="little").astype(np.float32)

    def emissions(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.languages)), np.float32)
        most, at, ends = CELLS // len(self.languages), 0, np.cumsum([len(w) + 2 for w in words])
        while at < len(words):
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
            rows, starts = gram_rows(words[at:end])
            out[at:end] = self.scores(rows, starts) + self._lexical(words[at:end]) @ self.in_lexicon
            at = end
        return out

    def scores(self, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The summed weights of each word's n-grams."""
        per_place = self.weights[rows[:, 0]]
        for j in range(1, len(GRAMS)):
            per_place += self.weights[rows[:, j]]
        return np.add.reduceat(per_place, starts, axis=0)

    def posteriors(self, emitted: np.ndarray, lengths: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
        """Forward-backward over chains of these lengths that lie one after another in `emitted`; adds expected transitions to `pairs`."""
        e = np.exp(emitted - emitted.max(axis=1, keepdims=True))
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = (np.cumsum(lengths) - lengths)[order], lengths[order]
        then, alpha = np.exp(self.then), np.empty_like(e)
        active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0] if len(lengths) else 0), side="right")
        for t, n in enumerate(active):
            at = starts[:n] + t
            a = (np.exp(self.first) if t == 0 else prior[:n] @ then) * e[at]
            prior = a / a.sum(axis=1, keepdims=True)
            alpha[at] = prior
        gamma = alpha.copy()
        for t in range(len(active) - 2, -1, -1):
            n = active[t + 1]
            at = starts[:n] + t
            beta = e[at + 1] * (later[:n] if t + 2 < len(active) else 1)
            if t + 2 < len(active) and active[t + 2] < n:
                beta[active[t + 2] :] = e[at[active[t + 2] :] + 1]
            back = beta @ then.T
            both = alpha[at] * back
            total = both.sum(axis=1, keepdims=True)
            gamma[at] = both / total
            if pairs is not None:
                pairs += ((alpha[at] / total).T @ beta) * then
            back /= back.sum(axis=1, keepdims=True)
            later = np.ones((active[t], e.shape[1]), e.dtype)
            later[:n] = back
        return gamma

    def label_words(self, text: str) -> list[tuple[str, str, float]]:
        """(word, language, posterior) of each word."""
        flat, chains = _chains([words_of(text)])
        if not flat:
            return []
        g = self.posteriors(self.emissions(flat), chains)
        return [(w, self.languages[k], float(p)) for w, k, p in zip(flat, g.argmax(axis=1), g.max(axis=1), strict=True)]


def _chains(texts: list[list[str]]) -> tuple[list[str], np.ndarray]:
    flat, lengths = [], []
    for words in texts:
        n = 0
        for w in words:
            if w in ENDS:
                lengths += [n] * (n > 0)
                n = 0
            else:
                flat.append(w)
                n += 1
        lengths += [n] * (n > 0)
    return flat, np.array(lengths, np.int64)


def train(windows: list[tuple[str, str]], seed: int = 7) -> Crf | None:
    """windows: (language, words joined by spaces)."""
    windows = sorted((a, b.split(" ")) for a, b in windows if b)
    languages = sorted({a for a, _ in windows})
    k = len(languages)
    if not k:
        return None
    rng = np.random.default_rng(seed)
    number = {a: i for i, a in enumerate(languages)}
    counts: list[dict[str, int]] = [{} for _ in languages]
    for a, words in windows:
        for w in words:
            counts[number[a]][w] = counts[number[a]].get(w, 0) + 1
    bits: dict[str, int] = {}
    for i, c in enumerate(counts):
        for w in sorted((w for w in c if c[w] > 1), key=lambda w: (-c[w], w))[:LEXICON]:
            bits[w] = bits.get(w, 0) | 1 << i
    lexicon = {w: x.to_bytes(-(-k // 8), "little") for w, x in bits.items()}
    model = Crf(languages, np.zeros((WEIGHTS + 1, k), np.float32), lexicon, np.zeros((k, k), np.float32), np.zeros(k, np.float32), np.zeros((k, k), np.float32))
    sums = [np.full_like(x, 1e-6) for x in (model.weights, model.in_lexicon, model.first, model.then)]

    def step(x: np.ndarray, total: np.ndarray, grad: np.ndarray) -> None:
        total += grad * grad
        x += RATE * grad / np.sqrt(total)

    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            words, labels, lengths = [], [], []
            for i in order[at : at + BATCH]:
                a, w = windows[i]
                b, other = windows[rng.integers(len(windows))]
                cut = int(rng.integers(1, len(w) + 1)) if rng.random() < SWITCHES else len(w)
                tail = other[: len(w) - cut]
                words += w[:cut] + tail
                labels += [number[a]] * cut + [number[b]] * len(tail)
                lengths.append(cut + len(tail))
            y, lengths = np.array(labels), np.array(lengths, np.int64)
            distinct: dict[str, int] = {}
            codes = np.array([distinct.setdefault(w, len(distinct)) for w in words])
            names = list(distinct)
            rows, starts = gram_rows(names)
            lexical = model._lexical(names)
            pairs = np.zeros((k, k), np.float32)
            gamma = model.posteriors((model.scores(rows, starts) + lexical @ model.in_lexicon)[codes], lengths, pairs)
            observed = np.eye(k, dtype=np.float32)[y]
            diff = observed - gamma
            per_word = np.stack([np.bincount(codes, diff[:, i], len(names)) for i in range(k)], axis=1).astype(np.float32)
            place = np.repeat(np.arange(len(names)), np.diff(np.append(starts, len(rows))))
            used, at_used = np.unique(rows, return_inverse=True)  # the rows of weights that the batch has
            at_used = at_used.reshape(rows.shape)
            grad = np.zeros((len(used), k), np.float32)
            for i in range(k):
                w = per_word[place, i]
                for j in range(len(GRAMS)):
                    grad[:, i] += np.bincount(at_used[:, j], w, len(used))
            grad[used == WEIGHTS] = 0
            begin = np.cumsum(lengths) - lengths
            inner = np.ones(len(y), bool)
            inner[begin] = False
            to = np.flatnonzero(inner)
            seen = np.zeros((k, k), np.float32)
            np.add.at(seen, (y[to - 1], y[to]), 1)
            sums[0][used] += grad * grad
            model.weights[used] += RATE * grad / np.sqrt(sums[0][used])
            step(model.in_lexicon, sums[1], lexical.T @ per_word)
            step(model.first, sums[2], diff[begin].sum(axis=0))
            step(model.then, sums[3], seen - pairs)
    return model


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_windows(docs: DataFrame, doc_id: str, text: str, lang: str) -> list[tuple[str, str]]:
    """The bounded sample; `docs` are those that may be learned from."""
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    doc_id, text, lang = "id", "text", "lang"
    counts = usable.groupBy(lang).count().collect()
    if not counts:
        return []
    # Twice as many as needed on average, then the first by hash.
    limits = docs.sparkSession.createDataFrame([(r[0], hash_limit(min(1.0, 2 * DOCS / r[1]))) for r in counts], "_lang string, _most long")
    chosen = usable.join(F.broadcast(limits), F.col(lang) == F.col("_lang")).where(F.xxhash64(F.lit(3), doc_id) <= F.col("_most"))
    ranked = chosen.withColumn("_r", F.row_number().over(Window.partitionBy(lang).orderBy(F.xxhash64(F.lit(3), doc_id), text)))

    def cut(batches):
        for batch in batches:
            langs, parts = [], []
            for a, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                w = [x for x in words_of(text) if x not in ENDS]
                found = [" ".join(w[i : i + WIDTH]) for i in range(0, len(w), WIDTH)]
                langs += [a] * len(found)
                parts += found
            yield pa.record_batch([pa.array(langs, pa.string()), pa.array(parts, pa.string())], names=["lang", "words"])

    windows = ranked.where(F.col("_r") <= DOCS).select(lang, text).mapInArrow(cut, "lang string, words string")
    few = windows.withColumn("_r", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("words"), "words"))).where(F.col("_r") <= WINDOWS)
    return [(r[0], r[1]) for r in few.select("lang", "words").collect()]


def predict_column(model: Crf, col: pa.Array) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    codes, offsets, distinct = units(col)
    known: dict[str, int] = {}
    parsed = []  # of each unit: numbers of its words, -1 where a chain ends
    for u in distinct.to_pylist():
        parsed.append([-1 if w in ENDS else known.setdefault(w, len(known)) for w in words_of(u)])
    n_of = np.fromiter(map(len, parsed), np.int64, len(parsed))
    flat_units = np.fromiter((x for p in parsed for x in p), np.int32, int(n_of.sum()))
    unit_starts = np.cumsum(n_of) - n_of
    emitted = model.emissions(list(known))
    k = len(model.languages)
    block = max(1, CELLS // k)
    names, scores = [], []
    row, sizes = 0, np.concatenate(([0], np.cumsum(n_of[codes])))[offsets]
    while row < len(col):
        end = max(row + 1, int(np.searchsorted(sizes, sizes[row] + block, side="right")) - 1)
        at = codes[offsets[row] : offsets[end]]
        n = n_of[at]
        ends = np.cumsum(n)
        words = flat_units[np.arange(ends[-1] if len(ends) else 0) + np.repeat(unit_starts[at] - (ends - n), n)]
        bounds = sizes[row : end + 1] - sizes[row]
        # A chain also ends with its text: the word before a new text or a mark is the last of one.
        is_word = words >= 0
        doc = np.repeat(np.arange(end - row), np.diff(bounds))
        chain = np.cumsum(~is_word) + doc
        w, d, c = words[is_word], doc[is_word], chain[is_word]
        sums = np.zeros((end - row, k))
        if len(w):
            new = np.concatenate(([True], c[1:] != c[:-1]))
            gamma = model.posteriors(emitted[w], np.diff(np.append(np.flatnonzero(new), len(w))))
            for i in range(k):
                sums[:, i] = np.bincount(d, gamma[:, i], end - row)
        total, best = sums.sum(axis=1), sums.argmax(axis=1)
        for i in range(end - row):
            names.append(model.languages[best[i]] if total[i] else "und")
            scores.append(min(1.0, float(sums[i, best[i]] / total[i])) if total[i] else 0.0)
        row = end
    return names, scores


def identify(docs: DataFrame, model: Crf | None, text: str = "text", prefix: str = "") -> DataFrame:
    """The columns of docs with lang_pred and score, their names after `prefix`; columns of docs with these names give way."""
    names = [f"{prefix}lang_pred", f"{prefix}score"]
    docs = docs.drop(*names)
    if model is None:
        return docs.withColumns({names[0]: F.lit("und"), names[1]: F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def told(part):
        said, scores = predict_column(shared.value, part.column(place))
        return pa.record_batch([*part.columns, pa.array(said, pa.string()), pa.array(scores, pa.float64())], names=[*part.schema.names, *names])

    def run(batches):
        with frugal():
            for batch in batches:
                yield from map(told, chunks(batch, text, CHUNK))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{schema}, `{names[0]}` string, `{names[1]}` double")


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Crf | None:
    return train(training_windows(docs.where(~held_out(doc_id)), doc_id, text, lang))


def op1_crf_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs)
    named = identify(spread(docs.select("doc_id", "text")), model)
    return named.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
