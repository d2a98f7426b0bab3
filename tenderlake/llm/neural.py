"""Scores of texts by a log-bilinear neural language model.

The score of a token v after i, with j before that, is Q[v] . (A[i] + B[j]) + b[v]: a table of vectors for each place of the context, one
for what follows, and a bias.  The most frequent tokens are classes of their own, all others one more class; within that, a token's
probability is its smoothed share of the counts, over the tokens seen and one that was not.  So all tokens' probabilities sum to one.

Training is noise-contrastive estimation: tell the true token from noise drawn by frequency.  Each task goes once over its own documents;
the vectors of all tasks are averaged by how often each was used, in rounds that share out the documents.  All documents that may be
learned from are used, small corpora several times.

As scores are sums over two context places, the normaliser of all pairs of contexts is one product of two matrices of
exponentials: log Z[i, j] = log sum over v of exp(A[i].Q[v] + b[v]) exp(B[j].Q[v]).

Defined cases: a null or empty text is its end token only; a null doc_id counts as an empty one when documents are dealt to training and
held-out ones; texts are scored whole, whatever their length; repeated rows count and are scored each; ties for the last class go to
the smaller token; without anything to learn from every token has probability 1; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.session import Scratch

from .coded import ROW_GROUPS, coded, for_chunks, save, split_words, words_of
from .common import frugal, spread, table

#: Classes, with the one for all other tokens; numbers of a vector.
CLASSES, WIDTH = 2048, 32
#: Tokens of a step, noise tokens they share, rate and first squared gradient of AdaGrad.
STEP, NOISE, RATE, FLOOR = 512, 64, 0.1, 0.1
#: Equal tokens in equal contexts that count as one row of a step at most.
TOGETHER = 8
#: Averagings; tokens that training sees at least, by going over small corpora again, but not more often than PASSES times.
ROUNDS, TOKENS, PASSES = 2, 2_000_000, 4
#: Tokens that are scored at a time, and contexts that are normalised at a time.
BLOCK, ROWS = 1 << 20, 256
LN10 = float(np.log(10))


def held_out(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 1


@dataclasses.dataclass
class Model:
    """Vectors, and what counts say: the classes' tokens in order, their share as noise, the tokens learned from and how many are distinct."""

    tokens: list[str]
    noise: np.ndarray
    a: np.ndarray
    b: np.ndarray
    q: np.ndarray  # the bias is the last column
    n: int
    distinct: int
    rest: float  # the weight of all tokens without a class, unseen ones included

    @classmethod
    def fresh(cls, top: list[tuple[str, int]], n: int, distinct: int) -> Model:
        rng = np.random.default_rng(0)
        named = np.array([c for _, c in top], float)
        weights = np.append(named + 0.5, n - named.sum() + 0.5 * (distinct - len(top) + 1))
        noise = weights / weights.sum()
        a, b, q = (rng.normal(scale=0.1, size=(len(noise), WIDTH + 1)).astype(np.float32) for _ in range(3))
        q[:, -1] = np.log(noise)
        return cls([t for t, _ in top], noise, a, b, q, n, distinct, float(weights[-1]))

    def classes(self, words: pa.Array) -> np.ndarray:
        found = pc.index_in(words, value_set=pa.array(self.tokens, words.type))
        return np.asarray(pc.fill_null(found, len(self.tokens)), dtype=np.int32)

    @property
    def start(self) -> int:
        """What stands before a text: an end."""
        return self.tokens.index("") if "" in self.tokens else len(self.tokens)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-probabilities of classes: those of v after (i, j) are first[i, v] + second[j, v] - norm[i, j]."""
        vectors, bias = self.q[:, :-1], self.q[:, -1]
        first, second = self.a[:, :-1] @ vectors.T + bias, self.b[:, :-1] @ vectors.T
        more = second.max(1, keepdims=True)
        right = np.exp((second - more).astype(float)).T
        norm = np.empty_like(first)
        for s in range(0, len(first), ROWS):
            some = first[s : s + ROWS]
            most = some.max(1, keepdims=True)
            norm[s : s + ROWS] = np.log(np.exp((some - most).astype(float)) @ right) + most + more.T
        return first, second, norm


def contexts(classes: np.ndarray, firsts: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The class before each token and the one before that; firsts: where texts begin."""
    one, two = np.empty_like(classes), np.empty_like(classes)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    one[firsts] = two[firsts] = start
    seconds = firsts[firsts + 1 < len(classes)] + 1
    two[seconds] = start
    return one, two


class Learner:
    """Noise-contrastive steps on one task's tokens."""

    def __init__(self, model: Model, seed: int):
        self.params = [model.a.copy(), model.b.copy(), model.q.copy()]
        self.squares = [np.full(p.shape, FLOOR, np.float32) for p in self.params]
        self.used = [np.zeros(len(p)) for p in self.params]
        self.model, self.rng = model, np.random.default_rng(seed)
        self.ends = np.cumsum(model.noise)
        self.log_noise = np.log(NOISE * model.noise).astype(np.float32)

    def _change(self, which: int, rows: np.ndarray, gradient: np.ndarray, weight: np.ndarray) -> None:
        """Adds the gradients of equal rows and takes one AdaGrad step up for each row."""
        order = np.argsort(rows, kind="stable")
        rows = rows[order]
        at = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        total, rows = np.add.reduceat(gradient[order], at, axis=0), rows[at]
        squares = self.squares[which][rows] + total * total
        self.squares[which][rows] = squares
        self.params[which][rows] += RATE * total / np.sqrt(squares)
        self.used[which][rows] += np.add.reduceat(weight[order], at)

    def step(self, i: np.ndarray, j: np.ndarray, v: np.ndarray, weight: np.ndarray) -> None:
        a, b, q = self.params
        h = a[i] + b[j]
        h[:, -1] = 1  # for the bias
        noise = np.minimum(np.searchsorted(self.ends, self.rng.random(NOISE)), len(self.ends) - 1)
        qv, qn = q[v], q[noise]
        true = weight / (1 + np.exp(np.einsum("ij,ij->i", h, qv) - self.log_noise[v]))  # 1 - P(true)
        false = -weight[:, None] / (1 + np.exp(self.log_noise[noise] - h @ qn.T))  # - P(true) of noise
        up = true[:, None] * qv + false @ qn
        up[:, -1] = 0
        self._change(2, np.concatenate((v, noise)), np.concatenate((true[:, None] * h, false.T @ h)), np.concatenate((weight, np.ones(NOISE, np.float32))))
        self._change(0, i, up, weight)
        self._change(1, j, up, weight)

    def learn(self, classes: np.ndarray, firsts: np.ndarray) -> None:
        """Once over all tokens: equal ones in equal contexts together, at most TOGETHER in a step's row."""
        k = len(self.model.noise)
        i, j = contexts(classes.astype(np.int64), firsts, self.model.start)
        keys, n = np.unique((i * k + j) * k + classes, return_counts=True)
        times = -(-n // TOGETHER)
        keys, weights = np.repeat(keys, times), np.repeat((n / times).astype(np.float32), times)
        order = self.rng.permutation(len(keys))
        for at in range(0, len(order), STEP):
            some = keys[order[at : at + STEP]]
            self.step(some // (k * k), some // k % k, some % k, weights[order[at : at + STEP]])


def _docs(batch: pa.RecordBatch) -> Iterator[tuple[pa.StructArray, np.ndarray, np.ndarray]]:
    """Documents, codes and offsets of each chunk of a batch."""
    for at in range(batch.num_rows):
        docs = pa.concat_arrays([batch.column("docs")[at].values])
        codes = docs.field("codes")
        offsets = np.asarray(codes.offsets, dtype=np.int64)
        yield docs, np.asarray(codes.values, dtype=np.int64)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array, pa.StructArray, np.ndarray, np.ndarray]]:
    """Number, words, documents, codes and offsets of each chunk of a batch of (chunk, words, docs)."""
    for at, told in enumerate(_docs(batch)):
        yield (batch.column("chunk")[at].as_py(), batch.column("words")[at].values, *told)


def _part(codes: np.ndarray, offsets: np.ndarray, stay: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the documents that stay, and where each begins."""
    n = np.diff(offsets)
    return codes[np.repeat(stay, n)], np.cumsum(np.append(0, n[stay][:-1])) if stay.any() else np.array([], np.int64)


def token_counts(chunked: DataFrame) -> DataFrame:
    """(token, n) over all documents that are not held out; chunks count first."""

    def told(batches):
        for batch in batches:
            for _, words, docs, codes, offsets in _rows(batch):
                mine, _ = _part(codes, offsets, ~np.asarray(docs.field("held"), dtype=bool))
                n = np.bincount(mine, minlength=len(words))
                at = pa.array(np.flatnonzero(n))
                yield pa.record_batch([words.take(at), pa.array(n[n > 0], pa.int64())], names=["word", "n"])

    return chunked.select("chunk", "words", "docs").mapInArrow(told, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def train(chunked: DataFrame, model: Model) -> Model:
    """The model after ROUNDS averagings."""
    if not model.n:
        return model
    passes = int(min(PASSES, max(1, -(-TOKENS // model.n))))
    names = ["a", "b", "q"]
    for r in range(ROUNDS):

        def told(batches, model=model, r=r):
            own = Learner(model, TaskContext.get().partitionId())
            for batch in batches:
                for number, words, docs, codes, offsets in _rows(batch):
                    mine = ~np.asarray(docs.field("held"), dtype=bool) & ((np.arange(len(docs)) + number) % ROUNDS == r)
                    part, firsts = _part(codes, offsets, mine)
                    classes = model.classes(words)[part]
                    for _ in range(passes):
                        own.learn(classes, firsts)
            for t in range(3):
                rows = np.flatnonzero(own.used[t])
                flat = pa.array(own.params[t][rows].astype(float).ravel())
                yield pa.record_batch([pa.array(np.full(len(rows), t), pa.int32()), pa.array(rows, pa.int32()), pa.array(own.used[t][rows]), pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * (WIDTH + 1), pa.int32()), flat)], names=["t", "row", "n", "x"])

        def run(batches, told=told):
            with frugal():
                yield from told(batches)

        made = chunked.select("chunk", "words", "docs").mapInArrow(run, "t int, row int, n double, x array<double>")
        mean = made.groupBy("t", "row").agg(*[(F.sum(F.col("n") * F.col("x")[k]) / F.sum("n")).alias(f"x{k}") for k in range(WIDTH + 1)]).collect()  # one row a vector
        new = {n: getattr(model, n).copy() for n in names}
        for row in mean:
            new[names[row[0]]][row[1]] = row[2:]
        model = dataclasses.replace(model, **new)
    return model


def score(docs: DataFrame, doc_id: str, text: str, held: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), log10: a model of the documents that are not held out, applied to all.

    base_score is that of the smoothed counts alone.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "neural")
    chunked = save(scratch, coded(docs.select(F.col(doc_id).alias("doc_id"), held.alias("held"), F.col(text).alias("text")), "text", split_words), "chunks", ROW_GROUPS)
    counts = save(scratch, token_counts(chunked), "counts")
    n, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = [(r[0], r[1]) for r in counts.orderBy(F.desc("n"), "word").limit(CLASSES - 1).collect()]
    model = train(chunked, Model.fresh(top, n, distinct))
    sent = spark.sparkContext.broadcast((model, model.tables()))
    # Documents are shuffled without their words: what counts say of these comes by position.
    named = spark.createDataFrame([(t, k) for k, t in enumerate(model.tokens)], "word string, class int")  # at most CLASSES rows
    known = counts.join(F.broadcast(named), "word", "left").select("word", "n", F.coalesce("class", F.lit(len(model.tokens))).alias("class"))
    places = words_of(chunked).join(known, "word").select(F.col("chunk").alias("of"), "pos", "n", "class")

    def told(docs: pa.StructArray, words: pa.Table) -> Iterator[pa.RecordBatch]:
        model, (first, second, norm) = sent.value
        rest, floor = len(model.tokens), np.log10(model.n + 0.5 * (model.distinct + 1))
        lists = docs.field("codes")
        offsets = np.asarray(lists.offsets, dtype=np.int64)
        codes, offsets = np.asarray(lists.values, dtype=np.int64)[offsets[0] : offsets[-1]], offsets - offsets[0]
        size = int(codes.max(initial=-1)) + 1
        c, own = np.zeros(size), np.full(size, rest, np.int32)
        pos = np.asarray(words.column("pos"))
        c[pos], own[pos] = np.asarray(words.column("n")), np.asarray(words.column("class"))
        logs = np.log10(c + 0.5)
        base, within = logs - floor, np.where(own == rest, logs - np.log10(model.rest), 0)
        classes, of = own[codes], np.repeat(np.arange(len(docs)), np.diff(offsets))
        one, two = contexts(classes, offsets[:-1], model.start)
        sums = np.zeros((3, len(docs)))
        for s in range(0, len(codes), BLOCK):
            w = slice(s, s + BLOCK)
            i, j, v = one[w], two[w], classes[w]
            found = (first[i, v].astype(float) + second[j, v] - norm[i, j]) / LN10 + within[codes[w]]
            for k, x in enumerate((found, base[codes[w]], (c > 0)[codes[w]])):
                sums[k] += np.bincount(of[w], weights=x, minlength=len(docs))
        lengths = pa.array(np.diff(offsets), pa.int64())
        yield pa.record_batch([docs.field("doc_id"), docs.field("held"), lengths, pa.array(sums[2].astype(np.int64)), pa.array(np.full(len(docs), model.n), pa.int64()), pa.array(sums[1]), pa.array(sums[0])], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    key = chunked.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()
    return for_chunks(chunked.select("chunk", "docs"), places, told, f"doc_id {key}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op11_log_bilinear(spark, sf_dir):
    return score(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", "text", held_out("doc_id"))
