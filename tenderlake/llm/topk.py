"""Exact top-k by integer inner product with MaxScore over shards of the candidates.

A query's terms are its dimensions.  A shard holds its candidates by dimension, in small blocks
of similar vectors; of each block it knows the largest and smallest value in every dimension,
hence the most that a term can add to a score there.  A query takes the blocks in the order of
their bounds, a few at first and twice as many each time:

1. Blocks whose bounds together can't reach the k-th best score so far are left out.
2. Terms are sorted by bound and split: the last ones, whose bounds together can't reach that
   score, are non-essential.  The lists of the essential terms are traversed for all candidates of the blocks.
3. The other terms are probed a few at a time, only for candidates whose score plus what is still
   possible in their block is competitive.

While a query has fewer than k results every term is essential.  Query blocks and candidate shards of
bounded size meet as groups of a cogroup, so nothing is broadcast or collected, and each group's k best
per query are merged by a window.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part; vectors of
different lengths are compared as if the shorter were continued with zeros (so one very long vector makes all be
read as long as it, and the search slower); ties go to the
smaller id; repeated ids are separate candidates, and queries of their own, with a list each, but a query
never finds rows with its own id; a null id takes no part; scaled components and scores beyond 64 bits become the
nearest number of 64 bits; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, frugal, table

#: Components of a candidate shard or a block of queries; rows from which a shard is split where tasks are free.
GROUP_CELLS, SPLIT_ROWS = 1 << 22, 4096
#: Candidates of a block that has bounds of its own, and non-essential terms that are probed at a time.
BLOCK, PROBE = 32, 4
#: Rows by whose nearest one a shard is put in order.
PIVOTS = 256
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def scaled(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(seq, vec_id, v): floor(scale * x) of each component, of the vectors that take part; seq numbers the rows once stored."""
    x = F.col(embedding)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == math.inf))
    usable = vectors.where(F.col(vec_id).isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~bad)
    return usable.select(F.monotonically_increasing_id().alias("seq"), F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))


def _matrix(col: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of the list column, continued with zeros."""
    col = col.combine_chunks()
    lengths = np.asarray(col.value_lengths(), np.int64)
    out = np.zeros((len(lengths), max(width, int(lengths.max(initial=0)))), np.int64)
    flat = np.asarray(col.flatten(), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _similar(rows: np.ndarray) -> np.ndarray:
    """An order in which neighbours are similar: by the nearest of some rows, then by length."""
    x = rows.astype(np.float64)
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    pivots = x[:: -(-len(x) // min(PIVOTS, len(x)))]
    pivots = pivots / np.maximum(1e-300, np.sqrt(np.einsum("ij,ij->i", pivots, pivots)))[:, None]
    return np.lexsort((-norm, (x @ pivots.T).argmax(axis=1)))


class Shard:
    """Candidates by term and in blocks, and how many of their components searches have looked at."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, largest_weight: int):
        order = _similar(rows) if len(rows) else np.zeros(0, np.int64)
        self.ids, rows = ids[order], rows[order]
        most = largest_weight * max(map(abs, (int(rows.max(initial=0)), int(rows.min(initial=0))))) * max(1, rows.shape[1])
        # Doubles are exact below 2**53 and multiply fastest, then integers of 64 bits; beyond, Python's.
        self.kind = np.float64 if most < 1 << 52 else np.int64 if most < 1 << 62 else object
        starts = np.arange(0, len(rows), BLOCK)
        self.lists = np.ascontiguousarray(rows.T.astype(self.kind))
        self.high, self.low = (f.reduceat(rows, starts, axis=0).astype(self.kind) if len(rows) else rows.astype(self.kind) for f in (np.maximum, np.minimum))
        self.looked_at = 0

    def search(self, weights: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the k best, best first, rows with the query's own id aside."""
        w = weights.astype(self.kind)
        bounds = np.maximum(w * self.high, w * self.low)
        total = bounds.sum(axis=1)
        blocks = np.argsort(-total, kind="stable")
        scores, ids, floor = np.zeros(0, self.kind), np.zeros(0, np.int64), None
        at, some = 0, -(-(k + 1) // BLOCK)
        while at < len(blocks):
            now = blocks[at : at + some]
            at, some = at + some, some * 2
            if floor is not None:
                now = now[total[now] >= floor]
                if not len(now):
                    break
            s, i = self._competitive(w, bounds[now], now, floor)
            mine = i != own
            scores, ids = np.concatenate((scores, s[mine])), np.concatenate((ids, i[mine]))
            best = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[best], ids[best]
            if len(ids) == k:
                floor = scores[-1]  # a tie can still win by its id
        return scores, ids

    def _competitive(self, w: np.ndarray, bounds: np.ndarray, blocks: np.ndarray, floor) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the candidates of these blocks that reach the floor."""
        terms = np.argsort(-bounds.max(axis=0), kind="stable")
        rest = np.concatenate((np.cumsum(bounds[:, terms][:, ::-1], axis=1)[:, ::-1], np.zeros((len(blocks), 1), bounds.dtype)), axis=1)  # the most that the terms from here on give, by block
        done = len(terms)
        if floor is not None and (low := rest.max(axis=0) < floor).any():
            done = int(np.argmax(low))
        place = np.minimum(blocks[:, None] * BLOCK + np.arange(BLOCK), len(self.ids)).ravel()
        block = np.repeat(np.arange(len(blocks)), BLOCK)[place < len(self.ids)]
        place = place[place < len(self.ids)]
        essential = terms[:done]
        score = w[essential] @ self.lists[np.ix_(essential, place)] if done else np.zeros(len(place), self.kind)
        self.looked_at += done * len(place)
        while done < len(terms):
            stays = score + rest[block, done] >= floor
            place, block, score = place[stays], block[stays], score[stays]
            if not len(place):
                break
            probe = terms[done : done + PROBE]
            score = score + w[probe] @ self.lists[np.ix_(probe, place)]
            self.looked_at += len(probe) * len(place)
            done += len(probe)
        if floor is not None:
            place, score = place[score >= floor], score[score >= floor]
        if self.kind is object:
            score = np.minimum(np.maximum(score, LEAST), MOST)
        return score, self.ids[place]


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) over tables of scaled(), each of them stored, as they are read several times."""
    n, width = candidates.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    asked, wide = queries.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = max(width or 1, wide or 1)
    tasks = candidates.sparkSession.sparkContext.defaultParallelism
    shards = max(1, -(-n * width // GROUP_CELLS), min(-(-n // SPLIT_ROWS), tasks))
    blocks = max(1, -(-asked * width // GROUP_CELLS))
    dealt = lambda df, mine, n, other, m: df.select("seq", "vec_id", "v", F.pmod(F.xxhash64("seq"), F.lit(n)).cast("int").alias(mine), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))
    left, right = dealt(candidates, "shard", shards, "block", blocks), dealt(queries, "block", blocks, "shard", shards)

    def run(own: pa.Table, asked: pa.Table) -> pa.Table:
        if not own.num_rows or not asked.num_rows:
            return pa.table([[]] * 4, schema=pa.schema([(c, pa.int64()) for c in ("seq", "query_id", "vec_id", "score")]))
        with frugal():
            rows = _matrix(own["v"], width)
            vectors = _matrix(asked["v"], width)
            shard = Shard(np.asarray(own["vec_id"], np.int64), rows, max(abs(int(vectors.max(initial=0))), abs(int(vectors.min(initial=0)))))
            seqs, names, parts = np.asarray(asked["seq"], np.int64), np.asarray(asked["vec_id"], np.int64), []
            for seq, name, v in zip(seqs.tolist(), names.tolist(), vectors, strict=True):
                scores, ids = shard.search(v, name, k)
                parts.append((np.full(len(ids), seq), np.full(len(ids), name), ids, scores.astype(np.int64)))
            cols = [np.concatenate([np.zeros(0, np.int64), *c]) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 4
            return pa.table(dict(zip(("seq", "query_id", "vec_id", "score"), cols, strict=True)))

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(run, "seq long, query_id long, vec_id long, score long")
    order = Window.partitionBy("seq").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_maxscore(spark, sf_dir):
    vectors = Scratch(spark, "vectors").save(scaled(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 1024))
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
