"""Pieces that several operators of this subpackage share: scratch tables in the shared folder and word units of texts.

A *unit* is what lies between two U+0020 in a text.  Texts of natural language repeat few
units often, so Arrow splits and dictionary-encodes a chunk of texts in C++, Python looks
only at the distinct units, and numpy gathers the results back into the order of the texts.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tenderlake.session import Scratch, shared_dir  # noqa: F401

#: Bytes of text that one chunk of a Python worker holds at most (a single longer text is a chunk of its own).
CHUNK_BYTES = 8 << 20


def spread(df: DataFrame) -> DataFrame:
    """df, a scan of files, dealt to as many partitions as there are cores if it has fewer: for work in Python on small tables in few files."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fresh(names: list[str], prefix: str = "_") -> str:
    """A prefix with which none of the names begins, whatever its case."""
    while any(n.lower().startswith(prefix) for n in names):
        prefix += "_"
    return prefix


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextlib.contextmanager
def frugal(collect: bool = True) -> Iterator[None]:
    """Around a task of a Python worker, which may be reused: what the task has freed goes back to the system at its end.

    collect=False: without garbage collection meanwhile, for tasks that make millions of short lists and no cycles.
    """
    if not collect:
        gc.disable()
    try:
        yield
    finally:
        gc.enable()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only where the C library is GNU's
            ctypes.CDLL(None).malloc_trim(0)


def hash_limit(share: float) -> int:
    """The largest signed 64-bit hash that belongs to this share of all."""
    return min((1 << 63) - 1, int((2 * share - 1) * (1 << 63)))


def plain(col: pa.Array) -> pa.Array:
    """A fresh large_string array without nulls: some kernels of Arrow misread slices."""
    return pc.if_else(pc.is_valid(col), col.cast(pa.large_string()), "")


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch of at most `limit` bytes of text each, whole rows only."""
    col = batch.column(batch.schema.get_field_index(text))
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, end - at)
        at = end


def units(col: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Codes of all units in order, the row offsets into them (len(col) + 1), and the distinct units."""
    parts = pc.split_pattern(plain(col), " ")
    offsets = np.asarray(parts.offsets, dtype=np.int64)
    coded = pc.dictionary_encode(parts.flatten())
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return np.asarray(coded.indices, dtype=np.int64), offsets - offsets[0], coded.dictionary


class Pool:
    """Variable-length integer values of distinct keys, kept from chunk to chunk and forgotten beyond `most` keys.

    make(keys) returns a list with a list of integers for each key.
    """

    def __init__(self, make, dtype, most: int = 250_000):
        self.make, self.dtype, self.most = make, dtype, most
        self.known: dict = {}

    def of(self, keys: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """starts and lengths of each key's values, and the flat values."""
        got = list(map(self.known.get, keys))
        at = [i for i, v in enumerate(got) if v is None]
        new = [keys[i] for i in at]
        made = self.make(new) if new else []
        for i, v in zip(at, made, strict=True):
            got[i] = v
        if len(self.known) + len(made) > self.most:
            self.known.clear()
        if len(made) <= self.most:
            self.known.update((k, v) for k, v in zip(new, made, strict=True) if len(v) <= 64)
        lengths = np.fromiter(map(len, got), np.int64, len(got))
        ends = np.cumsum(lengths)
        return ends - lengths, lengths, np.fromiter(chain.from_iterable(got), self.dtype, int(ends[-1]) if len(ends) else 0)


def gather(starts: np.ndarray, lengths: np.ndarray, values: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of codes in order, and the end of each code's values among them."""
    n = lengths[codes]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total, dtype=np.int64) + np.repeat(starts[codes] - (ends - n), n)
    return values[at], ends
