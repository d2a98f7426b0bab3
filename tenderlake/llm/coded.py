"""Texts as numbers into the distinct words of their chunk, so that each word of a chunk is looked at once.

A chunk is a bounded run of documents of one partition (a longer text is one of its own).  Its row has `words` and,
for each document, the codes of its words in order; what is known of a word comes to the chunks that have it by a join
on the word, and back to the documents by position.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.session import Scratch

from .common import chunks, frugal, plain, units

#: Bytes of text of a chunk.
CHUNK = 8 << 20
#: Row groups of a few chunks each, looked at after every row: a reader decodes all of a group at once.
ROW_GROUPS = {"parquet.block.size": str(2 * CHUNK), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
Split = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, pa.Array]]


@contextlib.contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """These settings of spark.sql, with `_` for `.`, while a table is written."""
    names = {f"spark.sql.{k.replace('_', '.')}": v for k, v in values.items()}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def save(scratch: Scratch, df: DataFrame, name: str, options: dict[str, str] | None = None, **more: str) -> DataFrame:
    """A scratch table whose shuffles go once it is written, as nothing reads them again; options are those of the writer."""
    with settings(scratch.spark, classic_shuffleDependency_fileCleanup_enabled="true", **more):
        return scratch.save(df, name, **(options or {}))


def byte_table(lower: bool = True, space: str = "\t\n\v\f\r ") -> np.ndarray:
    """What each byte becomes: A-Z in lower case, and white space a U+0020."""
    out = np.arange(256, dtype=np.uint8)
    if lower:
        out[ord("A") : ord("Z") + 1] += 32
    out[[ord(c) for c in space]] = 32
    return out


def with_bytes(col: pa.Array, change: Callable[[np.ndarray], np.ndarray]) -> pa.Array:
    """The column of texts with its bytes changed one for one."""
    col = plain(col)
    _, offsets, data = col.buffers()
    if data is None:
        return col
    return pa.LargeStringArray.from_buffers(len(col), offsets, pa.py_buffer(change(np.frombuffer(data, dtype=np.uint8))))


def without(codes: np.ndarray, offsets: np.ndarray, mark: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes but for this one."""
    stay = codes != mark
    return codes[stay], np.concatenate(([0], np.cumsum(stay)))[offsets]


def split_words(col: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Codes of the words between white space, A-Z in lower case, and one `""` at the end of each text."""
    table = byte_table()
    codes, offsets, words = units(with_bytes(col, lambda b: table[b]))
    end = pc.index(words, "").as_py()
    if end < 0:
        end, words = len(words), pa.concat_arrays([words, pa.array([""], words.type)])
    else:
        codes, offsets = without(codes, offsets, end)
    n = np.arange(len(offsets))
    return np.insert(codes, offsets[1:], end), offsets + n, words


def coded(docs: DataFrame, text: str, split: Split, limit: int = CHUNK) -> DataFrame:
    """(chunk, words, docs): docs are structs of the other columns and `codes`.

    The numbers of chunks are those of one run: write the result before it is read twice.
    """
    others = [c for c in docs.columns if c != text]

    def told(batches):
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in chunks(batch, text, limit):
                codes, offsets, words = split(part.column(len(others)))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(codes, pa.int32()))
                rows = pa.StructArray.from_arrays([*part.columns[: len(others)], lists], [*others, "codes"])
                yield pa.record_batch([pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string())), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)], names=["chunk", "words", "docs"])
                number += 1

    def run(batches):
        with frugal():
            yield from told(batches)

    fields = ", ".join(f"`{c}`: {docs.schema[c].dataType.simpleString()}" for c in others)
    return docs.select(*others, text).mapInArrow(run, f"chunk long, words array<string>, docs array<struct<{fields}{', ' if fields else ''}codes: array<int>>>")


def words_of(chunked: DataFrame, *more: str) -> DataFrame:
    """(chunk, pos, word) of every word of every chunk."""
    return chunked.select("chunk", *more, F.posexplode("words").alias("pos", "word"))


def for_chunks(docs: DataFrame, words: DataFrame, made: Callable[[pa.StructArray, pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What made(documents, words) yields for each chunk of docs (chunk, docs); words (of, pos, ...) are those of chunk `of`, and come in the order of pos.

    The rows of a chunk's words meet its documents sorted, not as lists, so the JVM holds no chunk.
    """

    def run(own: pa.Table, known: pa.Table) -> pa.Table:
        with frugal():
            return pa.Table.from_batches(list(made(pa.concat_arrays([own.column("docs").combine_chunks()[0].values]), known.sort_by("pos"))))

    return docs.groupBy("chunk").cogroup(words.groupBy("of")).applyInArrow(run, schema)
