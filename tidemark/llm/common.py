"""Reading, storing and bounded filters shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import run_dir
from tidemark.sources.logs import remove_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back.

    Cuts the lineage: a lost executor costs what it was working on and nothing before. The written
    files are in the folder that spark.checkpoint.dir names.
    """
    return Stored(df, name).rows


class Stored:
    """A stored table that is dropped when what was made from it is stored as well."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = run_dir(self.spark, name)
        df.write.parquet(self.path)
        self.rows = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        remove_path(self.spark, self.path)


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand at most so many rows at once to Arrow functions.

    Texts are long: the default of 10,000 rows is tens of megabytes, held several times over by the
    JVM and by the worker. The setting stays, as plans run after their operator has returned.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    asked = int(spark.conf.get(name))
    if not 0 < asked <= rows:
        spark.conf.set(name, rows)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand at most so many rows at once to Arrow functions that run within the block."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def finite_vector(name: str) -> Column:
    """Whether an array is there and all its entries are numbers; null never."""
    number = F.forall(
        name, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(F.col(name).isNotNull() & number, F.lit(False))


def fixed_point(name: str) -> Column:
    """floor(64 * x) of every entry as long; an entry out of a long's range stops at its end."""
    return F.transform(name, lambda x: F.floor(x.cast("double") * 64.0).cast("long"))


def matrix(column: pa.Array) -> np.ndarray:
    """Arrays of one length as the rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


class Bitmap:
    """Set membership by one bit per value, in a fixed number of bytes.

    May answer yes for a value outside the set, never no for one inside, so what it lets through is
    joined exactly afterwards. Its size doesn't depend on the set: a crowded map only filters less.
    """

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.shift = words, np.uint64(64 - bits)

    def has(self, values: np.ndarray) -> np.ndarray:
        at = values.view(np.uint64) >> self.shift
        word = self.words[(at >> np.uint64(6)).astype(np.int64)]
        return (word >> (at & np.uint64(63))) & np.uint64(1) != 0


def bitmap_of(values: DataFrame, name: str, bits: int = 23) -> Bitmap:
    """The bitmap of a column of 64-bit hashes; at most 2^(bits - 6) longs reach the driver."""
    at = F.shiftrightunsigned(F.col(name), 64 - bits)
    words = (
        values.select(at.alias("at"))
        .groupBy(F.expr("shiftright(at, 6) AS word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(at & 63 AS int))) AS bits"))
        .toArrow()
    )
    filled = np.zeros(1 << (bits - 6), np.uint64)
    if words.num_rows:
        filled[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return Bitmap(filled, bits)


_held: dict[str, dict] = {}


def held(owner: str) -> dict:
    """What a worker process remembers between tasks, for one owner at a time.

    Workers are reused by later stages; what an earlier operator remembered is given up when another
    one begins.
    """
    if owner not in _held:
        _held.clear()
        pa.default_memory_pool().release_unused()
        _held[owner] = {}
    return _held[owner]


def balanced(sizes: Iterator[int] | list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring items with at most limit bytes each, or one item."""
    start = total = 0
    end = 0
    for end, size in enumerate(sizes):
        if end > start and total + size > limit:
            yield start, end
            start, total = end, 0
        total += size
    if sizes:
        yield start, end + 1


Query = Callable[[SparkSession, str], DataFrame]
