"""Best-fit packing of whole documents into few sequences by a grouping genetic algorithm.

Documents longer than a sequence are cut into full pieces and a rest; rests and shorter documents are
the items, and an individual is a partition of items into bins. A child takes whole well-filled bins
of one parent, gives up the other parent's bins that share an item with them, and puts the displaced
items of those bins back by best fit, longest first. Fewer bins win, then more uneven filling, as that
leaves room in few bins.

Distribution: items are dealt by a hash into problems of about ITEMS items, as any such mix of lengths
is like any other. Every problem lives on several islands, each a row of its own with its own
population; after every epoch the best individual of an island moves to the next one. A problem that
has reached the least possible number of bins evolves no further. The emptiest bins of all problems,
up to a quarter of each problem's items, are dissolved and dealt anew as the next level, until one
problem is left; so the work is at most 4/3 of the first level's and the corpus ends with one open bin
for all problems together.

Populations hold positions and lengths only. Every epoch is a written table.

Defined results: null text is empty and yields the closing id alone; rows with equal ids are items of
their own; null ids are kept; an empty table gives no rows; other columns are left out. Sequence
numbers are unique and otherwise without meaning.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_rows, stored, text_or_empty
from tidemark.llm.encoding import Encoder

WINDOW = 2048
END_ID = 0
ITEMS = 1024  # of a problem, on average
ISLANDS = 3
EPOCHS = 2
POPULATION = 6
CHILDREN = 12  # of an island in an epoch
_HELD = 1 << 18  # ids of pieces gathered before they are handed on

Bins = list[list[int]]


def best_fit(
    order: list[int], sizes: list[int], window: int, bins: Bins, loads: list[int]
) -> None:
    """Put items, in the given order, where the least room remains; a bin is opened if none fits."""
    room = sorted((window - load, b) for b, load in enumerate(loads) if load < window)
    for item in order:
        size = sizes[item]
        at = bisect_left(room, (size, -1))
        if at == len(room):
            b = len(bins)
            bins.append([item])
            loads.append(size)
            if size < window:
                insort(room, (window - size, b))
        else:
            left, b = room.pop(at)
            bins[b].append(item)
            loads[b] += size
            if left > size:
                insort(room, (left - size, b))


def _loads(bins: Bins, sizes: list[int]) -> list[int]:
    return [sum(sizes[i] for i in b) for b in bins]


def worth(bins: Bins, sizes: list[int], window: int) -> tuple:
    """Greater is better: fewer bins, then the greater sum of squared loads."""
    return -len(bins), sum(load * load for load in _loads(bins, sizes))


def least_bins(sizes: list[int], window: int) -> int:
    """No packing has fewer bins."""
    return max(-(-sum(sizes) // window), sum(2 * s > window for s in sizes))


def cross(
    mother: Bins, father: Bins, sizes: list[int], window: int, rng: random.Random
) -> Bins:
    """A child of mother with some of the father's well-filled bins in it."""
    filled = sorted(range(len(father)), key=lambda b: -sum(sizes[i] for i in father[b]))
    upper = filled[: -(-len(filled) // 2)]
    injected = [father[b] for b in rng.sample(upper, rng.randint(1, len(upper)))]
    taken = {i for b in injected for i in b}
    child = [list(b) for b in injected]
    displaced: list[int] = []
    for b in mother:
        if taken.isdisjoint(b):
            child.append(list(b))
        else:
            displaced += [i for i in b if i not in taken]
    displaced.sort(key=lambda i: (-sizes[i], i))
    best_fit(displaced, sizes, window, child, _loads(child, sizes))
    return child


def evolve(
    population: list[Bins],
    sizes: list[int],
    window: int,
    size: int,
    children: int,
    rng: random.Random,
) -> list[Bins]:
    """The population after so many children, best first; it stops at the least number of bins."""
    least = least_bins(sizes, window)
    items = range(len(sizes))
    while len(population) < size:
        # The first is best fit of falling lengths, the others of lengths that are disturbed.
        shake = 0.0 if not population else 0.3
        key = [-s * (1 + shake * (rng.random() - 0.5)) for s in sizes]
        bins: Bins = []
        best_fit(sorted(items, key=lambda i: (key[i], i)), sizes, window, bins, [])
        population.append(bins)
        if len(bins) == least:
            break
    ranked = sorted(
        ((worth(b, sizes, window), k, b) for k, b in enumerate(population)), reverse=True
    )
    for k in range(children if -ranked[0][0][0] > least and len(ranked) > 1 else 0):
        mother, father = (max(rng.sample(ranked, 2))[2] for _ in range(2))
        child = cross(mother, father, sizes, window, rng)
        entry = (worth(child, sizes, window), len(population) + k, child)
        if entry[0] > ranked[-1][0] and all(entry[0] != r[0] for r in ranked):
            ranked[-1] = entry
            ranked.sort(reverse=True)
        if -ranked[0][0][0] == least:
            break
    return [b for _, _, b in ranked[:size]]


def _bins_of(numbers: list[int]) -> Bins:
    bins: Bins = [[] for _ in range(max(numbers, default=-1) + 1)]
    for item, b in enumerate(numbers):
        bins[b].append(item)
    return bins


def _numbers_of(bins: Bins, n: int) -> list[int]:
    numbers = [0] * n
    for b, items in enumerate(bins):
        for i in items:
            numbers[i] = b
    return numbers


def _pieces(docs: DataFrame, tokenizer: str, window: int, end_id: int, keep_ids: bool) -> DataFrame:
    """Every document as ids, in pieces of the window's length and a rest, each with a number."""
    schema = (
        "doc_id long, piece int, start long, length long, ids_crc32 long, item_id long"
        + (", ids array<int>" if keep_ids else "")
    )
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        number = TaskContext.get().partitionId() << 33
        out: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[] for _ in names]
            ids = columns.pop() if keep_ids else None
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            if ids is not None:
                ends = np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int32)
                values = np.concatenate([np.zeros(0, np.uint32), *ids]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values)))
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(encoder.ids(text.as_py()), np.uint32(end_id))
                for piece, start in enumerate(range(0, len(ids), window)):
                    own = ids[start : start + window]
                    crc = zlib.crc32(own.astype("<u4").tobytes())
                    row = (doc_id, piece, start, len(own), crc, number)
                    out.append((*row, own) if keep_ids else row)
                    number += 1
                    held += len(own)
                    if held >= _HELD:
                        yield batch()
                        held = 0
        yield batch()

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(rows, schema)


_STATE = (
    "problem long, island int, sizes array<int>, population array<array<int>>, "
    "bins int, squares long"
)


def _epoch(state: DataFrame, window: int, size: int, children: int, seed: str) -> DataFrame:
    """One epoch of every island; ``migrant`` is another island's best individual or null."""
    names = [c.split()[0] for c in _STATE.split(", ")]
    kinds = [
        pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32())),
        pa.int32(), pa.int64(),
    ]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.to_pylist():
                problem, island, sizes = row["problem"], row["island"], row["sizes"]
                rng = random.Random(f"{seed}-{problem}-{island}")
                population = [_bins_of(p) for p in row["population"]]
                if row["migrant"] is not None:
                    population.append(_bins_of(row["migrant"]))
                population = evolve(population, sizes, window, size, children, rng)
                fewest, squares = worth(population[0], sizes, window)
                numbers = [_numbers_of(p, len(sizes)) for p in population]
                out.append((problem, island, sizes, numbers, -fewest, squares))
            columns = list(zip(*out)) if out else [[] for _ in names]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return state.mapInArrow(rows, _STATE)


def _places(solved: DataFrame, window: int, level: int, last: bool) -> DataFrame:
    """Where every item lies, and whether its bin is dissolved for the next level."""
    schema = "item_id long, length int, sequence_id long, offset long, again boolean"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for row in b.to_pylist():
                sizes, ids = row["sizes"], row["item_ids"]
                bins = _bins_of(row["best"])
                loads = _loads(bins, sizes)
                dissolved: set[int] = set()
                spare = 0 if last else len(sizes) // 4
                for k in sorted(range(len(bins)), key=loads.__getitem__):
                    spare -= len(bins[k])
                    if spare < 0 or loads[k] >= window - window // 128:
                        break
                    dissolved.add(k)
                first = (level << 56) + (row["problem"] << 20)
                for k, own in enumerate(bins):
                    at = 0
                    for i in own:
                        out.append((ids[i], sizes[i], first + k, at, k in dissolved))
                        at += sizes[i]
            columns = list(zip(*out)) if out else [[] for _ in range(5)]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["item_id", "length", "sequence_id", "offset", "again"],
            )

    return solved.mapInArrow(rows, schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    items: int = ITEMS,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    population: int = POPULATION,
    children: int = CHILDREN,
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and its ids if asked.

    tokenizer: path of a tokenizer file on every executor. A sequence is the ids of its pieces by
    offset; length and ids_crc32 are those of ids.
    """
    spark = docs.sparkSession
    with arrow_rows(spark, 1000):
        pieces = stored(_pieces(docs, tokenizer, window, end_id, keep_ids), "pieces")
    rest = pieces.where(F.col("length") < window).select("item_id", F.col("length").cast("int"))
    placed: list[DataFrame] = []
    with arrow_rows(spark, 128):
        while n := rest.count():
            level, count = len(placed), -(-n // items)
            one = F.struct("item_id", "length")
            number = F.pmod(F.xxhash64("item_id", F.lit(level)), F.lit(count).cast("long"))
            dealt = rest.groupBy(number.alias("problem")).agg(
                F.array_sort(F.collect_list(one)).alias("all")
            )
            problems = stored(
                dealt.select(
                    "problem",
                    F.col("all.item_id").alias("item_ids"),
                    F.col("all.length").alias("sizes"),
                ),
                "packing-problems",
            )
            state = problems.select(
                "problem",
                F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                "sizes",
                F.array().cast("array<array<int>>").alias("population"),
                F.lit(None).cast("array<int>").alias("migrant"),
            ).repartition("problem", "island")
            best = F.col("population")[0]
            for epoch in range(epochs):
                state = stored(
                    _epoch(state, window, population, children, f"{level}-{epoch}"), "islands"
                )
                if epoch + 1 < epochs:
                    to = ((F.col("island") + 1) % islands).cast("int")
                    elite = state.select("problem", to.alias("island"), best.alias("migrant"))
                    state = state.join(elite, ["problem", "island"], "left")
            order = F.struct("bins", (-F.col("squares")).alias("squares"), "island")
            solved = state.groupBy("problem").agg(F.min_by(best, order).alias("best"))
            placed.append(
                stored(
                    _places(problems.join(solved, "problem"), window, level, count == 1),
                    "placements",
                )
            )
            rest = placed[-1].where("again").select("item_id", "length")
    whole = pieces.where(F.col("length") >= window).withColumns(
        {"sequence_id": -1 - F.col("item_id"), "offset": F.lit(0).cast("long")}
    )
    if not placed:
        return whole.drop("item_id")
    places = reduce(DataFrame.unionByName, placed).where(~F.col("again"))
    own = places.select("item_id", "sequence_id", "offset")
    return whole.unionByName(pieces.join(own, "item_id")).drop("item_id")
