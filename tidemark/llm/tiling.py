"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs without white space. Two texts share a tile where at least MIN_TILE words
in a row are equal; longest tiles are marked first and no word is in two tiles, so passages count in
whatever order they stand. A document is contaminated by an item whose words are covered to at
least COVERAGE.

Every tile consists of shared runs of MIN_TILE words (seeds), so a document shrinks to the stretches
of its seeds before anything is shuffled: a bitmap of fixed size over the items' seeds finds the
stretches. The bitmap may let stretches through that no item has; the joins drop them.

A join on seeds names the pairs. Tiles that cover w words of an item hold at least w / MIN_TILE of its
seeds, so with that number called q any q - 1 places of an item may be left out of the join: these are
the ones whose seeds most documents have, and a passage that many texts share makes no pairs of its
own. Of the pairs found, those whose shared seeds cannot cover enough of the item are dropped before
they are tiled.

Defined results: null and empty texts, and items with fewer than MIN_TILE words, match nothing;
equal ids are told apart by their texts, and a result row stands for all rows equal in both; a null
id stays null; other columns are left out; an empty table on either side gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bitmap_of, stored
from tidemark.llm.textkit import shingles, word_hashes

MIN_TILE = 5
COVERAGE = 0.5
FIRST_LENGTH = 20  # words; the search begins with tiles of this length

_MODULUS, _BASE = (1 << 61) - 1, 1_000_003


def _rolling(words: list[int], length: int, marked: list[bool]) -> Iterator[tuple[int, int]]:
    """(start, Karp-Rabin hash) of each run of unmarked words, the hash carried from run to run."""
    top = pow(_BASE, length - 1, _MODULUS)
    h = held = 0
    for i, word in enumerate(words):
        if marked[i]:
            h = held = 0
            continue
        if held == length:
            h = (h - words[i - length] * top) % _MODULUS
            held -= 1
        h = (h * _BASE + word) % _MODULUS
        held += 1
        if held == length:
            yield i - length + 1, h


def tiles(
    pattern: list[int], text: list[int], least: int = MIN_TILE, first: int = FIRST_LENGTH
) -> list[tuple[int, int, int]]:
    """(start in pattern, start in text, length) of the tiles, longest first.

    A search length s is halved from first down to least. In each pass the pattern's hashed runs of
    s words find the text's, runs are extended as far as words are equal and unmarked, and marked
    from the longest on; a run that earlier marks have shortened waits for the next pass.
    """
    p_marked, t_marked = [False] * len(pattern), [False] * len(text)
    done: list[tuple[int, int, int]] = []
    s = max(least, min(first, len(pattern)))
    while True:
        by_hash: dict[int, list[int]] = defaultdict(list)
        for i, h in _rolling(pattern, s, p_marked):
            by_hash[h].append(i)
        matches: list[tuple[int, int, int]] = []
        reach: dict[int, int] = {}  # per diagonal, how far in the text a match goes already
        longest = 0
        if by_hash:
            for j, h in _rolling(text, s, t_marked):
                for i in by_hash.get(h, ()):
                    if reach.get(j - i, -1) >= j + s:
                        continue
                    n = 0
                    while (
                        i + n < len(pattern)
                        and j + n < len(text)
                        and pattern[i + n] == text[j + n]
                        and not (p_marked[i + n] or t_marked[j + n])
                    ):
                        n += 1
                    if n >= s:
                        matches.append((n, i, j))
                        reach[j - i] = j + n
                        longest = max(longest, n)
        if longest > 2 * s:
            s = longest
            continue
        again = False
        for n, i, j in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if any(p_marked[i : i + n]) or any(t_marked[j : j + n]):
                again = True
                continue
            p_marked[i : i + n] = t_marked[j : j + n] = [True] * n
            done.append((i, j, n))
        if again:
            continue
        if s == least:
            return done
        s = max(least, s // 2)


def _stretches(keep: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Word ranges covered by the kept runs of width words."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], keep, [False])).astype(np.int8)))
    spans: list[list[int]] = []
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        end = b + width - 1
        if spans and a <= spans[-1][1]:
            spans[-1][1] = end
        else:
            spans.append([a, end])
    return [(a, b) for a, b in spans]


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


_WORDS = "doc_id long, text_key long, words array<long>, seeds array<long>"


def coverable(runs: np.ndarray, seeds: np.ndarray, least: int) -> int:
    """Words of an item that tiles can cover at most; runs: its seeds in order of place."""
    at = np.flatnonzero(np.isin(runs, seeds))
    if not len(at):
        return 0
    return int(np.minimum(np.diff(at), least).sum()) + least


def _hashed(texts: DataFrame, key: str, least: int, seen=None) -> DataFrame:
    """Words and seeds of each text; with seen, only of the stretches whose seeds it may hold.

    Stretches are parted by a word of their own, which matches nothing; their seeds are a set. Without
    seen, seeds are those of every place, in order.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [t.as_py().encode().lower() for t in b.column(1)]
            at, words, seeds = [], [], []
            for i, w in word_hashes(raw):
                s = shingles(w, least)
                if seen is not None and len(s):
                    keep = seen.has(s)
                    parts = [
                        np.append(w[a:e], np.uint64(k)) for k, (a, e) in
                        enumerate(_stretches(keep, least))
                    ] if keep.any() else []
                    w = np.concatenate(parts) if parts else w[:0]
                    s = s[keep]
                if len(s):
                    at.append(i)
                    words.append(_signed(w))
                    seeds.append(_signed(s if seen is None else np.unique(s)))
            if at:
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(pa.array(at)),
                        b.column(2).take(pa.array(at)),
                        pa.array(words, pa.list_(pa.int64())),
                        pa.array(seeds, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text_key", "words", "seeds"],
                )

    given = texts.where("text IS NOT NULL").select(key, "text", F.xxhash64("text").alias("k"))
    return given.mapInArrow(rows, _WORDS)


def candidates(found: DataFrame, tests: DataFrame, least: int, coverage: float) -> DataFrame:
    """doc, doc_key, item, test_key: pairs that share a seed which is not one of the item's q - 1
    most common ones.
    """
    by_seed = found.select("doc_id", "text_key", F.explode("seeds").alias("seed"))
    often = by_seed.groupBy("seed").agg(F.count(F.lit(1)).alias("texts"))
    words = F.ceil(F.size("item_words") * F.lit(coverage) - F.lit(1e-9))
    places = tests.select(
        "item_id",
        "item_key",
        F.ceil(words / least).alias("q"),
        F.posexplode("item_runs").alias("place", "seed"),
    )
    # An item's places at a time.
    common_first = Window.partitionBy("item_id", "item_key").orderBy(F.desc("texts"), "place")
    asked = (
        places.join(often, "seed")
        .withColumn("rank", F.row_number().over(common_first))
        .where("rank >= q")
        .select("seed", "item_id", "item_key")
        .distinct()
    )
    pairs = by_seed.join(asked, "seed").select("doc_id", "text_key", "item_id", "item_key")
    return pairs.distinct().toDF("doc", "doc_key", "item", "test_key")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    least: int = MIN_TILE,
    coverage: float = COVERAGE,
) -> DataFrame:
    """doc_id, item_id, n_item_words, n_covered, n_tiles, coverage of each contaminated pair.

    text_key is the xxhash64 of the document's text.
    """
    tests = stored(
        _hashed(items, "item_id", least).toDF("item_id", "item_key", "item_words", "item_runs"),
        "tiling-items",
    ).dropDuplicates(["item_id", "item_key"])
    seen = bitmap_of(tests.select(F.explode("item_runs").alias("seed")), "seed", bits=24)
    found = stored(_hashed(docs, "doc_id", least, seen), "tiling-stretches").dropDuplicates(
        ["doc_id", "text_key"]
    )
    # Null ids are compared by the text's key alone.
    pairs = candidates(found, tests, least, coverage)
    same_doc = F.col("doc").eqNullSafe(F.col("doc_id")) & (F.col("doc_key") == F.col("text_key"))
    same_item = F.col("item").eqNullSafe(F.col("item_id")) & (
        F.col("test_key") == F.col("item_key")
    )
    whole = (
        pairs.join(found, same_doc)
        .join(tests, same_item)
        .select("doc_id", "text_key", "item_id", "item_words", "words", "item_runs", "seeds")
    )

    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, at = [], []
            for i, (item, text, runs, seeds) in enumerate(zip(*b.columns[3:])):
                bound = coverable(runs.values.to_numpy(), seeds.values.to_numpy(), least)
                if bound < coverage * len(item):
                    continue
                pattern = item.as_py()
                marked = tiles(pattern, text.as_py(), least)
                n = sum(m[2] for m in marked)
                rows.append((len(pattern), n, len(marked), n / len(pattern)))
                at.append(i)
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
            ids = [c.take(pa.array(at, pa.int64())) for c in b.columns[:3]]
            yield pa.RecordBatch.from_arrays(
                [*ids, *(pa.array(c, t) for c, t in zip(columns, types))],
                ["doc_id", "text_key", "item_id", "n_item_words", "n_covered", "n_tiles", "coverage"],
            )

    schema = (
        "doc_id long, text_key long, item_id long, n_item_words long, n_covered long, "
        "n_tiles long, coverage double"
    )
    return whole.mapInArrow(tiled, schema).where(F.col("coverage") >= coverage)


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs, with all columns, that no item contaminates."""
    found = contamination(docs, items).select("doc_id", "text_key").distinct()
    bad = stored(found, "contaminated")
    # Rows travel as one struct, so that no column of theirs clashes.
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (
        F.xxhash64("row.text") == F.col("text_key")
    )
    return rows.join(bad, same, "left_anti").select("row.*")
