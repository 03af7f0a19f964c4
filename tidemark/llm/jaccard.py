"""N-gram Jaccard join with several global token orders.

Two texts link when their sets of word shingles are similar enough. Under any order of all shingles,
linked sets share an element among the first n - ceil(t * n) + 1 of each (its prefix), so a pair
must pass under every order tried, and the filters intersect:

1. Order by hash. A set can only have a partner if enough of an extended prefix (twice as long) is
   shared with any other set; all others, as a rule most, are settled here with n numbers each.
   Shingles are counted per batch first, so a shingle that a third of all texts hold is one row per
   batch.
2. Order by frequency among the sets left, rare ones first. Sets sharing prefix shingles fall into
   the same group (connected components over shingles, not pairs).
3. Order by the frequency's magnitude and another hash, within those groups; the groups are split
   again.

What is left in a group meets in blocks of bounded size. Within a pair of blocks the candidates are the
pairs that share a prefix shingle under order 2 and one under order 3, found by inverted lists of both
prefixes and intersected; only theirs overlaps count, and only a spanning forest of the links leaves
the task. So no pair is ever a row and no link between different texts is lost. Block pairs are dealt
out one by one, also those of one group: a group of S texts that the filters cannot part costs S * S / 2
checks in total, in tasks of one block pair each. Copies with equal sets are one member.

Shingle hashes have 64 bits and set keys 128; the distinct sets of step 2 and later are numbered.

Defined results: words are runs without ASCII white space, A-Z lower-cased; a text with fewer words
than the width is one shingle; a text without words has an empty set and links with nothing, its
component is its own id; rows with equal ids count one by one and share what their ids are linked
to; null ids take part but never name a component; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Bitmap, Stored, bitmap_of, stored
from tidemark.llm.components import components
from tidemark.llm.textkit import mix, shingle_set, word_hashes

WIDTH = 4
PERCENT = 85
BLOCK_SETS = 1024
BLOCK_SHINGLES = 1 << 20
BATCH_SHINGLES = 1 << 20  # shingles counted per batch before they are shuffled

_SALT = np.uint64(0xA24BAED4963EE407)


def prefix_length(n, percent: int):
    """Elements among which a set of n must share one with any partner; 0 for an empty set."""
    return n - -(-n * percent // 100) + (n > 0)


def _sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    raw = [(t.as_py() or "").encode().lower() for t in column]
    for _, words in word_hashes(raw):
        yield shingle_set(words, width)


def _key(h: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(h.tobytes())


def _short(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


class _Batch:
    """Extended prefixes of a stretch of input, as rows for the count of sharing."""

    def __init__(self, percent: int):
        self.percent = percent
        self.keys: dict[int, int] = {}  # short key: position
        self.sizes: list[int] = []
        self.prefixes: list[np.ndarray] = []
        self.held = 0

    def add(self, h: np.ndarray) -> None:
        if not len(h):
            return
        key = _short(_key(h))
        if key in self.keys:
            return
        self.keys[key] = len(self.sizes)
        self.sizes.append(len(h))
        order = mix(h ^ _SALT)
        length = 2 * prefix_length(len(h), self.percent) - 1
        self.prefixes.append(np.sort(order)[:length] if length < len(h) else order)
        self.held += len(self.prefixes[-1])

    def rows(self) -> pa.RecordBatch:
        """Of a shingle held by one set here: shingle and set; by several: the shingle alone, and
        the sets count it as shared at once. A set's own row has its need and what it knows so far.
        """
        keys = np.fromiter(self.keys, np.int64, len(self.keys))
        sizes = np.array(self.sizes, np.int64)
        lengths = np.fromiter(map(len, self.prefixes), np.int64, len(self.prefixes))
        tokens = np.concatenate([*self.prefixes, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(keys)), lengths)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        first = np.append(True, tokens[1:] != tokens[:-1])[: len(tokens)]
        run = np.cumsum(first) - 1
        times = np.bincount(run, minlength=1)
        several = times[run] > 1 if len(run) else np.zeros(0, bool)
        shared = np.bincount(owner[several], minlength=len(keys))
        once = first & ~several
        marks = first & several
        # A partner's prefix may be the shorter one; the least partner has ceil(t * n) shingles.
        need = prefix_length(-(-sizes * self.percent // 100), self.percent)
        n, m, k = int(once.sum()), int(marks.sum()), len(keys)
        token = np.concatenate([tokens[once].view(np.int64), tokens[marks].view(np.int64), keys])
        member = pa.array(
            np.concatenate([keys[owner[once]], np.zeros(m, np.int64), keys]),
            mask=np.concatenate([np.zeros(n, bool), np.ones(m, bool), np.zeros(k, bool)]),
        )
        empty = np.zeros(n + m, np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(token),
                member,
                pa.array(np.concatenate([empty, need.astype(np.int32)])),
                pa.array(np.concatenate([empty, shared.astype(np.int32)])),
            ],
            ["token", "member", "need", "shared"],
        )


def _promising(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Short keys of the sets that share enough of their extended prefix with other sets."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Batch(percent)
        for b in batches:
            for h in _sets(b.column(0), width):
                held.add(h)
                if held.held >= BATCH_SHINGLES:
                    yield held.rows()
                    held = _Batch(percent)
        yield held.rows()

    counted = docs.select("text").mapInArrow(
        rows, "token long, member long, need int, shared int"
    )
    is_set = F.col("need") > 0
    holders = F.count("*").over(Window.partitionBy("token", is_set))
    known = (
        counted.withColumn("holders", holders)
        .where(is_set | ((F.col("holders") > 1) & F.col("member").isNotNull()))
        .withColumn("shared", F.when(is_set, F.col("shared")).otherwise(1))
    )
    return (
        known.groupBy("member")
        .agg(F.sum("shared").alias("shared"), F.max("need").alias("need"))
        .where("shared >= need")
        .select("member")
    )


def _all_sets(docs: DataFrame, width: int, seen: Bitmap) -> DataFrame:
    """doc_id, text_hash, set_key, n_shingles of every row, and the shingles of those in seen."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sizes, kept = [], [], []
            for h in _sets(b.column(2), width):
                key = _key(h) if len(h) else None
                keys.append(key)
                sizes.append(len(h))
                hit = key is not None and seen.has(np.array([_short(key)], np.int64))[0]
                kept.append(h.view(np.int64) if hit else None)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array(keys, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array([_short(k) if k else None for k in keys], pa.int64()),
                    pa.array(kept, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "set_key", "n_shingles", "short", "shingles"],
            )

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        rows,
        "doc_id long, text_hash long, set_key binary, n_shingles long, short long, "
        "shingles array<long>",
    )


def _groups(prefixes: DataFrame, within: DataFrame | None) -> DataFrame:
    """set_id, cell: sets that share prefix shingles, directly or over others.

    prefixes: set_id, token. With within (set_id, cell), only sets of the same cell meet.
    """
    keyed = prefixes.withColumn("cell", F.lit(None).cast("long"))
    if within is not None:
        keyed = prefixes.join(within, "set_id")
    centers = (
        keyed.groupBy("cell", "token")
        .agg(F.min("set_id").alias("center"), F.max("set_id").alias("other"))
        .where("center <> other")
        .select(F.col("cell").alias("cell_"), F.col("token").alias("token_"), "center")
    )
    met = F.col("cell").eqNullSafe(F.col("cell_")) & (F.col("token") == F.col("token_"))
    edges = keyed.join(centers, met).select(F.col("set_id").alias("b"), F.col("center").alias("a"))
    return components(edges).select(F.col("node").alias("set_id"), F.col("root").alias("cell"))


def _inverted(lists: list[np.ndarray], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Owners by token, where each token's begin, and each owner's own tokens; owners are ranks."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    tokens = np.concatenate([*lists, np.zeros(0, np.int64)])
    _, tokens = np.unique(tokens, return_inverse=True)
    owner = rank[np.repeat(np.arange(len(lists)), sizes)]
    by_token = np.lexsort((owner, tokens))
    begin = np.searchsorted(tokens[by_token], np.arange(tokens.max(initial=-1) + 2))
    by_owner = np.lexsort((tokens, owner))
    ends = np.cumsum(np.bincount(owner, minlength=len(lists)))[:-1]
    return owner[by_token], begin, np.split(tokens[by_owner], ends)


def links_within(
    sets: list[np.ndarray],
    prefixes: list[list[np.ndarray]],
    side: np.ndarray,
    percent: int,
) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets; of one block (side all 0) or of two.

    prefixes: per order, each set's prefix. A pair counts if it shares a token in all of them.
    """
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    order = np.argsort(sizes, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    whole = _inverted(sets, rank)
    filters = [_inverted(p, rank) for p in prefixes]
    sizes, sides = sizes[order], side[order]
    two = bool(side.any())
    root = np.arange(n)  # the root of every set, kept flat

    def shared(index: tuple, i: int) -> np.ndarray:
        """How many tokens every set has in common with set i."""
        lists, begin, own = index
        held = [lists[begin[t] : begin[t + 1]] for t in own[i].tolist()]
        return np.bincount(np.concatenate([*held, np.zeros(0, np.int64)]), minlength=n)

    out = []
    for i in range(1, n):
        least = -(-int(sizes[i]) * percent // 100)
        low = int(np.searchsorted(sizes[:i], least))
        if low == i:
            continue
        candidate = root[low:i] != root[i]
        if two:
            candidate &= sides[low:i] != sides[i]
        for index in filters:
            if candidate.any():
                candidate &= shared(index, i)[low:i] > 0
        if not candidate.any():
            continue
        count = shared(whole, i)[low:i]
        ok = candidate & (100 * count >= percent * (sizes[low:i] + sizes[i] - count))
        for j in (np.flatnonzero(ok) + low).tolist():
            if root[j] != root[i]:
                out.append((int(order[j]), int(order[i])))
                root[root == root[j]] = root[i]
    return out


def _links(sets: DataFrame, percent: int, block_sets: int, block_shingles: int) -> DataFrame:
    """Links (a, b) that span the components.

    sets: set_key of any type, cell, n_shingles, shingles, and the prefixes first and second.
    """
    total = sets.groupBy("cell").agg(
        F.count("*").alias("members"), F.sum("n_shingles").alias("held")
    )
    blocks = F.greatest(
        F.ceil(F.col("members") / block_sets), F.ceil(F.col("held") / block_shingles)
    ).cast("int")
    total = total.where("members > 1").select("cell", blocks.alias("blocks"))
    block = F.pmod(F.xxhash64("set_key"), F.col("blocks").cast("long")).cast("int")
    dealt = (
        sets.join(total, "cell")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            # One column, so that rows dealt by their cell are dealt anew by block pair.
            F.struct(
                "cell", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
            ).alias("pair"),
            (F.col("block") > F.col("other")).cast("int").alias("side"),
            "set_key",
            "shingles",
            "first",
            "second",
        )
    )

    def verify(group: pa.Table) -> pa.Table:
        key_type = group.schema.field("set_key").type
        keys = group.column("set_key").to_pylist()
        sets, *prefixes = (
            [s.values.to_numpy() for s in group.column(c)] for c in ("shingles", "first", "second")
        )
        side = group.column("side").to_numpy()
        found = links_within(sets, prefixes, side, percent) if keys else []
        return pa.table(
            [
                pa.array([keys[i] for i, _ in found], key_type),
                pa.array([keys[j] for _, j in found], key_type),
            ],
            ["a", "b"],
        )

    kind = sets.schema["set_key"].dataType.simpleString()
    return dealt.groupBy("pair").applyInArrow(verify, f"a {kind}, b {kind}")


def _classes(
    docs: DataFrame, width: int, percent: int, block_sets: int, block_shingles: int
) -> DataFrame:
    """doc_id, text_hash, n_shingles and class of every row; rows without words have no class.

    Those are parted off before any join, as nulls would gather in one task.
    """
    settled = Stored(_promising(docs, width, percent), "promising")
    promising = settled.rows
    rows = stored(_all_sets(docs, width, bitmap_of(promising, "member")), "sets")
    distinct = stored(
        rows.where("shingles IS NOT NULL")
        .join(promising.select(F.col("member").alias("short")).distinct(), "short", "left_semi")
        .select("set_key", "n_shingles", "shingles")
        .dropDuplicates(["set_key"])
        # Rows of shingles bear this number, a few bytes when compressed, instead of the key's 16.
        .withColumn("set_id", F.monotonically_increasing_id()),
        "distinct-sets",
    )
    settled.drop()
    tokens = distinct.select("set_id", F.explode("shingles").alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    counted = Stored(tokens.join(often, "token"), "shared-shingles")
    shared = counted.rows
    by_set = Window.partitionBy("set_id")
    by_frequency = by_set.orderBy("df", "token")
    by_magnitude = by_set.orderBy(F.floor(F.log2("df")), F.xxhash64("token"), "token")
    placed = shared.select(
        "set_id",
        "token",
        F.count("*").over(by_set).alias("held"),
        F.row_number().over(by_frequency).alias("first_place"),
        F.row_number().over(by_magnitude).alias("second_place"),
    )
    # Shingles of one set only come first in both orders and lead nowhere; they are only counted.
    alone = F.col("n_shingles") - F.col("held")
    prefix = F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100) + 1
    # The sizes join where the windows have put the rows, which move without them.
    ranked = placed.join(distinct.select("set_id", "n_shingles"), "set_id").select(
        "set_id",
        "token",
        (alone + F.col("first_place") <= prefix).alias("in_first"),
        (alone + F.col("second_place") <= prefix).alias("in_second"),
    ).where("in_first OR in_second")
    # No longer than the set; gathered where the windows have already put it.
    prefixes = stored(
        ranked.groupBy("set_id").agg(
            F.collect_list(F.when(F.col("in_first"), F.col("token"))).alias("first"),
            F.collect_list(F.when(F.col("in_second"), F.col("token"))).alias("second"),
        ),
        "prefixes",
    )
    counted.drop()
    by_first = prefixes.select("set_id", F.explode("first").alias("token"))
    by_second = prefixes.select("set_id", F.explode("second").alias("token"))
    cells = _groups(by_second, stored(_groups(by_first, None), "cells"))
    sets = distinct.drop("set_key").join(cells, "set_id").join(prefixes, "set_id")
    sets = sets.withColumnRenamed("set_id", "set_key")
    links = _links(sets, percent, block_sets, block_shingles)
    keys = distinct.select(F.col("set_id").alias("node"), "set_key")
    roots = distinct.select(F.col("set_id").alias("root"), F.col("set_key").alias("class"))
    classes = components(links).join(keys, "node").join(roots, "root").select("set_key", "class")
    slim = rows.select("doc_id", "text_hash", "n_shingles", "set_key")
    labelled = slim.where("set_key IS NOT NULL").join(classes, "set_key", "left")
    labelled = labelled.withColumn("class", F.coalesce("class", "set_key")).drop("set_key")
    wordless = slim.where("set_key IS NULL").drop("set_key")
    return labelled.unionByName(wordless, allowMissingColumns=True)


def linked(
    docs: DataFrame,
    width: int = WIDTH,
    percent: int = PERCENT,
    block_sets: int = BLOCK_SETS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    rows = _classes(docs, width, percent, block_sets, block_shingles)
    worded = rows.where("class IS NOT NULL")
    least = worded.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    named = worded.join(least, "class").select("doc_id", "n_shingles", "component_id")
    # A row without words has no class and keeps its own id.
    own = F.col("doc_id").alias("component_id")
    return named.unionByName(rows.where("class IS NULL").select("doc_id", "n_shingles", own))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, with all columns, of which one of each linked group stays.

    It is the row with the least id; null ids come last, and rows with equal ids are told apart by
    their text. Of repeated rows one stays. Rows without words are linked with nothing: all stay.
    """
    rows = _classes(docs, width, percent, BLOCK_SETS, BLOCK_SHINGLES)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    key = ["text_hash", "id", "no_id"]
    keepers = stored(
        rows.where("class IS NOT NULL")
        .groupBy("class")
        .agg(F.min(rank).alias("keep"))
        .select("keep.text_hash", F.expr("coalesce(keep.doc_id, 0L) AS id"), "keep.no_id"),
        "kept",
    )
    # Rows travel as one struct, so no column of theirs can clash with the key's names. The join and
    # the window share the key: whole texts are shuffled once.
    marked = docs.select(
        F.struct("*").alias("row"),
        F.xxhash64("text").alias("text_hash"),
        F.expr("coalesce(doc_id, 0L) AS id"),
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("worded"),
    )
    one = Window.partitionBy(*key).orderBy(F.xxhash64("row"))
    single = (
        marked.where("worded")
        .join(keepers, key, "left_semi")
        .withColumn("n", F.row_number().over(one))
        .where("n = 1")
    )
    wordless = marked.where("NOT worded")
    return single.select("row.*").unionByName(wordless.select("row.*"))
