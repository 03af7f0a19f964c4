"""Approximate nearest neighbours by cosine with an inverted multi-index.

Unit vectors are cut into halves and each half is quantised by its own centroids, so K centroids a
half give K * K cells. A query walks over pairs of centroids in the order of summed distance, taken
from a heap, until the cells hold a given share of all vectors; entries of those cells are reranked
by the exact measure.

Centroids are fitted on a bounded sample (SAMPLE rows by hash order); every vector is indexed. K grows
with the root of the table, from 32 to 512. Cell counts are K * K numbers. Vectors and probes meet per
first-half centroid, in blocks: BLOCK vectors against up to QUERY_BYTES of probes, compared in tiles. A
vector is copied once per block of the probes that visit its centroid and a probe once per block of
vectors. Each block returns only its best per query, so no pair is ever a row.

Recall: the share to walk over is measured, not given. For MEASURED vectors of the sample the exact
nearest others of the sample are looked up, and the share is the least that reaches RECALL of them.
Neighbours in a sample are further away than those in the table, so the measure is on the safe side. On
vectors without structure, as in the given table, it is about half of all; there finer cells only copy
probes more often, so beyond COARSE the least K is taken. On clustered vectors it is a few hundredths.

Defined results: vectors that are null, zero, of another length than most, or with null or
non-finite components take no part; equal scores go to the smaller id; a query with fewer
candidates returns all; repeated rows are candidates of each other only if their ids differ; rows of
one id with the same vector are one, and with several vectors the best score of two ids counts; null
ids take no part; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

LEAST_CENTROIDS, MOST_CENTROIDS = 32, 512  # a half
PER_CELL = 50  # vectors of an average cell, until MOST_CENTROIDS is reached
SAMPLE = 20_000
RECALL = 0.95  # of the neighbours within the sample
MEASURED = 256
COARSE = 0.25
BLOCK = 8192  # vectors compared at once
QUERY_BYTES = 32 << 20  # probes compared with one block
TILE = 256

_HITS = "query_id long, vec_id long, score double"


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares of tiny or huge components stay in range.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centroids(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k-means; fewer rows than k give fewer centroids."""
    distinct = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    centers = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        nearest = _distances(x, centers).argmin(axis=1)
        for c in range(len(centers)):
            own = x[nearest == c]
            if len(own):
                centers[c] = own.mean(axis=0)
    return centers


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances less the square of x itself, which doesn't change an order."""
    return (centers * centers).sum(axis=1) - 2 * x @ centers.T


def probed(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
    """For each first-half centroid the bits of the second-half ones to visit.

    first, second: a query's distances to the centroids. counts: vectors by pair of centroids.
    Pairs come in the order of summed distance, each pushing its two successors on the heap.
    """
    a, b = first.argsort(), second.argsort()
    bits = [0] * len(a)
    heap = [(first[a[0]] + second[b[0]], 0, 0)]
    seen = {(0, 0)}
    found = 0
    while heap and found < wanted:
        _, i, j = heapq.heappop(heap)
        n = int(counts[a[i], b[j]])
        if n:
            bits[a[i]] |= 1 << int(b[j])
            found += n
        for i2, j2 in ((i + 1, j), (i, j + 1)):
            if i2 < len(a) and j2 < len(b) and (i2, j2) not in seen:
                seen.add((i2, j2))
                heapq.heappush(heap, (first[a[i2]] + second[b[j2]], i2, j2))
    return bits


def centroids_for(total: int) -> int:
    return max(LEAST_CENTROIDS, min(MOST_CENTROIDS, round((total / PER_CELL) ** 0.5)))


def needed_share(x: np.ndarray, first: np.ndarray, second: np.ndarray, k: int) -> float:
    """The least share of all vectors to walk over that reaches RECALL of the k nearest others.

    x: distinct unit vectors of the sample.
    """
    half, n = first.shape[1], len(x)
    if n <= k + 1:
        return 1.0
    d1, d2 = _distances(x[:, :half], first), _distances(x[:, half:], second)
    cell = d1.argmin(axis=1) * len(second) + d2.argmin(axis=1)
    counts = np.bincount(cell, minlength=len(first) * len(second))
    reached = []
    for i in np.random.default_rng(7).permutation(n)[:MEASURED].tolist():
        near = x @ x[i]
        near[i] = -np.inf
        best = np.argpartition(near, n - k)[n - k :]
        order = np.argsort((d1[i][:, None] + d2[i]).ravel(), kind="stable")
        before = np.empty_like(counts)  # vectors walked over before a cell's turn
        before[order] = np.cumsum(counts[order]) - counts[order]
        reached.extend(before[cell[best]].tolist())
    reached.sort()
    return min(1.0, (reached[math.ceil(RECALL * len(reached)) - 1] + 1) / n)


def _usable(vectors: DataFrame) -> DataFrame:
    good = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    ) & F.exists("embedding", lambda x: x != 0)
    kept = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    return kept.select("vec_id", "embedding").where(good)


def _best(query_id: int, ids: np.ndarray, scores: np.ndarray, k: int) -> Iterator[tuple]:
    """The k best ids, each with its best score."""
    order = np.lexsort((ids, -scores))
    if len(order) > k:
        firsts = np.unique(ids[order], return_index=True)[1]
        order = order[np.sort(firsts)[:k]]
    for i in order.tolist():
        yield query_id, int(ids[i]), float(scores[i])


def _rerank(k: int):
    def block(key, queries: pa.Table, entries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if queries.num_rows and entries.num_rows:
            entries = entries.sort_by("vec_id")
            q, x = _matrix(queries.column("embedding")), _matrix(entries.column("embedding"))
            # The same row has the same length and product wherever it lies: ties stay ties.
            q_unit, x_unit = _unit(q), _unit(x)
            q_ids = queries.column("query_id").to_numpy()
            x_ids = entries.column("vec_id").to_numpy()
            bits = queries.column("bits").to_pylist()
            second = entries.column("c2").to_numpy()
            for i, query_id in enumerate(q_ids.tolist()):
                if i % TILE == 0:
                    rough = q_unit[i : i + TILE] @ x_unit.T
                visited = np.unpackbits(np.frombuffer(bits[i], np.uint8), bitorder="little")
                at = np.flatnonzero((visited[second] != 0) & (x_ids != query_id))
                if len(at) > k:
                    near = rough[i % TILE, at]
                    edges = np.flatnonzero(np.append(True, np.diff(x_ids[at]) != 0))
                    tops = np.maximum.reduceat(near, edges)  # one for each id
                    if len(tops) > k:
                        least = np.partition(tops, len(tops) - k)[len(tops) - k]
                        at = at[near >= least - 1e-9]
                y, z = x[at], q[i]
                product = (y * z).sum(axis=1)
                scores = product / (np.sqrt((y * y).sum(axis=1)) * np.sqrt((z * z).sum()))
                out.extend(_best(query_id, x_ids[at], scores, k))
        columns = list(zip(*out)) if out else [[], [], []]
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, types)], ["query_id", "vec_id", "score"]
        )

    return block


def nearest(
    vectors: DataFrame,
    every: int = 50,
    k: int = 5,
    centroids: int | None = None,
    share: float | None = None,
    sample: int = SAMPLE,
    block: int = BLOCK,
    query_block: int | None = None,
) -> DataFrame:
    """The k nearest of each row whose vec_id is divisible by every: query_id, rank, vec_id, score.

    centroids and share are taken from the table unless given.
    """
    usable = _usable(vectors)
    lengths = usable.groupBy(F.size("embedding").alias("n")).count()
    most = lengths.orderBy(F.desc("count"), "n").limit(1).toArrow()
    empty = "query_id long, rank int, vec_id long, score double"
    if not most.num_rows:
        return vectors.sparkSession.createDataFrame([], empty)
    dim, total = most.column("n")[0].as_py(), most.column("count")[0].as_py()
    usable = usable.where(F.size("embedding") == dim)

    # The sample's size is bounded whatever the table's: a hash threshold, then a limit.
    steps = 1 << 20
    wanted = min(steps, -(-steps * 2 * sample // total))
    usable_hash = F.xxhash64("vec_id", "embedding")
    picked = usable.where(F.pmod(usable_hash, F.lit(steps)) < wanted).dropDuplicates()
    picked = picked.limit(2 * sample)
    fitted = picked.select("embedding", usable_hash.alias("h")).toArrow().sort_by("h")
    x = _unit(_matrix(fitted.column("embedding").slice(0, sample)))
    half = max(1, dim // 2)

    def fitted_halves(k: int) -> tuple[np.ndarray, np.ndarray]:
        other = fit_centroids(x[:, half:], k) if dim > 1 else np.zeros((1, 0))
        return fit_centroids(x[:, :half], k), other

    distinct = np.unique(x, axis=0) if share is None else x
    fine = centroids or centroids_for(total)
    first, second = fitted_halves(fine)
    walked = needed_share(distinct, first, second, k) if share is None else share
    if share is None and centroids is None and walked > COARSE and fine > LEAST_CENTROIDS:
        first, second = fitted_halves(LEAST_CENTROIDS)
        walked = needed_share(distinct, first, second, k)
    width = -(-len(second) // 8)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            u = _unit(_matrix(b.column(1)))
            c1 = _distances(u[:, :half], first).argmin(axis=1)
            c2 = _distances(u[:, half:], second).argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(c1, pa.int32()), pa.array(c2, pa.int32())],
                ["vec_id", "embedding", "c1", "c2"],
            )

    kind = dict(usable.dtypes)["embedding"]
    index = stored(
        usable.dropDuplicates().mapInArrow(coded, f"vec_id long, embedding {kind}, c1 int, c2 int"), "multi-index"
    )
    # At most centroids * centroids rows. A cell counts an id once, whatever its vectors.
    per_id = index.groupBy("c1", "c2", "vec_id").count()
    cells = per_id.groupBy("c1", "c2").agg(
        F.count(F.lit(1)).alias("ids"),
        F.sum("count").alias("rows"),
    ).toArrow()
    at = cells.column("c1").to_numpy(), cells.column("c2").to_numpy()
    counts = np.zeros((len(first), len(second)), np.int64)
    counts[at] = cells.column("ids").to_numpy()
    sizes = np.zeros_like(counts)
    sizes[at] = cells.column("rows").to_numpy()
    # Ids in several cells are counted in each, so that many more are needed for k others.
    again = int(counts.sum()) - index.select("vec_id").distinct().count()
    target = max(math.ceil(walked * int(counts.sum())), k + 1 + again)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            u = _unit(_matrix(b.column(1)))
            d1, d2 = _distances(u[:, :half], first), _distances(u[:, half:], second)
            rows = [
                (i, c, bits.to_bytes(width, "little"))
                for i in range(b.num_rows)
                for c, bits in enumerate(probed(d1[i], d2[i], counts, target))
                if bits
            ]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(at),
                    b.column(1).take(at),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.binary()),
                ],
                ["query_id", "embedding", "c1", "bits"],
            )

    asked = index.where(F.col("vec_id") % every == 0).select("vec_id", "embedding")
    kinds = f"query_id long, embedding {kind}, c1 int, bits binary"
    asking = stored(asked.mapInArrow(probes, kinds), "multi-index-probes")

    # Both sides of a first-half centroid are dealt into blocks; each block of probes meets each
    # block of entries. At most one count for each first-half centroid.
    visits = asking.groupBy("c1").count().toArrow()
    n_probes = np.zeros(len(first), np.int64)
    n_probes[visits.column("c1").to_numpy()] = visits.column("count").to_numpy()
    at_once = query_block or max(1024, QUERY_BYTES // (8 * dim))

    def blocks(rows: np.ndarray, size: int) -> Column:
        return F.array(*[F.lit(-(-int(n) // size)) for n in rows])[F.col("c1")]

    entry_blocks, probe_blocks = blocks(sizes.sum(axis=1), block), blocks(n_probes, at_once)
    entries = index.where(probe_blocks > 0).withColumns(
        {
            "eb": F.pmod(F.xxhash64("vec_id", "embedding"), entry_blocks.cast("long")).cast("int"),
            "qb": F.explode(F.sequence(F.lit(0), probe_blocks - 1)),
        }
    )
    asking = asking.withColumns(
        {
            "eb": F.explode(F.sequence(F.lit(0), entry_blocks - 1)),
            "qb": F.pmod(F.xxhash64("query_id", "embedding"), probe_blocks.cast("long")).cast("int"),
        }
    )
    keys = ["c1", "eb", "qb"]
    hits = (
        asking.groupBy(*keys).cogroup(entries.groupBy(*keys)).applyInArrow(_rerank(k), _HITS)
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    folded = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = folded.withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
