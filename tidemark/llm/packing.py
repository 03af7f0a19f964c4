"""Order-preserving packing of token streams into windows of bounded length.

The documents of a partition, in order, are one stream of ids. Windows are cut at document or
sentence ends so that padding plus penalties for cut documents is least. With P(j) the position of
boundary j and L the window length, the least cost up to j is

    cost(j) = penalty(j) + L - P(j) + min { cost(i) + P(i) : P(j) - P(i) <= L }

and the minimum slides with j, so a monotone queue finds all transitions in linear time. A window
whose length is a power of two needs no padding.

Distribution: documents are range-partitioned by id, so order is kept and every partition packs on
its own. A partition is read as a stream in blocks of bounded size; the last window of a block goes
on into the next one, so only a partition's end can hold padding beyond the optimum.

Defined results: null text is empty and yields the closing id alone; rows with equal ids are packed
one by one; null ids sort first; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty
from tidemark.llm.encoding import Encoder

WINDOW = 2048
SENTENCE_PENALTY = 4  # a window that ends at a sentence end within a document
FORCED_PENALTY = 24  # a window that ends within a sentence
LONG_SENTENCE = 64  # ids; longer sentences may be cut within, at every FORCED_STEP ids
FORCED_STEP = 16
END_ID = 1
BLOCK = 1 << 20  # ids optimised at once

_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, ids array<int>"
)
_IDS = ", ids array<int>"
_HELD = 1 << 18  # ids of pieces gathered before they are handed on


def cut(
    positions: np.ndarray, penalties: np.ndarray, window: int, finish: bool
) -> list[int]:
    """Boundaries (indexes into positions) at which windows end; the first boundary is position 0.

    No two neighbouring positions are further apart than window. Without finish, the end of the
    stream costs nothing, as the last window goes on.
    """
    at, pen = positions.tolist(), penalties.tolist()
    n = len(at)
    cost, back = [0] * n, [0] * n
    queue: deque[tuple[int, int]] = deque()  # (cost + position, index), both increasing
    last = n - 1
    for j in range(1, n):
        i = j - 1
        key = cost[i] + at[i]
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, i))
        p = at[j]
        low = p - window
        while at[queue[0][1]] < low:
            queue.popleft()
        key, i = queue[0]
        if j == last and not finish:
            # The open window's padding is decided by what follows it.
            key, i = min((cost[i], i) for _, i in queue)
            cost[j] = key
        else:
            cost[j] = key + pen[j] + window - p
        back[j] = i
    ends = []
    j = last
    while j > 0:
        ends.append(j)
        j = back[j]
    return ends[::-1]


def _tail(length: int, window: int, penalty: int) -> list[int]:
    """Lengths of the last windows: padded as one, or cut into powers of two."""
    bits = [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]
    if len(bits) > 1 and penalty * (len(bits) - 1) < window - length:
        return bits
    return [length]


class Packer:
    """Windows of one stream; feed documents in order, then finish."""

    def __init__(self, window: int, sentence: int, forced: int, block: int, first: int):
        self.window, self.sentence, self.forced = window, sentence, forced
        self.block = max(block, 2 * window)
        self.sequence = first
        self.docs: list[tuple] = []  # (doc_id, start, ids, number of the document's ids, ends)
        self.held = 0

    def add(self, doc_id, ids: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
        """ends: lengths of prefixes of ids that end a sentence."""
        step = self.block
        for a in range(0, len(ids), step):
            part = ids[a : a + step]
            within = ends[(ends > a) & (ends <= a + len(part))] - a
            self.docs.append((doc_id, a, part, len(ids), within))
            self.held += len(part)
            if self.held >= self.block:
                yield from self._flush(False)

    def finish(self) -> Iterator[tuple]:
        if self.held:
            yield from self._flush(True)

    def _boundaries(self) -> tuple[np.ndarray, np.ndarray]:
        positions, penalties = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        base = 0
        for _, a, ids, n, ends in self.docs:
            own = ends if len(ends) and ends[-1] == len(ids) else np.append(ends, len(ids))
            pen = np.full(len(own), self.sentence, np.int64)
            pen[-1] = 0 if a + len(ids) == n else self.forced
            positions.append(own + base)
            penalties.append(pen)
            base += len(ids)
        at, pen = np.concatenate(positions), np.concatenate(penalties)
        wide = np.flatnonzero(np.diff(at) > min(LONG_SENTENCE, self.window))
        if len(wide):
            step = min(FORCED_STEP, self.window)
            extra = np.concatenate([np.arange(at[i] + step, at[i + 1], step) for i in wide.tolist()])
            at, pen = np.append(at, extra), np.append(pen, np.full(len(extra), self.forced))
            order = np.argsort(at, kind="stable")
            at, pen = at[order], pen[order]
        return at, pen

    def _flush(self, final: bool) -> Iterator[tuple]:
        at, pen = self._boundaries()
        stops = at[cut(at, pen, self.window, final)].tolist()
        if final:
            begin = stops[-2] if len(stops) > 1 else 0
            sizes = _tail(stops[-1] - begin, self.window, self.forced)
            stops[-1:] = (begin + np.cumsum(sizes)).tolist()
        else:
            stops.pop()
        yield from self._pieces(stops)

    def _pieces(self, stops: list[int]) -> Iterator[tuple]:
        """Pieces of the windows that end at stops; what lies behind stays held."""
        k = opened = base = 0  # current window, where it began, where the document began
        rest: list[tuple] = []
        for doc_id, a, ids, n, ends in self.docs:
            done = 0
            while done < len(ids) and k < len(stops):
                take = min(len(ids), stops[k] - base) - done
                piece = ids[done : done + take]
                yield (
                    doc_id,
                    a + done,
                    take,
                    zlib.crc32(piece.astype("<u4").tobytes()),
                    n,
                    self.sequence,
                    base + done - opened,
                    piece,
                )
                done += take
                if base + done == stops[k]:
                    opened = stops[k]
                    k += 1
                    self.sequence += 1
            if done < len(ids):
                rest.append((doc_id, a + done, ids[done:], n, ends[ends > done] - done))
            base += len(ids)
        self.docs = rest
        self.held = sum(len(d[2]) for d in rest)


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    sentence_penalty: int = SENTENCE_PENALTY,
    forced_penalty: int = FORCED_PENALTY,
    end_id: int = END_ID,
    block: int = BLOCK,
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: its ids, and where it lies in its document and in its sequence.

    A sequence is the ids of its pieces by offset; length and ids_crc32 are those of ids. Without
    ``keep_ids`` the rows have no column ids.

    tokenizer: path of a tokenizer file on every executor. Sequence ids are unique and, within a
    range of document ids, consecutive.
    """
    schema = _SCHEMA if keep_ids else _SCHEMA.removesuffix(_IDS)
    names = [c.split()[0] for c in schema.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        first = TaskContext.get().partitionId() << 32
        packer = Packer(window, sentence_penalty, forced_penalty, block, first)
        out: list[tuple] = []
        held = 0

        def add(pieces: Iterator[tuple]) -> None:
            nonlocal held
            for piece in pieces:
                out.append(piece if keep_ids else piece[:-1])
                held += len(piece[-1])

        def batch() -> pa.RecordBatch:
            nonlocal held
            columns = list(zip(*out)) if out else [[] for _ in names]
            ids = columns.pop() if keep_ids else None
            arrays = [pa.array(c, pa.int64()) for c in columns]
            if ids is not None:
                offsets = np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int32)
                values = np.concatenate([np.zeros(0, np.uint32), *ids]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))
            out.clear()
            held = 0
            return pa.RecordBatch.from_arrays(arrays, names)

        for b in batches:
            keys = b.column(0).to_pylist()
            for doc_id, text in zip(keys, b.column(1)):
                ids = np.append(encoder.ids(text.as_py()), np.uint32(end_id))
                add(packer.add(doc_id, ids, encoder.sentence_ends(ids)))
                if held >= _HELD:
                    yield batch()
        add(packer.finish())
        yield batch()

    text = docs.select("doc_id", text_or_empty().alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = text.repartitionByRange(width, *order).sortWithinPartitions(*order)
    return ordered.mapInArrow(rows, schema)
