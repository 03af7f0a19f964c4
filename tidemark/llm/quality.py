"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins at quantiles. Cyclic boosting visits the features in turn; a visit
fits a shallow tree on one feature's histogram of gradients and adds it to that feature's lookup
table. Pairs of features that explain most of what is left then get two-dimensional tables in the
same way. A score is a sum of table entries, so scoring is a few vectorised additions per batch.

The model is fitted on a bounded sample (SAMPLE labelled rows by hash order) whose features are
brought to the driver: at most SAMPLE rows of a few numbers. Scoring reads every whole text once and
does not shuffle. Features come from the text alone.

Defined results: null text is empty and is scored like any text; labels other than 0 and 1 and null
ids in labels are left out; a document labelled both ways counts as both; without labels every score
is 1, with one class only it is that class; every row gives a row, repeats included; a null id stays
null and counts as the text of an empty id for the fold; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty

SAMPLE = 20_000
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
BINS, ROUNDS, PAIR_ROUNDS, PAIRS, RATE = 32, 60, 20, 8, 0.3

FEATURES = (
    "log_bytes", "word_length", "upper", "digit", "symbol", "bar", "bang", "distinct_words",
    "repeated_next", "stops", "line_words", "distinct_lines", "non_ascii", "closed_words",
)

_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_SYMBOL = b"#$%&*+<=>@\\^_`{}~/"
_SPACE = b" \t\n\r\x0b\x0c"
_HIGH = bytes(range(128, 256))


def features(text: str) -> tuple[float, ...]:
    """Numbers about a whole text that do not depend on its language."""
    b = text.encode()
    n = max(1, len(b))

    def share(of: bytes) -> float:
        return (len(b) - len(b.translate(None, of))) / n

    words = b.split()
    k = max(1, len(words))
    lines = b.split(b"\n")
    space = share(_SPACE)
    stops = b.count(b".") + b.count(b"?")
    return (
        float(np.log1p(len(b))),
        n * (1 - space) / k,
        share(_UPPER),
        share(_DIGIT),
        share(_SYMBOL),
        b.count(b"|") / k,
        b.count(b"!") / k,
        len(set(words)) / k,
        sum(map(eq, words, words[1:])) / k,
        stops / k,
        k / len(lines),
        len(set(lines)) / len(lines),
        share(_HIGH),
        (b.count(b". ") + b.count(b", ")) / k,
    )


class AdditiveModel:
    """Lookup tables per feature and per pair of features."""

    def __init__(self, base: float, edges: list[np.ndarray]):
        self.base, self.edges = base, edges
        self.tables = [np.zeros(len(e) + 1) for e in edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)]

    def raw(self, x: np.ndarray) -> np.ndarray:
        at = self.bins(x)
        total = np.full(len(x), self.base)
        for table, own in zip(self.tables, at):
            total += table[own]
        for i, j, table in self.pairs:
            total += table[at[i], at[j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-self.raw(x)))


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, index) of the cut of a histogram that lowers the loss most; index 0 is no cut."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1)
    at = int(gain.argmax())
    return float(gain[at]), at + 1 if gain[at] > 1e-9 else 0


def _step(g: np.ndarray, h: np.ndarray) -> float:
    return float(-g.sum() / (h.sum() + 1))


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values per bin of a tree of that depth on one feature."""
    cut = _best_cut(g, h)[1] if depth else 0
    if not cut:
        return np.full(len(g), _step(g, h))
    return np.concatenate(
        [_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)]
    )


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, values) of a tree that cuts the first feature and each side by the second."""
    best, values = 0.0, np.full(g.shape, _step(g, h))
    whole = g.sum() ** 2 / (h.sum() + 1)
    for cut in range(1, len(g)):
        gain, found = -whole, np.empty(g.shape)
        for side in (slice(0, cut), slice(cut, None)):
            gs, hs = g[side].sum(axis=0), h[side].sum(axis=0)
            more, at = _best_cut(gs, hs)
            gain += gs.sum() ** 2 / (hs.sum() + 1) + (more if at else 0)
            found[side, :at], found[side, at:] = _step(gs[:at], hs[:at]), _step(gs[at:], hs[at:])
        if gain > best + 1e-9:
            best, values = gain, found
    return best, values


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    if not len(y):
        return AdditiveModel(np.inf, [np.zeros(0)] * x.shape[1])
    if y.min() == y.max():
        return AdditiveModel(np.inf if y[0] else -np.inf, [np.zeros(0)] * x.shape[1])
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    model = AdditiveModel(
        float(np.log(y.mean() / (1 - y.mean()))),
        [np.unique(np.quantile(x[:, f], quantiles)) for f in range(x.shape[1])],
    )
    at = model.bins(x)
    raw = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-raw))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for f, table in enumerate(model.tables):
            g, h = slopes()
            n = len(table)
            step = RATE * _tree(np.bincount(at[f], g, n), np.bincount(at[f], h, n))
            table += step
            raw += step[at[f]]

    def histogram(i: int, j: int, values: np.ndarray) -> np.ndarray:
        shape = (len(model.tables[i]), len(model.tables[j]))
        flat = np.bincount(at[i] * shape[1] + at[j], values, shape[0] * shape[1])
        return flat.reshape(shape)

    g, h = slopes()
    ranked = []
    for i, j in combinations(range(x.shape[1]), 2):
        ranked.append((_pair_tree(histogram(i, j, g), histogram(i, j, h))[0], i, j))
    ranked.sort(key=lambda r: (-r[0], r[1], r[2]))
    model.pairs = [
        (i, j, np.zeros((len(model.tables[i]), len(model.tables[j]))))
        for gain, i, j in ranked[:PAIRS]
        if gain > 0
    ]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            g, h = slopes()
            step = RATE * _pair_tree(histogram(i, j, g), histogram(i, j, h))[1]
            table += step
            raw += step[at[i], at[j]]
    return model


def held_out(doc_id: Column) -> Column:
    key = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % FOLDS == HELD_OUT


def _featured(batches: Iterator[pa.RecordBatch], label: bool) -> Iterator[tuple]:
    for b in batches:
        rows = [features(t.as_py()) for t in b.column(1)]
        yield b, np.array(rows, np.float64).reshape(len(rows), len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AdditiveModel:
    """A model from at most sample labelled rows outside the held-out fold."""
    known = labels.where(
        F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))
    ).select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    total = known.count()
    # A hash threshold keeps a share that holds the sample; the limit bounds it whatever the hashes.
    steps = 1 << 20
    wanted = min(steps, -(-steps * 2 * sample // max(1, total)))
    order = F.xxhash64("doc_id", "quality")
    chosen = known.where(F.pmod(order, F.lit(steps)) < wanted).orderBy(order).limit(sample)
    text = docs.select("doc_id", text_or_empty().alias("text"))
    # At most `sample` ids and labels: their size is bounded, so they go to every task.
    marked = text.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _featured(batches, True):
            columns = [b.column(2), *(pa.array(x[:, f]) for f in range(len(FEATURES)))]
            yield pa.RecordBatch.from_arrays(columns, ["quality", *FEATURES])

    schema = "quality int, " + ", ".join(f"{f} double" for f in FEATURES)
    # Repeated documents share a label; the sample of rows is bounded like that of ids.
    found = marked.mapInArrow(rows, schema).limit(2 * sample).toArrow()
    found = found.sort_by([(c, "ascending") for c in found.column_names])
    x = np.column_stack([found.column(f).to_numpy() for f in FEATURES])
    return fit(x.reshape(-1, len(FEATURES)), found.column("quality").to_numpy().astype(float))


def score(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for each row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _featured(batches, False):
            s = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    text = docs.select(
        "doc_id", text_or_empty().alias("text"), held_out(F.col("doc_id")).alias("held_out")
    )
    return text.mapInArrow(
        rows, "doc_id long, held_out boolean, score double, predicted int"
    )


def accepted(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all columns, that the model does not reject."""
    at = docs.columns.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features(t.as_py() or "") for t in b.column(at)]
            x = np.array(found, np.float64).reshape(len(found), len(FEATURES))
            yield b.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(rows, docs.schema)
