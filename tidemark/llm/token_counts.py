"""Token counts of whole texts.

An Arrow function encodes and returns lengths only: ids never leave the worker. Rows are taken in
batches of about equal bytes, so a few long texts do not share a batch with thousands of short
ones, and a long text is encoded stretch by stretch, cut where the tokenizer starts a new piece.
No shuffle; a row's text is read once.

Defined results: null text is empty and has no tokens; every row gives a row, repeats included; a
null id stays null; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import balanced, text_or_empty
from tidemark.llm.encoding import Encoder

BATCH_BYTES = 4 << 20


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 512, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether n_tokens exceeds the limit, for each row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        for b in batches:
            texts = b.column(1)
            sizes = [len(t.as_buffer()) for t in texts]
            for first, last in balanced(sizes, batch_bytes):
                counts = encoder.counts(texts.slice(first, last - first).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).slice(first, last - first),
                        pa.array(sizes[first:last], pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([n > limit for n in counts], pa.bool_()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    text = docs.select("doc_id", text_or_empty().alias("text"))
    return text.mapInArrow(
        rows, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
