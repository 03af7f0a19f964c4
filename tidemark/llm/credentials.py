"""Secret scans: plain credentials, and multipart ones linked within their scope.

Plain spans (kinds assign, access, hex) are reported wherever they stand. Parts that alone mean
little (an account name, an unlabelled random string, an address) are weak: they are reported only
when complementary parts stand in the same scope. A scope is a block of lines without an empty line
between, and parts in it link when at most SCOPE characters lie between them. The links are an
interval join, done as a sweep over the sorted parts of a document; a document with many parts
costs their number times its logarithm.

Defined results: null text is empty; every row gives a row, repeats included; a null id stays null;
positions are code points, ends exclusive; other columns are left out (redact keeps all).
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty

SCOPE = 300
KINDS = ("assign", "access", "hex", "id", "secret", "endpoint")
REDACTED = "[redacted]"

# Fixed patterns of the plain kinds.
_ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

# Weak parts.
_ID = re.compile(
    r"""\b(?i:access_?key(?:_?id)?|client_?id|account_?id|user(?:_?name)?|login)["']?\x20*[:=]"""
    r"""\x20*["']?[A-Za-z0-9._@-]{4,}""",
    re.ASCII,
)
_RANDOM = re.compile(r"[A-Za-z0-9+/_-]{20,}")
_ENDPOINT = re.compile(
    r"""(?:https?|jdbc:[a-z]+|s3|amqp|redis|postgres(?:ql)?|mysql)://[^\s"'<>]+"""
)
_BLOCK_END = re.compile(r"\n[ \t]*\n")


def plain_spans(text: str) -> list[tuple[int, int, str]]:
    spans = [
        (m.start(), m.end(), "assign")
        for m in _ASSIGN.finditer(text)
        if m.end(2) - m.start(2) >= ASSIGN_LEAST
    ]
    spans += [
        (m.start(), m.end(), "access")
        for m in _ACCESS.finditer(text)
        if m.end() - m.start() >= ACCESS_LEAST
    ]
    # A run is matched whole from its start, so the length can be asked for in the pattern.
    spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return spans


def _looks_random(s: str) -> bool:
    return any(c.isdigit() for c in s) and any(c.isupper() for c in s) and s.upper() != s


class _Sorted:
    """Parts by their starts and by their ends; which lie near a span of the same block.

    Of the parts behind a span the first decides: the others lie in its block or in later ones. Of
    those before it, the ends within the scope are looked at, which are no more than its characters.
    """

    def __init__(self, parts: list[tuple[int, int, str]], breaks: list[int], scope: int):
        self.starts = sorted(p[0] for p in parts)
        by_end = sorted((p[1], p[0]) for p in parts)
        self.ends = [b for b, _ in by_end]
        self.begins = [a for _, a in by_end]
        self.breaks, self.scope = breaks, scope

    def near(self, start: int, end: int) -> bool:
        block = bisect_right(self.breaks, start)
        k = bisect_left(self.starts, end)
        if k < len(self.starts) and self.starts[k] <= end + self.scope:
            if bisect_right(self.breaks, self.starts[k]) == block:
                return True
        first = bisect_left(self.ends, start - self.scope)
        for k in range(bisect_right(self.ends, start) - 1, first - 1, -1):
            if bisect_right(self.breaks, self.begins[k]) == block:
                return True
        return False


def _free(weak: list[tuple[int, int, str]], taken: list[tuple]) -> list[tuple[int, int, str]]:
    """Weak parts that overlap nothing taken."""
    taken = sorted((a, b) for a, b, _ in taken)
    kept, k, reach = [], 0, -1
    for a, b, kind in sorted(weak):
        while k < len(taken) and taken[k][0] < b:
            reach = max(reach, taken[k][1])
            k += 1
        if reach <= a:
            kept.append((a, b, kind))
    return kept


def linked_spans(
    text: str, plain: list[tuple[int, int, str]], scope: int = SCOPE
) -> list[tuple[int, int, str]]:
    """The weak parts whose complement stands in their scope."""
    ids = [(m.start(), m.end(), "id") for m in _ID.finditer(text)]
    ids = _free(ids, plain)
    strong_ids = [p for p in plain if p[2] == "access"]
    strong_secrets = [p for p in plain if p[2] != "access"]
    if not ids and not strong_ids:
        return []  # neither a secret nor an endpoint has its complement without an identifier
    secrets = [
        (m.start(), m.end(), "secret")
        for m in _RANDOM.finditer(text)
        if _looks_random(m.group())
    ]
    secrets = _free(secrets, [*plain, *ids])
    breaks = [m.end() for m in _BLOCK_END.finditer(text)]
    by_id = _Sorted([*strong_ids, *ids], breaks, scope)
    by_secret = _Sorted([*strong_secrets, *secrets], breaks, scope)
    out = [p for p in ids if by_secret.near(p[0], p[1])]
    out += [p for p in secrets if by_id.near(p[0], p[1])]
    endpoints = [(m.start(), m.end(), "endpoint") for m in _ENDPOINT.finditer(text)]
    endpoints = _free(endpoints, [*plain, *ids, *secrets])
    out += [p for p in endpoints if by_id.near(p[0], p[1]) and by_secret.near(p[0], p[1])]
    return out


def _joined(spans: list[tuple[int, int, str]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in ordered)


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row: counts of plain spans, the digest of their places, and the places of all spans."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: list[list[int]] = [[], [], []]
            digests, places = [], []
            for value in b.column(1):
                text = value.as_py()
                plain = plain_spans(text)
                for kind, column in zip(KINDS, counts):
                    column.append(sum(p[2] == kind for p in plain))
                digests.append(hashlib.sha256(_joined(plain).encode()).hexdigest())
                places.append(_joined([*plain, *linked_spans(text, plain, scope)]))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array(digests, pa.string()),
                    pa.array(places, pa.string()),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    schema = (
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(rows, schema)


def _without(text: str, scope: int) -> str:
    plain = plain_spans(text)
    spans = sorted((a, b) for a, b, _ in [*plain, *linked_spans(text, plain, scope)])
    out, at = [], 0
    for a, b in spans:
        if a >= at:
            out += [text[at:a], REDACTED]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """docs with every span of the text replaced; n_chars, where there is one, follows the text."""
    names = docs.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for b in batches:
            texts = (None if t is None else _without(t, scope) for t in map(_value, b.column(at)))
            column = pa.array(texts, b.schema.field(at).type)
            yield b.set_column(at, b.schema.field(at), column)

    clean = docs.mapInArrow(rows, docs.schema)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        length = F.when(F.col("text").isNotNull(), F.length("text").cast(kind))
        clean = clean.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))
    return clean.select(names)


def _value(scalar: pa.Scalar) -> str | None:
    return scalar.as_py()
