"""BPE by a public tokenizer file, with a faster library where it gives the same ids.

A single space between two ASCII letters always starts a new piece of the split patterns known here,
so a text may be cut before such spaces and the stretches encoded apart: ids and counts are those of
the whole text. Stretches with unusual characters or special strings go to the file's own library,
and so do all texts of a file of another kind.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np

from tidemark.llm.common import held

# White space other than space and line feed, and characters that not every library counts as such.
_ODD = re.compile(
    "[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f\u2060\u3000\ufeff]"
)
_SAFE = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")
SEGMENT = 1 << 18  # characters encoded at once
REMEMBERED = 150_000  # words of a generation; a worker keeps two

# Byte-level vocabularies write these bytes as themselves and the others from U+0100 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _byte_of() -> dict[str, int]:
    others = [b for b in range(256) if b not in _PLAIN]
    return {chr(b): b for b in _PLAIN} | {chr(256 + k): b for k, b in enumerate(others)}


def _merges(model: dict) -> list[tuple[str, str]]:
    pairs = model.get("merges") or []
    return [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in pairs]


def _plain_bpe(model: dict) -> bool:
    """Whether ids follow the order of merges, so that the least id wins, as ranks do."""
    if model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        return False
    vocab = model["vocab"]
    return all(a < b for a, b in pairwise(vocab["".join(p)] for p in _merges(model)))


class _ByteLevel:
    """The usual byte-level pattern; whole stretches go to the library that takes ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        import public_tokenizers
        import tiktoken

        self.ranked = tiktoken.Encoding(
            "ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    @classmethod
    def of(cls, said: dict, special: list[str]) -> "_ByteLevel | None":
        model, split = said["model"], said.get("pre_tokenizer") or {}
        usual = (
            _plain_bpe(model)
            and not model.get("end_of_word_suffix")
            and not said.get("normalizer")
            and split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space")
            and split.get("use_regex", True)
        )
        if not usual:
            return None
        byte = _byte_of()
        words = model["vocab"].items()
        return cls({bytes(byte[c] for c in w): i for w, i in words if w not in special})

    def usual(self, text: str) -> bool:
        return not _ODD.search(text)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.ranked.encode_ordinary(text), np.uint32)


class _Known(dict):
    """Ids of words as bytes; a missing word is encoded when it is asked for.

    A full generation becomes the old one. What is asked for again moves to the new one, so common
    words stay and rare ones go, in bounded memory.
    """

    def __init__(self, encode):
        self.encode = encode
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = array("I", self.encode(word)).tobytes()
        self[word] = ids
        return ids

    def turn(self, most: int) -> None:
        if len(self) > most:
            self.old = dict(self)
            self.clear()


class _WordEnds:
    """Lower-case words whose last symbol carries an end mark; white space is dropped.

    The mark becomes one closing byte, so that tokens with it are byte strings of their own and a
    library that takes ranks merges in the same order. That holds if every token is what its own
    symbols merge to, which is checked with the file's own merges. Only characters below U+0180 are
    taken: none of them composes with a neighbour or leaves that range in lower case.
    """

    # Fixed by the tokenizer file: how it prepares and splits texts.
    NORMALIZED = [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ]
    SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
    LETTERS, NUMBERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff\u0100-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe"
    PIECES = re.compile(
        f"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+"
    )
    USUAL = re.compile("[\n\r\t -~\xa1-\u012f\u0131-\u017f]*")
    CLOSING = "\x1f"

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        ranked = tiktoken.Encoding(
            "words",
            pat_str=f"[^{self.CLOSING}]+{self.CLOSING}",
            mergeable_ranks=ranks,
            special_tokens={},
        )
        self.known = _Known(lambda word: ranked.encode_ordinary(word + self.CLOSING))

    @classmethod
    def of(cls, said: dict, special: list[str]) -> "_WordEnds | None":
        model = said["model"]
        prepared = (said.get("normalizer") or {}).get("normalizers")
        steps = (said.get("pre_tokenizer") or {}).get("pretokenizers") or []
        usual = (
            model.get("end_of_word_suffix")
            and _plain_bpe(model)
            and prepared == cls.NORMALIZED
            and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
            and steps[0]["pattern"] == {"Regex": cls.SPLIT}
            and (steps[0]["behavior"], steps[0]["invert"]) == ("Removed", True)
            and not steps[1].get("add_prefix_space")
            and not steps[1].get("use_regex", True)
        )
        if not usual:
            return None
        from tokenizers.models import BPE

        end, vocab, merges = model["end_of_word_suffix"], model["vocab"], _merges(model)
        within, closing = BPE(vocab, merges), BPE(vocab, merges, end_of_word_suffix=end)
        byte, close = _byte_of(), cls.CLOSING.encode()
        ranks: dict[bytes, int] = {}
        for word, i in vocab.items():
            if word in special:
                continue
            ends = word.endswith(end) and len(word) > len(end)
            body = word[: -len(end)] if ends else word
            if [t.id for t in (closing if ends else within).tokenize(body)] != [i]:
                return None
            ranks[bytes(byte[c] for c in body) + (close if ends else b"")] = i
        return cls(ranks)

    def usual(self, text: str) -> bool:
        return bool(self.USUAL.fullmatch(text))

    def encode(self, text: str) -> np.ndarray:
        self.known.turn(REMEMBERED)
        words = self.PIECES.findall(text.lower())
        return np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.uint32)


class Encoder:
    """A tokenizer file of the library ``tokenizers``; one per path and worker."""

    @classmethod
    def of(cls, path: str) -> "Encoder":
        loaded = held("encoders")
        if path not in loaded:
            loaded[path] = cls(path)
        return loaded[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = [s for s in special if s]
        self.fast = _ByteLevel.of(said, special) or _WordEnds.of(said, special)
        size = self.tokenizer.get_vocab_size()
        pieces = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        # Byte-level vocabularies write a space as U+0120 and a line feed as U+010A.
        self.closes = np.fromiter((p[-1:] in ".!?" and p != "" for p in pieces), bool, size)
        self.opens = np.fromiter((p[:1] in "ĠĊ" and p != "" for p in pieces), bool, size)
        self.breaks = np.fromiter(("Ċ" in p for p in pieces), bool, size)

    def _unusual(self, text: str) -> bool:
        return not self.fast.usual(text) or any(s in text for s in self.special)

    def _segments(self, text: str) -> Iterator[str]:
        """Stretches of bounded length, where the file's kind is known; else the whole text."""
        at = 0
        while at < len(text):
            long = self.fast is not None and len(text) - at > SEGMENT
            found = _SAFE.search(text, at + SEGMENT) if long else None
            segment = text[at : found.start()] if found else text[at:]
            at += len(segment)
            yield segment

    def _found(self, text: str) -> Iterator[np.ndarray]:
        for segment in self._segments(text):
            if self.fast is None or self._unusual(segment):
                ids = self.tokenizer.encode(segment, add_special_tokens=False).ids
                yield np.array(ids, np.uint32)
            else:
                yield self.fast.encode(segment)

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text, without added special tokens, as unsigned 32-bit."""
        found = list(self._found(text))
        return found[0] if len(found) == 1 else np.concatenate([np.zeros(0, np.uint32), *found])

    def counts(self, texts: list[str]) -> list[int]:
        """The number of ids of each text; their ids are not kept."""
        return [sum(map(len, self._found(text))) for text in texts]

    def sentence_ends(self, ids: np.ndarray) -> np.ndarray:
        """Lengths of the prefixes of ids after which a sentence or line ends."""
        if len(ids) < 2:
            return np.zeros(0, np.int64)
        known = np.minimum(ids, len(self.closes) - 1)
        ends = (self.closes[known[:-1]] & self.opens[known[1:]]) | (
            self.breaks[known[:-1]] & ~self.breaks[known[1:]]
        )
        return np.flatnonzero(ends) + 1
