import json
import random
import re

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tidemark.llm import textkit, token_counts
from tidemark.llm.common import Bitmap, balanced, bitmap_of
from tidemark.llm.encoding import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "", " ", "  ", "\n", "a  b", "a \n b", "\n\na", "a\n\n", "tail  ", "x\t\n\ny", "it's  they'll",
    "<|endoftext|> a <|endoftext|>b", "é ü z", "a b  c", "word " * 50, "日本 語", "9,5 %",
    "\r\n a\r\n", " 　 b", "$$ ** a!!", "a\u001cb c", "\x00 z",
]


def test_ids_are_those_of_the_library():
    encoder, plain = Encoder.of(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(3)
    pieces = [" ", "  ", "\n", "a", "be", "'s", "é", "1", "!", "\t", " ", "<|endoftext|>", "Z"]
    made = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    for text in HARD + made:
        want = plain.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text).tolist() == want, repr(text)
        assert encoder.counts([text]) == [len(want)]


def test_long_texts_are_cut_safely(monkeypatch):
    monkeypatch.setattr("tidemark.llm.encoding.SEGMENT", 20)
    encoder, plain = Encoder(PATH), Tokenizer.from_file(PATH)
    text = "The mill  stood\nnear it's <|endoftext|> old\tbridge " * 20
    assert encoder.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [PATH, WORDS])
def test_every_code_point_gives_the_ids_of_the_library(path):
    encoder, plain = Encoder.of(path), Tokenizer.from_file(path)
    points = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    texts = [f"Ab{c}c {c} d{c}" for c in points]
    want = plain.encode_batch_fast(texts, add_special_tokens=False)
    for text, ids in zip(texts, want):
        assert encoder.ids(text).tolist() == ids.ids, repr(text)


def test_words_with_ends_take_the_fast_way(folder):
    encoder, plain = Encoder(WORDS), Tokenizer.from_file(WORDS)
    assert encoder.fast is not None and Encoder(PATH).fast is not None
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["text"]).column(0).to_pylist()
    texts = [t for t in docs if t]
    want = plain.encode_batch_fast(texts, add_special_tokens=False)
    for text, ids in zip(texts, want):
        assert encoder.ids(text).tolist() == ids.ids
    pieces = [" ", "'S", "\n", "Aé", "be", "'s", "É", "1", "½", "!", "ǅ", "İ", "\t", "Word", "³x", "<|endoftext|>"]
    rng = random.Random(9)
    for _ in range(1500):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 40)))
        assert encoder.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_common_words_stay_in_bounded_memory(monkeypatch):
    monkeypatch.setattr("tidemark.llm.encoding.REMEMBERED", 10)
    encoder, plain = Encoder(WORDS), Tokenizer.from_file(WORDS)
    for i in range(60):
        text = f"the river word{i} and {i} others' x{i}y"
        assert encoder.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert len(encoder.fast.known) + len(encoder.fast.known.old) < 60


def test_a_file_of_another_kind_is_left_to_its_library(tmp_path):
    with open(WORDS, encoding="utf-8") as f:
        said = json.load(f)
    said["normalizer"] = None
    other = tmp_path / "other.json"
    other.write_text(json.dumps(said))
    encoder, plain = Encoder(str(other)), Tokenizer.from_file(str(other))
    assert encoder.fast is None
    text = "The Mill stood " * 30
    assert encoder.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_counts_of_rows(docs_of):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "x y " * 400), (3, "x y " * 400)]
    got = token_counts.token_counts(docs_of(rows), PATH, batch_bytes=100).collect()
    plain = Tokenizer.from_file(PATH)
    want = []
    for i, t in rows:
        n = len(plain.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 512))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(docs_of([]), PATH).count() == 0


def test_words_are_those_of_split(monkeypatch):
    monkeypatch.setattr(textkit, "CHUNK", 64)
    rng = random.Random(5)
    texts = [
        bytes(rng.choice(b"ab \t\n\x0b\xc3\xa9") for _ in range(rng.randint(0, 300)))
        for _ in range(80)
    ]
    ids: dict[bytes, int] = {}
    for i, words in textkit.word_hashes(texts):
        split = re.findall(rb"[^\x20\x09-\x0d]+", texts[i])
        assert len(split) == len(words)
        for w, h in zip(split, words.tolist()):
            assert ids.setdefault(w, h) == h
    assert len(set(ids.values())) == len(ids)


def test_shingle_sets_count_distinct_runs():
    for text in [b"", b"a", b"a b c", b"a b c d", b"a b a b a b a b", b"c b a"]:
        ((_, words),) = textkit.word_hashes([text])
        split = text.split()
        runs = {tuple(split[i : i + 4]) for i in range(len(split) - 3)} or {tuple(split)} - {()}
        assert len(textkit.shingle_set(words, 4)) == len(runs)


def test_balanced_ranges_cover_in_order():
    assert list(balanced([], 5)) == []
    assert list(balanced([9, 1, 1, 9, 2, 3], 5)) == [(0, 1), (1, 3), (3, 4), (4, 6)]


def test_bitmap_holds_all_members(spark):
    values = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 500)
    df = spark.createDataFrame([(int(v),) for v in values], "v long")
    found: Bitmap = bitmap_of(df, "v", bits=20)
    assert found.has(values).all()
    assert found.has(np.arange(10_000) * 1_844_674_407_370_955).mean() < 0.01
    assert not bitmap_of(df.where("v = 0"), "v", bits=20).has(values).any()
