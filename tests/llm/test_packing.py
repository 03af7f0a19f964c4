import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm import packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(positions, penalties, window):
    best = None
    inner = range(1, len(positions) - 1)
    for k in range(len(positions)):
        for chosen in itertools.combinations(inner, k):
            ends = [0, *chosen, len(positions) - 1]
            sizes = [positions[b] - positions[a] for a, b in zip(ends, ends[1:])]
            if max(sizes) > window:
                continue
            cost = sum(window - s for s in sizes) + sum(penalties[e] for e in ends[1:])
            best = cost if best is None else min(best, cost)
    return best


def test_cuts_have_the_least_cost():
    rng = random.Random(2)
    for _ in range(300):
        window = rng.randint(3, 12)
        steps = [rng.randint(1, window) for _ in range(rng.randint(1, 9))]
        positions = np.concatenate([[0], np.cumsum(steps)])
        penalties = np.array([rng.choice([0, 1, 4]) for _ in positions])
        ends = packing.cut(positions, penalties, window, True)
        sizes = np.diff(positions[[0, *ends]])
        assert sizes.max() <= window and ends[-1] == len(positions) - 1
        cost = int((window - sizes).sum() + penalties[ends].sum())
        assert cost == brute(positions.tolist(), penalties.tolist(), window)


def check_pieces(rows, texts, window):
    """Each id of each document lies in one piece, pieces fill sequences, digests fit."""
    plain = Tokenizer.from_file(PATH)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            piece = np.array(ids[p.start : p.start + p.length], "<u4")
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(piece.tobytes())
            at += p.length
        assert at == len(ids)
    return padding / sum(r.length for r in rows)


def test_small_windows_and_blocks(docs_of, sentences):
    rng = random.Random(4)
    texts = {i: ". ".join(rng.choices(sentences, k=rng.randint(0, 30))) for i in range(40)}
    texts |= {50: None, 51: "", 52: "x" * 3000, 53: "no stop " * 500}
    rows = packing.pack(docs_of(list(texts.items())), PATH, window=64, block=300).collect()
    assert check_pieces(rows, texts, 64) < 0.15


def test_repeated_rows_null_ids_and_no_rows(docs_of):
    rows = packing.pack(docs_of([(None, "a b"), (7, "c"), (7, "c"), (7, "d e")]), PATH).collect()
    assert sum(r.length for r in rows) == 3 + 2 + 2 + 3
    assert {(r.doc_id, r.doc_tokens) for r in rows} == {(None, 3), (7, 2), (7, 3)}
    assert rows[0].doc_id is None
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert packing.pack(docs_of([]), PATH).count() == 0


def test_query_packs_the_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = queries.op1_packing(spark, folder).collect()
    assert check_pieces(rows, {d.doc_id: d.text for d in docs}, 2048) < 0.05


def test_pieces_hold_their_ids(docs_of, sentences):
    rng = random.Random(5)
    texts = {i: ". ".join(rng.choices(sentences, k=rng.randint(0, 30))) for i in range(40)}
    texts |= {50: None, 51: "", 52: "x" * 3000}
    rows = packing.pack(docs_of(list(texts.items())), PATH, window=64, block=300).collect()
    plain = Tokenizer.from_file(PATH)
    for doc_id, text in texts.items():
        pieces = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start)
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        assert [i for p in pieces for i in p.ids] == ids
    for r in rows:
        assert r.length == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())


def test_last_stage_of_the_pipeline_stores_ids(spark, docs_of):
    import corpus_pipeline

    packed = dict(corpus_pipeline.STAGES)["packing"](spark, docs_of([(1, "a b"), (2, "c")]), "")
    rows = packed.collect()
    assert sum(len(r.ids) for r in rows) == 5 and all(len(r.ids) == r.length for r in rows)
