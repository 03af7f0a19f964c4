import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm import bins, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


def fewest(sizes, window):
    """By trying every place for every item."""
    best = [len(sizes)]
    order = sorted(sizes, reverse=True)

    def place(i, loads):
        if len(loads) >= best[0] and i < len(order):
            return
        if i == len(order):
            best[0] = min(best[0], len(loads))
            return
        for b in range(len(loads)):
            if loads[b] + order[i] <= window and loads[b] not in loads[:b]:
                place(i + 1, [*loads[:b], loads[b] + order[i], *loads[b + 1 :]])
        place(i + 1, [*loads, order[i]])

    place(0, [])
    return best[0]


def whole(found, sizes, window):
    assert sorted(i for b in found for i in b) == list(range(len(sizes)))
    assert all(b and sum(sizes[i] for i in b) <= window for b in found)


def test_evolution_finds_the_fewest_bins():
    rng = random.Random(1)
    plain = evolved = 0
    for k in range(120):
        window = 60
        sizes = [rng.randint(12, 34) for _ in range(rng.randint(1, 11))]
        best = fewest(sizes, window)
        first: bins.Bins = []
        bins.best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i]), sizes, window, first, [])
        found = bins.evolve([], sizes, window, 8, 60, random.Random(k))[0]
        whole(first, sizes, window)
        whole(found, sizes, window)
        assert bins.least_bins(sizes, window) <= best <= len(found) <= len(first)
        plain += len(first) == best
        evolved += len(found) == best
    assert evolved >= 118 and evolved > plain


def test_child_keeps_injected_bins_and_every_item_once():
    rng = random.Random(2)
    for k in range(100):
        sizes = [rng.randint(1, 50) for _ in range(40)]
        mother, father = (
            bins.evolve([], sizes, 100, 1, 0, random.Random(s))[0] for s in (k, 1000 + k)
        )
        order = list(range(40))
        rng.shuffle(order)
        father = []
        bins.best_fit(order, sizes, 100, father, [])
        child = bins.cross(mother, father, sizes, 100, rng)
        whole(child, sizes, 100)
        assert any(sorted(c[: len(f)]) == sorted(f) for c in child for f in father)


def test_population_never_gets_worse():
    rng = random.Random(3)
    sizes = [rng.choice([51, 27, 26, 23, 24, 25, 50, 49]) for _ in range(60)]
    population = bins.evolve([], sizes, 100, 6, 0, random.Random(0))
    before = bins.worth(population[0], sizes, 100)
    for k in range(5):
        population = bins.evolve(population, sizes, 100, 6, 10, random.Random(k))
        after = bins.worth(population[0], sizes, 100)
        assert after >= before
        before = after
        for individual in population:
            whole(individual, sizes, 100)


def check_rows(rows, texts, window):
    """texts: (doc_id, text) of every document. Returns the number of sequences."""
    plain = Tokenizer.from_file(PATH)
    want = defaultdict(int)
    for doc_id, text in texts:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), window)):
            own = np.array(ids[start : start + window], "<u4")
            want[doc_id, piece, start, len(own), zlib.crc32(own.tobytes())] += 1
    got = defaultdict(int)
    by_sequence = defaultdict(list)
    for r in rows:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        by_sequence[r.sequence_id].append(r)
        if "ids" in r:
            assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    assert got == want
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
    return len(by_sequence)


def test_many_problems_and_levels(docs_of, sentences):
    rng = random.Random(4)
    texts = [(i, ". ".join(rng.choices(sentences, k=rng.randint(0, 9)))) for i in range(300)]
    texts += [(400, None), (401, ""), (402, "x y " * 900), (403, "mill " * 63)]
    rows = bins.pack(docs_of(texts), PATH, window=64, items=40, epochs=3).collect()
    n = check_rows(rows, texts, 64)
    total = sum(r.length for r in rows)
    assert n <= 1.1 * total / 64
    levels = {r.sequence_id >> 56 for r in rows if r.sequence_id >= 0}
    assert len(levels) > 1


def test_repeated_rows_null_ids_and_no_rows(docs_of):
    texts = [(None, "a b"), (7, "c"), (7, "c"), (7, "d e"), (None, None)]
    assert check_rows(bins.pack(docs_of(texts), PATH).collect(), texts, 2048) == 1
    assert bins.pack(docs_of([]), PATH).count() == 0
    full = [(1, "a " * 2047), (2, "a " * 4095)]
    assert check_rows(bins.pack(docs_of(full), PATH).collect(), full, 2048) == 3


def test_query_packs_the_whole_table(spark, folder):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = queries.op11_best_fit(spark, folder).collect()
    n = check_rows(rows, docs, 2048)
    assert n <= -(-sum(r.length for r in rows) // 2048) + 1
