import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import jaccard
from tidemark.llm.components import components


def brute(rows, width, percent):
    """(doc_id, n, least id reachable) by comparing all pairs."""
    sets = []
    for _, text in rows:
        lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        runs = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
        sets.append(runs or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return [
        (d, len(s), least.get(top(i)) if s else d)
        for i, ((d, _), s) in enumerate(zip(rows, sets))
    ]


def near_copies(sentences, seed, n):
    """Texts with edits at all rates, so that similarities lie on both sides of any threshold."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.75:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6, 12])):
                if words:
                    words[rng.randrange(len(words))] = f"w{rng.randrange(400)}"
            if rng.random() < 0.2:
                words = words[: rng.randint(1, len(words))] if words else words
        else:
            words = [
                w if rng.random() < 0.5 else f"{w}{rng.randrange(50)}"
                for s in rng.choices(sentences, k=rng.randint(1, 8))
                for w in s.split()
            ]
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize(("width", "percent", "block"), [(4, 85, 1024), (4, 85, 5), (5, 80, 4), (3, 50, 7)])
def test_components_equal_brute_force(docs_of, sentences, width, percent, block):
    rows = near_copies(sentences, width, 150)
    rows += [(900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one TWO"), (905, "two")]
    got = jaccard.linked(docs_of(rows), width, percent, block_sets=block).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, width, percent))


def test_copies_repeats_and_nulls(docs_of):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (None, "A b c d e"), (3, "q r s t u"), (None, "z")]
    got = jaccard.linked(docs_of(rows)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows, 4, 85), key=repr)
    assert jaccard.linked(docs_of([])).count() == 0


def test_one_of_each_group_stays(docs_of, sentences):
    rows = near_copies(sentences, 9, 60) + [(70, None), (71, ""), (None, "x"), (0, "other text")]
    docs = docs_of(rows + rows[:5])
    kept = jaccard.one_of_each(docs)
    want = {d for d, n, c in brute(rows[:60], 5, 80) if d == c} | {70, 71, None}
    got = kept.collect()
    assert kept.columns == docs.columns
    assert {r.doc_id for r in got} == want
    assert sorted(r.text for r in got if r.doc_id == 0) == sorted([rows[0][1], "other text"])
    assert len(got) == len(want) + 1


def prefixes_of(sets, percent, seed):
    """Prefixes under a random order of all tokens."""
    place = np.random.default_rng(seed).permutation(5000)
    return [
        np.array(sorted(s.tolist(), key=place.__getitem__)[: jaccard.prefix_length(len(s), percent)])
        for s in sets
    ]


def test_candidates_share_a_prefix_under_both_orders(monkeypatch):
    """Pairs that meet under one order only are never counted, and links are found all the same."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 4000, 50)
    sets = [np.unique(np.append(base[rng.random(50) < 0.97], rng.integers(0, 4000, 2))) for _ in range(30)]
    sets += [np.unique(rng.integers(0, 4000, 50)) for _ in range(30)]
    first, second = (prefixes_of(sets, 85, seed) for seed in (3, 4))
    none = [np.zeros(0, np.int64)] * len(sets)
    side = np.zeros(len(sets), np.int64)
    both = jaccard.links_within(sets, [first, second], side, 85)
    assert both and sorted(both) == sorted(jaccard.links_within(sets, [first], side, 85))
    assert jaccard.links_within(sets, [first, none], side, 85) == []
    assert jaccard.links_within(sets, [none, second], side, 85) == []


def test_block_pairs_of_a_group_are_dealt_apart(spark):
    """One group of many blocks is not one task, although its rows come dealt by their group."""
    rows = [(i.to_bytes(2, "big"), b"cell", 3, [1, 2, 3 + i % 4], [1], [2]) for i in range(40)]
    sets = spark.createDataFrame(
        rows,
        "set_key binary, cell binary, n_shingles long, shingles array<long>, "
        "first array<long>, second array<long>",
    )
    links = jaccard._links(sets, 50, 5, 1 << 20)
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(pair" in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = jaccard._links(sets, 50, 5, 1 << 20).count()
        used = (
            jaccard._links(sets, 50, 5, 1 << 20)
            .select(F.spark_partition_id().alias("p"))
            .distinct()
            .count()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert pairs > 30 and used > 1


def test_verification_of_blocks_finds_every_component():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1000, 60)
    sets = []
    for _ in range(40):
        s = base.copy()
        s[rng.integers(0, 60, rng.integers(1, 12))] = rng.integers(2000, 3000)
        sets.append(np.unique(s))
    prefixes = [prefixes_of(sets, 85, seed) for seed in (1, 2)]
    links = jaccard.links_within(sets, prefixes, np.zeros(40, np.int64), 85)
    want = {
        (i, j)
        for i in range(40)
        for j in range(i)
        if 100 * len(np.intersect1d(sets[i], sets[j]))
        >= 85 * len(np.union1d(sets[i], sets[j]))
    }

    def parts(edges):
        root = list(range(40))
        for a, b in edges:
            ra, rb = root[a], root[b]
            root = [ra if r == rb else r for r in root]
        return {frozenset(i for i in range(40) if root[i] == r) for r in root}

    assert parts(links) == parts(want) and len(links) < 40


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    random.Random(1).shuffle(chain)
    got = components(spark.createDataFrame(chain, "a long, b long")).collect()
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert {r.node: r.root for r in got} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_of_shingles_bear_numbers_and_nothing_that_their_set_has_once(docs_of, sentences, monkeypatch):
    seen = {}

    class Kept(jaccard.Stored):
        def __init__(self, df, name):
            seen[name] = df.schema.simpleString()
            super().__init__(df, name)

    monkeypatch.setattr(jaccard, "Stored", Kept)
    rows = near_copies(sentences, 7, 40)
    got = jaccard.linked(docs_of(rows)).collect()
    assert len(got) == len(rows)
    assert seen["shared-shingles"] == "struct<token:bigint,set_id:bigint,df:bigint>"
