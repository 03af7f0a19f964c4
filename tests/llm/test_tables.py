import base64
import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

from tidemark.llm import archive, multi_index, quality, queries, sharding, sql

# Multi-index.


def brute_nearest(rows, every, k):
    good = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            good[i] = np.array(v, np.float64)
    out = {}
    for q in (i for i in good if i % every == 0):
        scored = []
        for i, v in good.items():
            if i != q:
                cos = float(good[q] @ v / np.sqrt((good[q] @ good[q]) * (v @ v)))
                scored.append((-round(cos, 12), i))
        out[q] = [i for _, i in sorted(scored)[:k]]
    return out


def vectors_of(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.selectExpr("*", "1 AS label", "'x' AS c1", "2 AS query_id").repartition(3)


def test_whole_share_equals_brute_force_with_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).astype("float32").tolist()) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]  # copies: ties by id
    rows += [(300, None), (301, [0.0] * 6), (302, [float("nan")] * 6), (303, [1.0, None] * 3)]
    rows += [(304, [float("inf")] * 6), (None, [1.0] * 6), (305, [1.0, 2.0]), (306, [])]
    got = multi_index.nearest(
        vectors_of(spark, rows), every=10, centroids=4, share=1.0, block=25, query_block=3
    ).collect()
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append(r.vec_id)
    assert dict(found) == brute_nearest([r for r in rows if r[0] != 305], 10, 5)


@pytest.mark.parametrize("several", [False, True])
def test_an_id_with_a_third_of_the_rows_takes_one_place(spark, several):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=6).astype("float32").tolist()) for i in range(120)]
    near = np.array(rows[10][1])
    for _ in range(60):
        v = near + rng.normal(size=6) * 0.01 if several else near * 2
        rows.append((7, v.astype("float32").tolist()))
    got = multi_index.nearest(
        vectors_of(spark, rows), every=10, centroids=1, share=1.0, block=1000, query_block=3
    ).collect()
    for q in range(0, 120, 10):
        scores = defaultdict(lambda: -2.0)
        x = np.array(rows[q][1])
        for i, v in rows:
            if i != q:
                y = np.array(v)
                scores[i] = max(scores[i], float(x @ y / np.sqrt((x @ x) * (y @ y))))
        want = sorted(scores, key=lambda i: (-round(scores[i], 12), i))[:5]
        found = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.vec_id for r in found] == want
        assert np.allclose([r.score for r in found], [scores[i] for i in want])


def test_few_vectors_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [0.0, 2.0])]
    got = multi_index.nearest(vectors_of(spark, rows)).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [
        (0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)
    ]
    assert multi_index.nearest(vectors_of(spark, [])).count() == 0
    assert multi_index.nearest(vectors_of(spark, [(0, None)])).count() == 0


def test_recall_of_the_query(spark, folder):
    folder = folder.replace("0.001", "0.01")
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    want = brute_nearest([(r.vec_id, list(r.embedding)) for r in table], 50, 5)
    got = defaultdict(set)
    for r in queries.op2_multi_index(spark, folder).collect():
        got[r.query_id].add(r.vec_id)
    hits = sum(len(got[q] & set(ids)) for q, ids in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_clustered_vectors_need_a_small_share(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(40, 16))
    rows = [(i, (centers[i % 40] + 0.1 * rng.normal(size=16)).tolist()) for i in range(2000)]
    shares = []
    measure = multi_index.needed_share
    monkeypatch.setattr(
        multi_index, "needed_share", lambda *a: shares.append(measure(*a)) or shares[-1]
    )
    want = brute_nearest(rows, 50, 5)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in multi_index.nearest(df, query_block=7, block=300).collect():
        got[r.query_id].add(r.vec_id)
    assert sum(len(got[q] & set(ids)) for q, ids in want.items()) >= 0.9 * 5 * len(want)
    assert shares[-1] < 0.2
    assert multi_index.centroids_for(10) == 32 and multi_index.centroids_for(10**6) == 141
    assert multi_index.centroids_for(10**12) == 512


def test_more_centroids_than_a_word_has_bits(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = multi_index.nearest(df, every=20, centroids=150, share=1.0, block=9, query_block=4)
    found = defaultdict(list)
    for r in got.orderBy("query_id", "rank").collect():
        found[r.query_id].append(r.vec_id)
    assert dict(found) == brute_nearest(rows, 20, 5)


def test_traversal_goes_by_summed_distance():
    rng = np.random.default_rng(5)
    a, b, counts = rng.random(7), rng.random(9), rng.integers(0, 5, (7, 9))
    bits = multi_index.probed(a, b, counts, 40)
    order = sorted(((a[i] + b[j], i, j) for i in range(7) for j in range(9)))
    want, found = set(), 0
    for _, i, j in order:
        if found >= 40:
            break
        if counts[i, j]:
            want.add((i, j))
            found += counts[i, j]
    assert {(i, j) for i in range(7) for j in range(9) if bits[i] >> j & 1} == want


# Quality.


def test_lookup_tables_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert (0, 1) in {(i, j) for i, j, _ in model.pairs}
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    one = model.raw(x[:1])[0]
    at = [int(b[0]) for b in model.bins(x[:1])]
    by_hand = model.base + sum(t[a] for t, a in zip(model.tables, at))
    assert one == pytest.approx(by_hand + sum(t[at[i], at[j]] for i, j, t in model.pairs))


def test_held_out_accuracy_and_folds(spark, folder):
    folder = folder.replace("0.001", "0.1")
    got = queries.op5_quality(spark, folder).toPandas()
    fold = got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)
    assert (fold == got.held_out).all() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    labels = pd.read_parquet(f"{folder}/labels.parquet")
    both = got[got.held_out].merge(labels, on="doc_id")
    assert (both.predicted == both.quality).mean() > 0.95


def test_quality_of_odd_tables(spark, docs_of):
    docs = docs_of([(1, None), (1, None), (2, ""), (None, "a b"), (3, "x " * 5000)])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    none = quality.train(docs, labels)
    rows = quality.score(docs, none).collect()
    assert len(rows) == 5 and {r.score for r in rows} == {1.0}
    assert quality.accepted(docs, none).columns == docs.columns
    some = spark.createDataFrame([(1, 0), (1, 0), (2, None), (None, 1), (3, 7)], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, quality.train(docs, some)).collect()} <= {0.0, 1.0}
    assert quality.score(docs_of([]), none).count() == 0


# Sharding.


@pytest.mark.parametrize("limit", [3000, 20_000, 1 << 30])
def test_shards_equal_sql(spark, folder, limit):
    path = f"{folder}/documents.parquet"
    big = spark.read.parquet(path).where(f"length(text) < {limit // 2}")
    got = sharding.shard(big, limit).toPandas()
    text = sql.sharding(limit).replace(
        "FROM documents", f"FROM (SELECT * FROM '{path}' WHERE length(text) < {limit // 2})"
    )
    want = duckdb.sql(text).df()
    order = ["doc_id"]
    pd.testing.assert_frame_equal(
        got.sort_values(order).reset_index(drop=True)[sorted(got)],
        want.sort_values(order).reset_index(drop=True)[sorted(want)],
        check_dtype=False,
    )
    assert got.groupby("shard").n_bytes.sum().max() <= limit


def test_shards_of_one_key_get_pages(docs_of):
    rng = random.Random(3)
    rows = [(7, "x" * rng.choice([0, 10, 40, 90, 130])) for _ in range(300)]
    rows += [(None, "ab"), (None, None), *((i, "y" * 20) for i in range(100, 160))]
    got = sharding.shard(docs_of(rows), 100).toPandas()
    assert len(got) == len(rows)
    pages = got.groupby(["shard", "page"]).n_bytes.agg(["sum", "count"])
    assert ((pages["sum"] <= 100) | (pages["count"] == 1)).all()
    assert len(pages) < 300
    assert sharding.shard(docs_of([]), 100).count() == 0


def test_shards_run_without_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for df in (queries.op7_sharding(spark, folder), sharding.placed(docs, 50_000)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def test_documents_lie_whole_in_their_shards(spark, folder, tmp_path):
    path = str(tmp_path / "shards")
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr(
        "*", "'s' AS shard", "1 AS page", "2 AS hash", "3 AS bytes", "4 AS entry", "5 AS `row`"
    )
    docs = docs.unionAll(docs.where("doc_id % 7 = 0"))
    limit = 20_000
    sharding.write_shards(docs, path, limit)
    rows = sharding.read_shards(spark, path, docs.schema)
    assert sorted(map(repr, rows.select("row.*").collect())) == sorted(map(repr, docs.collect()))
    seen = rows.selectExpr("shard", "page", "octet_length(row.text) AS n", "input_file_name() AS f")
    for (shard, page), own in seen.toPandas().groupby(["shard", "page"]):
        assert f"shard={shard}/page={page}/" in own.f.iloc[0]
        assert own.f.nunique() == 1 and (own.n.sum() <= limit or len(own) == 1)
    shards = sorted({r.shard for r in rows.select("shard").distinct().collect()})
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:]))
    assert len({len(x) for x in shards}) > 1  # only oversized buckets split on


def test_one_shard_and_no_shard(spark, docs_of, tmp_path):
    one, none = str(tmp_path / "one"), str(tmp_path / "none")
    docs = docs_of([(1, "a"), (None, None), (1, "")])
    sharding.write_shards(docs, one)
    rows = sharding.read_shards(spark, one, docs.schema).collect()
    assert len(rows) == 3 and {(r.shard, r.page) for r in rows} == {("", 0)}
    sharding.write_shards(docs_of([]), none)
    assert sharding.read_shards(spark, none, docs.schema).count() == 0


# Archive.


def test_records_come_back_byte_by_byte(spark, tmp_path):
    rows = [
        (1, "http://a.example/", "same é"), (2, None, "same é"), (9, "u\r\nX: y", "same é"),
        (3, "http://b.example/", ""), (4, "http://b.example/", None), (5, "http://c.example/", "x"),
        (None, "n", "x"), (6, "d", "only"), (6, "d", "only"), (None, "m", "nameless"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.selectExpr("*", "'q' AS payload", "1 AS address").repartition(3)
    archive.write_archive(pages, str(tmp_path / "a"))
    got = archive.read_records(spark, str(tmp_path / "a")).collect()
    assert len(got) == len(rows)
    payloads = defaultdict(list)
    for i, _, html in rows:
        payloads[html or ""].append(i)
    for r in got:
        text = bytes(r.payload).decode()
        digest = base64.b32encode(hashlib.sha1(bytes(r.payload)).digest()).decode()
        assert r.payload_digest == digest
        owner = max((i for i in payloads[text] if i is not None), default=None)
        if r.record_type == "revisit":
            assert r.refers_to == owner
        else:
            assert r.refers_to is None and r.page_id == owner
        header, body = bytes(r.record).split(b"\r\n\r\n", 1)
        assert header + b"\r\n\r\n" == r.header.encode()
        length = int(header.rsplit(b": ", 1)[1])
        assert body == (bytes(r.payload) if length else b"") + b"\r\n\r\n"
        assert header.count(b"\r\nX:") == 0
    responses = [r for r in got if r.record_type == "response"]
    assert len(responses) == len(payloads)
    assert spark.read.parquet(str(tmp_path / "a" / "payloads")).count() == len(payloads)


def test_a_damaged_payload_fails(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string")
    archive.write_archive(pages, str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a" / "payloads"))
    stored.selectExpr("address", "size", "CAST('abd' AS binary) AS payload").write.parquet(
        str(tmp_path / "b" / "payloads")
    )
    spark.read.parquet(str(tmp_path / "a" / "headers")).write.parquet(str(tmp_path / "b" / "headers"))
    with pytest.raises(Exception, match="does not match"):
        archive.summary(archive.read_records(spark, str(tmp_path / "b"))).collect()


def test_small_payloads_may_all_be_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "a"), (2, "v", "a")], "page_id long, url string, html string")
    archive.write_archive(pages, str(tmp_path / "a"), least=2)
    got = archive.read_records(spark, str(tmp_path / "a")).collect()
    assert [r.record_type for r in got] == ["response", "response"]


def test_empty_archive(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    archive.write_archive(pages, str(tmp_path / "a"))
    assert archive.read_records(spark, str(tmp_path / "a")).count() == 0


# Pipeline.


def test_pipeline_keeps_clean_documents_and_packs_them(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, seen, folder)
        assert after.columns == docs.columns, name
        assert set(r.doc_id for r in after.select("doc_id").collect()) <= set(
            r.doc_id for r in seen.select("doc_id").collect()
        )
        seen = after
    packed = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {
        r.doc_id for r in seen.select("doc_id").collect()
    }


def test_rebuilt_records_are_checked_and_other_columns_left_out(spark, tmp_path):
    rows = [(1, "http://a.example/é", "same é"), (2, None, "same é"), (3, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' AS address", "2 AS size", "'y' AS payload", "3 AS n", "'z' AS record", "4 AS header"
    )
    archive.write_archive(pages, str(tmp_path / "a"))
    records = archive.read_records(spark, str(tmp_path / "a"))
    got = {r.page_id: r for r in archive.summary(records).collect()}
    assert [got[i].payload_bytes for i in (1, 2, 3)] == [7, 7, 0]
    assert [(got[i].record_type, got[i].refers_to) for i in (1, 2)] == [("revisit", 2), ("response", None)]
    plan = archive.summary(records)._jdf.queryExecution().optimizedPlan().toString()
    assert "AS record#" in plan  # the record is rebuilt, not pruned
    changed = records.selectExpr(
        "* EXCEPT (record)", "encode(replace(decode(record, 'UTF-8'), 'same', 'some'), 'UTF-8') AS record"
    )
    with pytest.raises(Exception, match="record can't be rebuilt"):
        archive.summary(changed).collect()
