"""Search against brute force."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docflow.operators import search as s

TEXTS = ["rare common common", "common words here", "Nothing; of the KIND, común", "", "common rare rare rare rare rare rare"]


def parsed(spark, texts=TEXTS, errors=()):
    rows = [(i, f"d{i}.txt", t, "ERROR" if i in errors else "SUCCESS", len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "parsed_id BIGINT, file_name STRING, extracted_text STRING, processing_status STRING, file_size BIGINT")
    time = F.lit("2024-01-01").cast("timestamp_ntz")
    return df.withColumns({"file_url": F.col("file_name"), "last_modified": time, "parse_timestamp": time})


def brute(texts, query, ids):
    docs = {i: [w for w in re.split(r"[\W_]+", texts[i].lower()) if w] for i in ids}
    avg = sum(map(len, docs.values())) / len(docs)
    out = {}
    for i, words in docs.items():
        score = 0.0
        for term in set(query.lower().split()):
            df = sum(term in d for d in docs.values())
            tf = words.count(term)
            if tf:
                idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / avg))
        if score:
            out[i] = round(score, 6)
    return sorted(out.items(), key=lambda p: (-p[1], p[0]))


def test_bm25(spark):
    got = s.search(s.build_index(parsed(spark)), "rare common", 10).collect()
    want = brute(TEXTS, "rare common", range(len(TEXTS)))
    assert sorted(((r.parsed_id, r.score) for r in got), key=lambda p: (-p[1], p[0])) == want
    assert want[0][0] == 4


def test_error_documents_are_never_returned(spark):
    got = s.search(s.build_index(parsed(spark, errors={4})), "rare common", 10).collect()
    assert {r.parsed_id for r in got} == {0, 1}


def test_attribute_filter_keeps_corpus_figures(spark):
    index = s.build_index(parsed(spark))
    got = s.search(index, "rare common", 10, where=F.col("file_size") < 30).collect()
    want = dict(brute(TEXTS, "rare common", range(len(TEXTS))))
    assert {r.parsed_id: r.score for r in got} == {i: want[i] for i in (0, 1)}


def test_query_terms():
    assert s.query_terms("Naïve_COÛT, 3x; naïve") == ["3x", "coût", "naïve"]


def test_batch_with_and_without_broadcast(spark, tables, monkeypatch):
    index = s.build_index(tables.parsed)
    queries = tables.table("benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    a = s.search_batch(index, queries, 5).collect()
    monkeypatch.setattr(s, "BROADCAST_ROWS", 0)
    b = s.search_batch(index, queries, 5).collect()
    assert a and sorted(a) == sorted(b)


def test_batch_equals_single(spark, tables):
    index = s.build_index(tables.parsed)
    queries = spark.createDataFrame([(1, "the reresh"), (2, "ononedth worthless")], "query_id BIGINT, query STRING")
    batch = s.search_batch(index, queries, 7).collect()
    for qid, text in ((1, "the reresh"), (2, "ononedth worthless")):
        single = s.search(index, text, 7).collect()
        assert sorted((r.parsed_id, r.score) for r in batch if r.query_id == qid) == sorted((r.parsed_id, r.score) for r in single)


def vectors(spark, n=200, dims=8, seed=3):
    rng = random.Random(seed)
    rows = [(i, [float(rng.randint(-3, 3)) for _ in range(dims)]) for i in range(n)]
    rows[5] = (5, [0.0] * dims)
    return rows, spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>").repartition(5)


def brute_dense(rows, query, k, skip=None):
    q = np.array(query) / (np.linalg.norm(query) or 1)
    scored = []
    for i, v in rows:
        norm = np.linalg.norm(v)
        scored.append((i, round(float(np.dot(np.array(v) / norm, q)), 6) + 0.0 if norm else 0.0))
    return sorted((p for p in scored if p[0] != skip), key=lambda p: (-p[1], p[0]))[:k]


@pytest.mark.parametrize("block", [8_000_000, 8 * 3])
def test_dense_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(s, "BLOCK_NUMBERS", block)
    rows, df = vectors(spark)
    queries = df.filter("vec_id < 10").select(F.col("vec_id").alias("query_id"), "embedding")
    got = {}
    for r in s.search_dense(df, queries, 6).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for qid in range(10):
        mine = [(i, sc) for _, i, sc in sorted(got[qid])]
        want = brute_dense(rows, rows[qid][1], 6)
        assert [i for i, _ in mine] == [i for i, _ in want]
        assert np.allclose([sc for _, sc in mine], [sc for _, sc in want], atol=1e-6)


def clustered(n=3000, groups=12, dims=16, seed=0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, dims))
    return np.round(middles[rng.integers(0, groups, n)] + rng.normal(size=(n, dims)) * 0.1, 4)


def test_dense_in_cells_is_exact_with_three_queries_a_block(spark, monkeypatch):
    monkeypatch.setattr(s, "BLOCK_NUMBERS", 3 * 16)
    monkeypatch.setattr(s, "TASK_NUMBERS", 16 * 200)
    monkeypatch.setattr(s, "PACK_ROWS", 32)
    m = clustered()
    m[7] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    df = spark.createDataFrame(rows + [(9999, None)], "vec_id BIGINT, embedding ARRAY<DOUBLE>").repartition(6)
    queries = df.filter("vec_id < 12").select(F.col("vec_id").alias("query_id"), "embedding")
    got = {}
    for r in s.search_dense(df, queries, 5, exclude_self=True).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for qid in range(12):
        want = brute_dense(rows, rows[qid][1], 5, skip=qid)
        assert [(i, pytest.approx(sc, abs=1e-6)) for i, sc in want] == [(i, sc) for _, i, sc in sorted(got[qid])]


def test_packs_that_cannot_matter_are_passed_over():
    m = s._unit(clustered(2000))
    centre, away = m[0], s._angles(m, m[:1])[:, 0]
    order = np.argsort(away)
    packs = [(away[p[0]], away[p[-1]], p, m[p]) for p in np.array_split(order, 60)]
    q = m[:40]
    found, compared = s.best_of_packs(packs, q, [None] * 40, np.full(40, s.NOTHING), centre, 10)
    assert compared < 0.6 * len(m) * len(q)
    for j in range(40):
        scores = np.round(m @ q[j], 6)
        assert found[j][0].tolist() == np.lexsort((np.arange(len(m)), -scores))[:10].tolist()


def test_similar_leaves_itself_out(spark):
    rows, df = vectors(spark)
    got = s.similar_to(df, spark.createDataFrame([(7,)], "vec_id BIGINT"), 5).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [i for i, _ in brute_dense(rows, rows[7][1], 5, skip=7)]


def test_no_queries_no_hits(spark):
    _, df = vectors(spark)
    empty = spark.createDataFrame([], "query_id BIGINT, embedding ARRAY<FLOAT>")
    assert s.search_dense(df, empty, 5).count() == 0


def test_default_embedder_finds_the_copy(spark):
    texts = ["red green blue", "one two three four", "red green blue", "alpha beta gamma"]
    vec = s.embed(parsed(spark, texts), "extracted_text").select(F.col("parsed_id").alias("vec_id"), "embedding")
    best = s.similar_to(vec, spark.createDataFrame([(0,)], "vec_id BIGINT"), 1).first()
    assert (best.vec_id, best.score) == (2, 1.0)


def test_fusion(spark):
    schema = "query_id BIGINT, parsed_id BIGINT, rank INT"
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], schema)
    b = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], schema)
    got = s.fuse(a, b, 2).orderBy("rank").collect()
    assert [(r.parsed_id, r.score) for r in got] == [(11, round(1 / 61 + 1 / 62, 9)), (10, round(1 / 61, 9))]


def test_index_in_batches_equals_whole_index(spark, tables, tmp_path):
    docs = tables.parsed
    for i, part in enumerate(docs.randomSplit([1.0, 1.0, 1.0], seed=1)):
        s.refresh_index(str(tmp_path / "i"), part, i)
    a = s.load_index(spark, str(tmp_path / "i"))
    b = s.build_index(docs)
    assert a.postings.exceptAll(b.postings).count() == 0 and b.postings.exceptAll(a.postings).count() == 0
    x, y = a.corpus.first(), b.corpus.first()
    assert x.n_docs == y.n_docs and abs(x.avg_len - y.avg_len) < 1e-9
    s.refresh_index(str(tmp_path / "i"), docs.limit(0), 3)  # nothing new changes nothing
    assert s.load_index(spark, str(tmp_path / "i")).postings.count() == b.postings.count()
