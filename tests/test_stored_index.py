"""The stored index against the plain one and against brute force: shards, bounds, changes, removals, roll-ups."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_search import TEXTS, brute, parsed

from docflow.operators import search as s, stored_index as si
from docflow.sources import batches

COMMON = "the of and to in is it on as be".split()
RARE = [f"w{i}" for i in range(300)]


def corpus(n, seed=1):
    rng = random.Random(seed)
    return [" ".join(rng.choices(COMMON, k=rng.randint(0, 40)) + rng.choices(RARE, k=rng.randint(0, 4))) for _ in range(n)]


def versions(spark, rows):
    """Rows (parsed_id, file_name, text, status) as parsed documents; the id is also the time."""
    df = spark.createDataFrame([(*r, 5 * r[0]) for r in rows],
                               "parsed_id BIGINT, file_name STRING, extracted_text STRING, processing_status STRING, file_size BIGINT")
    time = F.timestamp_seconds("parsed_id").cast("timestamp_ntz")
    return df.withColumns({"file_url": F.col("file_name"), "last_modified": time, "parse_timestamp": time})


def hits(index, query, k=10, where=None):
    return [(r.parsed_id, r.score) for r in sorted(si.search(index, query, k, where).collect(), key=lambda r: (-r.score, r.parsed_id))]


def test_search_is_brute_force(spark, tmp_path):
    path = str(tmp_path / "i")
    si.add(spark, path, parsed(spark, errors={3}), 0, shards=3)
    index = si.open_index(spark, path)
    assert hits(index, "rare common") == brute(TEXTS, "rare common", [0, 1, 2, 4])
    assert hits(index, "nothing of común words", 2) == brute(TEXTS, "nothing of común words", [0, 1, 2, 4])[:2]
    want = dict(brute(TEXTS, "rare common", [0, 1, 2, 4]))
    assert dict(hits(index, "rare common", where=F.col("file_size") < 30)) == {i: want[i] for i in (0, 1)}
    assert hits(index, "rare common", where=F.col("file_size") < 0) == []
    assert hits(index, "absent") == [] and hits(index, "?!") == []


def test_batch_equals_the_plain_search(spark, tmp_path, monkeypatch):
    texts = corpus(600)
    docs = parsed(spark, texts)
    monkeypatch.setattr(si, "BLOCK", 16)
    si.add(spark, str(tmp_path / "i"), docs, 0, shards=4)
    index = si.open_index(spark, str(tmp_path / "i"))
    queries = spark.createDataFrame([(i, q) for i, q in enumerate(corpus(40, seed=2) + ["", "w1 w2 w3", "the"])], "query_id BIGINT, query STRING")
    want = s.search_batch(s.build_index(docs), queries, 7).collect()
    for rows, listed in ((200_000, 1000), (50, 0)):
        monkeypatch.setattr(si, "QUERY_ROWS", rows)
        monkeypatch.setattr(si, "LISTED_TERMS", listed)
        assert sorted(map(tuple, si.search_batch(index, queries, 7).collect())) == sorted((r.query_id, r.parsed_id, r.score, r.rank) for r in want)
    wanted = queries.select("query_id", F.explode(F.array_distinct(s.tokens(F.col("query")))).alias("term"))
    assert si.rank_in_shards(index, wanted, 7).count() <= 7 * 43 * 4  # rows that the ranking shuffles


def table_of(lists):
    rows = [{"kind": 0, "low": 0, "term": t, "n": len(p), "most_tf": max(x[1] for x in p), "least_len": min(x[2] for x in p),
             "ids": [x[0] for x in p], "tfs": [x[1] for x in p], "lens": [x[2] for x in p]} for t, p in lists]
    kinds = [("kind", pa.int32()), ("low", pa.int64()), ("term", pa.string()), ("n", pa.int32()), ("most_tf", pa.int32()),
             ("least_len", pa.int32()), ("ids", pa.list_(pa.int64())), ("tfs", pa.list_(pa.int32())), ("lens", pa.list_(pa.int32()))]
    return pa.Table.from_pylist(rows, schema=pa.schema(kinds))


@pytest.mark.parametrize("seed", range(20))
def test_bounds_lose_nothing_and_skip_much(seed):
    rng = np.random.default_rng(seed)
    lens = rng.integers(5, 400, 4000)
    lists, scores, idfs = [], np.zeros(4000), {}
    for t in range(6):
        ids = np.flatnonzero(rng.random(4000) < (0.9, 0.5, 0.3, 0.05, 0.01, 0.002)[t])
        tfs = np.minimum(rng.geometric(0.5, len(ids)), 20)
        idfs[f"t{t}"] = float(np.log(1 + 4000 / (len(ids) + 0.5)))
        scores[ids] += si._bound(idfs[f"t{t}"], tfs, lens[ids], 200.0)
        for at in range(0, len(ids), 32):
            part = slice(at, at + 32)
            lists.append((f"t{t}", list(zip(ids[part].tolist(), tfs[part].tolist(), lens[ids][part].tolist()))))
    shard = si.Shard(table_of(lists), 200.0)
    ids, got = shard.best(idfs, 10)
    want = np.lexsort((np.arange(4000), -np.round(scores, 6)))[:10]
    assert ids.tolist() == want.tolist() and np.allclose(got, np.round(scores, 6)[want])
    assert shard.scored < 0.7 * len(shard.ids)


def test_changed_and_removed_documents(spark, tmp_path):
    path, rng, texts, state = str(tmp_path / "i"), random.Random(3), corpus(400, seed=5), {}
    number, step = 0, 0
    for batch in range(7):
        rows = []
        for _ in range(40 if batch else 120):
            name, status = f"f{rng.randint(0, 150)}", rng.choices(["SUCCESS", "REMOVED", "ERROR"], [8, 3, 1])[0]
            number += 1
            rows.append((number, name, rng.choice(texts) if status == "SUCCESS" else None, status))
            if status == "SUCCESS":
                state[name] = (number, rows[-1][2])
            elif status == "REMOVED":
                state.pop(name, None)
        assert si.add(spark, path, versions(spark, rows), batch, shards=3)
        assert not si.add(spark, path, versions(spark, rows), batch)
        if batch in (2, 4):
            step += si.roll_up(spark, path, fan=2)
    live = dict(state.values())
    by_id = [live.get(i, "") for i in range(number + 1)]

    def check():
        index = si.open_index(spark, path)
        assert sorted(r.parsed_id for r in index.docs.collect()) == sorted(live)
        corpus_row = index.corpus.first()
        lengths = [len(t.split()) for t in live.values()]
        assert corpus_row.n_docs == len(live) and corpus_row.avg_len == pytest.approx(sum(lengths) / len(live))
        for query in ("the w1 w2 w3 w4 w5 w6 w7", "is it w9 w10"):
            assert hits(index, query, 1000) == brute(by_id, query, live)
            assert hits(index, query, 3) == brute(by_id, query, live)[:3]

    assert step
    check()
    si.roll_up(spark, path, fan=2)
    check()
    folders = set(os.listdir(path))
    si.compact(spark, path)
    assert folders < set(os.listdir(path))  # those before stay until they are asked to go
    check()
    batches.vacuum(spark, path)
    assert len(os.listdir(path)) == 2
    check()
    si.add(spark, path, versions(spark, [(number + 1, "f3", "the w1", "SUCCESS"), (number + 2, "f3", None, "REMOVED")]), 7)
    live = {i: t for n, (i, t) in state.items() if n != "f3"}
    check()


def test_a_document_sent_again_under_its_id(spark, tmp_path):
    path = str(tmp_path / "i")
    for batch, text in enumerate(["one two", "one three", "one four"]):
        si.add(spark, path, versions(spark, [(1, "a", text, "SUCCESS"), (2 + batch, f"b{batch}", "one", "SUCCESS")]), batch, shards=2)
    for _ in range(3):
        index = si.open_index(spark, path)
        assert [i for i, _ in hits(index, "two three")] == []
        assert [i for i, _ in hits(index, "four")] == [1]
        assert index.docs.count() == index.corpus.first().n_docs == 4
        if _ == 0:
            found = batches.live(spark, path)
            batches.combine(spark, path, found[1:], si._merge(spark, path, False))
        else:
            si.compact(spark, path)


def test_empty_index(spark, tmp_path):
    path = str(tmp_path / "i")
    assert si.search_batch(si.open_index(spark, path), spark.createDataFrame([(1, "x")], "query_id BIGINT, query STRING")).collect() == []
    assert hits(si.open_index(spark, path), "x") == []
    si.add(spark, path, parsed(spark).limit(0), 0)
    index = si.open_index(spark, path)
    assert hits(index, "rare") == [] and index.docs.count() == 0
    with pytest.raises(ValueError):
        si.add(spark, path, parsed(spark), 1, shards=5)
    si.add(spark, path, parsed(spark), 1)
    assert hits(si.open_index(spark, path), "rare common") == brute(TEXTS, "rare common", range(5))
