"""The pipeline over a small folder of tables, each stage held against brute force on what it was given."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from test_operators import BYTE_BPE, jaccard_components, leaks, sentence

import __spark_entry__ as entry
import corpus_pipeline
from docflow.llm import bpe, queries, toxicity
from docflow.llm.common import prepare


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    rows, labels = [], []
    for i in range(160):
        words = sentence(rng, 60).split()
        if i % 5 == 0:
            for k in range(6):
                words[7 * k] = "scoundrel"
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 5 == 0)))
    item = sentence(rng, 25)
    rows += [(200 + i, rows[i + 1][1]) for i in range(0, 40, 10)]
    rows += [(300, f"before {item} behind"), (301, "mail me at a@b.co or +1 (456) 555-2186"), (302, ""), (303, None), (1, rows[1][1])]
    path = str(tmp_path_factory.mktemp("tables"))
    docs = [(d, t, "en", "src", None if t is None else len(t), "kept") for d, t in rows]
    prepare(spark).createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, extra string").write.parquet(
        f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_take_effect_and_keep_the_columns(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(toxicity, "MIN_TEXTS", 2)
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(docs.collect())
    before = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    clean, single, apart, masked, tokens = ([tuple(r) for r in rows] for rows in seen)
    gone = {d for d, _ in before} - {r[0] for r in clean}
    assert {d for d in range(0, 160, 5)} <= gone and len(gone) <= 34
    want = jaccard_components([(r[0], r[1] or "") for r in clean])
    assert Counter(r[0] for r in single) == Counter(d for d, (_, c) in want.items() if c == d)
    bad = {d for d, *_, hit in leaks([(r[0], r[1]) for r in single], [(0, before[[d for d, _ in before].index(300)][1][7:-7])]) if hit}
    assert bad == {300} and {r[0] for r in apart} == {r[0] for r in single} - bad
    texts = {r[0]: (r[1], r[4]) for r in masked}
    assert texts[301] == ("mail me at [email] or [phone]", 29) and texts[303] == (None, None) and len(masked) == len(apart)
    lib = bpe.tokenizer(BYTE_BPE)
    for doc, n, ids_sha, text_sha in tokens:
        ids = lib.encode(texts[doc][0] or "", add_special_tokens=False).ids
        assert (n, ids_sha) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert text_sha == hashlib.sha256((texts[doc][0] or "").encode()).hexdigest()
    assert len(tokens) == len(masked)


def test_rows_that_share_an_id_are_judged_alone(spark, folder, tmp_path):
    rng = random.Random(4)
    item, copied = spark.read.parquet(f"{folder}/benchmark.parquet").first().text, sentence(rng, 50)
    clean = [sentence(rng, 50) for _ in range(6)]
    rows = [(7, f"{item} {sentence(rng, 40)}"), (7, clean[0]), (7, clean[1]), (None, f"{sentence(rng, 40)} {item}"), (None, clean[2]), (None, clean[3]), (8, clean[4]),
            (8, clean[5]), (9, copied), (4, copied), (4, ""), (4, ""), (None, copied)]
    docs = prepare(spark).createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, row_key string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    apart = corpus_pipeline.drop_leaks(spark, docs, folder)
    assert apart.schema == docs.schema
    assert Counter(map(tuple, apart.collect())) == Counter((*r, "k") for r in rows if item not in r[1])
    single = corpus_pipeline.drop_copies(spark, docs, folder)
    assert single.schema == docs.schema
    assert Counter(map(tuple, single.collect())) == Counter((*r, "k") for r in rows if r not in ((9, copied), (None, copied)))


def test_run_is_the_stages_and_takes_empty_tables(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_are_registered():
    names = set(entry.queries())
    assert set(queries.QUERIES) <= names and "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.ORACLES) <= set(queries.QUERIES) and set(queries.ORACLES) <= set(entry.oracle_sql())


def test_workers_give_memory_back(spark):
    """Python workers outlive a stage: what they keep of it is missing in the next one."""
    import pyarrow as pa

    from docflow.llm import toxicity

    corpus_pipeline.mask_personal(spark, spark.createDataFrame([(1, "x", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long"), "")

    def seen(batches):
        import os

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"name": [k for k in ("MALLOC_TRIM_THRESHOLD_", "MALLOC_MMAP_THRESHOLD_") if k in os.environ]})

    assert spark.range(1).mapInArrow(seen, "name string").count() == 2
    assert toxicity.PIECE <= 1 << 20


def test_the_driver_gives_memory_back_after_training(spark, folder, monkeypatch):
    """What training frees lies between small objects that stay; the stages after it need the driver's memory."""
    import os
    from pathlib import Path

    def resident():
        return (int(Path("/proc/self/statm").read_text().split()[1]) * os.sysconf("SC_PAGE_SIZE")) >> 20

    stays, seen = [], []

    def train(texts, y, weight):
        bags = [np.ones(1000) for _ in range(30_000)]
        stays.append(np.ones(1000))
        seen.append(resident())
        bags.clear()
        return np.zeros(1 << toxicity.BITS, np.float32), 0.0

    monkeypatch.setattr(toxicity, "train", train)
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    assert toxicity.fit(docs, labels).trained
    assert resident() < seen[0] - 150
