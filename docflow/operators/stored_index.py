"""A stored search index that follows new, changed and removed documents, and top-k search over it with score bounds.

A document is known by a key (its file name) and lies, in all its versions, in the shard that the key's hash names. A batch
writes the postings of its documents, packed by (shard, term) in blocks of at most ``BLOCK`` sorted ids that carry their largest
term frequency and least document length, and the ids of the stored versions that it replaces or removes. Those ids hide
postings of earlier batches until a roll-up leaves them out, so results are the same before and after it (``sources.batches``
says how batches and roll-ups become visible). A batch reads the stored keys of its own shards only.

A search reads the blocks of its terms, and a shard ranks all queries by itself: terms in order of their largest possible
contribution, new documents only while they could still reach the k best, blocks only if their bound or a document that
is already in question asks for it. ``k`` rows per query and shard leave the task, whatever the terms match. Document
frequencies and lengths are those of the visible documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docflow.operators.search import (
    ATTRIBUTES, B, BROADCAST_ROWS, K1, build_index, query_terms, search_join, tokens, top_per_query,
)
from docflow.sources import batches

SHARDS = 16
SHARD_ROWS = 50_000
BLOCK = 512
# Distinct terms of a search that go to the scan as a list; more are joined.
LISTED_TERMS = 1_000
# (query, term) rows that a shard ranks in one task.
QUERY_ROWS = 200_000
# Scores are compared as they are rounded.
MARGIN = 2e-6

POSTINGS = "shard INT, term STRING, n INT, most_tf INT, least_len INT, ids ARRAY<BIGINT>, tfs ARRAY<INT>, lens ARRAY<INT>"
DOCS = ("parsed_id BIGINT, doc_len INT, file_name STRING, file_url STRING, file_size BIGINT, last_modified TIMESTAMP_NTZ, "
        "parse_timestamp TIMESTAMP_NTZ, key STRING, shard INT")
DEAD = "shard INT, parsed_id BIGINT, doc_len BIGINT"
STATS = "n_docs BIGINT, sum_len BIGINT, shards INT"


@dataclass(frozen=True)
class StoredIndex:
    """What was published at ``path`` when it was opened."""

    spark: SparkSession
    path: str
    intervals: tuple[batches.Interval, ...]

    def table(self, name: str, schema: str | None = None, low: bool = False) -> DataFrame:
        return batches.read_from(self.spark, self.path, list(self.intervals), name, schema, low)

    @property
    def dead(self) -> DataFrame:
        return self.table("dead", DEAD, low=True)

    @property
    def docs(self) -> DataFrame:
        """The visible documents: shard, key, parsed_id, doc_len and attributes."""
        return _visible(self.table("docs", None if self.intervals else DOCS, low=True), self.dead, self.changed).drop("low")

    @property
    def changed(self) -> bool:
        """Whether a batch that was not merged with all before it hides documents."""
        return any("dead" in x.tables for x in self.intervals)

    @property
    def corpus(self) -> DataFrame:
        """One row: number of visible documents and their average length."""
        stats = self.table("stats", STATS).agg(F.sum("n_docs").alias("n"), F.sum("sum_len").alias("s"))
        gone = self.dead.agg(F.count("*").alias("n"), F.coalesce(F.sum("doc_len"), F.lit(0)).alias("s"))
        counts = stats.select(F.struct("n", "s").alias("a")).withColumn("b", gone.select(F.struct("n", "s")).scalar())
        n = F.coalesce(F.col("a.n"), F.lit(0)) - F.col("b.n")
        return counts.select(n.alias("n_docs"), ((F.col("a.s") - F.col("b.s")) / n).alias("avg_len"))


def open_index(spark: SparkSession, path: str) -> StoredIndex:
    return StoredIndex(spark, path, tuple(batches.live(spark, path)))


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def _visible(rows: DataFrame, dead: DataFrame, changed: bool, how: str = "left_anti") -> DataFrame:
    """Rows (parsed_id, low) that no later batch has hidden."""
    if not changed:
        return rows
    hides = dead.select(F.col("parsed_id").alias("_id"), F.col("low").alias("_low"))
    return rows.join(hides, (F.col("parsed_id") == F.col("_id")) & (F.col("_low") > F.col("low")), how)


# ---- writing -------------------------------------------------------------------------


def _packed(rows):
    """Blocks of sorted ids from postings that come sorted by term, shard and id."""
    for batch in rows:
        if not len(batch):
            continue
        shard, ids, tfs, lens = (batch.column(c).to_numpy() for c in ("shard", "parsed_id", "tf", "doc_len"))
        code = batch.column("term").dictionary_encode().indices.to_numpy()
        new = np.concatenate([[True], (code[1:] != code[:-1]) | (shard[1:] != shard[:-1])])
        begins = np.flatnonzero(new)
        at = np.flatnonzero((np.arange(len(new)) - begins[np.cumsum(new) - 1]) % BLOCK == 0)
        ends = np.append(at, len(new))
        offsets, first = pa.array(ends, pa.int32()), pa.array(at)
        yield pa.RecordBatch.from_arrays([
            batch.column("shard").take(first), batch.column("term").take(first), pa.array(np.diff(ends), pa.int32()),
            pa.array(np.maximum.reduceat(tfs, at), pa.int32()), pa.array(np.minimum.reduceat(lens, at), pa.int32()),
            pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32())),
            pa.ListArray.from_arrays(offsets, pa.array(lens, pa.int32()))],
            ["shard", "term", "n", "most_tf", "least_len", "ids", "tfs", "lens"])


def _pack(postings: DataFrame) -> DataFrame:
    """Blocks from rows (shard, term, parsed_id, tf, doc_len), sorted by term. The postings are shuffled once, and sorted
    as a stream that any list may exceed; none is collected."""
    rows = postings.select("shard", "term", "parsed_id", F.col("tf").cast("int").alias("tf"), F.col("doc_len").cast("int").alias("doc_len"))
    return rows.repartition("shard", "term").sortWithinPartitions("term", "shard", "parsed_id").mapInArrow(_packed, POSTINGS)


def _unpack(blocks: DataFrame) -> DataFrame:
    one = F.explode(F.arrays_zip("ids", "tfs", "lens")).alias("p")
    return blocks.select("shard", "term", "low", one).select(
        "shard", "term", "low", F.col("p.ids").alias("parsed_id"), F.col("p.tfs").alias("tf"), F.col("p.lens").alias("doc_len"))


def _by_term(blocks: DataFrame) -> DataFrame:
    return blocks.repartitionByRange("term", "shard").sortWithinPartitions("term", "shard")


def _older_versions(rows: DataFrame, key: str) -> DataFrame:
    """parsed_id of the rows of a batch that are not the newest of their key: the last to be parsed, changed, by id."""
    order = F.struct("parse_timestamp", "last_modified", "parsed_id")
    several = rows.groupBy(key).agg(F.count("*").alias("n"), F.max(order).alias("newest")).filter("n > 1")
    several = several.select(F.col(key).alias("_key"), "newest")
    return rows.join(several, F.col(key) == F.col("_key")).filter(order != F.col("newest")).select("parsed_id")


def add(spark: SparkSession, path: str, parsed: DataFrame, batch_id: int, key: str = "file_name", shards: int | None = None) -> bool:
    """Index a batch of parsed documents. A document takes the place of stored ones with its key; a row with the status
    REMOVED only takes them away; other statuses are passed over. False if the batch was there already.

    ``shards`` is fixed by the first batch: one for each ``SHARD_ROWS`` of its documents, ``SHARDS`` at least.
    """
    index = open_index(spark, path)
    known = [r.shards for r in index.table("stats", STATS).select("shards").distinct().collect()]
    if shards and known and known != [shards]:
        raise ValueError(f"the index has {known[0]} shards")
    rows = parsed.filter(F.col("processing_status").isin("SUCCESS", "REMOVED") & F.col(key).isNotNull())
    shards = known[0] if known else shards or max(SHARDS, -(-rows.count() // SHARD_ROWS))
    meta = rows.select(key, "parsed_id", "parse_timestamp", "last_modified", "processing_status")
    older = _older_versions(meta, key)
    if not older.isEmpty():
        n = older.limit(BROADCAST_ROWS + 1).count()
        rows = rows.join(F.broadcast(older) if n <= BROADCAST_ROWS else older, "parsed_id", "left_anti")
    made = build_index(rows.withColumn("_key", F.col(key).cast("string")), extra=["_key"])

    def put(folder: str) -> list[str]:
        placed = made.postings.withColumn("shard", _shard(F.col("_key"), shards)).drop("_key")
        _pack(placed).write.parquet(f"{folder}/postings")
        docs = made.docs.withColumn("shard", _shard(F.col("_key"), shards)).withColumnRenamed("_key", "key")
        docs.repartition("shard").sortWithinPartitions("shard", "key").write.parquet(f"{folder}/docs")
        _stats(spark, f"{folder}/docs", shards).write.parquet(f"{folder}/stats")
        names = ["postings", "docs", "stats"]
        if index.intervals:
            gone = _replaced(index, meta.select(F.col(key).cast("string").alias("_touched")), shards)
            gone.write.parquet(f"{folder}/dead")
            if not spark.read.schema(DEAD).parquet(f"{folder}/dead").isEmpty():
                names.append("dead")
        return names

    return batches.write(spark, path, batch_id, put)


def _stats(spark: SparkSession, docs: str, shards: int) -> DataFrame:
    return spark.read.parquet(docs).agg(
        F.count("*").alias("n_docs"), F.coalesce(F.sum("doc_len"), F.lit(0)).cast("bigint").alias("sum_len"), F.lit(shards).alias("shards"))


def _replaced(index: StoredIndex, touched: DataFrame, shards: int) -> DataFrame:
    """Stored visible versions of the touched keys; only the shards of those keys are read."""
    touched = touched.distinct().withColumn("_shard", _shard(F.col("_touched"), shards))
    here = [r[0] for r in touched.select("_shard").distinct().collect()]
    stored = index.table("docs", low=True).filter(F.col("shard").isin(here))
    dead = index.dead.filter(F.col("shard").isin(here))
    met = (F.col("shard") == F.col("_shard")) & (F.col("key") == F.col("_touched"))
    return _visible(stored, dead, index.changed).join(touched, met, "left_semi").select(
        "shard", "parsed_id", F.col("doc_len").cast("bigint").alias("doc_len"))


def _merge(spark: SparkSession, path: str, first: bool):
    """Tables of several intervals as those of one: hidden documents are left out, what hides earlier ones is kept."""

    def merge(parts: list[batches.Interval], folder: str) -> list[str]:
        index = StoredIndex(spark, path, tuple(parts))
        shards = index.table("stats", STATS).first()["shards"]
        blocks = index.table("postings", POSTINGS, low=True)
        blocks = _pack(_visible(_unpack(blocks), index.dead, True)) if index.changed else _by_term(blocks.drop("low"))
        blocks.write.parquet(f"{folder}/postings")
        index.docs.repartition("shard").sortWithinPartitions("shard", "key").write.parquet(f"{folder}/docs")
        _stats(spark, f"{folder}/docs", shards).write.parquet(f"{folder}/stats")
        names = ["postings", "docs", "stats"]
        if index.changed and not first:
            inside = index.table("docs", low=True).select(F.col("parsed_id").alias("_id"), F.col("low").alias("_low"))
            met = (F.col("parsed_id") == F.col("_id")) & (F.col("low") > F.col("_low"))
            index.dead.join(inside, met, "left_anti").drop("low").write.parquet(f"{folder}/dead")
            if not spark.read.schema(DEAD).parquet(f"{folder}/dead").isEmpty():
                names.append("dead")
        return names

    return merge


def roll_up(spark: SparkSession, path: str, fan: int = 4) -> int:
    """Combine neighbouring batches of one level; see ``batches.roll_up``."""
    lowest = min((x.low for x in batches.live(spark, path)), default=0)

    def merge(parts, folder):
        return _merge(spark, path, parts[0].low == lowest)(parts, folder)

    return batches.roll_up(spark, path, merge, fan)


def compact(spark: SparkSession, path: str) -> None:
    """All batches as one, at the same path; ``batches.vacuum`` then deletes the former folders."""
    found = batches.live(spark, path)
    if len(found) > 1 or any("dead" in x.tables for x in found):
        batches.combine(spark, path, found, _merge(spark, path, True))


# ---- searching -----------------------------------------------------------------------


def _bound(idf: np.ndarray, tf: np.ndarray, length: np.ndarray, avg_len: float) -> np.ndarray:
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / avg_len))


class Shard:
    """The blocks of the wanted terms of one shard, hidden and filtered documents left out."""

    def __init__(self, blocks: pa.Table, avg_len: float):
        kind = blocks["kind"].to_numpy()
        rows = blocks.filter(pa.array(kind == 0))
        ids, tfs, lens = (pc.list_flatten(rows[c].combine_chunks()).to_numpy() for c in ("ids", "tfs", "lens"))
        sizes = rows["n"].to_numpy()
        usable = np.ones(len(ids), bool)
        hides = blocks.filter(pa.array(kind == 1))
        if len(hides):
            gone = pc.list_flatten(hides["ids"].combine_chunks()).to_numpy()
            order = np.lexsort((hides["low"].to_numpy(), gone))
            gone, lows = gone[order], hides["low"].to_numpy()[order]  # of an id's entries the last hides most
            at = np.searchsorted(gone, ids, "right") - 1
            usable &= ~((at >= 0) & (gone[at] == ids) & (lows[at] > np.repeat(rows["low"].to_numpy(), sizes)))
        if (kind >= 2).any():
            allowed = pc.list_flatten(blocks.filter(pa.array(kind == 2))["ids"].combine_chunks()).to_numpy()
            usable &= np.isin(ids, allowed)
        self.avg_len, self.scored = avg_len, 0
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(np.repeat(np.arange(len(sizes)), sizes)[usable], minlength=len(sizes)))])
        self.ids, self.tfs, self.lens = ids[usable], tfs[usable], lens[usable]
        filled = np.flatnonzero(np.diff(self.starts))
        self.weight = _bound(1.0, rows["most_tf"].to_numpy().astype(float), rows["least_len"].to_numpy(), avg_len)
        self.first, self.last = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        self.first[filled], self.last[filled] = self.ids[self.starts[filled]], self.ids[self.starts[filled + 1] - 1]
        self.blocks: dict[str, list[int]] = {}
        names = rows["term"].to_pylist()
        for i in filled.tolist():
            self.blocks.setdefault(names[i], []).append(i)

    def best(self, terms: dict[str, float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and rounded scores of the ``k`` best documents for terms and their idf."""
        there = [(idf, np.array(self.blocks[t])) for t, idf in terms.items() if t in self.blocks]
        there.sort(key=lambda x: -x[0] * self.weight[x[1]].max())
        rest = np.append(np.cumsum([idf * self.weight[b].max() for idf, b in there][::-1])[::-1], 0.0)
        ids, scores, least = np.empty(0, np.int64), np.empty(0), -np.inf
        for i, (idf, blocks) in enumerate(there):
            known = np.searchsorted(ids, self.first[blocks]) < np.searchsorted(ids, self.last[blocks], "right")
            fresh = rest[i] >= least - MARGIN  # whether a document not seen so far may still be among the best
            take = blocks[known | (fresh & (idf * self.weight[blocks] + rest[i + 1] >= least - MARGIN))]
            if len(take):
                sizes = self.starts[take + 1] - self.starts[take]
                at = np.arange(sizes.sum()) + np.repeat(self.starts[take] - np.cumsum(sizes) + sizes, sizes)
                self.scored += len(at)
                found, more = self.ids[at], _bound(idf, self.tfs[at], self.lens[at], self.avg_len)
                if not fresh:
                    place = np.minimum(np.searchsorted(ids, found), len(ids) - 1)
                    met = ids[place] == found
                    np.add.at(scores, place[met], more[met])
                else:
                    ids, where = np.unique(np.concatenate([ids, found]), return_inverse=True)
                    scores = np.bincount(where, np.concatenate([scores, more]), len(ids))
            if len(ids) >= k:
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                likely = scores + rest[i + 1] >= least - MARGIN
                ids, scores = ids[likely], scores[likely]
        scores = np.round(scores, 6)
        order = np.lexsort((ids, -scores))[:k]
        return ids[order], scores[order]


def _ranked(k: int, kind: pa.DataType):
    def rank(key, blocks: pa.Table, wanted: pa.Table) -> pa.Table:
        out = ([], [], [])
        if len(blocks) and len(wanted):
            shard = Shard(blocks, wanted["avg_len"][0].as_py())
            queries: dict = {}
            for query, term, idf in zip(wanted["query_id"].to_pylist(), wanted["term"].to_pylist(), wanted["idf"].to_pylist()):
                queries.setdefault(query, {})[term] = idf
            for query, terms in queries.items():
                ids, scores = shard.best(terms, k)
                out[0].extend([query] * len(ids))
                out[1].append(ids)
                out[2].append(scores)
        return pa.table({"query_id": pa.array(out[0], kind), "parsed_id": pa.array(np.concatenate([np.empty(0, np.int64), *out[1]])),
                         "score": pa.array(np.concatenate([np.empty(0), *out[2]]))})

    return rank


def _wanted_blocks(index: StoredIndex, terms: DataFrame) -> DataFrame:
    blocks = index.table("postings", POSTINGS, low=True)
    listed = terms.limit(LISTED_TERMS + 1).collect()
    if len(listed) <= LISTED_TERMS:
        return blocks.filter(F.col("term").isin([r.term for r in listed]))
    few = terms.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return blocks.join(F.broadcast(terms) if few else terms, "term", "left_semi")


def _frequencies(index: StoredIndex, blocks: DataFrame) -> DataFrame:
    """Visible documents of each term."""
    counts = blocks.groupBy("term").agg(F.sum("n").alias("df"))
    if not index.changed:
        return counts
    hidden = _visible(_unpack(blocks), index.dead, True, "left_semi").groupBy("term").agg(F.count("*").alias("hidden"))
    return counts.join(hidden, "term", "left").select("term", (F.col("df") - F.coalesce("hidden", F.lit(0))).alias("df"))


def rank_in_shards(index: StoredIndex, wanted: DataFrame, k: int, where: Column | None = None) -> DataFrame:
    """The ``k`` best rows (query_id, parsed_id, score) of each query in each shard; ``wanted`` has (query_id, term)."""
    shards = index.table("stats", STATS).first()
    if shards is None:
        kind = wanted.schema["query_id"].dataType.simpleString()
        return index.spark.createDataFrame([], f"query_id {kind}, parsed_id BIGINT, score DOUBLE")
    blocks = _wanted_blocks(index, wanted.select("term").distinct())
    corpus = index.corpus.select(F.struct("n_docs", "avg_len")).scalar()
    idf = F.log(1 + (F.col("_c.n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = wanted.join(_frequencies(index, blocks), "term").filter("df > 0").withColumn("_c", corpus).select(
        "query_id", "term", idf.alias("idf"), F.col("_c.avg_len").alias("avg_len"))
    parts = max(1, -(-wanted.count() // QUERY_ROWS))
    numbered, every = weighted.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")), F.sequence(F.lit(0), F.lit(parts - 1))
    queries = numbered.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards["shards"] - 1))))
    cols = ["shard", "kind", "low", "term", "n", "most_tf", "least_len", "ids", "tfs", "lens"]
    left = blocks.withColumn("kind", F.lit(0)).select(cols)
    none = [F.lit(None).cast(t).alias(c) for c, t in (("term", "string"), ("n", "int"), ("most_tf", "int"), ("least_len", "int"))]
    lists = [F.lit(None).cast("array<int>").alias(c) for c in ("tfs", "lens")]

    def ids_as(kind: int, rows: DataFrame, low: Column) -> DataFrame:
        return rows.select("shard", F.lit(kind).alias("kind"), low.alias("low"), *none, F.array("parsed_id").alias("ids"), *lists)

    if index.changed:
        left = left.unionByName(ids_as(1, index.dead, F.col("low")))
    if where is not None:
        mark = index.spark.range(shards["shards"]).select(F.col("id").cast("int").alias("shard"), F.lit(0).cast("bigint").alias("low"))
        left = left.unionByName(ids_as(2, index.docs.filter(where), F.lit(0).cast("bigint"))).unionByName(
            mark.select("shard", F.lit(3).alias("kind"), "low", *none, F.lit(None).cast("array<bigint>").alias("ids"), *lists))
    left = left.withColumn("part", F.explode(every))
    kind = wanted.schema["query_id"].dataType
    return left.groupBy("shard", "part").cogroup(queries.groupBy("shard", "part")).applyInArrow(
        _ranked(k, to_arrow_type(kind)), f"query_id {kind.simpleString()}, parsed_id BIGINT, score DOUBLE")


def search_batch(index: StoredIndex, queries: DataFrame, k: int = 10, where: Column | None = None) -> DataFrame:
    """``queries(query_id, query)`` to ranked ``(query_id, parsed_id, score, rank)``."""
    wanted = queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("query")))).alias("term"))
    return top_per_query(rank_in_shards(index, wanted, k, where), k)


def search(index: StoredIndex, query: str, k: int = 10, where: Column | None = None) -> DataFrame:
    """The ``k`` best documents with their attributes; ``where`` limits them by attribute."""
    terms = index.spark.createDataFrame([(0, t) for t in query_terms(query)], "query_id INT, term STRING")
    top = top_per_query(rank_in_shards(index, terms, k, where), k).select("parsed_id", "score")
    return search_join(top, index.docs, "parsed_id", k).select("parsed_id", *ATTRIBUTES, "score")
