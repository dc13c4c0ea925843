"""Ranked search over parsed documents: BM25, vectors, and both together."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docflow.session import scratch, written

K1, B = 1.2, 0.75
RRF = 60
NOT_WORD = r"[^\p{L}\p{N}]+"
ATTRIBUTES = ["file_name", "file_url", "file_size", "last_modified", "parse_timestamp"]
# Above this many (query, term) rows the query side is shuffled, not broadcast.
BROADCAST_ROWS = 200_000
# Numbers of the query vectors and of the vectors that a task holds (64 MB of doubles each).
BLOCK_NUMBERS = 8_000_000
TASK_NUMBERS = 8_000_000
CENTRES = 64
PACK_ROWS = 256
NOTHING = -2.0  # below every cosine
MARGIN = 2e-6  # scores are compared as they are rounded
# Scores a task holds at once.
TILE_SCORES = 4_000_000
SALTS = 32
# Words that are counted at once.
GROUP_WORDS = 500_000


@dataclass
class Index:
    """``postings(term, parsed_id, tf, doc_len)``, ``docs(parsed_id, doc_len, attributes…)``."""

    postings: DataFrame
    docs: DataFrame

    @property
    def corpus(self) -> DataFrame:
        """One row: number of documents and their average length."""
        return self.docs.agg(F.count("*").alias("n_docs"), F.avg("doc_len").alias("avg_len"))


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), NOT_WORD), "")


def query_terms(query: str) -> list[str]:
    """Distinct terms of a query, split as ``tokens`` splits documents."""
    kept = "".join(c if unicodedata.category(c)[0] in "LN" else " " for c in query.lower())
    return sorted(set(kept.split()))


def _counted(keep: int):
    """Rows (kept columns, doc_len, term, tf) of batches with ``keep`` columns and the words of a document each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(keep)
            sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, at = np.cumsum(sizes), 0
            while at < len(sizes):
                stop = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + GROUP_WORDS, "right")))
                flat = pc.list_flatten(words.slice(at, stop - at)).dictionary_encode()
                owner = np.repeat(np.arange(stop - at), sizes[at:stop])
                pairs, tf = np.unique(owner * len(flat.dictionary) + flat.indices.to_numpy(zero_copy_only=False), return_counts=True)
                row, code = np.divmod(pairs, max(1, len(flat.dictionary)))
                cols = [batch.column(i).slice(at, stop - at).take(pa.array(row)) for i in range(keep)]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(sizes[at:stop][row], pa.int32()), flat.dictionary.take(pa.array(code)), pa.array(tf, pa.int64())],
                    [*batch.schema.names[:keep], "doc_len", "term", "tf"])
                at = stop

    return run


def build_index(parsed: DataFrame, extra: Sequence[str] = ()) -> Index:
    """Index of the successfully parsed documents; documents and postings carry the columns ``extra`` along.

    A document's terms are counted where the document lies, and every posting carries the document length, so neither
    counting nor scoring needs a shuffle. Only documents that share an id have their counts added up.
    """
    ok = parsed.filter(F.col("processing_status") == "SUCCESS")
    docs = ok.select("parsed_id", F.size(tokens(F.col("extracted_text"))).alias("doc_len"), *ATTRIBUTES, *extra)

    def counted(rows: DataFrame) -> DataFrame:
        words = rows.select("parsed_id", *extra, tokens(F.col("extracted_text")).alias("_t"))
        kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema.fields[:-1])
        made = words.mapInArrow(_counted(len(words.columns) - 1), f"{kept}, doc_len INT, term STRING, tf BIGINT")
        return made.select("parsed_id", "doc_len", *extra, "term", "tf")

    def added(rows: DataFrame) -> DataFrame:
        return rows.groupBy("parsed_id", "doc_len", *extra, "term").agg(F.sum("tf").alias("tf"))

    shared = ok.groupBy("parsed_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("parsed_id").alias("_shared"))
    n = shared.limit(BROADCAST_ROWS + 1).count()
    if n == 0:
        postings = counted(ok)
    elif n > BROADCAST_ROWS:
        postings = added(counted(ok))
    else:
        met = F.col("parsed_id").eqNullSafe(F.col("_shared"))
        postings = counted(ok.join(F.broadcast(shared), met, "left_anti")).unionByName(
            added(counted(ok.join(F.broadcast(shared), met, "left_semi"))))
    return Index(postings.select("term", "parsed_id", "tf", "doc_len", *extra), docs)


def write_index(index: Index, path: str, batch_id: int = 0) -> None:
    """One batch of documents in its own folder; postings lie sorted by term for row-group skipping."""
    postings = index.postings.repartitionByRange("term", "parsed_id").sortWithinPartitions("term", "parsed_id")
    postings.write.mode("overwrite").parquet(f"{path}/postings/batch_id={batch_id}")
    index.docs.write.mode("overwrite").parquet(f"{path}/docs/batch_id={batch_id}")


def load_index(spark: SparkSession, path: str) -> Index:
    return Index(
        spark.read.parquet(f"{path}/postings").drop("batch_id"), spark.read.parquet(f"{path}/docs").drop("batch_id")
    )


def refresh_index(path: str, new_docs: DataFrame, batch_id: int) -> None:
    """Add a batch of parsed documents; corpus figures follow from the stored documents."""
    write_index(build_index(new_docs), path, batch_id)


def _document_frequency(postings: DataFrame) -> DataFrame:
    """Documents per term. It reads ``tf`` so that both uses of the postings are one exchange."""
    return postings.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))


def _bm25(tf: Column, doc_len: Column, df: Column, n_docs: Column, avg_len: Column) -> Column:
    idf = F.log(1 + (n_docs - df + 0.5) / (df + 0.5))
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * doc_len / avg_len))


def _scored(index: Index, hits: DataFrame, group: list[str], where: Column | None) -> DataFrame:
    """Sum of term weights per ``group``; ``hits`` are postings of query terms with their df."""
    if where is not None:
        hits = hits.join(index.docs.filter(where).select("parsed_id"), "parsed_id", "left_semi")
    weight = _bm25(F.col("tf"), F.col("doc_len"), F.col("df"), F.col("n_docs"), F.col("avg_len"))
    corpus = index.corpus.select(F.struct("n_docs", "avg_len")).scalar()
    figures = hits.withColumn("_c", corpus).select("*", "_c.n_docs", "_c.avg_len")
    return figures.groupBy(*group).agg(F.round(F.sum(weight), 6).alias("score"))


def search(index: Index, query: str, k: int = 10, where: Column | None = None) -> DataFrame:
    """The ``k`` best documents with their attributes; ``where`` limits them by attribute."""
    postings = index.postings.filter(F.col("term").isin(query_terms(query)))
    hits = postings.join(F.broadcast(_document_frequency(postings)), "term")  # one row per query term
    top = _scored(index, hits, ["parsed_id"], where).orderBy(F.col("score").desc(), "parsed_id").limit(k)
    return search_join(top, index.docs, "parsed_id", k).select("parsed_id", *ATTRIBUTES, "score")


def search_join(hits: DataFrame, table: DataFrame, key: str, k: int) -> DataFrame:
    """Hits next to the rows of a table. ``k`` bounds the hits; a small bound is broadcast."""
    return table.join(F.broadcast(hits) if k <= BROADCAST_ROWS else hits, key)


def search_batch(index: Index, queries: DataFrame, k: int = 10) -> DataFrame:
    """``queries(query_id, query)`` to ranked ``(query_id, parsed_id, score, rank)``."""
    wanted = queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("query")))).alias("term"))
    n = wanted.agg(F.count("*").alias("n")).first()["n"]
    terms = wanted.select("term").distinct()
    if n <= BROADCAST_ROWS:
        used = index.postings.join(F.broadcast(terms), "term", "left_semi")
        weighted = wanted.join(F.broadcast(_document_frequency(used)), "term")
        hits = used.join(F.broadcast(weighted), "term")
    else:
        used = index.postings.join(terms, "term", "left_semi")
        hits = salted_join(used, wanted.join(_document_frequency(used), "term"), "term", "parsed_id")
    scored = _scored(index, hits, ["query_id", "parsed_id"], None)
    return top_per_query(scored, k)


def salted_join(big: DataFrame, small: DataFrame, key: str, spread: str) -> DataFrame:
    """Equi join whose hot keys are spread over ``SALTS`` tasks; every pair appears once."""
    left = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [key, "_salt"]).drop("_salt")


def top_per_query(scored: DataFrame, k: int, item: str = "parsed_id") -> DataFrame:
    """Best ``k`` per query; map tasks pass on ``k`` rows per query at most."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), item)
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


# ---- vectors -------------------------------------------------------------------------


def _bucketed(dims: int):
    """Rows (id, buckets, counts) of batches of ids and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(1)
            flat = pc.list_flatten(words).dictionary_encode()
            sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
            of = np.array([int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dims for w in flat.dictionary.to_pylist()], np.int64)
            owner = np.repeat(np.arange(len(batch)), sizes)
            pairs, counts = np.unique(owner * dims + of[flat.indices.to_numpy(zero_copy_only=False)], return_counts=True)
            row, bucket = np.divmod(pairs, dims)
            ends = pa.array(np.searchsorted(row, np.arange(len(batch) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, pa.array(bucket, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))], ["id", "b", "n"])

    return run


def _buckets(df: DataFrame, text_col: str, dims: int, id_col: str) -> DataFrame:
    """One row per row of ``df``, stored: its id and how often its words fall into which of the ``dims`` buckets.

    Rows that share an id have one row's counts together, ``rows`` says how many they are.
    """
    words = df.select(id_col, F.coalesce(tokens(F.col(text_col)), F.array().cast("array<string>")).alias("_t"))
    kind = df.schema[id_col].dataType.simpleString()
    counts = written(words.mapInArrow(_bucketed(dims), f"id {kind}, b ARRAY<INT>, n ARRAY<BIGINT>"), "buckets")
    several = counts.groupBy("id").agg(F.count("*").alias("rows")).filter("rows > 1").select(F.col("id").alias("_id"), "rows")
    k = several.limit(BROADCAST_ROWS + 1).count()
    one = F.lit(1).cast("bigint").alias("rows")
    if k == 0:
        return counts.select("id", "b", "n", one)
    shared, same = F.broadcast(several) if k <= BROADCAST_ROWS else several, F.col("id").eqNullSafe(F.col("_id"))
    cells = counts.join(shared, same).select("id", "rows", F.explode_outer(F.arrays_zip("b", "n")).alias("c"))
    added = cells.groupBy("id", "rows", F.col("c.b").alias("b")).agg(F.sum("c.n").alias("n"))
    lists = added.groupBy("id", "rows").agg(F.array_sort(F.collect_list(F.when(F.col("b").isNotNull(), F.struct("b", "n")))).alias("c"))
    return written(counts.join(shared, same, "left_anti").select("id", "b", "n", one).unionByName(
        lists.select("id", F.col("c.b").alias("b"), F.col("c.n").alias("n"), "rows")), "buckets")


def _model(counts: DataFrame, dims: int) -> DataFrame:
    spread = counts.select(F.explode("b").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("df"))
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0))).scalar()
    every = counts.sparkSession.range(dims).select(F.col("id").cast("int").alias("bucket"))
    return every.join(spread, "bucket", "left").select(
        "bucket", (F.log((total + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1).alias("idf"))


def embedding_model(df: DataFrame, text_col: str, dims: int = 256, id_col: str = "parsed_id") -> DataFrame:
    """The weight of each of the ``dims`` buckets in a collection: (bucket, idf), for texts to be embedded like its own."""
    return _model(_buckets(df, text_col, dims, id_col), dims)


def _weighted(dims: int):
    """Unit vectors of rows (id, buckets, counts, weights of all buckets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((len(batch), dims))
            if len(batch):
                idf = np.zeros(dims)
                for one in batch.column("model")[0].as_py():
                    idf[one["bucket"]] = one["idf"]
                sizes = pc.list_value_length(batch.column("b")).to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(len(batch)), sizes)
                bucket, n = (pc.list_flatten(batch.column(c)).to_numpy(zero_copy_only=False) for c in ("b", "n"))
                out[owner, bucket] = n * idf[bucket]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * dims, pa.int32()), pa.array(_unit(out).ravel()))],
                ["id", "embedding"])

    return run


def _embedded(counts: DataFrame, model: DataFrame, dims: int, id_col: str) -> DataFrame:
    """A row for each row that was counted; rows without words or without an id have the zero vector."""
    none = F.col("id").isNull()
    asked = counts.select("id", *[F.when(none, F.array().cast(t)).otherwise(F.col(c)).alias(c) for c, t in (("b", "array<int>"), ("n", "array<bigint>"))],
                          F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))))
    weights = model.agg(F.collect_list(F.struct("bucket", "idf")).alias("model"))  # one row of ``dims`` pairs
    kind = counts.schema["id"].dataType.simpleString()
    made = asked.drop("col").crossJoin(F.broadcast(weights)).mapInArrow(_weighted(dims), f"id {kind}, embedding ARRAY<DOUBLE>")
    return made.withColumnRenamed("id", id_col)


def embed(
    df: DataFrame, text_col: str, dims: int = 256, id_col: str = "parsed_id", model: DataFrame | None = None
) -> DataFrame:
    """Default embedder: ``id_col`` and ``embedding``, TF-IDF over hashed words, unit length.

    A word's bucket is its md5 modulo ``dims``. Words are counted where the text lies and the counts stored, at most
    ``dims`` per document; a text without words has the zero vector. ``model`` are another collection's weights.
    """
    counts = _buckets(df, text_col, dims, id_col)
    return _embedded(counts, _model(counts, dims) if model is None else model, dims, id_col)


def search_by_meaning(docs: DataFrame, text_col: str, queries: DataFrame, k: int = 10, dims: int = 256) -> DataFrame:
    """``queries(query_id, query)`` to the ``k`` nearest of ``docs`` by the documents' own vectors: (query_id, parsed_id, score, rank)."""
    counts = _buckets(docs, text_col, dims, "parsed_id")
    model = written(_model(counts, dims), "embedding-model")
    asked = embed(queries, "query", dims, "query_id", model)
    return search_dense(_embedded(counts, model, dims, "parsed_id"), asked, k, "parsed_id")


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _best(ids: np.ndarray, scores: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Row positions of the ``k`` best scores, ties to the lower id, ``own`` rows left out."""
    usable = np.flatnonzero(~own)
    if len(usable) > k:
        cut = np.partition(scores[usable], len(usable) - k)[len(usable) - k]
        usable = usable[scores[usable] >= cut]
    return usable[np.lexsort((ids[usable], -scores[usable]))][:k]


def _matrix(column: pa.Array) -> np.ndarray:
    """The lists of a batch as unit rows; a list without length stays zero."""
    return _unit(pc.list_flatten(column).to_numpy(zero_copy_only=False).astype("float64").reshape(len(column), -1))


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))


def _centres(vectors: DataFrame, item: str) -> np.ndarray:
    """At most ``CENTRES`` unit vectors of the table, chosen by hash."""
    rows = vectors.orderBy(F.xxhash64(item), item).limit(CENTRES).select("e").collect()
    unit = _unit(np.array([r.e for r in rows], "float64").reshape(len(rows), -1)) if rows else np.empty((0, 0))
    return unit[unit.any(axis=1)]


def _packed(centres: np.ndarray):
    """Vectors by their nearest centre, in packs of a narrow range of angles to it; those without direction have cell -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _matrix(batch.column("e"))
            near = _angles(unit, centres) if len(centres) else np.zeros((len(unit), 1))
            cell = np.where(unit.any(axis=1), near.argmin(axis=1), -1)
            angle = np.where(cell < 0, 0.0, near[np.arange(len(unit)), cell])
            order = np.lexsort((angle, cell))
            cuts = np.flatnonzero(np.diff(cell[order])) + 1
            for part in np.split(order, cuts):
                for at in range(0, len(part), PACK_ROWS):
                    one = part[at:at + PACK_ROWS]
                    ids = batch.column(0).take(pa.array(one))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([int(cell[one[0]])], pa.int32()), pa.array([angle[one[0]]]), pa.array([angle[one[-1]]]), pa.array([len(one)], pa.int32()),
                        pa.ListArray.from_arrays(pa.array([0, len(one)], pa.int32()), ids), pa.array([unit[one].tobytes()], pa.binary())],
                        ["cell", "low", "high", "n", "ids", "data"])

    return run


def _asked(centres: np.ndarray):
    """Queries with their unit vector and own cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _matrix(batch.column("e"))
            near = _angles(unit, centres) if len(centres) else np.zeros((len(unit), 1))
            cell = np.where(unit.any(axis=1), near.argmin(axis=1), -1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([row.tobytes() for row in unit], pa.binary()), pa.array(cell, pa.int32())], ["query_id", "data", "cell"])

    return run


def _bounds(away: np.ndarray, low, high) -> np.ndarray:
    """Largest cosine with anything whose angle to a centre is from ``low`` to ``high``, for angles ``away`` to that centre."""
    return np.cos(np.maximum(0.0, np.maximum(away - high, low - away)))


def _remaining(centres: np.ndarray, cells: list[tuple[int, float, float]]):
    """The other cells that may hold one of a query's best."""
    numbers = np.array([c[0] for c in cells])
    low, high = (np.array([c[i] for c in cells]) for i in (1, 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = np.frombuffer(b"".join(batch.column("data").to_pylist())).reshape(len(batch), -1)
            bound = np.zeros((len(unit), len(cells)))
            real = numbers >= 0
            bound[:, real] = np.where(unit.any(axis=1)[:, None], _bounds(_angles(unit, centres[numbers[real]]), low[real], high[real]), 0.0)
            least, own = batch.column("least").to_numpy(), batch.column("cell").to_numpy()
            row, which = np.nonzero((bound >= least[:, None] - MARGIN) & (numbers[None] != own[:, None]))
            kept = batch.take(pa.array(row))
            yield kept.set_column(kept.schema.get_field_index("cell"), "cell", pa.array(numbers[which], pa.int32()))

    return run


def best_of_packs(
    packs: list[tuple], q: np.ndarray, own: list, least: np.ndarray, centre: np.ndarray | None, k: int
) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """The ``k`` best (ids, scores) of each row of ``q`` in the packs (low, high, ids, unit rows) of one cell, and how many
    scores that took. A pack is passed over for the queries that have ``k`` better ones, the ids in ``own`` are left out."""
    away = _angles(q, centre[None])[:, 0] if centre is not None else None
    found = [(np.empty(0, np.int64), np.empty(0))] * len(q)
    least, some, compared = least.copy(), q.any(axis=1), 0
    if away is not None:  # near packs first: they raise the bar for the others
        packs = sorted(packs, key=lambda p: abs((p[0] + p[1]) / 2 - float(np.median(away))))
    for low, high, ids, unit in packs:
        bound = np.zeros(len(q)) if away is None else np.where(some, _bounds(away, low, high), 0.0)
        asked = np.flatnonzero(bound >= least - MARGIN)
        for at in range(0, len(asked), max(1, TILE_SCORES // len(ids))):
            part = asked[at:at + max(1, TILE_SCORES // len(ids))]
            scores = np.round(unit @ q[part].T, 6) + 0.0
            compared += scores.size
            for column in np.flatnonzero(scores.max(axis=0) >= least[part]):
                j = part[column]
                near = np.concatenate([found[j][1], scores[:, column]])
                names = np.concatenate([found[j][0], ids])
                pick = _best(names, near, (names == own[j]) if own[j] is not None else np.zeros(len(names), bool), k)
                found[j] = names[pick], near[pick]
                if len(pick) == k:
                    least[j] = max(least[j], near[pick].min())
    return found, compared


def _met(centres: np.ndarray, k: int, exclude_self: bool, id_type: pa.DataType, query_type: pa.DataType):
    def rank(key, packs: pa.Table, asked: pa.Table) -> pa.Table:
        cell = key[0].as_py()
        out: tuple[list, list, list] = ([], [], [])
        if len(packs) and len(asked):
            q = np.frombuffer(b"".join(asked["data"].to_pylist())).reshape(len(asked), -1)
            names = asked["query_id"].to_pylist()
            parts = [(low, high, np.array(ids), np.frombuffer(data).reshape(len(ids), -1)) for low, high, ids, data in zip(
                *(packs[c].to_pylist() for c in ("low", "high", "ids", "data")))]
            found, _ = best_of_packs(parts, q, names if exclude_self else [None] * len(q), asked["least"].to_numpy(),
                                     centres[cell] if cell >= 0 else None, k)
            for name, (ids, scores) in zip(names, found):
                out[0].extend([name] * len(ids))
                out[1].extend(ids.tolist())
                out[2].extend(scores.tolist())
        return pa.table({"query_id": pa.array(out[0], query_type), "item": pa.array(out[1], id_type), "score": pa.array(out[2], pa.float64())})

    return rank


def search_dense(
    vectors: DataFrame, queries: DataFrame, k: int = 10, item: str = "vec_id", exclude_self: bool = False
) -> DataFrame:
    """Exact cosine ranking: ``queries(query_id, embedding)`` to ``(query_id, item, score, rank)``.

    Vectors are packed by the nearest of a few centres, in narrow ranges of the angle to it. A query is ranked in its own
    cell first; what it finds there, with the angles, rules out cells and packs that can't hold a better one. Queries and
    packs meet in tasks of bounded size, a large cell in several, and each keeps its ``k`` best rows per query.
    Neither queries nor vectors pass through the driver, but for the centres. Null vectors are left out, and those without direction
    have cosine 0. ``exclude_self`` leaves out the row whose id equals the query id.
    """
    spark, e = vectors.sparkSession, F.col("embedding").cast("array<double>").alias("e")
    source = vectors.filter("embedding is not null").select(item, e)
    centres = _centres(source, item)
    kind, query_kind = vectors.schema[item].dataType, queries.schema["query_id"].dataType
    path = scratch(spark, "packs")
    source.mapInArrow(_packed(centres), f"cell INT, low DOUBLE, high DOUBLE, n INT, ids ARRAY<{kind.simpleString()}>, data BINARY").write.parquet(path)
    packs = spark.read.parquet(path)
    # A row per centre at most.
    cells = packs.groupBy("cell").agg(F.min("low"), F.max("high"), F.sum("n"), F.max(F.octet_length("data") / F.col("n") / 8)).collect()
    asked = queries.filter("embedding is not null").select("query_id", e).mapInArrow(
        _asked(centres), f"query_id {query_kind.simpleString()}, data BINARY, cell INT")
    width = int(max((c[4] for c in cells), default=0))
    parts = max(1, -(-asked.count() * width // BLOCK_NUMBERS))
    subs = {c[0]: max(1, -(-c[3] * width // TASK_NUMBERS)) for c in cells} or {-1: 1}
    of_cell = F.create_map(*[F.lit(int(x)) for pair in subs.items() for x in pair])[F.col("cell")]
    placed = packs.withColumn("sub", F.pmod(F.xxhash64(F.get("ids", F.lit(0))), of_cell).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    key = ["cell", "sub", "part"]

    def meet(wanted: DataFrame) -> DataFrame:
        spread = wanted.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")).withColumn(
            "sub", F.explode(F.sequence(F.lit(0), of_cell.cast("int") - 1)))
        return placed.groupBy(*key).cogroup(spread.groupBy(*key)).applyInArrow(
            _met(centres, k, exclude_self, to_arrow_type(kind), to_arrow_type(query_kind)),
            f"query_id {query_kind.simpleString()}, item {kind.simpleString()}, score DOUBLE")

    # A query whose own cell is empty starts with nothing found.
    first = scratch(spark, "own-cell")
    top_per_query(meet(asked.withColumn("least", F.lit(NOTHING))), k, "item").write.parquet(first)
    own = spark.read.parquet(first)
    least = own.filter(F.col("rank") == k).select(F.col("query_id").alias("_q"), "score")
    known = asked.join(least, F.col("query_id") == F.col("_q"), "left").select(
        "query_id", "data", "cell", F.coalesce("score", F.lit(NOTHING)).alias("least"))
    others = known.mapInArrow(_remaining(centres, [(c[0], c[1], c[2]) for c in cells]),
                              f"query_id {query_kind.simpleString()}, data BINARY, cell INT, least DOUBLE")
    both = own.drop("rank").unionByName(meet(others))
    return top_per_query(both, k, "item").withColumnRenamed("item", item)


def similar_to(vectors: DataFrame, seeds: DataFrame, k: int = 10, item: str = "vec_id") -> DataFrame:
    """Documents like the given ones: their own vectors are the queries, themselves left out."""
    queries = vectors.join(seeds.select(item), item, "left_semi").select(F.col(item).alias("query_id"), "embedding")
    return search_dense(vectors, queries, k, item, exclude_self=True)


def fuse(lexical: DataFrame, dense: DataFrame, k: int, item: str = "parsed_id") -> DataFrame:
    """Reciprocal-rank fusion of two rankings ``(query_id, item, rank)``."""
    both = lexical.select("query_id", item, "rank").unionByName(dense.select("query_id", item, "rank"))
    score = F.round(F.sum(F.lit(1.0) / (RRF + F.col("rank"))), 9).alias("score")
    return top_per_query(both.groupBy("query_id", item).agg(score), k, item)
