"""Queries: ranked search over the parsed documents and over vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.operators import analytics as a, search as s, stored_index as si
from docflow.plans.fixtures import with_tables
from docflow.plans.registry import query
from docflow.schemas import PARSED
from docflow.session import scratch
from docflow.sources.tables import conform

TEXT = "worthless ingthere the reresh ononedth"
K = 10

# Index and scores in SQL. Two lists of words: the documents' and the queries'.
WORDS = "LIST_FILTER(REGEXP_SPLIT_TO_ARRAY(LOWER({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"
INDEX = f"""toks AS (SELECT *, {WORDS.format('extracted_text')} AS t FROM parsed_invoices WHERE processing_status = 'SUCCESS'),
  docs AS (SELECT parsed_id, file_name, file_url, file_size, last_modified, parse_timestamp, LEN(t) AS doc_len FROM toks),
  words AS (SELECT parsed_id, LEN(t) AS doc_len, UNNEST(t) AS term FROM toks),
  postings AS (SELECT term, parsed_id, COUNT(*) AS tf, doc_len FROM words GROUP BY term, parsed_id, doc_len),
  corpus AS (SELECT COUNT(*) AS n_docs, AVG(doc_len) AS avg_len FROM docs)"""
SCORES = """,
  terms AS (SELECT DISTINCT query_id, UNNEST({words}) AS term FROM ({queries})),
  freq AS (SELECT term, COUNT(*) AS df FROM postings GROUP BY term),
  scores AS (SELECT query_id, p.parsed_id, ROUND(SUM(LN(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.2
      / (tf + 1.2 * (1 - 0.75 + 0.75 * doc_len / avg_len))), 6) AS score
    FROM terms t JOIN postings p ON p.term = t.term JOIN freq f ON f.term = t.term, corpus {where} GROUP BY 1, 2),
  lexical AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, parsed_id) AS rank FROM scores)
    WHERE rank <= {k})"""


def scored(queries: str, k: int = K, where: str = "") -> str:
    return "WITH " + INDEX + SCORES.format(words=WORDS.format("query"), queries=queries, k=k, where=where)


def one(text: str = TEXT) -> str:
    return f"SELECT 1 AS query_id, '{text}' AS query"


HIT = "d.parsed_id, d.file_name, d.file_url, d.file_size, d.last_modified, d.parse_timestamp, l.score"


STORED: dict[tuple[str, str], str] = {}  # where the index of a data folder lies, by application


def index(t) -> si.StoredIndex:
    """The stored index of the parsed documents, which the first search of an application writes."""
    key = (t.spark.sparkContext.applicationId, t.dir)
    if key in STORED and (there := si.open_index(t.spark, STORED[key])).intervals:
        return there
    STORED[key] = scratch(t.spark, "search-index")
    si.add(t.spark, STORED[key], conform(t.parsed, PARSED), 0)
    return si.open_index(t.spark, STORED[key])


@query("h1_build_index", with_tables(f"WITH {INDEX} SELECT term, parsed_id, tf, doc_len FROM postings", "parsed_invoices"))
def _(t):
    return s.build_index(t.parsed).postings


@query("h1b_store_index", with_tables(f"""WITH {INDEX}
SELECT (SELECT COUNT(*) FROM docs) AS documents, COUNT(*) AS postings, COUNT(DISTINCT term) AS terms, CAST(SUM(tf) AS BIGINT) AS words FROM postings""",
       "parsed_invoices"))
def _(t):
    STORED.pop((t.spark.sparkContext.applicationId, t.dir), None)
    stored = index(t)
    blocks = stored.table("postings", si.POSTINGS)
    counts = blocks.agg(F.sum("n").cast("bigint").alias("postings"), F.count_distinct("term").alias("terms"),
                        F.sum(F.aggregate("tfs", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("words"))
    return a.beside(stored.corpus.select(F.col("n_docs").alias("documents")), counts)


@query("h2_search", with_tables(scored(one()) + f" SELECT {HIT} FROM lexical l JOIN docs d ON d.parsed_id = l.parsed_id", "parsed_invoices"))
def _(t):
    return si.search(index(t), TEXT, K)


@query("h2b_search_stored_index", with_tables(
    scored(one(), 50) + f" SELECT {HIT} FROM lexical l JOIN docs d ON d.parsed_id = l.parsed_id", "parsed_invoices"))
def _(t):
    # As postings that other jobs can read: sorted by term, not packed.
    path = scratch(t.spark, "index")
    s.write_index(s.build_index(t.parsed), path)
    return s.search(s.load_index(t.spark, path), TEXT, 50)


@query("h5_batch_queries", with_tables(
    scored("SELECT item_id AS query_id, text AS query FROM benchmark") + " SELECT query_id, parsed_id, score, rank FROM lexical",
    "parsed_invoices"))
def _(t):
    queries = t.table("benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return si.search_batch(index(t), queries, K).select("query_id", "parsed_id", "score", F.col("rank").cast("bigint").alias("rank"))


JOINED = "p.file_name, p.parse_timestamp, p.file_size"


@query("h6_search_with_filters", with_tables(
    scored(one(), 50) + f""" SELECT {JOINED} FROM parsed_invoices p JOIN lexical l ON p.parsed_id = l.parsed_id
WHERE p.processing_status = 'SUCCESS' AND p.file_size > 1000""", "parsed_invoices"))
def _(t):
    hits = si.search(index(t), TEXT, 50).select("parsed_id")
    base = t.parsed.filter("processing_status = 'SUCCESS' AND file_size > 1000")
    return s.search_join(hits, base, "parsed_id", 50).select("file_name", "parse_timestamp", "file_size")


@query("n10_search_join", with_tables(
    scored(one(), 50) + f" SELECT {JOINED} FROM parsed_invoices p JOIN lexical l ON p.parsed_id = l.parsed_id", "parsed_invoices"))
def _(t):
    hits = si.search(index(t), TEXT, 50).select("parsed_id")
    return s.search_join(hits, t.parsed, "parsed_id", 50).select("file_name", "parse_timestamp", "file_size")


# Document n is taken as the scan of invoice n, so hits lead to the invoice through its extraction.
@query("h7_search_to_invoices", with_tables(scored(one(), 50) + """
SELECT i.invoice_number, i.vendor_name, i.invoice_date, i.total_amount FROM lexical l
JOIN raw_json r ON r.extraction_id = l.parsed_id JOIN invoice i ON i.extraction_id = r.extraction_id""",
       "parsed_invoices", "raw_json", "invoice"))
def _(t):
    hits = si.search(index(t), TEXT, 50).select(F.col("parsed_id").alias("extraction_id"))
    sources = s.search_join(hits, t.raw.select("extraction_id"), "extraction_id", 50)
    return s.search_join(sources, t.invoice, "extraction_id", 50).select(
        "invoice_number", "vendor_name", "invoice_date", "total_amount"
    )


@query("h8_saved_search", with_tables(
    scored(one(), 50) + " SELECT d.file_name, d.parse_timestamp, d.file_url FROM lexical l JOIN docs d ON d.parsed_id = l.parsed_id",
    "parsed_invoices"))
def _(t):
    si.search(index(t), TEXT, 50).createOrReplaceTempView("docflow_saved_search")
    return t.spark.sql("SELECT file_name, parse_timestamp, file_url FROM docflow_saved_search")


@query("h9_attribute_filter", with_tables(
    scored(one(), K, "WHERE p.parsed_id IN (SELECT parsed_id FROM docs WHERE file_size BETWEEN 500 AND 5000)")
    + f" SELECT {HIT} FROM lexical l JOIN docs d ON d.parsed_id = l.parsed_id", "parsed_invoices"))
def _(t):
    return si.search(index(t), TEXT, K, where=F.col("file_size").between(500, 5000))


@query("h11_index_stats", with_tables(f"""WITH {INDEX} SELECT COUNT(*) AS documents, COUNT(DISTINCT file_name) AS unique_files,
  MIN(parse_timestamp) AS first_indexed, MAX(parse_timestamp) AS last_indexed, ROUND((SELECT avg_len FROM corpus), 6) AS average_length
FROM docs""", "parsed_invoices"))
def _(t):
    one_index = index(t)
    stats = a.search_stats(one_index.docs.withColumn("processing_status", F.lit("SUCCESS")))
    return a.beside(stats, one_index.corpus).select(
        F.col("n_docs").alias("documents"), "unique_files", "first_indexed", "last_indexed",
        F.round("avg_len", 6).alias("average_length"),
    )


# ---- vectors: the queries are the centres of the labelled groups -----------------------

# Numbered components keep the sum in a fixed order on both sides.
CENTRES = """parts AS (SELECT label, vec_id, UNNEST(embedding) AS v, GENERATE_SUBSCRIPTS(embedding, 1) AS i FROM embeddings),
  centres AS (SELECT label AS query_id, LIST(m ORDER BY i) AS embedding FROM
    (SELECT label, i, ROUND(AVG(CAST(v AS DOUBLE)), 9) AS m FROM parts GROUP BY 1, 2) GROUP BY 1)"""
COSINE = "ROUND(LIST_COSINE_SIMILARITY(CAST({0} AS DOUBLE[]), CAST({1} AS DOUBLE[])), 6)"
DENSE = f"""dense AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM
    (SELECT c.query_id, e.vec_id, {COSINE.format('e.embedding', 'c.embedding')} AS score FROM embeddings e, centres c)) WHERE rank <= {K})"""


def centres(t):
    parts = t.table("embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    means = parts.groupBy("label", "i").agg(F.round(F.avg(F.col("v").cast("double")), 9).alias("m"))
    # One row per label and component, so a label's list has as many entries as the vector.
    return means.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.array_sort(F.collect_list(F.struct("i", "m"))).alias("p")
    ).select("query_id", F.col("p.m").alias("embedding"))


@query("h3_dense_search", f"WITH {CENTRES}, {DENSE} SELECT query_id, vec_id, score, rank FROM dense")
def _(t):
    return s.search_dense(t.table("embeddings"), centres(t), K).withColumn("rank", F.col("rank").cast("bigint"))


@query("h3b_embed_documents", with_tables(f"""WITH {INDEX},
  counts AS (SELECT parsed_id, CAST(CAST('0x' || SUBSTR(MD5(term), 1, 8) AS BIGINT) % 256 AS BIGINT) AS bucket, COUNT(*) AS tf
    FROM words GROUP BY 1, 2),
  spread AS (SELECT bucket, LN(((SELECT COUNT(*) FROM toks) + 1) / (COUNT(*) + 1)) + 1 AS idf FROM counts GROUP BY 1),
  weights AS (SELECT parsed_id, c.bucket, tf * idf AS w FROM counts c JOIN spread s ON s.bucket = c.bucket)
SELECT parsed_id, bucket, ROUND(w / SQRT(SUM(w * w) OVER (PARTITION BY parsed_id)), 6) AS weight FROM weights""", "parsed_invoices"))
def _(t):
    ok = t.parsed.filter("processing_status = 'SUCCESS'").select("parsed_id", "extracted_text")
    cells = s.embed(ok, "extracted_text").select("parsed_id", F.posexplode("embedding").alias("bucket", "w")).filter("w > 0")
    return cells.select("parsed_id", F.col("bucket").cast("bigint").alias("bucket"), F.round("w", 6).alias("weight"))


# Documents and questions by the same embedder: the documents' weights.
MEANING = """, counts AS (SELECT parsed_id, {bucket} AS bucket, COUNT(*) AS tf FROM words GROUP BY 1, 2),
  spread AS (SELECT b AS bucket, LN(((SELECT COUNT(*) FROM toks) + 1) / (COUNT(counts.bucket) + 1)) + 1 AS idf
    FROM RANGE(256) r(b) LEFT JOIN counts ON counts.bucket = b GROUP BY 1),
  unit AS (SELECT parsed_id, c.bucket, tf * idf / SQRT(SUM(tf * idf * tf * idf) OVER (PARTITION BY parsed_id)) AS w
    FROM counts c JOIN spread s ON s.bucket = c.bucket),
  asked AS ({queries}),
  parts AS (SELECT query_id, {bucket} AS bucket, COUNT(*) AS tf FROM (SELECT query_id, UNNEST({words}) AS term FROM asked) GROUP BY 1, 2),
  question AS (SELECT query_id, p.bucket, tf * idf / SQRT(SUM(tf * idf * tf * idf) OVER (PARTITION BY query_id)) AS w
    FROM parts p JOIN spread s ON s.bucket = p.bucket),
  cosines AS (SELECT query_id, parsed_id, SUM(u.w * q.w) AS c FROM unit u JOIN question q ON q.bucket = u.bucket GROUP BY 1, 2),
  near AS (SELECT a.query_id, d.parsed_id, ROUND(COALESCE(c, 0), 6) AS score FROM asked a CROSS JOIN docs d
    LEFT JOIN cosines x ON x.query_id = a.query_id AND x.parsed_id = d.parsed_id),
  meaning AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, parsed_id) AS rank FROM near) WHERE rank <= {k})"""


def by_meaning(queries: str, k: int = K) -> str:
    return MEANING.format(bucket="CAST(CAST('0x' || SUBSTR(MD5(term), 1, 8) AS BIGINT) % 256 AS BIGINT)", queries=queries,
                          words=WORDS.format("query"), k=k)


def good_texts(t):
    return t.parsed.filter("processing_status = 'SUCCESS'").select("parsed_id", "extracted_text")


@query("h3c_text_to_ranking", with_tables(
    f"WITH {INDEX}" + by_meaning("SELECT item_id AS query_id, text AS query FROM benchmark") + " SELECT query_id, parsed_id, score, rank FROM meaning",
    "parsed_invoices"))
def _(t):
    queries = t.table("benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return s.search_by_meaning(good_texts(t), "extracted_text", queries, K).withColumn("rank", F.col("rank").cast("bigint"))


@query("h4b_hybrid_by_text", with_tables(scored(one(), 50) + by_meaning(one(), 50) + f""",
  both_ranks AS (SELECT query_id, parsed_id, rank FROM lexical UNION ALL SELECT query_id, parsed_id, rank FROM meaning),
  fused AS (SELECT query_id, parsed_id, ROUND(SUM(1.0::DOUBLE / (60 + rank)), 9) AS score FROM both_ranks GROUP BY 1, 2)
SELECT query_id, parsed_id, score, rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, parsed_id) AS rank FROM fused)
WHERE rank <= {K}""", "parsed_invoices"))
def _(t):
    queries = t.spark.createDataFrame([(1, TEXT)], "query_id BIGINT, query STRING")
    dense = s.search_by_meaning(good_texts(t), "extracted_text", queries, 50)
    return s.fuse(si.search_batch(index(t), queries, 50), dense, K).withColumn("rank", F.col("rank").cast("bigint"))


# Vector n belongs to document n; group 1 is the query's vector.
@query("h4_hybrid_search", with_tables(scored(one(), 50) + f""", {CENTRES}, {DENSE.replace(f'rank <= {K}', 'rank <= 50')},
  both_ranks AS (SELECT query_id, parsed_id, rank FROM lexical UNION ALL SELECT query_id, vec_id, rank FROM dense WHERE query_id = 1),
  fused AS (SELECT query_id, parsed_id, ROUND(SUM(1.0::DOUBLE / (60 + rank)), 9) AS score FROM both_ranks GROUP BY 1, 2)
SELECT query_id, parsed_id, score, rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, parsed_id) AS rank FROM fused)
WHERE rank <= {K}""", "parsed_invoices"))
def _(t):
    queries = t.spark.createDataFrame([(1, TEXT)], "query_id BIGINT, query STRING")
    lexical = si.search_batch(index(t), queries, 50)
    dense = s.search_dense(t.table("embeddings"), centres(t).filter("query_id = 1"), 50)
    fused = s.fuse(lexical, dense.withColumnRenamed("vec_id", "parsed_id"), K)
    return fused.withColumn("rank", F.col("rank").cast("bigint"))


# Seeds: the first vector of every label.
@query("h12_similar_documents", f"""
WITH seeds AS (SELECT MIN(vec_id) AS vec_id FROM embeddings GROUP BY label),
  pairs AS (SELECT q.vec_id AS query_id, e.vec_id, {COSINE.format('e.embedding', 'q.embedding')} AS score
    FROM embeddings q JOIN seeds ON seeds.vec_id = q.vec_id, embeddings e WHERE e.vec_id <> q.vec_id)
SELECT query_id, vec_id, score, rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= {K}""")
def _(t):
    vectors = t.table("embeddings")
    seeds = vectors.groupBy("label").agg(F.min("vec_id").alias("vec_id")).select("vec_id")
    return s.similar_to(vectors, seeds, K).withColumn("rank", F.col("rank").cast("bigint"))
