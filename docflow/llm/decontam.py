"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the postings (document, place) of every word that occurs in a test item, from all documents.
``phrases`` takes, for each window of test words, the offset-adjusted postings of its two rarest words in the index,
intersects them, and confirms the surviving starts by intersecting the postings of the window's other words.
``proximity`` returns documents that hold all words of a window within a stretch, in any order.

DataFrame functions only. Windows and the words of the test set are broadcast when their counted size is below a
bound (``common.small``), otherwise they are joined by shuffle.

Words are ``[0-9a-z]`` and all characters outside ASCII, after A-Z became a-z. Null and empty texts have no words and
no hits. Each input row is a document of its own, also when ids repeat or are null. An item of fewer words than a
window is one window, an item without words none; rows of the same item id count as one item; a null item id is the
empty name. Empty tables give no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docflow.llm.common import documents, keyed, small, texts_of, written

WINDOW = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Characters outside ASCII that lower() would change too: there, A-Z are translated one by one.
WIDE_UPPER = r"[[^\x00-\x7F]&&[\p{IsUppercase}\p{Lt}]]"
END = ""  # no word; stands after the last word of each document


def word_array(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    lowered = F.when(text.rlike(WIDE_UPPER), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(lowered, BREAK), "")


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(window_id, item_id, words): each ``size`` consecutive words of an item."""
    texts = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                         word_array(F.col("text").cast("string")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    rows = texts.select("item_id", "words", F.explode(starts).alias("start"))
    rows = rows.select("item_id", F.slice("words", F.col("start"), F.lit(size)).alias("words")).distinct()
    return written(rows.select(F.monotonically_increasing_id().alias("window_id"), "item_id", "words"), "windows")


def terms(found: DataFrame) -> DataFrame:
    """(term_id, word) of all windows."""
    rows = found.select(F.explode("words").alias("word")).distinct()
    return written(rows.select(F.monotonically_increasing_id().alias("term_id"), "word"), "terms")


def build_index(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Stored postings (doc_key, doc_id, term_id, pos) of the words in ``vocabulary``.

    A posting with term -1 stands behind each document's last word: its place is the document's length. Postings are
    written from the scan, without a shuffle; words outside the vocabulary never leave it.
    """
    marked = vocabulary.unionByName(docs.sparkSession.createDataFrame([(-1, END)], "term_id long, word string"))
    texts = documents(docs).select(F.monotonically_increasing_id().alias("doc_key"), "doc_id",
                                   F.concat(word_array(F.col("text")), F.array(F.lit(END))).alias("words"))
    rows = texts.select("doc_key", "doc_id", F.posexplode("words").alias("pos", "word"))
    return written(rows.join(small(marked), "word").select("doc_key", "doc_id", "term_id", "pos"), "postings")


def _window_terms(index: DataFrame, found: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(window_id, size, offset, term_id, rank): a window's words from the rarest in the index on.

    Windows with a word that no document has are left out.
    """
    counts = index.where("term_id >= 0").groupBy("term_id").agg(F.count("*").alias("n"))
    spread = found.select("window_id", F.size("words").alias("size"), F.posexplode("words").alias("offset", "word"))
    known = spread.join(vocabulary, "word").join(counts, "term_id")
    near = Window.partitionBy("window_id")
    ranked = known.withColumn("rank", F.row_number().over(near.orderBy("n", "offset"))).withColumn(
        "known", F.count("*").over(near)).where("known = size")
    return written(ranked.select("window_id", "size", "offset", "term_id", "rank"), "window_terms")


def phrases(index: DataFrame, found: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(doc_key, window_id, start, size): every occurrence of every window."""
    spread = _window_terms(index, found, vocabulary)
    postings = index.where("term_id >= 0").select("doc_key", "term_id", "pos")
    rarest, second = spread.where("rank = 1"), spread.where("rank = 2").select("window_id", "offset", "term_id")
    lists = postings.join(small(spread.where("rank <= 2").select("term_id").distinct()), "term_id")

    def adjusted(of: DataFrame) -> DataFrame:
        return lists.join(small(of), "term_id").withColumn("start", F.col("pos") - F.col("offset")).where("start >= 0").drop(
            "pos", "offset", "term_id", "rank")

    first = adjusted(rarest)
    both = first.where("size > 1").join(adjusted(second), ["doc_key", "window_id", "start"]).select(first.columns)
    starts = written(both.unionByName(first.where("size = 1")), "starts")
    left = starts.where("size > 2").join(small(spread.where("rank > 2").select("window_id", "offset", "term_id")), "window_id")
    left = left.withColumn("pos", F.col("start") + F.col("offset"))
    of_docs = postings.join(small(starts.select("doc_key").distinct()), "doc_key", "left_semi")
    full = left.join(of_docs, ["doc_key", "pos", "term_id"]).groupBy("doc_key", "window_id", "start", "size").agg(
        F.count("*").alias("n")).where("n = size - 2").drop("n")
    return full.unionByName(starts.where("size <= 2").select(full.columns))


def proximity(index: DataFrame, found: DataFrame, vocabulary: DataFrame, within: int) -> DataFrame:
    """(doc_key, window_id, pos): places of a window's rarest word that have all its words at most ``within`` words off."""
    spread = _window_terms(index, found, vocabulary)
    postings = index.where("term_id >= 0").select("doc_key", "term_id", "pos")
    places = written(postings.join(small(spread.where("rank = 1").select("window_id", "term_id")), "term_id").select(
        "doc_key", "window_id", "pos"), "places")
    wanted = spread.select("window_id", "term_id").distinct()
    need = wanted.groupBy("window_id").agg(F.count("*").alias("need"))
    others = postings.withColumnRenamed("pos", "other").join(
        small(places.select("doc_key").distinct()), "doc_key", "left_semi")
    met = places.join(small(wanted), "window_id").join(others, ["doc_key", "term_id"]).where(
        F.abs(F.col("other") - F.col("pos")) <= within)
    return met.groupBy("doc_key", "window_id", "pos").agg(F.count_distinct("term_id").alias("n")).join(
        small(need), "window_id").where("n = need").select("doc_key", "window_id", "pos")


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = windows(items, size)
    vocabulary = terms(found)
    index = build_index(docs, vocabulary)
    hits = written(phrases(index, found, vocabulary), "hits")
    places = hits.select("doc_key", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("pos")).distinct()
    n_hit = places.groupBy("doc_key").agg(F.count("*").alias("n_hit"))
    named = hits.join(small(found.select("window_id", "item_id")), "window_id").groupBy("doc_key").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"))
    lengths = index.where("term_id = -1").select("doc_key", "doc_id", F.col("pos").cast("long").alias("n_words"))
    out = lengths.join(n_hit.join(named, "doc_key"), "doc_key", "left")
    items_list = F.coalesce("items", F.array().cast("array<string>"))
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc_id", "n_words", hit.alias("n_hit"), F.size(items_list).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items_list, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without documents that hold a window of a test item; rows that share an id (null too) are one document."""
    bad = written(contamination(docs, items, size).where("contaminated").select(F.col("doc_id").alias("bad_id")).distinct(), "bad")
    kept = docs.select([F.col(c) for c in docs.columns])
    return kept.join(small(bad), kept["doc_id"].eqNullSafe(bad["bad_id"]), "left_anti")


def drop_contaminated_rows(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of a test item; other rows stay, also those that share an id with one."""
    rows = keyed(docs)
    bad = written(contamination(texts_of(rows), items, size).where("contaminated").select(F.col("doc_id").alias("row_key")), "bad")
    return rows.join(small(bad), "row_key", "left_anti").select("row.*")
