"""A bounded sample of labelled texts to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import documents


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> tuple[list[tuple[bytes, int]], dict[int, int]]:
    """At most ``rows`` texts, half of each label, and how many rows have each label.

    The ids are drawn by hash from the label table alone, so the texts meet a side of at most ``rows`` rows and
    are not shuffled. A null label, id or text is no example; of several labels of an id, the largest holds.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    picked = None
    for value in (0, 1):
        one = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows // 2)
        picked = one if picked is None else picked.unionByName(one)
    found = documents(docs).where("text is not null").join(F.broadcast(picked), "doc_id").select("doc_id", "text", "label")
    out = sorted((r.doc_id, r.text.encode(), r.label) for r in found.collect())
    return [(text, y) for _, text, y in out], counts
