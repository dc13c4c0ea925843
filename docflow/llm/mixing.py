"""Mixing sources to target weights: tokens per source, repetition rates, whole copies and one Bernoulli copy.

A source's target is its share by weight of all words, at most ``MOST`` times what the source has; what is above is shared
out again by weight among the others until no target is above. With the level L that solves
sum(min(MOST * size, L * weight)) = all words, each target is min(MOST * size, L * weight). A document of rate r =
target / size of its source is taken floor(r) times, and once more with probability r - floor(r), decided by a hash of
its id and text: the same in every run, on any cluster.

Words are ``[^\\x20\\x09-\\x0D]+``; null texts have none. Documents without words are copied like the others of their source
and add nothing. Sources are ordered by code point, null (a source of its own) last, and get the weights in turn. Rows that
are equal in id and text share one decision; rows that share only an id (or have none) do not. A source without words has
target 0 and rate 0. Empty tables give empty tables. Columns besides those read may have any name.

Sizes are summed per source before they are shuffled, so a hot source costs one row a task. Sources are numbered in
range partitions; the level comes from a few rounds of one aggregate over the source table, of which four numbers reach
the driver. Rates go to the documents by a broadcast if there are few sources, else by a join whose hot keys AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import small, written
from docflow.sources.keys import dense_ids

WEIGHTS = (5, 2, 1)
MOST = 3
DIGITS = 13  # hexadecimal digits of the hash that make the Bernoulli number


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def chance(doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) that follows from the id and the text of a row."""
    key = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, DIGITS), 16, 10).cast("double") / float(16 ** DIGITS)


def _sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and chance of each row, stored without the texts."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return written(docs.select(doc_id.alias("doc_id"), F.col("source").cast("string").alias("source"),
                               size_of(text).alias("size"), chance(doc_id, text).alias("chance")), "sized")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, weight, source_size, target, rate: one stored row per source of ``sized`` (source, size)."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("unnamed", F.col("source").isNull())
    numbered = dense_ids(sources, ["unnamed", "source"], "number", start=0)
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights)).cast("int") + 1).cast("long")
    per = written(numbered.select("source", turn.alias("weight"), "source_size"), "sources")
    cap, level = F.col("source_size") * most, F.lit(0.0)
    total, weight = per.agg(F.sum("source_size"), F.sum("weight")).first()
    held = None
    while total:
        above = cap < level * F.col("weight")
        now = per.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
                      F.coalesce(F.sum(F.when(above, F.col("weight"))), F.lit(0))).first()
        if held is not None and now[0] == held:
            break
        held, level = now[0], F.lit(float(total - now[1]) / float(weight - now[2]))
    target = F.least(cap.cast("double"), level * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return written(per.select("*", target.alias("target"), rate.alias("rate")), "targets")


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target and how many ``copies`` of the row the mix takes."""
    sized = _sized(docs)
    rates = small(targets(sized, weights, most).withColumnRenamed("source", "_source"))
    whole = F.floor("rate")
    extra = (F.col("chance") < F.col("rate") - whole).cast("long")
    return sized.join(rates, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "source_size", "target", (whole + extra).alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, with its columns."""
    doc_id, text = docs["doc_id"].cast("long"), docs["text"].cast("string")
    rates = small(targets(_sized(docs), weights, most).select(F.col("source").alias("_source"), "rate"))
    row = docs.select(F.struct([docs[c] for c in docs.columns]).alias("_row"), docs["source"].cast("string").alias("_of"),
                      chance(doc_id, text).alias("_chance"))
    times = (F.floor("rate") + (F.col("_chance") < F.col("rate") - F.floor("rate")).cast("long")).cast("int")
    taken = row.join(rates, F.col("_of").eqNullSafe(F.col("_source"))).select("_row", F.explode(F.array_repeat(F.lit(0), times)))
    return taken.select([F.col("_row").getField(c).alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words that the mix takes of each document."""
    return copies(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
