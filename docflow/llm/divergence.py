"""Source divergence audit: how the sources of a language differ in their terms, by Gustavson row accumulation.

Terms are runs of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]``, A-Z in lower case. A language keeps the V terms in at least ``LEAST``
of its documents. A group (language, source), and the language itself, gives each kept term
p = 1 + floor(SCALE * (count + 2) / (N + 2 V)), N being its occurrences of kept terms; two of them differ at a term by
floor((p - q)^2 / (p + q)). Arithmetic is exact: decimals for p, 64-bit integers for differences.

``pairs``: for all pairs of groups of a language the sum over all kept terms. The postings (term: groups and their p) are
dealt out in blocks of terms, so each block is a term-major index. In a block, each group scatters its terms through
the postings into a dense accumulator over its peers, so no pair of postings is ever a row. Only terms that both have are
met there; what they would give against the other's baseline (the p of count 0) is taken off again, and the baselines of all terms
are added from each group's distinct values, of which there are few. Every block gives whole sums over its terms, and blocks add up.
``prominent``: the terms that a group has more than its language, by value, ranks to ``TOP``.

Null texts, languages and sources are read as ''. A group without terms takes part with baselines; with V = 0 all pairs are 0; a
group alone in its language has no pairs. Empty tables give empty tables; columns besides those read may have any name.

Occurrences and documents are counted per task before the shuffle. A language with a third of all rows is many blocks;
a block has about ``POSTINGS`` postings, at least as many as it has accumulators, and where groups are many they are dealt
out in tiles of accumulators too, so a task never holds all pairs. The result itself has a row per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docflow.llm.common import small, utf8, written

LEAST = 10
SCALE = 1_000_000_000
TOP = 10
POSTINGS = 500_000  # postings of a block of terms
CELLS = 4_000_000  # accumulators of a task
KNOWN = 200_000  # terms counted in a task before they are handed on

LETTERS = np.full(256, 0x20, np.uint8)
LETTERS[0x80:] = np.arange(0x80, 0x100)
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
LETTERS = LETTERS.tobytes()


def _counted(batches):
    """Occurrences and documents of the terms of each (lang, source), added up until ``KNOWN`` terms are held."""
    groups: dict[tuple[bytes, bytes], dict[bytes, list[int]]] = {}
    held = 0

    def flush():
        for (lang, source), terms in groups.items():
            n = len(terms)
            keys = [pa.array([x] * n, pa.binary()).cast(pa.string()) for x in (lang, source)]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(list(terms), pa.binary()).cast(pa.string()), pa.array([v[0] for v in terms.values()], pa.int64()),
                 pa.array([v[1] for v in terms.values()], pa.int64())], ["lang", "source", "term", "n", "docs"])
        groups.clear()

    for batch in batches:
        for lang, source, text in zip(*map(utf8, batch.columns)):
            terms = groups.setdefault((lang, source), {})
            before = len(terms)
            own: dict[bytes, int] = {}
            for term in text.translate(LETTERS).split():
                own[term] = own.get(term, 0) + 1
            for term, n in own.items():
                if term in terms:
                    counts = terms[term]
                    counts[0] += n
                    counts[1] += 1
                else:
                    terms[term] = [n, 1]
            held += len(terms) - before
            if held > KNOWN:
                yield from flush()
                held = 0
    yield from flush()


def probability(count: Column, total: Column, kept: Column) -> Column:
    share = (count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", share, (total + 2 * kept).cast("decimal(20,0)")) + 1


def difference(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); p and q are at most SCALE + 1, so the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def index(docs: DataFrame) -> DataFrame:
    """The kept terms, stored: lang, term, total, postings (source, n). A term has a posting per source of its language."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    partial = texts.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    counts = partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("postings"))
    return written(terms.where(F.col("docs") >= LEAST).drop("docs"), "index")


def groups(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """One stored row per group: lang, source, number in its language, total, and the language's total, kept terms (kept),
    groups (peers), blocks and tiles of accumulators. The numbering sorts the sources of a language, of which the result has all pairs.
    """
    there = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    rows = terms.select("lang", F.explode("postings").alias("p"))
    own = rows.groupBy("lang", F.col("p.source").alias("source")).agg(F.sum("p.n").alias("total"))
    langs = terms.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count("*").alias("kept"), F.sum(F.size("postings")).alias("postings"))
    all_peers = there.groupBy("lang").agg(F.count("*").alias("peers"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("lang_total", "kept", "postings")]
    sizes = all_peers.join(langs, "lang", "left").select("lang", "peers", *zero)
    wide = F.least("peers", F.greatest(F.lit(1), F.floor(F.lit(CELLS) / F.col("peers"))))  # groups of a tile
    least = F.greatest(F.lit(POSTINGS), F.col("peers") * F.col("wide"))
    sizes = sizes.withColumn("wide", wide).withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("postings") / least))).withColumn(
        "tiles", F.ceil(F.col("peers") / F.col("wide")))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    out = there.join(own, ["lang", "source"], "left").join(sizes, "lang").select(
        "lang", "source", number.alias("number"), F.coalesce("total", F.lit(0)).alias("total"), "lang_total", "kept", "peers",
        "wide", "blocks", "tiles")
    return written(out, "groups")


def _p(count: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """As ``probability``, in two steps that fit 64 bits up to 9 * 10^13 occurrences."""
    whole, rest = np.divmod((count + 2) * 100_000, total + 2 * kept)
    return 1 + whole * (SCALE // 100_000) + rest * (SCALE // 100_000) // (total + 2 * kept)


def _f(p, q):
    return (p - q) * (p - q) // (p + q)


def _against_baselines(values: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """Sum of f(value, baseline) over ``values`` for each baseline, by distinct values."""
    distinct, times = np.unique(values, return_counts=True)
    out, step = np.zeros(len(zero), np.int64), max(1, CELLS // max(1, len(zero)))
    for at in range(0, len(distinct), step):
        out += times[at:at + step] @ _f(distinct[at:at + step, None], zero[None])
    return out


def accumulate(starts: np.ndarray, peer: np.ndarray, p: np.ndarray, zero: np.ndarray, tile: range) -> np.ndarray:
    """Sums over a block's terms between the groups of ``tile`` and all groups.

    Term t has the postings starts[t]:starts[t + 1] of ``peer`` (group) and ``p``; ``zero`` is every group's baseline.
    """
    n, term = len(zero), np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.argsort(peer, kind="stable")
    begins = np.searchsorted(peer[order], np.arange(n + 1))
    has = np.diff(begins)
    inside = zero[tile.start:tile.stop]
    out = np.zeros((len(tile), n), np.int64)
    for h in range(n):  # terms of h against the baselines of the tile's groups
        out[:, h] = _against_baselines(p[order[begins[h]:begins[h + 1]]], inside)
    for row, g in enumerate(tile):
        mine = order[begins[g]:begins[g + 1]]
        lengths = starts[term[mine] + 1] - starts[term[mine]]
        met = np.arange(lengths.sum()) + np.repeat(starts[term[mine]] - np.cumsum(lengths) + lengths, lengths)
        other, theirs, ours = peer[met], p[met], np.repeat(p[mine], lengths)
        more = _f(ours, theirs) - _f(ours, zero[other]) - _f(zero[g], theirs) + _f(zero[g], zero[other])
        scattered = np.bincount(other, weights=more, minlength=n)  # whole numbers below 2^53
        neither = (len(starts) - 1 - has[g] - has) * _f(zero[g], zero)
        out[row] += np.rint(scattered).astype(np.int64) + neither + _against_baselines(p[mine], zero)
    return out


def _block(key, terms: pa.Table, peers: pa.Table) -> pa.Table:
    lang, tile = key[0].as_py(), key[1].as_py()
    peers = peers.sort_by("number")
    total, kept, wide = peers["total"].to_numpy(), peers["kept"][0].as_py(), peers["wide"][0].as_py()
    n = len(total)
    part = range(tile * wide, min(n, (tile + 1) * wide))
    if not len(terms):
        sums = np.zeros((len(part), n), np.int64)
    else:
        lists = terms["postings"].combine_chunks()
        flat = lists.flatten()
        peer = pa.compute.index_in(flat.field("source"), value_set=peers["source"].combine_chunks()).to_numpy().astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy())]).astype(np.int64)
        p = _p(flat.field("n").to_numpy(), total[peer], kept)
        sums = accumulate(starts, peer, p, _p(np.zeros(n, np.int64), total, kept), part)
    values = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * n, pa.int32()), pa.array(sums.ravel()))
    return pa.table({"lang": pa.array([lang] * len(part)), "number": pa.array(part, pa.int32()), "sums": values})


def pairs(terms: DataFrame, of: DataFrame) -> DataFrame:
    """lang, source, item, value for all pairs of groups of a language, both ways."""
    key = ["lang", "tile", "block"]
    plan = small(of.select("lang", "blocks", "tiles").distinct())
    tiles, blocks = (F.explode(F.sequence(F.lit(0), F.col(c).cast("int") - 1)) for c in ("tiles", "blocks"))
    dealt = terms.join(plan, "lang").withColumn("block", F.pmod(F.xxhash64("term"), "blocks").cast("int")).withColumn("tile", tiles)
    peers = of.withColumn("tile", tiles).withColumn("block", blocks)
    sums = dealt.select(*key, "postings").groupBy(*key).cogroup(
        peers.select(*key, "source", "number", "total", "kept", "wide").groupBy(*key)).applyInArrow(
        _block, "lang string, number int, sums array<long>")
    added = sums.select("lang", "number", F.posexplode("sums").alias("peer", "value")).where("number <> peer").groupBy(
        "lang", "number", "peer").agg(F.sum("value").alias("value"))
    names = small(of.select("lang", "number", "source"))
    theirs = names.select("lang", F.col("number").alias("peer"), F.col("source").alias("item"))
    return added.join(names, ["lang", "number"]).join(small(theirs), ["lang", "peer"]).select("lang", "source", "item", "value")


def prominent(terms: DataFrame, of: DataFrame) -> DataFrame:
    """lang, source, item, value of each term that a group has more than its language."""
    rows = terms.select("lang", F.col("term").alias("item"), F.col("total").alias("all"), F.explode("postings").alias("p"))
    rows = rows.select("lang", "item", "all", "p.source", "p.n").join(small(of), ["lang", "source"])
    p, q = probability(F.col("n"), F.col("total"), F.col("kept")), probability(F.col("all"), F.col("lang_total"), F.col("kept"))
    rows = rows.select("lang", "source", "item", p.alias("p"), q.alias("q")).where("p > q")
    return rows.select("lang", "source", "item", difference(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, part ('pair', 'term'), item, value, rank."""
    terms = index(docs)
    of = groups(docs, terms)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")).alias("rank")

    def part(name: str, rows: DataFrame) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", rank)

    return part("pair", pairs(terms, of)).unionByName(part("term", prominent(terms, of)).where(F.col("rank") <= top))
