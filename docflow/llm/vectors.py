"""Embedding near-duplicates by a forest of random-projection trees.

Each tree splits the vectors at quantiles of a random projection, again and again; the vectors near the split go to
both sides (spill), so close pairs rarely part. The upper levels of the trees are fitted on a bounded sample and
route every vector; what arrives at one node is split further in the task that gets it, down to leaves of bounded
size. Vectors are compared within leaves in double precision, and those with the wanted cosine are united; from a
leaf only the links of a spanning forest leave, not all pairs. The components come from all leaves of all trees.
A pair that nothing else links is found if one tree keeps it together, so the number of trees follows from the depth
and ``RECALL``: pairs at the wanted cosine are made from the sample and sent down trees over it, which gives the share
that a level parts; levels below the sample count as the worst of those measured.
Within a component, vectors are then compared block by block to count each one's links: one row for a vector and
block, never one for a pair, and a component of any size is spread over tasks.

Where the depth asks for more than ``MOST_TREES``, leaves are made larger until it does not, so no recall is given up.

Equal vectors are one node with a weight. Vectors that are null, empty, zero, or hold null or non-finite components link with
nothing; vectors of different lengths don't link with each other. Rows that share an id are told apart by their vectors; rows
with a null id are compared too, but named by null. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import written
from docflow.llm.graph import components

COSINE = 0.9
TREES = 4  # at least
RECALL = 0.999  # share of pairs at COSINE, linked by nothing else, that some tree is to keep together
MOST_TREES = 64  # beyond them leaves grow instead
PROBES = 1024  # such pairs made for a tree that is measured
MEASURED = 4  # trees measured
LEAF = 384  # vectors compared with each other at most
SPILL = 0.12  # share of a node's vectors that goes to both sides
NODE = 6000  # vectors of a node that one task splits further, about
SAMPLE = 40_000  # vectors the upper levels are fitted on, at most
SAMPLE_BYTES = 64 << 20  # and their bytes
BLOCK = 1024  # vectors of a component compared at once


@dataclass(frozen=True)
class Split:
    direction: np.ndarray
    low: float  # up to here, both sides
    high: float  # from here, the right side only
    left: Split | None
    right: Split | None


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cut(x: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float, float]:
    """A random direction, and the quantiles around the median between which vectors go to both sides."""
    direction = rng.normal(size=x.shape[1])
    low, high = np.quantile(x @ direction, [0.5 - SPILL / 2, 0.5 + SPILL / 2])
    return direction, float(low), float(high)


def fit(sample: np.ndarray, depth: int, rng: np.random.Generator) -> Split | None:
    if depth == 0 or len(sample) < 32:
        return None
    direction, low, high = _cut(sample, rng)
    at = sample @ direction
    return Split(direction, low, high, fit(sample[at <= high], depth - 1, rng), fit(sample[at >= low], depth - 1, rng))


def route(tree: Split | None, x: np.ndarray, rows: np.ndarray, name: int = 1):
    """(node, rows) of each node that vectors arrive at."""
    if not len(rows):
        return
    if tree is None:
        yield name, rows
        return
    at = x[rows] @ tree.direction
    yield from route(tree.left, x, rows[at <= tree.high], 2 * name)
    yield from route(tree.right, x, rows[at >= tree.low], 2 * name + 1)


def _probes(sample: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Pairs at ``COSINE``: sample vectors, turned towards other sample vectors in one half and anywhere in the other."""
    x = sample[rng.integers(0, len(sample), PROBES)]
    to = rng.normal(size=x.shape)
    to[::2] = sample[rng.integers(0, len(sample), len(to[::2]))]
    to -= (to * x).sum(1, keepdims=True) * x
    norm = np.linalg.norm(to, axis=1)
    x, to = x[norm > 1e-6], to[norm > 1e-6]
    return x, COSINE * x + np.sqrt(1 - COSINE**2) * _unit(to)


def kept_together(sample: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Share of probe pairs that a tree over ``sample`` holds in one node, for each level from 0 on."""
    x, y = _probes(sample, rng)
    shares, nodes = [1.0], [(sample, np.arange(len(x)))]
    while nodes and len(x):
        below, alive = [], np.zeros(len(x), bool)
        for rows, pairs in nodes:
            direction, low, high = _cut(rows, rng)
            at, a, b = rows @ direction, x[pairs] @ direction, y[pairs] @ direction
            for side, both in ((at <= high, (a <= high) & (b <= high)), (at >= low, (a >= low) & (b >= low))):
                alive[pairs[both]] = True
                below.append((rows[side], pairs[both]))
        shares.append(float(alive.mean()))
        # a level counts as a whole, so no node of the next one may be too small for its quantiles
        nodes = below if min(len(rows) for rows, _ in below) >= 64 else []
    return np.array(shares)


def level_shares(sample: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """``kept_together`` of several trees, averaged."""
    measured = [kept_together(sample, rng) for _ in range(MEASURED)]
    return np.mean([m[:min(map(len, measured))] for m in measured], axis=0)


def survival(sample: np.ndarray, levels: int, rng: np.random.Generator) -> float:
    """Share of pairs at ``COSINE`` that one tree of so many levels holds together."""
    return held_together(level_shares(sample, rng), levels)


def held_together(measured: np.ndarray, levels: int) -> float:
    """``survival`` by shares that were measured; levels below count as the worst of them."""
    shares = measured[:levels + 1]
    worst = (shares[1:] / np.maximum(shares[:-1], 1e-12)).min(initial=1.0)
    return float(shares[-1] * worst ** (levels + 1 - len(shares)))


def n_trees(share: float) -> int:
    """Trees after which a pair that each holds together with probability ``share`` has met with probability ``RECALL``."""
    return TREES if share >= 1 else max(TREES, int(np.ceil(np.log(1 - RECALL) / np.log1p(-max(share, 1e-9)))))


def forest_size(measured: np.ndarray, total: int) -> tuple[int, int]:
    """Trees and the size of their leaves: where ``MOST_TREES`` don't reach the recall, leaves are larger, up to all vectors."""
    leaf = LEAF
    while n_trees(held_together(measured, _levels(total, leaf))) > MOST_TREES:
        leaf *= 2
    return n_trees(held_together(measured, _levels(total, leaf))), leaf


def _levels(total: int, least: int) -> int:
    """Splits until a node of ``total`` vectors has about ``least``."""
    return max(0, int(np.ceil(np.log(max(total, 1) / least) / -np.log(0.5 + SPILL / 2))))


def leaves(x: np.ndarray, rows: np.ndarray, rng: np.random.Generator, least: int):
    """Splits by rank until a leaf is small: equal projections cannot keep a node large."""
    if len(rows) <= least:
        yield rows
        return
    order = rows[np.argsort(x[rows] @ rng.normal(size=x.shape[1]), kind="stable")]
    half, spill = len(order) // 2, max(1, int(len(order) * SPILL / 2))
    yield from leaves(x, order[:half + spill], rng, least)
    yield from leaves(x, order[half - spill:], rng, least)


def _forest_links(x: np.ndarray, rows: np.ndarray, root: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest among the close pairs of a leaf, beyond what ``root`` has united."""
    out = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = int(root[i])
        return i

    for at in range(0, len(rows), BLOCK):  # a part of the leaf against what follows
        part = rows[at:at + BLOCK]
        close = np.triu(x[part] @ x[rows[at:]].T >= COSINE, 1)
        for i in np.flatnonzero(close.any(1)):
            a = find(int(part[i]))
            for j in rows[at:][close[i]].tolist():
                b = find(j)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    a = min(a, b)
                    out.append((int(part[i]), j))
    return out


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def _nodes(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (vec_id, vector bytes or null): the unit vector in double precision where there is one."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))

    def pack(batches):
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                a = np.array(v if v and None not in v else [np.nan], float)
                with np.errstate(over="ignore", invalid="ignore"):
                    norm = np.linalg.norm(a / (np.abs(a).max() or 1))
                    ok = np.isfinite(a).all() and norm > 0
                    out.append((a / np.abs(a).max() / norm).astype("<f8").tobytes() if ok else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "unit"])

    return written(rows.mapInArrow(pack, "vec_id long, unit binary"), "units")


def _tiles(near: DataFrame) -> DataFrame:
    """(node, links) within components: blocks of a component meet block by block."""
    placed = near.withColumn("block", F.xxhash64("node"))
    sizes = near.groupBy("component").agg(F.count("*").alias("members")).withColumn(
        "blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    placed = placed.join(sizes, "component").withColumn("block", F.pmod("block", "blocks").cast("int"))

    def packed(table: pa.Table) -> pa.Table:
        units = b"".join(table["unit"].to_pylist())
        return pa.table({"component": table["component"][:1], "block": table["block"][:1], "blocks": table["blocks"][:1],
                         "nodes": pa.array([table["node"].to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "weights": pa.array([table["weight"].to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "units": pa.array([units], pa.binary())})

    # by both keys: the join above has dealt whole components to tasks
    blocks = written(placed.repartition("component", "block").groupBy("component", "block").applyInArrow(
        packed, "component long, block int, blocks int, nodes binary, weights binary, units binary"), "blocks")
    left = blocks.select("component", "nodes", "units", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    right = blocks.select("component", "block", F.col("nodes").alias("nodes2"), F.col("weights"), F.col("units").alias("units2"))

    def count(batches):
        for batch in batches:
            nodes, links = [], []
            for a, u, b, w, v in zip(*(batch.column(c).to_pylist() for c in ("nodes", "units", "nodes2", "weights", "units2"))):
                a, b, w = (np.frombuffer(k, "<i8") for k in (a, b, w))
                x, y = (np.frombuffer(k, "<f8").reshape(len(n), -1) for k, n in ((u, a), (v, b)))
                close = x @ y.T >= COSINE
                close[a[:, None] == b[None, :]] = False
                nodes.append(a)
                links.append(close @ w)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z) if z else [], pa.int64()) for z in (nodes, links)],
                                             ["node", "links"])

    met = left.join(right, ["component", "block"]).mapInArrow(count, "node long, links long")
    return met.groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 11) -> DataFrame:
    """vec_id, n_links, component_id, kept per row. Vectors of each length are compared among themselves."""
    units, length = _nodes(embeddings, id_col, vector_col), F.octet_length("unit")
    lengths = [r.n for r in units.select(length.alias("n")).distinct().collect()]
    out = units.where("unit is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    for n in sorted(n for n in lengths if n is not None):
        out = out.unionByName(_compared(units.where(length == n), seed))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _compared(units: DataFrame, seed: int) -> DataFrame:
    """vec_id, n_links, component_id of vectors of one length."""
    nodes = units.groupBy("unit").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    total = nodes.count()
    leaf, trees = LEAF, [None] * TREES
    if total > LEAF:
        most = max(LEAF, min(SAMPLE, SAMPLE_BYTES // len(nodes.first().unit)))
        share = min(1.0, most / total)
        drawn = nodes.where(F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(1 << 20)) < int(share * (1 << 20))).select(
            "unit").limit(2 * most)
        sample = np.frombuffer(b"".join(r.unit for r in drawn.collect()), "<f8")
        sample = sample.reshape(-1, len(nodes.first().unit) // 8)
        several, leaf = forest_size(level_shares(sample, np.random.default_rng([seed, 1 << 20])), total)
        depth = _levels(total, max(NODE, leaf))
        trees = [fit(sample, depth, np.random.default_rng([seed, t])) for t in range(several)]
    shared = nodes.sparkSession.sparkContext.broadcast(trees)

    def routed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            ids = batch.column(0)
            for t, tree in enumerate(shared.value):
                for name, rows in route(tree, x, np.arange(len(x))):
                    take = pa.array(rows)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), t, np.int32)), pa.array(
                        np.full(len(rows), name, np.int64)), ids.take(take), batch.column(1).take(take)],
                        ["tree", "place", "node", "unit"])

    def linked(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        x, ids = _matrix(table["unit"]), table["node"].to_numpy()
        key = f"{seed} {table['tree'][0]} {table['place'][0]}".encode()
        rng = np.random.default_rng(int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little"))
        root, found = np.arange(len(x)), []
        for rows in leaves(x, np.arange(len(x)), rng, leaf):
            found += _forest_links(x, rows, root)
        return pa.table({"a": pa.array([ids[i] for i, _ in found], pa.int64()),
                         "b": pa.array([ids[j] for _, j in found], pa.int64())})

    placed = nodes.select("node", "unit").mapInArrow(routed, "tree int, place long, node long, unit binary")
    links = placed.groupBy("tree", "place").applyInArrow(linked, "a long, b long")
    near = components(links)
    near = written(nodes.join(near, nodes["node"] == near["id"]).select("node", "unit", "weight", "least", "component"), "near")
    names = near.groupBy("component").agg(F.min("least").alias("component_id"))
    each = nodes.select("node", F.col("unit").alias("same"), "weight", "least").join(_tiles(near), "node", "left").join(
        near.select("node", "component").join(names, "component").select("node", "component_id"), "node", "left")
    each = each.select("same", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                       F.coalesce("component_id", "least").alias("component_id"))
    out = units.join(each, units["unit"] == each["same"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out
