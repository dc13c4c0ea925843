"""BPE encoding and decoding with content-defined chunks that are encoded once.

A rolling hash over the bytes of a text cuts it into chunks; where two documents share a passage, their cuts fall on
the same places. Chunks travel to the task that owns their digest, are encoded there once with the tokenizers
library, and return to each block of documents that has them. Encoding chunk by chunk is wrong only around the
joins. There the ids are given up back to the last place before the join and on to the first place behind it where
every encoding of the text must break (a blank between two visible ASCII characters starts a new piece whatever
stands around it), and the text between is encoded again; a chunk without such a place becomes part of that text, so
the stretch grows until both ends agree.

Digests are counted first. Those that more than one document has are kept in a filter of fixed size; a digest that
passes by chance costs work, not correctness. A document without a shared chunk is encoded whole where it is read.
Rows between the stages are chunks (a hot chunk: one row for each block of documents that has it) and documents (a
list of digests), so nothing grows with the number of documents that share a chunk. Blocks are numbered by scan
task: the input must be a stored table, or anything else that gives the same rows when a task runs again.

Null texts count as empty; empty texts have no ids. Each row is encoded for itself, also when ids repeat or are null.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import documents, utf8
from docflow.llm.hashing import joined

LEAST, MEAN_BITS, MOST = 256, 10, 8192  # bytes of a chunk: at least, 2^n between cuts, at most
BLOCK_BYTES = 2 << 20  # text of a block of documents
GROUP_BYTES = 1 << 19  # text that the library encodes at once
NEAR = 48  # tokens looked at first for a safe place
SAFE = re.compile(rb"(?<=[!-~]) (?=[!-~])")
# The same places, also beside characters of U+00C0 to U+00FF, none of which is white space, and between a letter and a mark.
UNIT = re.compile(rb"(?<=[!-~])(?= [!-~\xc3])|(?<=\xc3[\x80-\xbf])(?= [!-~\xc3])|(?<=[A-Za-z])(?=[.,;:!?])|(?<=\xc3[\x98-\xb6])(?=[.,;:!?])")
UNITS = 4096  # units encoded at once
KNOWN_UNITS, UNIT_BYTES = 200_000, 64  # units whose ids a worker keeps, and their longest
ROWS = "key binary, block long, kind int, doc_id long, payload binary"
CHUNK, DOCUMENT = 0, 1
RESULT = ["doc_id", "ids", "decoded"]
FILTER_BITS, SLICE_BITS, PROBES = 26, 17, 4  # bits of the filter of shared digests (2^n), of its slices, set a digest


def cuts(data: np.ndarray) -> np.ndarray:
    """Places after which the rolling hash of the last 16 bytes asks for a cut, never inside a character."""
    h = data.astype(np.uint32)
    factor = 0x01000193
    for step in (1, 2, 4, 8):
        h[step:] = h[step:] + np.uint32(factor) * h[:-step].copy()
        factor = factor * factor % 2**32
    h *= np.uint32(0x9E3779B1)
    asked = (h >> np.uint32(32 - MEAN_BITS)) == 0
    asked[:-1] &= (data[1:] & 0xC0) != 0x80
    return np.flatnonzero(asked) + 1


def chunked(texts: list[bytes]) -> list[list[bytes]]:
    """The chunks of each text."""
    data, starts = joined(texts)
    places = cuts(data)
    out = []
    for text, start in zip(texts, starts.tolist()):
        asked = places[np.searchsorted(places, start + LEAST):np.searchsorted(places, start + len(text))] - start
        chunks, at = [], 0
        for cut in [*asked.tolist(), len(text)]:
            while cut - at > MOST:
                end = at + MOST
                while text[end] & 0xC0 == 0x80:
                    end -= 1
                chunks.append(text[at:end])
                at = end
            if cut - at >= LEAST or cut == len(text) and cut > at:
                chunks.append(text[at:cut])
                at = cut
        out.append(chunks)
    return out


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
    columns = zip(*rows) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      ["key", "block", "kind", "doc_id", "payload"])


def _pieces(batches):
    """(ids, chunks of each text, digests of each text), some texts at a time."""
    for batch in batches:
        ids, texts, at = batch.column(0).to_pylist(), utf8(batch.column(1)), 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and size < BLOCK_BYTES:
                size += len(texts[end])
                end += 1
            chunks = chunked(texts[at:end])
            yield ids[at:end], chunks, [[hashlib.blake2b(c, digest_size=16).digest() for c in cs] for cs in chunks], size
            at = end


def _digests(batches):
    """Each document's distinct digests."""
    for _, _, keys, _ in _pieces(batches):
        yield pa.RecordBatch.from_arrays([pa.array([k for ks in keys for k in dict.fromkeys(ks)], pa.binary())], ["key"])


def _bits(keys: list[bytes]) -> np.ndarray:
    """The filter's bits for each digest."""
    halves = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    return (halves[:, :1] + np.arange(PROBES, dtype=np.uint64) * (halves[:, 1:] | np.uint64(1))) >> np.uint64(64 - FILTER_BITS)


def _filter_slices(batches):
    """The task's share of the filter, slice by slice."""
    mask = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for batch in batches:
        if batch.num_rows:
            at = _bits(batch.column(0).to_pylist()).ravel().astype(np.int64)
            np.bitwise_or.at(mask, at >> 3, (128 >> (at & 7)).astype(np.uint8))
    for i, part in enumerate(mask.reshape(-1, 1 << SLICE_BITS - 3)):
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([zstandard.compress(part.tobytes(), 1)], pa.binary())],
                                             ["slice", "bits"])


def _united(table: pa.Table) -> pa.Table:
    parts = [np.frombuffer(zstandard.decompress(b), np.uint8) for b in table["bits"].to_pylist()]
    bits = zstandard.compress(np.bitwise_or.reduce(parts).tobytes(), 1)
    return pa.table({"slice": table["slice"][:1], "bits": pa.array([bits], pa.binary())})


def shared_filter(texts: DataFrame) -> np.ndarray:
    """Bits of the digests that more than one document has; of fixed size, united in two levels."""
    keys = texts.mapInArrow(_digests, "key binary").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    parts = keys.mapInArrow(_filter_slices, "slice int, bits binary").withColumn("part", F.xxhash64("bits") % 32)
    for group in (["slice", "part"], ["slice"]):
        parts = parts.groupBy(*group).applyInArrow(_united, "slice int, bits binary")
    out = np.zeros((1 << FILTER_BITS - SLICE_BITS, 1 << SLICE_BITS - 3), np.uint8)
    for r in parts.collect():
        out[r.slice] = np.frombuffer(zstandard.decompress(r.bits), np.uint8)
    return out.ravel()


def _has_shared(bits: np.ndarray, keys: list[list[bytes]]) -> list[bool]:
    """Whether any digest of each text passes the filter."""
    flat = [k for ks in keys for k in ks]
    if not flat:
        return [False] * len(keys)
    at = _bits(flat).astype(np.int64)
    hit = ((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(1)
    owner = np.repeat(np.arange(len(keys)), [len(ks) for ks in keys])
    return (np.bincount(owner, hit, len(keys)) > 0).tolist()


def _whole(path: str, bits):
    """Documents without a shared chunk, encoded where they are read."""

    def run(batches):
        for ids, chunks, keys, _ in _pieces(batches):
            alone = [i for i, shared in enumerate(_has_shared(bits.value, keys)) if not shared]
            yield _results(path, [ids[i] for i in alone], encode(path, [b"".join(chunks[i]) for i in alone]))

    return run


def _cut_up(bits):
    """Distinct chunks of each block of documents, compressed, and each document's list of digests."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        task, number, filled, met = TaskContext.get().partitionId(), 0, 0, set()
        for ids, chunks, keys, size in _pieces(batches):
            if filled >= BLOCK_BYTES:
                number, filled, met = number + 1, 0, set()
            filled += size
            block, out = (task << 32) + number, []
            for i, shared in enumerate(_has_shared(bits.value, keys)):
                if not shared:
                    continue
                for key, chunk in zip(keys[i], chunks[i]):
                    if key not in met:
                        met.add(key)
                        out.append((key, block, CHUNK, None, pack(chunk)))
                spread = hashlib.blake2b(f"{block} {len(out)}".encode(), digest_size=8).digest()
                out.append((spread, block, DOCUMENT, ids[i], b"".join(keys[i])))
            yield _rows(out)

    return run


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


@lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[list[bytes], np.ndarray]:
    """The bytes of each id of a byte-level vocabulary, and their number."""
    with open(path, encoding="utf-8") as f:
        stored = json.load(f)
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*visible}))}
    names = {i: bytes(byte_of[c] for c in name) for name, i in stored["model"]["vocab"].items()}
    names |= {t["id"]: t["content"].encode() for t in stored["added_tokens"]}
    table = [names.get(i, b"") for i in range(max(names) + 1)]
    return table, np.array([len(t) for t in table])


@lru_cache(maxsize=2)
def known_units(path: str) -> dict[bytes, bytes]:
    """Ids of units of text; a Python worker keeps them from task to task."""
    return {}


def encode(path: str, texts: list[bytes]) -> list[np.ndarray]:
    """Ids of each text. A text is cut into units before blanks that begin a piece whatever stands around them, and the
    library encodes distinct units, about ``GROUP_BYTES`` of text at a time."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    known, out, at = known_units(path), [], 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and size < GROUP_BYTES:
            size += len(texts[end])
            end += 1
        units = [UNIT.split(t) for t in texts[at:end]]
        made = {u: known.get(u) for u in dict.fromkeys(chain.from_iterable(units))}
        fresh = [u for u, ids in made.items() if ids is None]
        for i in range(0, len(fresh), UNITS):
            group = fresh[i:i + UNITS]
            found = tokenizer(path).encode_batch_fast([u.decode() for u in group], add_special_tokens=False)
            made.update((u, np.array(e.ids, "<u4").tobytes()) for u, e in zip(group, found))
        if len(known) + len(fresh) <= KNOWN_UNITS:
            known.update((u, made[u]) for u in fresh if len(u) <= UNIT_BYTES)
        out += [np.frombuffer(b"".join([made[u] for u in us]), "<u4") for us in units]
        at = end
    return out


def decode(path: str, ids: np.ndarray) -> bytes:
    table = token_bytes(path)[0]
    return b"".join([table[i] for i in ids.tolist()])


def _packed(ids: np.ndarray) -> bytes:
    """Low and high bytes apart; the high halves of 16-bit ids cost nothing."""
    return zstandard.compress(np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def _encoded(path: str):
    """Rows sorted by digest: each chunk's text becomes its ids, made once however many blocks want it."""

    def run(batches):
        unpack, last, ids = zstandard.ZstdDecompressor().decompress, None, b""
        for batch in batches:
            rows, at = list(zip(*(c.to_pylist() for c in batch.columns))), 0
            while at < len(rows):
                wanted, size, end = {}, 0, at
                while end < len(rows) and size < GROUP_BYTES:
                    key, _, kind, _, payload = rows[end]
                    if kind == CHUNK and key != last and key not in wanted:
                        wanted[key] = unpack(payload)
                        size += len(wanted[key])
                    end += 1
                made = dict(zip(wanted, map(_packed, encode(path, list(wanted.values())))))
                if last is not None:
                    made[last] = ids
                out = []
                for key, block, kind, doc, payload in rows[at:end]:
                    if kind == CHUNK:
                        last, ids = key, made[key]
                        payload = ids
                    out.append((key, block, kind, doc, payload))
                yield _rows(out)
                at = end

    return run


def _results(path: str, docs: list, made: list[np.ndarray]) -> pa.RecordBatch:
    made = [ids.astype("<u4") for ids in made]
    texts = [decode(path, ids).decode("utf-8", "replace") for ids in made]
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array([x.tobytes() for x in made], pa.binary()),
                                       pa.array(texts, pa.string())], RESULT)


def _safe(path: str, ids: np.ndarray, from_end: bool) -> tuple[int, bytes] | None:
    """The last (or first) token that starts at a safe place, and the bytes behind it (or before it)."""
    lengths = token_bytes(path)[1]
    for part in (ids[-NEAR:] if from_end else ids[:NEAR], ids):
        text = decode(path, part)
        places = [m.start() for m in SAFE.finditer(text)]
        starts = np.concatenate([[0], np.cumsum(lengths[part])])
        for place in reversed(places) if from_end else places:
            token = int(np.searchsorted(starts, place))
            if starts[token] == place:  # else this encoding does not break here: no agreement, look further
                return (len(ids) - len(part) + token, text[place:]) if from_end else (token, text[:place])
        if len(part) == len(ids):
            return None
    return None


def _repaired(path: str, chunks: list[np.ndarray]) -> list[np.ndarray | bytes]:
    """Ids that stand, and between them the texts to encode again."""
    if len(chunks) < 2:
        return list(chunks)
    out, window = [], b""
    for i, ids in enumerate(chunks):
        begin = (0, b"") if i == 0 else _safe(path, ids, False)
        if begin is None:
            window += decode(path, ids)
            continue
        if i:
            out.append(window + begin[1])
        if i == len(chunks) - 1:
            out.append(ids[begin[0]:])
            return out
        end = _safe(path, ids, True)
        if end is None:
            window = decode(path, ids)
        else:
            out.append(ids[begin[0]:end[0]])
            window = end[1]
    out.append(window)
    return out


def _assembled(path: str):
    """Rows sorted by block, chunks first: the ids of each document, and their text."""

    def finished(docs: list, parts: list) -> pa.RecordBatch:
        again = iter(encode(path, [x for p in parts for x in p if isinstance(x, bytes)]))
        made = []
        for p in parts:
            ids = [next(again) if isinstance(x, bytes) else x for x in p]
            made.append(np.concatenate(ids) if ids else np.empty(0))
        return _results(path, docs, made)

    def run(batches):
        block, known = None, {}
        for batch in batches:
            docs, parts, size = [], [], 0
            for key, of, kind, doc, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if of != block:
                    block, known = of, {}
                if kind == CHUNK:
                    known[key] = _unpacked(payload)
                    continue
                docs.append(doc)
                parts.append(_repaired(path, [known[payload[i:i + 16]] for i in range(0, len(payload), 16)]))
                size += sum(map(len, parts[-1]))
                if size >= GROUP_BYTES:  # ids, each of some bytes of text
                    yield finished(docs, parts)
                    docs, parts, size = [], [], 0
            yield finished(docs, parts)

    return run


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Per row: doc_id, ids (little-endian 32-bit numbers), decoded (the text made from the ids)."""
    texts, schema = documents(docs), "doc_id long, ids binary, decoded string"
    bits = texts.sparkSession.sparkContext.broadcast(shared_filter(texts))
    cut = texts.mapInArrow(_cut_up(bits), ROWS)
    made = cut.repartition("key").sortWithinPartitions("key").mapInArrow(_encoded(path), ROWS)
    home = made.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(_assembled(path), schema)
    return texts.mapInArrow(_whole(path, bits), schema).unionByName(home)


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return round_trip(docs, path).select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
