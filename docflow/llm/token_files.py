"""Token ids as binary files: a concatenated id array with Elias-Fano encoded document boundaries.

Documents are dealt out by ranges of doc_id, so the files in order hold the ids in ascending doc_id order. A file has a
header, the document ids, the boundaries of its documents (Elias-Fano, ``elias_fano``) and the ids as unsigned 16-bit
numbers (32-bit for vocabularies beyond 65,536). A file holds at most ``FILE_BYTES`` of ids, or one document. The
manifest, one row a file, is a table; ``start`` of a document is the sum of the ids of all files before plus its
boundary in the file.

Texts are split where the tokenizer encodes the parts independently (white space, which it drops, and points and commas
behind words), and distinct words are encoded with the tokenizers library; a bounded table keeps the words' ids. Null texts count as empty; an empty text has the end id
alone. Rows that share a doc_id follow each other by text; rows with a null id come first. An empty table makes no files.
Files are written under a name of their own for each task attempt and enter the manifest with the attempt that counts.
"""

from __future__ import annotations

import posixpath
import re
import struct
import uuid
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docflow.llm import elias_fano
from docflow.llm.bpe import tokenizer
from docflow.llm.common import documents, utf8, written
from docflow.session import shared_dir

END_ID = 1
FILE_BYTES = 16 << 20
KNOWN_WORDS = 300_000  # words whose ids a worker keeps; further ones are encoded again
PIECE = 4 << 20  # bytes of text taken at once
READ_TASKS = 10_000
HEAD = "<8sBQQ"  # magic, bytes an id, documents, bytes of the boundaries
MAGIC = b"IDSEF001"
NULL_ID = -(2**63)  # stands for a null document id in a file; also the id it sorts as
SEPARATOR = "\x01"  # a piece of its own and one id; words that hold it are encoded by themselves
# The white space that the tokenizer's own expression drops; Python's str.split() would also split at \x1c-\x1f.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK, ODD = re.compile(f"[{WHITE}]+"), re.compile("[\x1c-\x1f]")
# A point or comma behind a letter or digit is a piece of its own, so the word before it is the same as without.
# The mark comes first in the expression, so the search runs from mark to mark.
MARK = re.compile(rf"([.,])(?<=[^\W_].)(?=[{WHITE}]|\Z)")
# Marks that join the letter before them, in some cases only a small one.
JOINING = re.compile("[\u02be\u0300-\u036f]")


def pieces(raw: bytes) -> list[str]:
    """Parts of a text that the tokenizer encodes independently, A-Z in lower case as it would make them."""
    text = raw.decode()
    if b"<|" not in raw:  # else special tokens, which it finds as they are written
        if text.isascii() or not JOINING.search(text):
            text = raw.lower().decode()
        text = MARK.sub(r" \1", text)
    return [w for w in BLANK.split(text) if w] if ODD.search(text) else text.split()


@lru_cache(maxsize=2)
def known_words(path: str) -> dict[str, bytes]:
    """Ids of words; a Python worker keeps them from task to task."""
    return {}


def encode_words(path: str, found: list[str], kind: str) -> dict[str, bytes]:
    """The library's ids of each word, some hundred words at a time with separators between them."""
    encode = tokenizer(path).encode_batch_fast
    odd = [w for w in found if SEPARATOR in w]
    plain = [w for w in found if SEPARATOR not in w] if odd else found
    out = {w: np.array(e.ids, kind).tobytes() for w, e in zip(odd, encode(odd, add_special_tokens=False))}
    (separator,) = encode([SEPARATOR], add_special_tokens=False)[0].ids
    for start in range(0, len(plain), 256):
        group = plain[start:start + 256]
        ids = np.array(encode([f" {SEPARATOR} ".join(group)], add_special_tokens=False)[0].ids, kind)
        ends = [*np.flatnonzero(ids == separator).tolist(), len(ids)]
        data, width, at = ids.tobytes(), ids.itemsize, 0
        for word, end in zip(group, ends, strict=True):
            out[word] = data[at * width:end * width]
            at = end + 1
    return out


def _ids(path: str, end_id: int):
    def run(batches):
        known = known_words(path)
        kind = "<u4" if tokenizer(path).get_vocab_size() > 65_536 else "<u2"
        end = np.array([end_id], kind).tobytes()
        for batch in batches:
            docs, raws, at = batch.column(0), utf8(batch.column(1)), 0
            while at < len(raws):
                size, stop = 0, at
                while stop < len(raws) and size < PIECE:
                    size += len(raws[stop])
                    stop += 1
                texts = [pieces(raw) for raw in raws[at:stop]]
                found = dict.fromkeys(chain.from_iterable(texts))
                made = encode_words(path, [w for w in found if w not in known], kind)
                if len(known) + len(made) <= KNOWN_WORDS:
                    known.update(made)
                made.update((w, known[w]) for w in found if w in known)
                out = [b"".join(map(made.__getitem__, t)) + end for t in texts]
                yield pa.RecordBatch.from_arrays([docs.slice(at, stop - at), pa.array(out, pa.binary()), pa.array(
                    [int(kind[2])] * len(out), pa.int32())], ["doc_id", "ids", "width"])
                at = stop

    return run


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    """Any store that pyarrow knows; a path without a scheme is a shared local folder."""
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


def _write(folder: str):
    """One manifest row (path, first_id, part, number, documents, ids) for each file of a sorted partition."""

    def run(batches):
        store, base = _place(folder)
        part, number = TaskContext.get().partitionId(), 0
        docs, ids, size, width = [], [], 0, 2

        def flush():
            ends = np.cumsum([len(x) // width for x in ids], dtype=np.uint64)
            name = f"{part:08d}-{number:06d}-{uuid.uuid4().hex}.ids"
            bounds = elias_fano.encode(np.concatenate([[0], ends]).astype(np.uint64))
            with store.open_output_stream(posixpath.join(base, name)) as f:
                f.write(struct.pack(HEAD, MAGIC, width, len(docs), len(bounds)))
                f.write(np.array([NULL_ID if d is None else d for d in docs], "<i8").tobytes())
                f.write(bounds)
                for x in ids:
                    f.write(x)
            return pa.RecordBatch.from_arrays([
                pa.array([name]), pa.array([part], pa.int32()), pa.array([number], pa.int32()),
                pa.array([len(docs)], pa.int64()), pa.array([int(ends[-1])], pa.int64())],
                ["name", "part", "number", "documents", "ids"])

        for batch in batches:
            for doc, x, w in zip(*(c.to_pylist() for c in batch.columns)):
                if docs and size + len(x) > FILE_BYTES:
                    yield flush()
                    docs, ids, size, number = [], [], 0, number + 1
                docs.append(doc)
                ids.append(x)
                size, width = size + len(x), w
        if docs:
            yield flush()

    return run


def write(docs: DataFrame, path: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Write the files to ``folder`` (one that all executors share); returns the stored manifest."""
    store, base = _place(folder)
    store.create_dir(base)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    texts = documents(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranged = texts.repartitionByRange(*order).sortWithinPartitions(*order, "text")  # texts: sampling must not encode
    made = ranged.mapInArrow(_ids(path, end_id), "doc_id long, ids binary, width int")
    return written(made.mapInArrow(_write(folder), "name string, part int, number int, documents long, ids long"), "manifest")


class TokenFile:
    """One file: ``boundaries`` selects in place, ``ids(i)`` reads one document's ids from the store."""

    def __init__(self, source: pa.NativeFile):
        self.source = source
        magic, self.width, self.n, size = struct.unpack(HEAD, source.read(struct.calcsize(HEAD)))
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.doc_ids = np.frombuffer(source.read(8 * self.n), "<i8")
        self.boundaries = elias_fano.Sequence(source.read(size))
        self.begin = struct.calcsize(HEAD) + 8 * self.n + size

    def ids(self, i: int) -> np.ndarray:
        start, end = self.boundaries[i], self.boundaries[i + 1]
        self.source.seek(self.begin + start * self.width)
        return np.frombuffer(self.source.read((end - start) * self.width), f"<u{self.width}")


def _read(folder: str):
    def run(batches):
        store, base = _place(folder)
        for batch in batches:
            for name, before in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(posixpath.join(base, name)) as source:
                    file, out = TokenFile(source), ([], [], [], [])
                    for i, doc in enumerate(file.doc_ids.tolist()):
                        ids = file.ids(i)
                        out[0].append(None if doc == NULL_ID else doc)
                        out[1].append(before + file.boundaries[i])
                        out[2].append(len(ids))
                        out[3].append(zlib.crc32(ids.astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out],
                                                 ["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, from the files.

    The running sum over the manifest has one row a file: the files of a partition are summed first.
    """
    parts = manifest.groupBy("part").agg(F.sum("ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("before_part"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    tasks = max(1, min(manifest.count(), READ_TASKS))
    files = manifest.withColumn("before", F.coalesce(F.sum("ids").over(within), F.lit(0))).join(parts, "part")
    return files.select("name", (F.col("before") + F.col("before_part")).alias("before")).repartition(tasks, "name").mapInArrow(
        _read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Write all documents to a new folder beside the checkpoints and read them back."""
    folder = f"{shared_dir(docs.sparkSession).rstrip('/')}/docflow/token-files-{uuid.uuid4().hex}"
    return read(write(docs, path, folder), folder)
