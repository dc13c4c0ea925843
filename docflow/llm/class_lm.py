"""Class-based n-gram model (Brown): words in classes found by exchange, class transitions and word emissions.

The exchange runs on the bigram counts of the most frequent words (a lexicon of fixed size): each round, every second
word moves to the class where the likelihood of the class bigrams grows most, given all other words; the rounds are
Spark jobs over one row a word. Every other word of the corpus then makes one such move: each block of documents
proposes the best class for its occurrences, and the word goes where most of its occurrences are. Counts, class sizes
and transitions come from all training documents.

p(word | history) = p(class | class before) * n(word) / n(class). Transitions are smoothed towards the class
frequencies; a word that training doesn't have is one symbol whose probability is the share of words seen once
(Good-Turing). The probabilities of all words, the end and the unknown word sum to one.

Words meet their counts in blocks: a block of documents (some megabytes of text) asks for its distinct words, so the
vocabulary is joined by word and never broadcast, and a word a third of all documents have is one row a block.

Null texts count as empty: the end alone. Repeated rows count as often as they occur. Without training documents
every score is that of the unknown symbol; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import documents, id_bucket, utf8, words, written

LEXICON = 4096  # most frequent words, clustered by exchange
CLASSES = 64  # classes of words; the end and the unknown word have one each
ROUNDS = 8
SMOOTH = 20.0  # weight of the class frequencies in a transition row
BLOCK_BYTES = 4 << 20
FLUSH = 1 << 20  # numbers a task gathers before it counts them
PLACES = 1 << 12  # places of words judged at once: a few megabytes, which stay in a core's cache
END, REST = 0, LEXICON + 1  # numbers of the end and of all words outside the lexicon; lexicon words lie between
SIZE = LEXICON + 2


# --- lexicon and its bigrams --------------------------------------------------------------------------------------


def _word_counts(batches):
    """All words of a task with their counts, a word once for each flush."""
    counts: Counter[bytes] = Counter()
    for batch in batches:
        for text in utf8(batch.column(0)):
            counts.update(words(text))
            if len(counts) > FLUSH:
                yield _counted(counts.items())
                counts.clear()
    yield _counted(counts.items())


def _counted(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())],
                                      ["word", "n"])


def _sums(codes: np.ndarray, name: str) -> pa.RecordBatch:
    values, n = np.unique(codes, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(values, pa.int64()), pa.array(n, pa.int64())], [name, "n"])


def _bigrams(index):
    """Counts of (word, next word) as numbers; the end stands before and behind each text."""

    def run(batches):
        number, gathered, size = index.value, [], 0
        for batch in batches:
            for text in utf8(batch.column(0)):
                ids = np.array([END, *map(number.get, words(text), repeat(REST)), END], np.int64)
                gathered.append(ids[:-1] * SIZE + ids[1:])
                size += len(ids)
                if size > FLUSH:
                    yield _sums(np.concatenate(gathered), "pair")
                    gathered, size = [], 0
        if gathered:
            yield _sums(np.concatenate(gathered), "pair")

    return run


# --- exchange -----------------------------------------------------------------------------------------------------


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def _ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and where each row's begin."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _class_counts(classes):
    """A task's share of the class bigrams."""
    n_classes = CLASSES + 2

    def run(batches):
        total = np.zeros(n_classes * n_classes)
        for batch in batches:
            other, at = _ragged(batch.column("next"))
            own = np.repeat(batch.column("w").to_numpy(zero_copy_only=False), np.diff(at))
            pair = classes[own] * n_classes + classes[other.astype(np.int64)]
            total += np.bincount(pair, _ragged(batch.column("n_next"))[0].astype(float), len(total))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])

    return run


def _gains(counts: np.ndarray, own: np.ndarray, n: float) -> np.ndarray:
    """Change of sum x log x when ``own`` (n in all) is added to each row of ``counts``, their sums' change taken off twice."""
    used = np.flatnonzero(own)
    cells = counts[:, used]
    sums = counts.sum(1)
    return (_xlogx(cells + own[used]) - _xlogx(cells)).sum(1) - (_xlogx(sums + n) - _xlogx(sums))


def _moves(classes, counts, turn: int):
    """The best class of each word whose turn it is."""

    def run(batches):
        for batch in batches:
            moved = []
            (after, at), (n_after, _) = _ragged(batch.column("next")), _ragged(batch.column("n_next"))
            (before, to), (n_before, _) = _ragged(batch.column("before")), _ragged(batch.column("n_before"))
            for i, w in enumerate(batch.column("w").to_pylist()):
                if w in (END, REST) or w % 2 != turn % 2:
                    continue
                part, back = slice(at[i], at[i + 1]), slice(to[i], to[i + 1])
                s = np.bincount(classes[after[part]], n_after[part].astype(float), CLASSES + 2)
                p = np.bincount(classes[before[back]], n_before[back].astype(float), CLASSES + 2)
                n, own, rest = s.sum(), classes[w], counts.copy()
                rest[own] -= s
                rest[:, own] -= p
                rest = rest.clip(0)
                gain = _gains(rest, s, n)[:CLASSES] + _gains(rest.T, p, n)[:CLASSES]
                moved.append((w, int(gain.argmax())))
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in moved], pa.int32()),
                                              pa.array([c for _, c in moved], pa.int32())], ["w", "c"])

    return run


def exchange(contexts: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Class of each lexicon number, and the class bigrams, from rows (w, next, n_next, before, n_before).

    The most frequent words start as classes of their own, the others are dealt out by rank.
    """
    classes = (np.arange(SIZE) - 1) % CLASSES
    classes[END], classes[REST] = CLASSES, CLASSES + 1

    def counted() -> np.ndarray:
        parts = contexts.mapInArrow(_class_counts(classes), "counts binary").collect()
        return sum((np.frombuffer(r.counts).reshape(CLASSES + 2, -1) for r in parts), np.zeros((CLASSES + 2, CLASSES + 2)))

    counts = counted()
    for turn in range(2 * rounds):
        moved = {r.w: r.c for r in contexts.mapInArrow(_moves(classes, counts, turn), "w int, c int").collect()}
        changed = [w for w, c in moved.items() if classes[w] != c]
        if not changed and turn:
            break
        for w in changed:
            classes[w] = moved[w]
        counts = counted()
    return classes, counts


# --- blocks -------------------------------------------------------------------------------------------------------


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _numbered(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the word numbers of all texts one after the other, and each text's number of words."""
    index, ids, sizes = _Numbers(), array("q"), []
    for t in texts:
        found = words(t)
        ids.extend(map(index.__getitem__, found))
        sizes.append(len(found))
    return list(index), np.array(ids, np.int64), np.array(sizes, np.int64)


def _proposals(number, classes, counts):
    """A block's distinct words: occurrences in training texts and the class they fit best."""
    sums = np.log(counts.sum(1) + 1.0)
    after = (np.log(counts + 0.1) - sums[:, None])[:CLASSES].T.astype(np.float32)  # [class behind, own class]
    before = (np.log(counts.T + 0.1) - np.log(counts.sum(0) + 1.0)[:, None])[:CLASSES].T.astype(np.float32)

    def run(table: pa.Table) -> pa.Table:
        texts, held = utf8(table["text"].combine_chunks()), np.array(table["held_out"].to_pylist(), bool)
        known, ids, sizes = _numbered(texts)
        in_training = ~np.repeat(held, sizes)
        n = np.bincount(ids[in_training], minlength=len(known))
        lexicon = np.fromiter(map(number.value.get, known, repeat(REST)), np.int64, len(known))
        of = np.concatenate([classes[lexicon[ids]], [CLASSES]]) if len(ids) else np.full(1, CLASSES)
        ends = np.cumsum(sizes)
        left, right = np.concatenate([[CLASSES], of[:-1]])[:len(ids)], of[1:].copy()
        left[(ends - sizes)[sizes > 0]] = CLASSES
        right[(ends - 1)[sizes > 0]] = CLASSES
        vote = classes[lexicon] if known else np.empty(0, np.int64)
        rare = np.flatnonzero(in_training & (lexicon[ids] == REST)) if len(ids) else np.empty(0, np.int64)
        rare = rare[np.argsort(ids[rare], kind="stable")]
        of_rare, begin = ids[rare], 0
        while begin < len(rare):
            # pieces end between words, so each word is judged by all its places in the block
            stop = int(np.searchsorted(of_rare, of_rare[min(begin + PLACES, len(rare)) - 1], "right"))
            part, own = rare[begin:stop], of_rare[begin:stop]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            fits = after[right[part]]
            fits += before[left[part]]
            vote[own[first]] = np.add.reduceat(fits, first).argmax(1)
            begin = stop
        block = table["block"][0].as_py()
        return pa.table({"block": pa.array(np.full(len(known), block, np.int64)), "word": pa.array(known, pa.binary()),
                         "n": pa.array(n, pa.int64()), "vote": pa.array(vote, pa.int32())})

    return run


@dataclass(frozen=True)
class Sizes:
    tokens: int  # training tokens, ends included
    types: int  # distinct training tokens
    ends: int
    once: int
    of_class: np.ndarray


def _sequences(sizes: Sizes):
    """Per document of a block: base score, emissions and the classes of its tokens (END_CLASS last)."""
    floor = math.log10(0.1) - math.log10(sizes.tokens + 0.1 * (sizes.types + 1))
    total = math.log10(sizes.tokens + 0.1 * (sizes.types + 1))
    base_end = math.log10(sizes.ends + 0.1) - total
    of_class = np.log10(np.maximum(sizes.of_class, 1))

    def run(docs: pa.Table, dictionary: pa.Table) -> pa.Table:
        number = {w: i for i, w in enumerate(dictionary["word"].to_pylist())}
        n = np.concatenate([dictionary["n"].to_numpy(), [0]]).astype(float)
        c = np.concatenate([dictionary["c"].to_numpy(), [CLASSES + 1]]).astype(np.uint8)
        base = np.where(n > 0, np.log10(n + 0.1) - total, floor)
        emit = np.log10(np.maximum(n, 1)) - np.where(n > 0, np.append(of_class, [0, 0])[c], 0)
        out = ([], [], [], [], [])
        ids, ends = array("q"), []
        for text in utf8(docs["text"].combine_chunks()) if docs.num_rows else []:
            ids.extend(map(number.get, words(text), repeat(-1)))
            ends.append(len(ids))
        ids = np.array(ids, np.int64)
        known = np.concatenate([[0], np.cumsum(n[ids] > 0)])
        bases, emits, kinds_of, at = base[ids], emit[ids], c[ids], 0
        for end in ends:
            out[0].append(end - at + 1)
            out[1].append(int(known[end] - known[at]) + (sizes.ends > 0))
            out[2].append(float(bases[at:end].sum()) + base_end)
            out[3].append(float(emits[at:end].sum()))
            out[4].append(kinds_of[at:end].tobytes() + bytes([CLASSES]))
            at = end
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
        return pa.table([docs["doc_id"], docs["held_out"], *(pa.array(x, k) for x, k in zip(out, kinds))],
                        ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "emissions", "classes"])

    return run


def _transitions(batches):
    """Counts of class pairs; each text ends with the end's class, which stands before the next."""
    gathered, size = [], 0
    for batch in batches:
        joined = bytes([CLASSES]) + b"".join(batch.column(0).to_pylist())
        seq = np.frombuffer(joined, np.uint8).astype(np.int64)
        gathered.append(np.bincount(seq[:-1] * 256 + seq[1:], minlength=1 << 16))
        size += 1
        if size == 64:
            gathered, size = [sum(gathered)], 1
    if gathered:
        total = sum(gathered)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["pair", "n"])


def _transition_table(counts: np.ndarray, sizes: Sizes) -> np.ndarray:
    """log10 p(class | class before); the unknown word's class is the last."""
    unknown = (sizes.once + 0.5) / (sizes.tokens + 1) if sizes.tokens else 1.0
    known = counts[:-1, :-1]
    share = (known.sum(0) + 1e-9) / (known.sum() + 1e-9 * len(known))
    rows = (known + SMOOTH * share) / (known.sum(1, keepdims=True) + SMOOTH)
    out = np.empty_like(counts)
    out[:-1, :-1], out[-1, :-1], out[:, -1] = rows * (1 - unknown), share * (1 - unknown), unknown
    return np.log10(np.maximum(out, 1e-300))


def _scores(table: np.ndarray):
    def run(batches):
        for batch in batches:
            out = []
            for classes, emissions in zip(batch.column("classes").to_pylist(), batch.column("emissions").to_pylist()):
                seq = np.frombuffer(bytes([CLASSES]) + classes, np.uint8)
                out.append(emissions + float(table[seq[:-1], seq[1:]].sum()))
            keep = [batch.column(k) for k in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(out, pa.float64())], [
                "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score(docs: DataFrame, folds: int = 10, held: int = 0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity per document.

    Trained on the documents whose id does not fall into the held-out fold.
    """
    context = docs.sparkSession.sparkContext
    texts = documents(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                                   (id_bucket("doc_id", folds) == held).alias("held_out"))
    training = texts.where("not held_out").select("text")

    top = training.mapInArrow(_word_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = [bytes(r.word) for r in top.orderBy(F.desc("n"), "word").limit(LEXICON).collect()]
    number = context.broadcast({w: i + 1 for i, w in enumerate(top)})
    pairs = training.mapInArrow(_bigrams(number), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = pairs.select(F.expr(f"cast(pair div {SIZE} as int)").alias("a"), F.expr(f"cast(pair % {SIZE} as int)").alias("b"), "n")
    sides = pairs.select(F.col("a").alias("w"), F.struct("b", "n").alias("next"), F.lit(None).alias("before")).unionByName(
        pairs.select(F.col("b").alias("w"), F.lit(None).alias("next"), F.struct(F.col("a").alias("b"), "n").alias("before")))
    both = sides.groupBy("w").agg(F.collect_list("next").alias("x"), F.collect_list("before").alias("y"))
    contexts = written(both.select("w", F.col("x.b").alias("next"), F.col("x.n").alias("n_next"),
                                   F.col("y.b").alias("before"), F.col("y.n").alias("n_before")), "contexts")
    classes, class_bigrams = exchange(contexts)

    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    placed = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    asked = written(placed.groupBy("block").applyInArrow(
        _proposals(number, classes, class_bigrams), "block long, word binary, n long, vote int"), "asked")
    votes = asked.where("n > 0").groupBy("word", "vote").agg(F.sum("n").alias("n"))
    known = written(votes.groupBy("word").agg(F.max_by("vote", F.struct("n", "vote")).alias("c"), F.sum("n").alias("n")), "vocabulary")
    ends = training.count()
    by_class = known.groupBy("c").agg(F.sum("n").alias("n"), F.count("*").alias("types"),
                                      F.count_if(F.col("n") == 1).alias("once")).collect()
    of_class = np.zeros(CLASSES)
    for r in by_class:
        of_class[r.c] = r.n
    sizes = Sizes(int(of_class.sum()) + ends, sum(r.types for r in by_class) + (ends > 0), ends, sum(r.once for r in by_class), of_class)

    answers = asked.select("block", "word").join(known, "word").select("block", "word", "c", "n")
    schema = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, emissions double, classes binary")
    told = placed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_sequences(sizes), schema)
    told = written(told, "sequences")

    counts = np.zeros((CLASSES + 2, CLASSES + 2))
    seen = told.where("not held_out").select("classes").mapInArrow(_transitions, "pair long, n long")
    for r in seen.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        counts[r.pair // 256, r.pair % 256] = r.n
    table = _transition_table(counts, sizes)
    out = told.withColumn("train_tokens", F.lit(sizes.tokens).cast("long")).mapInArrow(_scores(table), (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
