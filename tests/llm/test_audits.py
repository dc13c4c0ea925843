"""Conversation repair, source divergence and source mixing on small awkward tables, against brute force and SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from docflow.llm import conversations, divergence, mixing, oracles
from docflow.llm.common import prepare

TURNS = "conv_id long, turn long, role string, text string, gone string, row long, fault string"
DOCS = "doc_id long, text string, lang string, source string, number long, rate double, value string, size string"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def same_as_sql(df, sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, rows.toArrow())
    rel = con.sql(sql)
    assert df.columns == rel.columns
    assert Counter(map(tuple, df.collect())) == Counter(rel.fetchall())


# --- conversations --------------------------------------------------------------------------------------------------


def turns():
    rng = random.Random(8)
    rows = []
    for conv in [None, *range(40)]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "Ümit", "uncle"])
            text = rng.choice(["Yes.", "No!", "a?", "cut off", "", None, " \t\n", "same.", "same.", "ends. \x0b", "é…", "x" * 3000 + "."])
            rows.append((conv, rng.choice([None, turn * 2, turn, turn]), role, text))
    rows += rows[:7] + [(99, None, None, None)] * 3 + [(98, t, "user", "ok.") for t in range(30)]
    return [(*r, "text", None, "blank") for r in rows]


@pytest.fixture(scope="module")
def table(spark):
    return prepare(spark).createDataFrame(turns(), TURNS).drop("gone", "row")


def repaired_by_trying(rows):
    """The contract over one conversation's rows, all edits tried in a plain dynamic program over (kept roles, audit)."""
    white = " \t\n\x0b\f\r"
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(white)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
    paths = {"": (0, "", ())}  # by the initials so far
    legal = re.compile("(s?(ua)*u?)?")

    def insert(paths):
        for _ in range(2):
            for key, (cost, audit, out) in list(paths.items()):
                for role in ("user", "assistant"):
                    put(paths, key + role[0], cost + 2, audit + "I", (*out, (role, "")))

    def put(paths, key, cost, audit, out):
        if legal.fullmatch(key):
            if key not in paths or (cost, audit) < paths[key][:2]:
                paths[key] = cost, audit, out

    for (_, role, text), fault in zip(rows, faults):
        insert(paths)
        now = {}
        for key, (cost, audit, out) in paths.items():
            put(now, key, cost + 3, audit + "D", out)
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                if role:
                    put(now, key + role[0], cost + cut, audit + "K", (*out, (role, text)))
                for new in ("user", "assistant"):
                    put(now, key + new[0], cost + cut + 2, audit + "R", (*out, (new, text)))
        least = min(v[0] for v in now.values())
        paths = {k: v for k, v in now.items() if v[0] <= least + 8}
    insert(paths)
    cost, audit, out = min(v for k, v in paths.items() if re.fullmatch("(s?(ua)+)?", k))
    initials = [r[1][:1] for r in rows]
    known = [r[0] for r in rows if r[0] is not None]
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        mine = out[conv]
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            mine.extend([(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1))
    return out


@pytest.mark.parametrize("most, block", [(2000, 2000), (0, 2000), (3, 2)])
def test_conversations_are_repaired_at_least_cost(table, monkeypatch, most, block):
    monkeypatch.setattr(conversations, "BLOCK", block)
    got = {r[0]: tuple(r[1:]) for r in conversations.digest(conversations.damage(table), most=most).collect()}
    assert got == {conv: repaired_by_trying(rows) for conv, rows in damaged(turns()).items()}


def test_conversations_are_as_in_sql(table):
    same_as_sql(conversations.digest(conversations.damage(table)), oracles.CONVERSATIONS, conversations=table)
    same_as_sql(conversations.digest(conversations.damage(table), size=50), oracles.CONVERSATIONS, conversations=table)


def test_repaired_rows_alternate_and_keep_the_extra_columns_out(table):
    for most in (2000, 2):
        rows = conversations.repair(table, most=most).collect()
        convs = defaultdict(list)
        for r in sorted(rows, key=lambda r: (r.row, r.nth)):
            if r.edit not in ("", "D"):
                convs[r.conv_id].append(r.role[0])
        assert all(re.fullmatch("s?(ua)+", "".join(v)) for v in convs.values())
        kept = Counter((r.conv_id, r.turn, r.was) for r in rows if r.edit in ("K", "R", "D"))
        assert kept == Counter((c, t, " " if role is None else role) for c, t, role, *_ in turns())


@pytest.mark.parametrize("most", [2000, 1])
def test_no_conversations(spark, most):
    none = prepare(spark).createDataFrame([], TURNS).drop("gone")
    assert conversations.digest(conversations.damage(none), most=most).collect() == []
    assert conversations.repair(none, most=most).collect() == []


def test_one_conversation_with_most_rows(spark):
    rows = [(5, i // 3, ("user", "assistant", "tool")[i % 3], f"text {i % 4000}.") for i in range(30_000)] + [(6, 0, "user", "hi.")]
    df = prepare(spark).createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in conversations.digest(df).collect()}
    line, seen = "", set()
    ordered = sorted((r for r in rows if r[0] == 5), key=lambda r: (r[1], r[2], hashlib.md5(r[3].encode()).hexdigest()))
    for _, _, role, text in ordered:
        line += conversations.symbol(role[0], "duplicate" if (role, text) in seen else None)
        seen.add((role, text))
    state = {0: (0, "")}  # left to right instead of by spans
    for x in line:
        state = {q: min((c + k, a + b) for (p, r), (k, b) in conversations.leaf(x).items() if r == q and p in state for c, a in [state[p]])
                 for q in range(4) if any((p, q) in conversations.leaf(x) for p in state)}
    assert (got[5].cost, got[5].audit) == min(state[q] for q in (0, 3) if q in state)
    assert got[6].audit == "KI" and got[6].cost == 2


def test_cells_are_the_same_at_every_split():
    rng = random.Random(1)
    for n in range(1, 9):
        line = "".join(rng.choice("suaSUA-_x") for _ in range(n))
        whole = conversations.parse(line)
        for cut in range(1, n):
            assert conversations.product(conversations.parse(line[:cut]), conversations.parse(line[cut:])) == whole


# --- divergence -----------------------------------------------------------------------------------------------------


def texts():
    rng = random.Random(4)
    words = ["Haus", "hund", "KATZE", "ñandú", "mesa", "été", "a1b2", "Straße", "Ångström"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) + rng.choice(["", ". ", " 12 x-y", "\x00z", " ́"]),
             rng.choice(["de", "de", "de", "fr", None]), rng.choice(["src0", "src0", "s1", "s\U0001f642", "s￿", None, ""])) for i in range(400)]
    rows += [(500, None, "de", "only null"), (501, "rare terms alone", "xx", "one"), (502, "", "xx", "two"), (None, "12 34", "yy", "alone"),
             (503, "long " * 20_000, "de", "src0")] + [(504, "hund hund", "de", "copies")] * 300
    return [(*r, None, None, "v", "s") for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return prepare(spark).createDataFrame(texts(), DOCS)


def divergence_by_trying(rows):
    """Every pair of groups and every kept term, directly."""
    found = [(lang or "", source or "", re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(text or ""))) for _, text, lang, source, *_ in rows]
    out = []
    for lang in {f[0] for f in found}:
        mine = [f for f in found if f[0] == lang]
        spread = Counter(t for f in mine for t in set(f[2]))
        kept = sorted(t for t, n in spread.items() if n >= 10)
        counts = {s: Counter(t for f in mine if f[1] == s for t in f[2]) for s in {f[1] for f in mine}}

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        whole, own = shares(Counter(t for f in mine for t in f[2])), {s: shares(c) for s, c in counts.items()}
        for s, p in own.items():
            pair = [(o, sum((p[t] - q[t]) ** 2 // (p[t] + q[t]) for t in kept)) for o, q in own.items() if o != s]
            term = [(t, (p[t] - whole[t]) ** 2 // (p[t] + whole[t])) for t in kept if counts[s][t] and p[t] > whole[t]]
            for part, items, most in (("pair", pair, None), ("term", term, 10)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return out


@pytest.mark.parametrize("postings, cells, known", [(500_000, 4_000_000, 200_000), (4, 6, 3), (10, 1, 10)])
def test_divergence_is_brute_force(docs, monkeypatch, postings, cells, known):
    monkeypatch.setattr(divergence, "POSTINGS", postings)
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "KNOWN", known)
    assert Counter(map(tuple, divergence.audit(docs).collect())) == Counter(divergence_by_trying(texts()))


def test_divergence_is_as_in_sql(docs):
    same_as_sql(divergence.audit(docs), oracles.DIVERGENCE, documents=docs)


def test_divergence_of_nothing(spark):
    assert divergence.audit(prepare(spark).createDataFrame([], DOCS)).collect() == []


def test_large_counts_stay_exact():
    count, total, kept = np.array([0, 9 * 10**12, 10**13 - 1, 8 * 10**13]), np.array([3 * 10**14] * 4), 10**6
    assert divergence._p(count, total, kept).tolist() == [1 + 10**9 * (int(c) + 2) // (3 * 10**14 + 2 * 10**6) for c in count]


# --- mixing ---------------------------------------------------------------------------------------------------------


def water_level(sizes, weights, most=3):
    """Targets by resharing what is above, as the contract says it."""
    targets, free = {}, dict(sizes)
    total = sum(sizes.values())
    while free:
        rest, weight = total - sum(targets.values()), sum(weights[s] for s in free)
        above = [s for s in free if rest * weights[s] / weight > most * free[s]]
        if not above:
            targets.update({s: rest * weights[s] / weight for s in free})
            break
        for s in above:
            targets[s] = most * free.pop(s)
    return targets


def test_mixing_follows_targets_and_repeats_itself(docs):
    rows = mixing.copies(docs).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.copies(docs.repartition(5)).collect()))
    sizes = Counter()
    for _, text, _, source, *_ in texts():
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    targets = water_level(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    assert len(rows) == len(texts())
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        rate = r.target / r.source_size if r.source_size else 0
        assert int(rate) <= r.copies <= min(3, int(rate) + 1)
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))


def test_mixing_takes_about_the_target(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(1, 60)), rng.choice("aaaabcde")) for i in range(6000)]
    out = mixing.copies(prepare(spark).createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = Counter(), {}
    for r in out:
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
    assert all(abs(taken[s] - t) < 0.1 * t for s, t in target.items())


def test_mixing_is_as_in_sql(docs):
    same_as_sql(mixing.digest(docs), oracles.MIXING, documents=docs)


def test_mixed_rows_are_the_copies(docs):
    whole = Counter((r.doc_id, r.source) for r in mixing.mix(docs).collect())
    want = Counter()
    for r in mixing.copies(docs).collect():
        want[r.doc_id, r.source] += r.copies
    assert whole == +want and mixing.mix(docs).columns == docs.columns


def test_mixing_without_words_or_rows(spark):
    empty = prepare(spark).createDataFrame([], DOCS)
    assert mixing.digest(empty).collect() == [] and mixing.mix(empty).collect() == []
    silent = prepare(spark).createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted(map(tuple, mixing.digest(silent).collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    one = prepare(spark).createDataFrame([(1, "x y", "a"), (2, "", "b"), (3, "x", "c")], "doc_id long, text string, source string")
    assert {(r.doc_id, r.target) for r in mixing.digest(one).collect()} == {(1, 2.5), (2, 0.0), (3, 0.5)}
