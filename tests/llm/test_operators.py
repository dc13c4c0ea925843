"""Each operator on small tables with every awkward case, against brute force where SQL can't say it."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from docflow.llm import bpe, class_lm, decontam, elias_fano, jaccard, pages, pii, quality, token_files, toxicity, vectors
from docflow.llm.common import prepare
from docflow.llm.graph import components

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, key string, block long, n int, component string, unit string"
WORDS = [w + s for w in "abba cede fico gola hyme iota juno kilo lima mene".split() for s in ("", "n", "rs", "x", "tion")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def awkward():
    """Nulls, empty and long texts, ties, repeated rows, odd characters; ids that repeat or are null."""
    rng = random.Random(5)
    base = sentence(rng, 60)
    near = base.split()
    near[30] = "changed"
    texts = [base, base, base.upper(), " ".join(near), sentence(rng, 3), sentence(rng, 3), "", None, " \t\n ", "one",
             sentence(rng, 30_000), "x" * 50_000, "é" * 20_000 + " ñ Ω", "<|endoftext|> it's <|endof" + "text|>", "　 \x1c\x85 🙂🙂",
             sentence(rng, 400), sentence(rng, 400)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, base), (None, base), (None, None), (3, sentence(rng, 20))]
    return [(i, t, "k", 1, 2, "c", "u") for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return prepare(spark).createDataFrame(awkward(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return prepare(spark).createDataFrame([], SCHEMA)


def listed(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# --- language model -------------------------------------------------------------------------------------------------


def test_class_model_counts_and_base_score(docs):
    rows = class_lm.score(docs, folds=3).collect()
    texts = [(i, low(t).encode().split()) for i, t in listed(docs)]
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 3 == 0 for i, _ in texts}
    counts = Counter(w for i, t in texts if not held[i] for w in [*t, None])
    n, v = sum(counts.values()), len(counts)
    want = Counter((i, held[i], len(t) + 1, sum(counts[w] > 0 for w in [*t, None]), n,
                    round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*t, None]), 4)) for i, t in texts)
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows)
    assert got == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_class_model_beats_the_base_and_sums_to_one(spark):
    rng = random.Random(1)
    kinds = ["der die das ein kein".split(), "hund katze maus vogel fisch esel".split(), "läuft schläft frisst ruft".split()]
    rows = [(i, " ".join(rng.choice(k) for _ in range(12) for k in kinds)) for i in range(120)]
    out = class_lm.score(prepare(spark).createDataFrame(rows, "doc_id long, text string")).where("held_out").collect()
    assert sum(r.score for r in out) > sum(r.base_score for r in out) * 0.8
    counts = np.random.default_rng(0).integers(0, 50, (class_lm.CLASSES + 2,) * 2).astype(float)
    counts[-1] = counts[:, -1] = 0
    table = class_lm._transition_table(counts, class_lm.Sizes(5000, 100, 10, 7, np.ones(class_lm.CLASSES)))
    assert np.allclose((10 ** table).sum(1), 1)


def test_exchange_finds_the_classes(spark):
    rng = random.Random(3)
    sides = ([1, 3, 5, 7], [2, 4, 6, 8])
    pairs = Counter()
    for _ in range(4000):
        a, b = rng.choice(sides[0]), rng.choice(sides[1])
        pairs[a, b] += 1
        pairs[b, rng.choice(sides[0])] += 1
    rows = [(w, [b for (a, b) in pairs if a == w], [n for (a, _), n in pairs.items() if a == w],
             [a for (a, b) in pairs if b == w], [n for (_, b), n in pairs.items() if b == w]) for w in range(1, 9)]
    table = prepare(spark).createDataFrame(rows, "w int, next array<int>, n_next array<long>, before array<int>, n_before array<long>")
    classes, counts = class_lm.exchange(table)
    assert {classes[w] for w in sides[0]}.isdisjoint({classes[w] for w in sides[1]})
    assert counts.sum() == sum(pairs.values())


# --- BPE and token files --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("least, bits", [(bpe.LEAST, bpe.MEAN_BITS), (4, 2)])
def test_chunks_join_to_the_text_and_their_ids_to_its_ids(monkeypatch, least, bits):
    monkeypatch.setattr(bpe, "LEAST", least)
    monkeypatch.setattr(bpe, "MEAN_BITS", bits)
    rng = random.Random(2)
    parts = ["a", " ", "  ", "\n", "é", " ", "1", "'s", "<|endoftext|>", "<|endo", "ftext|>", ".", "🙂", "foo bar", "　"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 900))) for _ in range(60)]
    texts += [t or "" for _, t, *_ in awkward()]
    lib = bpe.tokenizer(BYTE_BPE)
    for text, chunks in zip(texts, bpe.chunked([t.encode() for t in texts])):
        assert b"".join(chunks) == text.encode()
        parts = bpe._repaired(BYTE_BPE, bpe.encode(BYTE_BPE, chunks)) if chunks else []
        ids = [i for p in parts for i in (bpe.encode(BYTE_BPE, [p])[0] if isinstance(p, bytes) else p)]
        assert ids == lib.encode(text, add_special_tokens=False).ids


def test_round_trip_equals_the_library(docs, spark):
    lib = bpe.tokenizer(BYTE_BPE)

    def want(text):
        ids = lib.encode(text, add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    shared = sentence(random.Random(9), 2000)  # passages that many documents share
    more = spark.createDataFrame([(100 + i, f"{i} {shared[i % 7:]} {i}") for i in range(40)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(more)
    assert Counter(tuple(r) for r in bpe.digest(both, BYTE_BPE).collect()) == Counter((i, *want(t)) for i, t in listed(both))


def test_elias_fano_selects_every_number():
    rng = np.random.default_rng(4)
    for n, top in ((0, 0), (1, 0), (1, 10**12), (5, 3), (1000, 10**6), (3000, 10), (700, 2**40)):
        values = np.sort(rng.integers(0, top + 1, n)).astype(np.uint64)
        sequence = elias_fano.Sequence(elias_fano.encode(values))
        assert [sequence[i] for i in range(n)] == values.tolist() == sequence.all().tolist()
    values = np.cumsum(rng.integers(1, 2000, 20_000)).astype(np.uint64)
    assert len(elias_fano.encode(values)) * 8 < len(values) * 14  # against 64 bits in a table


def test_token_files_hold_every_document_in_order(docs, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 4000)
    lib = bpe.tokenizer(WORD_BPE)
    rows = sorted(token_files.round_trip(docs, WORD_BPE).collect(), key=lambda r: r.start)
    ids = [(i, lib.encode(t, add_special_tokens=False).ids + [1]) for i, t in listed(docs)]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter(
        (i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids)
    order = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert order == sorted(order)
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]


def test_lexicon_counts_leave_no_word_out(monkeypatch):
    monkeypatch.setattr(class_lm, "FLUSH", 30_000)
    texts = [" ".join(f"w{i}" for i in range(begin, begin + 20_000)) for begin in (0, 10_000, 20_000)]
    counts = Counter()
    for part in class_lm._word_counts(pa.RecordBatch.from_arrays([pa.array([t])], ["text"]) for t in texts):
        counts.update(dict(zip(part["word"].to_pylist(), part["n"].to_pylist())))
    assert counts == Counter(w.encode() for t in texts for w in t.split())


# --- decontamination ------------------------------------------------------------------------------------------------


def leaks(texts, items, size=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t or ""))

    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add("" if item is None else str(item))
    for doc, text in texts:
        w, hit, named = words(text), set(), set()
        for window, found in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i:i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    named |= found
        yield doc, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)


def test_decontamination_is_brute_force(spark):
    rng = random.Random(6)
    texts = [(i, sentence(rng, 80)) for i in range(40)] + [(None, "z"), (41, None), (42, ""), (7, "The Ünder, the der!")]
    items = [(i, " ".join(texts[i][1].split()[10:35])) for i in range(5)]
    items += [(6, "the der"), (7, None), (8, " -- "), (None, texts[9][1]), (1, texts[11][1]), (9, "ünder")]
    texts += [(50 + i, f"{sentence(rng, 9)} {items[i % 5][1].upper()}; {sentence(rng, 4)}") for i in range(30)]
    docs = prepare(spark).createDataFrame([(*t, "x", 3) for t in texts], "doc_id long, text string, words string, pos int")
    table = spark.createDataFrame([(*t, 1) for t in items], "item_id long, text string, window_id int")
    out = decontam.contamination(docs, table)
    assert Counter(tuple(r) for r in out.collect()) == Counter(leaks(texts, items))
    kept = decontam.drop_contaminated(docs, table)
    assert kept.columns == docs.columns
    leaky = {d for d, *_, bad in leaks(texts, items) if bad}
    assert 7 in leaky and {r.doc_id for r in kept.collect()} == {d for d, _ in texts} - leaky
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()


def test_decontamination_without_rows(spark, docs, none):
    items = prepare(spark).createDataFrame([], "item_id long, text string")
    assert decontam.contamination(none, items).count() == 0
    assert not decontam.contamination(docs, items).where("contaminated").count()
    assert decontam.drop_contaminated(docs, items).count() == docs.count()


def test_proximity_takes_words_in_any_order(spark):
    docs = prepare(spark).createDataFrame([(1, "red fox over lazy dog"), (2, "dog x x x x lazy fox"), (3, "fox dog"), (4, "dog lazy fox")],
                                          "doc_id long, text string")
    found = decontam.windows(spark.createDataFrame([(1, "lazy fox dog")], "item_id long, text string"))
    terms = decontam.terms(found)
    index = decontam.build_index(docs, terms)
    near = decontam.proximity(index, found, terms, 3).join(index.select("doc_key", "doc_id").distinct(), "doc_key")
    assert {r.doc_id for r in near.collect()} == {1, 4}


# --- pages ----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("html, text", [
    ("<body><nav>Menu</nav><article><h1>A &amp; B</h1><p>one\n  <b>two</b><br>three<p>four &#8217;x&eacute;</article><footer>f</footer>",
     "A & B\n\none two three\n\nfour ’xé"),
    ("<body><header>top</header><main><p>x<div class='ad'>buy</div><script>var t='</p>'</script><p>y</p></main>", "x\n\ny"),
    ("<article><header><h2>t</h2></header>z<!-- no --><section id=comments><p>c</p></section><form>q</form></article>", "t\n\nz"),
    ("<div hidden>h</div><p>a &lt;b&gt; c</p><aside><div><p>s</div></aside><p>d", "a <b> c\n\nd"),
    ("plain", "plain"), ("", ""), ("<article></article><p>rest</p>", "rest"),
])
def test_blocks(html, text):
    assert "\n\n".join(pages.blocks(html)[1]) == text


@pytest.mark.parametrize("html, texts", [
    ("<article><p class='ad'>x<p>y</p><p>z</p></article>", ["y", "z"]),
    ("<article><ul><li class=ad>x<li>y</ul><p>z</article>", ["y", "z"]),
    ("<article><p class=ad>x<span>x</span><div>y</div><div class=ad>x<p>x<div>x</div>x</div>z</article>", ["y", "z"]),
    ("<div><p class=ad>x</div>y<p>a<span class=ad>x</p><p>z", ["y", "a", "z"]),
    ("<table><tr class=ad><td>x<tr><td class=ad>x<td>y<tr><td>z</table>", ["y", "z"]),
    ("<table><tr><td class=ad>x<table><tr><td>x</table>x<td>y</table>z", ["y", "z"]),
    ("<dl><dt class=ad>x<dd>y<dd class=ad>x</dl>z", ["y", "z"]),
    ("<article><article class=related>x</article>y<div class=ad>x</article>", ["y"]),
    ("<head><title>x</title><meta name=x><body><p>y", ["y"]), ("<head><title>x</title>y<p>z", ["y", "z"]),
    ("<p>5 < 6</p><p>a <> b <3 & c<</p>", ["5 < 6", "a <> b <3 & c<"]), ("<!doctype html><p>y</ z>z<?x?>", ["yz"]),
])
def test_blocks_end_where_html_ends_them(html, texts):
    assert pages.blocks(html)[1] == texts


@pytest.mark.parametrize("html, texts", [
    ('<article><div style="overflow:hidden"><p>real</p></div><p title="the hidden valley">text</p><p data-hidden=1>x</article>', ["real", "text", "x"]),
    ('<article><p hidden>x<p HIDDEN="">x<p style="color:red; Display : None">x<p style="visibility:hidden!important">x<p>y</article>', ["y"]),
    ('<article><p class="side-by-side">a<p id="related-work">b<p id=search-results>c<p class="alert-level">d<p class="adage">e</article>', list("abcde")),
    ('<article><div class="k related-posts">x</div><p id=site-footer>x<p class="cookie-notice">x<p class=ad_box-2>x<p role=Alert>x<p>y</article>', ["y"]),
    ('<main><h1>T</h1><p>the story</p><article class="card">teaser</article></main>', ["T", "the story", "teaser"]),
    ('<main><p>by</p><article>the story itself</article></main>', ["the story itself"]),
    ('<main><p>short</p></main><article>the much longer story</article>', ["the much longer story"]),
])
def test_only_furniture_is_left_out(html, texts):
    assert pages.blocks(html)[1] == texts


def test_no_pages_and_a_very_long_one(spark):
    schema = "page_id long, url string, html string"
    assert pages.main_text(prepare(spark).createDataFrame([], schema)).collect() == []
    text = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, "https://a.example", f"<article><p>{text}</p></article>"), (2, "https://a.example", f"<div>{text}</div>")]
    assert {r.text for r in pages.main_text(spark.createDataFrame(rows, schema)).collect()} == {text}


def test_pages_without_marks_lose_what_their_host_repeats(spark, monkeypatch):
    monkeypatch.setattr(pages, "SHARD", 16)  # a hot host is split; the counts of its shards add up
    menu, foot = "Home News About Contact Login Register Search Help", "All rights reserved by the owner of this site"
    rows = [(i, "https://Hot.example/x", f"<div>{menu}</div><div>" + " ".join(f"w{i}a{k}" for k in range(30)) + f"</div><p>{foot}</p>", "h")
            for i in range(120)]
    copy = "<p>" + " ".join(f"c{k}" for k in range(40)) + "</p>"
    article = "<article><p>" + " ".join(f"r{k}" for k in range(60)) + "</p></article>"
    rows += [(200 + i, "https://copy.example", copy, "h") for i in range(5)] + [(300 + i, "https://hot.example", article, "h") for i in range(5)]
    rows += [(400, None, None, "h"), (None, "no host", "", "h"), (401, "https://lone.example", f"<div>{menu}</div>", "h")]
    out = pages.main_text(prepare(spark).createDataFrame(rows, "page_id long, url string, html string, host string"))
    got = {r.page_id: r for r in out.collect()}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got.values())
    assert all(got[i].text == " ".join(f"w{i}a{k}" for k in range(30)) for i in range(120))
    assert all(got[200 + i].text == copy[3:-4] for i in range(5))
    assert all(got[300 + i].text == article[12:-14] for i in range(5))
    assert (got[400].text, got[None].text, got[401].text) == ("", "", menu)


@pytest.mark.parametrize("shard", [8, 512])
def test_marked_articles_lose_what_most_pages_of_their_host_have(spark, monkeypatch, shard):
    monkeypatch.setattr(pages, "SHARD", shard)  # with 8 the host is split
    notice, line = "You read this story free of charge because our members pay for it", "a line that some stories of this site have in common"
    own = {i: " ".join(f"w{i}a{k}" for k in range(60)) for i in range(60)}
    copy = " ".join(f"c{k}" for k in range(40))
    html = {i: f"<article><p>{text}</p>" + f"<p>{line}</p>" * (i % 3 == 0) + f"<div>{notice}</div>" * (i % 5 > 0) + "</article>" for i, text in own.items()}
    rows = [(i, "https://site.example/x", h) for i, h in html.items()]
    rows += [(100 + i, "https://copy.example", f"<article><p>{copy}</p><p>{notice} {i}</p></article>") for i in range(8)]
    rows += [(200 + i, "https://small.example", f"<article><p>{own[i]}</p><p>{notice}</p></article>") for i in range(5)]
    rows += [(300, "https://site.example", f"<div>{notice}</div>"), (400, "https://site.example", None), (None, None, None)]
    got = {r.page_id: r.text for r in pages.main_text(prepare(spark).createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == own[i] + f"\n\n{line}" * (i % 3 == 0) for i in own)
    assert all(got[100 + i] == f"{copy}\n\n{notice} {i}" for i in range(8))
    assert all(got[200 + i] == f"{own[i]}\n\n{notice}" for i in range(5))
    assert (got[300], got[400], got[None]) == (notice, "", "")


def test_suffix_groups_are_common_prefixes():
    tokens = np.random.default_rng(1).integers(0, 3, 300)
    tokens[-8:] = np.arange(100, 108)
    group = pages.suffix_groups(tokens, 5)
    for i in range(0, 290, 7):
        for j in range(0, 290):
            assert (group[i] == group[j]) == (tokens[i:i + 5].tolist() == tokens[j:j + 5].tolist())


# --- classifiers ----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        words = sentence(rng, rng.randint(20, 80)).split()
        toxic, bad = i % 4 == 0, i % 3 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["scoundrel", "scoundrels", "blockhead", "blockheads"])
        rows.append((i, " ".join(w + "###" if bad else w for w in words), None))
        labels.append((i, int(not bad), int(toxic), i))
    rows += [(1000, "", 1), (1001, None, 1), (1002, "you blokhead, you scoundrell, blockhed " + sentence(rng, 12), 1), (None, "x", 1)]
    labels += [(None, 1, 1, 0), (5, None, None, 0), (2000, 0, 1, 0)]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string, score int")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text int")


def test_toxicity_learns_and_knows_misspellings(labelled, monkeypatch):
    monkeypatch.setattr(toxicity, "MIN_TEXTS", 2)
    docs, labels = labelled
    rows = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    held = [r for i, r in rows.items() if r.held_out and i is not None and i < 400]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    assert rows[1002].predicted == 1 and rows[1000].score == rows[1001].score < 0.5
    model = toxicity.fit(docs, labels)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and 1002 not in {r.doc_id for r in kept.collect()}


def test_quality_learns_from_compression(labelled):
    docs, labels = labelled
    rows = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    held = [r for i, r in rows.items() if r.held_out and i is not None and i < 400]
    assert sum(r.predicted == (r.doc_id % 3 != 0) for r in held) >= 0.95 * len(held)
    assert rows[1000].score == rows[1001].score


@pytest.mark.parametrize("kind", [quality, toxicity])
def test_classifiers_without_labels_or_rows(docs, none, spark, kind):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert kind.classify(none, labels).count() == 0
    rows = kind.classify(docs, labels).collect()
    assert len(rows) == docs.count() and len({r.score for r in rows}) == 1


# --- personal data --------------------------------------------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def is_valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    doubled = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits)))
    return {"email": True, "ip": kind == "ip" and max(map(int, match.split("."))) <= 255,
            "card": 13 <= len(digits) <= 19 and doubled % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]


def test_personal_spans_are_the_plain_expressions(spark):
    rng = random.Random(12)
    parts = ["a@b.co", "x.y_z@q", "@", ".", "4041894974608795", "4041 8949 7460 8795", "4041-8949-7460-8794", "1", "12", " ", "-", "+",
             "+1 (456) 555-2186", "255.1.2.3", "256.1.1.1", "00.1.2.3.4.5.6.7", "é", "🙂", "(", "word"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [None, "", "9" * 60_000 + " " + "a" * 60_000 + "1 " * 30_000 + "-+1((((", "a@b.co" * 300]
    docs = prepare(spark).createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_email int")
    out = pii.digest(docs)
    for r in out.collect():
        spans = {k: [m.span() for m in re.finditer(p, texts[r.doc_id] or "") if is_valid(k, m.group())] for k, p in BASE.items()}
        named = ",".join(f"{k}:{a}:{b}" for k, x in spans.items() for a, b in x)
        assert r.base_sha256 == hashlib.sha256(named.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(x) for x in spans.values()]
        assert r.spans == named
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()


def test_added_kind_context_and_masking(spark):
    text = "pay to iban DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432x, call +1 (456) 555-2186; a@b.c_d@e.f"
    docs = prepare(spark).createDataFrame([(1, text, "k"), (2, None, "k"), (3, "plain", "k")], "doc_id long, text string, pii_spans string")
    found = {s.kind: s for s in pii.find(docs.where("doc_id = 1"), "text", "out").first()["out"]}
    assert (found["iban"].start, found["iban"].end) == (12, 39) and found["iban"].score > 0.9
    assert found["phone"].score == pytest.approx(0.8)
    masked = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert masked[1].text == "pay to iban [iban] or GB82WEST12345698765432x, call [phone]; [email][email]"
    assert masked[2].text is None and masked[3].text == "plain" and masked[1].pii_spans == "k"


# --- near copies ----------------------------------------------------------------------------------------------------


def jaccard_components(rows):
    sets = {}
    for doc, text in rows:
        w = low(text).encode().split()
        sets.setdefault(doc, set()).update(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        if w and len(w) < 5:
            sets[doc].add(tuple(w))
    low_of = {d: d for d in sets}
    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            c = len(sets[a] & sets[b])
            if c and 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
                x, y = low_of[a], low_of[b]
                for d in docs:
                    if low_of[d] in (x, y):
                        low_of[d] = min(x, y)
    return {d: (len(sets[d]), low_of[d]) for d in docs}


def test_jaccard_join_is_brute_force(spark):
    rng = random.Random(13)
    base, passage = sentence(rng, 120).split(), sentence(rng, 60)
    rows = [(i, sentence(rng, rng.randint(1, 90))) for i in range(40)]
    rows += [(100 + i, " ".join(base)) for i in range(30)]
    for i in range(120):  # a group of near copies, some linked only through others
        words = list(base)
        for _ in range(rng.randint(1, 5)):
            words[rng.randrange(len(words))] = f"n{i}"
        rows.append((200 + i, " ".join(words[rng.randint(0, 6):])))
    rows += [(500 + i, f"{passage} {sentence(rng, 30)}") for i in range(60)]  # a passage that many share
    rows += [(600, ""), (601, None), (602, " "), (603, "one two"), (604, "ONE\ttwo"), (605, sentence(rng, 3000))]
    docs = prepare(spark).createDataFrame([(d, t, "a", 1, 2) for d, t in rows], "doc_id long, text string, a string, n int, b int")
    want = jaccard_components([(d, t or "") for d, t in rows])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs).collect()}
    assert got == want
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (_, c) in want.items() if c == d)


def test_jaccard_join_of_awkward_rows(docs, none):
    rows = jaccard.join(docs).collect()
    assert len(rows) == docs.count()
    of = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert of[0] == of[1] == of[2] == 0 and of[9] == 9 and of[6] == 6 and of[7] == 7
    assert all(r.component_id is None for r in rows if r.doc_id is None)
    assert jaccard.join(none).count() == 0 and jaccard.keep_one(none).count() == 0


def test_rare_words_are_judged_by_all_their_places_whatever_the_pieces(monkeypatch):
    class Number:
        value = {w.encode(): i + 1 for i, w in enumerate(WORDS[:10])}

    rng = np.random.default_rng(3)
    classes = rng.integers(0, class_lm.CLASSES, class_lm.SIZE)
    classes[class_lm.END], classes[class_lm.REST] = class_lm.CLASSES, class_lm.CLASSES + 1
    run = class_lm._proposals(Number, classes, rng.integers(0, 50, (class_lm.CLASSES + 2,) * 2).astype(float))
    texts = [sentence(random.Random(i), 30) for i in range(20)] + ["", "only here"]
    table = pa.table({"text": texts, "held_out": [i % 5 == 0 for i in range(22)], "block": [4] * 22})
    got = []
    for places in (1, 7, 1 << 12):
        monkeypatch.setattr(class_lm, "PLACES", places)
        got.append(run(table).to_pylist())
    assert got[0] == got[1] == got[2] and len(got[0]) == len({w for t in texts for w in t.split()})


def test_near_copies_meet_in_blocks_of_their_own(spark, monkeypatch):
    rng = random.Random(17)
    base, rows = [f"b{i}" for i in range(120)], [(1000 + i, sentence(rng, 60)) for i in range(30)]
    for i in range(300):  # near copies of one text, mostly not similar to each other, each of them in every task
        words = list(base)
        for k in range(3):
            words[rng.randrange(len(words))] = f"n{i}x{k}"
        rows += [(i, " ".join(words))] + [(2000 + 3 * i + k, " ".join(words)) for k in range(3) if i < 40]
    seen, tables = jaccard.written, {}
    monkeypatch.setattr(jaccard, "written", lambda df, name: tables.setdefault(name, []).append(seen(df, name)) or tables[name][-1])
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string").repartition(16, "doc_id")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs).collect()} == jaccard_components(rows)
    asked = [r for t in tables["asks"] for r in t.collect()]
    assert asked and max(r.a for r in asked) < 2000  # of copies one asks
    # by the hash of the id, as before, each would send its set to nearly all blocks
    assert sum(r.block != r.home for r in asked) < 300 * jaccard.BLOCKS // 4


def test_a_very_common_smallest_shingle_fills_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 4096)
    each = prepare(spark).createDataFrame([(i, 64, bytes([i]), 7) for i in range(100)] + [(500 + i, 64, bytes([i]), 7) for i in range(9)],
                                          "doc_id long, n long, key binary, least long")
    labels, blocks = jaccard._first_labels(each)
    held = [r for r in labels.collect() if r.lead == r.doc_id]
    assert len(held) == 100 and blocks == jaccard.BLOCKS
    assert max(Counter(r.block for r in held).values()) < 40


def test_probe_gives_up_only_when_hopeless():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64)) for _ in range(2))
        common = len(np.intersect1d(a, b))
        assert jaccard.similar(jaccard.probe(a, b), len(a), len(b)) == jaccard.similar(common, len(a), len(b))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(7, 7), (500, 450)]
    out = components(prepare(spark).createDataFrame(edges, "a long, b long")).collect()
    got = {r.id: r.component for r in out}
    assert len(got) == len(out) and got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(300)}, 500: 450, 450: 450}


# --- embeddings -----------------------------------------------------------------------------------------------------


def test_vectors_in_forest_and_tiles(spark, monkeypatch):
    for name, value in (("LEAF", 24), ("NODE", 150), ("SAMPLE", 300), ("BLOCK", 32)):
        monkeypatch.setattr(vectors, name, value)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 16))
    x[100:220] = x[100] + 0.05 * rng.normal(size=(120, 16))  # a group of near copies
    x[220:260] = x[220]  # copies
    x[260:300] = x[0:40] + 0.1 * rng.normal(size=(40, 16))
    rows = [(i, v.tolist(), "n") for i, v in enumerate(x.astype(np.float32).astype(float))]
    odd = [(600, None, "n"), (601, [0.0] * 16, "n"), (602, [float("nan")] * 16, "n"), (603, [1.0, None] + [1.0] * 14, "n"), (604, [], "n"),
           (605, [1.0], "n"), (606, [float("inf")] * 16, "n")]
    table = prepare(spark).createDataFrame(rows + odd, "vec_id long, embedding array<double>, node string")
    got = {r.vec_id: r for r in vectors.near_duplicates(table).collect()}
    unit = np.array([v for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    assert sum(got[i].n_links for i in range(500)) >= 0.95 * close.sum()
    assert all(got[i].n_links <= close[i].sum() for i in range(500))
    assert len({got[i].component_id for i in range(100, 220)}) == 1 and all(got[i].component_id == 220 for i in range(220, 260))
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, *_ in odd)
    assert vectors.near_duplicates(table.where("vec_id < 0")).count() == 0


def test_pairs_that_nothing_else_links_are_found(spark, monkeypatch):
    for name, value in (("LEAF", 8), ("NODE", 20), ("SAMPLE", 5000)):
        monkeypatch.setattr(vectors, name, value)
    rng = np.random.default_rng(6)
    x = vectors._unit(rng.normal(size=(4000, 32)))
    to = rng.normal(size=(400, 32))
    to -= (to * x[:400]).sum(1, keepdims=True) * x[:400]
    x = np.concatenate([x, 0.905 * x[:400] + np.sqrt(1 - 0.905**2) * vectors._unit(to)])
    table = prepare(spark).createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.component_id for r in vectors.near_duplicates(table).collect()}
    assert sum(got[4000 + i] == i for i in range(400)) >= 396


def test_trees_follow_the_depth():
    sample = vectors._unit(np.random.default_rng(7).normal(size=(20_000, 64)))
    share = [vectors.survival(sample, levels, np.random.default_rng(1)) for levels in (0, 5, 10, 20)]
    assert share[0] == 1 and share == sorted(share, reverse=True) and 0.45 < share[2] < 0.7
    trees = [vectors.n_trees(s) for s in share]
    assert trees[0] == vectors.TREES and trees[1] <= trees[2] < trees[3]
    assert 1 - (1 - share[3]) ** trees[3] >= vectors.RECALL


def test_vectors_of_other_lengths_are_compared_among_themselves(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0, 0.0]), (4, [1.0, 0.1, 0.0]), (5, [0.0, 0.0, 1.0]), (6, [0.0, 1.0]), (7, [])]
    table = prepare(spark).createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(table).collect()}
    assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (1, 3, True), 4: (1, 3, False), 5: (0, 5, True), 6: (0, 6, True), 7: (0, 7, True)}


def test_leaves_grow_where_trees_would_be_too_many(monkeypatch):
    measured = np.array([1.0, 0.8, 0.6, 0.45])
    trees, leaf = vectors.forest_size(measured, 10**7)
    assert trees <= vectors.MOST_TREES and leaf > vectors.LEAF
    share = vectors.held_together(measured, vectors._levels(10**7, leaf))
    assert 1 - (1 - share) ** trees >= vectors.RECALL
    assert vectors.forest_size(np.array([1.0, 0.99, 0.98]), 10**4)[1] == vectors.LEAF


def test_context_words_change_the_score_and_nothing_else(spark):
    texts = ["write to a@b.cd", "xx a@b.cd", "DE89 3704 0044 0532 0130 00", "iban: DE89 3704 0044 0532 0130 00", "x_DE89 3704 0044 0532 0130 00 y",
             "my_iban DE89 3704 0044 0532 0130 00", "server 1.2.3.4 and" + " z" * 30 + " 5.6.7.8"]
    rows = pii.digest(prepare(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.scores for r in rows} == {0: "1.0", 1: "0.8", 2: "0.8", 3: "1.0", 4: "", 5: "0.8", 6: "0.7,0.5"}
