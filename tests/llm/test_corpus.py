"""Corpus operators against brute force, the libraries they must equal, and odd rows."""

import hashlib
import itertools
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seriesmill.llm import bpe, components, decontamination, html_main, line_dedup, near_dups, quality, search, suffix_dedup, token_counts, toxicity
from seriesmill.llm.queries import PIECE_MODEL, WORD_VOCABULARY

WORDS = [a + b for a in "the or ing tion ar en ou st ly".split() for b in ["", "ed", "er", "al", "it", "os", "é", "um"]]
SCHEMA = "doc_id long, text string, lang string, n long, score double, line string"


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


@pytest.fixture(scope="module")
def corpus():
    """Texts with copies, edited copies, shared passages, short, empty and null ones."""
    rng = random.Random(4)
    line = lambda k: " ".join(rng.choices(WORDS, k=k)) + rng.choice([".", "", "!"])
    texts = ["\n".join(line(rng.choice([1, 3, 9, 25])) for _ in range(rng.randint(1, 8))) for _ in range(60)]
    passage = line(60)
    for t in texts[:25]:
        parts = t.split(" ")
        parts[rng.randrange(len(parts))] = "edited"
        texts.append(" ".join(parts))
    texts += texts[5:20] + [t + "\n" + passage for t in texts[20:30]] + ["", None, None, "  \n \t", "a", "a", "a b", "é", line(4000)]
    rng.shuffle(texts)
    return [(3 * k + 1, t) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    """With extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", 7, 0.5, "x") for i, t in corpus], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def fuzz(seed, n=300):
    rng = random.Random(seed)
    alphabet = list("abTΣσİßé一😀 \t\n\x0b\x1c\x85  　!?%$'s\x00") + ["<|endoftext|>", "<s>", "   ", "▁", "the", "aaaa", "ab", "é"]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(n)] + ["a" * 5000, " " * 70, None, ""]


def test_bpe_equals_the_library(spark):
    texts = fuzz(1)
    df = spark.createDataFrame([(i, t, 3, b"x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int, ids binary")
    vocabulary = open(WORD_VOCABULARY).read()
    library = Tokenizer.from_file(WORD_VOCABULARY)
    for r in bpe.encode_decode(df, vocabulary).collect():
        want = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
        assert r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.encode_decode(df.limit(0), vocabulary).count() == 0


def test_bpe_forgets_without_effect(corpus):
    v = bpe.Vocabulary(open(WORD_VOCABULARY).read())
    texts = [t for _, t in corpus]
    small = bpe.Encoder(v, most=5)
    assert [small.encode(pa.array([t], pa.string()))[0][0] for t in texts] == bpe.Encoder(v).encode(pa.array(texts))[0]


def test_token_counts_equal_the_library(spark):
    texts = fuzz(2)
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    model = open(PIECE_MODEL, "rb").read()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    for r in token_counts.token_counts(df, model).collect():
        assert r.n_tokens == len(library.encode(texts[r.doc_id] or ""))
    assert token_counts.token_counts(df.limit(0), model).count() == 0


def groups_by_force(rows, words):
    sets = {i: s for i, t in rows for s in [words_of(t)] for s in [{tuple(s[k : k + words]) for k in range(len(s) - words + 1)} or ({tuple(s)} if s else set())]}
    root = {i: i for i in sets}
    changed = True
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and sets[b]]
    while changed:
        changed = False
        for a, b in links:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
    return {i: (len(sets[i]), root[i]) for i in sets}


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates_by_force(docs, corpus, none, words):
    found = near_dups.near_duplicates(docs, words=words)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == groups_by_force(corpus, words)
    assert near_dups.near_duplicates(none).count() == 0


def test_superminhash_is_sequential_superminhash():
    """Steps in parallel give the signature of the element-by-element algorithm, and its estimate is close."""
    rng = np.random.default_rng(1)
    m = 64
    for size in (1, 5, 60, 900):
        values = rng.integers(1, 2**63, size, dtype=np.uint64)
        want = np.full(m, near_dups._NONE, np.uint64)
        for v in values:
            p = list(range(m))
            for j in range(m):
                rank, k = (x[0] for x in near_dups._draw(np.array([v]), j, m))
                p[j], p[k] = p[k], p[j]
                want[p[j]] = min(want[p[j]], rank)
        assert (near_dups.superminhash(values, np.zeros(size, np.int64), 1, m)[0] == want).all()
    a = rng.integers(1, 2**63, 1000, dtype=np.uint64)
    b = np.concatenate((a[:800], rng.integers(1, 2**63, 200, dtype=np.uint64)))
    s = near_dups.superminhash(np.concatenate((a, b)), np.repeat([0, 1], 1000), 2, 512)
    assert abs((s[0] == s[1]).mean() - 800 / 1200) < 0.08


def test_repeated_and_missing_ids(spark):
    rows = [(1, "one two three four five six"), (1, "one two three four five six"), (None, "one two three four five six"), (2, "other words that are here now")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(near_dups.near_duplicates(df).select("doc_id", "component_id").collect(), key=str) == [(1, 1), (1, 1), (2, 2), (None, 1)]
    assert line_dedup.dedup_lines(df).count() == 4
    assert suffix_dedup.remove_repeats(df).count() == 3
    assert search.top_k(df, df.withColumnRenamed("doc_id", "query_id")).filter("query_id IS NULL").count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    chain = list(range(0, 200, 2))
    rng.shuffle(chain)
    edges = [(a, a + 2) if rng.random() < 0.5 else (a + 2, a) for a in chain[:-1] if a < 198] + [(1001 + k, 1001) for k in range(1, 90)] + [(7, 7)]
    found = {r.vertex: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect()}
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert found == {x: root(x) for x in parent if x != 7}


def lines_by_force(rows):
    kept, sets = {}, []
    for i, t in sorted(rows):
        left = []
        for line in t.split("\n") if t else []:
            s = frozenset(words_of(line))
            if not s or not any(5 * len(s & x) >= 4 * len(s | x) for x in sets):
                left.append(line)
            if s:
                sets.append(s)
        kept[i] = "\n".join(left) if t else t
    return kept


@pytest.mark.parametrize("most", [1, 64])
def test_lines_by_force(docs, corpus, none, most):
    want = lines_by_force(corpus)
    for r in line_dedup.dedup_lines(docs, most=most).collect():
        assert r.text == want[r.doc_id]
        assert r.n_lines - r.n_removed == (0 if not want[r.doc_id] and r.n_removed == r.n_lines else (want[r.doc_id] or "").count("\n") + bool(r.n_lines))
        assert r.lang == "en" and r.n == 7 and r.line == "x"
    assert line_dedup.dedup_lines(none).count() == 0


def strings_by_force(rows, size=50):
    seen, out = set(), {}
    for i, t in sorted(rows):
        raw = (t or "").encode()
        own = [raw[k : k + size] for k in range(len(raw) - size + 1)]
        gone = np.zeros(len(raw) + 1, bool)
        for k, s in enumerate(own):
            if s in seen:
                gone[k : k + size] = True
        seen.update(own)
        kept = bytes(x for x, g in zip(raw, gone, strict=False) if not g)
        out[i] = (len(raw), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()), kept)
    return out


def test_repeated_strings_by_force(docs, corpus, none):
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert found == strings_by_force(corpus)
    assert sum(x[1] for x in found.values()) > 1000
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_frequent_phrases_between_other_neighbours(spark, monkeypatch, docs, corpus):
    """Strings at frequent q-grams are dealt by their own hashes, with the same result."""
    rng = random.Random(14)
    some = lambda k: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=k))
    rows = [(k, some(40) + " a phrase that stands everywhere " + some(40)) for k in range(400)]
    rows += [(500 + k, t[10:] + " " * 90) for k, (_, t) in enumerate(rows[:30])]
    raw = [t.encode() for _, t in rows]
    data, starts = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    grams = len(np.unique(suffix_dedup.Anchors(data, starts, 50, 24).hash))
    piece = {"z": zstandard.compress(data.tobytes()), "sizes": np.diff(starts).tolist(), "ids": [i for i, _ in rows]}
    e = suffix_dedup.Entries(piece | {"seen": [{"part": 0, "blob": zstandard.compress(b"\3" * grams)}]}, 50, 24, 32)
    loads = np.bincount(e.part, minlength=32)
    assert loads.max() < 1.5 * loads.mean()
    monkeypatch.setattr(suffix_dedup, "OFTEN", 5)
    monkeypatch.setattr(suffix_dedup, "RANGE_BYTES", 1000)
    for df, known in ((docs, corpus), (spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows)):
        found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df).collect()}
        assert found == strings_by_force(known)


def test_ranges_of_repeated_strings_are_even():
    data = np.random.default_rng(5).integers(97, 123, 200_000).astype(np.uint8)
    text = zstandard.compress(data.tobytes())
    grams = len(np.unique(suffix_dedup.Anchors(data, np.array([0, len(data)]), 50, 24).hash))
    for seen in (b"\1", b"\3"):
        e = suffix_dedup.Entries({"z": text, "sizes": [len(data)], "ids": [1], "seen": [{"part": 0, "blob": zstandard.compress(seen * grams)}]}, 50, 24, 64)
        loads = np.bincount(e.part, minlength=64)
        assert loads.max() < 1.5 * loads.mean()


def test_loser_tree_sorts_with_common_prefixes(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "FAN_IN", 4)
    rng = random.Random(6)
    runs = []
    for n in (0, 1, 7, 30, 30, 5, 0, 12, 3):
        words = sorted(bytes(rng.choices([0, 65, 66, 200], k=6)) for _ in range(n))
        common = [0] + [len(os.path.commonprefix([a, b])) for a, b in itertools.pairwise(words)]
        runs.append(type("R", (), {"value": [int.from_bytes(w, "big") for w in words], "common": common[:n], "words": words}))
    order, common = suffix_dedup.merge_all(runs, 6)
    words = [w for r in runs for w in r.words]
    got = [words[k] for k in order]
    assert got == sorted(words)
    assert common.tolist()[1:] == [len(os.path.commonprefix([a, b])) for a, b in itertools.pairwise(got)]


def edits(text, word):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(word):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_leaks_by_force(spark, none):
    rng = random.Random(8)
    items = [" ".join(rng.choices(WORDS, k=k)) for k in (14, 20, 30, 45)] + ["tiny"]
    rows = []
    for k in range(80):
        word = list(rng.choice(items[:4]))
        for _ in range(rng.randint(0, int(len(word) * 0.14))):
            p = rng.randrange(len(word))
            word[p : p + 1] = rng.choice([[], ["q"], [word[p], "w"]])
        rows.append((k, " ".join(rng.choices(WORDS, k=9)) + "\n " + "".join(word).upper() + "  " + " ".join(rng.choices(WORDS, k=9))))
    rows += [(900, None), (901, ""), (None, items[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(10 + k, t) for k, t in enumerate(items)] + [(99, None), (None, "x" * 90), (98, "")], "item_id long, text string")
    found = decontamination.passages(docs, benchmark, block_bytes=200).filter("doc_id IS NOT NULL").groupBy("doc_id", "item_id").agg(F.min("edits")).collect()
    want = set()
    for i, t in rows:
        text = re.sub("[\x20\x09-\x0d]+", " ", t or "")
        text = "".join(c.lower() if c.isascii() else c for c in text).encode()
        for k, w in enumerate(items[:4]):
            e = edits(text, w.encode())
            if i is not None and e <= len(w.encode()) // 10:
                want.add((i, 10 + k, e))
    assert {tuple(r) for r in found} == want and len(want) > 30
    for r in decontamination.passages(docs, benchmark).filter("edits = 0 AND doc_id IS NOT NULL").collect():
        raw = dict(rows)[r.doc_id].encode()[r.start : r.end].decode()
        assert re.sub(r"\s+", " ", raw).lower() == items[r.item_id - 10].lower()
    assert decontamination.leaked(none, benchmark).count() == 0
    assert decontamination.passages(docs, benchmark.limit(0)).count() == 0


def test_search_by_force(docs, corpus, none):
    found = search.top_k(docs, docs.filter("doc_id % 5 = 0").withColumnRenamed("doc_id", "query_id"), k=4, shard_docs=20, block_queries=6)
    bags = {i: Counter(re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())) for i, t in corpus}
    bags = {i: b for i, b in bags.items() if b}
    df = Counter(w for b in bags.values() for w in b)
    mean = sum(sum(b.values()) for b in bags.values()) / len(bags)

    def score(q, d):
        n = sum(bags[d].values())
        return sum(np.log(1 + (len(bags) - df[w] + 0.5) / (df[w] + 0.5)) * bags[d][w] * 2.2 / (bags[d][w] + 1.2 * (0.25 + 0.75 * n / mean)) for w in bags[q] if w in bags[d])

    want = {}
    for q in bags:
        if q % 5 == 0:
            best = sorted((-round(score(q, d), 6), d) for d in bags)
            want[q] = [(d, -s) for s, d in best if s < 0][:4]
    got = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.doc_id, r.score))
    assert {q: [d for d, _ in v] for q, v in got.items()} == {q: [d for d, _ in v] for q, v in want.items()}
    assert all(abs(a[1] - b[1]) < 2e-6 for q in want for a, b in zip(got[q], want[q], strict=True))
    assert search.top_k(none, none.withColumnRenamed("doc_id", "query_id")).count() == 0


def labelled(spark, junk, good, n=300):
    rng = random.Random(9)
    rows = [(k, (junk if k % 4 == 0 else good)(rng), int(k % 4 != 0)) for k in range(n)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(n, None), (n + 1, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, 1 - y) for i, _, y in rows] + [(0, 0, 1), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark, lambda r: "BUY!! " * r.randint(3, 40), lambda r: " ".join(r.choices(WORDS, k=r.randint(5, 90))) + ".")
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).collect()
    assert all(0 <= r.score <= 1 and (r.doc_id >= 300 or (r.score >= 0.3) == (r.doc_id % 4 != 0)) for r in rows) and len(rows) == 302
    blind = quality.fit(docs, labels.limit(0))
    assert quality.score(docs, blind).filter("score >= 0.3").count() == 302


def test_toxicity_ignores_group_names(spark):
    bad = lambda r: " ".join(r.choices(WORDS, k=12) + ["idiot", "muslims"] * (r.random() < 0.7) + ["scum"])
    docs, labels = labelled(spark, bad, lambda r: " ".join(r.choices(WORDS, k=20)))
    model = toxicity.fit(docs, labels)
    test = spark.createDataFrame([(1, "the muslims there"), (2, "the women there"), (3, "you idiot scum"), (4, None), (5, "The MUSLIMS there")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(test, model).collect()}
    assert got[3] > 0.5 > max(got[1], got[2], got[4]) and got[1] == got[5]
    free = toxicity.fit(docs, labels, swap_penalty=0.0)
    loose = {r.doc_id: r.score for r in toxicity.score(test, free).collect()}
    assert abs(got[1] - got[2]) < abs(loose[1] - loose[2])
    assert toxicity.score(test, toxicity.fit(docs, labels.limit(0))).filter("score >= 0.5").count() == 0


def test_toxicity_holds_scores_of_texts_that_name_no_group(spark):
    """Counterfactuals are made for them too, also for rows that share a doc_id; columns and empty tables."""
    docs, labels = labelled(spark, lambda r: " ".join(r.choices(WORDS, k=12) + ["scum"]), lambda r: " ".join(r.choices(WORDS, k=20)))
    model = toxicity.fit(docs, labels)
    assert model.penalised > 100
    column, of = toxicity.Chosen(model.hashes).find(pa.array(["muslims", "femmes", "ausländer", "judíos"], pa.large_string()))
    assert set(of) == {0, 1, 2, 3}
    twice = toxicity.fit(docs.union(docs), labels)
    assert twice.penalised == 2 * model.penalised
    odd = spark.createDataFrame([(1, "you scum", 9.0), (1, None, 9.0), (None, "", 9.0)], "doc_id long, text string, score double")
    rows = toxicity.score(odd, model).collect()
    assert [r.doc_id for r in rows] == [1, 1, None] and rows[0].score > 0.5 > rows[1].score == rows[2].score
    assert toxicity.score(odd.limit(0), model).collect() == []
    assert toxicity.fit(docs.limit(0), labels).penalised == 0


def test_toxicity_gradient_and_optimum():
    """Against central differences of the loss written out, and no better point nearby."""
    rng = np.random.default_rng(8)
    x, y = (rng.random((60, 6)) < 0.4).astype(np.float32), (rng.random(60) < 0.3).astype(np.float32)
    changes = [[1, -3], [2, -1, 5], [-6], [], [4, -2]]
    delta = toxicity.Changes(changes, 6)
    dense = np.zeros((4, 6))
    for i, r in enumerate([c for c in changes if c]):
        for c in r:
            dense[i, abs(c) - 1] = np.sign(c)
    w = rng.normal(size=6)
    assert delta.n == 4 and np.allclose(delta.pull(w), dense.T @ (dense @ w) / 4, atol=1e-6)
    half = rng.random(6)
    assert np.allclose(delta.scaled(half).pull(w), (dense * half).T @ ((dense * half) @ w) / 4, atol=1e-6)

    def loss(w, b):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        each = np.where(y == 1, 2.0, 1.0)
        return -(each * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean() + 0.5e-3 * w @ w + 0.5 * np.square(dense @ w).sum() / 4

    best, b = toxicity.fit_logistic(x, y, delta, steps=4000)
    for k in range(7):
        for step in (-1e-2, 1e-2):
            moved, c = best.copy(), b
            if k < 6:
                moved[k] += step
            else:
                c += step
            assert loss(best, b) < loss(moved, c)


def test_toxicity_query_has_penalised_rows(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("sample tables not here")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    assert toxicity.fit(docs.select("doc_id", "text"), labels).penalised > 100


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>One.</p><svg viewBox='0 0 1 1' /><p>Two.</p>", ["One.", "Two."]),
        ("<p>One.</p><svg/><p>Two.</p><svg><title>x</title><text>no</text></svg><p>Three.</p>", ["One.", "Two.", "Three."]),
        ("<div><object data=x><p>Two.</p></div><p>Three.</p>", ["Two.", "Three."]),
        ("<p>One.</p><select><option>no<p>Two.</p>", ["One.", "no", "Two."]),
        ("<form><select><option>no</select><select><option>no</form><p>Two.</p>", ["no", "Two."]),
        ("<p>One.</p><SELECT><option>no</Select><p>Two.</p>", ["One.", "Two."]),
        ("<noscript><p>no</p></noscript><template><p>no</p></template><math><mi>x</mi></math><p>Two.</p>", ["Two."]),
        ("<p>One.</p><textarea>no</textarea><xmp><p>no</p></xmp><p>Two.</p><script>no", ["One.", "Two."]),
    ],
)
def test_elements_that_hold_no_page_text(page, want):
    assert [b.text for b in html_main.blocks(page)] == want


PAGE = """<html><head><title>T &amp; t</title><script>var p="</p>";</script></head><body><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="ad">Buy now.</div><article><h1>A  title&nbsp;here</h1><p>First <b>bold&amp; text<br>goes on, as it does.<p>Second paragraph, with <a href="/x">a link</a> in it.
<div class="comments"><p>Nice post, thanks.</p></div></article><form><label>Mail</label><input><button>Go</button></form><footer>&copy; site</footer></body>"""


def test_main_text(spark, corpus):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, "u", None, "x"), (3, "u", "", "x"), (4, None, "<p>" + "word and word, so. " * 9000 + "</p", "x"), (5, "u", "<!-- a", "x")], "page_id long, url string, html string, text string")
    chain = html_main.fit_pages(pages)
    got = {r.page_id: r.text for r in html_main.main_text(pages, chain).collect()}
    assert got[1] == "A title here\n\nFirst bold& text goes on, as it does.\n\nSecond paragraph, with a link in it."
    assert got[2] == got[3] == got[5] == "" and len(got[4]) > 100_000
    sentences = [t for _, text in corpus if text for t in text.split("\n") if t.strip()]
    pages = html_main.labelled_layouts(sentences, 200, seed=77)
    chain = html_main.fit(html_main.labelled_layouts(sentences, 600, seed=1))
    wrong = sum(a != b for f, y in pages for a, b in zip(chain.decode(chain.scores(f).tolist()), y, strict=True))
    assert wrong < 0.02 * sum(len(y) for _, y in pages)
    assert html_main.main_text(spark.createDataFrame([], "page_id long, html string"), chain).count() == 0


def test_chain_probabilities_by_enumeration():
    rng = np.random.default_rng(5)
    chain = html_main.Chain(step=rng.normal(size=(2, 2)), start=rng.normal(size=2))
    emit = rng.normal(size=5)
    total, one, best = 0.0, np.zeros(5), (-1e9, None)
    for y in itertools.product([0, 1], repeat=5):
        s = chain.start[y[0]] + sum(emit[k] * y[k] for k in range(5)) + sum(chain.step[y[k], y[k + 1]] for k in range(4))
        total += np.exp(s)
        one += np.exp(s) * np.array(y)
        best = max(best, (s, list(y)))
    assert np.allclose(chain.expected(emit)[0], one / total)
    assert chain.decode(emit.tolist()) == best[1]


def test_pipeline_on_the_sample(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("sample tables not here")
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        before = rows
        rows = stage(spark, rows, folder).cache()
        if name == "encode":
            break
        assert rows.columns == docs.columns
        if name == "lines":
            want = lines_by_force([(r.doc_id, r.text) for r in before.collect()])
            assert {r.doc_id: r.text for r in rows.collect()} == {i: t for i, t in want.items() if words_of(t)}
            assert rows.filter("n_chars <> length(text)").count() == 0
        if name == "near_duplicates":
            groups = groups_by_force([(r.doc_id, r.text) for r in before.collect()], 5)
            assert {r.doc_id for r in rows.collect()} == {i for i, (_, c) in groups.items() if i == c}
        if name == "benchmark":
            items = [re.sub(r"\s+", " ", r.text).lower() for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            left = {r.doc_id for r in rows.collect()}
            for r in before.collect():
                assert (r.doc_id in left) != any(x in re.sub(r"\s+", " ", r.text).lower() for x in items)
    kept = {r.doc_id: r.text for r in before.collect()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in rows.collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(kept[r.doc_id], add_special_tokens=False).ids


def test_stages_keep_odd_rows_and_columns(spark, corpus):
    """Null, empty and repeated rows, columns named like those the operators make, an empty table."""
    from seriesmill.llm import stages

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("sample tables not here")
    schema = "doc_id long, text string, n_chars long, n_lines int, n_removed int, gone int, gone0 string, quality_score double, leaks int, component_id int"
    rows = [(i, t, 7, 1, 7, 3, "g", 0.5, 4, 5) for i, t in corpus[:40]] + [(None, None, 0, 1, 7, 3, "g", 0.5, 4, 5), (None, "a b", 0, 1, 7, 3, "g", 0.5, 4, 5)]
    docs = spark.createDataFrame(rows, schema)
    for stage in (stages.keep_quality, stages.drop_repeated_lines, stages.one_of_each_group, stages.drop_leaked):
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        for r in kept.collect():
            assert (r.n_lines, r.n_removed, r.gone, r.gone0, r.quality_score, r.leaks, r.component_id) == (1, 7, 3, "g", 0.5, 4, 5)
        assert stage(spark, docs.limit(0), folder).count() == 0
    assert stages.drop_repeated_lines(spark, docs, folder).filter("doc_id IS NULL").count() == 2
    assert stages.encode(spark, docs, folder).columns == ["doc_id", "n_tokens", "ids", "decoded"]


def test_digests_of_the_queries(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("sample tables not here")
    from seriesmill.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    library = Tokenizer.from_file(WORD_VOCABULARY)
    for r in QUERIES["op3_bpe_round_trip"](spark, folder).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    want = strings_by_force(texts.items())
    for r in QUERIES["op9_suffix_dedup"](spark, folder).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans) == want[r.doc_id][:3] and r.kept_sha256 == hashlib.sha256(want[r.doc_id][3]).hexdigest()
