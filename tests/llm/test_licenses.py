"""License scan against a matcher that tries every way through a template, and odd rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from seriesmill.llm import licenses
from seriesmill.llm.licenses import PHRASES, TEMPLATES, Automaton, Reader, Template, mandatory, parsed, scan

SCHEMA = "doc_id long, text string, labels string, score double, n_words int"


def words_of(text):
    low = (text or "").translate({k: k + 32 for k in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def ends(items, words, at):
    """Where the items can end if they begin at ``at``."""
    if not items:
        return {at}
    item, rest = items[0], items[1:]
    if isinstance(item, str):
        return ends(rest, words, at + 1) if words[at : at + 1] == [item] else set()
    if isinstance(item, list):
        return set().union(*(ends(rest, words, e) for e in ends(item, words, at) | {at}))
    low, high = item
    return set().union(*(ends(rest, words, at + k) for k in range(low, high + 1) if at + k <= len(words)))


def by_force(text, templates):
    words = words_of(text)
    places, base, every, longest = [], set(), set(), 0
    for t in templates:
        starts = [k for k in range(len(words)) if ends(parsed(t.wording), words, k)]
        if starts:
            every.add(t.label)
            longest = max(longest, mandatory(parsed(t.wording)))
            if t.base:
                base.add(t.label)
                places += starts
    span = (min(places), max(places)) if places else (None, None)
    return (len(words), len(places), *span, ",".join(sorted(base)), ",".join(sorted(every)), longest / (longest + 1))


def written_out(items, rng):
    out = []
    for item in items:
        if isinstance(item, str):
            out.append(item.upper() if rng.random() < 0.2 else item)
        elif isinstance(item, list):
            out += written_out(item, rng) if rng.random() < 0.5 else []
        else:
            out += [rng.choice(["acme", "the", "é1", "license", "under"]) for _ in range(rng.randint(max(0, item[0] - 1), item[1] + 1))]
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    texts = ["", None, " \n", "mit", "under the mit license" * 3, "cc by nc cc by nc", "CC-BY-NC\x00cc by\tnc", "x" * 3000]
    marks = [" ", "\n", ", ", "-", "\x00"]
    for t in list(PHRASES + TEMPLATES) * 6:
        words = written_out(parsed(t.wording), rng)
        if rng.random() < 0.3:
            words.pop(rng.randrange(len(words)))
        around = [rng.choice(["this", "is", "über", "the", "copyright", "licensed", "a"]) for _ in range(6)]
        texts.append("".join(w + rng.choice(marks) for w in around[:3] + words + around[3:] + (words if rng.random() < 0.2 else [])))
    return texts


def test_scan_by_force(spark, texts):
    rows = [(k if k % 7 else None, t, "x", 2.0, 1) for k, t in enumerate(texts)] + [(3, texts[3], "", 0.0, 0)]
    got = sorted(map(tuple, scan(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()), key=repr)
    assert got == sorted(((r[0], *by_force(r[1], PHRASES + TEMPLATES)) for r in rows), key=repr)
    assert sum(bool(r[6]) for r in got) > 80 and sum(not r[6] for r in got) > 20
    assert scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_nested_and_replaceable_regions():
    templates = (Template("a", "x [y [z <1-2>] w] q"), Template("b", "x <0-3> q <2-2> x"), Template("c", "q x q", True))
    automaton, rng = Automaton(templates), random.Random(2)
    reader = Reader(automaton)
    texts = [" ".join(rng.choices("xyzwqo", k=rng.randint(0, 14))) for _ in range(400)]
    words, count = reader.read(pa.array(texts))
    assert count.tolist() == [len(t.split()) for t in texts]
    begin = np.concatenate(([0], np.cumsum(count + 1)))
    got = {(int(np.searchsorted(begin, s, "right")) - 1, int(s), int(e), int(k)) for s, e, k in zip(*automaton.matches(words), strict=True)}
    want = set()
    for o, t in enumerate(texts):
        for k, template in enumerate(templates):
            for s in range(count[o]):
                want |= {(o, int(begin[o]) + s, int(begin[o]) + e, k) for e in ends(parsed(template.wording), t.split(), s)}
    assert got == want
    automaton.MOST = 1
    assert {tuple(map(int, x)) for x in zip(*automaton.matches(words), strict=True)} == {x[1:] for x in want}


def test_long_texts_are_read_in_stretches(monkeypatch, texts):
    whole = " ".join(t for t in texts if t)
    automaton = Automaton(PHRASES + TEMPLATES)
    reader = Reader(automaton)
    want = reader.read(pa.array([whole, "a", None, whole]))
    monkeypatch.setattr(Reader, "STRETCH", 50)
    got = reader.read(pa.array([whole, "a", None, whole]))
    assert all((a == b).all() for a, b in zip(got, want, strict=True))


@pytest.mark.parametrize("wording", ["a ] b", "a [ b", "<3-1> a", "a <0-0>", "[a]", ""])
def test_wrong_markup_is_refused(wording):
    with pytest.raises(ValueError):
        parsed(wording)


def test_every_template_is_found_in_its_own_wording():
    for t in PHRASES + TEMPLATES:
        bare = " ".join(i if isinstance(i, str) else " ".join(["w"] * max(1, i[0])) for i in parsed(t.wording) if not isinstance(i, list))
        assert t.label in by_force(bare, licenses.PHRASES + licenses.TEMPLATES)[5].split(",")
