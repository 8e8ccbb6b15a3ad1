"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks of the element tree; each has features of its ancestors
(tags, words of class, id and role) and of its text. The chain's weights are learned
from labelled pages; Viterbi decoding tells which blocks are main text.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import pieces

#: Elements that hold raw text up to their end tag; it is never page text.
_RAW = "script|style|title|textarea|iframe|noembed|noframes|xmp"
#: Elements with content of their own that is no page text. Without an end tag they hold nothing.
_ASIDE = frozenset("template noscript svg select object math".split())
_ASIDE_END = re.compile(rf"</({'|'.join(sorted(_ASIDE))})\b", re.I)
_SCAN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<({_RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+[^>]*+)>?",
    re.S | re.I,
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open element of the second kind ends where one of the first kind begins.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_HOLDS = frozenset("ul ol dl table".split())
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class Block:
    path: tuple[str, ...]
    text: str
    link: int


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order; an element of a path is its tag and name words, blank-separated.

    An element of ``_ASIDE`` that closes itself, or whose end tag the page does not have, is
    empty: what follows is text again. A start tag of ``select`` ends an open one.
    """
    last_end = {m[1].lower(): m.start() for m in _ASIDE_END.finditer(page)}
    out: list[Block] = []
    path: list[str] = []
    tags: list[str] = []
    held: list[str] = []
    links: list[str] = []
    in_link = False

    def flush() -> None:
        if held:
            text = "" if _ASIDE.intersection(tags) else " ".join(entities.unescape("".join(held)).split())
            if text:
                link = len(" ".join(entities.unescape("".join(links)).split()))
                out.append(Block(tuple(path), text, link))
            held.clear()
            links.clear()

    def close(to: int) -> None:
        del path[to:], tags[to:]

    at = 0
    for m in _SCAN.finditer(page):
        if m.start() > at:
            held.append(page[at : m.start()])
            if in_link:
                links.append(page[at : m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        if name in _INLINE:
            if name == "a":
                in_link = not m[2]
            continue
        if name == "br":
            held.append(" ")
            continue
        flush()
        in_link = False
        if m[2]:
            for k in range(len(tags) - 1, -1, -1):
                if tags[k] == name:
                    close(k)
                    break
            continue
        if tags and tags[-1] == "p":
            close(len(tags) - 1)
        if name in _ENDS:
            for k in range(len(tags) - 1, -1, -1):
                if tags[k] in _HOLDS:
                    break
                if tags[k] in _ENDS[name]:
                    close(k)
                    break
        if name == "select" and name in tags:
            close(tags.index(name))
        if name in _ASIDE and (m[4].rstrip().endswith("/") or last_end.get(name, -1) < m.end()):
            continue
        if name not in _VOID:
            words = [name]
            if "=" in m[4]:
                for a in _NAMES.findall(m[4]):
                    words += _WORD.findall("".join(a).lower())
            tags.append(name)
            path.append(" ".join(words))
    held.append(page[at:])
    flush()
    return out


def text_features(b: Block, k: int, n: int) -> list[str]:
    words = b.text.count(" ") + 1
    share = b.link / len(b.text)
    return [
        f"words {min(words.bit_length(), 8)}",
        f"link {0 if not b.link else 1 if share < 0.3 else 2 if share < 0.8 else 3}",
        "stop" if b.text[-1] in ".!?…\"'”»)" else "open",
        "sign" if b.text[0] in "©®™|»›•·" else "plain",
        f"commas {min(b.text.count(','), 3)}",
        "first" if k == 0 else "last" if k == n - 1 else "between",
    ]


def element_features(element: str) -> list[str]:
    tag, *names = element.split(" ")
    return [f"in {tag}"] + [f"named {x}" for x in names]


def features(page: list[Block]) -> list[list[str]]:
    """Features of each block: of every ancestor but the outermost two kinds, of the nearest, of the text."""
    out = []
    for k, b in enumerate(page):
        f = text_features(b, k, len(page))
        for e in b.path:
            f += element_features(e)
        f.append(f"leaf {b.path[-1].split(' ')[0]}" if b.path else "leaf none")
        out.append(f)
    return out


@dataclass
class Chain:
    """Weights of a two-label chain: label 1 is main text."""

    emit: dict[str, float] = field(default_factory=dict)
    step: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))

    def scores(self, page: list[list[str]]) -> np.ndarray:
        get = self.emit.get
        return np.array([sum(get(x, 0.0) for x in f) for f in page])

    def decode(self, emit: list[float]) -> list[int]:
        """The likeliest labels (Viterbi) for the scores of label 1 over label 0."""
        if not emit:
            return []
        (s00, s01), (s10, s11) = self.step.tolist()
        a, b = self.start[0], self.start[1] + emit[0]
        back = []
        for e in emit[1:]:
            from0, from1 = a + s00 >= b + s10, a + s01 >= b + s11
            back.append((0 if from0 else 1, 0 if from1 else 1))
            a, b = (a + s00 if from0 else b + s10), (a + s01 if from1 else b + s11) + e
        label = 0 if a >= b else 1
        out = [label]
        for pair in reversed(back):
            label = pair[label]
            out.append(label)
        return out[::-1]

    def expected(self, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chance of label 1 at each block, and expected number of each step (forward-backward)."""
        n = len(emit)
        node = np.column_stack((np.zeros(n), emit))
        forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
        forward[0] = self.start + node[0]
        for k in range(1, n):
            forward[k] = np.logaddexp.reduce(forward[k - 1][:, None] + self.step, axis=0) + node[k]
        for k in range(n - 2, -1, -1):
            backward[k] = np.logaddexp.reduce(self.step + node[k + 1] + backward[k + 1], axis=1)
        total = np.logaddexp.reduce(forward[-1])
        steps = np.zeros((2, 2))
        for k in range(1, n):
            steps += np.exp(forward[k - 1][:, None] + self.step + node[k] + backward[k] - total)
        return np.exp(forward[:, 1] + backward[:, 1] - total), steps


def fit(pages: list[tuple[list[list[str]], list[int]]], epochs: int = 12, rate: float = 0.3, ridge: float = 1e-4, seed: int = 3) -> Chain:
    """Maximises the conditional likelihood of the labels, page by page, with falling steps per weight."""
    chain, square = Chain(), {}
    square_step, square_start = np.full((2, 2), 1e-2), np.full(2, 1e-2)
    rng = random.Random(seed)
    order = [k for k, (page, _) in enumerate(pages) if page]
    for _ in range(epochs):
        rng.shuffle(order)
        for k in order:
            page, labels = pages[k]
            chance, steps = chain.expected(chain.scores(page))
            gradient: dict[str, float] = {}
            for f, y, p in zip(page, labels, chance.tolist(), strict=True):
                for x in f:
                    gradient[x] = gradient.get(x, 0.0) + y - p
            for x, g in gradient.items():
                g -= ridge * chain.emit.get(x, 0.0)
                square[x] = square.get(x, 1e-2) + g * g
                chain.emit[x] = chain.emit.get(x, 0.0) + rate * g / square[x] ** 0.5
            seen = np.zeros((2, 2))
            np.add.at(seen, (labels[:-1], labels[1:]), 1)
            first = np.array([chance[0] - 1, -chance[0]]) + np.eye(2)[labels[0]]
            square_step += (seen - steps) ** 2
            chain.step += rate * (seen - steps) / np.sqrt(square_step)
            square_start += first**2
            chain.start += rate * first / np.sqrt(square_start)
    return chain


# Usual names of page parts that are not main text, of those that are, and of neither.
ASIDE_NAMES = (
    "nav menu navbar header masthead footer sidebar widget ad ads advert advertisement banner promo sponsored sponsor cookie cookies consent notice alert popup modal overlay "
    "newsletter subscribe signup login search comment comments reply discussion respond share social related recommended breadcrumb breadcrumbs pagination pager tags copyright legal"
).split()
MAIN_NAMES = "article content main post entry story articlebody body text story prose".split()
OTHER_NAMES = "wrapper container page site col row section block inner outer box group wrap area region".split()


def labelled_layout(sentences: list[str], rng: random.Random) -> tuple[str, list[str]]:
    """A page built by rule from the given texts, and the blocks of its main text.

    Layouts differ in what holds the article (a telling element, a telling name, or
    neither), in the parts around and inside it, and in their order.
    """
    word = lambda n: " ".join(rng.choice(sentences).split()[:n]) or "x"
    name = lambda pool: f' {rng.choice(["class", "id"])}="{rng.choice(pool)}{rng.choice(["", "", "-" + rng.choice(OTHER_NAMES), " " + rng.choice(OTHER_NAMES)])}"'
    esc = entities.escape
    main: list[str] = []

    def sentence() -> str:
        return " ".join(rng.choice(sentences) for _ in range(rng.choice([1, 1, 2, 4]))).strip() or "x"

    def menu() -> str:
        items = [word(rng.choice([1, 1, 2])) for _ in range(rng.randint(2, 8))]
        if rng.random() < 0.8:
            return "<ul>" + "".join(f'<li><a href="/{k}">{esc(x)}</a></li>' for k, x in enumerate(items)) + "</ul>"
        return " | ".join(f'<a href="/{k}">{esc(x)}</a>' for k, x in enumerate(items))

    def aside(inside: bool) -> str:
        kind = rng.choice(["menu", "box", "text", "comments", "form", "small"] if not inside else ["box", "comments", "form", "small", "menu"])
        tag = rng.choice(["div", "div", "section", "aside", "ul" if kind == "menu" else "div"])
        names = name(ASIDE_NAMES)
        if kind == "menu":
            return f"<nav>{menu()}</nav>" if rng.random() < 0.5 else f"<div{names}>{menu()}</div>"
        if kind == "comments":
            names = name(["comment", "comments", "discussion", "respond", "reply", "reactions"])
            each = "".join(f'<div{rng.choice([name(["comment", "reply"]), ""])}><p>{esc(sentence())}</p></div>' for _ in range(rng.randint(1, 4)))
            return f"<{tag}{names}><h3>{esc(word(2))}</h3>{each}</{tag}>"
        if kind == "form":
            return f'<form{rng.choice([names, ""])}><label>{esc(word(2))}</label><input name="q"><button>{esc(word(1))}</button><p>{esc(word(5))}</p></form>'
        if kind == "small":
            return f"<{tag}{names}>{esc(word(rng.choice([1, 2, 6])))}</{tag}>"
        plain = "".join(f"<p>{esc(sentence())}</p>" for _ in range(rng.randint(1, 2)))
        return f"<aside{rng.choice([names, ''])}>{plain}</aside>" if rng.random() < 0.4 else f"<{tag}{names}>{rng.choice([plain, esc(sentence())])}</{tag}>"

    def block(tag: str, text: str) -> str:
        text = " ".join(text.split())
        main.append(text)
        shown = esc(text)
        cut = shown.find(" ")
        if cut > 0 and "&" not in shown[:cut] and rng.random() < 0.25:
            shown = rng.choice(["<b>{}</b>", '<a href="/x">{}</a>', "<em>{}</em>", "<b>{}"]).format(shown[:cut]) + shown[cut:]
        return f"<{tag}>{shown}" + ("" if tag == "p" and rng.random() < 0.1 else f"</{tag}>")

    body = [block(rng.choice(["h1", "h1", "h2"]), word(9))] if rng.random() < 0.9 else []
    for _ in range(rng.choice([1, 2, 4, 8, 14])):
        kind = rng.random()
        if kind < 0.78:
            body.append(block("p", sentence()))
        elif kind < 0.86:
            body.append(block(rng.choice(["h2", "h3"]), word(4)))
        elif kind < 0.93:
            body.append("<ul>" + "".join(block("li", word(8)) for _ in range(rng.randint(1, 4))) + "</ul>")
        else:
            body.append("<blockquote>" + block("p", sentence()) + "</blockquote>")
        if rng.random() < 0.08:
            body.append(aside(True))
    if rng.random() < 0.3:
        body.append(aside(True))
    inner = "".join(body)
    holder = rng.random()
    if holder < 0.4:
        article = f"<article{rng.choice(['', name(MAIN_NAMES)])}>{inner}</article>"
    elif holder < 0.55:
        article = f"<main>{inner}</main>"
    elif holder < 0.85:
        article = f"<{(t := rng.choice(['div', 'section']))}{name(MAIN_NAMES)}>{inner}</{t}>"
    else:
        article = f"<div{rng.choice(['', name(OTHER_NAMES)])}>{inner}</div>"
    head = rng.choice([f"<header><a href='/'>{esc(word(2))}</a>{menu()}</header>", f"<nav>{menu()}</nav>", aside(False), f"<div{name(['header', 'nav', 'menu', 'top'])}>{menu()}</div>"])
    foot = rng.choice([f"<footer>&copy; {esc(word(1))}.net &middot; {esc(sentence())}</footer>", f"<footer><p>{esc(sentence())}</p>{menu()}</footer>", f"<div{name(['footer', 'copyright', 'legal'])}>&copy; {esc(word(3))}</div>", aside(False)])
    around = [aside(False) for _ in range(rng.choice([0, 1, 1, 2, 3]))]
    cut = rng.randint(0, len(around))
    whole = head + "".join(around[:cut]) + article + "".join(around[cut:]) + foot
    if rng.random() < 0.4:
        whole = f"<div{name(OTHER_NAMES)}>{whole}</div>"
    return f"<!DOCTYPE html><html><head><title>{esc(word(6))}</title><script>var a=1;</script></head><body>{whole}</body></html>", main


def labelled_layouts(sentences: list[str], n: int, seed: int = 11) -> list[tuple[list[list[str]], list[int]]]:
    """Features and labels of ``n`` pages built by rule."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        page, main = labelled_layout(sentences, rng)
        found, labels, k = blocks(page), [], 0
        for b in found:
            hit = k < len(main) and b.text == main[k]
            labels.append(int(hit))
            k += hit
        if k == len(main):
            out.append((features(found), labels))
    return out


def fit_pages(pages: DataFrame, html: str = "html", page_id: str = "page_id", most_pages: int = 200, most_sentences: int = 5_000, layouts: int = 1_500) -> Chain:
    """Learns the chain from ``layouts`` labelled pages made of the words of the table.

    The words are at most ``most_sentences`` sentences of at most ``most_pages`` pages,
    both chosen by hashes; the labels come from the rule that builds the pages.
    """
    sample = pages.select(page_id, html).filter(F.length(html) > 0).orderBy(F.xxhash64(page_id), page_id).limit(most_pages).select(html)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page in batch.column(html).to_pylist():
                texts = (p for b in blocks(page) for p in re.split(r"(?<=[.!?])\s+", b.text))
                yield pa.RecordBatch.from_arrays([pa.array([" ".join(t.split()[:40]) for t in texts if t.strip()], pa.string())], ["s"])

    rows = sample.mapInArrow(cut, "s string").distinct().orderBy(F.xxhash64("s"), "s").limit(most_sentences).collect()
    return fit(labelled_layouts(sorted(r["s"] for r in rows) or ["The quick brown fox jumps over the lazy dog."], layouts))


class Reader:
    """Main text of pages; the score of an element is looked up once in a task."""

    def __init__(self, chain: Chain):
        self.chain, self.seen = chain, {}

    def element(self, e: str) -> float:
        if e not in self.seen:
            if len(self.seen) > 50_000:
                self.seen.clear()
            self.seen[e] = sum(self.chain.emit.get(x, 0.0) for x in element_features(e))
        return self.seen[e]

    def main_blocks(self, page: str) -> list[str]:
        found = blocks(page)
        get = self.chain.emit.get
        emit = []
        for k, b in enumerate(found):
            score = sum(get(x, 0.0) for x in text_features(b, k, len(found)))
            score += get(f"leaf {b.path[-1].split(' ')[0]}" if b.path else "leaf none", 0.0)
            emit.append(score + sum(self.element(e) for e in b.path))
        return [b.text for b, y in zip(found, self.chain.decode(emit), strict=True) if y]


def main_text(pages: DataFrame, chain: Chain, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page, blocks joined by two line breaks.

    Null or empty html gives an empty text, as does a page without main text. A column
    of ``pages`` named ``out`` is replaced. Rows are independent: no shuffle.
    """
    kept = [f for f in pages.schema.fields if f.name != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(chain)
        for batch in batches:
            for part in pieces(batch, html):
                texts = ["\n\n".join(reader.main_blocks(x)) if x else "" for x in part.column(html).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(f.name) for f in kept] + [pa.array(texts, pa.string())], [f.name for f in kept] + [out])

    return pages.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{out}` string"]))
