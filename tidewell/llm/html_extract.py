"""Main text of web pages as a maximum-scoring subsequence.

A page is a sequence of words and tags. A word scores by the elements that
enclose it (their names, the words of their classes, ids and roles, whether they
are links) and by the run of text that it stands in (how long, whether it has a
full stop); a tag scores negative. The weights are log-odds learned from labelled
pages. One linear scan finds the contiguous run of tokens with the highest sum;
within it, blocks that score negative themselves (an advert or a comment form
amid the article) are left out.

Labelled pages are pages whose markup names the content (one ``article`` or
``main`` element): what stands in it, outside menus, forms and the like, is
content. That an element is called so, and containers that say nothing (``div``,
``section``), are no features, so what is learned holds for pages without such
markup. Where a page does name its content, this counts by a fixed weight.
"""

from __future__ import annotations

import html as htmllib
import math
import re
import sys
from collections import Counter

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, received, sent, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Elements without an end tag, elements whose content is no markup, elements that are never text, block elements (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
NEVER = frozenset("script style textarea title head noscript template svg canvas iframe object audio video select option button datalist math map noembed noframes xmp".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTENT = frozenset(("article", "main"))
CHROME = frozenset("nav aside footer form menu dialog".split())
_CHROME_NAMES = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banners?|breadcrumbs?|comments?|cookies?|consent|disclaimer|disqus|footer|header|masthead|menu|modal|nav\w*|newsletter|notices?|pagination|pager|popup|promo\w*|related|replies|respond|share|sharing|sidebar|side|skip|social|sponsor\w*|subscribe|toolbar|widgets?)(?:$|[\s_-])", re.I)
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]*))?""")
#: An open one of these is ended by the start of such another (fixed values).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FENCE = frozenset("article main body html nav aside footer header form section div table ul ol dl td th".split())


def tokens(page: str):
    """("open", name, attributes), ("close", name, ""), ("text", text, "") of a page, in order."""
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:], ""
            return
        if lt > at:
            yield "text", page[at:lt], ""
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        after = page[lt + 1 : lt + 2]
        if after in ("!", "?") or (after == "/" and not page[lt + 2 : lt + 3].isalpha()):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt) if after == "/" or (after.isascii() and after.isalpha()) else None
        if not m:
            if after == "/" or (after.isascii() and after.isalpha()):
                end = page.find(">", lt)  # a quote without an end: the tag is up to the next >
                name = re.match(r"</?([A-Za-z][^\s/>]*)", page[lt : lt + 80])
                at = n if end < 0 else end + 1
                if end >= 0 and name:
                    yield ("close" if after == "/" else "open"), name[1].lower(), ""
                continue
            yield "text", "<", ""
            at = lt + 1
            continue
        name = m[2].lower()
        at = m.end()
        yield ("close" if m[1] else "open"), name, m[3]
        if not m[1] and name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            at = n if end is None else end.start()


def _is_chrome(name: str, attrs: str, within_content: bool) -> bool:
    if name in CHROME or (name == "header" and not within_content):
        return True
    if "=" not in attrs or name in ("article", "main", "body", "html"):
        return False
    for key, value in _ATTR.findall(attrs):
        value = value.strip("\"'")
        key = key.lower()
        if key in ("class", "id") and _CHROME_NAMES.search(value) or key == "role" and value.lower() in _CHROME_ROLES:
            return True
    return False


#: Elements whose names are no features: the labels are made of the first two, the others stand everywhere.
PLAIN = CONTENT | frozenset("html body div section span font center".split())
#: An end tag does not end what encloses one of these, but for those that name a whole page or article.
BARRIER = CONTENT | frozenset("nav aside footer form".split())
WHOLE = frozenset("body html article main".split())
_NAME_WORDS = re.compile(r"[a-z]+")


def signs_of(name: str, attrs: str, within_content: bool) -> tuple[str, ...]:
    """The features of an element: its name, and the words of its class, id and role."""
    out = [] if name in PLAIN else ["header in article" if name == "header" and within_content else f"el:{name}"]
    if "=" in attrs and name not in WHOLE:
        said: dict[str, None] = {}
        for key, value in _ATTR.findall(attrs):
            key = key.lower()
            if key in ("class", "id", "role"):
                value = value.strip("\"'")
                said |= dict.fromkeys(f"is:{w}" for w in _NAME_WORDS.findall(value.lower()))
                if key != "role" and _CHROME_NAMES.search(value) or key == "role" and value.lower() in _CHROME_ROLES:
                    said = {"is furniture": None, **said}
        out += said
    return tuple(out)


class Element:
    """An open element, with what holds for the text in it."""

    __slots__ = ("barrier", "chrome", "content", "fence", "name", "never", "parent", "score", "signs", "words")

    def __init__(self, name: str, signs: tuple[str, ...], parent: Element | None, attrs: str, weigh):
        content = parent.content if parent else False
        self.name, self.signs, self.parent = name, signs, parent
        self.never = name in NEVER or bool(parent and parent.never)
        self.chrome = bool(parent and parent.chrome) or _is_chrome(name, attrs, content)
        self.content = content or name in CONTENT
        self.score = (parent.score if parent else 0.0) + weigh(signs)
        self.words = [0, 0]
        self.fence = self.barrier = False


class Open:
    """The stack of open elements. Every tag costs what it opens and ends, however deep the stack is."""

    def __init__(self, weigh, ended):
        self.stack: list[Element] = []
        self.weigh, self.ended = weigh, ended
        self.fences: list[Counter] = [Counter()]
        self.barriers: list[Counter] = [Counter()]
        self.whole: Counter = Counter()

    def top(self) -> Element | None:
        return self.stack[-1] if self.stack else None

    def _pop(self) -> Element:
        e = self.stack.pop()
        self.fences[-1][e.name] -= 1
        self.barriers[-1][e.name] -= 1
        if e.fence:
            self.fences.pop()
        if e.barrier:
            self.barriers.pop()
        if e.name in WHOLE:
            self.whole[e.name] -= 1
        self.ended(e, self.top())
        return e

    def _end(self, names) -> None:
        while self._pop().name not in names:
            pass

    def open(self, name: str, attrs: str) -> None:
        ends = ENDS.get(name)
        if ends and any(self.fences[-1][x] > 0 for x in ends):
            self._end(ends)
        if name in BLOCK and self.fences[-1]["p"] > 0:
            self._end(("p",))  # a block ends an open paragraph, with the inline elements in it
        parent = self.top()
        e = Element(name, signs_of(name, attrs, bool(parent and parent.content)), parent, attrs, self.weigh)
        if name in FENCE:
            e.fence = True
            self.fences.append(Counter())
        if name in BARRIER:
            e.barrier = True
            self.barriers.append(Counter())
        self.fences[-1][name] += 1
        self.barriers[-1][name] += 1
        if name in WHOLE:
            self.whole[name] += 1
        self.stack.append(e)

    def close(self, name: str) -> None:
        if self.barriers[-1][name] > 0 or name in WHOLE and self.whole[name] > 0:
            self._end((name,))

    def rest(self) -> None:
        while self.stack:
            self._pop()


def walk(page: str | None, weigh=lambda signs: 0.0, ended=lambda e, parent: None):
    """("tag", name, None, block), ("words", text, its element, block) and ("space", "", None, block) of a page, in order.

    ``weigh`` gives the weight of an element's signs, which adds up over what
    encloses it; ``ended`` is told of every element that ends, and of its parent.
    """
    still = Open(weigh, ended)
    block = 0
    for kind, name, attrs in tokens(page or ""):
        top = still.top()
        never = bool(top and top.never)
        if kind == "text":
            if not never:
                yield ("words", name, top, block) if name.strip() else ("space", "", None, block)
            continue
        if name in BLOCK:
            block += 1
        if name == "br":
            yield "space", "", None, block
        if not never and name not in NEVER:
            yield "tag", name, None, block
        if kind == "close":
            still.close(name)
        elif name not in VOID:
            still.open(name, attrs)
    still.rest()


def run_signs(text: str, words: int) -> tuple[str, str]:
    """Features of a run of text: how many words it has, and whether a sentence ends in it."""
    return f"words:{min(4, words.bit_length() // 2)}", f"stop:{int(any(x in text for x in '.!?'))}"


#: Weights of what labelled pages do not tell: elements and names as seen on ordinary pages.
PRIOR = {"el:p": 1.0, "el:h1": 0.6, "el:h2": 0.5, "el:li": -0.3, "el:a": -1.2, "el:header": -3.0, "is furniture": -5.0, "words:0": -0.3, "words:1": -0.2, "words:2": 0.1, "words:3": 0.4, "words:4": 0.8, "stop:1": 0.3, "stop:0": -0.2} | {f"el:{x}": -5.0 for x in CHROME}
TAG_PRIOR = -0.4
#: Of a page that names its content, for words in it and for words beside it.
NAMED = (0.5, -4.0)
#: What fewer words than this have is not learned.
LEAST_SEEN = 50


def names_content(page: str) -> bool:
    return len(re.findall(r"<(?:article|main)[\s>]", page, re.I)) == 1


def count(page: str | None) -> Counter | None:
    """(feature, is content) counts of a labelled page; None of a page that is not labelled."""
    if not page or not names_content(page):
        return None
    out: Counter = Counter()
    inside = False

    def ended(e: Element, parent: Element | None) -> None:
        for k in (0, 1):
            for sign in set(e.signs):
                out[sign, bool(k)] += e.words[k]
            if parent:
                parent.words[k] += e.words[k]

    for kind, name, element, _ in walk(page, ended=ended):
        if kind == "words":
            n = len(name.split())
            inside = bool(element and element.content and not element.chrome)
            out["all words", inside] += n
            if element:
                element.words[inside] += n
            for sign in run_signs(name, n):
                out[sign, inside] += n
        elif kind == "tag":
            out["all tags", inside] += 1
            out[f"tag:{name}", inside] += 1
    return out


class Weights:
    """Log-odds of words' features and of tags, in favour of content."""

    def __init__(self, counts: Counter):
        self.signs = dict(PRIOR)
        self.tags: dict[str, float] = {}
        total = {k: (counts[k, True] + 1, counts[k, False] + 1) for k in ("all words", "all tags")}
        if counts["all words", True] and counts["all words", False]:
            for f in sorted({f for f, _ in counts} - set(total)):
                a, b = total["all tags" if f.startswith("tag:") else "all words"]
                x = math.log((counts[f, True] + 0.5) / (a + 1)) - math.log((counts[f, False] + 0.5) / (b + 1))
                if f.startswith("tag:"):
                    self.tags[f[4:]] = min(-0.1, max(-3.0, x))
                elif counts[f, True] + counts[f, False] >= LEAST_SEEN:
                    # short lines are common in menus and no less in articles: a run's own features decide only where elements say little
                    self.signs[f] = max(-0.75, min(0.75, x)) if f.startswith(("words:", "stop:")) else max(-4.0, min(2.0, x))

    def of(self, signs) -> float:
        return sum(self.signs.get(s, 0.0) for s in signs)

    def word(self, element: Element | None, text: str, words: int, named: bool) -> float:
        said = (element.score if element else 1.0) + self.of(run_signs(text, words))  # text without any markup is text
        if named:
            said += NAMED[0 if element and element.content else 1]
        # a word counts against a run less than for it, so that an advert does not part an article; its block is left out
        return max(-1.0, min(2.0, said))

    def tag(self, name: str) -> float:
        return self.tags.get(name, TAG_PRIOR)


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous run of the highest sum, (begin, end), by one scan; the first of equal ones; empty where no sum is above 0."""
    best, start, run, span = 0.0, 0, 0.0, (0, 0)
    for i, s in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += s
        if run > best:
            best, span = run, (start, i + 1)
    return span


def extract(page: str | None, weights: Weights) -> str:
    """The main text: blocks joined by newlines, white space within a block one space, character references decoded.

    The empty string for null, and for a page without a run that scores above 0.
    """
    named = names_content(page or "")
    items = list(walk(page, weights.of))
    scores = []
    for kind, name, element, _ in items:
        n = len(name.split()) if kind == "words" else 0
        scores.append(weights.tag(name) if kind == "tag" else weights.word(element, name, n, named) * n)
    begin, end = best_run(scores)
    blocks: dict[int, list] = {}
    for (kind, name, _, block), s in zip(items[begin:end], scores[begin:end]):
        if kind in ("words", "space"):
            held = blocks.setdefault(block, [0.0, []])
            held[0] += s
            held[1].append(name or " ")
    out = []
    for _, (score, parts) in sorted(blocks.items()):
        if score > 0:
            text = " ".join(htmllib.unescape("".join(parts)).split())
            if text:
                out.append(text)
    return "\n".join(out)


def fit(pages: DataFrame, max_pages: int = 2000) -> Weights:
    """Weights from at most ``max_pages`` labelled and other pages, the first in hash order of their html; those without labels do not count."""
    keyed = pick(pages, "html").where("html is not null").withColumn("h", F.xxhash64("html"))
    chosen = keyed.select("h").distinct().orderBy("h").limit(max_pages)  # a proven bound for the broadcast

    def run(batches):
        seen: set[int] = set()
        for b in slices(batches):
            rows: list[tuple[int, str, bool, int]] = []
            for page, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if h not in seen:
                    seen.add(h)
                    rows += [(h, f, y, n) for (f, y), n in (count(page) or {}).items()]
            cols = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.bool_(), pa.int64()))], names=["h", "f", "y", "n"])

    counted = keyed.join(F.broadcast(chosen), "h").select("html", "h").mapInArrow(run, "h long, f string, y boolean, n long")
    # copies of a page count once, in whatever partitions they are
    rows = counted.dropDuplicates(["h", "f", "y"]).groupBy("f", "y").agg(F.sum("n").alias("n")).collect()
    return Weights(Counter({(r["f"], r["y"]): r["n"] for r in rows}))


def extract_all(pages: DataFrame, weights: Weights, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` in place of ``html``. Null and empty html give the empty string; repeated rows each a result."""
    names = pages.columns
    at = names.index(html)
    packed = sent(pages.sparkSession, weights)

    def run(batches):
        weights = received(packed)
        for b in slices(batches):
            texts = [extract(t, weights) for t in b.column(at).to_pylist()]
            cols = list(b.columns)
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    flat = pages.toDF(*[f"c{i}" for i in range(len(names))])
    return flat.mapInArrow(run, flat.schema).toDF(*["text" if i == at else n for i, n in enumerate(names)])
