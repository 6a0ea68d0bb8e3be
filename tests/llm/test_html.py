"""The scan against brute force, the walk against a plain one, labels that the features do not give away, very long pages."""

from __future__ import annotations

import random
import time
from collections import Counter

import pytest

from tests.llm import data
from tidewell.llm import html_extract as hx


def test_the_best_run_against_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        scores = [rng.choice([-3, -1, -0.5, 0, 0.5, 2, 4]) for _ in range(rng.randint(0, 14))]
        begin, end = hx.best_run(scores)
        every = [(sum(scores[i:j]), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        assert sum(scores[begin:end]) == max([0, *(s for s, _, _ in every)])
        assert (begin == end) == (max([0, *(s for s, _, _ in every)]) == 0)


def slow_walk(page: str) -> list[tuple[str, list[str]]]:
    """Each text with the names of the elements around it, found by searching the whole stack at every tag."""
    stack, out = [], []
    for kind, name, _ in hx.tokens(page):
        if kind == "text":
            if name.strip() and not any(x in hx.NEVER for x in stack):
                out.append((name, list(stack)))
        elif kind == "open" and name not in hx.VOID:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i] in hx.ENDS.get(name, ()):
                    del stack[i:]
                    break
                if stack[i] in hx.FENCE:
                    break
            if name in hx.BLOCK and "p" in stack:
                i = max(i for i, x in enumerate(stack) if x == "p")
                if not any(x in hx.FENCE for x in stack[i:]):
                    del stack[i:]
            stack.append(name)
        elif kind == "close":
            for i in range(len(stack) - 1, -1, -1):
                if stack[i] == name:
                    del stack[i:]
                    break
                if stack[i] in hx.BARRIER and name not in hx.WHOLE:
                    break
    return out


def test_the_walk_against_a_plain_one():
    rng = random.Random(2)
    names = "p p p div li li ul span b a nav article main form td tr table th dt dd aside footer h1 br script option select body".split()
    for _ in range(1500):
        page = "".join(rng.choice([f"<{n}>", f"<{n}>", f"</{n}>", "word ", "two words "]) for n in rng.choices(names, k=rng.randint(0, 40)))
        got = []
        for kind, text, element, _ in hx.walk(page):
            if kind == "words":
                around = []
                while element:
                    around.insert(0, element.name)
                    element = element.parent
                got.append((text, around))
        assert got == slow_walk(page), page


@pytest.mark.parametrize("page", ["<span>x" * 100_000, "<span>" * 50_000 + "<li>y</li>" * 50_000, "<b><nav>" + "<span>x" * 50_000 + "</b>" * 50_000, "<p>x<div>" * 50_000, "".join(f"<div class='a{i}'>x" for i in range(50_000)), "<" * 100_000, "<a b='" * 2_000])
def test_very_long_pages_take_linear_time(page):
    began = time.perf_counter()
    hx.extract(page, hx.Weights(Counter()))
    hx.count(f"<article>{page}")
    assert time.perf_counter() - began < 60


def made(rng: random.Random, box: str) -> tuple[str, str]:
    """A page whose article is in the element ``box``, and its main text."""
    s = lambda n: f"{data.words(rng, n).capitalize()}."
    title, body = data.words(rng, 5), [s(rng.randint(4, 60)) for _ in range(rng.randint(2, 7))]
    menu = "".join(f"<li><a href=x>{data.words(rng, 2)}</a></li>" for _ in range(8))
    aside = f"<div class='sidebar'><ul>{menu}</ul></div>"
    advert = f"<div class='ad'>{s(15)}</div>"
    at = rng.randint(1, len(body))
    inner = "".join(f"<p>{x}</p>" for x in body[:at]) + advert + "".join(f"<p>{x}</p>" for x in body[at:])
    notes = f"<div class='comments'>{''.join(f'<p>{s(12)}</p>' for _ in range(3))}</div>"
    page = f"<html><head><title>{title}</title></head><body><nav><ul>{menu}</ul></nav>{aside}{advert}<{box}><h1>{title}</h1>{inner}{notes}</{box}><footer>{s(9)}</footer></body></html>"
    return page, "\n".join([title, *body])


@pytest.mark.parametrize("box", ["article", "main", "div", "div id=x7", "section", "td"])
def test_what_is_learned_holds_for_pages_that_do_not_name_their_content(box):
    """Trained on pages with an article; on others, found words against true ones."""
    rng = random.Random(3)
    counts: Counter = Counter()
    for _ in range(80):
        counts.update(hx.count(made(rng, "article")[0]))
    w = hx.Weights(counts)
    right = found = true = 0
    for _ in range(60):
        page, text = made(rng, box)
        got = hx.extract(page.replace(f"</{box}>", f"</{box.split()[0]}>"), w)
        a, b = Counter(got.split()), Counter(text.split())
        right, found, true = right + (a & b).total(), found + a.total(), true + b.total()
    assert right / found > 0.98 and right / true > 0.98, (right / found, right / true)


def test_counts_of_a_labelled_page_against_plain_ones():
    got = hx.count("<body><nav class='top menu'><a>one two</a></nav><article><p>three <b>four</b> five six.</p><div class=ad>seven</div></article></body>")
    want = {("el:nav", False): 2, ("is:top", False): 2, ("el:a", False): 2, ("el:p", True): 4, ("el:b", True): 1, ("is:ad", False): 1, ("all words", True): 4, ("all words", False): 3}
    assert {k: got[k] for k in want} == want and got["el:p", False] == 0 and not any(k in ("el:article", "el:div") for k, _ in got)
    assert hx.count("<p>no labels</p>") is None and hx.count(None) is None and hx.count("<article>a</article><article>b</article>") is None
