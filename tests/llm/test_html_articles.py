"""Marked articles with lists, tables and short blocks."""

import math
import random
import statistics
from xml.etree import ElementTree

import pytest

from tidegate.llm import html_text


@pytest.mark.parametrize("size, paragraphs, items", [(500, 6, 8), (300, 3, 5)])
@pytest.mark.parametrize("mark", ["article", "main"])
def test_a_marked_article_is_kept_whole(size, paragraphs, items, mark):
    prose = [("word " * size)[: size - 1] + "." for _ in range(paragraphs)]
    short = [f"item number {k} of the list" for k in range(items)]
    blocks = [f"short block {k}" for k in range(3)]
    long = "".join(f"<p>{p}</p>" for p in prose)
    inner = (
        f"{long}<h2>First</h2><ul>{''.join(f'<li>{x}</li>' for x in short)}</ul><h2>Second</h2>{long}"
        "<h2>Third</h2><table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>"
        f"<aside>Aside</aside>{''.join(f'<div>{b}</div>' for b in blocks)}<section><p>Bye</p></section>"
        f"<div class=share><a>Share</a></div><blockquote>Said</blockquote>{long}"
    )
    page = f"<body><nav>menu</nav><div>{'outside ' * 200}</div><{mark}>{inner}</{mark}><footer>foot</footer></body>"
    want = [*prose, "First", *short, "Second", *prose, "Third", "a", "b", "1", "2", *blocks, "Bye", "Said", *prose]
    assert html_text.main_text(page) == " ".join(want)


@pytest.mark.parametrize("mark", ["article", "main", "div"])
def test_names_do_not_silence_headings_and_paragraphs(mark):
    prose = "".join(f"<p>{'word ' * 60}{k}</p>" for k in range(4))
    inner = f'{prose}<h2 id="search">Search</h2>{prose}<p class="legal">On the law</p>{prose}<h3 class="related">Related</h3>{prose}'
    text = html_text.main_text(f"<body><nav>menu</nav><{mark}><h1>Title</h1>{inner}</{mark}><footer>foot</footer></body>")
    assert text.startswith("Title") and text.count("word") == 960 and "foot" not in text and "menu" not in text
    assert all(part in text for part in ("Search", "On the law", "Related"))


def test_ids_inside_an_article_do_not_silence():
    inner = f'<p>{"word " * 60}</p><div id="related-work"><p>Earlier work</p></div><div id="comments-on-law"><p>On comments</p></div><div id="search"><p>On search</p></div>'
    noise = '<div id="comments"><p>Nice</p></div><div class="comments"><p>First!</p></div><section class="ad-box"><p>Buy</p></section><div role="alert">Cookies</div>'
    text = html_text.main_text(f"<article>{inner}{noise}</article>")
    assert text == "word " * 60 + "Earlier work On comments On search"


def test_a_heading_in_a_page_header_is_silent():
    prose = "".join(f"<p>{'word ' * 60}</p>" for _ in range(3))
    page = f"<body><header><h1>My Site</h1><p>tagline here</p><a>Home</a></header><div><h2>Title</h2>{prose}</div></body>"
    assert html_text.main_text(page) == " ".join(["Title", *["word"] * 180])


def test_a_marked_stub_does_not_beat_the_text_of_the_page():
    prose = [f"{'word ' * 80}{k}" for k in range(12)]
    gap = "".join(f"<p><a>{k}</a></p>" for k in range(12))
    page = f"<body><article><p><a>More</a></p></article>{gap}<div>{''.join(f'<p>{p}</p>' for p in prose)}</div></body>"
    assert html_text.main_text(page) == " ".join(prose)


SILENT = {"nav", "aside", "footer", "script", "form", "header"}
BLOCKS = {"body", "article", "div", "p", "h1", "h2", "ul", "li", "section", "table", "tr", "td"}
CONTAINERS = {"body", "article", "div", "section", "ul", "table", "td"}


def plain_main_text(page):
    """The method by a tree of the whole page and sums over all lines."""
    lines, state = [], {"text": "", "tags": 0, "heading": False, "region": 1}

    def end_line(marked):
        text = " ".join(state["text"].split())
        if text:
            lines.append((text, state["tags"], 0 if marked else state["region"], state["heading"]))
        state.update(text="", tags=0, heading=False)

    def walk(node, marked):
        if node.tag in SILENT or node.get("class") == "ad":
            end_line(marked)
            state["region"] += 1
            return
        if node.tag in BLOCKS:
            end_line(marked)
            state["heading"] = node.tag in ("h1", "h2")
        state["region"] += node.tag in CONTAINERS
        state["tags"] += 1
        within = marked or node.tag == "article"
        state["text"] += node.text or ""
        for child in node:
            walk(child, within)
            state["text"] += child.tail or ""
        state["tags"] += 1
        if node.tag in BLOCKS:
            end_line(within)
        state["region"] += node.tag in CONTAINERS

    walk(ElementTree.fromstring(page), False)
    ratios, reach = [len(text) / max(tags, 1) for text, tags, *_ in lines], math.ceil(3 * html_text.SIGMA)
    weights = {k: math.exp(-0.5 * (k / html_text.SIGMA) ** 2) for k in range(-reach, reach + 1)}
    smooth = [
        sum(w * ratios[min(max(i + k, 0), len(ratios) - 1)] for k, w in weights.items()) / sum(weights.values()) for i in range(len(ratios))
    ]
    threshold = min(statistics.pstdev(smooth), max(smooth))
    content = {line[2] for line, r in zip(lines, smooth, strict=True) if r >= threshold}
    if 0 in content:
        content = {0}
    out = []
    for text, _, region, _ in lines:
        own = [line for line in lines if line[2] == region]
        dense = sum(len(x[0]) for x in own) >= threshold * sum(x[1] for x in own)
        if region in content and (region == 0 or dense or any(x[3] for x in own)):
            out.append(text)
    return " ".join(out)


@pytest.mark.parametrize("mark", ["article", "div"])
def test_regions_equal_a_plain_computation(mark):
    chance = random.Random(11)

    def words(n):
        return " ".join(chance.choice(["alpha", "be", "gamma", "to", "of", "delta-epsilon"]) for _ in range(n))

    def block():
        kind = chance.randrange(6)
        if kind == 0:
            return f"<ul>{''.join(f'<li>{words(3)}</li>' for _ in range(chance.randrange(1, 6)))}</ul>"
        if kind == 1:
            return f"<h2>{words(4)}</h2>"
        if kind == 2:
            return f"<table><tr><td>{words(1)}</td><td>{words(2)}</td></tr></table>"
        return f"<p>{words(chance.randrange(5, 120))} <b>{words(3)}</b></p>"

    for _ in range(60):
        inner = "".join(block() for _ in range(chance.randrange(1, 15)))
        around = [
            f"<nav><ul><li>{words(1)}</li></ul></nav>", f'<div class="ad">{words(40)}</div>', f"<div>{words(chance.randrange(1, 30))}</div>",
            "".join(f"<div><p><i>{words(1)}</i></p></div>" for _ in range(chance.randrange(8))),
        ]
        chance.shuffle(around)
        page = f"<html><body>{around[0]}{around[1]}<{mark}><h1>{words(5)}</h1>{inner}</{mark}>{around[2]}{around[3]}<footer>{words(9)}</footer></body></html>"
        assert html_text.main_text(page) == plain_main_text(page)


def test_a_very_long_page():
    page = f"<body><nav>menu</nav><article>{'<p>' + 'word ' * 50 + '</p>'}{'<p>some more words of it</p>' * 100_000}</article></body>"
    assert html_text.main_text(page).count("more words") == 100_000
