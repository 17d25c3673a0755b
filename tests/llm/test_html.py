"""Main text by tag-path ratios against a plain version, and pages that shortcuts get wrong."""

import math
import re
from html.parser import HTMLParser

import numpy as np
import pytest

from tidemark.llm.html_text import main_text

WORDS = "river house friend summer walk near every other long road stone paper, light; dark. water! north? south".split()


def words(rng, n):
    return " ".join(rng.choice(WORDS, n))


class Reader(HTMLParser):
    """Text nodes of a well-formed page: (tag path, its elements, text)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.nodes, self.made = [], [], 0

    def handle_starttag(self, tag, attrs):
        self.made += 1
        self.open.append((tag, self.made))

    def handle_endtag(self, tag):
        assert self.open.pop()[0] == tag

    def handle_data(self, data):
        if not {t for t, _ in self.open} & {"nav", "footer", "script", "style", "title"}:
            self.nodes.append((tuple(t for t, _ in self.open), list(self.open), data))


def plain(page, spread):
    """Ratios by path, smoothed and fused, for pages of div, section, p, h2, ul, li, a, b."""
    reader = Reader()
    reader.feed(page)
    said = [(p, len(" ".join(t.split())), len(re.findall(r"[.,;:!?…]", t))) for p, _, t in reader.nodes if t.strip()]
    of = {}
    for p, n, m in said:
        of.setdefault(p, []).append((n, m))
    mean = {p: [sum(c) / len(x) for c in zip(*x)] for p, x in of.items()}

    def smooth(k):
        out = []
        for i in range(len(said)):
            near = [(math.exp(-0.5 * d * d), mean[said[i + d][0]][k]) for d in range(-2, 3) if 0 <= i + d < len(said)]
            out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
        return out

    fused = [t * (1 + m) for t, m in zip(smooth(0), smooth(1))]
    ratio = {p: float(np.mean([f for f, s in zip(fused, said) if s[0] == p])) for p in of}
    least = min(spread * float(np.std(fused)), max(ratio.values()))
    content = {p for p in ratio if ratio[p] >= least - 1e-9}
    boxes, texts = {"html", "body", "div", "section"}, {"p", "h2", "ul", "li"}
    made = []  # blocks: (element, its box, text, is content)
    for path, elements, text in reader.nodes:
        block = next(e for e in reversed(elements) if e[0] in boxes | texts)
        box = [e for e in elements if e[0] in boxes]
        if not made or made[-1][0] != block:
            made.append([block, box, "", False])
        made[-1][2] += text
        made[-1][3] |= bool(text.strip()) and path in content
    made = [(e, box, " ".join(t.split()), ok) for e, box, t, ok in made if t.strip()]
    homes = {e for _, box, _, ok in made if ok for e in box}
    first = next(i for i, x in enumerate(made) if x[3])
    return "\n\n".join(t for i, (e, box, t, ok) in enumerate(made) if ok or e[0] in texts and box[-1] in homes and (i > first or e[0] != "li"))


def page(rng):
    def inline(n):
        return " ".join(f"<{t}>{words(rng, 2)}</{t}>" if (t := rng.choice(["a", "b", ""])) else words(rng, rng.integers(1, 12)) for _ in range(n))

    def box(depth):
        parts = []
        for _ in range(rng.integers(1, 6)):
            kind = rng.choice(["p", "p", "h2", "ul", "div", "section"])
            if kind in ("div", "section"):
                parts.append(f"<{kind}>{box(depth - 1) if depth else words(rng, 4)}</{kind}>")
            elif kind == "ul":
                parts.append("<ul>" + "".join(f"<li>{inline(1)}</li>" for _ in range(rng.integers(1, 5))) + "</ul>")
            else:
                parts.append(f"<{kind}>{inline(1 if kind == 'h2' else rng.integers(1, 9))}</{kind}>")
        return "".join(parts)

    return f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a>one</a></li></ul></nav>{box(3)}<footer><p>{words(rng, 9)}</p></footer></body></html>"


@pytest.mark.parametrize("spread", [0.5, 1.0, 2.0])
def test_against_a_plain_version(spread):
    rng = np.random.default_rng(21)
    pages = [page(rng) for _ in range(150)]
    got = [main_text(p, spread) for p in pages]
    assert got == [plain(p, spread) for p in pages]


def test_the_threshold_decides():
    rng = np.random.default_rng(22)
    pages = [page(rng) for _ in range(60)]
    assert sum(main_text(p, 0.3) != main_text(p, 1.5) for p in pages) > 20


def test_without_an_article_element():
    rng = np.random.default_rng(23)
    body = [words(rng, 60) + "." for _ in range(6)]
    text = "".join(f"<p>{x}</p>" for x in body)
    menu = "<div><ul>" + "".join(f"<li><a>{w}</a></li>" for w in WORDS[:8]) + "</ul></div>"
    assert main_text(f"<body>{menu}<div><h1>Title</h1>{text}</div><div><a>Home</a> <a>Top</a></div></body>") == "\n\n".join(["Title", *body])


def test_nothing_of_an_article_is_dropped():
    rng = np.random.default_rng(24)
    body = [words(rng, 40) + "." for _ in range(5)]
    links = "".join(f"<li><a href=x>{w} et al.</a></li>" for w in WORDS[:5])
    page = f"<article><h1>T</h1><p>{body[0]}<p class=alert>{body[1]}<section class='related-work'><h2>Related work</h2><p>{body[2]}</section><ol>{links}</ol><p>{body[3]}</article>"
    want = ["T", body[0], body[1], "Related work", body[2], *(f"{w} et al." for w in WORDS[:5]), body[3]]
    assert main_text(page) == "\n\n".join(want)


@pytest.mark.parametrize("depth", [600, 3000])
def test_deep_pages(depth):
    inside = "<nav>menu</nav><aside>side text, long enough to be one.</aside><p>The text, as it is.</p>"
    assert main_text("<div>" * depth + inside + "</div>" * depth) == "The text, as it is."
    assert main_text("<font>" * depth + inside) == "The text, as it is."


def test_what_names_say():
    rng = np.random.default_rng(25)
    long = words(rng, 50) + "."
    for name in ("comments", "sidebar-box", "adBox", "cookie_notice", "comment-list"):
        assert main_text(f"<article><p>{long}</p><div class='{name}'><p>{long}</p></div></article>") == long
    assert main_text(f"<article><p>{long}</p><div class='list wrapper'><p>{long}</p></div></article>") == f"{long}\n\n{long}"
