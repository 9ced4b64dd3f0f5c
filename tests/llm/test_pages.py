import re
import time

import numpy as np
import pytest

from firnline.llm import pages

TREE = pages.default_tree()
P = "The committee met on Tuesday and agreed that the plan should go ahead, although several members had doubts about the cost of it."

CASES = {
    "words &amp;amp; &lt;b&gt; caf&eacute; &#8364;&#x41;": "words &amp; <b> café €A",
    f"<body><header><p>{P}</p></header><article><h1>A  title\n here</h1><p>One <b>bo</b>ld<i>er</i></p>\n<p>x<br>y</p></article><footer>{P}</footer>": "A title here One bolder x y",
    f"<nav>{P}</nav><main><p>{P}</p><script>var a = '<p>no</p>';</script><style>p{{}}</style><form><input value=x><p>{P}</p></form><!-- <p>no</p> --><p>End</p></main>": f"{P} End",
    f"<article><p>{P}</p></article><div class='comments'><article class='comment'><p>{P}</p></article></div>": P,
    f"<div class='page-content has-sidebar'><p>{P}</p></div><div id='sideBar'><p>{P}</p></div><div role=alert><p>{P}</p></div>": P,
    f"<article><p>a < b and c > d</p><p>{P}": f"a < b and c > d {P}",
    f"<article><p>{P}<div class=\"ad-box\">{P}</div><div hidden>{P}</div><p>Last.</article>": f"{P} Last.",
}


@pytest.mark.parametrize("page", CASES)
def test_pages(page):
    assert pages.main_text(page if page.startswith("<") else f"<article><p>{page}</p></article>", TREE) == CASES[page]


def test_tree_knows_its_table():
    x, y = pages.labelled()
    assert np.mean([pages.decide(TREE, row) == bool(v) for row, v in zip(x.tolist(), y, strict=True)]) == 1


def test_tree_splits_by_neighbours():
    x = np.array([[1, 5], [1, 50], [2, 60], [2, 5.0]])
    tree = pages.grow(x, np.array([0, 1, 1, 0]))
    assert tree[0] == 1 and [pages.decide(tree, r) for r in x.tolist()] == [False, True, True, False]


def test_table(spark):
    long = "<article>" + f"<p>{P}</p>" * 5_000 + "</article>"
    broken = "<p a='" * 300 + "<!-- <textarea>" * 300
    rows = [(1, "u", f"<article><p>{P}</p></article>"), (1, "u", f"<article><p>{P}</p></article>"), (2, None, None), (None, "v", ""), (3, "w", "<nav>x</nav>"), (4, "x", long), (5, "y", broken), (6, "z", "<article><p>\U0001F600é</p></article>")]
    df = spark.createDataFrame([(*r, "mine", 0) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = sorted((tuple(r) for r in pages.extract(df).collect()), key=repr)
    assert [g for g in got if g[0] != 5] == sorted([(1, "u", P, len(P)), (1, "u", P, len(P)), (2, None, "", 0), (None, "v", "", 0), (3, "w", "", 0), (4, "x", " ".join([P] * 5000), 5000 * (len(P) + 1) - 1), (6, "z", "\U0001F600é", 2)], key=repr)
    assert pages.extract(df.limit(0)).count() == 0


NAV = "<nav><a href='/'>Home</a></nav>"
WHOLE = {
    f"<body><form id='aspnetForm' action='x'><input type=hidden>{NAV}<article><p>{P}</p></article><footer>{P}</footer></form></body>": P,
    f"<body><form id='mainForm'>{NAV}<div id='content'><p>{P}</p><p>{P}</p></div><div class='sidebar'>{P}</div></form></body>": f"{P} {P}",
    f"<body><form>{NAV}<main><p>{P}</p><form><p>{P}</p></form></main></form></body>": P,
    f"<html class='comments'><body class='single comments-open'>{NAV}<article><p>{P}</p></article></body></html>": P,
    f"<body>{NAV}<article class='post has-comments'><p>{P}</p><div class='comments'><p>{P}</p></div></article></body>": P,
    f"<body><main class='discussion'><p>{P}</p></main></body>": P,
    f"<body><main><h1>A title</h1><article class='has-comments'><p>{P}</p></article></main></body>": f"A title {P}",
    # forms and comments that hold no main text stay out
    f"<body><article><p>{P}</p><form><div class='form-body'><p>{P}</p></div></form></article></body>": P,
    f"<body><div class='post'><p>{P}</p></div><article class='comment'><p>{P}</p></article></body>": P,
    f"<body><article><p>{P}</p></article><form><div class='comments'><article class='comment'><p>{P}</p></article></div></form></body>": P,
    f"<body><article><p>{P}</p></article><nav><form><div class='content'><p>{P}</p></div></form></nav><form hidden><article>{P}</article></form></body>": P,
    f"<body><article><p>{P}</p></article><article class='post has-comments'><p>{P}</p></article></body>": P,
}


@pytest.mark.parametrize("page", WHOLE)
def test_containers_of_the_whole_page(page):
    assert pages.main_text(page, TREE) == WHOLE[page]


def _neutral(page):
    """The page without class, id and role, every sectioning element a div."""
    page = re.sub(r"\s(class|id|role)\s*=\s*('[^']*'|\"[^\"]*\"|[^\s>]+)", "", page)
    return re.sub(r"<(/?)(article|main|nav|aside|header|footer|section)\b", r"<\1div", page)


LINKS = "".join(f"<li><a href='/{w}'>{w} of the day</a></li>" for w in ("News", "Sport", "Weather", "Letters"))
OTHER = "Nobody had thought of the bridge until then, but now it was all that people spoke about in the town and beyond it."
PLAIN = [
    f"<body><nav class='x'><ul>{LINKS}</ul></nav><article><p>{P} {OTHER}</p><p>{OTHER}</p><p>Why not.</p><p>{P}</p></article><footer><a href='/i'>Imprint</a> <a href='/c'>Contact</a></footer></body>",
    f"<body><div class='menu'><a href='/'>Home</a> <a href='/n'>News</a></div><main><p>{OTHER} {P}</p><p>It rained.</p><p>{P}</p></main><aside><ul>{LINKS}</ul></aside></body>",
]


def test_pages_without_telling_names():
    """Where no name tells what an element is, words and links of a block and its neighbours do."""
    for page in PLAIN:
        assert pages.main_text(_neutral(page), TREE) == pages.main_text(page, TREE) != ""


def test_neighbours_decide():
    """A short block between long ones is text, the same block between links is not."""
    text = [p for page in PLAIN for p in [_neutral(page)]]
    changed = 0
    for page in text:
        found = pages.blocks(page)
        rows = pages.features(found)
        turned = rows.copy()
        turned[:, 2:6] = np.roll(rows[:, 2:6], len(rows) // 2, axis=0)
        changed += sum(pages.decide(TREE, a) != pages.decide(TREE, b) for a, b in zip(rows.tolist(), turned.tolist(), strict=True))
    assert changed > 0


@pytest.mark.parametrize("page", ["<div>x" * 60_000, "<span>" * 60_000 + "</p>" * 60_000 + "<p>x" * 2_000, "<p>a</b>" * 60_000, "<a href=x>y" * 30_000])
def test_deep_pages_take_time_in_proportion(page):
    start = time.process_time()
    pages.main_text(page, TREE)
    assert time.process_time() - start < 20
