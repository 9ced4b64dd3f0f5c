"""Main text of web pages: flat text blocks classified by a decision tree.

A page becomes a flat list of text blocks. A block is described by its words, the share of them in
links, the same of the blocks before and after it, and where it stands (in an element that holds
content or one that holds something else, by tag, role, class or id). A decision tree, trained
on a small labelled table, keeps a block or drops it. Pages are independent of each
other, so this is one pass without shuffle.
"""

import html as entities
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/\"'>]+)")
_SPLIT = re.compile(r"[^a-z]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDERS = frozenset("ul ol dl table tbody thead tfoot div section article main body".split())
OUTSIDE = frozenset("nav aside footer form menu dialog fieldset select option button object canvas".split())
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert alerts banner breadcrumb breadcrumbs captcha complementary consent contentinfo cookie cookies dialog disclaimer footer footnav gdpr header "
    "hidden login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion recommended related rss search share sharing shop sidebar sidenav "
    "signup skip social sponsor sponsored subscribe subscription toc toolbar topbar widget widgets".split())
TALK_WORDS = frozenset("comment comments commentlist discussion disqus replies reply respond".split())
ONE_TALK = frozenset("comment reply".split())  # is one, rather than has some
GOOD_WORDS = frozenset("article body content entry main post story text".split())
COLUMNS = ("words", "links", "words_before", "links_before", "words_after", "links_after", "inside", "outside", "heading", "item", "full_stop")


def _place(tag, attributes, above, talk=TALK_WORDS, wraps=False):
    """(inside, outside) of an element below ``above``: what holds content, and what holds something else.

    outside is 2 where nothing below counts as content again: navigation, forms, comments, hidden parts.
    A form that ``wraps`` the content is as if it were not there. ``talk`` are the words of comments.
    """
    inside, outside = above
    if outside == 2:
        return above
    found = {}
    for name, a, b, c, alone in _ATTRIBUTE.findall(attributes):
        found.setdefault((name or alone).lower(), a or b or c)
    style = found.get("style", "").replace(" ", "").lower()
    if tag in OUTSIDE and not wraps or "hidden" in found or "display:none" in style or "visibility:hidden" in style or found.get("aria-hidden") == "true":
        return inside, 2
    if wraps:
        return above
    words = set()
    for name in ("class", "id", "role"):
        if found.get(name):
            words.update(_SPLIT.split(found[name].lower()), _SPLIT.split(_HUMP.sub(" ", found[name]).lower()))
    if words & talk:
        return inside, 2
    if tag == "header" and not inside:
        return inside, 2
    if tag in ("article", "main"):
        return 1, 0
    if words & BAD_WORDS and not words & GOOD_WORDS and tag not in ("html", "body"):
        return inside, 1
    if words & GOOD_WORDS and not words & BAD_WORDS and not outside:
        return 1, 0
    return inside, outside


def blocks(page):
    """Text blocks of a page as (text, features without neighbours, label of a training page or None)."""
    out, wrappers = _walk(page, frozenset())
    return _walk(page, wrappers)[0] if wrappers else out


def _walk(page, wrappers):
    """The blocks, and which forms of the page (by number) hold an article, main or content container.

    Those in ``wrappers`` do not count as forms. In content, only an article or main makes a form a wrapper.
    """
    out, buffer = [], []  # buffer: (text, is link)
    # tag, place, label of it or of what it is in, place below the innermost form if that were none, forms that could be wrappers
    stack = [("", (0, 0), None, (0, 0), None)]
    opened = Counter()  # how many of each tag are open, so that no tag is looked for in vain, however deep the page
    forms, found, articles, content = 0, set(), 0, False

    def close(i):
        opened.subtract(s[0] for s in stack[i:])
        del stack[i:]

    def flush():
        if not buffer:
            return
        text = " ".join(entities.unescape("".join(t for t, _ in buffer)).split())
        if text:
            words = len(text.split())
            linked = sum(len(entities.unescape(t).split()) for t, link in buffer if link)
            inside, outside = stack[-1][1]
            nonlocal content
            content = content or bool(inside and not outside)
            heading = any(s[0] in ("h1", "h2", "h3", "h4", "h5", "h6") for s in stack[-4:])
            out.append((text, (words, min(1.0, linked / words), inside, outside, heading, opened["li"] > 0, text[-1] in ".!?…。:;\"”"), stack[-1][2]))
        buffer.clear()

    def text(piece):
        if piece:
            buffer.append((piece, opened["a"] > 0))

    at, unclosed = 0, set()
    page = page or ""
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            if tag == "br":
                buffer.append((" ", False))
                continue
            flush()
        if closing:
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i][0] == tag:
                    close(i)
                    break
                if tag in INLINE and stack[i][0] not in INLINE:
                    break
            continue
        if tag in RAW:
            if not attributes.endswith("/") and tag not in unclosed:
                end = _END[tag].search(page, at)
                if end is None:
                    unclosed.add(tag)
                at = end.end() if end else (len(page) if tag in ("script", "style") else at)
            continue
        if tag in VOID:
            continue
        ends = {"p"} if tag in CLOSES_P else SAME.get(tag, ())
        for i in range(len(stack) - 1, 0, -1) if any(opened[t] for t in ends) else ():
            if stack[i][0] in ends:
                close(i)
                break
            if stack[i][0] in HOLDERS:
                break
        label = re.search(r'data-y="([01])"', attributes)
        _, place, above, free, inner = stack[-1]
        talk = TALK_WORDS
        if tag in ("html", "body", "main"):
            talk = frozenset()
        elif tag == "article" and not articles:
            talk = ONE_TALK if content else frozenset()
        if tag == "article" and place[1] != 2:
            articles += 1
        if tag == "form":
            # (number, is in content, the one around it): hidden forms and those in navigation, comments and the like wrap nothing
            free = _place(tag, attributes, free, wraps=True)
            inner = (forms, bool(free[0]), inner) if free[1] != 2 else inner
            free = (0, free[1])
            place = _place(tag, attributes, place, wraps=forms in wrappers)
            forms += 1
        else:
            place = _place(tag, attributes, place, talk)
            if inner:
                free = _place(tag, attributes, free, talk)
                around = inner if free == (1, 0) else None
                while around and around[0] not in found:
                    if not around[1] or tag in ("article", "main"):
                        found.add(around[0])
                    around = around[2]
            else:
                free = place
        stack.append((tag, place, int(label[1]) if label else above, free, inner))
        opened[tag] += 1
    flush()
    return out, frozenset(found)


def features(found):
    """One row of COLUMNS per block, its neighbours' words and links among them."""
    own = np.array([f for _, f, _ in found], float).reshape(len(found), 7)
    near = np.zeros((len(found) + 2, 2))
    near[1:-1] = own[:, :2]
    return np.column_stack([own[:, :2], near[:-2], near[2:], own[:, 2:]])


# The small labelled table: blocks of pages as they are met, 1 for the main text.
_LONG = "The river rose again during the night and the lower meadows were under water by the morning, so the farmers moved their animals up the hill."
_MORE = "Nobody had expected it so late in the year, and the council met at once to decide what to do about the old bridge."
_SHORT = "It rained."
_NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About us</a></li></ul></nav>'
_FOOT = "<footer>© 2020 the valley paper · All rights reserved <a href='/imprint'>Imprint</a></footer>"
LABELLED_PAGES = (
    f'{_NAV}<div class="ad">Buy new boots now, half price until Sunday.</div><article data-y="1"><h1>Water in the meadows</h1><p>{_LONG}</p><p>{_SHORT}</p><p>{_MORE} <a href="/b">The bridge</a></p><p>Why?</p></article>{_FOOT}',
    f'<header><h1>The Valley Paper</h1><p>News from the valley since 1890, every day but Sunday.</p></header>{_NAV}<main data-y="1"><h2>A late flood</h2><p>{_LONG}</p><ul><li>The bridge</li><li>The mill and the weir.</li></ul><p>{_MORE}</p></main>'
    f'<aside><h3>Most read</h3><ul><li><a href="/1">Snow on the pass</a></li><li><a href="/2">The new school opens its doors</a></li></ul><p>{_MORE}</p></aside>{_FOOT}',
    f'<div id="menu"><a href="/">Home</a> <a href="/x">Contact</a></div><div class="content" data-y="1"><h1>Floods</h1><p>{_LONG}</p><blockquote>{_MORE}</blockquote><p>Rain.</p></div><div class="sidebar"><p>{_LONG}</p><p>{_SHORT}</p></div><div id="footer">Contact and imprint, all rights reserved.</div>',
    f'<div class="cookie-notice"><p>We use cookies to make this site better. By using it you agree to our use of cookies.</p><button>Accept</button></div><div><div data-y="1"><h1>Floods in the valley</h1><p>{_LONG}</p><p>{_MORE}</p><p>{_LONG} {_MORE}</p></div></div>'
    f'<div><a href="/a">One</a> <a href="/b">Two</a> <a href="/c">Three</a></div><div>© The paper</div>',
    f'<table><tr><td><a href="/">Home</a></td><td><a href="/n">News</a></td></tr></table><p data-y="1">{_LONG}</p><p data-y="1">{_MORE} {_MORE}</p><p data-y="1">{_LONG}</p><p><a href="/next">Next article</a> | <a href="/prev">Previous article</a></p><p>Printed on paper</p>',
    f'{_NAV}<article data-y="1"><header><h1>The mill</h1></header><p>{_LONG}</p><pre>level 4.2\nlevel 4.4</pre><p>{_MORE}</p></article><section id="comments"><h2>Comments</h2><div class="comment"><p>{_MORE} I was there and saw it myself, it was much worse.</p></div><div class="comment"><p>Thanks.</p></div></section>{_FOOT}',
    f'<div class="banner">Subscribe today and read four weeks for the price of one.</div><article data-y="1"><h1>Meadows</h1><p>{_MORE}</p><div class="related" data-y="0"><h3>Related</h3><a href="/1">Snow on the pass closes the road again</a><p>{_MORE}</p></div><p>{_LONG}</p><p>See also the report.</p>'
    f'<div class="share" data-y="0">Share this with your friends</div></article><form><p>Sign up for our letter, once a week, with all that matters in the valley.</p></form>',
    f'<div class="post" data-y="1"><p>{_SHORT}</p><p>{_LONG}</p><p>No.</p><h3>Afterwards</h3><p><a href="/r">The full report of the council with all its tables</a></p></div><div class="widget"><p>{_LONG}</p></div><div class="pagination"><a href="/2">2</a></div>',
    f'<article data-y="1"><h1>Rain</h1><p>{_SHORT}</p><p>{_LONG}</p></article>',
    f'<article data-y="1"><p>{_MORE}</p><p>Why not</p></article>',
    '<main data-y="1"><h1>Links</h1><p><a href="/1">The long report</a></p><p><a href="/2">Maps</a></p></main>',
    f'<p data-y="1">{_LONG}</p>',
    f'<p data-y="1">{_LONG}</p><p data-y="1">{_MORE}</p>',
    f'<article data-y="1"><p>Yes</p></article>{_FOOT}',
    f'<article data-y="1"><p>{_LONG}</p><p><a href="/m">The map</a></p><p>{_MORE}</p></article>',
    f'<div class="story" data-y="1"><p><a href="/m">The map of the valley</a></p><p>Seen from above</p></div>',
    f'{_NAV}<div data-y="1"><h2>The bridge</h2><p>{_MORE} {_LONG}</p><p>{_SHORT} {_LONG}</p></div><div><p><a href="/a">Archive</a> <a href="/b">Letters</a></p></div>',
    f'<article data-y="1"><ul><li><a href="/1">Level of the river</a></li><li>Level of the lake</li></ul></article><div><a href="/up">Back to the top</a></div>',
    # no name tells here, and the same short blocks are text between long ones and are not between links
    f'<div><div><a href="/">Home</a></div><div>It snowed.</div><div><a href="/n">News of the day</a></div><div>Why not</div><div><a href="/l">Letters</a></div></div>'
    f'<div data-y="1"><div>{_LONG}</div><div>It snowed.</div><div>{_MORE}</div><div>Why not</div><div>{_LONG}</div></div>'
    f'<div><a href="/1">Snow on the pass closes the road again</a></div><div>Read by many.</div><div><a href="/2">The new school opens its doors</a></div>',
    f'<div><a href="/">Home</a></div><div><a href="/n">News</a></div><div>All the news of the valley.</div><div data-y="1"><div>Rain in the hills</div><div>{_LONG}</div><div>{_MORE} {_LONG}</div></div><div>© 2020 the valley paper · All rights reserved</div>',
    f'<div><a href="/">Home</a></div><div>News since 1890, every day.</div><div data-y="1"><div>Water in the meadows</div><div>{_LONG} {_MORE}</div><div>No.</div><div>{_MORE}</div></div><div>© The paper, printed in the valley since 1890.</div>',
)


def labelled():
    """The labelled table: features and labels of its blocks."""
    found = [blocks(page) for page in LABELLED_PAGES]
    return np.concatenate([features(f) for f in found]), np.array([label or 0 for f in found for _, _, label in f])


def grow(x, y, depth=8, least=1):
    """A tree (column, limit, below or equal, above) split by Gini impurity; leaves are the share of ones."""
    if depth == 0 or len(set(y.tolist())) < 2:
        return float(y.mean())
    best = None
    for c in range(x.shape[1]):
        values = np.unique(x[:, c])
        for limit in (values[1:] + values[:-1]) / 2:
            low = x[:, c] <= limit
            n, m = low.sum(), (~low).sum()
            if min(n, m) < least:
                continue
            a, b = y[low].mean(), y[~low].mean()
            impurity = n * a * (1 - a) + m * b * (1 - b)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, c, limit, low)
    if best is None or best[0] > len(y) * y.mean() * (1 - y.mean()) - 1e-9:
        return float(y.mean())
    _, c, limit, low = best
    return c, float(limit), grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)


def decide(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree >= 0.5


@lru_cache(1)
def default_tree():
    return grow(*labelled())


def main_text(page, tree):
    found = blocks(page)
    return " ".join(b[0] for b, row in zip(found, features(found).tolist(), strict=True) if decide(tree, row)) if found else ""


def extract(pages, tree=None):
    """page_id, url, text and n_chars (code points) of the main text of every row of ``pages``.

    Null and empty html give an empty text, as does a page of which the tree keeps nothing. Every row is
    a page of its own: repeated ones alike, null page_id and url as they are. An empty table
    gives no rows; other columns are not read.
    """
    tree = tree or default_tree()

    def run(batches):
        for rows in batches:
            text = rows["html"].map(lambda h: main_text(h, tree))
            yield pd.DataFrame({"page_id": rows["page_id"], "url": rows["url"], "text": text, "n_chars": text.str.len().astype("int64")})

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, url string, text string, n_chars long")
