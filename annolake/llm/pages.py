"""Operator 8, main text of web pages by minimum-cut labelling.

A page is read into blocks (runs of text between block-level tags) with their
place in the element tree. A logistic classifier gives each block the log odds of
being article text; they become its capacity to the source or the sink of a flow
network. Neighbouring blocks and blocks of one parent element are joined by smoothness
edges. The minimum cut separates article from boilerplate.

The classifier is trained on a bounded sample of pages: blocks under ``article`` or
``main`` are examples of text, blocks under ``nav``, ``footer``, ``aside``, ``form`` and the
like of boilerplate; each example is learned with and without what its
surroundings tell, so that pages without such elements are judged by their text.

A boilerplate mark counts for all that its element holds, but an ``article`` or ``main``
inside starts anew, unless the mark says that what it holds is not the page's own
article (comments, hidden parts; for ``article`` also navigation, asides, related stories).
Marks that may as well be a wrapper's (a form, a name like ``header-fixed``) are weak:
text and cut decide. Names like ``has-sidebar`` are no marks.
"""

from __future__ import annotations

import html
import re
from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolake.llm.common import text_columns

SAMPLE_PAGES = 300
NEXT, SIBLING = 0.4, 0.6      # capacities of the smoothness edges
FEATURES = 10

_TOKEN = re.compile(
    r"(?s)<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|[^<]++|<")
_ATTR = re.compile(r"(?s)([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SENTENCE = re.compile(r"[.!?…。]")

RAW = frozenset("script style title textarea noscript template iframe svg math object select canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"button", "option", "legend", "caption", "summary", "tbody", "td", "tfoot", "th", "thead", "tr", "body", "html", "head"}
PEERS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}}
HOLDERS = frozenset("ul ol menu dl table tbody thead tfoot".split())
BAD_TAGS = frozenset("nav footer aside form button dialog head menu fieldset".split())
BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner comment comments disqus replies "
    "reply respond cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar share sharing social related "
    "recommended recommendations widget login signup signin search pagination pager toolbar skip copyright".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# what an article inside cannot undo, and what not even a main element can
FAST_TAGS = BAD_TAGS - {"form", "fieldset"}
FAST_ROLES = BAD_ROLES - {"form", "search", "banner"}
FAST_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored related recommended recommendations".split())
COMMENT_WORDS = frozenset("comment comments disqus replies reply respond".split())
# has-sidebar says nothing of the element itself; header-fixed may be said of the page around the header
ABOUT = frozenset("has have no with without is not hide show".split())
STATE = frozenset("fixed sticky static open opened closed on off enabled disabled none free left right top active visible collapsed expanded".split())
WEAK, MARKED, FAST, FASTEST = 1, 2, 3, 4     # how strongly an element is marked as boilerplate; 0 is not
WEAK_PART = 0.25                             # of the weight of a mark
GOOD_WORDS = frozenset("article post entry story content body text".split())


@dataclass(slots=True)
class Block:
    text: str
    parent: int
    tag: str
    good: bool
    bad: int
    link: int
    path: tuple = ()


@dataclass(slots=True)
class Open:
    tag: str
    key: int
    good: bool
    bad: int
    children: dict = field(default_factory=dict)


def _named(names: str, main: bool, in_good: bool) -> tuple[int, bool]:
    """(mark, article text) that the names of an element's class or id tell."""
    bad, good = 0, False
    for name in names.split():
        words = [w.lower() for w in _PART.findall(name)]
        if len(words) > 1 and words[0] in ABOUT:
            continue
        hits = set(words) & ({"comment", "comments", "ad", "ads"} if main else BAD_WORDS)
        if "header" in words and not in_good:
            hits.add("header")
        if not hits:
            good = good or not GOOD_WORDS.isdisjoint(words)
        elif not STATE.isdisjoint(words):
            bad = max(bad, WEAK)
        else:
            bad = max(bad, FASTEST if hits & COMMENT_WORDS else FAST if hits & FAST_WORDS else MARKED)
    return bad, good


def _hints(tag: str, attrs: str, up: Open) -> tuple[bool, int]:
    """(under article text, how strongly under boilerplate) of an element."""
    good, bad = up.good, up.bad
    main = tag in ("article", "main")
    a = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if attrs and tag not in ("html", "body") else {}
    role = a.get("role", "").lower()
    body = "articleBody" in a.get("itemprop", "")
    if main or role in ("main", "article") or body:
        good = True
        if bad < (FAST if "article" in (tag, role) and not body else FASTEST):
            bad = 0
    if tag in BAD_TAGS or tag == "header" and not up.good:
        bad = max(bad, FAST if tag in FAST_TAGS else WEAK if tag in ("form", "fieldset") else MARKED)
    if role in BAD_ROLES:
        bad = max(bad, FAST if role in FAST_ROLES else WEAK if role == "form" else MARKED)
    if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "").lower():
        bad = FASTEST
    mark, text = _named(f"{a.get('class', '')} {a.get('id', '')}", main, up.good)
    return good or text and not mark, max(bad, mark)


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in page order."""
    stack = [Open("", 0, False, 0)]
    out: list[Block] = []
    buf: list[str] = []
    link = keys = 0
    in_link = 0

    def flush():
        nonlocal link
        if buf:
            text = " ".join("".join(buf).split())
            buf.clear()
            if text:
                k = len(stack) - 1
                while k and stack[k].tag not in BLOCK:
                    k -= 1
                top = stack[-1]
                out.append(Block(text, stack[max(0, k - 1)].key, stack[k].tag, top.good, top.bad, min(link, len(text))))
        link = 0

    pos, n = 0, len(page)
    while pos < n:
        m = _TOKEN.match(page, pos)
        pos = m.end()
        tag = m[2] or m[5]
        if tag is None:
            t = m[0]
            if t[0] != "<" or t == "<":
                t = html.unescape(t)
                buf.append(t)
                if in_link:
                    link += len(t.strip())
            continue
        tag = tag.lower()
        if m[1] or m[4]:                                    # end tag
            if tag in BLOCK:
                flush()
            if tag == "br":
                buf.append(" ")
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    in_link -= sum(x.tag == "a" for x in stack[k:])
                    del stack[k:]
                    break
            continue
        attrs = m[3] if m[2] else m[6]
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                buf.append(" ")
            continue
        if tag in RAW:
            if attrs.endswith("/") and tag in ("svg", "math"):
                continue
            end = re.compile(f"(?i)</{tag}[\\s/>]").search(page, pos)
            if end is None:
                pos = n
            else:
                close = page.find(">", end.start())
                pos = n if close < 0 else close + 1
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSES_P:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == "p":
                        in_link -= sum(x.tag == "a" for x in stack[k:])
                        del stack[k:]
                        break
                    if stack[k].tag in BLOCK:
                        break
            peers = PEERS.get(tag)
            if peers:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in peers:
                        in_link -= sum(x.tag == "a" for x in stack[k:])
                        del stack[k:]
                        break
                    if stack[k].tag in HOLDERS:
                        break
        if tag == "a" and in_link:                          # links do not nest
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "a":
                    del stack[k:]
                    in_link -= 1
                    break
        keys += 1
        stack.append(Open(tag, keys, *_hints(tag, attrs, stack[-1])))
        if tag == "a":
            in_link += 1
    flush()
    return out


def features(b: Block, blind: bool = False) -> list[float]:
    """Ten numbers; ``blind`` leaves out what the surrounding elements tell."""
    n = len(b.text)
    words = b.text.count(" ") + 1
    return [1.0, 0.0 if blind else float(b.good and not b.bad), 0.0 if blind else WEAK_PART if b.bad == WEAK else float(b.bad > 0),
            min(1.0, b.link / n), min(words, 60) / 60, float(words < 4), float(bool(_SENTENCE.search(b.text))),
            float(b.tag in ("p", "pre", "blockquote")), float(b.tag[:1] == "h" and b.tag[1:].isdigit()), float(b.tag == "li")]


def train(rows: list[tuple[list[float], int]], steps: int = 400, rate: float = 1.0, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression by gradient descent, the two classes weighing alike; without examples, by the hints alone."""
    if not any(y for _, y in rows) or all(y for _, y in rows):
        return np.array([-1.0, 6.0, -6.0, -2.0, 3.0, -1.0, 1.0, 0.5, 0.5, -0.5])
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    w = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        beta -= rate * 4 * (x.T @ (w * (p - y)) + decay * beta)
    # whatever the sample holds, an element named as boilerplate outweighs the text's looks and the smoothness edges
    beta[1], beta[2] = max(beta[1], 6.0), min(beta[2], -12.0)
    return beta


def min_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Label 1 for the nodes on the source's side of a minimum cut: cost of label 0 is max(0, odds),
    of label 1 max(0, -odds), of an edge whose ends differ its capacity.

    A node whose own capacity is at least the sum of its edges is settled at once (its
    label is the same in some minimum cut) and only shifts its neighbours' odds; max-flow decides the rest."""
    n = len(odds)
    odds = list(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, c in edges:
        if i != j:
            near[i][j] = near[i].get(j, 0.0) + c
            near[j][i] = near[j].get(i, 0.0) + c
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is None and abs(odds[i]) >= sum(near[i].values()):
            label[i] = odds[i] > 0
            for j, c in near[i].items():
                odds[j] += c if label[i] else -c
                del near[j][i]
                if label[j] is None:
                    todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        s, t = n, n + 1
        cap: dict[int, dict[int, float]] = {i: dict(near[i]) for i in rest}
        cap[s], cap[t] = {}, {}
        for i in rest:
            if odds[i] > 0:
                cap[s][i], cap[i][s] = odds[i], 0.0
            elif odds[i] < 0:
                cap[i][t], cap[t][i] = -odds[i], 0.0
        while True:
            back, queue = {s: s}, deque([s])
            while queue and t not in back:
                u = queue.popleft()
                for v, c in cap[u].items():
                    if c > 1e-12 and v not in back:
                        back[v] = u
                        queue.append(v)
            if t not in back:
                break
            path, v = [], t
            while v != s:
                path.append((back[v], v))
                v = back[v]
            flow = min(cap[u][v] for u, v in path)
            for u, v in path:
                cap[u][v] -= flow
                cap[v][u] = cap[v].get(u, 0.0) + flow
        for i in rest:
            label[i] = i in back
    return [bool(x) for x in label]


def main_text(page: str, beta: np.ndarray) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    odds = (np.array([features(b) for b in blocks]) @ beta).tolist()
    edges, last = [], {}
    for k, b in enumerate(blocks):
        if k:
            edges.append((k - 1, k, NEXT))
        if b.parent in last:
            edges.append((last[b.parent], k, SIBLING))
        last[b.parent] = k
    return " ".join(b.text for b, keep in zip(blocks, min_cut(odds, edges)) if keep)


def fit(pages: DataFrame, url: str = "url", page: str = "html", sample: int = SAMPLE_PAGES) -> np.ndarray:
    """The classifier's weights from at most ``sample`` pages, in the order of a hash of address and page."""
    few = pages.select(F.col(page).alias("html"), F.xxhash64(url, page).alias("h")).where("html is not null") \
        .select("html", "h").orderBy("h").limit(sample)

    def make():
        def f(texts):
            out = []
            for t in texts:
                rows = []
                for b in blocks_of(t.decode()):
                    if b.good != (b.bad > 0) and b.bad != WEAK:
                        y = float(b.good)
                        rows += [y, *features(b), y, *features(b, True)]
                out.append(rows)
            return [pa.array(out, pa.list_(pa.float64()))]
        return f

    got = text_columns(few, "html", [("rows", T.ArrayType(T.DoubleType()))], make).collect()
    flat = [x for r in sorted(got, key=lambda r: (r["h"], r["rows"])) for x in r["rows"]]
    x = np.array(flat).reshape(-1, FEATURES + 1)
    return train([(r[1:].tolist(), int(r[0])) for r in x])


def extract(pages: DataFrame, beta: np.ndarray, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row for each row of ``pages``, whole pages.

    Null and empty pages and pages without article blocks have an empty text. Repeated rows are
    repeated; null ids and addresses are passed on. Empty table: empty result. Other columns are not read.
    """
    d = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))

    def make():
        return lambda texts: [pa.array([main_text(t.decode(), beta) for t in texts], pa.string())]

    return text_columns(d, "html", [("text", T.StringType())], make).withColumn("n_chars", F.length("text").cast("bigint"))
