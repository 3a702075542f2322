"""Main text, language and personal data."""

import hashlib
import html
import re
from collections import Counter
from itertools import product

import pytest

from annolake.llm import langid, pages, pii
from tests.llm.data import ODD, SF, SF2, empty, odd, rows


@pytest.fixture(scope="module")
def beta(spark):
    return pages.fit(spark.read.parquet(f"{SF2}/pages.parquet"))


def article(h):
    """What the given pages hold between <article> and </article>, by their fixed shape."""
    return " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<br>|</?(?:p|h1)>", " ", re.search(r"(?s)<article>(.*)</article>", h)[1]))).split())


def test_main_text_of_all_pages(spark, beta):
    for r in rows("pages", SF2):
        assert pages.main_text(r["html"], beta) == article(r["html"]), r["page_id"]


PAGE = """<!doctype html><html><head><title>T</title><script>if (a < b) document.write("</p>")</script></head><body class="has-sidebar">
<header class="site-header"><h1>Site</h1><a href=/>Home</a></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies. Please accept them all, this is a long sentence about cookies.</p></div>
<{0}><h1>The   title</h1><p>First &amp; <b>bo</b>ld para&shy;graph, with a comma and enough words to look like prose.
<p>Second&nbsp;one <a href="x">with a link</a>.<!-- no --><div class="ad"><p>Buy this now, it is a very fine product indeed.</p></div>
<ul><li>point a<li>point b</ul><form><label>Name</label><input></form></{1}>
<aside><h2>Sidebar</h2><p>Other stories that you may like to read next.</p></aside>
<section id="comments"><article class="comment"><p>I liked this very much, thank you for writing it.</p></article></section>
<footer>&copy; me</footer><style>p{{}}</style></body>"""


@pytest.mark.parametrize("tag", [("article", "article"), ("main", "main"), ('div class="post-content"', "div")])
def test_page_with_everything(beta, tag):
    assert pages.main_text(PAGE.format(*tag), beta) == (
        "The title First & bold para­graph, with a comma and enough words to look like prose. Second one with a link. point a point b")


BODY = ("<h1>The title</h1><p>A first paragraph of the article, with a comma and enough words to look like prose.</p>"
        "<p>The second paragraph goes on, and it also has more than a few words in it.</p>")
TEXT = ("The title A first paragraph of the article, with a comma and enough words to look like prose. "
        "The second paragraph goes on, and it also has more than a few words in it.")


@pytest.mark.parametrize("wrap", [
    'form id="aspnetForm"', 'div class="layout has-sidebar"', 'div class="page no-comments"', 'div class="header-fixed"',
    'div class="layout sidebar-right"', 'div id="page" class="nav-open"', 'div class="with-side-menu"', 'div class="banner"'])
@pytest.mark.parametrize("inner", ["article", "main", 'div role="main"', "div"])
def test_marked_wrapper_keeps_the_article(beta, wrap, inner):
    if inner == "div" and "banner" in wrap:
        return          # a plain element named as boilerplate is boilerplate
    page = (f"<html><body><{wrap}><nav><a>One</a> <a>Two</a></nav><{inner}>{BODY}<div class=ad><p>Buy this now, it is a very fine product.</p></div>"
            f"</{inner.split()[0]}><aside><p>Other stories that you may like to read next.</p></aside><footer>&copy; me</footer></{wrap.split()[0]}>")
    assert pages.main_text(page, beta) == TEXT


@pytest.mark.parametrize("wrap", ['section id="comments"', 'div class="related-posts"', "aside", "div hidden"])
def test_article_of_others_stays_out(beta, wrap):
    other = "<article><p>I liked this very much, thank you for writing it, said one reader.</p></article>"
    assert pages.main_text(f"<body><article>{BODY}</article><{wrap}>{other}</{wrap.split()[0]}>", beta) == TEXT


def test_odd_pages(spark, beta):
    for h in ("", "   ", "<", "<p", "<script>x", "<!-- x", "</p></div>", "<a title=\"x", "&amp;", "<nav>menu</nav>"):
        pages.main_text(h, beta)
    assert pages.main_text("<nav>menu</nav>", beta) == ""
    df = spark.createDataFrame([(1, "u", None, 1), (1, "u", None, 1), (None, None, "<article><p>x y</p></article>", 2), (3, "u", "", 3)],
                               "page_id bigint, url string, html string, text int")
    got = pages.extract(df, beta).collect()
    assert Counter(map(tuple, got)) == Counter({(1, "u", "", 0): 2, (None, None, "x y", 3): 1, (3, "u", "", 0): 1})
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert pages.extract(none, pages.fit(none)).count() == 0


def test_min_cut_is_minimal():
    import random
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 7)
        odds = [rng.choice([-2, -1, -0.5, 0.5, 1, 2]) + rng.random() / 100 for _ in range(n)]
        edges = [(i, j, rng.random()) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def cost(lab):
            return (sum(max(0, o) if not x else max(0, -o) for o, x in zip(odds, lab))
                    + sum(c for i, j, c in edges if lab[i] != lab[j]))
        best = min(cost(lab) for lab in product([False, True], repeat=n))
        assert cost(pages.min_cut(odds, edges)) == pytest.approx(best, abs=1e-9)


def test_language_of_pages(spark):
    model = langid.fit(spark.read.parquet(f"{SF2}/documents.parquet"))
    p = spark.read.parquet(f"{SF2}/pages.parquet")
    got = langid.languages(p, model).collect()
    want = {r["page_id"]: r["html"].split('lang="')[1][:2] for r in rows("pages", SF2)}
    assert len(got) == len(want) and sum(want[r.page_id] == r.lang for r in got) >= 0.98 * len(got)
    # without the markup the text and the host still tell
    plain = p.selectExpr("page_id", "null url", "regexp_replace(html, 'lang=', 'x=') html")
    got = langid.languages(plain, model).collect()
    assert sum(want[r.page_id] == r.lang for r in got) >= 0.95 * len(got)


def test_language_fusion_by_hand(spark):
    """A page without text takes its language from the host, the suffix and the markup."""
    model = langid.fit(spark.read.parquet(f"{SF2}/documents.parquet"))
    de = "Der und die das ist nicht ein eine und mit von der auf den im"
    data = [(k, f"http://a.site.de/{k}", f'<html lang="de"><p>{de}') for k in range(20)]
    data += [(100 + k, f"http://b.site.com/{k}", '<html lang="en"><p>the and of that with was this from for are') for k in range(60)]
    data += [(200, "http://a.site.de/x", "<html>"), (201, "not a url", None), (202, None, '<html lang="de">'), (None, "http://a.site.de/x", "<html>")]
    df = spark.createDataFrame([(*r, "x", "y") for r in data], "page_id bigint, url string, html string, lang string, host string")
    got = {r.page_id: r for r in langid.languages(df, model).collect()}
    assert got[200].lang == "de" and got[None].lang == "de" and got[202].lang == "de" and got[201].lang == "en"
    assert all(0 < r.probability <= 1 for r in got.values()) and len(got) == len(data)
    assert langid.languages(df.limit(0), model).count() == 0


def test_rare_languages_are_in_the_model(spark):
    """One document in thousands, or one without id, is enough for its language to be known."""
    data = [(k, "the and of that with was this from for are", "en") for k in range(5000)]
    data += [(9001, "le la les des une est dans pour que qui avec sur", "fr"), (None, "een het van dat niet zijn voor met ook maar", "nl"),
             (9002, None, "xx"), (1, "der die und", "de"), (9003, "no language", None)] + [(9004, "och att det som en av", "sv")] * 3
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string")
    model = langid.fit(docs, sample=50)
    assert model.langs == ["de", "en", "fr", "nl", "sv", "xx"]
    pages_ = spark.createDataFrame([(1, None, "<p>les une est dans pour avec"), (2, None, "<p>the and that with")], "page_id int, url string, html string")
    assert {r.page_id: r.text_lang for r in langid.languages(pages_, model).collect()} == {1: "fr", 2: "en"}
    once = langid.fit(docs.dropDuplicates(), sample=50)
    assert (once.weight == model.weight).all()


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0


def brute_base(t):
    out = []
    digits = lambda s: re.sub("[^0-9]", "", s)
    for k, (name, p, ok) in enumerate((("email", EMAIL, lambda s: True), ("ip", IP, lambda s: all(int(x) <= 255 for x in s.split("."))),
                                       ("card", CARD, lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
                                       ("phone", PHONE, lambda s: 10 <= len(digits(s)) <= 15))):
        out += [(m.start(), k, m.end(), name) for m in p.finditer(t or "") if ok(m[0])]
    return [f"{n}:{s}:{e}" for s, _, e, n in sorted(out)]


HARD = [
    "a@b.c_d@e.f x", "a@@b.cc", "..a@b.c.", "x@y", "a@b..c", "a@b.c@d.e", "1.2.3.4.5.6.7.8.9", "256.1.1.1 255.255.255.255 001.002.0003.4", "12.3.4",
    "1234567.1.1.1", "4501013203131650", "4501 0132 0313 1650 and 4501-0132-0313-1650-", "79927398713 0000000000000000", "+1 (578) 555-6437",
    "+49+49 30 1234567", "+1-", "+1 5", "++12345678901", "+1234567890123456", "é+33 1 23 45 67 89é a@é.fr \U0001f600 b@c.de", "9" * 3000,
    "a" * 3000, "1 " * 2000, "1.2.3.4 " * 450, "u@v.wx " * 450 + "+12 345 678 901", "mail me at joe (at) site (dot) com or call (415) 555-2671",
    "4501.0132.0313.1650", "tel. 030-555-1234", "2001:0db8:0000:0000:0000:ff00:0042:8329 is the ip of our server", "0.0.0.0", "+1.2.3.4.5.6.7.8.9.0",
]


def test_base_spans_equal_brute_force(spark):
    texts = [r["text"] for r in rows("documents", SF2)] + HARD + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in pii.personal_data(df).collect()}
    assert len(got) == len(texts)
    more = set()
    for k, t in enumerate(texts):
        base, r = brute_base(t), got[k]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), t[:80]
        count = Counter(x.split(":")[0] for x in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(count[n] for n in pii.KINDS)
        spans = r.spans.split(",") if r.spans else []
        assert not Counter(base) - Counter(spans)
        more |= {t[int(a):int(b)] for _, a, b in (x.split(":") for x in (Counter(spans) - Counter(base)))}
        key = [(int(x.split(":")[1]), pii.KINDS.index(x.split(":")[0])) for x in spans]
        assert key == sorted(key)
    assert "(415) 555-2671" in more and "joe (at) site (dot) com" in more
    assert len(more) < 10, more


def test_estimate_finds_the_reliable_labeler():
    import random
    rng, count = random.Random(2), Counter()
    for _ in range(5000):
        y = rng.random() < 0.4
        votes = [(1 if y else -1) * (1 if rng.random() < r else -1) for r in (0.95, 0.7, 0.6)]
        count[(0, False, *votes, y)] += 1
    rows_ = sorted({k[:-1] for k in count})
    post = dict(zip(rows_, pii.estimate([(*r, count[(*r, True)] + count[(*r, False)]) for r in rows_])))
    assert post[(0, False, 1, -1, -1)] > 0.5 > post[(0, False, -1, 1, 1)]


def brute_redact(t, spans):
    out, at = "", 0
    merged = []
    for s, e, n in spans:
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e, n])
    for s, e, n in merged:
        out += t[at:s] + f"<{n.upper()}>"
        at = e
    return out + t[at:]


def test_redaction_takes_out_the_spans(spark):
    texts = [r["text"] for r in rows("documents", SF2)] + HARD + ["x" * 999 + "a@b.cd" + "y " * 3000 + "1.2.3.4", "", "a@b.cd", "\U0001f600" * 1500 + " a@b.cd"]
    df = spark.createDataFrame([(k, t, len(t), "x") for k, t in enumerate(texts)], "doc_id bigint, text string, n_chars bigint, _spans string")
    spans = {r.doc_id: [(int(a), int(b), n) for n, a, b in (x.split(":") for x in r.spans.split(",") if x)] for r in pii.personal_data(df).collect()}
    out = pii.redact(df)
    assert out.columns == df.columns
    for r in out.collect():
        assert r.text == brute_redact(texts[r.doc_id], spans[r.doc_id]) and r.n_chars == len(r.text)


def test_personal_data_odd_and_empty(spark):
    got = pii.personal_data(odd(spark))
    assert got.count() == len(ODD)
    out = pii.redact(odd(spark))
    assert out.columns == odd(spark).columns and out.count() == len(ODD) and out.where("text is null").count() == 1
    assert pii.personal_data(empty(spark)).count() == 0 and pii.redact(empty(spark)).count() == 0


def test_personal_data_runs_no_python(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    for d in (pii.find_spans(df, "text", "s"), pii.redact(df), pii.personal_data(df)):
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
