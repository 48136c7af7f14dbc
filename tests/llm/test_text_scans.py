"""Operators that read each text on its own: BPE, PII, HTML, URLs, winnowing."""
from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import ODD, SF, collect

from churnlens.llm import byte_bpe, html_extract, pii, queries, url_filter, winnowing


# --- BPE ---------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import tiktoken
    ranks, pattern = byte_bpe.public_vocabulary()
    return tiktoken.Encoding("test", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_bpe_tree_equals_library(library):
    import regex
    ranks, pattern = byte_bpe.public_vocabulary()
    rng = random.Random(3)
    for leaf in (1, 3, 5):
        bpe = byte_bpe.TreeBpe(ranks, leaf=leaf, memo=500)
        pieces = byte_bpe._Pieces(bpe, entries=50)
        for _ in range(250):
            alphabet = rng.choice(["abcdethion", "aaab", "éèàthe", "=- ", "漢字かな🙂", "0123", "!?.,#$%&'s", " \n\t", "the of and"])
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 200)))
            got = np.frombuffer(byte_bpe._encode_text(text, regex.compile(pattern), pieces, block=40), "<u4").tolist()
            assert got == library.encode_ordinary(text)
            assert bpe.decode(got, block=7) == text.encode()


def test_bpe_join_is_associative():
    ranks, _ = byte_bpe.public_vocabulary()
    bpe = byte_bpe.TreeBpe(ranks)
    rng = random.Random(4)
    for _ in range(200):
        a, b, c = ("".join(rng.choice("abtheing") for _ in range(rng.randrange(0, 25))).encode() for _ in range(3))
        ea, eb, ec = (bpe._reduce(x) if x else () for x in (a, b, c))
        assert bpe.join(bpe.join(ea, eb), ec) == bpe.join(ea, bpe.join(eb, ec)) == bpe.merge(a + b + c)


def test_bpe_query_and_odd_rows(spark, odd, none, library):
    ranks, pattern = byte_bpe.public_vocabulary()
    out = byte_bpe.decode(byte_bpe.encode(odd, ranks, pattern), ranks)
    assert out.count() == len(ODD) and byte_bpe.encode(none, ranks, pattern).count() == 0
    for r in out.collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    got = queries.op10_byte_bpe(spark, SF).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# --- PII ---------------------------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def brute_spans(t):
    return {"email": [m.span() for m in EMAIL.finditer(t)],
            "ip": [m.span() for m in IP.finditer(t) if all(int(p[-4:]) <= 255 and int(p or 0) <= 255 for p in m.group().split("."))],
            "card": [m.span() for m in CARD.finditer(t) if 16 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))],
            "phone": [m.span() for m in PHONE.finditer(t) if 8 <= len(digits(m.group())) <= 15]}


def test_pii_equals_patterns():
    finder, rng = pii.Finder(), random.Random(5)
    for _ in range(15_000):
        alphabet = rng.choice(["0123456789. -+()", "ab.@-_%+", "0125.", "0 -1", "+0() .-5", "a@b.c 1+2-", "4 -11", "token=:\"x9 "])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        got, want = finder(text), brute_spans(text)
        assert {k: got[k] for k in pii.BASE_KINDS} == want, text


def test_pii_secrets_urls_and_mask(docs_of):
    text = 'a token = "d720805319a5f323fa11" b x@y.example.com, https://u.example.com/p?q c +1 (728) 555-9388.'
    got = pii.Finder()(text)
    assert [text[a:b] for a, b in got["secret"]] == ["d720805319a5f323fa11"]
    assert [text[a:b] for a, b in got["url"]] == ["https://u.example.com/p?q"]
    masked = pii.mask(docs_of([text, None, "clean text"])).orderBy("doc_id").collect()
    assert masked[0].text == 'a token = "<SECRET>" b <EMAIL>, https://u.example.com/p?q c <PHONE>.'
    assert masked[1].text is None and masked[2].text == "clean text"


def test_pii_query_and_odd_rows(spark, odd, none):
    assert pii.find_spans(odd).count() == len(ODD) and pii.find_spans(none).count() == 0
    assert all(r.spans == [] for r in pii.find_spans(odd).collect())
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op4_pii_spans(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k in pii.BASE_KINDS for a, b in want[k])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(want[k]) for k in pii.BASE_KINDS)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and r.spans.startswith(joined)


# --- HTML --------------------------------------------------------------------------------------------

@pytest.mark.parametrize(("page", "want"), [
    (None, ""), ("", ""), ("   ", ""), ("<html><body></body></html>", ""), ("plain   text\nonly", "plain text only"),
    ("<p>a<p>b", "a\n\nb"), ("<article><p>x &amp;lt; y&nbsp;&copy;<br>z</article><footer>f</footer>", "x &lt; y © z"),
    ('<body><nav>Home</nav><div class="ad">buy<div>now</div>!</div><h1>T</h1><p>one <b>two</b></p><aside>q</aside>'
     '<p class=notice>cookie<p>three</p><form>go</form><script>var t="</p>";</script><div id="comments"><p>c</p></div></body>', "T\n\none two\n\nthree"),
    ('<article><p>a</p><section class="comments"><article class="comment"><p>bad</p></article></section><p>b</p></article>', "a\n\nb"),
    ('<ul><li><a href="/x">Menu entry</a></li></ul><p>Text of the article here.</p>', "Text of the article here."),
    ("<!-- <p>no</p> --><p>yes", "yes"),
])
def test_html_cases(page, want):
    assert html_extract.main_text(page) == want


def test_html_keeps_short_runs():
    """Without an article element a short run after an advert is kept too."""
    long, last = "word " * 400, "closing words " * 20
    advert = "<div class='ad'><p>buy</p><p>now</p><p>cheap</p></div>"
    assert html_extract.main_text(f"<body><p>{long}</p>{advert}<p>{last}</p></body>") == f"{long.strip()}\n\n{last.strip()}"


@pytest.mark.parametrize("page, want", [
    ("<div class='layout no-sidebar'><p>one</p><article><p>two</p></article></div>", "two"),
    ("<article class='post has-comments'><p>text</p></article>", "text"),
    ("<div class='social'><main><article class='share'><p>text</p></article></main></div>", "text"),
    ("<div class='with-widgets tag-social'><p>text</p></div><div class='post-comments'><p>reply</p></div>", "text"),
    ("<article><p>text</p><article class='comment'><p>reply</p></article></article>", "text"),
    ("<article><p>text</p></article><div class='related'><article><p>more</p></article></div>", "text")])
def test_html_cues_spare_the_article(page, want):
    assert html_extract.main_text(page) == want


def test_html_surges():
    assert html_extract.surges(np.array([0, 0, 5, 0, 7, 0, 0, 0, 2]), 3) == [(2, 5), (8, 9)]
    assert html_extract.surges(np.array([], int)) == [] and html_extract.surges(np.array([0, 0])) == []


def test_html_surges_decide_on_lines_of_links():
    """without an article element, links between a surge and its dive are text, those of a longer list or outside are a menu."""
    link = "<p><a href='/x'>link {}</a></p>"
    menu = "".join(link.format(i) for i in range(3))
    text = html_extract.main_text(link.format("top") + "<p>one</p>" + link.format("in") + "<p>two</p>" + menu + "<p>three</p>" + link.format("end"))
    assert text == "one\n\nlink in\n\ntwo\n\nthree"
    assert html_extract.main_text("<p>one</p><nav>" + link.format("nav") + "</nav><p>two</p>") == "one\n\ntwo"
    assert html_extract.main_text("<article><p>one</p>" + menu + "</article>") == "one\n\nlink 0\n\nlink 1\n\nlink 2"


def test_html_query(spark):
    import html
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op3_html_text(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:   # brute force for this table's pages: the article's paragraphs
        body = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h[1-6])>", body)]
        assert r.text == "\n\n".join(x for x in parts if x) and r.n_chars == len(r.text)


# --- URLs --------------------------------------------------------------------------------------------

def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return lower, re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]


def brute_rule(host, path):
    best = None
    for verdict, rule in url_filter.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return best or (None, None)


URLS = ["http://example.com/en/x", "https://www.example.com/en/1?q", "http://a.www.example.com/en/", "http://EXAMPLE.com/EN/", "http://com",
        "http://com/", "ftp://x.net/es/a#b", "http://x.net/en/", "http://net/fr/", "http://xnet/fr/", "nothing", "", None, "://", "http://?a/b",
        "http://x.example.com", "http://x.org/fr/1"]


def test_url_rules_and_odd_rows(spark):
    frame = spark.createDataFrame([(i, u, "z") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    judged = url_filter.judge(frame, url_filter.fit([("a.example.com", "/en/1", 1), ("b.org", "/x", 0)])).orderBy("page_id").collect()
    assert len(judged) == len(URLS)
    for u, r in zip(URLS, judged):
        verdict, rule = brute_rule(*brute_url(u))
        assert (r.host, r.path, r.rule) == (*brute_url(u), rule)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
    empty = frame.limit(0)
    assert url_filter.judge(empty, url_filter.train(url_filter.rule_labels(empty))).count() == 0


def test_url_classifier_learns(spark):
    rows = [(f"http://{h}.org/{p}/{i}", y) for i in range(60) for h, p, y in (("ads-track", "promo", 1), ("news", "story", 0))]
    model = url_filter.train(spark.createDataFrame([*rows, (None, 1), ("http://x.y/z", None)], "url string, label int"))
    assert model.score("ads-track.org", "/promo/999") > 0.8 and model.score("news.org", "/story/999") < 0.2
    assert url_filter.train(spark.createDataFrame([("http://a.b/c", 0)], "url string, label int")).score("a.b", "/c") < 0.01


def test_url_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op5_url_filter(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        verdict, rule = brute_rule(*brute_url(pages[r.page_id]))
        assert (r.host, r.path, r.rule) == (*brute_url(pages[r.page_id]), rule)
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)


# --- winnowing ---------------------------------------------------------------------------------------

def brute_winnow(text, k=winnowing.GRAM, w=winnowing.WINDOW):
    codes = winnowing._codes(text)
    n = len(codes)
    if not n:
        return []
    values = [int(x) for x in winnowing.mix64(codes.astype(np.uint64) + np.uint64(1))]
    k, hashes = min(k, n), []
    for i in range(n - k + 1):
        h = 0
        for x in values[i:i + k]:
            h = (h * winnowing._BASE + x) % (1 << 64)
        hashes.append(int(winnowing.mix64(np.array([h], np.uint64))[0]) >> 32)
    kept = set()
    for i in range(max(1, len(hashes) - w + 1)):
        window = range(i, min(len(hashes), i + w))
        low = min(hashes[j] for j in window)
        kept.add(max(j for j in window if hashes[j] == low))
    return [(hashes[j], j) for j in sorted(kept)]


def test_winnow_equals_brute_force_and_guarantee():
    rng = random.Random(1)
    for i in range(80):
        text = "".join(rng.choice("ab" if i % 2 else "abcdéfgh 🙂") for _ in range(rng.randrange(0, 160)))
        h, p = winnowing.winnow(winnowing._codes(text))
        assert list(zip(h.tolist(), p.tolist())) == brute_winnow(text)
    shared = "".join(rng.choice("abcdefgh") for _ in range(winnowing.GRAM + winnowing.WINDOW - 1))
    a, b = ("".join(rng.choice("xyz") for _ in range(50)) + shared + "".join(rng.choice("uvw") for _ in range(90)) for _ in range(2))
    assert set(winnowing.winnow(winnowing._codes(a))[0]) & set(winnowing.winnow(winnowing._codes(b))[0])


def check_neighbours(rows, got):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    texts = [t or "" for _, t in ordered]
    sets = [np.unique(winnowing.winnow(winnowing._codes(t))[0]) for t in texts]
    want = []
    for i, (doc, _) in enumerate(ordered):
        j = (i + 1) % len(ordered)
        edited = winnowing.edit(texts[i], texts[j])
        codes = winnowing.winnow(winnowing._codes(edited))
        want.append((doc, len(texts[i]), hashlib.sha256(edited.encode()).hexdigest(), winnowing.as_text(*winnowing.winnow(winnowing._codes(texts[i]))),
                     winnowing.as_text(*codes), winnowing.likeness(sets[i], np.unique(codes[0])), winnowing.likeness(sets[i], sets[j])))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_winnow_query_and_odd_rows(spark, odd, none, real_rows, docs_of):
    check_neighbours(ODD, winnowing.neighbour_fingerprints(odd).collect())
    check_neighbours([(3, "a lonely text")], winnowing.neighbour_fingerprints(docs_of([(3, "a lonely text")])).collect())
    assert winnowing.neighbour_fingerprints(none).count() == 0
    check_neighbours(real_rows, queries.op8_winnowing(spark, SF).collect())
    shares = winnowing.fingerprints(odd).collect()
    assert len(shares) == len(ODD) and all(len(r.fingerprint) == 0 for r in shares if not r.text)


def test_hasher_blocks_agree():
    """Words hash alike wherever they stand, whatever the block size."""
    from churnlens.llm.common import WordHasher, text_buffer
    texts = ["The quick  brown", None, "", "fox\njumps " * 50, "THE quick", "x" * 200]
    col = pa.array(texts, pa.large_string())
    data, offsets = text_buffer(col)
    large, small = WordHasher(), WordHasher()
    small.BLOCK = 64
    h, first = large(data, offsets)
    sizes = [len((t or "").split()) for t in texts]
    assert np.diff(first).tolist() == sizes and h[0] == h[first[4]]
    g, first_small = small(data, offsets)
    assert np.array_equal(first, first_small) and np.array_equal(h[:first[5]], g[:first[5]])
