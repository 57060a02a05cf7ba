"""Personal data, pages, licences and top-k against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import time
from collections import Counter

import pytest

from veilmark.llm import html, licenses, privacy, topk

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(value):
    digits = [int(c) for c in value if c.isdigit()]
    total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
    return 16 <= len(digits) <= 19 and total % 10 == 0


RIGHT = {
    "email": lambda v: True,
    "ip": lambda v: all(int(p) <= 255 for p in v.split(".")),
    "card": luhn,
    "phone": lambda v: 8 <= sum(c.isdigit() for c in v) <= 15,
}


def plain_spans(text):
    return ",".join(
        f"{k}:{m.start()}:{m.end()}" for k in PLAIN for m in re.finditer(PLAIN[k], text or "") if RIGHT[k](m.group())
    )


ODD = [
    None, "", "a@b.c_d@e.f g@h.i", "1.2.3.4.5.6.7.8 999.1.1.1 0255.000.1.2 1.2.3", "4111 1111 1111 1111",
    "4111-1111-1111-1111 x 4111 1111 1111 1112", "5 4111111111111111", "+1 (212) 555-1234 +12 +1234567 8", "++1234567890",
    "é😀 a.b@c.d 😀 1.1.1.1", "x" * 200 + "@" + "y." * 50 + "z", "7" * 30_000, "1 " * 20_000, "a@b", "a@b.c@d.e",
    "%" * 50_000 + "@x.y", "41111111111111111111", "4222222222222222224 4000 0000 0000 0000 006",
]


def test_base_spans_match_the_plain_patterns(documents):
    rows = list(enumerate(ODD)) + [(3, ODD[3])]
    found = privacy.personal_data(documents(rows)).collect()
    expected = Counter((i, plain_spans(t)) for i, t in rows)
    assert Counter((r.doc_id, r.spans) for r in found) == expected
    for r in found:
        assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [r.spans.count(f"{k}:") for k in PLAIN]


def test_disclosing_terms_are_added_and_common_ones_are_not(documents):
    rows = [(i, f"dear Quillon write to quill@example.org soon about {i} things") for i in range(4)]
    rows += [(10 + i, f"dear all write soon about {i} things and to the others {i}") for i in range(40)]
    rows += [(60, "one other@example.org here"), (61, None)]
    frame = documents(rows)
    found = {r.doc_id: r.spans for r in privacy.personal_data(frame).collect()}
    assert found[0] == f"{plain_spans(rows[0][1])},term:5:12"
    assert found[60] == plain_spans(rows[-2][1]) and found[10] == "" and found[61] == ""
    out = privacy.sanitised(frame)
    assert out.columns == frame.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[1] == "dear [name] write to [email] soon about 1 things" and texts[61] is None
    assert texts[10] == rows[4][1] and len(texts) == len(rows)


def brute_terms(rows):
    """Disclosing terms per row, from the definition."""
    words = [{w.lower() for w in re.findall(r"[^\W_]+", t or "")} for _, t in rows]
    held = [{(k, m.group().lower()) for k in PLAIN for m in re.finditer(PLAIN[k], t or "") if RIGHT[k](m.group())} for _, t in rows]
    of_term, of_entity = Counter(w for ws in words for w in ws), Counter(e for es in held for e in es)
    of_pair = Counter((e, w) for ws, es in zip(words, held, strict=True) for e in es for w in ws)
    total, found = len(rows), set()
    for (e, w), n in of_pair.items():
        p, a = of_entity[e] / total, n / of_term[w]
        if a > p and math.log2(a / p) >= privacy.DISCLOSURE * math.log2(1 / p) - 1e-12:
            k = of_term[w]
            if a < 1:
                bits = k * (a * math.log2(a / p) + (1 - a) * math.log2((1 - a) / (1 - p)))
            else:
                bits = math.log2(math.comb(total, k) / math.comb(of_entity[e], k))
            if bits >= math.log2(len(of_term) / privacy.CHANCE):
                found.add((e, w))
    return [{w for w in ws if any((e, w) in found for e in es)} for ws, es in zip(words, held, strict=True)]


def test_terms_anywhere_in_a_text_disclose_entities_of_two_documents(documents):
    filler = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"{filler} plain{i % 7}") for i in range(400)]
    rows += [(1000 + i, f"Quillon at the top, {filler} and Quillon again {filler} q@example.org") for i in range(2)]
    rows += [(1010 + i % 2, f"Brandt {filler} Brandt b@example.org 10.0.0.{i % 2 + 1}") for i in range(4)]
    rows += [(1020 + i, f"Often {'Zed' if i else ''} {filler} o@example.org") for i in range(12)]
    rows += [(1040, "Often Zed here"), (1041, f"once {filler} single@example.org"), (None, rows[400][1])]
    expected = brute_terms(rows)
    assert {"quillon", "top"} <= expected[400] and "word1" not in expected[400] and "brandt" in expected[402] and expected[-2] == set()
    for row, (i, text) in zip(expected, rows, strict=True):
        marks = [f"term:{m.start()}:{m.end()}" for m in re.finditer(r"[^\W_]+", text) if m.group().lower() in row]
        inside = {f"term:{m.start() + a}:{m.start() + b}" for m in re.finditer(PLAIN["email"] + "|" + PLAIN["ip"], text)
                  for a in range(len(m.group())) for b in range(a + 1, len(m.group()) + 1)}
        rows[rows.index((i, text))] = (i, text, [m for m in marks if m not in inside])
    found = privacy.personal_data(documents([r[:2] for r in rows])).collect()
    got = Counter((r.doc_id, tuple(p for p in r.spans.split(",") if p.startswith("term"))) for r in found)
    assert got == Counter((i, tuple(marks)) for i, _, marks in rows)


def test_personal_data_of_an_empty_table(documents):
    assert privacy.personal_data(documents([])).count() == 0


def page(body, head="<title>t</title><script>var a='</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        (page("<nav>m</nav><article><h1>T &eacute;</h1><p><b>A  b<br><p>c\n d</p></article><footer>f</footer>"), "T é\nA b\nc d"),
        (page("<article><p>a<!-- x --> <i>b</i></p><aside>no</aside><form>no</form><p>c"), "a b\nc"),
        (page("<div class='site-header'>no</div><main><p>yes</main><div id=comments><p>no</p></div>"), "yes"),
        (page("<article><p>x</p><section class='comments'><article><p>no</p></article></section></article>"), "x"),
        (page("<p>no article here</p><ul><li>one<li>two</ul><div hidden>no</div>"), "no article here\none\ntwo"),
        (page("<article><p class=\"lead>unclosed</p>"), "unclosed"),
        (page("<article><p>1 < 2 &lt;b&gt;</p></article>"), "1 < 2 <b>"),
    ],
)
def test_main_text_of_one_page(source, text):
    assert html.Page(source or "").main_text() == text


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<main class='with-sidebar'><p>yes</main>", "yes"),
        ("<div class='content no-sidebar'><p>yes</div>", "yes"),
        ("<article class='post category-social tag-promo promo'><h1 class='header'>T</h1><p>yes</article>", "T\nyes"),
        ("<article><section id='related-work'><p>yes</section><div class='x Related'>no</div></article>", "yes"),
        ("<div class='widget'><p>no</p><article><p>yes</article><p>no</p></div>", "yes"),
        ("<article><p>yes</article><div id=comments><article><p>no</article></div>", "yes"),
        ("<div role=dialog><article><p>no</article></div><p>yes", "yes"),
    ],
)
def test_names_of_boilerplate_are_whole_tokens_and_spare_articles(source, text):
    assert html.Page(page(source)).main_text() == text


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<p>yes<div class='comment-body'>no</div><ul class=comments-list><li>no</ul><ol class=commentlist><li>no</ol>", "yes"),
        ("<div id=cookie-banner>no</div><p>yes</p><div class='site-footer-links'>no</div>", "yes"),
        ("<div class='no-sidebar tag-comments content_with_sidebar'><p>yes</div><div class='legal_notice'>no</div>", "yes"),
        ("<article class=category-comments><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold.</article>", "Let x=2 hold."),
        ("<article><math><semantics><mi>x</mi><annotation>\\x</annotation></semantics></math></article>", "x"),
        ("<article><figure><img><noscript>A caption</noscript></figure></article><noscript>no</noscript>", "A caption"),
        ("<p>a<xmp><b>1 &amp; 2</b></xmp>b", "a\n<b>1 &amp; 2</b>\nb"),
        ("<p>Text <button>no</button>more<select><option>no<option>no</select> <audio><p>no</p></audio>end", "Text more end"),
        ("<p>Intro before the article.</p><article><p>It.</article><p>After.", "Intro before the article.\nIt.\nAfter."),
        ("<div class='page-header'><h1>T</h1></div><p>yes", "T\nyes"),
        ("<div class='top-menu'>no</div><article><div class='post-header'><h1>T</h1></div><p>yes</article>", "T\nyes"),
        ("<script src=//cdn.x/y/>var no=1;</script><p>yes<svg/> too<svg viewBox='0' ><text>no</text></svg>", "yes too"),
        ("<p>1 < 2 and 3 <4</p>", "1 < 2 and 3 <4"),
        ("<p title='a > b'>yes</p><a href=\"x>y</a>", "yes\ny"),
    ],
)
def test_contract_of_main_text(source, text):
    assert html.Page(page(source)).main_text() == text


@pytest.mark.parametrize(
    "form",
    [
        lambda n: '<a href="' * n, lambda n: '<a href="' * n + ">", lambda n: "<a 'x\"" * n + ">", lambda n: "<" * n,
        lambda n: "<div>" * n + "</ul>" * n, lambda n: "<blockquote>" * n + "<p>x</h1>" * n, lambda n: "<!--" * n,
        lambda n: "<h1><div>" + "<blockquote>" * n + "</h1>" * n, lambda n: "<script>" + "</script " * n,
        lambda n: "<object>" * n + "<p>x" * n, lambda n: "<p>" + "word " * n, lambda n: "&amp" * n,
    ],
)
def test_time_grows_with_the_length_of_a_page(form):
    def seconds(n):
        start = time.process_time()
        html.Page(form(n))
        return time.process_time() - start

    # Four times the page in far less than sixteen times the time; at least a second's worth of slack for noise.
    assert seconds(80_000) < 8 * seconds(20_000) + 1


def test_templates_go_and_quoted_paragraphs_stay(spark):
    rows = [
        (i, f"http://h{i % 2}.example/{i}", page(f"<div>Site line</div><div>own {i} words</div><p>said {i}</p>"), "x")
        for i in range(20)
    ]
    rows += [(100 + i, f"http://a.example/{i}", page(f"<article><p>Same quote</p><p>{i}</p><div>Join us</div></article>"), "x") for i in range(9)]
    rows += [(200, None, page("<div>Site line</div>"), "x"), (None, "no host", None, "x"), (0, rows[0][1], rows[0][2], "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html.main_texts(frame).collect()
    got = Counter((r.page_id, r.text, r.n_chars) for r in found)
    texts = [(i, f"own {i} words\nsaid {i}") for i in range(20)] + [(0, "own 0 words\nsaid 0")]
    texts += [(100 + i, f"Same quote\n{i}") for i in range(9)] + [(200, "Site line"), (None, "")]
    assert got == Counter((i, t, len(t)) for i, t in texts)
    assert html.main_texts(frame.limit(0)).count() == 0


def test_licences(documents):
    mit = next(t for n, t in licenses.KNOWN if n == "MIT" and "Permission" in t)
    rows = [
        (1, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ,")),
        (2, "RELEASED under the MIT Licence!!"),
        (3, None),
        (4, ""),
        (5, "x\n\nAll  rights reserved\n\ny"),
        (5, "All rights reserved"),
        (6, "All rights reserved by nobody " * 3000),
        (None, "Licensed under CC-BY NC 4.0\nreleased UNDER the MIT license"),
    ]
    found = {(r.doc_id, r.n_licenses, r.licenses, r.whole_license) for r in licenses.license_scan(documents(rows)).collect()}
    assert found == {
        (1, 1, "MIT", "MIT"), (2, 1, "MIT", "MIT"), (3, 0, "", ""), (4, 0, "", ""),
        (5, 1, "all-rights-reserved", ""), (5, 1, "all-rights-reserved", "all-rights-reserved"), (6, 0, "", ""),
        (None, 2, "CC-BY-NC-4.0,MIT", ""),
    }
    assert licenses.license_scan(documents([])).count() == 0


def brute_top(vectors, asked, k):
    out = set()
    for q in asked:
        scores = sorted((-sum(a * b for a, b in zip(vectors[q], v, strict=False)), i) for i, v in vectors.items() if i != q)
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return out


def test_templates_of_large_hosts_are_found_by_their_count(spark):
    def body(i):
        advert = "<div>Buy now</div>" if i < 120 else "<div>rare</div>" if i < 160 else ""
        quote = "<p>quoted</p>" if i < 110 else ""
        return f"{advert}<article>{quote}<p>own {i}</p><div>{advert}</div><p>Subscribe</p><ul><li>yes</li><li>{i}</li></ul></article>"

    # 1000 pages: the advert on 12 %, its lookalike on 4 %, a quote on 11 %, the subscription everywhere.
    rows = [(i, f"http://large.example/{i}", page(body(i))) for i in range(1000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html.main_texts(frame).collect()}
    assert found[0] == "quoted\nown 0\n0" and found[115] == "own 115\n115"
    assert found[130] == "rare\nown 130\nrare\n130" and found[999] == "own 999\n999"


def test_whole_published_licences_titles_and_headers(documents):
    mit = next(t for n, t in licenses.KNOWN if n == "MIT" and "Permission" in t)
    rows = [(f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in licenses.TEXTS.iterdir()]
    apache = dict(rows)["Apache-2.0"]
    rows += [("MIT", f"MIT License\n\nCopyright (c) 2020 Someone\n\n{mit}\n")]
    rows += [("Apache-2.0", apache.replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2021 Someone"))]
    rows += [("Apache-2.0", apache[: apache.index("APPENDIX")])]
    rows += [("GPL-3.0", dict(rows)["GPL-3.0"].partition("\n\n")[2])]
    rows += [(name, "Copyright 2019, Someone\n" + text.replace("\n", "\r\n")) for name, text in licenses.BODIES]
    header = next(t for n, t in licenses.HEADERS if n == "Apache-2.0")
    comment = "\n".join(f" * {line}" for line in header.split("\n"))
    frame = documents([(i, text) for i, (_, text) in enumerate(rows)] + [(-1, f"/*\n{comment}\n */\n\nint main() {{}}\n")])
    found = {r.doc_id: r for r in licenses.license_scan(frame).collect()}
    names = {"Apache-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0", "BSD-2-Clause", "BSD-3-Clause", "Zlib", "Unlicense"}
    assert names <= {n for n, _ in rows}
    assert [found[i].whole_license for i in range(len(rows))] == [n for n, _ in rows]
    assert found[-1].licenses == "Apache-2.0" and found[-1].whole_license == ""


@pytest.mark.parametrize(("count", "block"), [(3, 2048), (400, 2048), (400, 60)])
def test_top_k_with_ties_and_odd_vectors(spark, monkeypatch, count, block):
    import random

    monkeypatch.setattr(topk, "VECTORS", block)
    monkeypatch.setattr(topk, "QUERIES", 5)
    monkeypatch.setattr(topk, "AT_ONCE", 3)
    rng = random.Random(count)
    vectors = {i: [rng.randrange(-3, 4) for _ in range(6)] for i in range(count)}
    rows = [(i, [x / 256 + 0.001 for x in v], "x") for i, v in vectors.items()]
    rows += [rows[1], (900, None, "x"), (950, [1.0, None], "x"), (1000, [float("inf")], "x"), (1050, [float("nan")], "x"), (None, [1.0], "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    usable = topk.integer_vectors(frame)
    got = topk.top_k(usable, usable.filter("vec_id % 50 = 0")).collect()
    assert {tuple(r) for r in got} == brute_top(vectors, [i for i in vectors if i % 50 == 0], 5)
    none = usable.limit(0)
    assert topk.top_k(none, none).count() == 0


def test_scores_that_may_not_fit_are_refused(spark):
    vectors = spark.createDataFrame([(0, [1 << 40] * 4), (50, [1 << 40] * 4)], "vec_id long, vector array<long>")
    with pytest.raises(Exception, match="may not fit a long"):
        topk.top_k(vectors, vectors).collect()
