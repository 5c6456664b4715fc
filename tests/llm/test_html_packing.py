"""HTML extraction and packing against plain Python."""

import html
import re
import zlib

import numpy as np
import pytest

from strata.llm import bestfit_packing, html_consensus
from strata.llm.queries import tokenizer_path
from strata.llm.tokens import WordEncoder

SF = "/root/testdata/sf0.01"


def plain_article(page):
    m = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
    parts = re.split(r"</?(?:p|h1|article)>", m[1].replace("<br>", " ")) if m else []
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
    return "\n".join(t for t in texts if t)


def test_pages_equal_a_plain_reading(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    got = html_consensus.extract_pages(pages).collect()
    assert len(got) == len(source)
    for r in got:
        assert r.text == plain_article(source[r.page_id]) and r.n_chars == len(r.text)


LAYOUT = """<html><body class="page-{n}"><div id="menu"><a href="/">Home</a> <a href="/b">More</a></div>
<div class="ad-box"><p>Buy now! Buy now! Buy now! Buy now! Buy now! Buy now!</p></div>
<div class="wrap"><div class="post-{n} body">{text}</div><div class="sidebar"><p>links</p></div>
<div class="comments"><p>A reader says a great deal about it, and then says more of it.</p></div></div>
<form><p>Name</p><input></form><footer>end</footer></body></html>"""


def test_hosts_vote_for_short_pages(spark):
    long = "<h2>Title</h2><p>" + "some words of the text " * 20 + "</p><p>and&nbsp;a   second&#33;</p>"
    rows = [(i, "https://User@Ex.org:8080/a", LAYOUT.format(n=i, text=long)) for i in range(6)]
    odd = "<html><body><div class='wrap'><div class='post-9 body'><p>Hi</p></div><div class='x'><p>" + "other things entirely " * 30 + "</p></div></div></body></html>"
    rows += [(7, "http://ex.org/b", odd), (8, "http://other.org/", odd)]
    got = {r.page_id: r for r in html_consensus.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = "Title\n" + " ".join(["some words of the text"] * 20) + "\nand a second!"
    assert all(got[i].text == want and got[i].path == "body.page>div.wrap>div.body.post" for i in range(6))
    assert got[8].text.startswith("other things")     # its own vote
    assert got[7].host == "ex.org"


def test_a_page_follows_its_host(spark):
    long = "<article><p>" + "text " * 100 + "</p></article>"
    short = "<article><p>Short.</p></article><div class='z'><p>" + "noise " * 50 + "</p></div>"
    rows = [(i, "http://h/x", f"<body>{long}</body>") for i in range(3)] + [(3, "http://h/y", f"<body>{short}</body>")]
    got = {r.page_id: r.text for r in html_consensus.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Short."


def test_pages_of_odd_tables(spark):
    schema = "page_id long, url string, html string, path string, winners string"
    assert html_consensus.extract_pages(spark.createDataFrame([], schema)).collect() == []
    deep = "<div>" * 5000 + "deep text" + "</div>" * 5000
    rows = [(1, None, None), (2, "", ""), (3, "x", "no markup &lt; &amp;copy &eacute; &am"), (4, "http://d/", deep), (None, None, "<p>a<p"),
            (6, "http://q/", "<a href=\"x>odd</a> <b title='1>2'>t</b>"), (7, "http://s/", "<script>if(a<b){'</p>'}</script><p>k<!-- <p>no -->&copy;</p>"),
            (7, "http://s/", "<p>k</p>"), (8, "http://l/", "<p>" + "w " * 200_000)]
    got = [(r.page_id, r.text) for r in html_consensus.extract_pages(spark.createDataFrame([(*r, "c", "c") for r in rows], schema)).collect()]
    text = dict(got)
    assert len(got) == len(rows) and text[1] == text[2] == "" and text[3] == "no markup < &copy é &am"
    assert text[4] == "deep text" and text[None] == "a" and text[8] == " ".join(["w"] * 200_000)
    assert sorted(t for p, t in got if p == 7) == ["k", "k©"]


def test_elements_of_any_depth_are_closed_and_left_out(spark):
    deep = "<article><p>Start of it.</p>" + "<div>" * 250 + "inside" + "</div>" * 250 + "<p>" + "words after it " * 9 + "</p></article><div>out</div>"
    noise = "<article><p>" + "words of the text " * 9 + "<b>" * 300 + "more<footer>the foot</footer><nav>a menu</nav></article>"
    rows = [(1, "http://a/", deep), (2, "http://b/", noise)]
    got = {r.page_id: r.text for r in html_consensus.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == "Start of it.\ninside\n" + " ".join(["words after it"] * 9)
    assert got[2] == " ".join(["words of the text"] * 9) + " more"
    assert html_consensus.vote("<b><p>x" * 20_000)[1] == 20_000


def test_pages_with_their_own_class_words_vote_together(spark):
    page = "<body class='single slug-{a}'><div class='post category-{b} tag-{a}'><p>{text}</p></div><div class='extra'><p>{more}</p></div></body>"
    name = lambda n: "".join(chr(103 + int(c)) for c in str(n))  # noqa: E731  no digits, no hash
    rows = [(i, "http://h/x", page.format(a=name(i), b=name(i % 15), text="text " * 100, more="")) for i in range(40)]
    rows += [(90, "http://h/y", page.format(a="short", b="other", text="Short.", more="noise " * 50))]
    rows += [(91, url, page.format(a="short", b="other", text="Short.", more="noise " * 50)) for url in (None, "/rel", "//h/x")]
    rows += [(92, None, page.format(a=name(i), b="q", text="text " * 100, more="")) for i in range(5)]
    got = html_consensus.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows)
    assert {(r.text, r.path) for r in got if r.page_id == 90} == {("Short.", "body.single>div.post")}
    assert [r.text for r in got if r.page_id == 91] == [" ".join(["noise"] * 50)] * 3  # no host: their own votes


def test_a_page_of_a_second_template_keeps_its_article(spark):
    first = "<body><div class='content'><p>" + "first kind " * 50 + "</p></div></body>"
    second = "<body><div class='content'>{teaser}</div><div class='story'><p>" + "second kind " * 50 + "</p></div></body>"
    rows = [(i, "http://h/1", first) for i in range(30)]
    rows += [(100 + i, "http://h/2", second.format(teaser=t)) for i, t in enumerate(["", "<p>Read on</p>", "<p> </p>", "<p><a href='/'>more</a></p>"] * 3)]
    got = {r.page_id: (r.text, r.path) for r in html_consensus.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert set(got[i] for i in range(30)) == {(" ".join(["first kind"] * 50), "body>div.content")}
    assert set(got[100 + i] for i in range(12)) == {(" ".join(["second kind"] * 50), "body>div.story")}


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def test_word_memory_gives_the_tokenizers_ids(tokenizer, spark):
    encoder = WordEncoder(tokenizer_path())
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["it's DON'T i'LL 'S", "<|endoftext|>a <|startoftext|>", "a\x1cb\x85c\xa0d　e", "ΑΣΣ ΌΣΟΣ İstanbul", "é ﬁ ½ ٣ 日本 ß ẞ",
              "😀👍🏽 a_b \\ 10,000.5 1st", "", " \n", "x×y µ ª ÿ", "a̧b ​"]
    for text in texts:
        assert list(np.frombuffer(encoder.encode(text), "<u4")) == tokenizer.encode(text, add_special_tokens=False).ids


def test_a_tokenizer_of_other_rules_encodes_whole_texts(tokenizer, tmp_path):
    import json
    rules = json.loads(tokenizer.to_str())
    assert WordEncoder(tokenizer_path()).by_words
    changes = [lambda r: r.update(normalizer=None), lambda r: r["normalizer"]["normalizers"].pop(),
               lambda r: r["pre_tokenizer"]["pretokenizers"][0]["pattern"].update(Regex="\\S+"),
               lambda r: r.update(pre_tokenizer={"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True})]
    from tokenizers import Tokenizer
    for k, change in enumerate(changes):
        other = json.loads(json.dumps(rules))
        change(other)
        path = tmp_path / f"{k}.json"
        path.write_text(json.dumps(other))
        encoder = WordEncoder(str(path))
        assert not encoder.by_words
        for text in ("Some words, twice:  some WORDS 123", "", " a\n\nb "):
            assert list(np.frombuffer(encoder.encode(text), "<u4")) == Tokenizer.from_file(str(path)).encode(text, add_special_tokens=False).ids


def test_packing_keeps_all_columns_of_pieces(spark):
    names = ["id", "length", "_id", "size", "kind", "bin", "place", "row", "a.b"]
    df = spark.createDataFrame([(i, 10 + i % 90, i, "s", 1, 2, 3, "r", i * 2) for i in range(60)], names)
    got = bestfit_packing.pack_pieces(df, 100)
    assert got.columns == [*names, "sequence_id", "offset"]
    rows = got.collect()
    assert sorted((r["id"], r["length"], r["a.b"]) for r in rows) == [(i, 10 + i % 90, i * 2) for i in range(60)]
    check_packing(rows, 100)


def brute_pieces(tokenizer, rows, capacity):
    out = []
    for d, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), capacity):
            part = ids[k:k + capacity]
            out.append((d, k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out)


def check_packing(rows, capacity):
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held)


@pytest.mark.parametrize("capacity", [4096, 300])
def test_packing_is_whole_and_tight(documents, tokenizer, capacity):
    rows = bestfit_packing.pack_documents(documents, tokenizer_path(), capacity=capacity).collect()
    source = [(r.doc_id, r.text) for r in documents.collect()]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == brute_pieces(tokenizer, source, capacity)
    n = check_packing(rows, capacity)
    assert n <= 1.02 * -(-sum(r.length for r in rows) // capacity) + 1


@pytest.mark.parametrize("lengths", [[60] * 50, [1] * 500, [100] * 7, list(range(1, 101)) * 3, [51, 50, 50, 49, 99, 1, 34, 33, 33], []])
@pytest.mark.parametrize("per_range", [100_000, 5])
def test_rounds_come_near_best_fit(spark, monkeypatch, lengths, per_range):
    monkeypatch.setattr(bestfit_packing, "ROWS_PER_RANGE", per_range)  # several ranges: matches across them
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    rows = bestfit_packing.pack_pieces(df, 100).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(lengths)))
    gaps = []
    for n in sorted(lengths, reverse=True):  # best fit, one after the other
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((100 if fit is None else fit) - n)
    assert check_packing(rows, 100) <= len(gaps) * 1.03 + 1


def test_packing_of_odd_tables(spark, make_docs, tokenizer):
    assert bestfit_packing.pack_documents(make_docs().limit(0), tokenizer_path()).collect() == []
    source = [(1, None), (2, ""), (3, "x " * 9000), (3, "x " * 9000), (5, "a" * 30_000)]
    rows = bestfit_packing.pack_documents(make_docs(*source), tokenizer_path()).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == brute_pieces(tokenizer, source, 4096)
    check_packing(rows, 4096)


PROSE = "<h1>The title</h1><p>" + "words of the article " * 12 + "</p><p>and its end.</p>"
WANT = "The title\n" + " ".join(["words of the article"] * 12) + "\nand its end."
AROUND = ("<div class='sidebar'><p>Popular things to see and do and buy this week in town.</p></div><section class='related'><article class='card'>"
          "<p>Another story you may like to read.</p></article><article class='card'><p>And another one.</p></article></section>"
          "<ol class='comment-list'><li><article class='comment-body'><p>" + "A reader writes at length about it. " * 30 + "</p></article></li></ol>"
          "<div id='comments-area'><p>Leave a reply</p></div><div class='post__share-bar'>Share this</div><footer>The foot.</footer>")
THEMES = {
    "sidebar": "<div class='content has-sidebar'><article>{}</article></div>{}",
    "subject": "<article class='post category-search tag-legal'>{}</article>{}",
    "flags": "<article class='story story--no-comments share-enabled'>{}</article>{}",
    "layout": "<div id='wrap' class='sidebar-right'><main><div class='entry-content'>{}</div></main></div>{}",
    "layout without tags": "<div class='layout sidebar-right'><div class='post-content'>{}</div></div>{}",
    "share above": "<div class='share-wrap'><div class='article-body'>{}</div></div>{}",
    "widget above": "<div class='elementor-widget widget'><div class='widget-inner'><article>{}</article></div></div>{}",
    "role": "<div class='promo' role='main'>{}</div>{}",
    "property": "<div class='header-wide'><div itemprop='articleBody'>{}</div></div>{}",
    "article in a hint": "<article class='post'><div class='notice-body'>{}</div></article>{}",
    "hints in hints": "<article><div class='side'><div class='widget'>{}</div></div></article>{}",
    "no names": "<div class='alert'><div>{}</div></div><footer>x</footer>",
    "comments off": "<body class='no-comments single-post'><div class='comments-closed post'>{}</div>{}",
}


@pytest.mark.parametrize("theme", THEMES)
def test_class_words_do_not_take_the_article(theme):
    page = "<html><body><nav>Home</nav>" + THEMES[theme].format(PROSE, AROUND) + "</body></html>"
    assert html_consensus.extract(page, [])[0] == WANT


@pytest.mark.parametrize("text", [PROSE, "<p>Short.</p>"])
def test_what_the_words_name_stays_out(text):
    inner = "<div class='advert'><p>" + "buy this now " * 40 + "</p></div><div class='share-bar'>Share</div><ul class='tags'><li>one</li></ul>"
    page = f"<body><div class='cookie-notice'><p>{'We use cookies on this site. ' * 20}</p></div><article>{text}{inner}</article>{AROUND}</body>"
    assert html_consensus.extract(page, [])[0] == (WANT if text is PROSE else "Short.")


def test_hints_of_any_depth_take_linear_time():
    deep = "<article>" + "<div class='widget'>" * 4000 + "<p>deep text</p>" + "</div>" * 4000 + "</article>"
    many = "<article>" + "<div class='widget'><p>part of it</p></div>" * 4000 + "</article>"
    assert html_consensus.extract(deep, [])[0] == "deep text"
    assert html_consensus.extract(many, [])[0] == "part of it"


def test_words_of_classes():
    hint = lambda c: html_consensus._hint("div", {"class": c})
    assert {hint(c) for c in ("sidebar", "page sidebar-left", "ad", "top_ads", "post__share", "share-bar--wide", "menu")} == {"noise"}
    assert {hint(c) for c in ("comments", "comment-body", "post__comments", "ad comment-list")} == {"comments"}
    assert {hint(c) for c in ("", "has-sidebar", "no-comments", "category-search", "tag-legal", "story--no-comments", "share-enabled", "comments-closed",
                              "adrift", "headers-of-state", "layout-sidebar", "search-layout")} == {""}


def test_repeated_pages_cost_their_number(spark):
    import time
    page = "<body><div class='a'><div class='b'><article><p>" + "text " * 30 + "</p></article></div></div></body>"
    took = []
    for n in (200, 3000):
        rows = spark.createDataFrame([(None, "http://h/x", page)] * n, "page_id long, url string, html string")
        start = time.time()
        got = html_consensus.extract_pages(rows).collect()
        took.append(time.time() - start)
        assert len(got) == n and {r.text for r in got} == {" ".join(["text"] * 30)}
    assert took[1] < 6 * took[0] + 10
