"""Operators 1, 2, 5 and 10."""

import hashlib
import re
import time
from html import unescape

import pytest

from tests.conftest import SMALL
from tests.llm.helpers import documents, frame
from tests.oracle import connect, differences
from tidemark.llm import op01_content_regions as regions
from tidemark.llm import op02_quote_threads as threads
from tidemark.llm import op05_bloom_lookup as sketches
from tidemark.llm import op10_line_dedup as lines

PAGE = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div>
<nav>Home</nav><div class="wrap"><div class="post"><h2>Title &amp; more</h2>
<p>First paragraph of the article with a <a href=x>link</a> and  some more words in it to be long.
<p>Second one &lt;tag&gt; long text here to be counted as content in the page.</p><ul><li>item one</li><li>item two</li></ul>
<p>Short.</p><script>var x="<p>no</p>"</script><form><label>Search</label></form></div>
<div class="sidebar"><h3>Related</h3><p>Sidebar with a long text which is here to confuse the extraction.</p></div>
<div id="comments"><p>A reader's comment with many words, again quite long for a comment.</p></div></div>
<footer>Copyright</footer></body></html>"""


def test_regions_of_a_page():
    assert regions.main_text(PAGE) == [
        "Title & more",
        "First paragraph of the article with a link and some more words in it to be long.",
        "Second one <tag> long text here to be counted as content in the page.",
        "item one",
        "item two",
        "Short.",
    ]


@pytest.mark.parametrize(
    ("html", "text"),
    [(None, []), ("", []), ("plain", ["plain"]), ("<p>a<p>b", ["a", "b"]), ("<article><p>Cut<b cla", ["Cut"])],
)
def test_regions_of_odd_pages(html, text):
    assert regions.main_text(html) == text


LONG = "A long paragraph with many words in it, which goes on for quite a while and is the text of this page"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        # a reader's comment that is an article too
        (f"<main><article><p>{LONG}</p></article><article class='comment'><p>{LONG} no</p></article></main>", [LONG]),
        (f"<main><article class='comment'><p>{LONG} no</p></article><article><p>Short.</p></article></main>", ["Short."]),
        (f"<article><p>{LONG}</p><section id=comments><article><p>{LONG} no</p></article></section></article>", [LONG]),
        (f"<main><p>{LONG}</p><article class='related-post related'><p>{LONG}</p></article></main>", [LONG]),
        # marked, but nothing else holds the text
        (f"<main><article class='widget'><h1>T</h1><p>{LONG}</p></article></main>", ["T", LONG]),
        (f"<div class='content sidebar'><article><p>{LONG}</p></article></div>", [LONG]),
        (f"<form><p>Skip</p><div class=sidebar><p>{LONG}</p><p>{LONG}</p></div></form>", [LONG, LONG]),
        (f"<form><p>{LONG}</p><div class=comments><p>{LONG}</p><p>{LONG} no</p></div></form>", [LONG]),
        # several articles, and one of links only
        (f"<article><p>{LONG}</p></article><article><p>Short.</p></article>", [LONG, "Short."]),
        (f"<main><article><p>{LONG}</p></article><article><p><a>Next</a></p><p><a>Last</a></p></article></main>", [LONG]),
        # camel case
        (f"<body><div class='postComments'><p>{LONG} no</p></div><div><h1>T</h1><p>{LONG}</p></div></body>", ["T", LONG]),
        # a division for each paragraph
        (f"<div><h1>Title here</h1></div><div><p>{LONG}</p></div><div><p>Short end.</p></div>", ["Title here", LONG, "Short end."]),
        # divisions of links, within an article and beside a text without one
        (f"<article><p>{LONG}</p><div>See <a>one of the others</a> <a>and another</a></div><div>End.</div></article>", [LONG, "End."]),
        (f"<body><div><p>{LONG}</p><p>{LONG}</p><div>On: <a>this topic</a> <a>and that one</a></div></div></body>", [LONG, LONG]),
        # tables for layout
        (f"<table><tr><td><a>Home</a><td><p>{LONG}</p><p>{LONG}</p><p>End.</p></table>", [LONG, LONG, "End."]),
        # nothing but hidden text
        (f"<div hidden><p>{LONG}</p></div>", []),
    ],
)
def test_regions_by_marks_and_ratio(html, text):
    assert regions.main_text(html) == text


def test_regions_are_chosen_by_the_threshold(monkeypatch):
    links = "".join(f"<div><a href=x>Some topic {i}</a> and <b>more</b></div>" for i in range(6))
    html = f"<body><div>{links}</div><div>{f'<p>{LONG}</p>' * 6}<p>End.</p></div></body>"
    assert regions.main_text(html) == [LONG] * 6 + ["End."]
    monkeypatch.setattr(regions, "threshold", lambda values: float("-inf"))
    assert len(regions.main_text(html)) > 7


@pytest.mark.parametrize(
    "html",
    [
        "<div>x" * 50_000,
        "<div class=ad>x" * 50_000,
        "<div>x" * 25_000 + "</span>x" * 25_000,
        "<p><div>" + "<span>" * 25_000 + "<p>x</p>" * 25_000,
        "<article><b>x" * 25_000,
        "<div>x</section>" * 25_000,
    ],
)
def test_regions_of_deep_pages(html):
    start = time.perf_counter()
    regions.main_text(html)
    assert time.perf_counter() - start < 10


def test_regions_beside_other_columns(spark):
    rows = [(1, "u", f"<article>{LONG}</article>"), (1, "u", None), (None, None, ""), (3, "w", "a")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' as text", "1 as n_chars")
    got = sorted(map(tuple, regions.extract(df).collect()), key=str)
    assert got == [(1, "u", "", 0), (1, "u", LONG, len(LONG)), (3, "w", "a", 1), (None, None, "", 0)]
    assert regions.extract(df.limit(0)).count() == 0


def test_regions_query(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in regions.op1_content_regions(spark, SMALL).collect()}
    assert got.keys() == pages.keys()
    for i, html in pages.items():
        inner = html.split("<article>")[1].split("</article>")[0]
        parts = re.split(r"</?(?:p|h1)>", inner)
        plain = [re.sub(r"\s+", " ", unescape(re.sub(r"<br>", " ", re.sub("</?b>", "", p)))).strip() for p in parts]
        assert got[i]["text"] == "\n\n".join(p for p in plain if p)
        assert got[i]["n_chars"] == len(got[i]["text"])


def test_quotes_are_read_by_level():
    own, passages = threads.split_quotes("On Monday x wrote:\n> one\n>> two\n> > two b\n\nmine")
    assert own == "mine"
    assert passages == [(1, "one"), (2, "two\ntwo b")]
    assert threads.split_quotes(None) == ("", [])


def test_threads(spark):
    rows = [
        (1, 0, "a", "Hello all.\nHow does this work?\nSecond line."),
        (1, 1, "b", "On Monday x wrote:\n> How does this work?\n\nLike that."),
        (1, 2, "c", "Something else."),
        (1, 2, "c", "Something else."),
        (1, 3, "d", "> Like that.\n>> how  does this work?\nThanks."),
        (1, 4, "d", "> unknown\nok"),
        (1, 5, "e", "> Thanks.\nyes"),
        (2, 0, "a", None),
        (2, 1, "b", "Like that."),
        (None, 3, "z", "> Like that.\nx"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as rank")
    got = [
        (r["conv_id"], r["position"], r["turn"], r["text"], r["n_quotes"], r["n_linked"], r["reply_to"], r["depth"])
        for r in threads.reply_ordered(df).orderBy("conv_id", "position").collect()
    ]
    assert got == [
        (None, 0, 3, "x", 1, 0, None, 0),
        (1, 0, 0, "Hello all.\nHow does this work?\nSecond line.", 0, 0, None, 0),
        (1, 1, 1, "Like that.", 1, 1, 0, 1),
        (1, 2, 3, "Thanks.", 2, 2, 1, 2),
        (1, 3, 5, "yes", 1, 1, 3, 3),
        (1, 4, 2, "Something else.", 0, 0, None, 0),
        (1, 5, 2, "Something else.", 0, 0, None, 0),
        (1, 6, 4, "ok", 1, 0, None, 0),
        (2, 0, 0, "", 0, 0, None, 0),
        (2, 1, 1, "Like that.", 0, 0, None, 0),
    ]
    assert threads.reply_ordered(df.limit(0)).count() == 0


def test_threads_query(spark):
    got = threads.op2_quote_threads(spark, SMALL).collect()
    assert len(got) == spark.read.parquet(f"{SMALL}/conversations.parquet").count()
    places = {}
    for r in got:
        places.setdefault(r["conv_id"], []).append(r["position"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def edited(own, next_):
    k = len(own) // 2
    return own[: len(own) - k] + next_[:k]


def test_fingerprints_query(spark):
    texts = documents(spark)
    got = {r["doc_id"]: r for r in sketches.fingerprints(sketches.table(spark, SMALL, "documents")).collect()}
    order = sorted(texts, reverse=True)
    prints = {}
    for i, j in zip(order, order[1:] + order[:1], strict=True):
        r = got[i]
        assert r["n_chars"] == len(texts[i])
        assert r["edited_sha256"] == hashlib.sha256(edited(texts[i], texts[j]).encode()).hexdigest()
        a, e, n = (set(r[c]) for c in ("digests", "edited_digests", "next_digests"))
        assert (sorted(r["edited_changes"]), sorted(r["next_changes"])) == (sorted(a ^ e), sorted(a ^ n))
        assert prints.setdefault(texts[i], r["fingerprint"]) == r["fingerprint"]
    assert sum(r["near_edited"] > r["near_next"] for r in got.values()) >= 0.9 * len(got)


def test_fingerprint_edges(spark):
    long_ = " ".join(f"Sentence number {i} says something about {i * i}." for i in range(3000))
    rows = [(5, long_), (4, None), (4, None), (3, ""), (None, "x y"), (1, "Short. Text."), (1, "Other text.")]
    got = sketches.fingerprints(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert [r["near_next"] for r in by_id[4]] == [1.0, 1.0]
    assert by_id[5][0]["edited_sha256"] == hashlib.sha256(long_[: len(long_) - len(long_) // 2].encode()).hexdigest()
    one = sketches.fingerprints(frame(spark, [(1, "abcd")])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    assert sketches.fingerprints(frame(spark, rows[:0])).count() == 0


def test_paragraphs_end_at_64_characters(spark):
    first, second = "a" * 69 + ".", "b" * 69 + "."
    got = sketches.fingerprints(frame(spark, [(1, f"{first} {second}")])).first()
    assert len(got["digests"]) == 2


def test_fingerprints_alone_give_large_differences(spark):
    same = [f"Line {i} is in both." for i in range(40)]
    rows = [(2, "\n".join([*same, *(f"Own {i}" for i in range(16))])), (1, "\n".join([*same, *(f"Other {i}" for i in range(18))]))]
    got = {r["doc_id"]: r for r in sketches.fingerprints(frame(spark, rows)).collect()}
    a, b = ([int(p[k : k + 16], 16) for k in range(8, len(p), 16)] for p in (got[2]["fingerprint"], got[1]["fingerprint"]))
    width = 3 * sketches.THIRD
    assert len(a) == len(b) > 12
    apart = [x ^ y for x, y in zip(a, b, strict=True)]
    want = {x % 2**64 for x in set(got[2]["digests"]) ^ set(got[1]["digests"])}
    tables, peeled = len(a) // width, 0
    for t in range(tables):  # a digest's first bits name its table, in the order of signed numbers
        cells, own = apart[t * width : (t + 1) * width], {x for x in want if (x ^ 2**63) * tables >> 64 == t}
        while pure := {c for c in cells if c in own}:
            for x in pure:
                own.remove(x)
                peeled += 1
                for j in range(3):
                    cells[j * sketches.THIRD + (x >> 24 + 8 * j & sketches.THIRD - 1)] ^= x
        assert not own or any(cells)
    assert len(want) == 34 and peeled > 25
    assert set(got[2]["next_changes"]) == set(got[2]["digests"]) ^ set(got[2]["next_digests"])


def test_fingerprints_of_many_lines(spark):
    many = [f"Line {i}" for i in range(50_000)]
    rows = [(3, "\n".join(many)), (2, "\n".join(many[:49_000] + ["New"])), (1, "\n".join(many[:3_000]))]
    start = time.perf_counter()
    got = {r["doc_id"]: r for r in sketches.fingerprints(frame(spark, rows)).collect()}
    assert time.perf_counter() - start < 60
    assert [len(got[i]["digests"]) for i in (3, 2, 1)] == [50_000, 49_001, 3_000]
    assert len(set(got[3]["next_changes"])) == len(got[3]["next_changes"]) == 1_001
    for r in got.values():
        a, e, n = (set(r[c]) for c in ("digests", "edited_digests", "next_digests"))
        assert (set(r["edited_changes"]), set(r["next_changes"])) == (a ^ e, a ^ n)


def test_lines_query_matches_sql(spark):
    assert differences(lines.op10_line_dedup(spark, SMALL), connect(SMALL), lines.ORACLE_SQL) == []


def test_line_edges(spark):
    rows = [(i, f" The LINE\x0b\nown {i}\n\nthe line") for i in range(10)]
    rows += [(10, None), (11, ""), (None, "the line\nÉ"), (0, " The LINE\x0b\nown 0\n\nthe line"), (12, "a\n" * 200 + "the line")]
    got = lines.dedup_lines(frame(spark, rows))
    assert got.columns.count("n_lines") == 1
    found = sorted((str(r["doc_id"]), r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect())
    want = [(str(i), f"own {i}\n", 4, 2) for i in range(10)] + [("0", "own 0\n", 4, 2), ("10", "", 1, 0), ("11", "", 1, 0)]
    want += [("None", "É", 2, 1), ("12", "\n".join(["a"] * 200), 201, 1)]
    assert found == sorted(want)
    first = lines.dedup_lines(frame(spark, rows[1:10] + rows[10:12]), min_documents=2, keep_first=True).collect()
    assert sum("the line" in r["text"].lower() for r in first) == 1
    assert lines.dedup_lines(frame(spark, rows[:0])).count() == 0


def test_wrappers_around_the_content_are_kept():
    words = "This is a plain sentence of the article that says something at length, and then some more of it."
    body = "".join(f"<p>{words} {i}</p>" for i in range(5))
    want = regions.main_text(f"<body><div><article>{body}</article></div></body>")
    assert words in str(want)
    for mark in (
        "class='content has-sidebar'", "class='no-sidebar'", "class='with-comments'", "class='single-related'",
        "id='page-header-fixed'",
    ):
        assert regions.main_text(f"<body><div {mark}><article>{body}</article></div></body>") == want
        assert words in str(regions.main_text(f"<body><div {mark}>{body}</div></body>"))
    assert words in str(regions.main_text(f"<body><form>{body}<nav>Home and more</nav></form></body>"))
    beside = "<div class='ad-container'><p>Buy this now, it is good, it is cheap.</p></div>"
    assert "Buy" not in str(regions.main_text(f"<body><form><article>{body}</article>{beside}</form></body>"))


def test_unit_hashes_use_all_their_bits():
    hashes = [threads._hash(f"line {i:06}") for i in range(1000)]
    # What two checksums of one text differ by depends on its length alone; no two halves may be bound like that.
    assert len({(h >> 31 ^ h) & 0x7FFFFFFF for h in hashes}) > 990


def test_copies_are_numbered_without_a_window_per_key(spark):
    keyed = spark.range(0, 1000, 1, 8).selectExpr("if(id < 700, 1, id) as k1", "if(id < 700, 2, id) as k2")
    got = threads._copies(keyed, ["k1", "k2"])
    rows = got.collect()
    assert sorted(r["copy"] for r in rows if r["k1"] == 1) == list(range(700))
    assert all(r["copy"] == 0 for r in rows if r["k1"] != 1)
    assert "row_number" not in got._jdf.queryExecution().toString()
