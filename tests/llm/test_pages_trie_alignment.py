"""Main text of pages, the conversation trie and token alignment beside brute force and SQL."""

from __future__ import annotations

import hashlib
import random
import time
import tracemalloc
import zlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from check_queries import compare, connect
from wayfare.llm import alignment, html_text, prefix_trie, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", ["op11_html", "op12_prefix_trie"])
def test_beside_sql(spark, duck, name):
    assert compare(queries.QUERIES[name](spark, SF).toPandas(), duck.execute(queries.ORACLES[name]).df()) == "ok"


# 11: html

PAGE = """<!DOCTYPE html><html><head><title>Tab title</title><style>p{}</style></head><body>
<header><a href="/">Site</a><h1>Name of the site</h1></header><nav><ul><li><a href="a">Home</a><li><a>About</a></ul></nav>
<div class="cookie-notice">We use cookies, accept all of them now please.</div><main><article>
<header><h1>Title &amp; more</h1><p class="byline">By a writer</p></header>
<p>First   paragraph
 with <b>bold</b> and <span class="ad">Buy <span>it</span> now!</span>words<br>next &lt;tag&gt; &#233;.</p><p>Ti.</p>
<ul><li>One<li>Two</ul><aside>Beside</aside><script>var a = "<p>x</p>";</script><form><input><label>Mail</label></form>
<div class="share-buttons">Share this</div><blockquote>A quote<p>in two blocks</blockquote>
<section id="comments"><article class="comment"><p>What a great article, thank you very much for all of this.</p></article></section>
</article></main><aside class="sidebar">Popular</aside><footer>&copy; 2020 nobody</footer></body></html>"""


def test_article_without_its_surroundings():
    want = ["Title & more", "First paragraph with bold and words next <tag> é.", "Ti.", "One", "Two", "A quote", "in two blocks"]
    assert html_text.text_of_page(PAGE) == "\n".join(want)


def test_region_without_an_article():
    page = """<div id="page"><div class="header">Logo</div><div class="menu"><a>a</a><a>b</a></div><div class="content"><h2>Headline</h2>
    <p>A long paragraph of prose that says many things about things in general and at length.</p><p>Short.</p>
    <p>Another long paragraph of prose that says many things about things in general.</p></div>
    <div class="sidebar">Popular posts and other things that are long enough to be counted as text</div>
    <div><a>First link</a> <a>Second link</a> <a>Third link</a></div><div class="comments"><p>Nice one, really a great article I think.</p></div>
    <div id="footer">Copyright</div>"""
    found = html_text.text_of_page(page).split("\n")
    assert found[0] == "Headline" and found[2] == "Short." and len(found) == 4


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<article></article>", ""),
        ("<nav>only a menu</nav>", ""),
        ("plain text &amp more", "plain text & more"),
        ("<p>one<p>two", "one\ntwo"),
        ("<nav><ul><li><a>Home</a><article><h1>T</h1><p>a b</article><div class=ad>buy</div>", "T\na b"),
        ("<form><div class='page-with-sidebar'><article><p>a</p></article></div></form>", "a"),
        ("<article><p>a</p><!-- never ends <p>b</p>", "a"),
        ("<article><p>a</p><p>b <a href='x", "a\nb"),
        ("<article><p>a < b &amp;amp; c</p></article>", "a < b &amp; c"),
        ("<script>x", ""),
    ],
)
def test_odd_pages(page, text):
    assert html_text.text_of_page(page) == text


def test_smoothing_and_ties():
    ratios = np.zeros(9)
    ratios[4] = 1.0
    found = html_text.smoothed(ratios)
    assert found.argmax() == 4 and np.allclose(found, found[::-1]) and found.sum() == pytest.approx(1.0)
    # Of two articles of the same weight the first is the region.
    assert html_text.text_of_page("<article><p>same size</p></article><article><p>also size</p></article>") == "same size"


def test_time_grows_with_the_page_not_its_square():
    start = time.time()
    for part in ("<div>", "<p>a</p></section>", "<!--", "<a b=", "<![CDATA[", '<a b="', "</", "&amp", "<script>"):
        html_text.text_of_page(part * 20_000 + "<p>end</p>")
    assert time.time() - start < 30


def test_extract_edges(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, "<p>no id</p>"), (2, None, None), (3, "v", ""), (4, "w", "<article>" + "<p>word " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("text", "n_chars", "tag"):
        pages = pages.withColumn(name, F.lit("clash"))
    found = html_text.extract(pages).collect()
    assert Counter(r["page_id"] for r in found) == Counter([1, 1, None, 2, 3, 4])
    by = {r["page_id"]: r for r in found}
    assert by[4]["n_chars"] == 50_000 * 5 - 1 and by[2]["text"] == by[3]["text"] == "" and by[None]["text"] == "no id"
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert html_text.extract(pages.where("false")).count() == 0


# 12: prefix trie


def trie_by_hand(rows):
    """{(conv_id, depth): the other columns} of the rebuilt conversations."""
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [turn[2:] for turn in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        whole[c] = own.get(base, [])[:h] + turns[h:]
    members, ends = {}, {}
    for c in sorted(whole):
        for depth in range(len(whole[c]) + 1):
            members.setdefault(tuple(whole[c][:depth]), []).append(c)
        ends.setdefault(tuple(whole[c]), []).append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, own_members in members.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not children[node]
            saved[node[:depth]] += (len(own_members) - 1) * len(node[-1][1]) if node else 0
    digest = lambda node: hashlib.sha256(",".join(map(str, ends.get(node, []))).encode()).hexdigest()
    return {
        (own_members[0], len(node)): (members[node[:-1]][0] if node else None, len(own_members), children[node], leaves[node], saved[node], digest(node))
        for node, own_members in members.items()
    }


def found_trie(frame, height=prefix_trie.HEIGHT):
    rows = prefix_trie.share(frame, height).collect()
    found = {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("height", [2, 3, 32])
def test_trie_beside_brute_force(spark, height):
    draw = random.Random(height)
    rows = [
        (c, turn, draw.choice(["user", "assistant", None]), draw.choice(["a", "bé", "ccc", None, ""]))
        for c in [*range(95, 260), -5, -200, 1000, 1001]
        for turn in range(draw.choice([0, 1, 2, 5, 9, 14]))
    ]
    # A long conversation, copies of one, ties and nulls in turn, repeated rows, rows without an id.
    rows += [(300, turn, "user", f"t{turn}") for turn in range(60)] + [(c, turn, "user", f"t{turn}") for c in range(301, 340) for turn in range(12)]
    rows += [(400, None, "b", "x"), (400, None, "a", "y"), (400, 3, "c", "z"), (400, 3, "c", "z"), (400, 3, "c", "aa"), (None, 1, "user", "lost")]
    draw.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("depth", "one", "n", "chars", "at"):
        frame = frame.withColumn(name, F.lit("clash"))
    assert found_trie(frame, height) == trie_by_hand(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert found_trie(spark.createDataFrame([], schema)) == {}
    assert found_trie(spark.createDataFrame([(None, 1, "a", "b")], schema)) == {}
    # 101 leaves out its first turns and its hundred has none to offer.
    alone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(alone, 0, "user", "x" * 100_000)]
    assert found_trie(spark.createDataFrame(rows, schema)) == trie_by_hand(rows)


def test_band_without_values_of_its_own(spark):
    """A lone path longer than a band adds nothing to the band's top; its leaf counts above all the same."""
    rows = [(600, turn, "user", f"t{turn}") for turn in range(100)] + [(c, turn, "user", f"t{turn}") for c in (607, 608) for turn in range(7)]
    found = found_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert found == trie_by_hand(rows) and found[(600, 0)][3] == 1


def test_runs_of_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 4)
    monkeypatch.setattr(prefix_trie, "JOINED", 3)
    rows = [(c, turn, "user", str(turn)) for c in range(500, 530) for turn in range(30)]
    assert found_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), 4) == trie_by_hand(rows)


# 13: alignment

ODD = [
    "a▁b  c", "x \n  y", "  two", "\n\n a  \t b", "end ", " ", "日本語のテキスト　です 和", "<s> <|endoftext|> </s>", "é ﬁ Å",
    "\x00a \x1f b", "a b​ c", " nb\xa0sp ", "x" * 5000, " " * 5000, "👩‍👩‍👧 ok", "a\r\n b\x85 c   d", "\x1c \x1d x \x0b y", "﻿ bom",
]


def aligned_by_hand(rows):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    alphabet = {chr(byte): byte for byte in shown} | {chr(256 + at): byte for at, byte in enumerate(hidden)}

    def second_bytes(at):
        piece = second.id_to_piece(at)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(at) else piece.replace("▁", " ").encode()

    docs, counts = [], Counter()
    for doc_id, text in rows:
        ids, groups = ([], []), []
        if text:
            ids = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
            parts = [bytes(alphabet[c] for c in first.id_to_token(at)) for at in ids[0]], [second_bytes(at) for at in ids[1]]
            if any(b"".join(part) != (" " + text).encode() for part in parts):
                ids = ([], [])
            else:
                ends = [np.cumsum([len(each) for each in part]).tolist() for part in parts]
                i = j = 0
                for end in sorted(set(ends[0]) & set(ends[1])):
                    to, till = bisect_left(ends[0], end) + 1, bisect_left(ends[1], end) + 1
                    groups.append((ids[0][i:to], ids[1][j:till]))
                    i, j = to, till
        docs.append((doc_id, *ids, groups))
        counts.update({(a, b) for left, right in groups for a in left for b in right})
    best = Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for doc_id, a_ids, b_ids, groups in docs:
        links = [(a, b) for left, right in groups for a in left for b in right]
        text = ";".join(f"{','.join(map(str, left))}|{','.join(map(str, right))}" for left, right in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a_ids else ""
        out.append((doc_id, len(a_ids), len(b_ids), len(groups), len(links), sum(counts[link] == best[link[0]] for link in links), sum(counts[link] for link in links), digest))
    return sorted(out, key=str)


def test_alignment_beside_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.QUERIES["op13_alignment"](spark, SF).drop("n_overlaps").collect()
    assert sorted(map(tuple, found), key=str) == aligned_by_hand(rows)


@pytest.mark.parametrize("chunk_bytes", [100, alignment.CHUNK_BYTES])
def test_alignment_of_odd_texts(spark, chunk_bytes):
    rows = list(enumerate(ODD)) + [(None, None), (None, ""), (100, "twice"), (100, "twice"), (101, None), (102, "word " * 40_000 + "End.")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("chunk", "count", "place", "n_a", "codes"):
        frame = frame.withColumn(name, F.lit("clash"))
    found = alignment.align(frame, *alignment.vocabularies(), chunk_bytes=chunk_bytes).drop("n_overlaps").collect()
    assert sorted(map(tuple, found), key=str) == aligned_by_hand(rows)
    assert alignment.align(frame.where("false"), *alignment.vocabularies()).count() == 0


def test_alignment_of_a_chunk_holds_few_units_at_once():
    draw = np.random.default_rng(5)
    texts = [" ".join(f"w{at}" for at in draw.integers(0, 3000, 200)) for _ in range(2000)]
    units = alignment.Units(*alignment.vocabularies())
    first = alignment._chunk_row(units, list(range(2000)), texts)
    tracemalloc.start()
    again = alignment._chunk_row(units, list(range(2000)), texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [list(again[name]) for name in ("codes", "docs", "n_links")] == [list(first[name]) for name in ("codes", "docs", "n_links")]
    # 400,000 units: a few numbers for each, never rows of counts or all strings and pairs at once.
    assert peak < 100 * 400_000


def test_gallop_and_overlaps():
    draw = np.random.default_rng(3)
    for _ in range(50):
        sizes, others = draw.integers(0, 6, 20), draw.integers(0, 6, 20)
        others[sizes == 0] = 0
        sizes[others == 0] = 0
        first, second = [], []
        base = 0
        for n, m in zip(sizes, others):
            if n:
                first += sorted(draw.choice(np.arange(1, 9), n - 1, replace=False) + base) + [base + 9]
                second += sorted(draw.choice(np.arange(1, 9), m - 1, replace=False) + base) + [base + 9]
                base += 9
        first, second = np.array(first, np.int64), np.array(second, np.int64)
        a, b, overlaps = alignment.common_ends(first, sizes, second, others)
        assert set(first[a]) == set(second[b]) == set(first) & set(second)
        starts = [np.concatenate([[0], each[:-1]]).astype(int) for each in (first, second)]
        units = np.repeat(np.arange(20), sizes)
        want = Counter()
        for i in range(len(first)):
            want[units[i]] += sum(1 for j in range(len(second)) if starts[1][j] < first[i] and starts[0][i] < second[j])
        assert {u: n for u, n in enumerate(overlaps) if n} == dict(want)
