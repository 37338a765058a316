"""Main text, importance resampling and collocations against plain versions."""

import hashlib
import html
import math
import random
import re
import time
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD, ODD_IDS, SENTENCE, alnum_words, documents, lower
from hypothesis import given, settings
from hypothesis import strategies as st

from glyphlex.llm import collocations as co
from glyphlex.llm import importance, main_text

MENU = "<nav><ul><li><a href=a>Home</a><li><a href=b>News, weather, sport and more</a></ul></nav>"
STORY = ("<h1>A headline</h1><p>One, two, three &amp; <b>four</b>, with <a href=x>a link</a> inside.\n"
         "<p>Second  paragraph<br>of&nbsp;text.</p>")
TEXT = "A headline\n\nOne, two, three & four, with a link inside.\n\nSecond paragraph of text."


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title></head><body>{MENU}<article>{STORY}</article><footer>&copy; x, y, z</footer>",
    f"<body>{MENU}<div class='layout with-sidebar'><div id=story>{STORY}</div>"
    "<div class='sidebar'><p>Some text, beside, with, many, commas, here.</p></div></div>",
    f"<main><section>{STORY}</section></main><div id=comments><article><p>I, say, something, long, too.</article></div>",
    f"<article><header>{STORY}</header><aside><p>a, b, c, d, e, f, g</p></aside>"
    "<form><p>Your, mail, please</p><input><textarea>x, y</textarea></form></article>",
    f"<div class=cookie-notice><p>We, use, cookies, you, know, it.</p></div><div class=adBox>Buy</div><div>{STORY}</div>",
    f"<form id=page><article>{STORY}</article></form>",
    f"<article><script>if (a < b) document.write('<p>x</p>')</script><!-- <p>no --><style>p > a {{}}</style>{STORY}"
    "<div hidden>no</div><p style='display: none'>no</p></article>",
    f"<article class=post>{STORY}<ul><li><a>one</a><li><a>two</a><li><a>three</a></ul></article>",
])
def test_main_text(page):
    assert main_text.main_text(page) == TEXT


def test_odd_pages():
    assert main_text.main_text(None) == main_text.main_text("") == main_text.main_text(MENU) == ""
    assert main_text.main_text("no markup, 1 < 2 &amp; &lt;b&gt; &eacute;") == "no markup, 1 < 2 & <b> é"
    assert main_text.main_text("<p>a<p>b</div></p></b><p>c<") == "a\n\nb\n\nc<"
    assert main_text.main_text("<p>a<br><br>b<hr>c<table><tr><td>d<td>e</table>") == "a\n\nb\n\nc\n\nd\n\ne"
    assert main_text.main_text("<p>cut off <b attr='x") == "cut off"
    assert main_text.main_text("<script>never ends <p>x") == ""


def test_sections_of_one_article_stay_together():
    part = "<section><h2>Part</h2><p>{}</p></section>"
    page = "<div>" + "".join(part.format("text, " * n + "end.") for n in (3, 30, 10, 1)) + "</div>"
    got = main_text.main_text(MENU + page)
    assert got.count("Part") == 4 and got.count("end.") == 4


def test_hostile_pages_take_linear_time():
    for page in ("<div>" * 20000 + "x", "<p><b>x <i>" * 10000, "<a x=\"<a x='" * 20000, "<!--" * 50000,
                 "<span>a" * 20000 + "</p></div>" * 20000, "<" * 100000, "&amp" * 50000):
        began = time.time()
        main_text.main_text(page)
        assert time.time() - began < 5


def test_extract_pages(spark):
    pages = [None, "", "<p>a</p>", MENU + STORY, "<p>a</p>", "<p>" + "long, " * 200000]
    rows = spark.createDataFrame([(k, "u", p, "t", 5) for k, p in enumerate(pages)],
                                 "page_id long, url string, html string, text string, n_chars int")
    got = {r._row.page_id: r for r in main_text.extract(rows).collect()}
    assert [got[k].text for k in range(5)] == ["", "", "a", TEXT, "a"]
    assert got[5].n_chars == len(got[5].text) == 1200000 - 1
    assert all(r.n_chars == len(r.text) and r._row.text == "t" and r._row.n_chars == 5 for r in got.values())
    assert main_text.extract(rows.limit(0)).count() == 0


def plain_resample(docs, target, n, percent, least):
    """{row: (n_words, n_features, weight, score)} and the drawn rows in order."""
    def feats(t):
        w = alnum_words(t)
        return w, [" ".join(w[i:i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]

    def bucket(f):
        return crc32(f.encode()) % 10000
    own = [feats(t) for _, t in docs]
    s = Counter(bucket(f) for _, fs in own for f in fs)
    t = Counter(bucket(f) for x in target for f in feats(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for (i, _), (w, fs) in zip(docs, own):
        g = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000))))
             for b in map(bucket, fs)]
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(g) // len(g) if g else 0
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((len(w), len(fs), weight, score))
    fit = [k for k in range(len(docs)) if out[k][0] >= least]
    fit.sort(key=lambda k: (-out[k][3], docs[k][0] is None, docs[k][0] or 0))
    return out, fit[:len(fit) * percent // 100]


@pytest.mark.parametrize("n,percent,least", [(1, 10, 20), (3, 50, 1), (2, 100, 0)])
def test_resample(spark, n, percent, least):
    texts = ODD + [f"{SENTENCE} number {k} of {k % 7}" for k in range(60)]
    ids = ODD_IDS + list(range(100, 160))
    target = [SENTENCE, "seven wizards", None, "", "É é ß"]
    want, drawn = plain_resample(list(zip(ids, texts)), target, n, percent, least)
    got = importance.resample(
        documents(spark, texts, ids), spark.createDataFrame([(t,) for t in target], "text string"),
        percent=percent, least_words=least, n=n).collect()
    assert Counter((r._row.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got) == Counter(
        (i, *w) for i, w in zip(ids, want))
    ranked = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r._row.doc_id, r.score) for r in ranked] == [(ids[k], want[k][3]) for k in drawn]


def test_resample_without_rows(spark):
    docs, none = documents(spark, ODD, ODD_IDS), spark.createDataFrame([], "text string")
    assert importance.resample(docs.limit(0), none).count() == 0
    rows = importance.resample(docs, none, percent=0).collect()
    assert len(rows) == len(ODD) and not any(r["rank"] for r in rows)


def test_one_row_that_is_most_of_the_table(spark):
    ids = [7] * 400 + list(range(1000, 1100))
    rows = importance.resample(documents(spark, [SENTENCE] * 500, ids), spark.createDataFrame(
        [(SENTENCE,)], "text string"), percent=30, least_words=3).where("rank is not null").collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, 151))


def test_words_in_pieces():
    raw = (" ".join(f"Wörd{k}" for k in range(5000)) + " " + "y" * 3000).encode()
    for size in (7, 64, 1000, 1 << 20):
        assert [w for p in importance.pieces(raw, size) for w in p] == raw.translate(importance.WORD_BYTES).split()


def plain_collocations(rows, most=3, least=10, within=50, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        c = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            c.update(tuple(w[i:i + k]) for k in range(1, most + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= within * a and
                   any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in found.items()):
                continue
            score, _, left, right = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]])
                                        for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for k, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, k, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def phrase_rows(k):
    r = random.Random(k)
    words = ["a", "B", "b", "ç", "中文", "x\x0by", "don't", "\x85", "ÉÉ"]
    texts = [None, "", " \t", ".;:", "a " * 50, "x" * 4000]
    for _ in range(120):
        texts.append("".join(r.choice(words) + r.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "?"])
                             for _ in range(r.randint(0, 60))))
    return [(r.choice(["en", "en", "de", None, "und", ""]), t) for t in texts]


@pytest.mark.parametrize("most,least,within,top", [(3, 10, 50, 2000), (4, 3, 80, 7), (2, 2, 50, 2000)])
def test_collocations(spark, most, least, within, top):
    rows = phrase_rows(most)
    docs = spark.createDataFrame([(k, lang, t, 1, "w") for k, (lang, t) in enumerate(rows)],
                                 "doc_id long, lang string, text string, n int, w1 string").repartition(4)
    got = co.collocations(docs, most, least, within, top).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, most, least, within, top)
    assert co.collocations(docs.limit(0)).count() == 0


def test_exact_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    a, left, right = 4 * 10 ** 12 + 7, 5 * 10 ** 12 + 1, 6 * 10 ** 12 + 3
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(
        co.cut_score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first()
    assert row.s == 1000000 * a * a // (left * right)


def test_words_that_clash_take_another_seed(spark, monkeypatch):
    plain = co._count_words

    def clashing(batches, seed):
        for b in plain(batches, seed):
            ids = [7 if seed == 0 and w in ("a", "b") else i
                   for w, i in zip(b["word"].to_pylist(), b["id"].to_pylist())]
            yield b.set_column(2, "id", pa.array(ids, pa.int64()))
    monkeypatch.setattr(co, "_count_words", clashing)
    words, seed = co.word_table(spark.createDataFrame([("en", "a c. b c. " * 12)], "lang string, text string"))
    assert seed == 1 and words.count() == 3


@pytest.mark.parametrize("length", [2, 3])
def test_tasks_pass_filters_on_in_parts(length, monkeypatch):
    monkeypatch.setattr(co, "PHRASES_HELD", 100)
    monkeypatch.setattr(co, "BLOCK_BYTES", 300)
    rows = phrase_rows(length)
    batches = [pa.RecordBatch.from_arrays(
        [pa.array([x or "und" for x, _ in rows[k:k + 9]]), pa.array([t for _, t in rows[k:k + 9]], pa.string())],
        ["lang", "text"]) for k in range(0, len(rows), 9)]
    every = np.full(1 << 10, 2 ** 64 - 1, np.uint64)
    parts = [r for b in co._count_phrases(iter(batches), 3, length, every, 5, 16) for r in b.to_pylist()]
    assert len({r["part"] for r in parts}) == 32 and len(parts) > 64
    f = co.QuotientFilter.merged([co.QuotientFilter.from_piece(*r.values(), length, 5, 16) for r in parts])
    want = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = co.word_ids([x.encode() for x in re.findall(r"[^\x20\x09]+", piece)], lang or "und", 3)
            want.update(tuple(w[i:i + length]) for i in range(len(w) - length + 1))
    assert dict(zip(zip(*[k.tolist() for k in co.restore(f.keys)]), f.counts.tolist())) == want


numbers = st.integers(0, 2 ** 64 - 1)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 4).flatmap(lambda m: st.lists(st.tuples(*[numbers] * m), min_size=1, max_size=40)),
       st.lists(st.integers(1, 10 ** 6), min_size=40, max_size=40), st.integers(1, 9))
def test_quotient_filter(rows, counts, range_bits):
    rows, length = rows + rows[:3], len(rows[0])
    counts = np.array((counts + counts)[:len(rows)], np.int64)
    keys = [np.array([r[j] for r in rows], np.uint64) for j in range(length)]
    back = co.restore(co.permute(keys))
    assert all((a == b).all() for a, b in zip(back, keys))
    f = co.QuotientFilter(co.permute(keys), counts)
    want = Counter()
    for r, n in zip(rows, counts.tolist()):
        want[r] += n
    parts = [co.QuotientFilter.from_piece(*p, length, range_bits, 16) for p in f.pieces(range_bits, 16)]
    got = co.QuotientFilter.merged(parts[::-1])
    assert dict(zip(zip(*[k.tolist() for k in co.restore(got.keys)]), got.counts.tolist())) == want


def test_blocks_keep_pieces_whole():
    text = "one two three. four five, six seven eight nine. " * 50
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de", "en"]), pa.array([text, None, text])], ["lang", "text"])
    old, co.BLOCK_BYTES = co.BLOCK_BYTES, 30
    try:
        got = [b for _, b in co.blocks(batch)]
    finally:
        co.BLOCK_BYTES = old
    words = Counter(p for b in got for p in (" ".join(x.split()) for x in b.decode().split("\n")) if p)
    assert words == Counter({"one two three": 100, "four five": 100, "six seven eight nine": 100})


def test_plain_html_agrees_on_given_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    for r in rows:
        own = re.search(r"(?s)<article>(.*?)(</article>|\Z)", r.html)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", own)]
        assert main_text.main_text(r.html) == "\n\n".join(p for p in parts if p)
