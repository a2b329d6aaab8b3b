"""Decontamination, winnowing, licences and HTML against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import product

import numpy as np
import pytest

from pageloom.llm import decontamination as dec
from pageloom.llm import html_text, licenses, winnowing
from pageloom.llm.text import alnum_words, space_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_az(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_words(text):
    return WORD.findall(lower_az(text))


@pytest.mark.parametrize("text", ["", None, "Ab-ÇÉ ñ9\x00z\x7fq", "  A\tB\x0bC\x1cD\xa0E ", "日本 GO"])
def test_words(text):
    assert [w.decode() for w in alnum_words(text)] == plain_words(text)
    assert [w.decode() for w in space_words(text)] == re.findall(r"[^\x20\x09-\x0D]+", lower_az(text))


# --- decontamination -----------------------------------------------------------


def plain_hits(text, items, size=13):
    words = plain_words(text)
    hit, ids = set(), set()
    for item, other in items:
        own = plain_words(other)
        m = min(size, len(own))
        for i in range(len(own) - m + 1 if own else 0):
            for j in range(len(words) - m + 1):
                if words[j : j + m] == own[i : i + m]:
                    hit.update(range(j, j + m))
                    ids.add(str(item))
    return len(words), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(words)


def random_corpus(seed, letters="abc"):
    rnd = random.Random(seed)
    items = [(i, " ".join(rnd.choices(letters, k=rnd.choice([1, 2, 5, 13, 14, 30])))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "--"), (3, items[3][1])]
    texts = [" ".join(rnd.choices(letters + "XYZ", k=rnd.choice([0, 1, 12, 13, 40, 200]))) for _ in range(25)]
    return [*texts, None, "", items[5][1].upper(), "q " * 300 + items[11][1]], items


def test_wu_manber_finds_every_occurrence():
    for seed, m in product(range(20), (1, 2, 3, 5)):
        rnd = random.Random(seed)
        patterns = {tuple(rnd.choices([b"a", b"b", b"c"], k=m)) for _ in range(4)}
        words = rnd.choices([b"a", b"b", b"c", b"d"], k=200)
        got = set(dec.WuManber(patterns, m).find(words))
        assert got == {(i, p) for i in range(200) for p in patterns if tuple(words[i : i + m]) == p}


@pytest.mark.parametrize("block_bytes", [8_000_000, 60])
def test_decontamination(spark, block_bytes):
    texts, items = random_corpus(1)
    rows = [(i, t, "x", 0) for i, t in enumerate(texts)] + [(0, texts[0], "x", 0), (None, texts[1], "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, items string, n_words long")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, piece int")
    got = dec.decontaminate(docs, bench, block_bytes=block_bytes)
    assert got.columns == [*docs.columns, "hits"]
    found = [(r["doc_id"], r["hits"]) for r in got.collect()]
    assert len(found) == len(rows)
    by_id = {i: t for i, t, *_ in rows}
    for i, h in found:
        expected = plain_hits(by_id[i], items)
        assert (h["n_words"], h["n_hit"], h["items"], h["contaminated"]) == expected


def test_nothing_to_search(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dec.decontaminate(docs, bench).first()["hits"]["contaminated"] is False
    assert dec.decontaminate(docs.limit(0), bench).count() == 0


# --- winnowing -----------------------------------------------------------------


def plain_winnow(text, k, window):
    codes = np.array([ord(c) for c in text or ""], np.uint32)
    if not len(codes):
        return []
    k = min(k, len(codes))
    runs = [int(winnowing._runs(codes[i : i + k], k)[0] >> np.uint64(24)) for i in range(len(codes) - k + 1)]
    window = min(window, len(runs))
    kept = []
    for i in range(len(runs) - window + 1):
        part = runs[i : i + window]
        at = i + max(j for j, h in enumerate(part) if h == min(part))
        if not kept or kept[-1][1] != at:
            kept.append((runs[at], at))
    return kept


@pytest.mark.parametrize("part", [1 << 23, 5])
def test_winnowing_keeps_the_rightmost_minimum(monkeypatch, part):
    monkeypatch.setattr(winnowing, "PART", part)
    rnd = random.Random(4)
    for n, (k, w) in product([0, 1, 3, 4, 9, 60, 200], [(3, 4), (5, 1), (1, 6), (12, 16)]):
        text = "".join(rnd.choices("ab\U0001f600é", k=n))
        h, p = winnowing.winnow(text, k, w)
        assert list(zip(h.tolist(), p.tolist(), strict=True)) == plain_winnow(text, k, w)


def test_a_shared_run_is_always_seen():
    rnd = random.Random(5)
    for _ in range(50):
        shared = "".join(rnd.choices("abcdefgh", k=27))
        a, b = ("".join(rnd.choices("abcdefgh", k=80)) + shared + "".join(rnd.choices("xyz", k=50)) for _ in "12")
        assert set(winnowing.winnow(a)[0].tolist()) & set(winnowing.winnow(b)[0].tolist())


@pytest.mark.parametrize("per_range", [10_000, 3])
def test_each_document_meets_the_next(spark, per_range):
    rnd = random.Random(6)
    texts = [None, "", "é" * 5, "😀ab" * 30] + ["".join(rnd.choices("abc de", k=rnd.randrange(200))) for _ in range(20)]
    ids = [7 * i - 30 for i in range(len(texts))]
    rows = [(i, t, "x") for i, t in zip(ids, texts, strict=True)]
    rnd.shuffle(rows)
    rows += [(None, "last one, without an id", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, place string").repartition(5)
    got = {r["doc_id"]: r for r in winnowing.compare_with_next(df, rows_per_range=per_range).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    assert len(got) == len(rows)
    for (i, t, _), (_, u, _) in zip(order, order[1:] + order[:1], strict=True):
        t, u = t or "", u or ""
        n = len(t) // 4
        changed = t[: len(t) - n] + u[:n]
        r = got[i]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        h, c, o = (winnowing.winnow(x)[0] for x in (t, changed, u))
        assert r["near_edited"] == winnowing.likeness(h, c) and r["near_next"] == winnowing.likeness(h, o)
        assert r["fingerprint"] == winnowing.digest(h) and r["edited_fingerprint"] == winnowing.digest(c)


def test_repeated_ids_and_few_rows(spark):
    schema = "doc_id long, text string"
    one = spark.createDataFrame([(1, "abcdefghijkl" * 4)], schema)
    assert winnowing.compare_with_next(one).first()["near_next"] == 1.0
    assert winnowing.compare_with_next(one.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (None, "z"), (None, None)], schema)
    assert winnowing.compare_with_next(same).count() == 5
    kept = winnowing.fingerprints(one.withColumnRenamed("doc_id", "hashes"), "kept").first()["kept"]
    assert kept["hashes"] and len(kept["hashes"]) == len(kept["positions"])


# --- licences ------------------------------------------------------------------


def test_license_places(spark):
    phrases = [(t.label, list(t.words)) for t in licenses.BASE]
    texts = [
        "This work is under the GNU General Public License, version 3.",
        "Licensed under CC BY-NC 4.0. cc by CC-BY",
        "MIT License\nmit licence apache-license gnu general public",
        "Released under the MIT License. Apache License, Version 2.0",
        "gnu gnu general public license general public license",
        None,
        "",
        "license " * 500 + "mit license",
    ]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    for r in licenses.scan_licenses(df, "found").collect():
        words = plain_words(texts[r["doc_id"]])
        places = {
            (i, label)
            for label, p in phrases
            for i in range(len(words))
            if words[i : i + len(p)] == p
        }
        f = r["found"]
        assert f["n_words"] == len(words) and f["starts"] == sorted(i for i, _ in places)
        assert f["base_labels"] == sorted({x for _, x in places})
        assert set(f["base_labels"]) <= set(f["labels"]) and 0 <= f["score"] <= 1
    found = {r["doc_id"]: r["found"]["labels"] for r in licenses.scan_licenses(df, "found").collect()}
    assert "gpl-3.0" in found[0] and "cc-by-nc-4.0" in found[1] and "mit-notice" in found[3]
    assert licenses.scan_licenses(df.limit(0), "found").count() == 0


LABELLED = {
    "Apache License, Version 2.0": "apache,apache-2.0",
    "Released CC BY 4.0.": "cc-by,cc-by-4.0",
    "CC BY-NC 4.0 only": "cc-by,cc-by-nc-4.0",
    "text (CC BY-SA 4.0)": "cc-by,cc-by-sa-4.0",
    "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "gpl,gpl-3.0",
    "BSD 3-Clause License": "bsd-3-clause",
    "// SPDX-License-Identifier: MIT": "mit",
    "SPDX-License-Identifier: GPL-2.0-only": "gpl-2.0",
    "under GNU GPL v3": "gpl-3.0",
    "the apache of licenses, version 2": "",
}


def plain_labels(words, templates, idf):
    """Labels and best share of one text, by comparing every place."""
    labels, best = set(), 0.0
    for t in templates:
        total = sum(idf[w.encode()] for w in t.words)
        for start in range(-len(t.words), len(words)):
            same = [0 <= start + j < len(words) and words[start + j] == w for j, w in enumerate(t.words)]
            share = sum(idf[w.encode()] for w, x in zip(t.words, same, strict=True) if x) / total
            if all(same[slice(*t.key)]) and share >= (1 - 1e-9 if t.base else licenses.ENOUGH):
                labels.add(t.label)
                best = max(best, share)
    return sorted(labels), round(best, 9)


def test_license_forms(spark):
    rnd = random.Random(8)
    filler = " ".join(rnd.choices(["lorem", "ipsum", "the", "of", "and", "version"], k=30))
    texts = [*LABELLED, *(f"{filler} {t} {filler}" for t in LABELLED)]
    every = [" ".join(t.words) for t in licenses.NOTICES]
    texts += every + [" ".join(w for w in t.split() if rnd.random() > 0.1) for t in every]
    texts += [" ".join(rnd.choice(words) if rnd.random() < 0.1 else w for w in words) for words in map(str.split, every)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    idf = licenses.inverse_frequencies(df, licenses.BASE + licenses.NOTICES)
    got = {r["doc_id"]: r["f"] for r in licenses.scan_licenses(df, "f").collect()}
    for i, text in enumerate(texts):
        labels, best = plain_labels(plain_words(text), licenses.BASE + licenses.NOTICES, idf)
        assert got[i]["labels"] == labels and round(got[i]["score"], 9) == best, text
    for i, expected in enumerate(LABELLED.values()):
        assert ",".join(got[i]["labels"]) == expected and set(got[i + len(LABELLED)]["labels"]) >= set(got[i]["labels"])


# --- HTML ----------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1><nav><a href="/">Home</a></nav></header>
<div class="cookie-notice">We use cookies. Accept all, please.</div><div class="ad">Buy now, it is good.</div>
<article class="post"><header><h1>Real &eacute;&nbsp;title</h1></header><p>First <b>one</b>, with
 <a href="x">a link</a>. 1 &lt; 2 &amp;amp; more.<p>Short.<script>var t = "</p>";</script><!-- <p>no</p> -->
<ul><li>One thing<li>Second</ul><section id="comments"><p>Great article, I loved it.</p></section></article>
<aside><p>Related stories, and more. See also.</p></aside><form>Name <input name=x></form>
<footer>&copy; someone &middot; all rights.</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE).split("\n\n") == [
        "Real é title",
        "First one, with a link. 1 < 2 &amp; more.",
        "Short.",
        "One thing",
        "Second",
    ]
    plain = "<body><div id=top-nav><a href=a>A</a></div><h1>Title</h1><p>Hello world, this is text.<p>More.</body>"
    assert html_text.main_text(plain) == "Title\n\nHello world, this is text.\n\nMore."


STORY = "<h1>Real title</h1><p>First one, with some words of text.</p><p>Short.</p><p>The last one, and more.</p>"
STORY_TEXT = "Real title\n\nFirst one, with some words of text.\n\nShort.\n\nThe last one, and more."


@pytest.mark.parametrize(
    "before, after",
    [
        ('<div class="content has-sidebar">', "</div>"),
        ('<div class="overflow-hidden">', "</div>"),
        ('<main class="with-sidebar">', "</main>"),
        ('<article class="post tag-search category-notices">', "</article>"),
        ('<form id="aspnetForm"><div id="comments-open" class="sidebar-layout"><main>', "</main></div></form>"),
        ('<form method="post" action="./"><div>', "</div></form>"),
        ('<div class="page-widget md:hidden">', "</div>"),
    ],
)
def test_names_of_wrappers_do_not_lose_the_article(before, after):
    rest = '<div class="sidebar"><p>Related stories, and more. See also.</p></div><footer><p>All rights, reserved.</p></footer>'
    for page in (before + STORY + after + rest, before + STORY + rest + after):
        assert html_text.main_text(f"<body><nav><a href=a>A</a></nav>{page}</body>") == STORY_TEXT


@pytest.mark.parametrize(
    "between, text",
    [
        ('<svg class="i"/>', ""),
        ('<svg data-a="x>y" />', ""),
        ("<svg-icon></svg-icon>", ""),
        ("<math-field></math-field>", ""),
        ("<template-part/>", ""),
        ('<svg class="i"><title>icon</title><path d="M0"/><text>drawn</text></svg>', ""),
        ('<svg class="i"><path d="M0"/>', ""),
        ("<script>var t = '<svg/>';</script>", ""),
        ('<math display="block"/>', ""),
        (
            "<p>It holds, that <math><mi>a</mi><mo>=</mo><mn>2</mn>"
            '<annotation encoding="application/x-tex">a=2</annotation></math>.</p>',
            "\n\nIt holds, that a=2.",
        ),
    ],
)
def test_text_after_drawings_and_formulas_stays(between, text):
    page = f"<article><p>One line, of text.</p>{between}<p>Two lines, of text.</p></article>"
    assert html_text.main_text(page) == f"One line, of text.{text}\n\nTwo lines, of text."


def test_many_open_drawings():
    assert html_text.main_text("<svg>" * 50_000 + "<p>Some words, of text.</p>") == "Some words, of text."


def test_long_comments_do_not_become_the_article():
    comments = '<div class="comment"><p>' + "I have read all of it, and liked it. " * 12 + "</p></div>"
    for start, end in (("<article>", "</article>"), ('<div class="post">', "</div>"), ("<div>", "</div>")):
        inside = f'{start}{STORY}<section id="comments">{comments}</section>{end}'
        outside = f'{start}{STORY}{end}<section id="comments">{comments}</section>'
        if start == "<article>":
            assert html_text.main_text(inside) == STORY_TEXT
        if start != "<div>":
            assert html_text.main_text(outside) == STORY_TEXT
    assert html_text.main_text('<div class="cookie-notice">We use cookies. Accept all, please.</div>') == ""


def test_lists_of_links_in_an_article_stay():
    items = "".join(f"<li><a href=/{i}>Chapter number {i}</a></li>" for i in range(20))
    want = "\n\n".join(["Reading list", *(f"Chapter number {i}" for i in range(20))])
    nav = "<nav><ul><li><a href=/>Home page</a></li><li><a href=/n>News today</a></li></ul></nav>"
    for tag in ("main", "article"):
        page = f"<body>{nav}<{tag}><h1>Reading list</h1><ul>{items}</ul></{tag}></body>"
        assert html_text.main_text(page) == want
    # what the navigation has as well is no content, and neither are lists outside
    again = '<ul><li><a href=/>Home page</a></li><li><a href=/n>News today</a></li></ul>'
    assert html_text.main_text(f"<body>{nav}<main>{STORY}{again}</main></body>") == STORY_TEXT
    assert html_text.main_text(f"<body>{nav}<main>{STORY}</main><ul>{items}</ul></body>") == STORY_TEXT


def test_a_long_paragraph_in_a_form():
    long = "It was said, and written down, that the form held all of the text. " * 4
    page = "<body><main><h1>Title here</h1><form><p>{}</p><input></form></main></body>"
    assert html_text.main_text(page.format(long)) == f"Title here\n\n{long.strip()}"
    assert html_text.main_text(page.format("Your name, please.")) == "Title here"


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!--", "<script>x", "</p></div>", "a" * 10, "<a href='x"])
def test_broken_pages(page):
    assert "<" not in html_text.main_text(page)


def test_long_page():
    page = "<article>" + "<p>Some words of text, and more.</p>" * 20_000 + "<p>cut of"
    assert html_text.main_text(page).count("\n\n") == 20_000


def test_minimum_cut_is_the_least_cost():
    rnd = random.Random(8)
    for _ in range(150):
        n = rnd.randrange(1, 9)
        z = [rnd.uniform(-2, 2) for _ in range(n)]
        smooth = {(i, j): rnd.uniform(0, 2) for i in range(n) for j in range(i + 1, n) if rnd.random() < 0.5}

        def cost(side, z=z, smooth=smooth):
            own = sum(max(x, 0) if not s else max(-x, 0) for x, s in zip(z, side, strict=True))
            return own + sum(w for (i, j), w in smooth.items() if side[i] != side[j])

        best = min(cost(s) for s in product([False, True], repeat=n))
        assert cost(html_text.minimum_cut(z, smooth)) == pytest.approx(best)


def test_extract_keeps_rows(spark):
    rows = [(1, "u", PAGE, "m"), (1, "u", PAGE, "m"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [r["out"] for r in html_text.extract(df, "out").collect()]
    assert sorted(got) == ["", *[html_text.main_text(PAGE)] * 2]
