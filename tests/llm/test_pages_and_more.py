"""HTML extraction, sharding, licences, language identification and the pipeline."""

from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from conftest_llm import prose
from quayside.llm import html, language, licenses, sharding

DATA = Path("/root/testdata/sf0.001")

PAGE = """<!doctype html><html><head><title>t</title><style>p{}</style></head><body class="home ad-free">
<header><h2>Site</h2></header><nav><a href=/>Home</a></nav><div class="cookie-notice"><p>We use cookies, a lot, really.</p></div>
<main><article><header><h1>Big&nbsp;news</h1><span>by someone</span></header>
<p>First, of   many &amp; more, words<br>here<p>Second <b>bo</b>ld &#233; &lt;tag&gt;, with <a href=x>a link</a>.
<div><ul><li>one<li>two</ul></div><script>var p="</p>";</script><aside>side, side, side</aside><p>ok</p>
<form><p>Name, please, now</p></form></article>
<section id="comments"><p>Great post, really, thanks, all!</p></section></main>
<div class=ad>Buy, buy, buy</div><footer>&copy; all, rights</footer>"""


def test_article_text():
    want = "Big news First, of many & more, words here Second bold é <tag>, with a link. one two ok"
    assert html.extract(PAGE) == want


def test_pages_without_article():
    page = "<div id=x><p>" + "Long, text, here. " * 9 + "</p><p>short</p></div><div><a href=a>link, link</a> <a href=b>more</a></div>"
    assert html.extract(page) == ("Long, text, here. " * 9).strip() + " short"
    assert html.extract("just text, no markup") == "just text, no markup"
    assert html.extract("<div>" * 5000 + "deep, text" + "</p>" * 10) == "deep, text"
    for nothing in (None, "", "  ", "<html></html>", "<p></p>", "<", "<!-- x"):
        assert isinstance(html.extract(nothing), str)


def test_frames_with_unlikely_names_keep_their_page():
    words = ", ".join(prose(i, 30) for i in range(3))
    article = f"<article><h1>Head line</h1><p>{words}</p></article>"
    side = "<div class='sidebar'><p>about us, and more, and more</p></div>"
    for page in (
        f"<body><div class='layout with-sidebar'>{article}{side}</div></body>",
        f"<body><form id='aspnetForm'>{article}{side}</form></body>",
        f"<body><form><nav>menu</nav><div><h1>Head line</h1><p>{words}</p></div>{side}</form></body>",
        f"<body><article><header class='entry-header'><h1>Head line</h1></header><p>{words}</p></article></body>",
        f"<body><article><div class='post-header'><h1>Head line</h1>by</div><p>{words}</p></article>{side}</body>",
    ):
        assert html.extract(page) == f"Head line {words}"
    lone = "<body><ul><li>" + prose(9, 40) + "</li></ul><div class='widget'><p>Short text.</p></div></body>"
    assert "about" not in html.extract(lone.replace("</body>", side + "</body>"))
    assert html.extract("<body><div class='promo'><p>Only this</p></div></body>") == "Only this"


def test_broken_markup_is_no_text():
    assert html.extract("<p>one, two</p><![foo[ bar ]]><![if x]><p>three, four</p>") == "one, two three, four"
    for tail in ("<a href='/x", "<!-- cut", "</arti", "<![CDATA[ cut", "<?php cut"):
        assert html.extract("<article><p>one, two</p>" + tail) == "one, two"
    assert html.extract("<p>1 < 2, 3 <") == "1 < 2, 3 <"


def test_deep_pages_take_linear_time():
    assert html.extract("<div>x y" * 20000).count("x") == 20000


def test_page_table(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (3, "v", "", "y")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = html.main_texts(pages).collect()
    assert len(got) == 4 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert html.main_texts(pages.limit(0)).count() == 0


def test_shards_hold_the_mixture(frame, monkeypatch):
    sources = ["big"] * 500 + ["mid"] * 90 + [None] * 50 + [f"one{i}" for i in range(40)]
    rows = [(i, f"text {i}", "en", s, 0, "", "", 0) for i, s in enumerate(sources)]
    rows += [(None, None, None, "big", None, "", "", 0)] * 5
    got = sharding.shards(frame(rows), slices=16).collect()
    assert len(got) == len(rows)
    by_shard = Counter(g["shard"] for g in got)
    assert set(by_shard) == set(range(8)) and max(by_shard.values()) - min(by_shard.values()) <= 1
    for k, n in by_shard.items():
        assert sorted(g["slot"] for g in got if g["shard"] == k) == list(range(n))
    source = {i: s for i, s in enumerate(sources)}
    for s, n in (("big", 500), ("mid", 90), (None, 50)):
        each = Counter(g["shard"] for g in got if g["doc_id"] is not None and source[g["doc_id"]] == s)
        assert max(each.values()) - min(each[k] for k in range(8)) <= 2 + 5 * (s == "big"), (s, n, each)
    assert {(g["size"], g["text_crc32"]) for g in got if g["doc_id"] is None} == {(1, 0)}
    monkeypatch.setattr(sharding, "SLICE_ROWS", 10)
    again = sharding.shards(frame(rows).repartition(7), slices=16).collect()
    assert sorted(g["shard"] for g in again) == sorted(g["shard"] for g in got)
    monkeypatch.undo()
    again = sharding.shards(frame(rows).repartition(7), slices=16).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert sharding.shards(frame([])).count() == 0
    assert [tuple(g)[4:] for g in sharding.shards(frame(["a"])).collect()] == [(0, 0, None)]


def slow_matches(text):
    import re

    words = re.sub("[^a-z0-9]+", " ", (text or "").lower()).split()
    out = set()
    for t in licenses.templates():
        for start in range(max(0, len(words) - t.window) // t.step * 1 + t.window):
            at = start * t.step
            part = words[at : at + t.window]
            found = {" ".join(part[i : i + 5]) for i in range(len(part) - 4)}
            if len(found & set(t.shingles)) >= 0.8 * len(t.shingles):
                out.add(t.name)
    return out


def test_licences_against_all_windows(frame):
    texts = [None, "", prose(1, 400), "license " * 50]
    for i, (_, notice) in enumerate(licenses.NOTICES.values()):
        texts += [notice, f"{prose(i, 30 + i)}.\n{notice.upper()} {prose(70 + i, 20)}"]
        words = notice.split()
        texts.append(prose(i, 9) + " " + " ".join(words[: len(words) - 1 - len(words) // 12]))
    texts.append(prose(5, 2000) + " " + texts[5] + " " + prose(6, 900))
    got = {r["doc_id"]: {m["name"] for m in r["matches"]} for r in licenses.scan(frame(texts)).collect()}
    for i, t in enumerate(texts):
        want = slow_matches(t)
        assert got[i] <= want and bool(got[i]) == bool(want), (t, got[i], want)
    shown = licenses.report(frame([*texts, texts[-1]])).collect()
    assert len(shown) == len(texts) + 1 and sum(r["n_matches"] for r in shown) >= 28
    assert licenses.report(frame([])).count() == 0


def test_licence_families(frame):
    texts = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0",
        "Licensed under CC BY 4.0.": "CC-BY-4.0",
        "Licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
        "Licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
        "This is free and unencumbered software released into the public domain.": "Unlicense",
        "GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n\n Copyright (C) 2007": "GPL-3.0",
        licenses.NOTICES["mit-text"][1]: "MIT",
    }
    docs = frame([f"{prose(i, 40)}. {t} {prose(60 + i, 20)}" for i, t in enumerate(texts)])
    got = {r["doc_id"]: r["licenses"] for r in licenses.report(docs).collect()}
    assert got == dict(enumerate(texts.values()))


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="test data not present")
def test_every_licence_sentence_of_the_table_is_found(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(F.col("text").rlike("(?i)licensed? "))
    assert docs.count() > 0
    assert licenses.report(docs).where("n_matches = 0").count() == 0


def test_collision_guarantee():
    assert min(licenses.collision_chance(t) for t in licenses.templates()) > 0.999
    with pytest.raises(ValueError):
        licenses.templates({"x": ("X", "too short")})


def test_languages(frame):
    letters = {"en": "etaoinshr", "de": "enisratdü", "fr": "esaitnéèu", "es": "eaosnrñóc"}
    rows = [(i, prose(i, 5 + i % 40, letters[c]), c, "s", 0, "", "", 0) for i in range(400) for c in [list(letters)[i % 4]]]
    odd = [None, "", "123 456 ½² !!", "é"]
    rows += [(1000 + i, t, "en", "s", 0, "", "", 0) for i, t in enumerate(odd)] + [(None, prose(1, 50, letters["fr"]), None, None, 0, "", "", 0)]
    got = language.identify(frame(rows)).collect()
    assert len(got) == len(rows) and all(0 <= g["score"] <= 1 for g in got)
    truth = {r[0]: r[2] for r in rows if r[0] is not None and r[0] < 400}
    held = [g for g in got if g["held_out"] and g["doc_id"] in truth]
    assert len(held) > 60 and sum(truth[g["doc_id"]] == g["lang_pred"] for g in held) >= 0.95 * len(held)
    by_id = {g["doc_id"]: g for g in got}
    assert [by_id[1000 + i]["lang_pred"] for i in range(3)] == ["und"] * 3 and by_id[1003]["lang_pred"] != "und"
    assert by_id[None]["lang_pred"] == "fr" and by_id[None]["held_out"]
    kept = language.keep_identified(frame(rows))
    assert kept.columns == frame([]).columns and not {1000, 1001, 1002} & {r["doc_id"] for r in kept.collect()}
    assert {g["lang_pred"] for g in language.identify(frame([(1, "abc", None, "", 0, "", "", 0)])).collect()} == {"und"}
    assert language.identify(frame([])).count() == 0


@pytest.mark.skipif(not DATA.exists(), reason="test data not present")
def test_pipeline_on_the_small_tables(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(DATA))
        assert after.columns == docs.columns
        docs = after
    left = {r["doc_id"] for r in docs.select("doc_id").collect()}
    packed = corpus_pipeline.run(spark, str(DATA)).collect()
    assert {r["doc_id"] for r in packed} == left
    assert set(entry_points.queries()) >= {"pipeline", *[f"op{i}_{n}" for i, n in enumerate(
        "pii html sharding simhash substrings packing licenses quality decontaminate language".split(), 1)]}
