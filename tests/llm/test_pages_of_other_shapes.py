"""Pages that are not one plain article: what is content stays, in page order."""

import pytest

from quayside.llm.html import extract

P = [f"<p>Sentence {i} of the story, which is long enough, with commas, to count as one of its paragraphs, and more.</p>" for i in range(6)]
BODY = "".join(P)
TEXT = " ".join(p[3:-4] for p in P)
MENU = "<ul><li><a href=a>Home</a><li><a href=b>News</a><li><a href=c>Sport</a></ul>"


def page(inner):
    return f"<html><head><title>x</title></head><body>{inner}</body></html>"


@pytest.mark.parametrize(
    ("inner", "want"),
    [
        (f"<div>{BODY}</div><div><p>The end of it.</p></div>", f"{TEXT} The end of it."),
        (f"<div>{BODY}</div><ul><li>one thing<li>another</ul>", f"{TEXT} one thing another"),
        (f"<h1>A headline</h1><div>{BODY}</div>", f"A headline {TEXT}"),
        (f"<div>{BODY}</div><h2>Part two</h2><div>{BODY}</div>", f"{TEXT} Part two {TEXT}"),
        (f"Before it all began. <div>{BODY}</div> After it had ended.", f"Before it all began. {TEXT} After it had ended."),
        (f"<div>{BODY}</div>bare <b>bold</b> text<div>{BODY}</div>", f"{TEXT} bare bold text {TEXT}"),
        (f"{MENU}<div>{BODY}</div>{MENU}", TEXT),
        (f"<div>{MENU}</div><h1>A headline</h1><div>{BODY}</div><div>{MENU}</div>", f"A headline {TEXT}"),
        (f"<div>{BODY}</div><div>Copyright 2020</div>", TEXT),
        (
            f"<article><header><h1>Title</h1><p>By A. Writer, 3 May</p><p>A lead that says in one whole sentence what the story is about.</p></header>{BODY}</article>",
            f"Title A lead that says in one whole sentence what the story is about. {TEXT}",
        ),
        (f"<article>{BODY}<div class='share-price-analysis'>{P[0]}</div></article>", f"{TEXT} {P[0][3:-4]}"),
        (f"<article>{BODY}<section class='social-history'>{P[1]}</section></article>", f"{TEXT} {P[1][3:-4]}"),
        (f"<article>{BODY}<div id='remark-1'>{P[2]}</div></article>", f"{TEXT} {P[2][3:-4]}"),
        (f"<article>{BODY}<div class='share'><a href=x>Share this</a> <span>12</span></div></article>", TEXT),
        (f"<article>{BODY}<div class='advert'>{P[3]}</div></article>", TEXT),
        (
            f"<article>{BODY}</article><section id='responses'>" + f"<article><b>Ann</b>{P[0]}{P[1]}</article>" * 4 + "</section>",
            TEXT,
        ),
        (
            f"<main><article>{BODY}</article><section class='c'>" + f"<article><b>Bo</b>{P[4]}{P[5]}</article>" * 4 + "</section></main>",
            TEXT,
        ),
        (f"{MENU}<div class='ad'>{P[0]}</div><article><h1>Short.</h1><p><b>Short.<br></article>", "Short. Short."),
        (f"<article>{BODY}</article><section><h2>Part two</h2>{BODY}</section>", f"{TEXT} Part two {TEXT}"),
    ],
)
def test_shapes(inner, want):
    assert extract(page(inner)) == want
