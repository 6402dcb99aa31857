"""Main text of pages of several layouts, and awkward pages."""

from __future__ import annotations

import time

import pytest

from tallyline.llm.html_text import (
    extract,
    extracted_pages,
    features,
    labelled_pages,
    main_text,
    text_blocks,
    train_tree,
)

TREE = train_tree()
LONG = "A sentence of the article with quite a few words in it, as articles have."
PAGES = {
    "article": (
        "<html><head><title>no</title><style>p{a}</style></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
        "<!-- <p>no</p> --><div class='ad'>Buy this now.</div><article><h1>Title</h1>"
        f"<p><b>{LONG}<br>More&nbsp;of &amp; it</b><p>Short.<script>var t='</p><p>no'</script></p></article>"
        "<footer>&copy; someone, some place, some year.</footer></body></html>",
        f"Title\n{LONG} More of & it\nShort.",
    ),
    "main": (
        f"<body><header><p>Site name and claim</p></header><main><p>{LONG}</p><p>Yes.</p></main><aside><p>{LONG}</p></aside></body>",
        f"{LONG}\nYes.",
    ),
    "inside": (
        f"<article><p>{LONG}</p><div class='advert-box'><p>{LONG}</p></div><form><p>Your mail {LONG}</p></form>"
        f"<p>Last.</p><section id='comments'><p>{LONG}</p></section></article>",
        f"{LONG}\nLast.",
    ),
    "unmarked": (
        f"<body><div><a href='/a'>One link</a> <a href='/b'>another link</a></div><div>{LONG}</div><div>{LONG}</div></body>",
        f"{LONG}\n{LONG}",
    ),
    "own header": (f"<article><header><h1>Title</h1></header><p>{LONG}</p></article>", f"Title\n{LONG}"),
    "cookie notice": (f"<div id='cookieNotice'><p>{LONG}</p></div><div class=content><p>{LONG}</p></div>", LONG),
    "hidden": (f"<article><p hidden>no</p><p style='display: none'>no</p><p>{LONG}</p></article>", LONG),
}


@pytest.mark.parametrize("name", list(PAGES))
def test_layouts(name):
    html, want = PAGES[name]
    assert main_text(html, TREE) == want


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("just text", "just text"),
        ("<p>unclosed <b>bold", "unclosed bold"),
        ("<p>cut off <a href='x", "cut off"),
        ("<!-- never closed <p>a</p>", ""),
        ("<script>never closed <p>a</p>", ""),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<p title='a > b'>quoted</p>", "quoted"),
        ("</p></div></article>stray", "stray"),
        ("<p>&eacute;&#233;&#xe9;&notareference;</p>", "ééé¬areference;"),
    ],
)
def test_awkward_pages(html, want):
    assert main_text(html, TREE) == want


def test_tree_knows_its_table():
    for html, labels in labelled_pages():
        blocks = text_blocks(html)
        assert len(features(blocks)) == len(labels) == len(blocks)
    right = sum(
        int((TREE.predict(features(text_blocks(html))) >= 0.5).astype(int).tolist() == labels)
        for html, labels in labelled_pages()
    )
    assert right >= 0.95 * len(labelled_pages())


def test_link_density_of_neighbours():
    x = features(text_blocks("<p>a b <a>c d</a></p><p>e</p><ul><li><a>f</a></li></ul>"))
    assert x[:, 0].tolist() == [4, 1, 1]
    assert x[:, 1].tolist() == [0.5, 0, 1]
    assert x[1, 2:6].tolist() == [4, 0.5, 1, 1]


def test_rows(spark):
    rows = [(i, f"u{i}", html) for i, (html, _) in enumerate(PAGES.values())] + [(None, None, None), (0, "u0", PAGES["article"][0])]
    found = extracted_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = [(i, f"u{i}", text, len(text)) for i, (_, text) in enumerate(PAGES.values())]
    want += [(None, None, "", 0), (0, "u0", PAGES["article"][1], len(PAGES["article"][1]))]
    assert sorted((tuple(r) for r in found), key=repr) == sorted(want, key=repr)


def test_extra_columns_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "<p>a b</p>", "old", 2.5)], "page_id long, html string, text string, n_chars double")
    [row] = extract(pages).collect()
    assert row.asDict() == {"page_id": 1, "html": "<p>a b</p>", "n_chars": 2.5, "text": "a b"}
    assert extract(pages.limit(0)).collect() == []


def test_long_page():
    html = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    assert main_text(html, TREE).count("\n") == 19_999


@pytest.mark.parametrize("tag", ["svg", "script", "textarea", "div", "a"])
@pytest.mark.parametrize("inside", ['a="b" ' * 200, "a='b' " * 200, 'a="b ' * 201, "a= " * 400 + '"', "a=\"'" * 301])
def test_pages_cut_off_in_a_tag_take_no_time(tag, inside):
    began = time.perf_counter()
    blocks = text_blocks(f"<p>Some text before the tag</p><{tag} {inside}")
    assert time.perf_counter() - began < 0.5
    assert [b.text for b in blocks] == ["Some text before the tag"]
