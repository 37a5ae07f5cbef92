import html
import re

import pytest

from lastro.llm import content

WEIGHTS = content.weights_of({
    ("word", True): 5000, ("word", False): 900, ("p", True): 200, ("p", False): 2, ("b", True): 30, ("h1", False): 5,
    ("li", False): 300, ("a", False): 300, ("ul", False): 50, ("div", False): 90, ("nav", False): 60,
})


def text_of(source):
    return content.extract(source, WEIGHTS)


def paragraphs(*names):
    return [f"{n} paragraph with enough words to look like the text of an article." for n in names]


ONE, TWO, THREE = paragraphs("First", "Second", "Third")


@pytest.mark.parametrize("page", [
    f"<body><header><a>Site</a></header><nav><ul><li><a>x</a></ul></nav><main><h1>Title</h1><p>{ONE}<p>{TWO}</main><footer>f</footer>",
    f"<div class='site-header'>Site</div><div id=content><h1>Title</h1><p>{ONE}</p><aside>side words</aside><p>{TWO}</p></div>",
    f"<article><header><h1>Title</h1></header><div class=body><p>{ONE}</p><div class='ad-box'>Buy now, {ONE}</div><p>{TWO}</p></div>"
    f"<section id=comments><p>{THREE}</p></section></article>",
    f"<nav><p>{THREE}</nav><h1>Title</h1><p>{ONE}</p><p>{TWO}</p><div class=cookie-notice>{THREE}</div><footer>{THREE}</footer>",
    f"<article><h1>Title</h1><script>var x='<p>{THREE}</p>'</script><p>{ONE}</p><form><label>{THREE}</label></form><p>{TWO}</article>"
    f"<div role=complementary><p>{THREE}</p></div>",
    f"<article><h1>Title</h1><!-- <p>no</p> --><p>{ONE}</p><p title='a > b'>{TWO}</p></article><article class=comment><p>{THREE}</p></article>",
])
def test_article_without_its_surroundings(page):
    assert text_of(page) == f"Title\n\n{ONE}\n\n{TWO}"


FOUR, FIVE = paragraphs("Fourth", "Fifth")


@pytest.mark.parametrize("page, names", [
    # A story in a div beside a teaser that holds two fifths of the run, before and after it.
    (f"<div class=story><p>{ONE}<p>{TWO}<p>{FIVE}</div><article><p>{THREE}<p>{FOUR}</article>", (ONE, TWO, FIVE, THREE, FOUR)),
    (f"<article><p>{THREE}<p>{FOUR}</article><div class=story><h2>Title</h2><p>{ONE}<p>{TWO}<p>{FIVE}</div>", (THREE, FOUR, "Title", ONE, TWO, FIVE)),
    # Sibling articles, alone, in one element, and with paragraphs between them.
    (f"<article><h1>Title</h1><p>{ONE}</article><article><p>{TWO}</article><article><p>{THREE}</article>", ("Title", ONE, TWO, THREE)),
    (f"<main><article><p>{ONE}</article><article><p>{TWO}<p>{THREE}</article></main><footer>{FOUR}</footer>", (ONE, TWO, THREE)),
    (f"<nav>{FIVE}</nav><article><p>{ONE}</article><p>{TWO}</p><article><p>{THREE}</article><div class=related>{FOUR}</div>", (ONE, TWO, THREE)),
    # An article inside another one, and a marked one that the run does not reach.
    (f"<article><h1>Title</h1><p>{ONE}<article><p>{TWO}</article><p>{THREE}</article>", ("Title", ONE, TWO, THREE)),
    (f"<div><p>{ONE}<p>{TWO}</div>" + "<ul><li><a>x</a></ul>" * 20 + "<article><p>Read on</article>", (ONE, TWO)),
])
def test_the_run_sets_the_bounds(page, names):
    assert text_of(page) == "\n\n".join(names)


SIX = paragraphs("Sixth")[0]


@pytest.mark.parametrize("page", [
    "<div class='page no-sidebar'>{0}</div>",
    "<div class='sidebar'><div class=menu>{0}</div></div><nav>{1}</nav>",
    "<article><div class='no-sidebar content'>{0}</div></article>",
    "<article><section id=discussion>{0}</section></article>",
    "<article><section id='share-price'>{0}</section></article>",
    "<body class=comments><main id=comments>{0}</main><div id=comments>{1}</div></body>",
    "<article><div class=has-footer>{0}</div><div class='site-footer'>{1}</div><div class=related-posts>{1}</div></article>",
])
def test_names_count_as_whole_classes_and_never_on_most_of_the_page(page):
    inner = f"<h1>Title</h1><p>{ONE}</p><p>{TWO}</p>" + f"<p>{FIVE}</p>" * 3
    assert text_of(page.format(inner, f"<p>{SIX}</p>")) == "\n\n".join(["Title", ONE, TWO, FIVE, FIVE, FIVE])


def test_names_inside_an_article():
    page = (
        f"<article><h1>Title</h1><p>{ONE}</p><section id=discussion><h2 id=related-work>Related work</h2><p>{TWO}</p></section>"
        f"<p class=promotion-history>{FIVE}</p><h2 id=comments>On comments</h2><p id=share>{FOUR}</p>"
        f"<div class=promo>{SIX}</div><div id=comments>{THREE}</div></article>"
    )
    assert text_of(page) == "\n\n".join(["Title", ONE, "Related work", TWO, FIVE, "On comments", FOUR])


def test_blocks_references_and_white_space():
    page = f"<article><h1> A &amp; B&nbsp;\n C </h1><p><b>bold<br>next</b>word <i>x</i>y<p>1 < 2 &lt;b&gt; &eacute;&#233;&#x41; &amp</article>{ONE}"
    assert text_of(page) == "A & B C\n\nbold nextword xy\n\n1 < 2 <b> éé" + "A &"


@pytest.mark.parametrize("page", ["", " ", "<html></html>", "<p></p>", "<script>x", "<!-- x", "<", "<p", "&", "</p></p>", "<nav>a b</nav>"])
def test_pages_without_article(page):
    assert text_of(page) in ("", "<", "&")


def test_long_and_broken_pages():
    assert len(text_of("<article><p>" + "word " * 400_000)) == 5 * 400_000 - 1
    assert text_of("<article><div class='" + f"x><p>{ONE}" * 50).count("First") <= 50
    assert text_of("<article>" + "<div>" * 3000 + ONE) == ONE


def test_rows(spark):
    rows = [(1, "u", None, "t"), (None, None, f"<article><p>{ONE}</article>", None), (2, "v", "", "x"), (2, "v", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = content.main_text(pages).collect()
    assert sorted((str(r.page_id), r.url, r.text, r.n_chars) for r in found if r.url) == [
        ("1", "u", "", 0), ("2", "v", "", 0), ("2", "v", "", 0)
    ]
    assert [r.text for r in found if r.url is None] == [ONE]
    assert content.main_text(pages.limit(0)).collect() == []


def plain(source):
    """The article of the generated pages, by their known form."""
    inner = re.search(r"<article>(.*?)(</article>|$)", source, re.S).group(1)
    parts = [re.sub(r"<br>", " ", part.replace("<b>", "")) for part in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(t for t in (" ".join(html.unescape(part).split()) for part in parts) if t)


def test_given_pages(spark, folder):
    from lastro.llm.queries import QUERIES

    given = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = QUERIES["op8_main_text"](spark, folder).collect()
    assert len(found) == len(given)
    for row in found:
        assert row.text == plain(given[row.page_id].html) and row.n_chars == len(row.text) and row.url == given[row.page_id].url
