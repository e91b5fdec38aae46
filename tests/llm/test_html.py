from tillwise.llm import html

STORY = "A sentence of the story that is long enough to count as text, with some more words. " * 2


def test_article_without_what_surrounds_it():
    page = f"""<html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
    <nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad <p>no</p> --><div class="ad">Buy</div>
    <article><header><h1>Head &amp; more</h1></header><p><b>Open<br><p>First   par
    agraph</p><aside>beside</aside><ul><li>one<li>two</ul><form>Name</form>
    <section id="comments"><p>I say</p></section></article><footer>&copy; x</footer></body></html>"""
    assert html.main_text(page) == "Head & more\nOpen\nFirst par agraph\none\ntwo"


def test_surge_and_dive_without_an_article():
    links = "".join(f'<li><a href="/{i}">Some linked heading number {i} of the site</a></li>' for i in range(9))
    page = f"<body><div>Home</div><ul>{links}</ul><div id=c><p>{STORY}</p><p>Short.</p><p>{STORY}</p></div><ul>{links}</ul></body>"
    assert html.main_text(page) == f"{STORY.strip()}\nShort.\n{STORY.strip()}"
    assert html.main_text("<p>only this</p>") == "only this"


def test_stretches():
    assert html.stretches([0, 5, 0, 50, 2, 40, 0, 9], surge=80) == [(3, 6)]
    assert html.stretches([], surge=1) == []


def test_references_and_broken_markup():
    assert html.main_text("<p>a &lt;b&gt; &eacute;&#233;&#x65; &nosuch; &amp;amp;") == "a <b> éée &nosuch; &amp;"
    assert html.main_text("<p>x <!-- open <p>y") == "x"
    assert html.main_text("a < b <p") == "a < b"
    assert html.main_text('<p title="a>b">c</p>') == "c"
    for page in ("<" * 50_000, "<a " * 20_000, "<div>" * 5_000 + "x", "&" * 50_000, '<p a="' * 5_000):
        html.main_text(page)


def test_pages(spark, small):
    from pyspark.sql import functions as F

    pages = spark.read.parquet(f"{small}/pages.parquet")
    odd = spark.createDataFrame(
        [(None, None, None), (900, "u", ""), (900, "u", ""), (901, None, "<p>téxt</p>")], pages.schema
    )
    frame = pages.unionByName(odd).withColumns({"text": F.lit(1), "n_chars": F.lit(2), "id": F.lit(3)})
    found = html.extract_text(frame).collect()
    texts = sorted((str(r.page_id), html.main_text(r.html)) for r in frame.collect())
    assert sorted((str(r.page_id), r.text) for r in found) == texts
    assert all(r.n_chars == len(r.text) for r in found)
    assert all(r.text for r in found if r.page_id is not None and r.page_id < 900)
    assert html.extract_text(pages.where("false")).collect() == []


def test_a_teaser_marked_as_article_does_not_replace_the_article():
    page = f"<body><div id=c><p>{STORY * 5}</p><p>{STORY * 4}</p></div><article class='card'><p>Read this too</p></article></body>"
    assert html.main_text(page) == f"{(STORY * 5).strip()}\n{(STORY * 4).strip()}"


def test_short_ends_stay_and_unlinked_notices_go():
    ends = f"<p>{STORY}</p><div class=ad>x</div><p>The end.</p><footer>f</footer>"
    assert html.main_text(ends) == f"{STORY.strip()}\nThe end."
    page = f"<body><div>A notice of this site</div><div id=c><h1>Head</h1><p>{STORY * 3}</p><p>Short.</p></div><div>All rights kept</div></body>"
    assert html.main_text(page) == f"Head\n{(STORY * 3).strip()}\nShort."


def test_a_run_ends_at_a_dive():
    assert html.stretches([500, 300, 20, 5, 5, 5, 5]) == [(0, 3)]


# Pages made by hand, with the text that a reader would call the article.
P = STORY.strip()
BY_HAND = {
    "a figure with a table": (
        f"<article><p>{P}</p><figure><table><tr><td>Rain</td><td>12 mm</td></tr></table><figcaption>Measured in May</figcaption>"
        f"</figure><p>{P}</p></article>", [P, "Rain", "12 mm", "Measured in May", P],
    ),
    "a title in a header class": (
        f"<article><div class='entry-header'><h1>The title</h1><p>by A. Writer</p></div><p>{P}</p></article>",
        ["The title", "by A. Writer", P],
    ),
    "columns in an article": (f"<main><div class='side-by-side'><p>{P}</p><p>{P}</p></div></main>", [P, P]),
    "a share price": (f"<article><p>{P}</p><p class='share-price'>The price of a share rose to 12 crowns on the day before, said the bank in a note to all who had asked for one.</p></article>",
                      [P, "The price of a share rose to 12 crowns on the day before, said the bank in a note to all who had asked for one."]),
    "a bar of links in an article": (f"<article><p>{P}</p><div class='share'><a href=a>Send this page to a friend of yours by mail</a> <a href=b>Keep this page for later and read it at home</a></div></article>", [P]),
    "comments of readers": (f"<article><p>{P}</p><section class='comments'><p>{P} I say.</p></section></article>", [P]),
    "a closing paragraph in a container of its own": (
        f"<body><div id=a><p>{P * 8}</p><p>{P * 8}</p></div><div id=b><p>And so the long story of the river came to its end, as all of them do.</p><p>{P}</p></div></body>",
        [P * 8, P * 8, "And so the long story of the river came to its end, as all of them do.", P],
    ),
    "a line of rights": (
        f"<body><div id=c><p>{P * 3}</p><p>{P}</p></div><div>Copyright 2020 by the Example Company of Anytown. All rights reserved in all countries of the world.</div></body>",
        [P * 3, P],
    ),
    "a notice about cookies": (f"<body><div>We use cookies to make this site better for all who come to see it, and so do our partners.</div><div><h1>Head</h1><p>{P * 2}</p><p>{P}</p></div></body>",
                               ["Head", P * 2, P]),
}


def test_pages_made_by_hand():
    assert {k: html.main_text(page) for k, (page, _) in BY_HAND.items()} == {k: "\n".join(t) for k, (_, t) in BY_HAND.items()}


def test_deep_pages_take_time_in_proportion():
    import time

    def seconds(page):
        start = time.perf_counter()
        html.main_text(page)
        return time.perf_counter() - start

    for page in ("<div>", "<b>", "<b><p>x", "<div></i>", "<a><li>"):
        small, large = (min(seconds(page * n) for _ in range(2)) for n in (4_000, 32_000))
        assert large < 30 * max(small, 0.01)
