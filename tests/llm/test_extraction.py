import html
import re
from collections import Counter

from cliptide.llm import extraction, queries

BODY = "Plain words that go on for a while, as paragraphs do, until they come to their end. "


FEATURES = dict(enumerate("words density words_before density_before words_after density_after heading region".split()))


def used(node, found=None):
    found = set() if found is None else found
    if not isinstance(node, bool):
        found.add(FEATURES[node[0]])
        used(node[2], found), used(node[3], found)
    return found


def test_tree_needs_density_and_neighbours():
    x, y = extraction.labelled_rows()
    fresh, truth = extraction.labelled_rows(200, 99)
    right = lambda tree, cols: sum(tree(r) == (t > 0) for r, t in zip(fresh[:, cols].tolist(), truth)) / len(truth)
    whole = right(extraction.trained(), list(range(8)))
    assert whole > 0.97 and used(extraction.trained().root) >= {"words", "density", "words_before", "density_before", "words_after", "density_after"}
    for cols in ([0, 6, 7], [0, 2, 4, 6, 7], [0, 1, 6, 7]):  # without links, without the links of all, without neighbours
        assert right(extraction.Tree(x[:, cols], y), cols) < whole - 0.005


def test_pages_without_names(spark):
    both = got = want = 0
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        a = Counter(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        bare = re.sub(r"<(/?)(article|nav|footer|header|aside|main)\b[^>]*>", r"<\1div>", re.sub(r'\s(class|id|role)="[^"]*"', "", r.html))
        b = Counter(extraction.main_text(bare).split())
        both, got, want = both + (a & b).total(), got + b.total(), want + a.total()
    assert both / want > 0.95 and both / got > 0.95


def test_article_of_every_page(spark):
    path = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{path}/pages.parquet").collect()}
    for r in queries.op8_extraction(spark, path).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert r.n_chars == len(r.text)


def test_unseen_layouts():
    main = f"<h1>Title here</h1><p>{BODY * 3}</p><p>Short.</p><p>{BODY}</p>"
    want = " ".join(f"Title here {BODY * 3} Short. {BODY}".split())
    sides = {
        "menu": "<ul class='main-menu'><li><a href=x>One</a><li><a href=y>Two</a></ul>",
        "aside": f"<aside><h3>Also</h3><p>{BODY * 4}</p></aside>",
        "notice": f"<div class='cookie-consent'><p>{BODY * 2}</p></div>",
        "advert": f"<div id='ad-slot-1'>{BODY * 3}</div>",
        "form": f"<form><label>Mail</label><input name=q><p>{BODY}</p><textarea>{BODY}</textarea><button>Go</button></form>",
        "comments": f"<section id='reader-comments'><h2>2 comments</h2><div class='comment-body'><p>{BODY * 5}</p></div></section>",
        "script": "<script>var a = '<p>no</p>'; if (a < 1) {}</script><style>p > a {}</style><noscript><p>On</p></noscript>",
        "hidden": f"<div hidden><p>{BODY * 2}</p></div><p style='display: none'>{BODY}</p><!-- <p>{BODY}</p> -->",
    }
    for name, side in sides.items():
        for page in (f"<body>{side}<article>{main}</article>{side}</body>", f"<body><article>{main}{side}</article></body>", f"<body><div class=content>{main}</div>{side}</body>"):
            assert extraction.main_text(page) == want, (name, page)


def test_markup_details():
    say = lambda inner: extraction.main_text(f"<article><p>{inner}</p></article>")
    assert say("a &amp; b &lt;c&gt; &eacute;&#233;&#xe9;&nbsp;d") == "a & b <c> ééé d"
    assert say("one<b>two</b> <i>three</i>\n\t four<br>five") == "onetwo three four five"
    assert say("x < y and 3 > 2") == "x < y and 3 > 2"
    assert say("<a title='a > b' href=\"x>y\">link</a> after") == "link after"
    assert extraction.main_text("<article><p><b>open<p>next<br>line") == "open next line"
    assert extraction.main_text("<title>T</title><article>&copy; text</article>") == "© text"
    assert extraction.main_text(None) == extraction.main_text("") == extraction.main_text("<p></p>  ") == ""
    assert len(extraction.main_text("<article>" + f"<p>{BODY}</p>" * 20_000 + "</article>")) == (len(BODY)) * 20_000 - 1
    assert extraction.main_text("<div>" * 5000 + "<article><p>deep") == "deep"
    assert say("Let <math><mi>x</mi></math> be <object data=o>fallback</object><svg><path d='M0'/></svg> given.") == "Let x be fallback given."
    assert say("a<script src='x'/>var z=1;</script> b") == "a b"
    assert say("see <a href=/x/>this</a> now") == "see this now"
    assert extraction.main_text(f"<div class=ad data-u=/u/><p>{BODY}</p></div><article><p>{BODY}</p></article>") == BODY.strip()


def test_rows_are_kept(spark, tmp_path):
    rows = [(1, "u", None, "t"), (None, None, "<article><p>text</p></article>", "t"), (2, "v", "", None), (2, "v", "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    df.write.parquet(f"{tmp_path}/a/pages.parquet")
    df.limit(0).write.parquet(f"{tmp_path}/b/pages.parquet")
    got = sorted(map(tuple, queries.op8_extraction(spark, f"{tmp_path}/a").collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (None, None, "text", 4), (2, "v", "", 0), (2, "v", "", 0)], key=str)
    assert queries.op8_extraction(spark, f"{tmp_path}/b").count() == 0


def test_regions_are_known_at_any_depth():
    inside = f"<nav><p>{BODY}</p></nav><article><p>{BODY * 2}</p></article>"
    for n in (0, 150, 250, 20_000):
        found = extraction.blocks(f"<body>{'<div>' * n}{inside}{'</div>' * n}<footer><p>{BODY}</p></footer></body>")
        assert [b.region for b in found] == [b.region for b in extraction.blocks(f"<body>{inside}<footer><p>{BODY}</p></footer></body>")], n
    found = extraction.blocks(f"<body>{'<span>' * 400}{inside}")
    assert len({b.region for b in found}) == 2
