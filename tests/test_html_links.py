import pytest

from linkforge.sources import html_links

CLASS = "data-service-file-link"
GOLDEN = [
    # page, classes and texts of its anchors
    ('<a class="c">one</a>', [(["c"], "one")]),
    ('<a class="c d">one <b> two</b> </a><a>three</a>', [(["c", "d"], "onetwo"), ([], "three")]),
    ('<a>x<span class="sr-only">hidden<span>too</span> still</span>y</a>', [([], "xy")]),
    ('<a>x<span class="a sr-only b">hidden</span>y</a>', [([], "xy")]),
    ('<a>x<span class="not-sr-only">shown</span></a>', [([], "xshown")]),
    ("<!-- <a>no</a> --><a>yes<!-- no --></a>", [([], "yes")]),
    ("<script>'<a>no</a>'</script><a>yes<script>no</script><style>no</style></a>", [([], "yes")]),
    ('<a title="x>y" href=\'</a>\'>text</a>', [([], "text")]),
    ("</b></a><a>one</i></a>", [([], "one")]),
    ("<a>open <b>end", [([], "openend")]),
    ("<a>outer <a>inner</a> rest</a>", [([], "outerinnerrest"), ([], "inner")]),
    ("<p><a>one</p> after</a>", [([], "one")]),
    ("<a>line<br>break<img src='x'/>end</a>", [([], "linebreakend")]),
    ("<a>&amp;lt; &#65;&#x42; &eacute;&nbsp;</a>", [([], "&lt; AB é")]),
    ("<A CLASS=c>upper</A>", [(["c"], "upper")]),
    ("<a></a><a> \n </a><a>x</a>", [([], ""), ([], ""), ([], "x")]),
    ("", []), (None, []), ("no markup < at all", []), ("<a", []),
]


@pytest.mark.parametrize("html, anchors", GOLDEN)
def test_anchors(html, anchors):
    assert html_links.anchors_of(html) == anchors


def test_pages_of_the_table(spark):
    rows = [(1, f'<a class="{CLASS}">F1<span class="sr-only">x</span></a><a>other</a>', "u"), (2, None, "u"), (3, "", "u"),
            (None, f'<a class="x {CLASS}"></a><a class="{CLASS}">F2</a>', "u"), (1, f'<a class="{CLASS}">F1</a>', "u")]
    pages = spark.createDataFrame(rows, "page_id long, html string, link_text string")
    got = html_links.page_links(pages).collect()
    assert sorted((r.page_id or 0, r.link_pos, r.link_text) for r in got) == [(0, 1, "F2"), (1, 0, "F1"), (1, 0, "F1")]
    assert html_links.page_links(pages, css_class=None).count() == 4
    assert html_links.page_links(pages.limit(0)).count() == 0


def test_long_and_deep_pages():
    deep = "<div>" * 20_000 + "<a>x</a>"
    assert html_links.anchors_of(deep) == [([], "x")]
    assert len(html_links.anchors_of("<a>x</a>" * 50_000)) == 50_000
