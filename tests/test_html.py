import html as std
import random
from html.entities import name2codepoint

import pytest
from pyspark.sql import functions as F

from newsloom.functions import elements, html


def test_entities_like_the_standard_library(column_of):
    samples = [f"a&{n};b" for n in name2codepoint] + [f"&#{i};" for i in range(1, 400)] + [
        f"&#x{i:x};" for i in (0x41, 0x80, 0x2019, 0x1F600, 0x10FFFF)] + [
        "&apos;", "&amp;lt;", "&amp; &copy;", "&", "& ", "&;", "a&b", "&#0;", "&#xD800;", "&#1114112;", "AT&T", "&&amp;&", "&copy &reg!"]
    # These have no text of their own for the standard library, which drops them.
    dropped = [s for s in samples if std.unescape(s) == ""]
    kept = [s for s in samples if s not in dropped]
    assert column_of(html.decode_entities, kept) == [std.unescape(s) for s in kept]


def test_unknown_entities_stay(column_of):
    assert column_of(html.decode_entities, ["&nothing; x", "&ampx", None]) == ["&nothing; x", "&ampx", None]


def test_random_entities(column_of):
    rng = random.Random(3)
    parts = ["&amp;", "&lt;", "&#65;", "&eacute;", "&", ";", "#", " ", "é", "<", "&#x20AC;"]
    samples = ["".join(rng.choice(parts) for _ in range(8)) for _ in range(300)]
    # The standard library also knows names without semicolon in front of letters; none is built here.
    assert column_of(html.decode_entities, samples) == [std.unescape(s) for s in samples]


def test_tags_with_quotes(column_of):
    got = column_of(html.drop_markup, ['a<b title="x > y">c</b>', "a < b and c > d", "<a title=\"5\" tall\">x", "<br/>x<br />"])
    assert got == ["a c ", "a < b and c > d", " x", " x "]


def test_long_attributes_do_not_overflow(column_of):
    page = "<a " + " ".join(f'd{i}="{"v" * 50}>"' for i in range(2000)) + ">x</a>"
    assert column_of(html.drop_markup, [page]) == [" x "]


@pytest.mark.parametrize("selector,attribute,page,want", [
    ("h3.title-news a", "href",
     '<h3 class="big title-news"><a class=x href="/1">A</a></h3><h3 class="title"><a href="/2"></a></h3>'
     '<h3 class="title-news"><a>no</a><a href="">e</a><a href=\'/3\'>C</a><a data-href="/n" href=/4>D</a>'
     '<!-- <a href="/hidden"></a> --><a href="/it\'s?a=1&amp;b=2">E</a></h3><script>"<h3 class=title-news><a href=/x>"</script>',
     ["/1", "", "", "/3", "/4", "/it's?a=1&b=2"]),
    ("p.Normal", None, "<p class='Normal'>a</p><p class='NormalX'>b</p><P CLASS='x Normal y'>c</P>", ["a", "c"]),
    ("p", None, "<pre>no</pre><p>yes</p>", ["yes"]),
    ("p", None, "a < b <p>1 < 2 <b>x</b> &lt;</p><p/><p>open <i>y <p>in</i> z", ["1 < 2x<", "", "openyin z".replace(" ", ""), "in"]),
    (".x .y", None, "<i class=y>0</i><b class='x y'>1<i class=y>2<i class=y>3</i></i></b><i class=y>4", ["23", "3"]),
    ("div p b", None, "<div><b>0</b><p><div><b>1</b></div></p></div></b><p><b>2</b></p>", ["1"]),
    ("p", None, "no tags at all", []),
    ("p", None, "<p>one</p><p cla", ["one"]),
    ("p", None, "", []),
])
def test_elements_by_selector(spark, selector, attribute, page, want):
    rows = spark.createDataFrame([(page,)], "html string").select(elements.page_tokens(F.col("html")).alias("tokens"))
    found = rows.withColumn("found", elements.matches(F.col("tokens"), F.array(elements.path_column(selector))))
    values = elements.element_attributes(F.col("tokens"), F.col("found"), attribute) if attribute else F.transform(
        "found", lambda e: elements.element_text(F.col("tokens"), e))
    assert found.select(values).first()[0] == want


def test_places_of_several_selectors(spark):
    rows = spark.createDataFrame([("<a><b>x</b><a>y</a>z",)], "html string").select(elements.page_tokens(F.col("html")).alias("t"))
    paths = F.array(*[elements.path_column(s) for s in ("a", "a b", "a a", "c")])
    found = rows.select(elements.matches(F.col("t"), paths)).first()[0]
    assert [tuple(m) for m in found] == [(0, 0, 8), (1, 1, 3), (0, 4, 6), (2, 4, 6)]


def test_unsupported_selectors_are_refused():
    for selector in ("a > b", "a[href]", "#id", ""):
        with pytest.raises(ValueError):
            elements.selector_path(selector)


def test_element_text_has_no_separator(column_of):
    def text(trim):
        return lambda c: elements.element_text(elements.page_tokens(c), F.struct(
            F.lit(-1).alias("start"), F.lit(100).alias("stop")), trim)

    samples = [" foo <b>bar</b> &amp; ", "<script>x</script>y<!-- n -->"]
    assert column_of(text(True), samples) == ["foobar&", "y"]
    assert column_of(text(False), samples) == [" foo bar & ", "y"]
