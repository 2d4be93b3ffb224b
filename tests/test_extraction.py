from html.parser import HTMLParser

from pyspark.sql import functions as F

from newsloom.operators import crawl_jobs, extraction

LISTING = """<h3 class="title-news"><a href="/a1">One</a></h3><h3 class="title-news"><a href="">none</a></h3>
<h3 class="title-news"><a href="https://vn/a2">Two</a></h3><h3 class="title-news"><a href="/a1">One</a></h3>
<h3 class="title-news"><a href="/gone">Gone</a></h3>"""
ARTICLE_1 = """<h1 class="title-detail"> First </h1><p class="description">Sum &amp; up</p><span class="date">Thứ hai</span>
<article class="fck_detail"><p class="Normal">One <b>two</b></p><p class="Other">x</p>
<p class="Normal"><strong>Writer</strong></p></article>
<div class="tags"><h4 class="item-tag"><a>xe</a></h4><h4 class="item-tag"><a> nhà </a></h4></div>"""
ARTICLE_2 = "<h1>no class</h1>"


def tables(spark):
    config = spark.createDataFrame(
        [(1, "VnExpress", "https://vn", True), (2, "TuoiTre", "https://tt", False), (3, "Other", "https://ot", True)],
        "config_id int, source_name string, base_url string, active boolean")
    categories = spark.createDataFrame(
        [(1, "Xe", "https://vn/xe", True), (1, "Off", "https://vn/off", False), (2, "B", "https://tt/b", True),
         (3, "C", "https://ot/c", True), (1, "Zero", "https://vn/zero", True), (1, "Gone", "https://vn/none", True)],
        "config_id int, category_name string, category_url string, active boolean")
    pages = spark.createDataFrame(
        [("https://vn/xe", LISTING), ("https://vn/zero", "<p>nothing</p>"), ("https://vn/a1", ARTICLE_1),
         ("https://vn/a2", ARTICLE_2), ("https://vn/gone", None)], "url string, html string")
    return config, categories, pages


def test_jobs(spark):
    config, categories, _ = tables(spark)
    jobs = crawl_jobs.crawl_jobs(config, categories)
    catalogue = extraction.selector_catalogue(spark)
    assert {(r.config_id, r.category_name) for r in jobs.collect()} == {
        (1, "Xe"), (1, "Zero"), (1, "Gone"), (3, "C")}
    assert {r.category_name for r in crawl_jobs.jobs_with_selectors(jobs, catalogue).collect()} == {"Xe", "Zero", "Gone"}
    assert [r.source_name for r in crawl_jobs.jobs_without_selectors(jobs, catalogue).collect()] == ["Other"]


def test_crawl(spark):
    config, categories, pages = tables(spark)
    catalogue = extraction.selector_catalogue(spark)
    jobs = crawl_jobs.jobs_with_selectors(crawl_jobs.crawl_jobs(config, categories), catalogue.select("source_name"))
    # A page stored twice counts once.
    outcomes = extraction.crawl_outcomes(jobs, pages.unionByName(pages), catalogue, "r1").orderBy("article_url").collect()
    rows = [r for r in outcomes if r.error is None]
    # The repeated link gives a second row, the page without content none.
    assert [r.article_url for r in rows] == ["https://vn/a1", "https://vn/a1", "https://vn/a2"]
    assert [(r.article_url, r.error, r.title_raw) for r in outcomes if r.error] == [("https://vn/gone", "Page not fetched", None)]
    first, last = rows[0], rows[-1]
    assert (first.title_raw, first.summary_raw, first.content_raw, first.author_raw, first.tags_raw) == (
        "First", "Sum & up", "Onetwo\nWriter", "Writer", "xe, nhà")
    assert (first.source_name_raw, first.category_raw, first.run_id) == ("VnExpress", "Xe", "r1")
    assert {last[f"{f}_raw"] for f in extraction.FIELDS} == {"N/A"}


def test_a_bad_page_costs_its_record_only(spark):
    jobs = spark.createDataFrame([(1, "VnExpress", "https://vn", "B", "https://vn/b")],
                                 "config_id int, source_name string, base_url string, category_name string, category_url string")
    listing = "".join(f'<h3 class="title-news"><a href="/{i}">x</a></h3>' for i in range(4))
    good = '<h1 class="title-detail">T</h1>'
    pages = spark.createDataFrame([("https://vn/b", listing), ("https://vn/0", good), ("https://vn/1", good + "\0"),
                                   ("https://vn/2", None)], "url string, html string")
    outcomes = extraction.crawl_outcomes(jobs, pages, extraction.selector_catalogue(spark), "r1")
    assert {(r.article_url[-1], r.title_raw, r.error) for r in outcomes.collect()} == {
        ("0", "T", None), ("1", None, "Page is not text"), ("2", None, "Page not fetched"), ("3", None, "Page not fetched")}
    named = outcomes.select("config_id", F.col("source_name_raw").alias("source_name"), "error")
    row, = crawl_jobs.job_summary(jobs.select("config_id", "source_name"), named, ["config_id", "source_name"]).collect()
    assert (row.status, row.extracted, row.note) == ("SUCCESS", 1, "Pages failed: 3")


def test_the_last_version_of_a_page_counts(spark):
    pages = spark.createDataFrame([("u", "old", 1), ("u", "new", 3), ("u", None, 4), ("v", None, 1)],
                                  "url string, html string, crawled_at int")
    assert sorted(map(tuple, extraction.last_versions(pages).collect())) == [("u", "new"), ("v", None)]


def test_crawl_of_nested_pages(spark):
    page = """<![odd[ x ]]><h1 class="article-title">T</h1><div class="detail-content"><div>in</div><p>one<p>two <b>bold</b></div>
    <div class="detail-tab"><div><a>x</a></div><a>y</a></div><p>out</p>"""
    listing = '<h3 class="box-title-text"><a href="/n">N</a></h3>'
    jobs = spark.createDataFrame([(1, "TuoiTre", "https://tt", "B", "https://tt/b")],
                                 "config_id int, source_name string, base_url string, category_name string, category_url string")
    pages = spark.createDataFrame([("https://tt/b", listing), ("https://tt/n", page)], "url string, html string")
    row, = extraction.crawl(jobs, pages, extraction.selector_catalogue(spark), "r1").collect()
    builder = TreeBuilder()
    builder.feed(page.partition("]]>")[2])
    for field in extraction.FIELDS:
        texts = [n.text() for n in select(builder.root, extraction.SELECTORS["TuoiTre"][field])]
        assert row[f"{field}_raw"] == ((", " if field == "tags" else "\n").join(texts) if texts else "N/A"), field
    # Unclosed paragraphs and what lies behind an inner <div> are kept.
    assert row.content_raw == "onetwobold\ntwobold" and row.tags_raw == "x, y"


def test_job_summary(spark):
    jobs = spark.createDataFrame([(i, f"s{i}") for i in range(40)], "config_id int, source_name string")
    articles = spark.createDataFrame([(i, f"s{i}") for i in range(40) for _ in range(i % 3)], "config_id int, source_name string")
    got = crawl_jobs.job_summary(jobs, articles, ["config_id", "source_name"]).orderBy("config_id").collect()
    total = 0
    for row in got:
        n = row.config_id % 3
        total += n
        assert (row.extracted, row.loaded, row.note) == ((n, total, None) if n else (0, 0, "No article found"))


def test_home_items_limit_before_filter(spark):
    def item(i, title=True, summary=True):
        head = f'<h3 class="title-news"><a href="/n{i}"> T{i} <b>x</b></a></h3>' if title else ""
        return f'<article class="item-news">{head}{"<p class=description><a> S </a></p>" if summary else ""}</article>'
    page = item(1) + item(2, title=False) + item(3, summary=False) + item(4)
    pages = spark.createDataFrame([("u", page)], "url string, html string")
    rows = extraction.home_items(pages, F.lit("now"), limit=3).orderBy("item_pos").collect()
    assert [(r.article_url, r.title_raw, r.summary_raw, r.category_raw) for r in rows] == [
        ("/n1", "T1 x", "S", "Trang chủ"), ("/n3", "T3 x", "", "Trang chủ")]


class Node:
    def __init__(self, tag, classes, parent):
        self.tag, self.classes, self.parent, self.children = tag, classes, parent, []

    def walk(self):
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.walk()

    def text(self):
        return "".join(c.text() if isinstance(c, Node) else c.strip() for c in self.children
                       if not (isinstance(c, Node) and c.tag in ("script", "style")))


class TreeBuilder(HTMLParser):
    """A whole tree in memory, to check the one-pass reader against."""

    def __init__(self):
        super().__init__()
        self.root = self.at = Node("", [], None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, (dict(attrs).get("class") or "").split(), self.at)
        self.at.children.append(node)
        if tag not in ("br", "img", "meta", "link"):
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def select(root, selector):
    steps = [s.partition(".")[::2] for s in selector.split()]
    fits = lambda n, s: s[0] == n.tag and (not s[1] or s[1] in n.classes)
    for node in root.walk():
        if fits(node, steps[-1]):
            up, left = node.parent, steps[:-1]
            while up is not None and left:
                if fits(up, left[-1]):
                    left = left[:-1]
                up = up.parent
            if not left:
                yield node


def test_nested_pages_like_a_tree(spark):
    from newsloom.plans.queries import SITE_SELECTORS, _site_pages
    pages = _site_pages(spark, "/root/testdata/sf0.001").withColumnsRenamed({"url": "article_url", "base_url": "category_name"})
    nested = """<div class="ad">a<div class="ad">b</div>c</div><article><h1>x<p>open<p>two</article><p>out</p>
    <nav><a>1</a><a>2 <script>no()</script>3</a></nav>"""
    extra = spark.createDataFrame([(0, "n", nested, "b", "com"), (0, "none", None, "b", "com"), (0, "other", "<p>", "b", "xyz")],
                                  "page_id long, article_url string, html string, category_name string, source_name string")
    catalogue = extraction.selector_catalogue(spark, SITE_SELECTORS)
    got = {r.article_url: r for r in extraction.article_records(
        pages.select(extra.columns).unionByName(extra), catalogue, "r").collect()}
    wanted = [r for r in pages.select(extra.columns).collect()] + [r for r in extra.collect() if r.article_url == "n"]
    assert len(got) == len(wanted)
    for page in wanted:
        builder = TreeBuilder()
        builder.feed(page.html)
        builder.close()
        for field in extraction.FIELDS:
            texts = [n.text() for n in select(builder.root, SITE_SELECTORS[page.source_name][field])]
            want = (", " if field == "tags" else "\n").join(texts) if texts else "N/A"
            assert got[page.article_url][f"{field}_raw"] == want, (page.article_url, field)
    assert got["n"].summary_raw == "abc\nb" and got["n"].content_raw == "opentwo\ntwo"
