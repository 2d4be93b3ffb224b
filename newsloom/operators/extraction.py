"""Links and article fields out of a table of raw pages.

The pages are given as rows (`url`, `html`, ...); fetching them is not part of
this. The selectors are a small table with one row per source, holding the
steps of each (`functions.elements`). A page that cannot be read is an outcome
with an `error` and no record; it does not stop the others.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import elements
from newsloom.functions.html import joined_or_default
from newsloom.functions.text import bound, trim_spaces
from newsloom.functions.urls import normalize_url
from newsloom.operators.lookup import lookup, with_keys
from newsloom.schemas import ARTICLE_CSV
from newsloom.session import materialize

# The selectors of each source.
SELECTORS = {
    "VnExpress": {
        "article_link": "h3.title-news a",
        "title": "h1.title-detail",
        "summary": "p.description",
        "content": "article.fck_detail p.Normal",
        "published_at": "span.date",
        "author": "p.Normal strong",
        "tags": "div.tags h4.item-tag a",
    },
    "TuoiTre": {
        "article_link": "h3.box-title-text a",
        "title": "h1.article-title",
        "summary": "h2.detail-sapo",
        "content": "div.detail-content p",
        "published_at": "div.detail-time",
        "author": "div.author-info a.name",
        "tags": "div.detail-tab a",
    },
}
# The items of the home page.
HOME_ITEM = "article.item-news"
HOME_TITLE = "h3.title-news a"
HOME_SUMMARY = "p.description a"
HOME_SOURCE = "VnExpress"
HOME_CATEGORY = "Trang chủ"
HOME_LIMIT = 5
# End of fixed values.

FIELDS = ["title", "summary", "content", "published_at", "author", "tags"]

NOT_FETCHED = "Page not fetched"
NOT_TEXT = "Page is not text"


def selector_catalogue(spark: SparkSession,
                       selectors: Mapping[str, Mapping[str, str]] = SELECTORS) -> DataFrame:
    """Source -> path of the link selector, and paths of the field selectors in the order of `FIELDS`."""
    rows = [
        (source, elements.selector_path(fields["article_link"]), [elements.selector_path(fields[f]) for f in FIELDS])
        for source, fields in selectors.items()
    ]
    return spark.createDataFrame(
        rows, f"source_name string, link_path {elements.PATH_TYPE}, field_paths array<{elements.PATH_TYPE}>")


def hrefs(html: Column, path: Column) -> Column:
    """The `href` of every element of a page that matches, in page order."""
    return bound(elements.page_tokens(html), lambda tokens: elements.element_attributes(
        tokens, elements.matches(tokens, F.array(path)), "href"))


def page_links(pages: DataFrame, path: Column, base_url: Column) -> DataFrame:
    """Every non-empty link that matches, in page order and with repeats, as an absolute address."""
    return (
        pages.select("*", F.posexplode(hrefs(F.col("html"), path)).alias("link_pos", "href"))
        .filter("href != ''")
        .withColumn("article_url", normalize_url(F.col("href"), base_url))
        .drop("html", "href")
    )


def article_links(listings: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Links of listing pages (`source_name`, `base_url`, `html`), each with its source's selector."""
    known = lookup(listings, catalogue.select("source_name", "link_path"), "source_name", "inner")
    return page_links(known, F.col("link_path"), F.col("base_url")).drop("link_path")


def page_fields(pages: DataFrame) -> DataFrame:
    """Replace `html` and `field_paths` by a text per field.

    Several matches stand on lines of their own, tags with commas between; `N/A` is for none.
    """
    def texts(tokens: Column) -> Column:
        def by_field(read: Column) -> Column:
            return F.array(*[
                joined_or_default(F.transform(F.filter(read, lambda e: e["path"] == i), lambda e: e["text"]),
                                  ", " if f == "tags" else "\n")
                for i, f in enumerate(FIELDS)])

        # One expression reads the elements of all fields, so the plan stays small.
        read = F.transform(elements.matches(tokens, F.col("field_paths")), lambda e: F.struct(
            e["path"].alias("path"), elements.element_text(tokens, e).alias("text")))
        return bound(read, by_field)

    kept = [c for c in pages.columns if c not in ("html", "field_paths")]
    return pages.select(*kept, bound(elements.page_tokens(F.col("html")), texts).alias("_texts")).select(
        *kept, *[F.col("_texts")[i].alias(f) for i, f in enumerate(FIELDS)])


def page_error(html: Column) -> Column:
    """Why a page cannot be read, or NULL."""
    return F.when(html.isNull(), NOT_FETCHED).when(F.contains(html, F.lit("\u0000")), NOT_TEXT)


def article_outcomes(pages: DataFrame, catalogue: DataFrame, run_id: str,
                     crawled_at: Column | None = None) -> DataFrame:
    """Raw article rows of article pages (`article_url`, `source_name`, `category_name`, `html`), with `error`.

    A page with an error has no fields; pages of sources without selectors give no row.
    """
    known = lookup(pages, catalogue.select("source_name", "field_paths"), "source_name", "inner")
    error = page_error(F.col("html"))
    named = known.select("article_url", "source_name", "category_name", "field_paths", error.alias("error"),
                         F.when(error.isNull(), F.col("html")).alias("html"))
    return page_fields(named).select(
        "article_url",
        F.col("source_name").alias("source_name_raw"),
        F.col("category_name").alias("category_raw"),
        *[F.when(F.col("error").isNull(), F.col(f)).alias(f"{f}_raw") for f in FIELDS],
        (crawled_at if crawled_at is not None else F.current_timestamp()).alias("scraped_at"),
        F.lit(run_id).alias("run_id"),
        "error",
    )


def article_records(pages: DataFrame, catalogue: DataFrame, run_id: str,
                    crawled_at: Column | None = None) -> DataFrame:
    """The raw article rows of all pages that can be read."""
    return article_outcomes(pages, catalogue, run_id, crawled_at).filter("error IS NULL").drop("error")


def last_versions(pages: DataFrame, address: str = "url") -> DataFrame:
    """`address`, `html`: one row of each page, the last by `crawled_at` if there is such a column; one with content goes first."""
    when = [F.col("crawled_at")] if "crawled_at" in pages.columns else []
    return pages.groupBy(address).agg(
        F.max_by("html", F.struct(F.col("html").isNotNull(), *when, F.xxhash64("html"))).alias("html"))


def crawl_outcomes(jobs: DataFrame, pages: DataFrame, catalogue: DataFrame, run_id: str,
                   crawled_at: Column | None = None) -> DataFrame:
    """All jobs: start page -> links -> article pages -> raw article rows, with the job's `config_id`, and `error`.

    `pages` (`url`, `html`) holds listing and article pages alike. Its rows are cut down to start pages, and then to
    linked pages, by sets of addresses that are broadcast while they are small, so the others are not moved. A page is
    read once for each source that links to it, however often it is stored; its record is then joined to all links. A
    link to a page that is not there has an error.
    """
    by_start = pages.withColumnRenamed("url", "category_url")
    starts = jobs.join(last_versions(with_keys(by_start, jobs, ["category_url"]), "category_url"), "category_url")
    links = materialize(article_links(starts, catalogue).select(
        "config_id", "source_name", "category_name", "article_url"), "crawl-links")

    wanted = materialize(links.select("article_url", "source_name").distinct(), "crawl-wanted")
    by_link = with_keys(pages.withColumnRenamed("url", "article_url"), wanted, ["article_url"])
    linked = wanted.join(last_versions(by_link, "article_url"), "article_url", "left").withColumn(
        "category_name", F.lit(None).cast("string"))
    # Written, so that a page with very many links is split when it is joined.
    records = materialize(
        article_outcomes(linked, catalogue, run_id, crawled_at).drop("category_raw"), "crawl-records")
    named = links.withColumnsRenamed({"source_name": "source_name_raw", "category_name": "category_raw"})
    return named.join(records, ["article_url", "source_name_raw"]).select(*ARTICLE_CSV, "config_id", "error")


def crawl(jobs: DataFrame, pages: DataFrame, catalogue: DataFrame, run_id: str,
          crawled_at: Column | None = None) -> DataFrame:
    """The raw article rows of all jobs, with the job's `config_id`."""
    return crawl_outcomes(jobs, pages, catalogue, run_id, crawled_at).filter("error IS NULL").drop("error")


def home_items(pages: DataFrame, crawled_at: Column, limit: int = HOME_LIMIT,
               item: str = HOME_ITEM, title: str = HOME_TITLE, summary: str = HOME_SUMMARY) -> DataFrame:
    """The first `limit` items of each home page; those of them without a title are then left out."""
    paths = F.array(*[elements.path_column(s) for s in (item, f"{item} {title}", f"{item} {summary}")])

    def text(tokens: Column, element: Column) -> Column:
        return trim_spaces(elements.element_text(tokens, element, trim_pieces=False))

    def items(tokens: Column) -> Column:
        def with_parts(found: Column) -> Column:
            def parts(outer: Column) -> Column:
                def first(path: int) -> Column:
                    return F.get(F.filter(elements.of_path(found, path), lambda m: (
                        m["start"] > outer["start"]) & (m["start"] < outer["stop"])), F.lit(0))

                return bound(first(1), lambda head: F.when(head.isNotNull(), F.struct(
                    elements.attribute(F.get(tokens, head["start"]), "href").alias("href"),
                    text(tokens, head).alias("title"),
                    bound(first(2), lambda e: F.when(e.isNotNull(), text(tokens, e))).alias("summary"))))

            return F.transform(F.slice(elements.of_path(found, 0), 1, limit), parts)

        return bound(elements.matches(tokens, paths), with_parts)

    return (
        pages.select("*", F.posexplode(bound(elements.page_tokens(F.col("html")), items)).alias("item_pos", "item"))
        .filter(F.col("item").isNotNull())
        .select(
            *[c for c in pages.columns if c != "html"],
            "item_pos",
            F.col("item.href").alias("article_url"),
            F.lit(HOME_SOURCE).alias("source_name_raw"),
            F.lit(HOME_CATEGORY).alias("category_raw"),
            F.lit("").alias("author_raw"),
            crawled_at.alias("published_at_raw"),
            F.col("item.title").alias("title_raw"),
            F.coalesce("item.summary", F.lit("")).alias("summary_raw"),
            F.lit("").alias("content_raw"),
        )
    )
