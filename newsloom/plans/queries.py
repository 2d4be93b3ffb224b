"""The operators run over the test tables.

The test tables are not news tables, so each stands in for one: `pages` for raw
pages, `documents` and `conversations` for texts, `orders` for articles with
`lineitem` and `part` for their tags, `supplier` and `lineitem` for the crawl
configuration, `events` for the run log.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import dates, elements, html, nulls, tags, text, urls
from newsloom.operators import (
    crawl_jobs, date_dim, delta, dimensions, extraction, mart, runlog, staging, tag_bridge, warehouse,
)
from newsloom.operators.lookup import lookup, with_keys
from newsloom.schemas import (
    ARTICLE_CSV, ARTICLE_ID, CLEAN_COLUMNS, DELTA_COLUMNS, MART_AGGREGATE, dimension,
)
from newsloom.session import materialize, materialize_observed, scratch_path, spread, tune
from newsloom.sources import csv_files, newest, publication, tables
from newsloom.streaming import article_files

RUN_ID = "run-1"
DAY_1 = datetime(2024, 1, 1, 6, 0, 0)
DAY_2 = datetime(2024, 1, 2, 6, 0, 0)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with long texts, ready for work on each of them."""
    return spread(_table(spark, sf_dir, name))


def _fresh_database(spark: SparkSession, label: str) -> str:
    """A database of its own in the shared folder."""
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


# --- stand-ins --------------------------------------------------------------------------------

def _article_id(name: str, prefix: str) -> list[Column]:
    """The key columns of an article, with keys forced to be equal for every 500th address."""
    return [(F.col(name) % 500).alias("article_key"), urls.address_mark(F.concat(F.lit(prefix), name)).alias("address_mark")]


def _order_facts(spark: SparkSession, d: str) -> DataFrame:
    """Orders as articles: key, month, category name and source key."""
    customers = _table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                                    F.col("c_nationkey").alias("source_key"))
    orders = _table(spark, d, "orders").select(
        *_article_id("o_orderkey", "order/"), "o_custkey",
        F.year("o_orderdate").alias("article_year"), F.month("o_orderdate").alias("article_month"),
        F.col("o_orderpriority").alias("category_name"))
    return lookup(orders, customers, "o_custkey", "inner").drop("o_custkey")


def _order_tags(spark: SparkSession, d: str) -> DataFrame:
    """The words of the ordered parts' names as tags of an order."""
    words = _table(spark, d, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.array_distinct(F.split("p_name", " ")).alias("words"))
    lines = _table(spark, d, "lineitem").select(*_article_id("l_orderkey", "order/"), "l_partkey")
    return lookup(lines, words, "l_partkey", "inner").select(
        *ARTICLE_ID, F.explode("words").alias("tag_name"))


def _order_articles(spark: SparkSession, d: str, price: Column, scraped_at: datetime) -> DataFrame:
    """Orders as transformed article rows with the price as title."""
    return _table(spark, d, "orders").select(
        F.concat(F.lit("order/"), "o_orderkey").alias("article_url"),
        F.col("o_orderpriority").alias("source_name"),
        F.col("o_orderstatus").alias("category_name"),
        F.when(F.col("o_orderstatus") == "P", "N/A").otherwise(F.concat(F.lit("by "), "o_custkey")).alias("author_name"),
        F.col("o_orderdate").cast("timestamp").alias("published_at"),
        price.cast("string").alias("title"),
        F.lit("").alias("description"),
        F.lit("").alias("content"),
        F.lit(scraped_at).alias("scraped_at"),
        F.lit(RUN_ID).alias("run_id"),
        F.lit("N/A").alias("tags"),
    )


def _raised() -> Column:
    """The price after urgent orders went up."""
    price = F.col("o_totalprice")
    return F.when(F.col("o_orderpriority") == "1-URGENT", price + 1).otherwise(price)


def _document_rows(documents: DataFrame) -> DataFrame:
    """Documents as raw article rows, without author and tags."""
    return documents.select(
        F.concat(F.lit("doc/"), F.lpad("doc_id", 12, "0")).alias("article_url"),
        F.col("source").alias("source_name_raw"),
        F.when(F.col("lang") != "es", F.col("lang")).alias("category_raw"),
        F.lit("2024-01-01 06:00:00").alias("published_at_raw"),
        F.concat(F.lit("no. "), "doc_id").alias("title_raw"),
        F.lit("N/A").alias("summary_raw"),
        F.col("text").alias("content_raw"),
        F.lit("2024-01-01 06:00:00").alias("scraped_at"),
        F.lit("crawl-1").alias("run_id"),
    )


def _document_articles(spark: SparkSession, d: str) -> DataFrame:
    """The same; some have a second row with a missing text."""
    rows = _document_rows(_texts(spark, d, "documents"))
    blank = rows.filter(F.col("source_name_raw").isin("src3", "src7")).withColumns({
        "article_url": F.concat("article_url", F.lit("/blank")),
        "content_raw": F.when(F.col("source_name_raw") == "src7", ""),
    })
    return rows.unionByName(blank)


def _part_delta(spark: SparkSession, d: str) -> DataFrame:
    """Parts as delta rows; some have no tags, some only unknown ones, and some come twice."""
    part = _table(spark, d, "part")
    first = part.select(
        *_article_id("p_partkey", "part/"),
        F.when(F.col("p_type") == "SMALL", F.lit(None).cast("string")).when(F.col("p_type") == "ECONOMY", "")
        .when(F.col("p_brand") == "Brand#5", " never seen,")
        .otherwise(F.replace("p_name", F.lit(" "), F.lit(", "))).alias("tags"))
    again = part.filter("p_size > 40").select(
        *_article_id("p_partkey", "part/"), F.substring_index("p_name", " ", 1).alias("tags"))
    return first.unionByName(again)


def _part_dim_tag(spark: SparkSession, d: str) -> DataFrame:
    """Words of the part names, but for those in `r`, numbered by name."""
    words = _table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("tag_name")).filter(
        ~F.startswith("tag_name", F.lit("r")))
    return dimensions.extended(spark.createDataFrame([], dimension("tag")), words, "tag_key", "tag_name")


def _part_bridge(spark: SparkSession, d: str, dim_tag: DataFrame) -> DataFrame:
    """Bridge of the smaller parts: all words, or only the last for some brands."""
    words = F.when(F.col("p_brand").isin("Brand#1", "Brand#2"),
                   F.array(F.substring_index("p_name", " ", -1))).otherwise(F.split("p_name", " "))
    names = _table(spark, d, "part").filter("p_size <= 45").select(
        *_article_id("p_partkey", "part/"), F.explode(words).alias("tag_name"))
    return tag_bridge.known_tags(names, dim_tag).select(*ARTICLE_ID, "tag_key").distinct()


def _compared_tags(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    dim_tag = _part_dim_tag(spark, d)
    bridge = _part_bridge(spark, d, dim_tag)
    sets = materialize(tag_bridge.new_tag_sets(_part_delta(spark, d), dim_tag), "tag-sets")
    return bridge, tag_bridge.compare_with_bridge(sets, bridge)


# --- aggregates -------------------------------------------------------------------------------

def agg_mart_monthly(spark: SparkSession, d: str) -> DataFrame:
    return mart.monthly_counts(_order_facts(spark, d), _order_tags(spark, d), "category_name", "tag_name")


def top_trends(spark: SparkSession, d: str) -> DataFrame:
    return mart.top_trends(agg_mart_monthly(spark, d), 3, "tag_name")


# --- text -------------------------------------------------------------------------------------

def article_key(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "pages").select("page_id", urls.article_key(F.col("url")).alias("article_key"))


def clean_html(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d, "pages").select("page_id", html.clean_content(F.col("html")).alias("content"))


def html_text(spark: SparkSession, d: str) -> DataFrame:
    """The markup steps alone."""
    return _texts(spark, d, "pages").select(
        "page_id", text.normalize_spaces(html.html_to_text(F.col("html"))).alias("content"))


def entity_text(spark: SparkSession, d: str) -> DataFrame:
    """Numeric references of 2 to 12 digits, with leading zeros and out of range, before every document's text."""
    letter = F.col("doc_id") % 26
    said = F.concat(
        F.lit("&#"), F.lpad((letter + 65).cast("string"), 2 + F.col("doc_id") % 11, "0"), F.lit(";x&#x"),
        F.lpad(F.hex(letter + 97), 2 + F.col("doc_id") % 9, "0"), F.lit(";&#"), F.col("doc_id") + 99999999, F.lit(";"),
        F.replace("text", F.lit("&"), F.lit("+")))
    return _texts(spark, d, "documents").select("doc_id", html.decode_entities(said).alias("text"))


def player_texts(spark: SparkSession, d: str) -> DataFrame:
    """Conversations with a player's boilerplate around each text."""
    wrapped = F.concat(F.lit("VIDEO player is loading.\n"), "role", F.lit(" end of Dialog window "), "text",
                       F.lit(" This is a modal window.\nClose End of dialog window"))
    return _texts(spark, d, "conversations").select(
        "conv_id", "turn", html.drop_player_texts(wrapped).alias("content"))


def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d, "documents").select("doc_id", text.tidy_sentence(F.col("text")).alias("content"))


def token_spacing(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d, "documents").select("doc_id", text.space_tokens(F.col("text")).alias("content"))


def split_case_boundary(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d, "documents").select(
        "doc_id", text.split_case_boundary(F.col("text")).alias("content"))


def fix_quotes(spark: SparkSession, d: str) -> DataFrame:
    quoted = F.concat(F.lit("“"), "text", F.lit("” ‘"), "role", F.lit("’"))
    return _texts(spark, d, "conversations").select(
        "conv_id", "turn", text.straighten_quotes(quoted).alias("content"))


def parse_published_at(spark: SparkSession, d: str) -> DataFrame:
    parsed = _table(spark, d, "orders").select("o_orderkey", _date_text().alias("published_at")).withColumn(
        "published_at", dates.parse_time(F.col("published_at")))
    return parsed.select(
        "o_orderkey", dates.time_text(F.col("published_at")).alias("published_at"),
        F.year("published_at").alias("article_year"), F.month("published_at").alias("article_month"))


def _date_text() -> Column:
    """The order date in one of two formats, or not at all."""
    return F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).when(
        F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "dd/MM/yyyy HH:mm")).otherwise("N/A")


# --- extraction -------------------------------------------------------------------------------

# Sites are told apart by their top-level domain; the author of the test pages is not marked up.
SITE_SELECTORS = {
    site: {"article_link": link, "title": "article h1", "summary": "div.ad", "content": "article p",
           "published_at": "footer", "author": "span.author", "tags": "nav a"}
    for site, link in {"com": "nav a", "net": "ul li a", "org": "a"}.items()
}


def _site_pages(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d, "pages").select(
        "page_id", "url", "html",
        urls.site_root(F.col("url")).alias("base_url"),
        F.regexp_extract("url", r"^[a-z]+://[^/]*\.([a-z]+)/", 1).alias("source_name"))


def extract_links(spark: SparkSession, d: str) -> DataFrame:
    catalogue = extraction.selector_catalogue(spark, SITE_SELECTORS)
    return extraction.article_links(_site_pages(spark, d), catalogue).select(
        "page_id", "source_name", "link_pos", "article_url")


def normalize_url_variants(spark: SparkSession, d: str) -> DataFrame:
    bare = F.regexp_replace("url", r"^[a-z]+://[^/]*/", "")
    forms = F.array(F.col("url"), F.regexp_replace("url", "^[a-z]+:", ""), F.concat(F.lit("/"), bare), bare)
    return (
        _table(spark, d, "pages")
        .select("page_id", urls.site_root(F.col("url")).alias("base_url"), F.posexplode(forms).alias("form", "href"))
        .select("page_id", "form", urls.normalize_url(F.col("href"), F.col("base_url")).alias("article_url"))
    )


def _article_fields(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """What the daily job reads from article pages."""
    named = pages.withColumnsRenamed({"url": "article_url", "base_url": "category_name"})
    catalogue = extraction.selector_catalogue(spark, SITE_SELECTORS)
    return extraction.article_records(named, catalogue, RUN_ID, F.lit("2024-01-01 06:00:00")).select(*ARTICLE_CSV)


def extract_fields(spark: SparkSession, d: str) -> DataFrame:
    return _article_fields(spark, _site_pages(spark, d))


def extract_fields_nested(spark: SparkSession, d: str) -> DataFrame:
    """The same from pages that hold elements in others of their kind and elements without an end tag."""
    put_in = F.concat(F.lit('<div class="x ad"><div>in '), "page_id", F.lit(
        '</div>on<br><DIV CLASS=\'ad\'>more<span class="author">A &amp; B</div></div><nav><a href="x">t<a>u</nav><footer>'))
    pages = _site_pages(spark, d)
    return _article_fields(spark, pages.withColumn("html", F.replace("html", F.lit("<footer>"), put_in)))


def home_page_items(spark: SparkSession, d: str) -> DataFrame:
    """The first three menu items of each page; an item without link would be left out."""
    return extraction.home_items(
        _texts(spark, d, "pages"), F.lit("2024-01-01 06:00:00"), limit=3, item="li", title="a", summary="b a",
    ).drop("url")


def first_links_per_page(spark: SparkSession, d: str) -> DataFrame:
    """The first five links of each page, and then those of them that do not end in a comma."""
    links = extraction.hrefs(F.col("html"), elements.path_column("a"))
    return (
        _texts(spark, d, "pages")
        .select("page_id", F.posexplode(F.slice(links, 1, 5)).alias("pos", "href"))
        .filter(~F.endswith("href", F.lit(",")))
    )


# --- crawl jobs -------------------------------------------------------------------------------

def _crawl_config(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    config = _table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("config_id"), F.concat(F.lit("src"), "s_nationkey").alias("source_name"),
        F.concat(F.lit("https://s"), "s_suppkey", F.lit(".example.com")).alias("base_url"),
        (F.col("s_acctbal") > 0).alias("active"))
    categories = _table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("config_id"), F.col("l_returnflag").alias("category_name"),
        F.concat(F.lit("/"), "l_returnflag").alias("category_url"),
        (F.col("l_linestatus") == "O").alias("active")).distinct()
    return config, categories


def crawl_job_list(spark: SparkSession, d: str) -> DataFrame:
    return crawl_jobs.crawl_jobs(*_crawl_config(spark, d))


def _some_selectors(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "nation").filter("n_regionkey <> 0").select(
        F.concat(F.lit("src"), "n_nationkey").alias("source_name"), F.col("n_name").alias("selector"))


def jobs_with_selectors(spark: SparkSession, d: str) -> DataFrame:
    return crawl_jobs.jobs_with_selectors(crawl_job_list(spark, d), _some_selectors(spark, d)).select(
        "config_id", "category_name", "source_name", "selector")


def jobs_missing_selector(spark: SparkSession, d: str) -> DataFrame:
    return crawl_jobs.jobs_without_selectors(crawl_job_list(spark, d), _some_selectors(spark, d)).select(
        "config_id", "category_name", "source_name")


def job_running_total(spark: SparkSession, d: str) -> DataFrame:
    """Jobs are the pairs of source and language; what they brought in are the texts labelled good."""
    documents = _table(spark, d, "documents").select("doc_id", "source", "lang")
    good = _table(spark, d, "labels").filter("quality = 1").select("doc_id")
    return crawl_jobs.job_summary(
        documents.select("source", "lang").distinct(), documents.join(good, "doc_id", "left_semi"),
        ["source", "lang"])


def _crawl_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Jobs and pages of a crawl: a listing for each 50 pages, some links twice, every fifth listing missing.

    The configuration was loaded twice; the older one has no active source. The categories were, too.
    """
    pages = _texts(spark, d, "pages").select("page_id", "url", "html")
    place = F.floor(F.col("page_id") / 50).cast("bigint").alias("config_id")
    item = F.concat(F.lit('<li><a href="'), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit('">more</a></li>'))
    items = F.repeat(item, F.when(F.col("page_id") % 7 == 0, 2).otherwise(1))
    listings = pages.groupBy(place).agg(F.array_join(F.sort_array(F.collect_list(items)), "").alias("items")).select(
        "config_id", F.concat(F.lit("https://list.example/"), "config_id").alias("url"),
        F.concat(F.lit("<nav><ul>"), "items", F.lit("</ul></nav>")).alias("html"))
    listings = materialize(listings, "listings")
    new = listings.select(
        "config_id", F.get(F.array(*map(F.lit, SITE_SELECTORS)), (F.col("config_id") % 3).cast("int")).alias("source_name"),
        F.lit("https://list.example").alias("base_url"), (F.col("config_id") % 4 != 3).alias("active"),
        F.lit(DAY_2).alias("date_dim"))
    old = new.withColumns({"active": F.lit(False), "date_dim": F.lit(DAY_1)})
    categories = listings.select("config_id", F.lit("all").alias("category_name"), F.col("url").alias("category_url"),
                                 F.lit(True).alias("active"))
    jobs = materialize(crawl_jobs.crawl_jobs(new.unionByName(old), categories.unionByName(categories)), "jobs")
    there = listings.filter("config_id % 5 <> 4").select("url", "html")
    return jobs, there.unionByName(pages.select("url", "html"))


def _crawled(spark: SparkSession, jobs: DataFrame, pages: DataFrame) -> DataFrame:
    catalogue = extraction.selector_catalogue(spark, SITE_SELECTORS)
    return extraction.crawl_outcomes(jobs, pages, catalogue, RUN_ID, F.lit("2024-01-01 06:00:00"))


def crawl_articles(spark: SparkSession, d: str) -> DataFrame:
    """Article rows of all jobs; every tenth page is stored twice, and counts once."""
    jobs, pages = _crawl_tables(spark, d)
    again = _table(spark, d, "pages").filter("page_id % 10 = 0").select("url", "html")
    return _crawled(spark, jobs, pages.unionByName(again)).filter("error IS NULL").drop("error")


def crawl_job_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """How each job of the crawl ended; every ninth page cannot be read, and every eleventh was not fetched."""
    jobs, pages = _crawl_tables(spark, d)
    number = F.regexp_extract("html", r"track\(([0-9]+)\)", 1).try_cast("int")
    pages = pages.withColumn("html", F.when(number % 11 == 0, None).when(
        number % 9 == 0, F.concat("html", F.lit("\u0000"))).otherwise(F.col("html")))
    articles = _crawled(spark, jobs, pages).select(
        "config_id", F.col("source_name_raw").alias("source_name"), F.col("category_raw").alias("category_name"), "error")
    return crawl_jobs.job_summary(crawl_jobs.with_reached(jobs, pages), articles,
                                  ["config_id", "source_name", "category_name"])


# --- staging ----------------------------------------------------------------------------------

def stage_rows(spark: SparkSession, d: str) -> DataFrame:
    return staging.stage_rows(_document_articles(spark, d), RUN_ID)


def _staged_with_nulls(spark: SparkSession, d: str) -> DataFrame:
    staged = staging.stage_rows(_document_articles(spark, d), RUN_ID)
    missing = F.col("article_url").endswith("/blank") & (F.col("source_name") == "src3")
    return staged.withColumn("content", F.when(~missing, F.col("content")))


def clean_staging(spark: SparkSession, d: str) -> DataFrame:
    return staging.clean_rows(_staged_with_nulls(spark, d))


def clean_ids(spark: SparkSession, d: str) -> DataFrame:
    """Rows numbered in the order in which the documents lie in their files."""
    landed = _document_rows(_table(spark, d, "documents"))
    return staging.clean_rows_with_ids(staging.stage_rows(landed, RUN_ID)).select("id", "article_url", "source_name", "content")


def null_tokens(spark: SparkSession, d: str) -> DataFrame:
    lang = F.create_map(*[F.lit(x) for x in ("de", "N/A", "fr", "null", "es", "")])
    marked = _table(spark, d, "documents").select(
        "doc_id", F.coalesce(F.try_element_at(lang, F.col("lang")), F.col("lang")).alias("lang"), "source",
        F.when(F.col("n_chars") > 100, F.col("n_chars").cast("double")).otherwise(F.lit(float("nan"))).alias("n_chars"))
    return nulls.tokens_to_null(marked)


def null_token_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = null_tokens(spark, d)
    return rows.groupBy("source").agg(
        F.count_if(F.col("lang").isNull()).alias("no_lang"), F.count_if(F.col("n_chars").isNull()).alias("no_chars"))


def _order_clean_rows(spark: SparkSession, d: str) -> DataFrame:
    """Orders as clean rows with spaces around the names and dates as text."""
    values = {
        "article_url": F.concat(F.lit("order/"), "o_orderkey"),
        "source_name": F.concat(F.lit("  "), "o_orderpriority", F.lit("\n")),
        "category": F.concat("o_orderstatus", F.lit("\t")),
        "author": F.lit("N/A"),
        "published_at": _date_text(),
        "title": F.lit("t"), "summary": F.lit("s"), "content": F.lit(" c "),
        "tags": F.lit("N/A"), "scraped_at": F.lit("2024-01-01 06:00:00"),
    }
    return _table(spark, d, "orders").select(*[values[c].alias(c) for c in CLEAN_COLUMNS])


def transform_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = staging.transform_rows(_order_clean_rows(spark, d), RUN_ID)
    return rows.withColumns({c: dates.time_text(F.col(c)) for c in ("published_at", "scraped_at")})


def transform_run(spark: SparkSession, d: str) -> DataFrame:
    return staging.rows_per_run(staging.transform_rows(_order_clean_rows(spark, d), RUN_ID))


def rows_per_run(spark: SparkSession, d: str) -> DataFrame:
    return staging.rows_per_run(_table(spark, d, "events").select(F.col("event_type").alias("run_id")))


# --- tags -------------------------------------------------------------------------------------

def tags_present(spark: SparkSession, d: str) -> DataFrame:
    return tag_bridge.tag_names(_part_delta(spark, d)).select(*ARTICLE_ID, "tag_name")


def tag_lookup(spark: SparkSession, d: str) -> DataFrame:
    names = tag_bridge.tag_names(_part_delta(spark, d))
    return tag_bridge.known_tags(names, _part_dim_tag(spark, d)).select(*ARTICLE_ID, "tag_name", "tag_key")


def tag_bridge_sync(spark: SparkSession, d: str) -> DataFrame:
    return tag_bridge.synced_bridge(*_compared_tags(spark, d))


def tag_sync_stats(spark: SparkSession, d: str) -> DataFrame:
    return tag_bridge.sync_counts(_compared_tags(spark, d)[1])


def bridge_insert_absent(spark: SparkSession, d: str) -> DataFrame:
    dim_tag = _part_dim_tag(spark, d)
    pairs = tag_bridge.known_tags(tag_bridge.tag_names(_part_delta(spark, d)), dim_tag)
    return tag_bridge.insert_if_absent(_part_bridge(spark, d, dim_tag), pairs)


# --- delta and warehouse ----------------------------------------------------------------------

def _document_versions(spark: SparkSession, d: str, text: Column, scraped_at: datetime) -> DataFrame:
    """Documents as transformed article rows."""
    values = {
        "article_url": F.concat(F.lit("doc/"), "doc_id"), "source_name": F.col("source"), "category_name": F.col("lang"),
        "published_at": F.lit(DAY_1), "content": text, "scraped_at": F.lit(scraped_at), "run_id": F.lit(RUN_ID),
    }
    return _texts(spark, d, "documents").select(*[values.get(c, F.lit("N/A")).alias(c) for c in DELTA_COLUMNS])


def staging_delta(spark: SparkSession, d: str) -> DataFrame:
    """The new load holds every document, the German ones longer, and as it was the day before.

    What the warehouse knows: the documents that are not Spanish, as they were first.
    """
    first, longer = F.col("text"), F.when(F.col("lang") == "de", F.concat("text", F.lit(" more"))).otherwise(F.col("text"))
    known = _document_versions(spark, d, first, DAY_1).filter("category_name <> 'es'")
    marks = materialize(known.select("article_url", delta.article_mark(known).alias("row_mark")), "known-marks")
    load = materialize(_document_versions(spark, d, longer, DAY_2).unionByName(
        _document_versions(spark, d, first, DAY_1)), "transformed")
    return delta.staging_delta(load, marks).select(
        "article_url", "change", "content", dates.time_text(F.col("scraped_at")).alias("scraped_at"))


def _priced(spark: SparkSession, d: str, price: Column) -> DataFrame:
    rows = _table(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus", price.alias("o_totalprice"),
        F.year("o_orderdate").alias("o_year"))
    return rows.withColumn("row_mark", urls.row_mark("o_orderstatus", "o_totalprice", "o_year"))


def warehouse_upsert(spark: SparkSession, d: str) -> DataFrame:
    current = _priced(spark, d, F.col("o_totalprice")).filter("o_orderstatus <> 'P'")
    changes = delta.find_changes(_priced(spark, d, _raised()), current, ["o_orderkey"], "row_mark")
    return tables.upserted(current, changes, ["o_orderkey"]).drop("row_mark")


def merge_touched_partitions(spark: SparkSession, d: str) -> DataFrame:
    """The same in a table by year and bucket, where raised orders also move on by a year."""
    db = _fresh_database(spark, "merge_query")
    places = ["o_year", "bucket"]
    bucket = (F.col("o_orderkey") % 8).cast("int")
    current = _priced(spark, d, F.col("o_totalprice")).filter("o_orderstatus <> 'P'").withColumn("bucket", bucket)
    tables.create_table(spark, f"{db}.orders", current.schema, places)
    tables.append_rows(current, f"{db}.orders")
    moved = _priced(spark, d, _raised()).withColumn(
        "o_year", F.col("o_year") + F.when(F.col("o_totalprice") > 400000, 1).otherwise(0))
    moved = moved.withColumns({"bucket": bucket, "row_mark": urls.row_mark("o_orderstatus", "o_totalprice", "o_year")})
    changes = delta.find_changes(moved, spark.table(f"{db}.orders"), ["o_orderkey"], "row_mark")
    tables.merge_rows(spark, f"{db}.orders", changes, ["o_orderkey"], places)
    return spark.table(f"{db}.orders").drop("row_mark")


def _count_tables(spark: SparkSession, d: str, db: str) -> tuple[DataFrame, DataFrame]:
    """Orders as fact rows and their tags as bridge pairs, each in the month of its order."""
    month = ["article_year", "article_month"]
    customers = _table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                                    F.col("c_nationkey").cast("long").alias("source_key"))
    orders = lookup(_table(spark, d, "orders"), customers, "o_custkey", "inner").select(
        "o_orderkey", *_article_id("o_orderkey", "order/"), "o_orderstatus", "source_key",
        F.left("o_orderpriority", F.lit(1)).cast("long").alias("category_key"),
        F.year("o_orderdate").alias("article_year"), F.month("o_orderdate").alias("article_month"))
    words = _order_tags(spark, d).select(*ARTICLE_ID, (F.ascii("tag_name") * 100 + F.length("tag_name")).cast("long").alias("tag_key"))
    pairs = words.distinct().join(orders.select(*ARTICLE_ID, "o_orderstatus", *month), ARTICLE_ID)
    for table, rows in (("fact", orders.drop("o_orderstatus")), ("bridge", pairs.drop("o_orderstatus"))):
        tables.create_table(spark, f"{db}.{table}", rows.schema, month)
    tables.create_table(spark, f"{db}.counts", MART_AGGREGATE, month)
    return orders, pairs


def _apply_delta(spark: SparkSession, db: str, orders: DataFrame, pairs: DataFrame) -> list[tuple]:
    """Merge orders and their pairs into fact and bridge, and count the touched months anew; these months."""
    month = ["article_year", "article_month"]
    orders, pairs = materialize(orders, "delta-orders"), materialize(pairs, "delta-pairs")
    before = materialize(with_keys(
        spark.table(f"{db}.fact").select("o_orderkey", *month), orders, ["o_orderkey"]), "before")
    months = [tuple(r) for r in warehouse.touched_months(orders, before).collect()]
    tables.merge_rows(spark, f"{db}.fact", orders, ["o_orderkey"], month, written=True)
    tables.merge_rows(spark, f"{db}.bridge", pairs, ARTICLE_ID, month, written=True)
    counts = mart.recounted(spark.table(f"{db}.fact"), spark.table(f"{db}.bridge"), months)
    tables.replace_places(counts, f"{db}.counts", month, months)
    return months


def incremental_counts(spark: SparkSession, d: str) -> DataFrame:
    """Monthly counts after two deltas: first the orders not pending; then the pending ones of 2000, and some of 2001 in another category."""
    db = _fresh_database(spark, "count_query")
    orders, pairs = _count_tables(spark, d, db)
    settled = F.col("o_orderstatus") != "P"
    _apply_delta(spark, db, orders.filter(settled).drop("o_orderstatus"), pairs.filter(settled).drop("o_orderstatus"))
    late = ~settled & (F.col("article_year") == 2000)
    changed = orders.filter(settled & (F.col("article_year") == 2001) & (F.col("o_orderkey") % 7 == 0)).withColumn(
        "category_key", F.lit(9).cast("long"))
    _apply_delta(spark, db, orders.filter(late).unionByName(changed).drop("o_orderstatus"), pairs.filter(late).drop("o_orderstatus"))
    return spark.table(f"{db}.counts").select(*[f.name for f in MART_AGGREGATE.fields])


def dim_new_members(spark: SparkSession, d: str) -> DataFrame:
    """Customers in credit have keys already; the others are numbered after them."""
    customers = _table(spark, d, "customer").select(F.col("c_name").alias("author_name"), "c_acctbal")
    none = spark.createDataFrame([], dimension("author"))
    known = dimensions.extended(none, customers.filter("c_acctbal > 0"), "author_key", "author_name")
    return dimensions.new_members(known, customers, "author_key", "author_name")


def fact_dimension_keys(spark: SparkSession, d: str) -> DataFrame:
    """Order articles with the keys of their category, source, author and date."""
    buffer = materialize(nulls.tokens_to_null(_order_articles(spark, d, F.col("o_totalprice"), DAY_1)), "buffer")
    def dim(prefix: str, name: str) -> DataFrame:
        none = spark.createDataFrame([], dimension(prefix))
        return dimensions.extended(none, buffer.select(F.col(name).alias(f"{prefix}_name")),
                                   f"{prefix}_key", f"{prefix}_name")
    rows = warehouse.fact_rows(buffer, dim("category", "category_name"), dim("source", "source_name"),
                               dim("author", "author_name"))
    return rows.select(*ARTICLE_ID, "article_url", "bucket", "date_key", "category_key", "source_key", "author_key",
                       "article_year", "article_month")


# --- run log ----------------------------------------------------------------------------------

def run_state(spark: SparkSession, d: str) -> DataFrame:
    events = _table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    return runlog.latest_by(events, "user_id", "ts", "event_id").select(
        "user_id", "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


def open_runs(spark: SparkSession, d: str) -> DataFrame:
    """A signup opens a user's run, a purchase ends it."""
    event = F.when(F.col("event_type") == "signup", runlog.START).when(
        F.col("event_type") == "purchase", runlog.END)
    log = _table(spark, d, "events").select(
        F.col("user_id").alias("run_id"), event.alias("event"), F.col("ts").alias("logged_at"))
    return runlog.open_runs(log)


def run_outcome(spark: SparkSession, d: str) -> DataFrame:
    """Errors carry a text, clicks give nothing, the others rows."""
    kind = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") != "click", "rows")
    status, note = runlog.outcome(kind, F.concat(F.lit("user "), "user_id"))
    return _table(spark, d, "events").select(status.alias("status"), note.alias("note")).groupBy(
        "status", "note").agg(F.count("*").alias("n_runs"))


def run_log_counters(spark: SparkSession, d: str) -> DataFrame:
    """How the steps of a log ended: rows, none, an error that leaves the table, no result, a part of a run, no jobs."""
    db = _fresh_database(spark, "log_query")
    log = runlog.RunLog(spark, f"{db}.run_log")
    customers = _table(spark, d, "customer").select("c_custkey", "c_name")
    kept = customers.filter("c_custkey % 3 = 0")

    def load(rows: DataFrame) -> Callable[[str], tuple[int, int]]:
        def step(run_id: str) -> tuple[int, int]:
            n = tables.replace_rows(rows, f"{db}.customer")
            return n, n

        return step

    def sync(run_id: str) -> tuple[int, int]:
        bridge, compared = _compared_tags(spark, d)
        _, seen = materialize_observed(compared, "log-tags", tag_bridge.sync_metrics())
        log.note("sync_tags", f"{run_id}/tags", seen["updated"] + seen["skipped"], seen["updated"])
        return bridge.count(), seen["updated"]

    def fail(run_id: str) -> tuple[int, int]:
        broken = customers.withColumn("c_name", F.when(F.col("c_custkey") > 0, F.raise_error(F.lit("no name"))))
        return load(broken)(run_id)

    def stop(run_id: str) -> tuple[int, int]:
        raise FileNotFoundError("no article file")

    for name, step in [("empty", load(customers.limit(0))), ("customers", load(kept)), ("broken", stop), ("tags", sync),
                       ("nothing", lambda run_id: None)]:
        log.run(name, step)
    _, status = log.run("failing load", fail)
    log.check(crawl_jobs.NO_JOBS)
    rows = log.rows()
    names = rows.filter(F.col("event") == runlog.START).select("run_id", "job_name")
    ended = rows.filter((F.col("event") == runlog.END)).drop("job_name").join(names, "run_id").filter("job_name <> 'failing load'")
    left = spark.table(f"{db}.customer").select(F.lit(f"left after {status}").alias("job_name"), F.lit(None).alias("status"),
                                                F.col("c_custkey").alias("extracted"), F.lit(None).alias("loaded"),
                                                F.col("c_name").alias("error"))
    return ended.select("job_name", "status", "extracted", "loaded", "error").unionByName(left)


# --- dates ------------------------------------------------------------------------------------

def _order_calendar(spark: SparkSession, d: str) -> DataFrame:
    bounds = _table(spark, d, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day"))
    return date_dim.calendar(bounds)


def date_dimension(spark: SparkSession, d: str) -> DataFrame:
    return _order_calendar(spark, d)


def date_dim_positional(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "date-file")
    csv_files.write_wide_dates(date_dim.to_wide_rows(_order_calendar(spark, d)), path)
    return date_dim.from_wide_rows(csv_files.read_wide_dates(spark, path))


def published_page_forms(spark: SparkSession, d: str) -> DataFrame:
    """Order dates as news pages print them: with a weekday in front, or the session's offset behind."""
    date, offset = F.col("o_orderdate"), F.date_format("o_orderdate", "xxx")
    forms = F.array(
        F.concat(F.lit("Thứ hai, "), F.date_format(date, "d/M/yyyy, H:mm"), F.lit(" (GMT"), offset, F.lit(")")),
        F.concat(F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss"), offset),
        F.concat(F.lit("Thứ 7, "), F.date_format(date, "d-M-yyyy H:mm")),
        F.concat(F.lit(" "), F.date_format(date, "d/M/yyyy"), F.lit(" ")),
        F.lit("hôm qua"))
    said = _table(spark, d, "orders").select("o_orderkey", F.get(forms, (F.col("o_orderkey") % 5).cast("int")).alias("said"))
    return said.select("o_orderkey", dates.time_text(dates.parse_published(F.col("said"))).alias("published_at"))


# --- files ------------------------------------------------------------------------------------

def _document_delta(spark: SparkSession, d: str) -> DataFrame:
    """Documents as delta rows, with a language read as missing."""
    values = {
        "article_url": F.concat(F.lit("doc/"), "doc_id"),
        "source_name": F.col("source"),
        "category_name": F.when(F.col("lang") == "de", "N/A").otherwise(F.col("lang")),
        "content": F.col("text"),
        "title": F.concat(F.lit(' say "'), "doc_id", F.lit('", twice ')),
        "tags": F.when(F.col("source") == "src1", "").otherwise("a, b"),
    }
    return _table(spark, d, "documents").select(
        *[values.get(c, F.lit("x")).alias(c) for c in DELTA_COLUMNS])


def csv_delta_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "delta-file")
    csv_files.write_delta(_document_delta(spark, d), path)
    return csv_files.read_delta(spark, path)


def csv_article_scan(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "article-file")
    csv_files.write_with_header(_document_articles(spark, d), path)
    return staging.stage_rows(csv_files.read_articles(spark, path), RUN_ID)


def latest_file(spark: SparkSession, d: str) -> DataFrame:
    """Daily files by language, written one after the other; the newest, of all other languages, is read."""
    folder = scratch_path(spark, "daily-files")
    articles = _document_articles(spark, d)
    category = F.coalesce("category_raw", F.lit(""))
    for day, of_day in enumerate([category == "en", category == "de", ~category.isin("en", "de")], start=1):
        csv_files.write_with_header(articles.filter(of_day), f"{folder}/article_0{day}0124.csv")
    newest_path = newest.newest_path(spark, folder, "article_*.csv")
    return staging.stage_rows(csv_files.read_articles(spark, newest_path), RUN_ID)


def daily_article_sink(spark: SparkSession, d: str) -> DataFrame:
    """Two days are written, then the second once more with other rows."""
    path = scratch_path(spark, "article-days")
    rows = _document_articles(spark, d)
    rows = rows.select(*[nulls.column_or_blank(rows, c).alias(c) for c in ARTICLE_CSV])
    csv_files.write_daily_articles(rows, path, F.lit("010124"))
    csv_files.write_daily_articles(rows.filter("category_raw = 'en'"), path, F.lit("020124"))
    csv_files.write_daily_articles(rows.filter("category_raw = 'fr'"), path, F.lit("020124"))
    return spark.read.schema("article_url string, category_raw string, crawl_date string").parquet(path)


def streamed_staging(spark: SparkSession, d: str) -> DataFrame:
    """Two daily files taken in by two runs of the file stream."""
    folder, db = scratch_path(spark, "stream-files"), _fresh_database(spark, "stream_query")
    rows = _document_articles(spark, d)
    rows = rows.select(*[nulls.column_or_blank(rows, c).alias(c) for c in ARTICLE_CSV])
    for day, of_day in enumerate([F.col("category_raw") == "en", F.col("category_raw") != "en"], start=1):
        csv_files.write_with_header(rows.filter(of_day), f"{folder}/article_0{day}0124.csv")
        article_files.stage_new_files(spark, folder, "article_*.csv", f"{db}.staging_temp_table",
                                      f"{folder}-progress", f"run-{day}")
    return spark.table(f"{db}.staging_temp_table")


def config_append(spark: SparkSession, d: str) -> DataFrame:
    """The crawl configuration out of a file without a date, appended twice on different days."""
    path, db = scratch_path(spark, "config-file"), _fresh_database(spark, "config_query")
    config, _ = _crawl_config(spark, d)
    csv_files.write_with_header(config, path)
    for day in ("2024-01-01", "2024-01-02"):
        tables.append_rows(csv_files.read_config(spark, path, F.lit(day)), f"{db}.config_table")
    return spark.table(f"{db}.config_table")


def truncate_load(spark: SparkSession, d: str) -> DataFrame:
    """Two full loads; only the second stays."""
    db = _fresh_database(spark, "replace_query")
    rows = _table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    tables.create_table(spark, f"{db}.customer", rows.schema)
    tables.replace_rows(rows, f"{db}.customer")
    tables.replace_rows(rows.withColumn("c_name", F.lower("c_name")), f"{db}.customer")
    return spark.table(f"{db}.customer")


def append_insert(spark: SparkSession, d: str) -> DataFrame:
    """Rows appended by name in another column order, one column missing."""
    db = _fresh_database(spark, "append_query")
    rows = _table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    tables.append_rows(rows, f"{db}.customer")
    tables.append_rows(_table(spark, d, "supplier").select(
        F.col("s_name").alias("c_name"), F.col("s_suppkey").alias("c_custkey")), f"{db}.customer")
    return spark.table(f"{db}.customer")


def mart_publish(spark: SparkSession, d: str) -> DataFrame:
    """Aggregate and dimensions dumped to dated files, loaded and swapped in over older tables."""
    folder, db = scratch_path(spark, "mart-files"), _fresh_database(spark, "mart_query")
    def dim(prefix: str, names: DataFrame) -> DataFrame:
        return dimensions.extended(spark.createDataFrame([], dimension(prefix)), names,
                                   f"{prefix}_key", f"{prefix}_name")
    fact, pairs = _order_facts(spark, d), materialize(_order_tags(spark, d).distinct(), "order-tags")
    dims = {
        "DimCategory": dim("category", _table(spark, d, "orders").select(F.col("o_orderpriority").alias("category_name"))),
        "DimTag": dim("tag", pairs.select("tag_name")),
        "DimSource": dim("source", _table(spark, d, "supplier").select(F.col("s_name").alias("source_name"))),
    }
    keyed = lookup(fact, dims["DimCategory"], "category_name", "left")
    bridge = tag_bridge.known_tags(pairs, dims["DimTag"])
    frames = {"Agg_Mart_Top_Trends": mart.monthly_counts(keyed, bridge), **dims}
    paths = csv_files.mart_paths(folder, "20240101")
    csv_files.dump_tables(frames, paths)

    publication.create(spark, db, {"Agg_Mart_Top_Trends": MART_AGGREGATE, **{t: df.schema for t, df in dims.items()}})
    mart.load_mart(spark, paths, db)
    agg = spark.table(f"{db}.Agg_Mart_Top_Trends")
    parts = [agg.select(
        F.lit("Agg_Mart_Top_Trends").alias("table_name"),
        F.concat_ws("/", "article_year", "article_month", "category_key", "tag_key", "source_key").alias("member"),
        F.col("total_articles").alias("amount"))]
    for table in dims:
        key, name = spark.table(f"{db}.{table}").columns
        parts.append(spark.table(f"{db}.{table}").select(
            F.lit(table).alias("table_name"), F.col(name).alias("member"), F.col(key).alias("amount")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def publish_after_failure(spark: SparkSession, d: str) -> DataFrame:
    """Two tables published, then a publication whose second table fails: both are as before, and nothing is left over."""
    db = _fresh_database(spark, "publish_query")
    customers = _table(spark, d, "customer").select("c_custkey", F.lower("c_name").alias("c_name"))
    suppliers = _table(spark, d, "supplier").select("s_suppkey", "s_name")
    publication.publish(spark, db, {"customer": customers, "supplier": suppliers})
    broken = suppliers.withColumn("s_name", F.when(F.col("s_suppkey") > 0, F.raise_error(F.lit("no name"))))
    try:
        publication.publish(spark, db, {"customer": customers.filter("c_custkey < 9"), "supplier": broken})
    except Exception:
        loaded = spark.table(f"{db}.customer__rows").select("publication").distinct().count()
        publication.recover(spark, db)
    left = spark.table(f"{db}.customer__rows").select("publication").distinct().count()
    return spark.table(f"{db}.customer").select(
        F.lit("customer").alias("table_name"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name")).unionByName(
        spark.table(f"{db}.supplier").select(F.lit("supplier").alias("table_name"), "s_suppkey", "s_name").toDF(
            "table_name", "key", "name")).withColumns({"loaded": F.lit(loaded), "left": F.lit(left)})


def header_hygiene(spark: SparkSession, d: str) -> DataFrame:
    """A mart file with spaces in its header and columns without a real name."""
    path = scratch_path(spark, "header-file")
    rows = _table(spark, d, "customer").select(
        F.col("c_custkey").alias("Unnamed: 0"), F.col("c_custkey").alias(" c_custkey "), F.col("c_nationkey").alias("NaN"),
        F.when(F.col("c_nationkey") > 5, F.col("c_name")).alias("c_name\t"), F.lit("x").alias(" "))
    csv_files.write_with_header(rows, path)
    return csv_files.read_mart_file(spark, path)


QUERIES = {
    f.__name__: f for f in (
        agg_mart_monthly, top_trends, article_key, clean_html, html_text, entity_text, player_texts, clean_text,
        token_spacing, split_case_boundary, fix_quotes, parse_published_at, extract_links,
        normalize_url_variants, extract_fields, extract_fields_nested, home_page_items,
        first_links_per_page, crawl_articles, crawl_job_outcomes, crawl_job_list, jobs_with_selectors, jobs_missing_selector,
        job_running_total, stage_rows, clean_staging, clean_ids, null_tokens, null_token_counts,
        transform_rows, transform_run, rows_per_run, tags_present, tag_lookup, tag_bridge_sync,
        tag_sync_stats, bridge_insert_absent, staging_delta, warehouse_upsert,
        merge_touched_partitions, dim_new_members, fact_dimension_keys, run_state, open_runs,
        run_outcome, date_dimension, date_dim_positional, csv_delta_roundtrip, csv_article_scan,
        latest_file, daily_article_sink, streamed_staging, config_append, truncate_load,
        append_insert, mart_publish, incremental_counts, run_log_counters, published_page_forms, publish_after_failure,
        header_hygiene,
    )
}
