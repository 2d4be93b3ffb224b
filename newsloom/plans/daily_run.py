"""The daily jobs in their order, each between the START and END rows of the run log.

    load_config, import_dates            once, and whenever the files change
    crawl_articles -> load_staging -> transform_staging -> load_delta -> export_delta
    -> load_warehouse -> aggregate -> load_mart

Every job takes its input from a table or file that the one before has written,
so a job can be run again alone, and no job holds rows outside of Spark.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.functions.tags import split_tags
from newsloom.functions.dates import DAY_FILE_FORMAT
from newsloom.operators import (
    crawl_jobs, date_dim, delta, dimensions, extraction, mart, runlog, staging, tag_bridge, warehouse,
)
from newsloom.operators.lookup import with_keys
from newsloom.schemas import ARTICLE_ID
from newsloom.session import materialize, materialize_observed, tune
from newsloom.sources import csv_files, newest, publication, tables

FACT_PARTITIONS = ["article_year", "article_month", "bucket"]
MONTH = FACT_PARTITIONS[:2]
# Pairs lie in the month of their article, so counting some months anew reads only these.
BRIDGE_PARTITIONS = MONTH
DIMENSIONS = {"category": "DimCategory", "source": "DimSource", "author": "DimAuthor", "tag": "DimTag"}


@dataclass(frozen=True)
class Layers:
    """The catalog database of each layer."""

    control: str = "news_control"
    staging: str = "news_staging"
    warehouse: str = "news_warehouse"
    mart: str = "news_mart"

    def dim(self, prefix: str) -> str:
        return f"{self.warehouse}.{DIMENSIONS[prefix]}"

    @property
    def fact(self) -> str:
        return f"{self.warehouse}.FactArticle"

    @property
    def bridge(self) -> str:
        return f"{self.warehouse}.Bridge_Article_Tag"


class DailyRun:
    def __init__(self, spark: SparkSession, layers: Layers, folder: str,
                 selectors: Mapping[str, Mapping[str, str]] = extraction.SELECTORS):
        self.spark, self.layers = tune(spark), layers
        self.folder = folder.rstrip("/")
        self.catalogue = extraction.selector_catalogue(spark, selectors)
        # A run that broke off may have left a table aside: first that is mended.
        for database in (layers.staging, layers.warehouse):
            tables.recover(spark, database)
        self.create_tables()
        self.log = runlog.RunLog(spark, f"{layers.control}.run_log")

    def create_tables(self) -> None:
        at, spark = self.layers, self.spark
        for database in (at.control, at.staging, at.warehouse, at.mart):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for table, schema, places in [
            (f"{at.staging}.staging_temp_table", schemas.STAGING, []),
            (f"{at.staging}.staging_clean_table", schemas.CLEAN, []),
            (f"{at.staging}.transformed_temp_table", schemas.TRANSFORMED, []),
            (f"{at.staging}.staging_delta", schemas.TRANSFORMED, []),
            (f"{at.warehouse}.buffer_delta", schemas.DELTA, []),
            (f"{at.warehouse}.DimDate", schemas.DATE_DIM, []),
            (f"{at.warehouse}.Agg_Temp_Mart", schemas.MART_AGGREGATE, MONTH),
            (f"{at.warehouse}.Touched_Months", schemas.MONTH, []),
            (at.fact, schemas.ARTICLE_FACT, FACT_PARTITIONS),
            (at.bridge, schemas.BRIDGE_BY_MONTH, BRIDGE_PARTITIONS),
            *[(at.dim(p), schemas.dimension(p), []) for p in DIMENSIONS],
        ]:
            tables.create_table(spark, table, schema, places)
        publication.create(spark, at.mart, {
            "Agg_Mart_Top_Trends": schemas.MART_AGGREGATE,
            **{DIMENSIONS[p]: schemas.dimension(p) for p in ("category", "tag", "source")}})

    def table(self, name: str) -> DataFrame:
        return self.spark.table(name)

    # --- configuration --------------------------------------------------------------------

    def load_config(self, path: str, today: Column | None = None) -> None:
        """Append a configuration file to the table, whatever columns it has."""
        tables.append_rows(csv_files.read_config(self.spark, path, today), f"{self.layers.control}.config_table")

    def import_dates(self, path: str) -> int:
        """Replace the date dimension by the rows of a wide date file."""
        wide = csv_files.read_wide_dates(self.spark, path)
        return tables.replace_rows(date_dim.from_wide_rows(wide), f"{self.layers.warehouse}.DimDate")

    # --- extract --------------------------------------------------------------------------

    def crawl_articles(self, pages: DataFrame, day: Column | None = None) -> str:
        """Article rows of all active jobs out of a table of pages, into the day's folder.

        Every job gets its own START and END row with its count and the running total.
        """
        jobs = crawl_jobs.crawl_jobs(self.table(f"{self.layers.control}.config_table"),
                                     self.table(f"{self.layers.control}.crawl_categories"))
        usable = materialize(crawl_jobs.jobs_with_selectors(jobs, self.catalogue.select("source_name")), "jobs")
        if usable.isEmpty():
            return self.log.check(crawl_jobs.NO_JOBS)

        day = day if day is not None else F.date_format(F.current_date(), DAY_FILE_FORMAT)

        def step(run_id: str) -> tuple[int, int]:
            outcomes = materialize(extraction.crawl_outcomes(usable, pages, self.catalogue, run_id), "articles")
            articles = outcomes.filter("error IS NULL")
            n = csv_files.write_daily_articles(
                articles.withColumn("scraped_at", F.col("scraped_at").cast("string")), self.article_days, day)
            named = outcomes.select("config_id", F.col("source_name_raw").alias("source_name"),
                                    F.col("category_raw").alias("category_name"), "error")
            self.log.append_jobs(crawl_jobs.job_summary(
                crawl_jobs.with_reached(usable, pages), named, ["config_id", "source_name", "category_name"]), run_id)
            return n, n

        return self.log.run("crawl", step)[1]

    @property
    def article_days(self) -> str:
        return f"{self.folder}/article_days"

    # --- staging --------------------------------------------------------------------------

    def load_staging(self, path: str | None = None) -> str:
        """Replace staging by the newest article file, or the one given."""
        def step(run_id: str) -> tuple[int, int]:
            source = path or newest.newest_path(self.spark, self.folder, "article_*.csv")
            if source is None:
                raise FileNotFoundError(f"no article file in {self.folder}")
            staged = staging.stage_rows(csv_files.read_articles(self.spark, source), run_id)
            n = tables.replace_rows(staged, f"{self.layers.staging}.staging_temp_table")
            return n, n

        return self.log.run("Load_Staging", step)[1]

    def load_staging_day(self, day: str) -> str:
        """The same from the day's folder that the crawl has written; no rows if it found nothing on that day."""
        def step(run_id: str) -> tuple[int, int]:
            raw = self.spark.read.schema(schemas.text_columns(*schemas.ARTICLE_CSV, "crawl_date")).parquet(
                self.article_days).filter(F.col("crawl_date") == day)
            n = tables.replace_rows(staging.stage_rows(raw, run_id), f"{self.layers.staging}.staging_temp_table")
            return n, n

        return self.log.run("Load_Staging", step)[1]

    def transform_staging(self) -> str:
        at = self.layers.staging

        def step(run_id: str) -> tuple[int, int]:
            clean = staging.clean_rows_with_ids(self.table(f"{at}.staging_temp_table"))
            tables.replace_rows(clean, f"{at}.staging_clean_table")
            typed = staging.transform_rows(self.table(f"{at}.staging_clean_table"), run_id)
            n = tables.replace_rows(typed, f"{at}.transformed_temp_table")
            return n, n

        return self.log.run("Transform_Staging", step)[1]

    def load_delta(self) -> str:
        at = self.layers

        def step(run_id: str) -> tuple[int, int]:
            changes = delta.staging_delta(self.table(f"{at.staging}.transformed_temp_table"), self.table(at.fact))
            n = tables.replace_rows(changes.drop("row_mark", "change"), f"{at.staging}.staging_delta")
            return n, n

        return self.log.run("load_delta", step)[1]

    def export_delta(self) -> str:
        def step(run_id: str) -> tuple[int, int]:
            n = csv_files.write_delta(self.table(f"{self.layers.staging}.staging_delta"), self.delta_path)
            return n, n

        return self.log.run("export_staging_file", step)[1]

    @property
    def delta_path(self) -> str:
        return f"{self.folder}/delta_data.csv"

    # --- warehouse ------------------------------------------------------------------------

    def load_warehouse(self) -> str:
        """Delta file -> buffer -> dimensions, fact and tag bridge; loaded are the changed articles.

        The months that the run touches are noted before anything moves, for the next count.
        """
        def step(run_id: str) -> tuple[int, int]:
            at = self.layers
            extracted = tables.replace_rows(csv_files.read_delta(self.spark, self.delta_path),
                                            f"{at.warehouse}.buffer_delta")
            buffer = self.table(f"{at.warehouse}.buffer_delta")
            self._extend_dimensions(buffer)
            rows = warehouse.fact_rows(buffer, *[self.table(at.dim(p)) for p in ("category", "source", "author")])
            rows = materialize(rows, "fact-rows")
            changes, seen = materialize_observed(
                warehouse.changed_facts(rows, self.table(at.fact)), "changes", [F.count(F.lit(1)).alias("n")])
            before = materialize(with_keys(
                self.table(at.fact).select(*warehouse.FACT_KEY, *MONTH), rows, warehouse.FACT_KEY), "before")
            tables.append_rows(warehouse.touched_months(rows, before), f"{at.warehouse}.Touched_Months")
            moved = materialize(warehouse.moved_articles(changes, before), "moved")
            tables.merge_rows(self.spark, at.fact, changes.drop("change"), warehouse.FACT_KEY, FACT_PARTITIONS, written=True)
            self._sync_tags(buffer, rows, moved, run_id)
            return extracted, seen["n"]

        return self.log.run("load_warehouse", step)[1]

    def _extend_dimensions(self, buffer: DataFrame) -> None:
        tag_names = buffer.select(F.explode(split_tags(F.col("tags"))).alias("tag_name")).filter("tag_name <> ''")
        for prefix in DIMENSIONS:
            name = f"{prefix}_name"
            names = tag_names if prefix == "tag" else buffer.select(name)
            table = self.layers.dim(prefix)
            tables.append_rows(dimensions.new_members(self.table(table), names, f"{prefix}_key", name), table)

    def _sync_tags(self, buffer: DataFrame, rows: DataFrame, moved: DataFrame, run_id: str) -> None:
        """The bridge after the delta: changed tag sets replaced, and pairs of articles in a new month moved there.

        Rows that led to an update, and all rows with tags, are logged as loaded and extracted of a part of the run.
        """
        at = self.layers
        sets = materialize(tag_bridge.new_tag_sets(
            buffer.select("article_url", "tags"), self.table(at.dim("tag"))), "new-tag-sets")
        compared, seen = materialize_observed(
            tag_bridge.compare_with_bridge(sets, self.table(at.bridge)), "compared-tags", tag_bridge.sync_metrics())
        replaced = tag_bridge.replaced_articles(compared)
        pairs = tag_bridge.new_pairs(compared).join(rows.select(*ARTICLE_ID, *MONTH), ARTICLE_ID)
        staying = moved.join(replaced, ARTICLE_ID, "left_anti")
        carried = with_keys(self.table(at.bridge).select(*ARTICLE_ID, "tag_key"), moved, ARTICLE_ID).join(staying, ARTICLE_ID)
        tables.merge_rows(self.spark, at.bridge, pairs.unionByName(carried), ARTICLE_ID, BRIDGE_PARTITIONS, removed=replaced)
        self.log.note("sync_tags", f"{run_id}/tags", seen["updated"] + seen["skipped"], seen["updated"])

    # --- mart -----------------------------------------------------------------------------

    def aggregate(self, day: str) -> str:
        """Monthly counts, and the files for the mart; loaded is the number of files.

        Counted are the months that runs have touched since the last count; the others stay as they are.
        """
        def step(run_id: str) -> tuple[int, int]:
            at = self.layers
            touched = f"{at.warehouse}.Touched_Months"
            months = [tuple(r) for r in self.table(touched).distinct().collect()]  # calendar months
            rows = 0
            if months:
                counts = mart.recounted(self.table(at.fact), self.table(at.bridge), months)
                rows = tables.replace_places(counts, f"{at.warehouse}.Agg_Temp_Mart", MONTH, months)
                self.spark.sql(f"TRUNCATE TABLE {touched}")
            dims = {DIMENSIONS[p]: self.table(at.dim(p)) for p in ("category", "tag", "source")}
            frames = {"Agg_Mart_Top_Trends": self.table(f"{at.warehouse}.Agg_Temp_Mart"), **dims}
            return rows, csv_files.dump_tables(frames, csv_files.mart_paths(self.folder, day))

        return self.log.run("aggregate_to_csv", step)[1]

    def load_mart(self, day: str) -> str:
        def step(run_id: str) -> tuple[int, int]:
            n = sum(mart.load_mart(self.spark, csv_files.mart_paths(self.folder, day), self.layers.mart).values())
            return n, n

        return self.log.run("load_to_datamart", step)[1]

    def run_day(self, day: str, crawled: bool = False) -> list[str]:
        """All jobs from staging to mart for a day (yyyyMMdd); stops at the first that fails.

        Staging takes the newest article file, or, if `crawled`, what `crawl_articles` has written for that day and
        never a file.
        """
        load = self.load_staging if not crawled else lambda: self.load_staging_day(day[6:8] + day[4:6] + day[2:4])
        outcomes = []
        for job in (load, self.transform_staging, self.load_delta, self.export_delta,
                    self.load_warehouse, lambda: self.aggregate(day),
                    lambda: self.load_mart(day)):
            outcomes.append(job())
            if outcomes[-1] != runlog.SUCCESS:
                break
        return outcomes
