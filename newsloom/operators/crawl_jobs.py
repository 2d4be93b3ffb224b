"""Crawl jobs out of the configuration, and what each job brought in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.lookup import lookup, with_keys
from newsloom.operators.ordering import running_total

# Messages of the run log.
NOTHING_FOUND = "No article found"
NO_JOBS = "There are no jobs to run (Check Active=1)"
# End of fixed values.
NO_START_PAGE = "Start page not found"
PAGES_FAILED = "Pages failed:"


def crawl_jobs(config: DataFrame, categories: DataFrame) -> DataFrame:
    """One job per active category of an active source, by each source's last configuration.

    Configurations are appended with a date (`date_dim`, if the table has it), so a source may have several.
    """
    order = [c for c in ("date_dim", "active", "source_name", "base_url") if c in config.columns]
    last = config.groupBy("config_id").agg(
        F.max_by(F.struct("source_name", "base_url", "active"), F.struct(*order)).alias("c"))
    sources = last.filter("c.active").select("config_id", "c.source_name", "c.base_url")
    wanted = categories.filter("active").select("config_id", "category_name", "category_url").distinct()
    return lookup(wanted, sources, "config_id", "inner").select(
        "config_id", "source_name", "base_url", "category_name", "category_url")


def jobs_with_selectors(jobs: DataFrame, catalogue: DataFrame) -> DataFrame:
    return lookup(jobs, catalogue, "source_name", "inner")


def jobs_without_selectors(jobs: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The jobs to warn about and leave out."""
    return lookup(jobs, catalogue.select("source_name"), "source_name", "left_anti")


def with_reached(jobs: DataFrame, pages: DataFrame) -> DataFrame:
    """Add `reached`: is the job's start page among the pages (`url`, `html`), with content?"""
    there = pages.filter(F.col("html").isNotNull()).select(F.col("url").alias("category_url"))
    there = with_keys(there, jobs, ["category_url"]).distinct().withColumn("reached", F.lit(True))
    return jobs.join(there, "category_url", "left").withColumn("reached", F.coalesce("reached", F.lit(False)))


def job_summary(jobs: DataFrame, articles: DataFrame, job_key: Sequence[str]) -> DataFrame:
    """Rows per job and the running total in job order; jobs without articles are kept with 0.

    `job_key` names a job and gives the order. A job whose column `reached`, if there, is false has failed. Articles with an
    `error`, if there is such a column, do not count; the note tells their number. Articles are counted before they
    meet the jobs, so a job with very many articles adds one row per task.
    """
    error = F.col("error") if "error" in articles.columns else F.lit(None)
    counts = articles.groupBy(*job_key).agg(
        F.count_if(error.isNull()).alias("extracted"), F.count_if(error.isNotNull()).alias("failed"))
    reached = F.col("reached") if "reached" in jobs.columns else F.lit(True)
    per_job = jobs.select(*job_key, reached.alias("reached")).join(counts, list(job_key), "left").select(
        *job_key, "reached", F.coalesce("extracted", F.lit(0)).alias("extracted"), F.coalesce("failed", F.lit(0)).alias("failed"))
    total = running_total(per_job, job_key, "extracted", "so_far")
    empty = F.col("extracted") == 0
    return total.select(
        *job_key,
        F.when(F.col("reached"), "SUCCESS").otherwise("FAILED").alias("status"),
        "extracted",
        F.when(empty, F.lit(0)).otherwise(F.col("so_far")).cast("bigint").alias("loaded"),
        F.nullif(F.concat_ws(
            "; ", F.when(~F.col("reached"), NO_START_PAGE).when(empty, NOTHING_FOUND),
            F.when(F.col("failed") > 0, F.concat(F.lit(f"{PAGES_FAILED} "), "failed"))), F.lit("")).alias("note"),
    )
