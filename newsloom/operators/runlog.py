"""The run log: one START and one END row per run."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.schemas import RUN_LOG
from newsloom.sources.tables import append_rows, create_table

START, END = "START", "END"
SUCCESS, FAILED = "SUCCESS", "FAILED"
SYSTEM_CHECK = "SYSTEM_CHECK"
NO_CONFIG = -1
# What a step gives: a row count, an error text, or neither.
ROWS, ERROR = "rows", "error"


def open_runs(log: DataFrame) -> DataFrame:
    """Runs whose last START has no END at or after it."""
    def last(event: str) -> Column:
        return F.max(F.when(F.col("event") == event, F.col("logged_at")))

    times = log.groupBy("run_id").agg(last(START).alias("_start"), last(END).alias("_end"))
    return times.filter("_start IS NOT NULL AND (_end IS NULL OR _end < _start)").select("run_id")


def latest_by(log: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of every key; each task keeps one row per key, so nothing is sorted."""
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")).select(key, "_last.*")


def run_state(log: DataFrame) -> DataFrame:
    """The last event of every run; of two at the same time the END counts."""
    ranked = log.withColumn("_is_end", F.col("event") == END)
    return latest_by(ranked, "run_id", "logged_at", "_is_end").drop("_is_end")


def outcome(result_kind: Column, error: Column) -> tuple[Column, Column]:
    """Status and message of a step result that is a row count, an error text or nothing."""
    status = F.when(result_kind == ROWS, SUCCESS).otherwise(FAILED)
    message = F.when(result_kind == ERROR, F.concat(F.lit("SQL Error: "), error)).when(
        (result_kind != ROWS) | result_kind.isNull(), "Procedure returned None")
    return status, message


class RunLog:
    """Start and end events in a table. "Busy" is a look at the table, not a lock."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table
        create_table(spark, table, RUN_LOG)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def _append(self, **values) -> None:
        def as_column(value) -> Column:
            return value if isinstance(value, Column) else F.lit(value)

        row = self.spark.range(0, 1, 1, 1).select(*[
            (F.current_timestamp() if f.name == "logged_at" else as_column(values.get(f.name)))
            .cast(f.dataType).alias(f.name)
            for f in RUN_LOG.fields
        ])
        append_rows(row, self.table)

    def start(self, job_name: str, config_id: int | None = None) -> str | None:
        """A new run id, or None while another run is open."""
        if not open_runs(self.rows()).isEmpty():
            return None
        run_id = str(uuid.uuid4())
        self._append(run_id=run_id, event=START, config_id=config_id, job_name=job_name)
        return run_id

    def end(self, run_id: str, kind: str | None, extracted: int, loaded: int, error: str | None = None) -> None:
        """The END row of a run that gave `rows`, an `error` with its text, or nothing, by the rule of `outcome`."""
        status, message = outcome(F.lit(kind).cast("string"), F.lit(error).cast("string"))
        self._append(run_id=run_id, event=END, status=status, extracted=extracted, loaded=loaded, error=message)

    def note(self, job_name: str, run_id: str, extracted: int, loaded: int) -> None:
        """START and END rows of a part of a run that is still open, with the part's own counters."""
        self._append(run_id=run_id, event=START, job_name=job_name)
        self.end(run_id, ROWS, extracted, loaded)

    def append_jobs(self, summary: DataFrame, run_id: str) -> None:
        """START and END rows of crawl jobs that ran together, under ids that extend `run_id`."""
        job = F.concat_ws("/", F.lit(run_id), "config_id", "source_name", "category_name")
        events = summary.withColumn("event", F.explode(F.array(F.lit(START), F.lit(END))))
        ended = F.col("event") == END
        append_rows(events.select(
            job.alias("run_id"), "event", "config_id",
            F.concat(F.lit("crawl: "), "source_name").alias("job_name"),
            F.when(ended, F.col("status")).alias("status"),
            F.when(ended, F.col("extracted")).alias("extracted"),
            F.when(ended, F.col("loaded")).alias("loaded"),
            F.when(ended, F.col("note")).alias("error"),
            F.current_timestamp().alias("logged_at"),
        ), self.table)

    def run(self, job_name: str, step: Callable[[str], tuple[int, int] | None],
            config_id: int | None = None) -> tuple[str | None, str]:
        """Run `step(run_id) -> (extracted, loaded)` between its two events.

        Zero rows are a success; a step that gives nothing has failed. An error is logged as FAILED with its
        text and not raised again, so the caller looks at the status.
        """
        run_id = self.start(job_name, config_id)
        if run_id is None:
            return None, "BUSY"
        try:
            result = step(run_id)
        except Exception as e:
            self.end(run_id, ERROR, 0, 0, str(e))
            return run_id, FAILED
        if result is None:
            self.end(run_id, None, 0, 0)
            return run_id, FAILED
        self.end(run_id, ROWS, *result)
        return run_id, SUCCESS

    def check(self, message: str) -> str:
        """A system check that has failed: its own run, under no configuration."""
        run_id = self.start(SYSTEM_CHECK, NO_CONFIG)
        if run_id is None:
            return "BUSY"
        self._append(run_id=run_id, event=END, status=FAILED, extracted=0, loaded=0, error=message)
        return FAILED
