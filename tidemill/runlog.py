"""Run log, dependency gate and metric thresholds."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .schemas import QUALITY_LOG, RUN_LOG
from .sources.reader import typed_rows, values_relation

# Fixed values.
STEPS = ["INIT", "DEPENDENCY_CHECK", "PREPROCESS", "DATA_LOAD", "DATA_QUALITY", "STATISTICS", "COMPLETE"]
THRESHOLDS = {"row_count": (1, None), "duration_seconds": (None, 3600), "error_rate_percent": (None, 5.0)}


class RunLog:
    """Append-only Parquet logs below one folder, partitioned by batch date.  A failed run's rows stay."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        for name, schema in (("runs", RUN_LOG), ("quality", QUALITY_LOG)):
            typed_rows(spark, [], schema).write.mode("ignore").partitionBy("batch_date").parquet(f"{path}/{name}")

    def add(self, **row: object) -> None:
        self._append("runs", [row], RUN_LOG)

    def add_faults(self, rows: Sequence[Mapping[str, object]]) -> None:
        if rows:
            self._append("quality", rows, QUALITY_LOG)

    def _append(self, name: str, rows: Sequence[Mapping[str, object]], schema: T.StructType) -> None:
        typed_rows(self.spark, rows, schema).coalesce(1).write.mode("append").partitionBy("batch_date").parquet(
            f"{self.path}/{name}")

    def runs(self) -> DataFrame:
        return self.spark.read.schema(RUN_LOG).parquet(f"{self.path}/runs").select(*RUN_LOG.fieldNames())

    def faults(self) -> DataFrame:
        return self.spark.read.schema(QUALITY_LOG).parquet(f"{self.path}/quality").select(*QUALITY_LOG.fieldNames())


@dataclass
class Step:
    name: str
    row_count: int | None = None
    message: str = ""
    error_rate_percent: float | None = None


class Run:
    """One run of one job for one batch date."""

    def __init__(self, log: RunLog, proc_name: str, mapping_id: str, batch_date: date | None):
        self.log, self.proc_name, self.mapping_id, self.batch_date = log, proc_name, mapping_id, batch_date
        self.started = datetime.now()

    def note(self, step: str, status: str, start: datetime, end: datetime | None = None, **more: object) -> None:
        seconds = (end - start).total_seconds() if end else None
        self.log.add(proc_name=self.proc_name, mapping_id=self.mapping_id, batch_date=self.batch_date, step=step,
                     status=status, start_time=start, end_time=end, duration_seconds=seconds, **more)

    @contextmanager
    def step(self, name: str) -> Iterator[Step]:
        """Log SUCCESS when the block ends, FAILED with the error when it raises; the error goes on."""
        step, start = Step(name), datetime.now()
        try:
            yield step
        except Exception as error:
            self.note(name, "FAILED", start, datetime.now(), error_code=type(error).__name__,
                      error_message=str(error), message=f"{type(error).__name__}: {error}")
            raise
        self.note(name, "SUCCESS", start, datetime.now(), row_count=step.row_count, message=step.message,
                  error_rate_percent=step.error_rate_percent)


def missing_upstreams(runs: DataFrame, names: Sequence[str], batch_date: date | None = None) -> DataFrame:
    """(batch_date, proc_name) of upstream jobs without a SUCCESS row; without a date, for every date in the log."""
    spark = runs.sparkSession
    done = runs.filter((F.col("status") == "SUCCESS") & F.col("proc_name").isin(list(names)))
    wanted = values_relation(spark, ["proc_name"], [(n,) for n in names])
    if batch_date is not None:
        done = done.filter(F.col("batch_date") == F.lit(batch_date))
        wanted = wanted.select(F.lit(batch_date).alias("batch_date"), "proc_name")
    else:
        each = F.explode(F.array(*[F.lit(n) for n in names])).alias("proc_name")
        wanted = runs.select("batch_date").distinct().select("batch_date", each)
    return wanted.join(done.select("batch_date", "proc_name").distinct(), ["batch_date", "proc_name"], "left_anti")


class UpstreamError(Exception):
    """An upstream job has not finished for the batch date."""


def require_upstreams(runs: DataFrame, names: Sequence[str], batch_date: date) -> None:
    missing = [r["proc_name"] for r in missing_upstreams(runs, names, batch_date).collect()]  # at most len(names) rows
    if missing:
        raise UpstreamError("missing upstream jobs: " + ", ".join(sorted(missing)))


def metric_breaches(runs: DataFrame, keys: Sequence[str],
                    thresholds: Mapping[str, tuple[float | None, float | None]] = THRESHOLDS) -> DataFrame:
    """(keys, metric, value, min_value, max_value, breached) for each metric column of the log."""
    def number(v: float | None):
        return F.lit(None if v is None else float(v)).cast("double")

    packed = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), number(lo).alias("min_value"),
                 number(hi).alias("max_value"))
        for m, (lo, hi) in thresholds.items()
    ])
    long = runs.select(*keys, F.explode(packed).alias("m")).select(*keys, "m.*")
    low = F.coalesce(F.col("value") < F.col("min_value"), F.lit(False))
    high = F.coalesce(F.col("value") > F.col("max_value"), F.lit(False))
    return long.withColumn("breached", low | high)
