"""Health of the jobs and of their inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.sources.files import freshness_of

RECENT_RUNS = 5


def job_health(run_log: DataFrame, runs: int = RECENT_RUNS, jobs: DataFrame | None = None) -> DataFrame:
    """Per job: last state and start, success percentage and mean minutes over its last ``runs`` runs.

    An unfinished run counts for the success rate but not for the mean.  Jobs
    listed in ``jobs`` (job_name) without any run show as NO_RUNS.  The log has
    job_name, run_id, state, started_on and minutes (null while unfinished).
    """
    newest = Window.partitionBy("job_name").orderBy(F.desc("started_on"), F.desc("run_id"))
    recent = run_log.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= runs)
    health = recent.groupBy("job_name").agg(
        F.max(F.when(F.col("_n") == 1, F.col("state"))).alias("last_run_status"),
        F.max("started_on").alias("last_run_time"),
        (F.count_if(F.col("state") == "SUCCEEDED").cast("double") / F.count(F.lit(1)) * 100).alias("success_rate"),
        F.coalesce(F.sum("minutes").cast("double") / F.count("minutes"), F.lit(0.0)).alias("avg_duration_minutes"),
    )
    if jobs is None:
        return health
    return jobs.select("job_name").distinct().join(health, "job_name", "left").select(
        "job_name", F.coalesce("last_run_status", F.lit("NO_RUNS")).alias("last_run_status"), "last_run_time",
        F.coalesce("success_rate", F.lit(0.0)).alias("success_rate"),
        F.coalesce("avg_duration_minutes", F.lit(0.0)).alias("avg_duration_minutes"))


def read_run_log(spark: SparkSession, target: str) -> DataFrame:
    """The log that the pipeline writes, in the form that ``job_health`` takes."""
    log = spark.read.parquet(f"{target}/run_log")
    seconds = F.unix_micros("completed_on") - F.unix_micros("started_on")
    return log.select("job_name", F.unix_micros("started_on").alias("run_id"), "state", "started_on",
                      (seconds / 60_000_000).alias("minutes"))


def data_freshness(df: DataFrame, time_column: str, as_of: Column, max_age_hours: int = 24,
                   source: str | None = None) -> DataFrame:
    """Age of the newest row, overall or per ``source`` column."""
    newest = (df.groupBy(source) if source else df.groupBy()).agg(F.max(time_column).alias("last_modified"))
    return freshness_of(newest, as_of, max_age_hours)


def recent_errors(errors: DataFrame, time_column: str, now: Column, hours: int = 1) -> DataFrame:
    """Errors of the last ``hours`` hours before ``now``, newest first."""
    since = now - F.make_dt_interval(hours=F.lit(hours))
    return errors.where((F.col(time_column) > since) & (F.col(time_column) <= now)).orderBy(F.desc(time_column))
