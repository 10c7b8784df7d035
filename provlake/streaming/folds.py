"""The event log as a stream: keyed state and windows over it.

State is kept per target and says the same after every order of arrival: it
holds the last resetting line and the failing lines after it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from provlake.operators.events import SUCCESS
from provlake.operators.references import utc_timestamp
from provlake.session import Stash, load

STREAK = "source string, target string, streak bigint, last_seq bigint"


def log_stream(spark: SparkSession, sf_dir: str, table: str = "check_log", files_per_batch: int = 8) -> DataFrame:
    """A table of a directory as a stream of files, whether it is one file or a folder of them."""
    schema = load(spark, sf_dir, table).schema
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
    folder = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(f"{sf_dir}/{table}.parquet") if folder else r.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)


def _streak(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    reset, failing = (lambda s: (s[0], set(json.loads(s[1]))))(state.get) if state.exists else (0, set())
    for f in frames:
        alive = f.loc[f["alive"], "seq"]
        if len(alive):
            reset = max(reset, int(alive.max()))
        failing.update(int(x) for x in f.loc[f["failed"], "seq"])
    failing = {x for x in failing if x > reset}
    state.update((reset, json.dumps(sorted(failing))))
    yield pd.DataFrame({"source": [key[0]], "target": [key[1]], "streak": [len(failing)], "last_seq": [max(failing, default=0)]})


def failure_streaks(log: DataFrame) -> DataFrame:
    """ST-02 as a stream: after each batch the streak of every target that it touched."""
    rows = log.select("source", "target", "seq", F.lower("outcome").isin(*SUCCESS, "live-attested").alias("alive"), ((F.lower("outcome") == "error") & F.coalesce(F.col("absence").isNull() | F.col("absence").isin("confirmed", "persistent"), F.lit(False))).alias("failed")).where("seq is not null and source is not null and target is not null and (alive or failed)")
    return rows.groupBy("source", "target").applyInPandasWithState(_streak, STREAK, "reset bigint, failing string", "update", GroupStateTimeout.NoTimeout)


def run_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream run over all files there are; one row per target with a streak of two or more."""
    stash = Stash(spark)
    out = f"{stash.root}/streaks"

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/b={number}")

    q = failure_streaks(log_stream(spark, sf_dir)).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{stash.root}/offsets").trigger(availableNow=True).start()
    q.awaitTermination()
    newest = spark.read.parquet(out).groupBy("source", "target").agg(F.max_by("streak", "batch").alias("streak"), F.max_by("last_seq", "batch").alias("last_seq"))
    return newest.where("streak >= 2")


def run_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and errors per UTC day, by event-time windows with a watermark for late lines.

    Lines delivered twice are dropped within the watermark; a line later than it
    is not counted, so it is set wide.
    """
    stash = Stash(spark)
    at = utc_timestamp(F.col("ts")).alias("at")
    rows = log_stream(spark, sf_dir).select(at, "seq", F.lower("outcome").alias("outcome")).where("at is not null").withWatermark("at", "3650 days").dropDuplicatesWithinWatermark(["seq"])
    days = rows.groupBy(F.window("at", "1 day")).agg(F.count("*").alias("n"), F.count_if(F.col("outcome") == "error").alias("errors"))

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{stash.root}/days/b={number}")

    q = days.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{stash.root}/offsets").trigger(availableNow=True).start()
    q.awaitTermination()
    d = spark.read.parquet(f"{stash.root}/days").groupBy("window").agg(F.max_by("n", "batch").alias("n"), F.max_by("errors", "batch").alias("errors"))
    return d.select(F.date_format(F.to_utc_timestamp("window.start", F.current_timezone()), "yyyy-MM-dd").alias("day"), "n", "errors")
