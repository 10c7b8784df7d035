"""Sinks of the ledger (K-01 to K-11)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.operators.ordered import last_of


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K-01: the whole table written beside its place, then moved there; readers see the old one or the new one."""
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.format(fmt).save(beside)
    fs, place = _fs(spark, path)
    old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{beside}.old")
    if fs.exists(place):
        fs.rename(place, old)
    fs.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(beside), place)
    if fs.exists(old):
        fs.delete(old, True)


def append_events(events: DataFrame, path: str, vantage: str) -> None:
    """K-02: lines appended, time and vantage filled in where they are missing."""
    ts, seen = ("ts", "vantage")
    for c in (ts, seen):
        if c not in events.columns:
            events = events.withColumn(c, F.lit(None).cast("string"))
    stamp = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    events.withColumn(ts, F.coalesce(ts, stamp)).withColumn(seen, F.coalesce(seen, F.lit(vantage))).write.mode("append").json(path)


def store_versions(fetched: DataFrame, held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K-03: the one write path: (new version rows, events) of fetches against what is held.

    fetched: source_id, target, capture_dir, fetched_at, sha256, text_sha;
    held: source_id, target, capture_dir, fetched_at, sha256, text_sha.  Of several
    fetches of a target in one batch the last counts.  `prior_sha256` is read from
    what was held before the batch.
    """
    last = last_of(fetched, ["source_id", "target"], ["fetched_at", "capture_dir"])
    before = last_of(held.select("source_id", "target", "fetched_at", F.col("sha256").alias("prior_sha256"), F.col("capture_dir").alias("prior_dir")), ["source_id", "target"], ["fetched_at", "prior_dir"]).drop("fetched_at")
    texts = held.where("text_sha is not null").groupBy("source_id", "target", "text_sha").agg(F.max("capture_dir").alias("matches"))
    both = last.join(before, ["source_id", "target"], "left").join(texts, ["source_id", "target", "text_sha"], "left")
    outcome = F.when(F.col("sha256") == F.col("prior_sha256"), "unchanged").when(F.col("matches").isNotNull(), "unchanged-content").otherwise("new")
    judged = both.withColumn("outcome", outcome)
    new = judged.where("outcome = 'new'").select("source_id", "target", "capture_dir", "fetched_at", "sha256", "text_sha", "prior_sha256")
    events = judged.select(F.col("source_id").alias("source"), "target", F.col("fetched_at").alias("ts"), "outcome", "sha256", F.when(F.col("outcome") == "new", F.col("capture_dir")).alias("dir"), "matches")
    return new, events


def version_writer(root: str):
    """K-03 for a stream: a function for foreachBatch; a batch that is run again writes the same folder again."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fs, place = _fs(spark, f"{root}/versions")
        kept = ["source_id", "target", "capture_dir", "fetched_at", "sha256", "text_sha"]
        held = spark.read.parquet(f"{root}/versions").where(F.col("batch") < number).select(*kept) if fs.exists(place) else batch.select(*kept).limit(0)
        new, events = store_versions(batch, held)
        new.write.mode("overwrite").parquet(f"{root}/versions/batch={number}")
        events.write.mode("overwrite").parquet(f"{root}/events/batch={number}")

    return write


def change_feed_xml(changes: DataFrame, title: str) -> DataFrame:
    """K-06: one row with an Atom feed of (id, updated, text); the caller has bounded the entries."""
    e = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    entry = F.concat(F.lit("<entry><id>"), e(F.col("id")), F.lit("</id><updated>"), "updated", F.lit("</updated><title>"), e(F.col("text")), F.lit("</title></entry>"))
    many = changes.agg(F.transform(F.reverse(F.array_sort(F.collect_list(F.struct("updated", "id", entry.alias("x"))))), lambda r: r["x"]).alias("xs"))
    return many.select(F.concat(F.lit(f"<feed xmlns=\"http://www.w3.org/2005/Atom\"><title>{title}</title>"), F.array_join("xs", ""), F.lit("</feed>")).alias("feed"))


def write_ledger(records: DataFrame, path: str, restricted: DataFrame) -> None:
    """K-10: the diff ledger in key order, without the words of restricted sources."""
    from provlake.operators.diff import redacted

    marked = records.join(restricted.select("source_id").distinct().withColumn("__r", F.lit(True)), "source_id", "left")
    clean = marked.withColumn("changes", redacted(F.col("changes"), F.coalesce("__r", F.lit(False)))).drop("__r")
    replace_table(clean.repartitionByRange("key").sortWithinPartitions("key"), path, "json")
