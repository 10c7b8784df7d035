"""Orphan references: null masks, match semantics, spellings of paths and times (problem 5)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from provlake.operators import references as refs


@pytest.mark.parametrize(
    "match, want",
    [("simple", {"ab-missing"}), ("partial", {"ab-missing", "a-null-missing", "null-b-missing"}), ("full", {"ab-missing", "a-null", "a-null-missing", "null-b-missing"})],
)
def test_match_semantics(spark, match, want):
    r = spark.createDataFrame([("ok", 1, "x"), ("ab-missing", 1, "z"), ("a-null", 2, None), ("a-null-missing", 9, None), ("null-b-missing", None, "q"), ("none", None, None)], "n string, a int, b string").withColumn("__mask", F.lit(1))
    t = spark.createDataFrame([(1, "x"), (2, "y"), (None, "w")], "a int, b string").withColumn("n", F.lit("clash"))
    got = refs.orphans(r, t, ["a", "b"], match)
    assert {x["n"] for x in got.collect()} == want and got.columns == r.columns


def test_empty_tables(spark):
    r = spark.createDataFrame([(1,), (1,), (None,)], "a int")
    assert [x["a"] for x in refs.orphans(r, r.limit(0), ["a"]).collect()] == [1, 1]
    assert refs.orphans(r.limit(0), r, ["a"]).count() == 0
    with pytest.raises(ValueError):
        refs.orphans(r, r, ["a"], "other")


def test_spellings(spark):
    rows = [("./captures/a/b/1", "captures/a/b/1"), ("captures//a/b/1/", "captures/a/b/1"), ("captures/a/b/1//", "captures/a/b/1"), ("", ""), (None, None)]
    df = spark.createDataFrame(rows, "p string, want string")
    assert df.where(~refs.clean_dir(F.col("p")).eqNullSafe(F.col("want"))).count() == 0
    times = [
        ("2025-06-30T23:30:00-05:00", "2025-07"), ("2025-07-01T00:30:00+02:00", "2025-06"), ("2025-07-01T00:30:00+0200", "2025-06"), ("2025-06-01 02:59:51", "2025-06"), ("2025-06-01T03:37:16.555Z", "2025-06"),
        ("n/a", None), ("", None), ("unknown", None), (None, None), ("2025-13-40T00:00:00Z", None), ("12345", None),
    ]
    df = spark.createDataFrame(times, "t string, want string")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert [r["t"] for r in df.where(~refs.utc_month(refs.utc_timestamp(F.col("t"))).eqNullSafe(F.col("want"))).collect()] == []
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_kinds_per_reference(spark):
    d = "captures/s__m/kind-00/2025060{}T000000Z"
    at = dt.datetime(2025, 6, 2)
    captures = spark.createDataFrame([(d.format(1), at), (d.format(2), dt.datetime(2025, 8, 1)), (None, at)], "capture_dir string, arrived_at timestamp")
    state = spark.createDataFrame(
        [("k1", d.format(1) + "/", [{"dir": d.format(1)}, {"dir": "./" + d.format(2)}]), ("k2", d.format(7), []), ("k3", None, None)],
        "state_key string, last_capture string, versions array<struct<dir:string>>",
    )
    log = spark.createDataFrame(
        [(1, "2025-06-05T00:00:00Z", "new", d.format(8)), (2, None, "new", d.format(8)), (3, "2025-06-09T00:00:00Z", "PRUNED-noise", d.format(9)), (4, "2025-06-10", "unchanged", d.format(9)), (4, "2025-06-10", "unchanged", d.format(9)),
         (5, "2025-06-05T00:00:00Z", None, d.format(2)), (6, "n/a", "new", d.format(2)), (7, "2025-06-05T00:00:00Z", "new", None), (8, "2025-06-05T00:00:00Z", "new", "loose")],
        "seq bigint, ts string, outcome string, dir string",
    )
    got = {(r["ref_table"], r["ref_field"], r["ref_row"], r["kind"], r["period"]) for r in refs.orphan_references(state, log, captures).collect()}
    assert got == {
        ("state_index", "versions", "k1", "late", "2025-06"), ("state_index", "last_capture", "k2", "missing", "2025-06"), ("check_log", "dir", "1", "missing", "2025-06"), ("check_log", "dir", "2", "missing", "unknown"),
        ("check_log", "dir", "4", "deleted", "unknown"), ("check_log", "dir", "5", "late", "2025-06"), ("check_log", "dir", "8", "missing", "2025-06"),
    }
    report = refs.orphan_report(refs.orphan_references(state, log, captures))
    assert report.agg(F.sum("n_references")).collect()[0][0] == 7


def test_a_directory_with_a_third_of_all_lines(spark):
    d = "captures/s/k-1/20250601T000000Z"
    log = spark.range(3000).select(F.col("id").alias("seq"), F.lit("2025-06-05T00:00:00Z").alias("ts"), F.lit("new").alias("outcome"), F.when(F.col("id") % 3 == 0, d).otherwise(F.concat(F.lit(d), "id")).alias("dir"))
    state = spark.createDataFrame([], "state_key string, last_capture string, versions array<struct<dir:string>>")
    captures = spark.createDataFrame([], "capture_dir string, arrived_at timestamp")
    assert refs.orphan_references(state, log, captures).where(F.col("kind") == "missing").count() == 3000
