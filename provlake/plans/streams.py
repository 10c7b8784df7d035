"""Queries that run as streams over all files there are."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from provlake.streaming import folds


def stream_error_streaks(spark: SparkSession, d: str) -> DataFrame:
    return folds.run_streaks(spark, d)


def stream_daily_windows(spark: SparkSession, d: str) -> DataFrame:
    return folds.run_daily_counts(spark, d)


_L = "(select distinct on (seq) seq, source, target, lower(outcome) as outcome, absence, ts from check_log)"
_TS = r"try_cast(case when regexp_matches(ts, '([zZ]|[+-]\d{2}:?\d{2})$') then ts else ts || 'Z' end as timestamptz)"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (stream_error_streaks, stream_daily_windows)}


def oracle_sql() -> dict[str, str]:
    return {
        "stream_error_streaks": f"""with l as (select * from {_L} where source is not null and target is not null), r as (select source, target, max(seq) as reset from l where outcome in ('new', 'unchanged', 'unchanged-content', 'recheck-recovered', 'live-attested') group by 1, 2)
            select l.source, l.target, count(*) as streak, max(seq) as last_seq from l left join r on r.source = l.source and r.target = l.target where outcome = 'error' and (absence is null or absence in ('confirmed', 'persistent')) and (reset is null or seq > reset) group by 1, 2 having count(*) >= 2""",
        "stream_daily_windows": f"with l as (select {_TS} as at_, outcome from {_L}) select strftime(timezone('UTC', at_), '%Y-%m-%d') as day, count(*) as n, count(*) filter (outcome = 'error') as errors from l where at_ is not null group by 1",
    }
