"""Queries of the general training-data operators (problems 2 and 5)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from provlake.operators import references, schema_drift
from provlake.session import load


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return schema_drift.schema_changes(load(spark, d, "raw_record"))


def p2_table(spark: SparkSession, d: str) -> DataFrame:
    return schema_drift.consistent_table(load(spark, d, "raw_record"))


def p2_kept(spark: SparkSession, d: str) -> DataFrame:
    """Values of each file in the one table, against those delivered."""
    return schema_drift.values_kept(p2_table(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return references.orphan_references(load(spark, d, "state_index"), load(spark, d, "check_log"), load(spark, d, "captures"))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return references.orphan_report(p5_found(spark, d))


_P5 = r"""
with cap as (
  select regexp_replace(regexp_replace(regexp_replace(trim(capture_dir), '/{2,}', '/', 'g'), '^(\./)+', ''), '/+$', '') as d, min(arrived_at) as arrived
  from captures where capture_dir is not null group by 1
), log as (
  select cast(seq as varchar) as ref_row, coalesce(lower(outcome) like 'pruned%', false) as pruned,
    regexp_replace(regexp_replace(regexp_replace(trim(dir), '/{2,}', '/', 'g'), '^(\./)+', ''), '/+$', '') as d,
    case when regexp_matches(ts, '([zZ]|[+-]\d{2}:?\d{2})$') then ts else ts || 'Z' end as t
  from check_log where dir is not null
), st as (
  select 'last_capture' as ref_field, state_key, last_capture as d from state_index
  union all select 'versions', state_key, unnest(versions).dir from state_index
), refs as (
  select distinct 'state_index' as ref_table, ref_field, state_key as ref_row,
    regexp_replace(regexp_replace(regexp_replace(trim(d), '/{2,}', '/', 'g'), '^(\./)+', ''), '/+$', '') as ref_value,
    case when regexp_matches(d, '/\d{8}T[^/]*/*$') then regexp_extract(d, '/(\d{4})\d{4}T[^/]*/*$', 1) || '-' || regexp_extract(d, '/\d{4}(\d{2})\d{2}T[^/]*/*$', 1) else 'unknown' end as period
  from st
  union select 'check_log', 'dir', ref_row, d, coalesce(strftime(timezone('UTC', try_cast(t as timestamptz)), '%Y-%m'), 'unknown') from log where not pruned
), judged as (
  select refs.*, case
      when cap.d is null and exists (select 1 from log where pruned and log.d = ref_value) then 'deleted'
      when cap.d is null then 'missing'
      when period <> 'unknown' and strftime(timezone('UTC', cast(arrived as timestamptz)), '%Y-%m') > period then 'late' end as kind
  from refs left join cap on cap.d = ref_value where ref_value is not null and ref_value <> ''
)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p2_found, p2_table, p2_kept, p5_found, p5_report)}


def oracle_sql() -> dict[str, str]:
    return {
        "p2_kept": "select feed, file_no, count(*) as n_records, sum(n)::bigint as n_values from (select r.feed, r.file_no, (select count(*) from json_tree(r.body) j where j.type not in ('OBJECT', 'NULL') and not contains(j.fullkey, '[')) as n from raw_record r) group by 1, 2",
        "p5_found": _P5 + "select ref_table, ref_field, ref_row, ref_value, period, kind from judged where kind is not null",
        "p5_report": _P5 + "select ref_table, ref_field, period, kind, count(*) as n_references, count(distinct ref_value) as n_directories from judged where kind is not null group by all",
    }
