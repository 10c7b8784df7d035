"""References to records that do not exist (problem 5).

Composite keys may be null in part.  The references are grouped by their null
mask; those of one mask are anti-joined with the targets on the columns that
are not null in it.  Declared match semantics decide about partly null keys:

- simple: a key with any null refers to nothing and is never an orphan
- partial: the non-null columns must be found together in some target
- full: a key is either null in all columns (and refers to nothing) or in none;
  a key that is null in part is an orphan

Keys that are null in all columns are no references under any of the three.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.session import Stash


def null_mask(cols: list[str]) -> Column:
    """'101' for a key whose second column is null."""
    return F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in cols])


def orphans(refs: DataFrame, targets: DataFrame, cols: list[str], match: str = "simple") -> DataFrame:
    """The rows of `refs` whose key `cols` finds no target, with all their columns.

    Repeated references stay repeated; ask with distinct keys and join the
    answer back where one key is referred to very often.  An empty target table
    makes every reference an orphan.  Column names may clash: only `cols` of
    the targets are read.
    """
    if match not in ("simple", "partial", "full"):
        raise ValueError(match)
    mask = "__mask"
    while mask in refs.columns:
        mask += "_"
    masked = refs.withColumn(mask, null_mask(cols))
    whole, nothing = "1" * len(cols), "0" * len(cols)
    parts = []
    # at most 2 ** len(cols) values, whatever the size of the table
    for (m,) in sorted(masked.select(mask).distinct().collect()):
        held = masked.where(F.col(mask) == m)
        if m == nothing:
            continue
        if m != whole and match == "simple":
            continue
        if m != whole and match == "full":
            parts.append(held)
            continue
        on = [c for c, bit in zip(cols, m) if bit == "1"]
        parts.append(held.join(targets.select(on).dropna().distinct(), on, "left_anti").select(masked.columns))
    found = reduce(DataFrame.unionByName, parts) if parts else masked.limit(0)
    return found.drop(mask)


def clean_dir(path: Column) -> Column:
    """A directory in the one spelling: no leading ./, no doubled or trailing slash."""
    one = F.regexp_replace(F.trim(path), "/{2,}", "/")
    return F.regexp_replace(F.regexp_replace(one, r"^(\./)+", ""), "/+$", "")


def utc_timestamp(ts: Column) -> Column:
    """A timestamp from any ISO spelling; without an offset it is UTC; unreadable gives null."""
    t = F.trim(ts)
    dated = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"), F.regexp_replace(t, r"^(.{16})(?!:)", "$1:00"))
    zoned = F.when(dated.rlike(r"([zZ]|[+-]\d{2}:?\d{2})$"), F.regexp_replace(F.upper(dated), r"([+-]\d{2})(\d{2})$", "$1:$2")).otherwise(F.concat(dated, F.lit("Z")))
    return zoned.try_cast("timestamp")


def utc_month(ts: Column) -> Column:
    """YYYY-MM in UTC of a timestamp, whatever the session's time zone."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM")


def directory_key(d: Column) -> list[Column]:
    """(parent, stamp): the composite key of a directory; a bare name has no parent."""
    return [F.nullif(F.regexp_extract(d, r"^(.*)/[^/]*$", 1), F.lit("")).alias("parent"), F.nullif(F.regexp_extract(d, r"([^/]*)$", 1), F.lit("")).alias("stamp")]


def references(state: DataFrame, log: DataFrame) -> DataFrame:
    """(ref_table, ref_field, ref_row, ref_value, period), each reference once."""
    tail = state.select(F.lit("last_capture").alias("ref_field"), F.col("state_key").alias("ref_row"), F.col("last_capture").alias("d"))
    each = state.select(F.lit("versions").alias("ref_field"), F.col("state_key").alias("ref_row"), F.explode("versions.dir").alias("d"))
    held = tail.unionByName(each).select(F.lit("state_index").alias("ref_table"), "ref_field", "ref_row", clean_dir(F.col("d")).alias("ref_value"))
    stamp = F.regexp_extract("ref_value", r"([^/]*)$", 1)
    held = held.withColumn("period", F.when(stamp.rlike(r"^\d{8}T"), F.concat(F.substring(stamp, 1, 4), F.lit("-"), F.substring(stamp, 5, 2))).otherwise("unknown"))
    lines = log.where("dir is not null and not coalesce(lower(outcome) like 'pruned%', false)").select(
        F.lit("check_log").alias("ref_table"), F.lit("dir").alias("ref_field"), F.col("seq").cast("string").alias("ref_row"), clean_dir(F.col("dir")).alias("ref_value"),
        F.coalesce(utc_month(utc_timestamp(F.col("ts"))), F.lit("unknown")).alias("period"),
    )
    return held.unionByName(lines).where("ref_value is not null and ref_value <> ''").distinct()


def directory_faults(refs: DataFrame, log: DataFrame, captures: DataFrame) -> DataFrame:
    """(ref_value, arrived): directories referred to that are gone, or when they came.

    kind is `deleted` or `missing` for orphans and null for the others, which
    carry the month of their arrival.  One row per directory, so a directory
    with very many references weighs no more than any other.
    """
    asked = refs.select("ref_value").distinct()
    held = captures.where("capture_dir is not null").select(clean_dir(F.col("capture_dir")).alias("ref_value"), "arrived_at").groupBy("ref_value").agg(utc_month(F.min("arrived_at")).alias("arrived"))
    keyed = asked.select("ref_value", *directory_key(F.col("ref_value")))
    gone = orphans(keyed, held.select(*directory_key(F.col("ref_value"))), ["parent", "stamp"], match="full")
    pruned = log.where("dir is not null and lower(outcome) like 'pruned%'").select(clean_dir(F.col("dir")).alias("ref_value")).distinct().withColumn("pruned", F.lit(True))
    gone = gone.select("ref_value").join(pruned, "ref_value", "left").select("ref_value", F.lit(None).cast("string").alias("arrived"), F.when(F.col("pruned"), "deleted").otherwise("missing").alias("kind"))
    here = asked.join(held, "ref_value").select("ref_value", "arrived", F.lit(None).cast("string").alias("kind"))
    return gone.unionByName(here)


def orphan_references(state: DataFrame, log: DataFrame, captures: DataFrame) -> DataFrame:
    """One row per distinct reference to a directory that is missing, deleted or late.

    The references are joined back on the directory; a directory to which a
    third of all lines refer is split by AQE, as the other side has one row for it.
    """
    refs = Stash(log.sparkSession).put(references(state, log), "references")  # asked for several times, the log read once
    judged = refs.join(directory_faults(refs, log, captures), "ref_value").withColumn(
        "kind", F.coalesce("kind", F.when((F.col("period") != "unknown") & (F.col("arrived") > F.col("period")), F.lit("late")))
    )
    return judged.where("kind is not null").select("ref_table", "ref_field", "ref_row", "ref_value", "period", "kind")


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphan references counted per table, field, period and kind."""
    return found.groupBy("ref_table", "ref_field", "period", "kind").agg(F.count("*").alias("n_references"), F.countDistinct("ref_value").alias("n_directories"))
