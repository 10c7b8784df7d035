"""Records whose text reads the same but differs in its characters (problem 3).

Defined results: a null text is in no group; the empty text is a text like any
other; exact copies share a class but are no pair of `look_alike_pairs`, which
wants different strings.  Columns beyond id and text are never read, so
clashing names do no harm.  An empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.llm.consistent import consistent, skeleton
from provlake.session import Stash

_KEYS = "id bigint, skel_hi bigint, skel_lo bigint, text_hash bigint"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        hi, lo, own = [], [], []
        for t in b.column(1).to_pylist():
            wide = xxhash.xxh3_128_intdigest(skeleton(t).encode("utf-8", "surrogatepass"))
            hi.append(_signed(wide >> 64))
            lo.append(_signed(wide & (1 << 64) - 1))
            own.append(_signed(xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass"))))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(own, pa.int64())], names=["id", "skel_hi", "skel_lo", "text_hash"])


def skeleton_keys(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, skel_hi, skel_lo, text_hash): 128 bits of the skeleton, 64 of the text."""
    picked = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return picked.where("id is not null and text is not null").mapInArrow(_keys, _KEYS)


def look_alike_classes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per record: its class (smallest id with that skeleton), the class's size and spellings."""
    keys = Stash(df.sparkSession).put(skeleton_keys(df, id_col, text_col), "keys")
    classes = (
        keys.groupBy("skel_hi", "skel_lo", "text_hash").agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .groupBy("skel_hi", "skel_lo").agg(F.min("first").alias("class_id"), F.sum("n").alias("n_records"), F.count("*").alias("n_spellings"))
    )
    return keys.join(classes, ["skel_hi", "skel_lo"]).select(F.col("id").alias(id_col), "class_id", "n_records", "n_spellings")


def look_alike_pairs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Pairs of records with equal skeletons and different strings, smaller id first.

    Exact copies are collapsed first, so the pairs are formed between distinct
    spellings; a spelling with a third of all rows is expanded only against
    the others, row by row, in the last two joins, which AQE may split.
    """
    keys = Stash(df.sparkSession).put(skeleton_keys(df, id_col, text_col), "keys")
    spelling = keys.groupBy("skel_hi", "skel_lo", "text_hash").agg(F.count("*").alias("n"))
    several = spelling.groupBy("skel_hi", "skel_lo").agg(F.count("*").alias("k")).where("k > 1").drop("k")
    few = keys.join(several, ["skel_hi", "skel_lo"], "left_semi")
    kinds = few.select("skel_hi", "skel_lo", "text_hash").distinct()
    left, right = kinds.alias("l"), kinds.alias("r")
    links = left.join(right, (F.col("l.skel_hi") == F.col("r.skel_hi")) & (F.col("l.skel_lo") == F.col("r.skel_lo")) & (F.col("l.text_hash") < F.col("r.text_hash")))
    links = links.select("l.skel_hi", "l.skel_lo", F.col("l.text_hash").alias("t_a"), F.col("r.text_hash").alias("t_b"))
    a = few.select("skel_hi", "skel_lo", F.col("text_hash").alias("t_a"), F.col("id").alias("x"))
    b = few.select("skel_hi", "skel_lo", F.col("text_hash").alias("t_b"), F.col("id").alias("y"))
    both = links.join(a, ["skel_hi", "skel_lo", "t_a"]).join(b, ["skel_hi", "skel_lo", "t_b"])
    return both.select(F.least("x", "y").alias(f"{id_col}_a"), F.greatest("x", "y").alias(f"{id_col}_b"))


def consistent_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, consistent_text): every text in the one form; null stays null."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([consistent(t) for t in b.column(1).to_pylist()], pa.string())], names=[id_col, "consistent_text"])

    return df.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col)).mapInArrow(fold, f"{id_col} bigint, consistent_text string")
