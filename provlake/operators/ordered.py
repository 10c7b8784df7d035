"""Order within keys without putting a key into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provlake.session import Stash


def lag_over(df: DataFrame, keys: list[str], order: list[str], cols: list[str], prefix: str = "prior_") -> DataFrame:
    """W-01: df with the given columns of the row before, per key, under the prefix.

    The rows are range-partitioned by key and order, so a key with a third of
    all rows is spread over partitions; each partition takes its first row's
    predecessor from the last row of the one before.  The order must be total
    within a key; ties keep an arbitrary order.  The first row of a key has
    nulls.
    """
    stash = Stash(df.sparkSession)
    wanted = list(dict.fromkeys([*keys, *cols]))
    cut = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    cut = stash.put(cut, "sorted")  # the cut must not be drawn anew by another branch
    ends = cut.groupBy("__part").agg(F.max_by(F.struct(*wanted), F.col("__at")).alias("__end"))
    ends = ends.select("__part", F.lag("__end").over(Window.orderBy("__part")).alias("__end"))  # a row per partition
    within = Window.partitionBy("__part").orderBy("__at")
    before = F.lag(F.struct(*wanted)).over(within)
    out = cut.join(F.broadcast(ends), "__part", "left").withColumn("__before", F.coalesce(before, F.col("__end")))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__before.{k}"))
    return out.select(*df.columns, *[F.when(same & F.col("__before").isNotNull(), F.col(f"__before.{c}")).alias(prefix + c) for c in cols])


def running(df: DataFrame, keys: list[str], order: list[str], folds: dict[str, tuple[Column, str]]) -> DataFrame:
    """df with folds (name -> column, 'max' or 'sum') over the rows before each row of its key; null before the first.

    Rows are cut as in `lag_over`; within a partition a window folds, and what
    came before it is carried over by a table of one row per partition, so a
    key with a third of all rows is spread over many tasks.  The order must be
    total within a key.
    """
    stash = Stash(df.sparkSession)
    marked = df.select("*", *[c.alias(f"__{n}") for n, (c, _) in folds.items()])
    cut = marked.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    cut = stash.put(cut, "sorted")
    fold = {"max": F.max, "sum": F.sum}
    ends = cut.groupBy("__part").agg(F.min_by(F.struct(*keys), "__at").alias("__first"), F.max_by(F.struct(*keys), "__at").alias("__last"))
    own = cut.groupBy("__part", *keys).agg(*[fold[how](f"__{n}").alias(f"__{n}") for n, (_, how) in folds.items()])
    same = F.col("e.__part") == F.col("o.__part")
    for k in keys:
        same = same & F.col(f"e.__last.{k}").eqNullSafe(F.col(f"o.{k}"))
    tails = own.alias("o").join(F.broadcast(ends).alias("e"), same).select("e.__part", "e.__first", "e.__last", *[f"o.__{n}" for n in folds])
    so_far = Window.partitionBy("__last").orderBy("__part")
    tails = tails.select("__part", "__first", "__last", *[fold[how](f"__{n}").over(so_far).alias(f"__{n}") for n, (_, how) in folds.items()])
    before = Window.orderBy("__part")  # a row per partition
    carried = tails.select("__part", "__first", F.lag(F.struct("__last", *[f"__{n}" for n in folds])).over(before).alias("__c")).where(F.col("__first").eqNullSafe(F.col("__c.__last")))
    both = cut.join(F.broadcast(carried.select("__part", "__first", "__c")), "__part", "left")
    within = Window.partitionBy("__part", *keys).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    mine = F.struct(*keys).eqNullSafe(F.col("__first"))
    out = []
    for n, (_, how) in folds.items():
        here, there = fold[how](f"__{n}").over(within), F.when(mine, F.col(f"__c.__{n}"))
        out.append((F.greatest(here, there) if how == "max" else F.coalesce(here + there, here, there)).alias(n))
    return both.select(*df.columns, *out)


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """X-03, W-03: the first row of each key in the given order, by an aggregate that combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return first.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def last_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """A-11: the last row of each key in the given order."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return last.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Rows numbered from 1 in the order of the partitions, without moving any of them.

    The partitions must come out the same whenever they are read, as those of
    files and written tables do.
    """
    marked = df.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offset = marked.groupBy("__part").agg(F.count("*").alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))  # a row per partition
    return marked.join(F.broadcast(offset), "__part").select((F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1).alias(name), *df.columns)


def ranked(df: DataFrame, order: list, name: str) -> DataFrame:
    """O-06: places in a total order over the whole table, by range partitions."""
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stash = Stash(df.sparkSession)
    # one file per range: its name, not its size, says where it stands
    cut = stash.put(cut.withColumn("__range", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id()), "ranges")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offset = cut.groupBy("__range").agg(F.count("*").alias("__n")).select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return cut.join(F.broadcast(offset), "__range").select((F.col("__before") + F.col("__row").bitwiseAND((1 << 33) - 1) + 1).alias(name), *df.columns)
