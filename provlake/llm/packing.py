"""Filling containers of fixed capacity with documents (problem 6).

A grouping genetic algorithm: a solution is a set of bins; crossover injects
whole well-filled bins of one parent into the other, removes the bins that
hold the same documents, and puts the displaced ones back by best fit.  The
documents are dealt into shards by a hash of their id; each shard evolves on
several islands, whose best solutions migrate to the next island between
rounds.  Bins that stay poorly filled are dissolved and packed once more across
shards.

Only a document above the capacity is split: into full containers and a rest.
Null texts and texts of no tokens need no container and are left out.
"""

from __future__ import annotations

import base64
import os
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.session import Stash

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Pieces in a shard (about), islands per shard, rounds, and the size of a population.
SHARD, ISLANDS, ROUNDS, POPULATION, GENERATIONS = 1500, 2, 2, 5, 6
#: More capacities than this are refused, as their table is broadcast.
MOST_CAPACITIES = 100_000
#: Bins filled to less than this share are dissolved after the first packing.
WELL_FILLED = 0.97


@lru_cache(maxsize=2)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _count(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    encode = _encoding(SparkFiles.get(name)).encode_ordinary
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(encode(t)) for t in b.column(1).to_pylist()], pa.int64())], names=["id", "n_tokens"])


def token_counts(docs: DataFrame, id_col: str, text_col: str, path: str = TOKENIZER) -> DataFrame:
    """(id, n_tokens) of whole texts; the vocabulary file is read on the driver's machine and shipped to the workers."""
    docs.sparkSession.sparkContext.addFile(path)
    picked = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    return picked.mapInArrow(partial(_count, name=os.path.basename(path)), "id bigint, n_tokens bigint")


class _Bins:
    """A solution: lists of pieces and their free space."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.free, self.open = capacity, [], [], []

    def add(self, pieces: list[int], used: int) -> None:
        insort(self.open, (self.capacity - used, len(self.bins)))
        self.free.append(self.capacity - used)
        self.bins.append(pieces)

    def best_fit(self, order: list[int], sizes: list[int]) -> None:
        for i in order:
            s = sizes[i]
            at = bisect_left(self.open, (s, -1))
            if at < len(self.open):
                room, k = self.open.pop(at)
                self.bins[k].append(i)
                self.free[k] = room - s
                insort(self.open, (room - s, k))
            else:
                self.add([i], s)

    def fitness(self) -> float:
        """Mean squared fill: prefers few bins, and full ones among them."""
        c = self.capacity
        return sum(((c - f) / c) ** 2 for f in self.free) / max(1, len(self.bins))


def _cross(a: _Bins, b: _Bins, sizes: list[int], rng: np.random.Generator) -> _Bins:
    ranked = np.argsort(a.free, kind="stable")
    n = max(1, int(len(ranked) * rng.uniform(0.2, 0.6)))
    good = ranked[: max(n, 1)]
    if len(good) > 2:
        lo = int(rng.integers(0, max(1, len(good) // 3)))
        good = good[lo:]
    child = _Bins(a.capacity)
    held = set()
    for k in good.tolist():
        child.add(list(a.bins[k]), a.capacity - a.free[k])
        held.update(a.bins[k])
    loose = []
    for k, pieces in enumerate(b.bins):
        if held.isdisjoint(pieces):
            child.add(list(pieces), b.capacity - b.free[k])
        else:
            loose += [i for i in pieces if i not in held]
    child.best_fit(sorted(loose, key=lambda i: -sizes[i]), sizes)
    return child


def _from_genome(genome: list[int], sizes: list[int], capacity: int) -> _Bins:
    found: dict[int, list[int]] = {}
    for i, g in enumerate(genome):
        found.setdefault(g, []).append(i)
    s = _Bins(capacity)
    for pieces in found.values():
        s.add(pieces, sum(sizes[i] for i in pieces))
    return s


def evolve(sizes: list[int], capacity: int, seed: int, migrants: list[list[int]]) -> list[int]:
    """The best genome (bin of each piece) of an island after its generations."""
    rng = np.random.default_rng(seed)
    least = -(-sum(sizes) // capacity)
    population = [_from_genome(g, sizes, capacity) for g in migrants]
    while len(population) < POPULATION:
        s = _Bins(capacity)
        noise = rng.normal(1, 0.0 if not population else 0.08, len(sizes))
        s.best_fit(np.argsort(-np.array(sizes) * noise, kind="stable").tolist(), sizes)
        population.append(s)
        if len(s.bins) == least:
            break
    for _ in range(GENERATIONS):
        population.sort(key=lambda s: (len(s.bins), -s.fitness()))
        if len(population[0].bins) <= least or len(population) < 2:
            break
        children = [_cross(population[i], population[j], sizes, rng) for i, j in (rng.choice(len(population), 2, replace=False) for _ in range(POPULATION - 1))]
        population = sorted(population[:2] + children, key=lambda s: (len(s.bins), -s.fitness()))[:POPULATION]
    best = min(population, key=lambda s: (len(s.bins), -s.fitness()))
    genome = [0] * len(sizes)
    for k, pieces in enumerate(best.bins):
        for i in pieces:
            genome[i] = k
    return genome


def _round(frames: Iterator[pd.DataFrame], number: int) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        genomes = []
        for r in pdf.itertuples(index=False):
            seed = (((r.pack_id * 1_000_003 + r.shard) * 31 + r.island) * 31 + number) % (1 << 32)
            genomes.append(evolve([int(s) for s in r.sizes], int(r.capacity), seed, [[int(x) for x in g] for g in (r.own, r.guest) if g is not None and len(g)]))
        yield pdf[["pack_id", "capacity", "shard", "island", "rows", "ids", "pieces", "sizes"]].assign(genome=genomes)


_KEYS = "pack_id bigint, capacity bigint, shard bigint, island int, rows array<bigint>, ids array<bigint>, pieces array<bigint>, sizes array<bigint>"


def _pack(items: DataFrame, stash: Stash, name: str) -> DataFrame:
    """(pack_id, capacity, row, id, piece, size, bin) for items (pack_id, capacity, row, id, piece, size, shards)."""
    shards = items.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.col("shards"))).groupBy("pack_id", "capacity", "shard")
    sorted_items = F.sort_array(F.collect_list(F.struct("id", "piece", "size", "row")))  # SHARD pieces on the average, by a hash
    base = shards.agg(sorted_items.alias("x")).select("pack_id", "capacity", "shard", F.col("x.row").alias("rows"), F.col("x.id").alias("ids"), F.col("x.piece").alias("pieces"), F.col("x.size").alias("sizes"))
    empty = F.lit(None).cast("array<int>")
    now = base.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))).withColumn("own", empty).withColumn("guest", empty)
    now = now.repartition(F.xxhash64("pack_id", "shard", "island"))
    for k in range(ROUNDS):
        done = stash.put(now.mapInPandas(partial(_round, number=k), _KEYS + ", genome array<int>"), f"{name}{k}")
        if k + 1 < ROUNDS:
            guests = done.select("pack_id", "shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"), F.col("genome").alias("guest"))
            now = done.withColumnRenamed("genome", "own").join(guests, ["pack_id", "shard", "island"])
    best = done.groupBy("pack_id", "capacity", "shard").agg(F.min_by(F.struct("rows", "ids", "pieces", "sizes", "genome"), F.struct(F.array_max("genome"), "island")).alias("b"))
    each = best.select("pack_id", "capacity", "shard", F.explode(F.arrays_zip("b.rows", "b.ids", "b.pieces", "b.sizes", "b.genome")).alias("z"))
    return each.select("pack_id", "capacity", F.col("z.rows").alias("row"), F.col("z.ids").alias("id"), F.col("z.pieces").alias("piece"), F.col("z.sizes").alias("size"), F.concat_ws("-", F.lit(name), "shard", F.col("z.genome").cast("string")).alias("bin"))


def pack(docs: DataFrame, packs: DataFrame, id_col: str, text_col: str, path: str = TOKENIZER) -> DataFrame:
    """(pack_id, container, id, piece, n_tokens): every document in a container of each capacity.

    `piece` counts the parts of a split document from 0; other documents have
    the one piece 0.
    """
    spark = docs.sparkSession
    stash = Stash(spark)
    # every row has a number of its own, so that rows with one id are dealt out too
    counts = stash.put(token_counts(docs, id_col, text_col, path).where("n_tokens > 0").withColumn("row", F.monotonically_increasing_id()), "tokens")
    sized = packs.select(F.col("pack_id").cast("bigint").alias("pack_id"), F.col("capacity_tokens").cast("bigint").alias("capacity")).where("capacity > 0").groupBy("pack_id").agg(F.min("capacity").alias("capacity"))
    if sized.count() > MOST_CAPACITIES:
        raise ValueError(f"more than {MOST_CAPACITIES} capacities")
    both = counts.crossJoin(F.broadcast(sized))  # a row for each document and capacity is the result itself
    full = both.where("n_tokens >= capacity").select("pack_id", "capacity", "row", "id", F.explode(F.expr("sequence(0L, n_tokens div capacity - 1)")).alias("piece"), F.col("capacity").alias("size"))
    full = full.withColumn("bin", F.concat_ws("-", F.lit("full"), F.col("row").cast("string"), F.col("piece").cast("string")))
    rest = both.where("n_tokens % capacity > 0").select("pack_id", "capacity", "row", "id", F.expr("n_tokens div capacity").alias("piece"), F.expr("n_tokens % capacity").alias("size"))
    n = max(1, -(-counts.count() // SHARD))
    first = stash.put(_pack(rest.withColumn("shards", F.lit(n)), stash, "a"), "first")
    filled = first.groupBy("pack_id", "capacity", "bin").agg(F.sum("size").alias("used"))
    poor = filled.where(f"used < {WELL_FILLED} * capacity").select("pack_id", "bin")
    again = first.join(poor, ["pack_id", "bin"], "left_semi").drop("bin")
    again = stash.put(again, "again")
    left = {r["pack_id"]: r["count"] for r in again.groupBy("pack_id").count().collect()}  # a row per capacity
    number = F.lit(1)
    for p, c in left.items():
        number = F.when(F.col("pack_id") == p, F.lit(max(1, -(-c // SHARD)))).otherwise(number)
    second = _pack(again.withColumn("shards", number), stash, "b")
    kept = first.join(poor, ["pack_id", "bin"], "left_anti")
    out = [x.select("pack_id", F.col("bin").alias("container"), F.col("id").alias(id_col), "piece", F.col("size").alias("n_tokens")) for x in (full, kept, second)]
    return out[0].unionByName(out[1]).unionByName(out[2])


def usage(packed: DataFrame, packs: DataFrame) -> DataFrame:
    """Containers, tokens and unused share per capacity, with the least number of containers possible."""
    size = packs.select(F.col("pack_id").cast("bigint").alias("pack_id"), F.col("capacity_tokens").alias("capacity"))
    per = packed.groupBy("pack_id", "container").agg(F.sum("n_tokens").alias("used")).groupBy("pack_id").agg(F.count("*").alias("n_containers"), F.sum("used").alias("n_tokens"), F.max("used").alias("fullest"))
    return per.join(size, "pack_id").select("pack_id", "capacity", "n_containers", "n_tokens", "fullest", F.ceil(F.col("n_tokens") / F.col("capacity")).alias("least_containers"), (1 - F.col("n_tokens") / (F.col("n_containers") * F.col("capacity"))).alias("unused_share"))
