"""Near-duplicate records over an exact byte-position index (problem 4).

A record is the set of its distinct runs of `RUN` consecutive words, each run a
64-bit hash.  Read as a sparse byte vector, a hash names a position (its upper
bytes) and the byte standing there (its lowest one); two records share a
positional byte where both agree in all of it.  A vector of 256 positions, as
of a short digest, would make every posting list a fixed share of the corpus
and the tally quadratic, so the positions are not folded down.

Guaranteed minimum.  For a similarity of at least NUM/DEN two sets of n_a and
n_b runs share at least alpha = ceil(NUM * (n_a + n_b) / (NUM + DEN)) of them.
Under any order common to all records, the first m shared runs stand within
the first n - ceil(n * NUM / DEN) + m runs of each record, and the k-th of them
leaves at least alpha - k behind itself in both.  So only these entries are
indexed, a pair is tallied only at entries that leave enough, and it is kept if
its tally reaches min(m, alpha).  No similar pair is lost: this holds whatever
the order.  The order puts the corpus' commonest runs last, from counts over
all records, of which the heaviest `HEAVY` (a bounded table) are broadcast.
Kept pairs are verified on the whole sets.

Exact copies and records with equal sets are one class from the start; pairs
are formed between classes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.llm.consistent import words
from provlake.session import Stash

NUM, DEN = 3, 5
RUN, LEAST_WORDS, MATCHES = 3, 40, 3
#: Most rows of the broadcast table of common runs (16 bytes each).
HEAVY = 1 << 18
#: Classes that hold a run, for each of which its part of the index gets one more block; pairs of blocks are met in tasks of their own.
HOT = 4096
MOST_BLOCKS = 1 << 15
#: Words that a task works on at once.
FLUSH = 1_000_000

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _WordHash(defaultdict):
    """word -> 32-bit hash, kept per worker; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 20:
            self.clear()
        h = self[word] = xxhash.xxh32_intdigest(word) - (1 << 31)
        return h


_HASHES = _WordHash()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _runs(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All distinct runs of a batch as (record, hash), in that order."""
    w = flat.astype(np.int64).view(np.uint64) + _M1
    h = w[: len(w) - RUN + 1].copy()
    for k in range(1, RUN):
        h = _mix(h * _M1 + w[k : len(w) - RUN + 1 + k])
    rec = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(h)]
    inside = rec == np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[RUN - 1 :]
    h, rec = h[inside].view(np.int64), rec[inside]
    order = np.lexsort((h, rec))
    h, rec = h[order], rec[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (rec[1:] != rec[:-1])
    return rec[fresh], h[fresh]


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _pieces(b: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about FLUSH words, or of one record."""
    if not b.num_rows:
        return
    ends = b.column(column).offsets.to_numpy()
    lo = 0
    while lo < b.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + FLUSH, "right")) - 1)
        yield b.slice(lo, hi - lo)
        lo = hi


def _described(ids: list[int], own: list[np.ndarray]) -> pa.RecordBatch:
    """Records with the key and the size of their set of runs, and their words."""
    flat, offsets = np.concatenate(own), np.concatenate([[0], np.cumsum([len(w) for w in own])])
    rec, h = _runs(flat, offsets)
    starts = np.searchsorted(rec, np.arange(len(ids)))
    n = np.diff(np.append(starts, len(rec)))
    u = h.view(np.uint64)
    k1, k2 = (np.add.reduceat(_mix(u * a), starts).view(np.int64) for a in (_M1, _M3))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(k1), pa.array(k2), pa.array(n.astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))], names=["id", "k1", "k2", "n", "words"]
    )


def _sets(batches: Iterator[pa.RecordBatch], least_words: int) -> Iterator[pa.RecordBatch]:
    get = _HASHES.__getitem__
    for b in batches:
        ids, own, held = [], [], 0
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            w = words(t)
            if len(w) >= least_words:
                ids.append(i)
                own.append(np.fromiter(map(get, w), np.int32, len(w)))
                held += len(w)
                if held >= FLUSH:
                    yield _described(ids, own)
                    ids, own, held = [], [], 0
        if ids:
            yield _described(ids, own)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part in _pieces(b, 0):
            _, h = _runs(*_flat(part.column(0)))
            token, c = np.unique(h, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(c.astype(np.int64))], names=["token", "c"])


def _entries(batches: Iterator[pa.RecordBatch], heavy, hot: int) -> Iterator[pa.RecordBatch]:
    tokens, weights = heavy.value
    for b in (part for whole in batches for part in _pieces(whole, 1)):
        rec, h = _runs(*_flat(b.column(1)))
        at = np.searchsorted(tokens, h)
        at[at == len(tokens)] = 0
        weight = np.where(tokens[at] == h, weights[at], 0) if len(tokens) else np.zeros(len(h), np.int64)
        order = np.lexsort((h, weight, rec))
        rec, h = rec[order], h[order]
        starts = np.searchsorted(rec, np.arange(b.num_rows))
        n = np.diff(np.append(starts, len(rec)))
        pos = np.arange(len(rec)) - starts[rec]
        keep = pos < (n - (n * NUM + DEN - 1) // DEN + MATCHES)[rec]
        blocks = np.minimum(1 + weight[order] // hot, MOST_BLOCKS)[keep]  # before the rows are thinned
        rec, h, pos = rec[keep], h[keep], pos[keep]
        ids = b.column(0).to_numpy(zero_copy_only=False)[rec]
        # an entry of a run in B blocks stands in the B cells that its own block shares with each
        own = (_mix(ids.view(np.uint64) * _M1) % blocks.astype(np.uint64)).astype(np.int64)
        row = np.repeat(np.arange(len(h)), blocks)
        other = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        mine, size = own[row], blocks[row]
        cell = np.minimum(mine, other) * size + np.maximum(mine, other)
        columns = (h[row], ids[row], (n[rec].astype(np.int64) << 32 | pos)[row], mine << 47 | size << 31 | cell)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "id", "np", "at"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in (part for whole in batches for part in _pieces(whole, 2)):
        sides = []
        for c in (2, 3):
            rec, h = _runs(*_flat(b.column(c)))
            sides.append((rec, h))
        rec, h = (np.concatenate([sides[0][k], sides[1][k]]) for k in (0, 1))
        order = np.lexsort((h, rec))
        rec, h = rec[order], h[order]
        twice = (h[1:] == h[:-1]) & (rec[1:] == rec[:-1])
        shared = np.bincount(rec[1:][twice], minlength=b.num_rows)
        union = np.bincount(rec, minlength=b.num_rows) - shared
        ok = np.flatnonzero(shared * DEN >= union * NUM)
        take = pa.array(ok)
        yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(shared[ok] / union[ok])], names=["a", "b", "similarity"])


class NearDuplicates:
    """The stages over one table; see the module's text.

    Null and empty texts and texts below `LEAST_WORDS` words are in no pair and
    form no class.  Ids are taken as unique; only id and text are read.
    """

    def __init__(self, df: DataFrame, id_col: str, text_col: str, least_words: int = LEAST_WORDS):
        self.spark, self.stash = df.sparkSession, Stash(df.sparkSession)
        least_words = max(least_words, RUN)
        picked = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
        sets = self.stash.put(picked.mapInArrow(partial(_sets, least_words=least_words), "id bigint, k1 bigint, k2 bigint, n int, words array<int>"), "sets")
        reps = sets.groupBy("k1", "k2").agg(F.min("id").alias("rep"))
        #: (id, rep): every record with its class, named by the smallest id.
        self.members = self.stash.put(sets.select("id", "k1", "k2").join(reps, ["k1", "k2"]).select("id", "rep"), "members")
        one_each = self.members.where("id = rep").select("id")
        self.records = self.stash.put(sets.select("id", "n", "words").join(one_each.hint("shuffle_hash"), "id", "left_semi"), "records")
        self.stash.drop("sets")

    def _heavy(self) -> tuple[np.ndarray, np.ndarray]:
        """Runs in most classes, from counts over all of them: at most HEAVY rows."""
        counted = self.records.select("words").mapInArrow(_counts, "token bigint, c bigint").groupBy("token").agg(F.sum("c").alias("c")).where("c > 2")
        common = self.stash.put(counted, "common")
        bound, held = None, 0
        by_octave = common.groupBy(F.floor(F.log2("c") * 16).cast("int").alias("step")).count().orderBy(F.desc("step")).collect()  # a few hundred rows at most
        for row in by_octave:
            held += row["count"]
            if held > HEAVY:
                break
            bound = row["step"]
        if bound is None:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        table = common.where(F.floor(F.log2("c") * 16) >= bound).toArrow()
        token, c = table.column("token").to_numpy(), table.column("c").to_numpy()
        order = np.argsort(token)
        self.stash.drop("common")
        return token[order], c[order]

    def candidates(self) -> DataFrame:
        """(a, b) of classes whose tally reaches the guaranteed minimum."""
        heavy = self.spark.sparkContext.broadcast(self._heavy())
        index = self.records.select("id", "words").mapInArrow(partial(_entries, heavy=heavy, hot=HOT), "token bigint, id bigint, np bigint, at bigint")
        x, y = index.alias("x"), index.alias("y")
        # packed, since every column weighs in the shuffle: at holds own block, number of blocks and cell; np size and place
        nx, ny, px, py = (F.expr(f"{e.format(s)}") for e in ("shiftright({}.np, 32)", "({}.np & 4294967295)") for s in "xy")
        bx, by, cells = F.expr("shiftright(x.at, 47)"), F.expr("shiftright(y.at, 47)"), F.expr("shiftright(x.at, 31) & 65535")
        alpha = F.floor((NUM * (nx + ny) + NUM + DEN - 1) / (NUM + DEN))
        left = F.least(nx - px, ny - py)
        once = F.least(bx, by) * cells + F.greatest(bx, by) == F.expr("x.at & 2147483647")  # a pair of blocks meets in one cell
        met = x.join(
            y,
            (F.col("x.token") == F.col("y.token")) & (F.expr("x.at & 2147483647") == F.expr("y.at & 2147483647")) & (F.col("x.id") < F.col("y.id"))
            & (F.least(nx, ny) * DEN >= F.greatest(nx, ny) * NUM) & (left >= alpha - (MATCHES - 1)) & once,
        )
        tally = met.groupBy(F.col("x.id").alias("a"), F.col("y.id").alias("b")).agg(F.count("*").alias("met"), F.min(F.least(F.lit(MATCHES), alpha)).alias("least"))
        return tally.where("met >= least").select("a", "b")

    def links(self) -> DataFrame:
        """(a, b, similarity) of all pairs of classes that are similar enough, verified."""
        pairs = self.stash.put(self.candidates(), "pairs")
        mine = self.records.select(F.col("id").alias("a"), F.col("words").alias("wa"))
        theirs = self.records.select(F.col("id").alias("b"), F.col("words").alias("wb"))
        both = pairs.join(mine, "a").join(theirs, "b").select("a", "b", "wa", "wb")
        links = self.stash.put(both.mapInArrow(_verify, "a bigint, b bigint, similarity double"), "links")
        self.stash.drop("pairs")
        self.stash.drop("records")
        return links


def near_duplicate_pairs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every pair of records, smaller id first, exact copies included.

    The result has as many rows as there are pairs; use `near_duplicate_groups`
    where groups of copies are large.
    """
    run = NearDuplicates(df, id_col, text_col)
    links = run.links().select("a", "b")
    m = run.members
    several = m.groupBy("rep").agg(F.count("*").alias("k")).where("k > 1").select("rep")
    copies = m.join(several, "rep", "left_semi")
    x, y = copies.alias("x"), copies.alias("y")
    within = x.join(y, (F.col("x.rep") == F.col("y.rep")) & (F.col("x.id") < F.col("y.id"))).select(F.col("x.id").alias("x"), F.col("y.id").alias("y"))
    across = links.join(m.select(F.col("rep").alias("a"), F.col("id").alias("x")), "a").join(m.select(F.col("rep").alias("b"), F.col("id").alias("y")), "b").select("x", "y")
    return within.unionByName(across).select(F.least("x", "y").alias(f"{id_col}_a"), F.greatest("x", "y").alias(f"{id_col}_b"))


def components(stash: Stash, edges: DataFrame) -> DataFrame:
    """(id, root): connected components by alternating large and small stars.

    Every round is written to the shared folder; the number of rounds grows with
    the logarithm of the longest chain.
    """
    now = stash.put(edges.selectExpr("greatest(a, b) as u", "least(a, b) as v").where("u <> v").distinct(), "star0")
    for k in range(1, 1000):
        both = now.unionByName(now.selectExpr("v as u", "u as v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").selectExpr("v as u", "m as v").where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.selectExpr("v as u", "m as v").unionByName(small.selectExpr("u", "m as v")).where("u <> v").distinct()
        after = stash.put(small, f"star{k}")
        same = after.count() == now.count() and not after.join(now, ["u", "v"], "left_anti").head(1)
        stash.drop(f"star{k - 1}")
        now = after
        if same:
            return now.select(F.col("u").alias("id"), F.col("v").alias("root"))
    raise RuntimeError("components do not settle")


def near_duplicate_groups(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per record of enough words: class, group (connected classes), links of its class."""
    run = NearDuplicates(df, id_col, text_col)
    links = run.links().select("a", "b")
    roots = components(run.stash, links)
    degree = links.selectExpr("a as rep").unionByName(links.selectExpr("b as rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    return (
        run.members.join(roots.withColumnRenamed("id", "rep"), "rep", "left").join(degree, "rep", "left")
        .select(F.col("id").alias(id_col), F.col("rep").alias("class_id"), F.coalesce("root", "rep").alias("group_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
    )
