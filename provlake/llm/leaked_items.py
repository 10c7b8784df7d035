"""Evaluation passages inside training text (problem 7).

The held-out items are a small fixed set; their words make one Aho-Corasick
automaton, with which every document is scanned once, whole.  A passage is a
run of `RUN` or more words of an item.  Every such run contains one of the
item's blocks of `BLOCK` words that begin at multiples of BLOCK, so the
automaton holds these blocks; a hit is extended word by word to both sides and
counts if the common run is long enough.

Null and empty documents and items hold nothing; items of fewer than RUN words
cannot leak; repeated items each count.  Items beyond `ITEM_BYTES` of text are
scanned for in several automata one after the other.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.llm.consistent import consistent, skeleton, words

RUN = 13
BLOCK = (RUN + 1) // 2
#: Bound of what one automaton is built from and one broadcast carries.
ITEM_BYTES = 8 << 20


def _automaton(items: list[tuple[int, list[str]]]):
    found: dict[str, list[tuple[int, int]]] = {}
    for k, (_, w) in enumerate(items):
        for j in range(0, len(w) - BLOCK + 1, BLOCK):
            found.setdefault(" " + " ".join(w[j : j + BLOCK]) + " ", []).append((k, j))
    auto = ahocorasick.Automaton()
    for key, where in found.items():
        auto.add_word(key, (len(key), where))
    if found:
        auto.make_automaton()
    return auto if found else None


_built: dict[int, tuple] = {}


def _auto_of(broadcast) -> tuple:
    """(automaton, items), built once in a worker."""
    key = id(broadcast.value)
    if key not in _built:
        _built.clear()
        _built[key] = (_automaton(broadcast.value), broadcast.value)
    return _built[key]


def runs_in(doc: list[bytes], auto, items: list[tuple[int, list[str]]]) -> list[tuple[int, int, int]]:
    """(item index, first word in the document, words) of the maximal common runs."""
    line = " " + b" ".join(doc).decode("utf-8") + " "
    hits = list(auto.iter(line))
    if not hits:
        return []
    begin = np.cumsum([1] + [len(w.decode("utf-8")) + 1 for w in doc])[:-1]
    plain = [w.decode("utf-8") for w in doc]
    out: set[tuple[int, int, int]] = set()
    reach: dict[tuple[int, int], int] = {}  # how far a common run is known already, by item and shift
    for end, (length, where) in hits:
        i = int(np.searchsorted(begin, end - length + 2))
        for k, j in where:
            w = items[k][1]
            if i < reach.get((k, i - j), 0):
                continue
            lo, hi = 0, BLOCK
            while i - lo > 0 and j - lo > 0 and plain[i - lo - 1] == w[j - lo - 1]:
                lo += 1
            while i + hi < len(plain) and j + hi < len(w) and plain[i + hi] == w[j + hi]:
                hi += 1
            reach[k, i - j] = i + hi
            if lo + hi >= RUN:
                out.add((k, i - lo, lo + hi))
    return sorted(out)


@lru_cache(maxsize=1)
def _leaning() -> frozenset[str]:
    """Characters that may become one with the character before them: marks, and those that compose though they are none."""
    found = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    for cp in range(0xC0, sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(cp)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(chr(int(parts[1], 16)))
    return frozenset(found)


@lru_cache(maxsize=1 << 16)
def _leans(ch: str) -> bool:
    """Whether a character belongs to the one before it: without width, a mark, or composing with it."""
    if ch < "\x80":
        return False
    said = skeleton(ch)
    return not said or unicodedata.combining(said[0]) > 0 or said[0] in _leaning()


@lru_cache(maxsize=1 << 16)
def _said(piece: str) -> str:
    return consistent(piece).lower()


def word_spans(text: str) -> list[tuple[int, int]]:
    """Where each word of the consistent text stands in the original, one for one.

    The text is cut where nothing composes over the cut, so the consistent forms
    of the pieces, one after the other, have the length of that of the whole.
    """
    starts = [i for i, ch in enumerate(text) if not i or not _leans(ch)] + [len(text)]
    spans, begin, last = [], None, 0
    for lo, hi in pairwise(starts):
        for ch in _said(text[lo:hi]):
            if ch.isalnum():
                begin, last = lo if begin is None else begin, hi
            elif begin is not None:
                spans.append((begin, last))
                begin = None
    if begin is not None:
        spans.append((begin, last))
    return spans


def _item_chunks(items: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[int, list[str]]]]:
    chunk, held = [], 0
    for row in items.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t")).where("i is not null and t is not null").toLocalIterator():
        w = [x.decode("utf-8") for x in words(row["t"])]
        if len(w) < RUN:
            continue
        held += sum(map(len, w))
        if chunk and held > most:
            yield chunk
            chunk, held = [], sum(map(len, w))
        chunk.append((row["i"], w))
    if chunk:
        yield chunk


def leaked_passages(docs: DataFrame, id_col: str, text_col: str, items: DataFrame, item_id: str, item_text: str, most: int = ITEM_BYTES) -> DataFrame:
    """(document, item, run of words, start and end in the original text), one row per common run."""
    spark = docs.sparkSession
    schema = f"{id_col} bigint, {item_id} bigint, n_words int, start_char int, end_char int"
    picked = docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t")).where("i is not null and t is not null")
    result = None
    for chunk in _item_chunks(items, item_id, item_text, most):
        sent = spark.sparkContext.broadcast(chunk)

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            auto, held = _auto_of(sent)
            for b in batches:
                rows = []
                for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    own = words(t)
                    if len(own) < RUN:
                        continue
                    met = runs_in(own, auto, held)
                    if met:
                        spans = word_spans(t)
                        if len(spans) != len(own):
                            raise RuntimeError(f"words of document {i} have no places")
                        rows += [(i, held[k][0], n, spans[at][0], spans[at + n - 1][1]) for k, at, n in met]
                yield pa.RecordBatch.from_pylist([dict(zip((id_col, item_id, "n_words", "start_char", "end_char"), r)) for r in rows], pa.schema([(id_col, pa.int64()), (item_id, pa.int64()), ("n_words", pa.int32()), ("start_char", pa.int32()), ("end_char", pa.int32())]))

        part = picked.mapInArrow(scan, schema)
        result = part if result is None else result.unionByName(part)
    return result if result is not None else spark.createDataFrame([], schema)


def leaked_items(docs: DataFrame, id_col: str, text_col: str, items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """(document, item) pairs, each once."""
    return leaked_passages(docs, id_col, text_col, items, item_id, item_text).select(id_col, item_id).distinct()
