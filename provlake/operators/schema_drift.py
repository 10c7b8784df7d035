"""Schemas that drift between files (problem 2).

Every file of a feed is profiled in one distributed pass: for each dotted path
how many records carry it, of which type its values are, and fixed-length
histograms of what they look like.  The profiles of a file and the one before
it become two schema graphs of names, types and nesting; similarity flooding
propagates match scores between them until they stand still.  Of the pairs
whose content is alike (a filter), those are selected one to one, best first,
whose flooded score is a large enough share of the score that either field has
with itself.  What stays without a partner was added or removed.

For the one table, the fields of all feeds are matched in the same way, by one
more flooding over the schema of all feeds, and all records are cast and united.

Defined results: bodies that are null, unreadable or no JSON object are counted
as records of no field; an empty object carries nothing; a field whose values
are all null has no type and cannot change it; a file without a predecessor
(file_no less 1) has no changes; repeated records count as often as delivered.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cached_property, lru_cache, partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provlake.session import Stash

#: A field belongs to a file if more than this share of its records carry the key.
LEAST_SHARE = 0.1
WORD_BINS, SHAPE_BINS = 64, 32
#: Rounds of flooding, at most; the scores of a schema stand still after some dozens.
ROUNDS = 1000
#: Filter: likeness of content (values, and a little the names) that a rename needs.
LIKE, NAME_SHARE = 0.71, 0.1
#: Selection: the least share of the fields' scores with themselves that a flooded score must reach.
LEAST_SCORE = 0.2
#: Fields are two if more than this share of the rarer one's records carry both.
BESIDE = 0.05
CHANGES = "feed string, file_no int, field string, change string, new_field string"


def flatten(record: dict, prefix: str = "") -> Iterator[tuple[str, object]]:
    """(dotted path, value) of all values that are no objects."""
    for key, value in record.items():
        if isinstance(value, dict):
            yield from flatten(value, f"{prefix}{key}.")
        else:
            yield prefix + key, value


_KINDS = {bool: "boolean", int: "number", float: "number", list: "array", str: "string"}


def kind_of(value: object) -> str:
    return _KINDS.get(type(value), "string")


#: Stands between the values of a field that are looked at together.
_END = "\x1f"
# What the characters of ASCII count as (others stand for themselves): a digit, a capital, a letter of hexadecimal
# numbers or another one; in shapes digits and letters; in words small letters, with anything else between them.
_CLASS = np.array([ord("9" if c.isdigit() else "u" if c.isupper() else "h" if c in "abcdef" else "a" if c.isalpha() else c) for c in map(chr, range(128))])
_SHAPE = {k: "9" if chr(k).isdigit() else "a" for k in range(128) if chr(k).isalnum()}
_WORD = {k: "9" if chr(k).isdigit() else chr(k).lower() if chr(k).isalpha() else " " for k in range(128)}
_DIGIT, _LETTER, _NO_WORD, _ASCII = re.compile(r"\d"), re.compile(r"[^\W\d_]"), re.compile(r"[\W_]+"), re.compile(r"[\x00-\x7f]+")
_NUMBER = re.compile(r"\s*[-+]?(\d[\d_]*\.?[\d_]*|\.\d[\d_]*)(e[-+]?\d+)?\s*|\s*[-+]?(nan|inf|infinity)\s*", re.I)
_LONG = re.compile("9{9,}")
_COUNTED = {0xE000 + n: str(n) for n in range(1, 10)}


def _shapes(joined: str) -> Counter:
    """The values' shapes: letters as one a, runs of digits as their length (9 at most), the rest as it is."""
    s = joined if joined.isascii() else _LETTER.sub("a", _DIGIT.sub("9", joined))
    s = _LONG.sub(chr(0xE009), s.translate(_SHAPE))
    for n in range(8, 0, -1):
        s = s.replace("9" * n, chr(0xE000 + n))
    while "aa" in s:
        s = s.replace("aaaaaaaa", "a").replace("aaa", "a").replace("aa", "a")
    return Counter(s.translate(_COUNTED).split(_END))


def _words(joined: str) -> Counter:
    """The values' words in small letters, digits as 9."""
    s = joined if joined.isascii() else _NO_WORD.sub(" ", _DIGIT.sub("9", joined.lower()))
    return Counter(s.translate(_WORD).split())


def _characters(joined: str) -> Counter:
    """The values' characters by class; other letters than those of ASCII count as a."""
    plain = joined.encode("ascii", "ignore")
    n = np.bincount(_CLASS[np.frombuffer(plain, np.uint8)], minlength=128)
    found = Counter({chr(k): int(n[k]) for k in np.flatnonzero(n) if k != ord(_END)})
    if len(plain) < len(joined):
        for ch, c in Counter(_ASCII.sub("", joined)).items():
            found["a" if ch.isalpha() else ch] += c
    return found


def _bin(word: str, bins: int) -> int:
    return zlib.crc32(word.encode(errors="replace")) % bins


def looks(values: list) -> Counter:
    """Histograms of the values of a field, taken whole: words, shapes, magnitudes, lengths and characters."""
    found: Counter = Counter()
    flat, rest = values, []
    if any(type(v) is list for v in values):
        flat, rest = [], values[::-1]
    while rest:
        v = rest.pop()
        if type(v) is list:
            found["s:empty" if not v else f"s:of{kind_of(v[0])}"] += 1
            rest.extend(v[::-1])
        elif v is not None:
            flat.append(v)
    if not flat:
        return found
    strings = [v for v in flat if type(v) is str]
    texts = strings if len(strings) == len(flat) else [v if type(v) is str else str(v) for v in flat]
    joined = _END.join(texts)
    if joined.count(_END) >= len(texts):
        texts = [t.replace(_END, " ") for t in texts]
        strings, joined = [t.replace(_END, " ") for t in strings], _END.join(texts)
    for text in filter(_NUMBER.fullmatch, texts):
        number = abs(float(text))
        found[f"m:{math.floor(math.log2(number) * 2) if number and math.isfinite(number) else 'zero'}"] += 1
    for size, n in Counter(map(len, texts)).items():
        found[f"l:{math.floor(math.log2(size + 1) * 3)}"] += n
    for word, n in _words(joined if strings is texts else _END.join(strings)).items():
        found[f"w:{_bin(word, WORD_BINS)}"] += n
    for ch, n in _characters(joined).items():
        found[f"c:{ch}"] += n
    for shape, n in _shapes(joined).items():
        found[f"s:{_bin(shape, SHAPE_BINS)}"] += n
    return found


def sound(s: str) -> str:
    """Text that can be written: halves of characters, which JSON can spell, become question marks."""
    return s if s.isascii() else s.encode("utf-8", "replace").decode()


def record_of(body: str | None) -> dict:
    """The object that a body holds; empty if it is null, unreadable or no object."""
    try:
        record = json.loads(body) if body else None
    except (ValueError, RecursionError):
        record = None
    return record if isinstance(record, dict) else {}


def _count(batches: Iterator[pa.RecordBatch], beside: bool = False) -> Iterator[pa.RecordBatch]:
    for b in batches:
        records: Counter = Counter()
        sets: Counter = Counter()
        carried: Counter = Counter()
        values: defaultdict[tuple, list] = defaultdict(list)
        for feed, no, body in zip(*(b.column(k).to_pylist() for k in range(3))):
            records[feed, no] += 1
            record = list(flatten(record_of(body)))
            if beside:
                sets[feed, no, frozenset(path for path, value in record if value is not None)] += 1
            for path, value in record:
                if value is None:
                    carried[feed, no, path] += 1
                else:
                    values[feed, no, path].append(value)
        keys, counts = [(feed, no, "", "records") for feed, no in records], list(records.values())
        for at in {*carried, *values}:
            own = values.get(at, [])
            found = looks(own)
            found.update({"n": carried[at] + len(own)})
            for kind, n in Counter(map(type, own)).items():
                found[f"t:{_KINDS[kind]}"] += n
            keys += [(*at, what) for what in found]
            counts += found.values()
        pairs: Counter = Counter()
        for (feed, no, paths), n in sets.items():
            pairs.update({(feed, no, x, f"&:{y}"): n for x, y in combinations(sorted(paths), 2)})
        keys += pairs
        counts += pairs.values()
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), *(pa.array([sound(k[n]) for k in keys], pa.string()) for n in (2, 3)), pa.array(counts, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["feed", "file_no", "path", "what", "c"])


def profiles(records: DataFrame, beside: bool = False) -> DataFrame:
    """(feed, file_no, path, what, c): counts per file, added up before the shuffle; with those of paths in one record, if wanted."""
    picked = records.select("feed", F.col("file_no").cast("int").alias("file_no"), "body").where("feed is not null and file_no is not null")
    counted = picked.mapInArrow(partial(_count, beside=beside), "feed string, file_no int, path string, what string, c bigint")
    return counted.groupBy("feed", "file_no", "path", "what").agg(F.sum("c").alias("c"))


GROUPS = ("w:", "s:", "m:", "l:", "c:")


class Field:
    """What is known of a field: share of the records that carry it, type of most values, histograms of them."""

    def __init__(self, path: str, counts: dict[str, int], records: int):
        self.path, self.share, self.counts = path, counts.get("n", 0) / max(records, 1), counts
        kinds = {k: counts[f"t:{k}"] for k in _KINDS.values() if f"t:{k}" in counts}
        self.kind = min(kinds, key=lambda k: (-kinds[k], k)) if kinds else None

    @cached_property
    def looks(self) -> dict[str, dict[str, int]]:
        found: dict[str, dict] = {g: {} for g in GROUPS}
        for w, c in self.counts.items():
            if w[:2] in found:
                found[w[:2]][w] = c
        return found


@lru_cache(1 << 16)
def _trigrams(name: str) -> frozenset[str]:
    t = f"##{re.sub(r'[^a-z0-9]', '', name.lower())}##"
    return frozenset(t[i : i + 3] for i in range(len(t) - 2))


@lru_cache(1 << 16)
def _stems(name: str) -> frozenset[str]:
    return frozenset(w.lower()[:5] for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+|\d+", name))


@lru_cache(1 << 16)
def name_similarity(a: str, b: str) -> float:
    """Shared parts of two dotted names, by words (cut to stems) and by trigrams."""
    wa, wb, ta, tb = _stems(a), _stems(b), _trigrams(a), _trigrams(b)
    words = len(wa & wb) / max(1, min(len(wa), len(wb)))
    return 0.6 * words + 0.4 * 2 * len(ta & tb) / max(1, len(ta) + len(tb))


def value_similarities(old: list[Field], new: list[Field]) -> np.ndarray:
    """How alike the values of any two fields are: the mean cosine of their histograms; 0 for other types."""
    total, groups = np.zeros((len(old), len(new))), np.zeros((len(old), len(new)))
    for g in GROUPS:
        column = {w: k for k, w in enumerate(sorted({w for f in (*old, *new) for w in f.looks[g]}))}
        sides = []
        for fields in (old, new):
            m = np.zeros((len(fields), len(column)))
            for i, f in enumerate(fields):
                m[i, [column[w] for w in f.looks[g]]] = list(f.looks[g].values())
            sides.append(m / np.maximum(np.sqrt((m * m).sum(1, keepdims=True)), 1e-300))
        total += sides[0] @ sides[1].T
        groups += np.logical_or.outer(sides[0].any(1), sides[1].any(1))
    alike = np.array([[f.kind is not None and f.kind == h.kind for h in new] for f in old], bool).reshape(total.shape)
    return np.where(alike, total / np.maximum(groups, 1), 0.0)


def distinctness(fields: list[Field], values: np.ndarray, beside: np.ndarray | None = None) -> np.ndarray:
    """How far a field's values tell it from those beside it: nothing for truth values, little for one date of several."""
    near = np.where(~np.eye(len(fields), dtype=bool) if beside is None else beside, values, 0.0)
    return np.where([f.kind == "boolean" for f in fields], 0.0, 1 - np.max(near, axis=1, initial=0.0) ** 8)


def _graph(fields: dict[str, Field]) -> tuple[dict[str, str], list[tuple[str, str, str]]]:
    """Nodes of a schema with what they are, and its edges: objects to what they hold, fields to their types."""
    nodes, edges = {"": "object"}, []
    for path, f in fields.items():
        parts = path.split(".")
        outer = ""
        for i in range(1, len(parts)):
            inner = ".".join(parts[:i]) + "."
            if inner not in nodes:
                nodes[inner] = "object"
                edges.append((outer, "holds", inner))
            outer = inner
        nodes["=" + path] = "field"
        edges.append((outer, "holds", "=" + path))
        if f.kind:
            nodes[f"<{f.kind}>"] = "type"
            edges.append(("=" + path, "type", f"<{f.kind}>"))
    return nodes, edges


def flood(old: dict[str, Field], new: dict[str, Field], values: np.ndarray, distinct: np.ndarray, kept: bool = True) -> np.ndarray:
    """Match scores of fields (old by new) after similarity flooding over names, types and nesting.

    A pair starts with the likeness of its values, which counts as far as values
    are distinct here and for the rest as far as the names are alike.  Each
    round adds what the pairs around it hand on, until the scores stand still.
    kept: a name found on both sides is the same field.
    """
    (na, ea), (nb, eb) = _graph(old), _graph(new)
    pairs = {(a, b): i for i, (a, b) in enumerate((a, b) for a in na for b in nb if na[a] == nb[b])}
    row, col = {"=" + a: i for i, a in enumerate(old)}, {"=" + b: j for j, b in enumerate(new)}
    start = np.zeros(len(pairs))
    for (a, b), i in pairs.items():
        if a == b:
            start[i] = 1.0
        elif na[a] == "field":
            d = distinct[row[a], col[b]]
            start[i] = values[row[a], col[b]] ** 4 * (d + (1 - d) * name_similarity(a[1:], b[1:]))
            if kept and (a in col or b in row):
                start[i] *= 0.2
        elif na[a] == "object":
            start[i] = 0.3 * name_similarity(a, b)
    give, take, weight = [], [], []
    for label in ("holds", "type"):
        both = [(pairs[a, b], pairs[c, d]) for a, x, c in ea if x == label for b, y, d in eb if y == label and (a, b) in pairs and (c, d) in pairs]
        out, into = Counter(p for p, _ in both), Counter(q for _, q in both)
        for p, q in both:
            give += (p, q)
            take += (q, p)
            weight += (1 / out[p], 1 / into[q])
    give, take, weight = np.array(give, int), np.array(take, int), np.array(weight)
    score = start.copy()
    for _ in range(ROUNDS):
        flow = start + score
        after = flow + np.bincount(take, weight * flow[give], minlength=len(pairs))
        after /= max(after.max(), 1e-12)
        still = np.abs(after - score).max() < 1e-4
        score = after
        if still:
            return np.array([[score[pairs["=" + a, "=" + b]] for b in new] for a in old]).reshape(len(old), len(new))
    raise RuntimeError("flooding does not converge")


def likely(old: list[Field], new: list[Field], values: np.ndarray) -> np.ndarray:
    """The filter: pairs of like content."""
    names = np.array([[name_similarity(a.path, b.path) for b in new] for a in old]).reshape(values.shape)
    return values + NAME_SHARE * names >= LIKE


def correspondences(old: dict[str, Field], new: dict[str, Field]) -> dict[str, str]:
    """Renamed fields: of like content, with a large enough flooded score, one to one from the best down."""
    gone, came = [a for a in old if a not in new], [b for b in new if b not in old]
    if not gone or not came:
        return {}
    a, b = list(old.values()), list(new.values())
    between, in_old, in_new = value_similarities(a, b), value_similarities(a, a), value_similarities(b, b)
    fit = likely(a, b, between)
    row, col = {x: i for i, x in enumerate(old)}, {y: j for j, y in enumerate(new)}
    asked = [(x, y) for x in gone for y in came if fit[row[x], col[y]]]
    if not asked:
        return {}
    da, db = distinctness(a, in_old), distinctness(b, in_new)
    score = flood(old, new, between, np.minimum.outer(da, db))
    perfect = np.sqrt(np.outer(np.diag(flood(old, old, in_old, np.minimum.outer(da, da))), np.diag(flood(new, new, in_new, np.minimum.outer(db, db)))))
    share = score / perfect
    chosen: dict[str, str] = {}
    used: set[str] = set()
    for x, y in sorted(asked, key=lambda p: (-score[row[p[0]], col[p[1]]], p)):
        if share[row[x], col[y]] >= LEAST_SCORE and x not in chosen and y not in used:
            chosen[x] = y
            used.add(y)
    return chosen


def _fields(paths: np.ndarray, whats: np.ndarray, cs: np.ndarray) -> dict[str, Field]:
    counts: defaultdict[str | None, dict] = defaultdict(dict)
    for path, what, c in zip(paths.tolist(), whats.tolist(), cs.tolist()):
        counts[None if what == "records" else path][what] = c
    records = counts.pop(None, {}).get("records", 0)
    found = {path: Field(path, counts[path], records) for path in sorted(counts)}
    return {path: f for path, f in found.items() if f.share > LEAST_SHARE}


def _compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    feed, no = key
    rows = []
    columns = [pdf[c].to_numpy() for c in ("path", "what", "c")]
    is_old = (pdf["side"] == "old").to_numpy()
    if is_old.any() and not is_old.all():
        old, new = (_fields(*(c[side] for c in columns)) for side in (is_old, ~is_old))
        renamed = correspondences(old, new)
        rows += [(feed, no, a, "renamed", b) for a, b in renamed.items()]
        rows += [(feed, no, a, "removed", "") for a in old if a not in new and a not in renamed]
        rows += [(feed, no, b, "added", "") for b in new if b not in old and b not in renamed.values()]
        rows += [(feed, no, a, "type_changed", "") for a in old if a in new and old[a].kind and new[a].kind and old[a].kind != new[a].kind]
    return pd.DataFrame(rows, columns=["feed", "file_no", "field", "change", "new_field"]).astype({"file_no": "int32"})


def _changes(p: DataFrame, following: DataFrame) -> DataFrame:
    both = p.withColumn("side", F.lit("new")).unionByName(following.withColumn("side", F.lit("old")))
    return both.groupBy("feed", "file_no").applyInPandas(_compare, CHANGES)


def schema_changes(records: DataFrame) -> DataFrame:
    """(feed, file_no, field, change, new_field) between each file and the one before it (file_no less 1).

    A group holds the profiles of two files, whose size is that of their schemas.
    """
    p = profiles(records)
    return _changes(p, p.withColumn("file_no", F.col("file_no") + 1))


def changes_over_gaps(p: DataFrame) -> DataFrame:
    """The same between each file and the next lower number that was delivered, from profiles."""
    files = p.select("feed", "file_no").distinct()
    after = files.withColumn("next", F.lead("file_no").over(Window.partitionBy("feed").orderBy("file_no")))  # a row per file
    following = p.join(after.where("next is not null"), ["feed", "file_no"]).withColumn("file_no", F.col("next")).select(p.columns)
    return _changes(p, following)


def aliases(changes: DataFrame, files: DataFrame) -> DataFrame:
    """(feed, file_no, names, past): for each file the names that its feed's renamed fields have or had, with their first ones, and those of them no longer in use.

    A record of an older shape may come late, so an earlier name stands for its
    field in all later files, also after the field was removed, until an added
    or renamed field takes the name anew.
    """

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        now: dict[str, str] = {}
        past: dict[str, str] = {}
        rows = []
        for no, own in pdf.sort_values("file_no").groupby("file_no"):
            gone, firsts = {}, {}
            for f, c, n in zip(own["field"], own["change"], own["new_field"]):
                if c in ("renamed", "removed"):
                    gone[f] = now.get(f, f)
                if c == "renamed":
                    firsts[n] = gone[f]
                elif c == "added":
                    firsts[f] = f
            for f, first in gone.items():
                now.pop(f, None)
                past[f] = first
            for n, first in firsts.items():
                past.pop(n, None)
                now[n] = first
            rows.append((own["feed"].iloc[0], no, {k: v for k, v in (past | now).items() if k != v}, list(past)))
        return pd.DataFrame(rows, columns=["feed", "file_no", "names", "past"])

    marks = files.select("feed", "file_no", F.lit("").alias("field"), F.lit("file").alias("change"), F.lit("").alias("new_field"))
    return changes.unionByName(marks).groupBy("feed").applyInPandas(chain, "feed string, file_no int, names map<string,string>, past array<string>")


def one_name(fields: dict[str, Field], feeds: dict[str, int], together: set[tuple[str, str]]) -> dict[str, str]:
    """Field -> the name that it has in most feeds, for fields that different feeds call differently.

    together: fields that stand side by side in records, so are not the same.
    """
    names, own = list(fields), list(fields.values())
    if len(own) < 2:
        return {a: a for a in names}
    beside = np.array([[(min(a, b), max(a, b)) in together for b in names] for a in names])
    values = value_similarities(own, own)
    d = distinctness(own, values, beside)
    score = flood(fields, fields, values, np.minimum.outer(d, d), kept=False)
    share = score / np.sqrt(np.outer(np.diag(score), np.diag(score)))
    fit = likely(own, own, values) & (share >= LEAST_SCORE) & ~beside
    groups = {k: {k} for k in range(len(names))}
    of = list(range(len(names)))
    for i, j in sorted(((i, j) for i in range(len(names)) for j in range(i) if fit[i, j]), key=lambda p: (-share[p], names[p[0]], names[p[1]])):
        x, y = groups[of[i]], groups[of[j]]
        if x is y or beside[np.ix_(list(x), list(y))].any():
            continue
        x |= y
        for k in y:
            of[k] = of[i]
    best = lambda g: min(g, key=lambda k: (-feeds[names[k]], names[k]))
    return {names[k]: names[best(groups[of[k]])] for k in range(len(names))}


KEYS = ("feed", "file_no", "rec_no", "rest")


def column_names(fields: list[str]) -> dict[str, str]:
    """Field -> a column name of letters, digits and underscores, unique whatever the case, in the order of the fields."""
    used, named = set(KEYS), {}
    for f in sorted(fields):
        base = name = re.sub(r"\W", "_", f) or "_"
        k = 1
        while name.lower() in used:
            k += 1
            name = f"{base}_{k}"
        used.add(name.lower())
        named[f] = name
    return named


_TRUTH = {"true": True, "yes": True, "1": True, "1.0": True, "false": False, "no": False, "0": False, "0.0": False}


def cast(value: object, kind: str) -> object:
    """The value as its column's type; None if that would lose something."""
    if kind == "string":
        return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    if kind == "array":
        return json.dumps(value if isinstance(value, list) else [value], ensure_ascii=False)
    if kind == "boolean":
        return value if isinstance(value, bool) else None if isinstance(value, list) else _TRUTH.get(str(value).strip().lower())
    if isinstance(value, (bool, list)) or isinstance(value, str) and not _NUMBER.fullmatch(value):
        return None
    try:
        number = float(value)
    except (ValueError, OverflowError):
        return None
    return None if isinstance(value, int) and int(number) != value else number


def _unify(batches: Iterator[pa.RecordBatch], one: dict[str, str], kinds: list[tuple[str, str, str]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    at = {f: (k, kind) for k, (f, _, kind) in enumerate(kinds)}
    for b in batches:
        columns: list[list] = [[None] * b.num_rows for _ in kinds]
        rest = []
        for r, (body, names, past) in enumerate(zip(*(b.column(k).to_pylist() for k in range(3, 6)))):
            names, past = dict(names or []), set(past or [])
            own: dict[int, tuple] = {}
            left = {}
            for raw, value in flatten(record_of(body)):
                if value is None:
                    continue
                path = sound(raw)
                field = names.get(path, path)
                k, kind = at[one.get(field, field)]
                v = cast(value, kind)
                mine = (path in past, path, value, v)
                if v is not None and (k not in own or own[k][0] and not mine[0]):
                    mine, own[k] = own.get(k), mine
                if mine:
                    left[mine[1]] = mine[2]
            for k, (_, _, _, v) in own.items():
                columns[k][r] = sound(v) if isinstance(v, str) else v
            rest.append(sound(json.dumps(left, ensure_ascii=False, sort_keys=True)) if left else None)
        arrays = [b.column(0), b.column(1), b.column(2), *(pa.array(c, t.type) for c, t in zip(columns, list(schema)[3:-1])), pa.array(rest, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def consistent_table(records: DataFrame) -> DataFrame:
    """All records in one table: feed, file_no, rec_no, a column per field, rest.

    A field has one name over all files and feeds: within a feed that it had
    first, between feeds that which most of them use.  Every field that any
    record carries with a value has a column, of the type of most of its values
    (arrays as JSON text, into which a single value goes as an array of one).
    Of a record that carries several names of a field the value under the
    present name counts, else the first one.  rest is a JSON object of the
    values that found no place, by their delivered names: those that could not
    be cast without loss, and those under a second name; it is null if there
    are none, so every value delivered is in exactly one place.  Column names
    are unique whatever the case; feeds or file numbers that are null keep
    their rows.
    """
    stash = Stash(records.sparkSession)
    counted = stash.put(profiles(records, beside=True), "profiles")
    p = counted.where("what not like '&:%'")
    named = stash.put(aliases(changes_over_gaps(p), p.select("feed", "file_no").distinct()), "names")
    q = p.where("what <> 'records'").join(named, ["feed", "file_no"], "left").withColumn("field", F.coalesce(F.try_element_at("names", "path"), "path"))
    # from here on as many rows as there are names of fields, not records
    sums = q.groupBy("field", "what").agg(F.sum("c").alias("c"))
    counts: defaultdict[str, dict] = defaultdict(dict)
    for r in sums.toLocalIterator():
        counts[r["field"]][r["what"]] = r["c"]
    feeds = {r["field"]: r["count"] for r in q.where("what = 'n'").select("feed", "field").distinct().groupBy("field").count().collect()}
    met = counted.where("what like '&:%'").join(named, ["feed", "file_no"], "left").withColumn("other", F.substring("what", 3, 1 << 30))
    x, y = (F.coalesce(F.try_element_at("names", c), c) for c in ("path", "other"))
    met = met.groupBy(F.least(x, y).alias("x"), F.greatest(x, y).alias("y")).agg(F.sum("c").alias("c")).where("x <> y")
    together = {(r["x"], r["y"]) for r in met.toLocalIterator() if r["c"] > BESIDE * min(counts[r["x"]]["n"], counts[r["y"]]["n"])}
    valued = {f: c for f, c in counts.items() if any(w.startswith("t:") for w in c)}
    one = one_name({f: Field(f, c, c.get("n", 0)) for f, c in sorted(valued.items())}, feeds, together)
    summed: defaultdict[str, Counter] = defaultdict(Counter)
    for f, c in valued.items():
        summed[one[f]].update({w: n for w, n in c.items() if w.startswith("t:")})
    named_columns = column_names(list(summed))
    kinds = [(f, named_columns[f], Field(f, c, 1).kind) for f, c in sorted(summed.items())]
    types = {"number": ("double", pa.float64()), "boolean": ("boolean", pa.bool_()), "string": ("string", pa.string()), "array": ("string", pa.string())}
    schema = pa.schema([("feed", pa.string()), ("file_no", pa.int32()), ("rec_no", pa.int32()), *((c, types[k][1]) for _, c, k in kinds), ("rest", pa.string())])
    ddl = ", ".join(["feed string", "file_no int", "rec_no int", *(f"`{c}` {types[k][0]}" for _, c, k in kinds), "rest string"])
    picked = records.select("feed", F.col("file_no").cast("int").alias("file_no"), F.col("rec_no").cast("int").alias("rec_no"), "body")
    joined = picked.join(named, ["feed", "file_no"], "left").select("feed", "file_no", "rec_no", "body", "names", "past")
    return joined.mapInArrow(partial(_unify, one=one, kinds=kinds, schema=schema), ddl)


def values_kept(table: DataFrame) -> DataFrame:
    """(feed, file_no, n_records, n_values): how many values of a file the table holds, in columns or in rest."""
    filled = sum((F.col(f"`{c}`").isNotNull().cast("int") for c in table.columns if c not in KEYS), F.lit(0))
    rest = F.coalesce(F.json_object_keys("rest"), F.array().cast("array<string>"))
    return table.groupBy("feed", "file_no").agg(F.count("*").alias("n_records"), F.sum(filled + F.size(rest)).alias("n_values"))
