"""Per-document text quality statistics and form (problem 8).

A document is read as lines.  Of every line fixed statistics are taken; a
Gaussian mixture, fitted by expectation-maximization on the standardized
statistics of a bounded sample, gives each line its component, and components
are mapped to prose, list, table or junk by hand-labelled documents.  The form
of a document is the one that holds most of its characters.

Defined results: null and empty documents have statistics of zero, no form, and
are no cases; blank lines count for nothing; documents whose labels contradict
each other are not used for the mapping.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.session import hash_sample

FORMS = ("prose", "list", "table", "junk")
#: Labelled documents and lines that the mixture is fitted on, at most, as many others again, and characters of one document.
SAMPLE_DOCUMENTS, SAMPLE_LINES, SAMPLE_CHARS = 2_000, 20_000, 100_000
#: A longer table of common words is refused, as every worker holds it.
MOST_WORDS = 1_000_000
STEPS, RIDGE, SEED = 25, 0.05, 7
#: Components started among lines of no form, and of prose, list, table and junk.
START = (14, 12, 8, 8, 14)

# Vowels of the scripts, separators of cells, ends of sentences.
VOWELS = "aeiouyàáâäèéêëìíîïòóôöùúûüæœøåαάεέηήιίοόυύωώϊϋаеиоуъюяыэ"
SEPARATORS = ("|", "\t", ";", ",", "   ")
_LINE = re.compile(r"\r\n|\r|\n")
_END = re.compile(r"[.!?…]['\"”’»)\]]*\s*$")
_BULLET = re.compile(r"\s*([-*•–·▪◦‣+]|\(?[0-9]{1,3}[.)]|\(?[a-zA-Z][.)])\s")
_SENTENCE = re.compile(r"[.!?]\s+[A-ZÀ-ÞΑ-ΩА-Я]")
_LETTER, _DIGIT, _SPACE, _UPPER, _VOWEL, _COMMON, _CODE, _BROKEN, _CONS, _CAPITAL, _SMALL = (1 << k for k in range(11))
#: Classes counted per line; after them come the separators of one character.
_COUNTED = (_LETTER, _DIGIT, _SPACE, _UPPER, _VOWEL, _COMMON, _CODE, _BROKEN)


@lru_cache(maxsize=1)
def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bits, kind) per code point of the Basic Multilingual Plane, symbols above it; and what counts in each kind."""
    table = np.zeros(0x10001, np.uint16)
    for cp in range(0x10000):
        ch = chr(cp)
        if ch.isalpha():
            low = ch.lower()
            table[cp] = _LETTER | (_UPPER if ch.isupper() else 0) | (_VOWEL if low in VOWELS else _CONS)
        elif ch.isdigit():
            table[cp] = _DIGIT
        elif ch.isspace():
            table[cp] = _SPACE
        elif ch in ".,;:!?'\"()-’“”«»%…–—":
            table[cp] = _COMMON
        elif ch in "{}[]<>=$&^~#@\\/*+_`|":
            table[cp] = _CODE
        elif 0x80 <= cp <= 0x9F or unicodedata.category(ch) in ("Cc", "Co", "Cn", "Cs"):
            table[cp] = _BROKEN
        table[cp] |= _case(ch)
    for ch in "ÃÂâÎÐÑ¢€¬Å¶¼±":
        table[ord(ch)] |= _BROKEN
    apart = table.astype(np.int64)
    for k, ch in enumerate(_SINGLE):
        apart[ord(ch)] |= 1 << 16 + k
    kinds, kind = np.unique(apart, return_inverse=True)
    return table, kind.astype(np.uint8), np.stack([kinds & b > 0 for b in (*_COUNTED, *(1 << 16 + k for k in range(len(_SINGLE))))], 1).astype(np.int64)


def _case(ch: str) -> int:
    return (_CAPITAL if ch.isupper() else 0) | (_SMALL if ch.islower() else 0)


_SINGLE = [c for c in SEPARATORS if len(c) == 1]
N_FEATURES = 26
#: Lines that a task gives to the mixture at once; characters of short texts that are measured, and of a long one that are counted, at once.
FLUSH, BLOCK = 4_096, 1 << 18
#: Stress of the statistics while the start is sought: repeated and common words part salads of words from sentences.
LEANING = np.where(np.isin(np.arange(N_FEATURES), (15, 16)), 2.0, 1.0)


def _counts(code: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Characters of each counted class per line."""
    _, kind, counted = _classes()
    k, out = len(counted), np.zeros((len(starts), counted.shape[1]), np.int64)
    for lo in range(0, len(code), BLOCK):
        piece = kind[np.minimum(code[lo : lo + BLOCK], 0x10000)]
        a, b = np.searchsorted(starts, lo, "right") - 1, np.searchsorted(starts, lo + len(piece))
        row = np.repeat(np.arange(b - a) * k, np.diff(np.append(np.maximum(starts[a:b], lo), lo + len(piece))))
        out[a:b] += np.bincount(row + piece, minlength=(b - a) * k).reshape(-1, k) @ counted
    return out


def _words(code: np.ndarray, starts: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per line: ends of runs of four consonants, words, longest word, capital and small letter at the start, later words with a capital, words with a digit."""
    n, bits = len(starts), _classes()[0][np.minimum(code, 0x10000)]
    cons = (bits & _CONS) > 0
    run = np.zeros(len(cons), bool)
    run[3:] = cons[3:] & cons[2:-1] & cons[1:-2] & cons[:-3]
    for k in range(3):  # no run goes on from one text into the next
        run[np.minimum(texts + k, len(run) - 1)] = False
    pile = np.add.reduceat(run, starts, dtype=np.int64)
    # words: from each character after a space or a line's start to the next such place
    blank = (bits & _SPACE) > 0
    edge = np.empty(len(blank), bool)
    edge[1:], edge[starts] = blank[:-1], True
    head = np.flatnonzero(edge & ~blank)
    edge[:-1], edge[starts[1:] - 1], edge[-1] = blank[1:], True, True
    length = np.flatnonzero(edge & ~blank) - head + 1
    if (dotted := np.flatnonzero(code == 0x130)).size:  # in small letters it is two characters
        length += np.bincount(np.searchsorted(head, dotted, "right") - 1, minlength=len(head))
    initial = bits[head]
    for k in np.flatnonzero(code[head] > 0xFFFF):
        ch = chr(code[head[k]])
        initial[k] = _case(ch) | (_DIGIT if ch.isdigit() else 0)
    at = np.searchsorted(starts, head, "right") - 1
    words = np.bincount(at, minlength=n)
    first = np.cumsum(words) - words
    capital = ((initial[first] & _CAPITAL) > 0).astype(float)
    named = np.bincount(at, (initial & _CAPITAL) > 0, n) - capital
    return pile, words, np.maximum.reduceat(length, first).astype(float), capital, (initial[first] & _SMALL) > 0, named, np.bincount(at, (initial & _DIGIT) > 0, n)


def line_statistics(texts: list[str], common: frozenset[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(statistics, characters, counts of words, common words and characters in words, text) of the lines of some texts that are not blank, all at once."""
    of = [[ln for ln in _LINE.split(t) if ln and not ln.isspace()] for t in texts]
    lines, held = list(chain.from_iterable(of)), np.array([len(x) for x in of], np.int64)
    n, owner = len(lines), np.repeat(np.arange(len(texts)), held)
    out = np.zeros((n, N_FEATURES))
    if not n:
        return out, np.zeros(0), np.zeros((0, 3)), owner
    size = np.array([len(ln) for ln in lines])
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    code = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter, digit, space, upper, vowel, usual, odd, broken, *single = _counts(code, starts).T
    first_line = (np.cumsum(held) - held)[held > 0]
    pile, words, longest, capital, small, named, counted = _words(code, starts, starts[first_line])
    del code  # of a long text it is large
    joined = "\n".join(lines)
    single = iter(single)
    many = np.stack([next(single) if len(s) == 1 else _occurrences(s, lines, joined) for s in SEPARATORS], 1)
    best = many.argmax(1)
    cells = many[np.arange(n), best]
    linked = _occurrences("://", lines, joined)
    low, to = joined.lower().split(), np.cumsum(words)
    del joined
    first = to - words
    distinct = np.fromiter((len(set(low[a:b])) for a, b in zip(first.tolist(), to.tolist())), float, n)
    common_ = np.add.reduceat(np.fromiter(map(common.__contains__, low), bool, len(low)), first, dtype=np.int64).astype(float)
    del low
    words_ = words.astype(float)
    ends = np.array([_END.search(ln[-8:]) is not None for ln in lines], float)
    bullet = np.array([_BULLET.match(ln) is not None for ln in lines], float)
    inner = np.array([len(_SENTENCE.findall(ln)) for ln in lines], float)
    safe = np.maximum(words_, 1)
    like = np.zeros(n)  # the same cells as a neighbour
    same = np.zeros(n)  # the same line as a neighbour
    grown = np.zeros(n)  # about as long as a neighbour, in words
    flows = np.zeros(n)  # carried on by the next line, or carrying on the one before
    beside = owner[1:] == owner[:-1]
    alike = beside & (best[1:] == best[:-1]) & (cells[1:] == cells[:-1]) & (cells[1:] > 0)
    like[1:] += alike
    like[:-1] += alike
    equal = beside & np.fromiter(map(eq, lines, lines[1:]), bool, n - 1)
    same[1:] += equal
    same[:-1] += equal
    close = beside & (np.abs(words_[1:] - words_[:-1]) <= 2)
    grown[1:] += close
    grown[:-1] += close
    on = beside & (ends[:-1] == 0) & (words_[:-1] >= 5) & small[1:]
    flows[:-1][on] = 1
    flows[1:][on] = 1
    cols = (
        np.log1p(size), np.log1p(words_), letter / size, digit / size, space / size, upper / np.maximum(letter, 1), vowel / np.maximum(letter, 1),
        (size - letter - digit - space - usual) / size, np.minimum(odd / size, 0.5), np.minimum(broken / size, 0.5), np.minimum(3 * pile / np.maximum(letter, 1), 1.0),
        np.minimum(cells / safe, 2.0), np.minimum(like, 2), np.minimum(same, 2), np.minimum(grown, 2) * (words_ < 14), np.where(words_ >= 6, distinct / safe, 1.0), np.where(words_ >= 4, common_ / safe, 0.12),
        np.maximum(ends, flows), bullet, np.minimum(inner, 3), capital, np.minimum(np.log1p(longest), 6),
        named / safe, counted / safe, np.minimum(linked, 1), ends * capital * (words_ >= 4),
    )
    for j, c in enumerate(cols):
        out[:, j] = c
    return out, size.astype(float), np.stack([words_, common_, size - space], 1), owner


def _occurrences(s: str, lines: list[str], joined: str) -> np.ndarray:
    return np.array([ln.count(s) for ln in lines]) if s in joined else np.zeros(len(lines), np.int64)


class Mixture:
    """Gaussians with full covariances over standardized statistics."""

    def __init__(self, x: np.ndarray, form: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.std = x.mean(0), x.std(0) + 1e-3
        z = self._standard(x)
        # the start: centres among the lines of each form's documents, and of no form's
        z = z * LEANING
        starts = [self._spread(z[form == f], n, rng) for f, n in zip(range(-1, len(FORMS)), START) if (form == f).sum() > n]
        centres = np.vstack(starts) if starts else self._spread(z, min(len(z), 8), rng)
        k = len(centres)
        for _ in range(8):
            near = (((z**2).sum(1)[:, None] - 2 * z @ centres.T) + (centres**2).sum(1)).argmin(1)
            centres = np.array([z[near == j].mean(0) if (near == j).any() else centres[j] for j in range(k)])
        z = z / LEANING
        moments, last = self._moments(z, lambda lo, hi, powers: np.eye(k)[:, near[lo:hi]]), -np.inf
        for _ in range(STEPS):
            self._maximize(moments, z.shape[1])
            likely: list[float] = []

            def expected(lo: int, hi: int, powers: np.ndarray) -> np.ndarray:
                r, norm = self._shares(powers)
                likely.append(norm.sum())
                return r

            moments = self._moments(z, expected)
            now = sum(likely) / len(z)
            if now - last < 1e-3:
                break
            last = now

    @staticmethod
    def _spread(z: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
        """k centres, each drawn the likelier the farther it is from those before."""
        centres = z[rng.integers(len(z))][None]
        far = ((z - centres[0]) ** 2).sum(1)
        for _ in range(k - 1):
            c = z[rng.choice(len(z), p=far / far.sum())] if far.sum() > 0 else z[rng.integers(len(z))]
            centres = np.vstack([centres, c])
            far = np.minimum(far, ((z - c) ** 2).sum(1))
        return centres

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.std, -6, 6)

    @staticmethod
    def _powers(z: np.ndarray) -> np.ndarray:
        """1, the statistics and their products two by two, a column for each line: every log density is linear in them."""
        n, d = z.shape
        out, at = np.empty((1 + d + d * (d + 1) // 2, n)), 1 + d
        out[0], out[1:at] = 1, z.T
        for i in range(d):
            np.multiply(out[1 + i], out[1 + i : 1 + d], out=out[at : at + d - i])
            at += d - i
        return out

    def _moments(self, z: np.ndarray, share) -> np.ndarray:
        """Sums of the powers by share of each component."""
        total = 0
        for lo in range(0, len(z), FLUSH):
            powers = self._powers(z[lo : lo + FLUSH])
            total = total + share(lo, lo + FLUSH, powers) @ powers.T
        return total

    def _maximize(self, moments: np.ndarray, d: int) -> None:
        n = moments[:, 0] + 1e-6
        weight, centre = n / n.sum(), moments[:, 1 : 1 + d] / n[:, None]
        i, j = np.triu_indices(d)
        self.linear = np.empty_like(moments)
        for k, c in enumerate(centre):
            cov = np.empty((d, d))
            cov[i, j] = cov[j, i] = moments[k, 1 + d :]
            shift = np.outer(c, moments[k, 1 : 1 + d])
            cov = (cov - shift - shift.T + moments[k, 0] * np.outer(c, c)) / n[k] + RIDGE * np.eye(d)
            low = np.linalg.cholesky(cov)
            root = np.linalg.inv(low)
            precise = root.T @ root
            self.linear[k, 0] = np.log(weight[k]) - np.log(np.diag(low)).sum() - 0.5 * c @ precise @ c
            self.linear[k, 1 : 1 + d] = precise @ c
            self.linear[k, 1 + d :] = np.where(i == j, -0.5, -1.0) * precise[i, j]

    def _shares(self, powers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(share of each component, log density) of each line."""
        p = self.linear @ powers
        top = p.max(0)
        np.exp(np.subtract(p, top, out=p), out=p)
        total = p.sum(0)
        return np.divide(p, total, out=p), top + np.log(total)

    def responsibilities(self, x: np.ndarray) -> np.ndarray:
        z = self._standard(x)
        return np.concatenate([self._shares(self._powers(z[lo : lo + FLUSH]))[0].T for lo in range(0, max(len(z), 1), FLUSH)])


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> list:
    """(text, form or None): labelled documents and others, each up to their half of the sample, chosen by a hash of the id."""
    clear = labels.where(F.col("form").isin(*FORMS)).groupBy(F.col(id_col).alias("i")).agg(F.min("form").alias("form"), F.countDistinct("form").alias("k")).where("k = 1").select("i", "form")
    known = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where(F.length("t") <= SAMPLE_CHARS)
    named = hash_sample(clear, "i", SAMPLE_DOCUMENTS)
    rows = known.join(named, "i").orderBy("i").select("t", "form").collect()
    others = hash_sample(known.select("i").join(clear, "i", "left_anti"), "i", SAMPLE_DOCUMENTS)
    rows += known.join(others, "i", "left_semi").orderBy("i").select("t", F.lit(None).cast("string").alias("form")).collect()
    return rows


def fit(rows: list, common: frozenset[str]) -> tuple[Mixture, np.ndarray] | None:
    """The mixture and, per component, its weight in each form."""
    stats, weight, form = [], [], []
    for part in _blocks([r["t"] for r in rows]):
        x, size, _, owner = line_statistics([rows[k]["t"] for k in part], common)
        stats.append(x)
        weight.append(size / np.maximum(np.bincount(owner, size, len(part)), 1)[owner])  # a document has one vote in all, as its label may be wrong
        form.append(np.array([FORMS.index(f) if (f := rows[k]["form"]) else -1 for k in part])[owner])
    x, size, form = (np.concatenate(v) for v in (stats, weight, form))
    if not len(x):
        return None
    rng = np.random.default_rng(SEED)
    drawn = rng.permutation(len(x))
    few = np.concatenate([drawn[(form[drawn] < 0) == other][:SAMPLE_LINES] for other in (False, True)])  # labelled lines and others
    model = Mixture(x[few], form[few])
    r = model.responsibilities(x[few])
    votes = np.zeros((r.shape[1], len(FORMS)))
    for f in range(len(FORMS)):
        own = form[few] == f
        votes[:, f] = (r[own] * size[few][own][:, None]).sum(0)
        votes[:, f] /= max(votes[:, f].sum(), 1e-9) ** 0.5  # rare forms gain, yet a few wrong labels of theirs do not outvote many right ones
    return model, np.eye(len(FORMS))[votes.argmax(1)]


def _blocks(texts: list[str]) -> Iterator[list[int]]:
    """Places of texts that are measured at once: some short ones, or a long one."""
    part, held = [], 0
    for k, t in enumerate(texts):
        if part and held + len(t) > BLOCK:
            yield part
            part, held = [], 0
        part.append(k)
        held += len(t)
    if part:
        yield part


def _measure(batches: Iterator[pa.RecordBatch], common: frozenset[str], model) -> Iterator[pa.RecordBatch]:
    mixture, mapping = model.value if model.value else (None, None)
    names = ["id", "n_lines", "n_words", "mean_word_length", "symbol_ratio", "lines_ending_in_punctuation", "common_word_share", *(f"{f}_chars" for f in FORMS)]
    for b in batches:
        texts = [t or "" for t in b.column(1).to_pylist()]
        # lines, characters, words, common words, characters of words, symbols, lines that end; then the characters of each form
        sums, first = np.zeros((7 + len(FORMS), len(texts))), 7
        for part in _blocks(texts):
            x, size, of_words, owner = line_statistics([texts[k] for k in part], common)
            total = lambda v, own=owner, n=len(part): np.bincount(own, v, n)
            sums[:first, part] = [total(v) for v in (np.ones(len(x)), size, *of_words.T, x[:, 7] * size, x[:, 17])]
            for lo in range(0, len(x) if mixture else 0, FLUSH):
                at = slice(lo, lo + FLUSH)
                p = mixture.responsibilities(x[at]) @ mapping * size[at, None]
                sums[first:, part] += [np.bincount(owner[at], v, len(part)) for v in p.T]
        lines, chars, words, usual, in_words, symbols, ended = sums[:first]
        per = lambda v, n: v / np.maximum(n, 1)
        columns = (per(in_words, words), per(symbols, chars), per(ended, lines), per(usual, words), *sums[first:])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lines.astype(np.int64)), pa.array(words.astype(np.int64)), *map(pa.array, columns)], names=names)


def quality_statistics(docs: DataFrame, labels: DataFrame, common_words: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: statistics, characters per form, and the form."""
    spark = docs.sparkSession
    common = frozenset(r[0].lower() for r in common_words.select("word").where("word is not null").distinct().limit(MOST_WORDS + 1).collect())
    if len(common) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} common words")
    rows = sample(docs, labels, id_col, text_col)
    model = spark.sparkContext.broadcast(fit(rows, common) if rows else None)
    schema = "id bigint, n_lines bigint, n_words bigint, mean_word_length double, symbol_ratio double, lines_ending_in_punctuation double, common_word_share double, " + ", ".join(f"{f}_chars double" for f in FORMS)
    measured = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(partial(_measure, common=common, model=model), schema)
    total = sum((F.col(f"{f}_chars") for f in FORMS), F.lit(0.0))
    best = F.greatest(*(f"{f}_chars" for f in FORMS[1:]))
    form = F.when(total <= 0, None).when(F.col("prose_chars") * 2 >= total, "prose")
    for f in FORMS[1:]:
        form = form.when(F.col(f"{f}_chars") == best, f)
    return measured.withColumn("form", form).withColumnRenamed("id", id_col)
