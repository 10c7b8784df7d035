"""Template residue and error-page text (problem 1).

Texts are read sentence by sentence.  A regularized linear classifier over
hashed n-grams, length and title features scores each sentence; a record is a
case if its highest score passes the threshold.  The classifier is trained on
weak labels, from phrases and response status, of a bounded sample, and
validated on hosts that it has not seen.

Defined results: null texts are no cases and keep a null score; an empty text
has no sentence and is no case.  Only id, text and the sample's status and URL
are read, so clashing extra columns do no harm.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.llm.consistent import consistent
from provlake.session import hash_sample

#: Records that the classifier is fitted on, at most: of all, of those with a template's signs, of short ones; units of them, and characters of one.
TRAIN_RECORDS, TRAIN_SIGNED, TRAIN_SHORT, TRAIN_UNITS, TRAIN_CHARS = 3_000, 4_000, 3_000, 100_000, 20_000
# Fixed value: signs of templates, by which records are drawn.
SIGNS = r"[{}]|\[[\p{L}\[]|<[<%\p{L}]|__|@@|%%|%\(|&lt;|undefined|NaN|XX"
DIMENSIONS = 1 << 18
#: Words on either side of a sign in a long sentence that are scored with it.
AROUND = 4
THRESHOLD = 0.4
#: Characters of a short text, and what the status of its response weighs against a phrase.
SHORT, STATUS_WEIGHT = 200, 0.1
#: Tokens and sentences that a task holds at once, and different tokens.
FLUSH, VOCABULARY = 1 << 18, 1 << 18
L2, STEPS = 2e-6, 200



def _phrases(pattern: str) -> re.Pattern:
    """A pattern over consistent text, so written in it."""
    return re.compile(consistent(pattern), re.I)


# Phrases of the weak labels, of any such page or template.
PLACEHOLDER = _phrases(
    r"\{\{.*?\}\}|\{%.*?%\}|<<\w+>>|\$\{[^}]*\}|<%.*?(%>|$)|<%=|\[\[.*?\]\]|%%[A-Za-z_.]+%%|%\(\w+\)[sd]|(?<!\w)\{(\d|[a-z]+[A-Z_.]?\w*)\}|\[(insert|todo|enter|tbd|fill in|your)\b[^\]]*\]|\[[^\]]*\bto be (completed|filled|added|confirmed)\]"
    r"|<(insert|enter|your|todo)\b[^>]*>|_{4,}|__[A-Za-z]\w*__|@@\w+@@|&lt;\w[\w. ]*&gt;|\[[^\]]*(à compléter|zu ergänzen|da completare|por completar|rellenar|ausfüllen|einfügen|eintragen|συμπληρώ|попълн)[^\]]*\]|\bXX/XX/|\b20XX\b|\bundefined\b|\[object Object\]|\bNaN\b|:\s*(null|None)\s*$|^(null|None)\b",
)
FILLER = _phrases(
    r"\blorem\b.*\b(ipsum|dolor)|\bipsum\b.*\blorem\b|(text|content|copy) goes here|your (own )?(text|words|content) here|\b(add|enter|insert|type|write) (your )?(body )?(copy|text|content)\b|\b(placeholder|dummy|sample|demo|filler) (text|copy|page|paragraph|content)\b"
    r"|texte provisoire|beispieltext|platzhaltertext|testo segnaposto|texto de relleno|\b(asdf|qwerty)\b|\bclick to edit|\bedit me\b|start (writing|typing)|^(sub)?heading( \d+)?$|^new page\b",
)
# The vocabulary of the printers' filler text.
LOREM = frozenset("lorem ipsum dolor amet consectetur adipiscing elit eiusmod tempor incididunt aliqua quisque mauris nulla velit vestibulum faucibus pulvinar nibh porta eros sagittis augue ornare tellus libero tempus lacus".split())
ERROR = _phrases(
    r"\b(page|document|file|resource|link|address|url|site)\b[^.]{0,25}\b(not (be )?found|cannot be found|is (gone|dead|missing)|does not exist|no longer (exists|available)|(been|was) (removed|withdrawn|deleted|moved))|not found|no such file or directory|access (is )?denied|\bforbidden\b|bad gateway|gateway time-?out"
    r"|too many requests|slow down|rate limit|service unavailable|temporarily unavailable|down for maintenance|does not exist|^(\W*(error|http)?\W*\d* ?\W*)gone\W*$|(may|can|could|are) not (allowed to )?(view|access|load)\b|request (was )?blocked|not available in your|\bupstream\b|went wrong|server (error|fault)|unhandled exception"
    r"|\w+exception\b|(connect\w*|connection) to (the )?database|traceback \(most|^(error|http) \d{3}\b(?=\s*([^\w\s]|$))|^oops\b|\b(lost|can't find|cannot find|could not find|couldn't find|unable to find) (the|this|that|your) (page|document|file|address)|^ray [0-9a-f]+$"
    r"|accès refusé|page introuvable|une erreur est|zugriff verweigert|seite nicht gefunden|ein fehler aufgetreten|se ha producido un error|página no encontrada|acceso denegado|pagina non trovata|accesso negato|si è verificato un errore"
    r"|страницата не е намерена|достъпът е отказан|възникна грешка|σελίδα δεν βρέθηκε|δεν επιτρέπεται|παρουσιάστηκε σφάλμα",
)
SCRIPTS = _phrases(
    r"(enable|turn on|switch on|allow|activate|need|requires?|without|does not run|blocks?|must)\b.{0,30}\b(javascript|js|script\w*|cookies)\b|\bscript\w* (is|are) (off|disabled)|noscript|cookies and scripts|(verifying|checking) (that|your)\b|not a robot|are human|security check|one moment\.\.\."
    r"|javascript (activ|aktiv|attiv)|(aktivier|activ|attiv|включете|ενεργοποι)\w*.{0,20}javascript|benötigt skripte|exige les scripts|servono gli script|изисква скрипт|χρειάζεται",
)
# How texts talk about such things without being them: in quotation marks, as examples and fields of a form;
# and of messages and filler, what was done with them.
MENTION = _phrases(r"[\"“”«»`].{0,60}[\"“”«»`]|\bthe (phrase|field|message|words?|string|placeholder|marker|form|template)\b|\bform (shows|has)\b|\bfor (example|instance)\b|\bsuch as\b|\be\.g\.|\bdocumented\b|\b(sample|example) field|\bexport \w+=")
REPORT = _phrases(r"\b(is|are|was|were|been|be) (\w+ )?(dropped|removed from|excluded|filtered|recorded|counted|rendered|configured|skipped|retried|discarded|kept|logged|treated|replaced|affected)\b|\b(crawl|scrap)\w*")

_SPLIT = re.compile(r"\n+|(?<=[.!?…])\s+")
_TOKEN = re.compile(r"[^\W_]+|%\(|[{}\[\]<>%$#_@&]+|[|:\"“”«»=/]")
_LETTERS = re.compile(r"[a-z]+")


def sentences(text: str | None) -> list[str]:
    """Sentences and lines of the consistent text, without empty ones."""
    return [s for s in _SPLIT.split(consistent(text)) if s and not s.isspace()] if text else []


def _stands_alone(t: str) -> bool:
    """A sign at which something is scored by itself."""
    return not t[0].isalnum() and t not in _PLAIN or t.lower() in _SIGNS


def units(s: str) -> list[str]:
    """What is scored of a sentence: the whole, and of a long one with signs also the words around each of them."""
    at = list(_TOKEN.finditer(s))
    if len(at) <= 2 * AROUND + 2:
        return [s]
    signs = [i for i, m in enumerate(at) if _stands_alone(m.group())]
    spans: list[list[int]] = []
    for i in signs:
        lo, hi = max(0, i - AROUND), min(len(at), i + AROUND + 1)
        if spans and lo <= spans[-1][1] - AROUND:
            spans[-1][1] = hi
        else:
            spans.append([lo, hi])
    return [s, *(s[at[lo].start() : at[hi - 1].end()] for lo, hi in spans)]


def token_form(t: str, first: bool) -> str:
    """What a token counts as: numbers by their length, names as one, unless a unit begins with it."""
    if t[0].isdigit():
        return "0a" if not t.isdigit() else "0" if len(t) < 3 else t if t in _CODES else "00"
    return "Name" if not first and t[0].isupper() and not t.isupper() and t.lower() not in _KEPT else t.lower()


def _is_sign(form: str) -> bool:
    return not form[0].isalnum() or form in _SIGNS


def _extent(chars: int) -> str:
    return "tiny" if chars < 120 else "short" if chars < 300 else "long"


def _frame(k: int, whole: str, tokens: int) -> list[str]:
    """Features of where a unit stands and how long it is."""
    size, title = f"len{min(tokens, 12)}", "title" if k == 0 else "body"
    return [size, whole, title, f"{whole} {size}", f"{title} {whole}"]


def features(s: str, k: int, chars: int) -> list[int]:
    """Hashed n-grams, length and title features of (a unit of) sentence k."""
    tokens = [token_form(t, not i) for i, t in enumerate(_TOKEN.findall(s))]
    whole = _extent(chars)
    found = _frame(k, whole, len(tokens))
    found += tokens
    found += [f"{whole}\t{t}" for t in tokens]
    grams = list(map(" ".join, zip(tokens, tokens[1:])))
    found += grams
    signs = [_is_sign(t) for t in tokens]
    if whole != "long":
        found += map(" ".join, zip(tokens, tokens[1:], tokens[2:]))
    if any(signs):
        # what stands at a sign weighs more, lest a long sentence drown it
        near = [t for t, z in zip(tokens, signs) if z] + [g for g, z, y in zip(grams, signs, signs[1:]) if z or y]
        near += [" ".join(g) for g, z in zip(zip(tokens, tokens[1:], tokens[2:]), zip(signs, signs[1:], signs[2:])) if any(z)]
        found += [f"{k}\t{g}" for g in near for k in "abc"]
    crc = zlib.crc32
    return [crc(f.encode()) & DIMENSIONS - 1 for f in found]


_CODES = frozenset({"400", "401", "403", "404", "410", "429", "500", "502", "503", "504"})
#: Tokens at which nothing is scored by itself.
_PLAIN = frozenset({"|", ":", '"', "“", "”", "«", "»", "=", "/", "%", "$", "#", "&"})
#: Words that stand where a value failed to.
_SIGNS = frozenset({"undefined", "null", "nan", "xx", "object", "insert", "todo"})
_KEPT = frozenset({"javascript", "lorem", "insert", "error", "page", "access", "http", "todo", "js", "object"})


def residue_phrase(s: str) -> bool:
    """A phrase of residue, or three different words of the filler text."""
    return any(p.search(s) for p in (PLACEHOLDER, FILLER, SCRIPTS, ERROR)) or len(LOREM.intersection(_LETTERS.findall(s.lower()))) >= 3


def is_mention(s: str) -> bool:
    """Words that talk about residue; a placeholder is none for being reported on."""
    return bool(MENTION.search(s) or REPORT.search(s) and not PLACEHOLDER.search(s))


def weak_label(s: str, chars: int, status: int | None) -> int | None:
    """1 residue, 0 none, by phrases; None where only the response status speaks: a short text of a response that failed."""
    if residue_phrase(s):
        return 0 if is_mention(s) else 1
    if chars < SHORT and status is not None and status >= 400:
        return None
    return 0


def fit(x: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """L2-regularized logistic regression by Adam over the whole sample; only features that occur are worked on."""
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in x])])
    held, idx = np.unique(np.concatenate(x), return_inverse=True)
    rows, w = np.repeat(np.arange(len(x)), np.diff(offsets)), np.zeros(len(held) + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    total = weight.sum()
    for t in range(1, STEPS + 1):
        z = np.add.reduceat(w[idx], offsets[:-1]) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        err = (p - y) * weight / total
        g = np.append(np.bincount(idx, err[rows], minlength=len(held)), err.sum()) + L2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    out = np.zeros(DIMENSIONS + 1)
    out[held], out[-1] = w[:-1], w[-1]
    return out.astype(np.float32)


def training_sample(df: DataFrame, manifest: DataFrame, id_col: str, text_col: str, key: str) -> list:
    """Records with status and host: of all, of those with a template's signs and of short ones so many at most, chosen by a hash of the id."""
    known = df.where(F.length(text_col) <= TRAIN_CHARS).select(F.col(id_col).alias("i"), F.col(key).alias("k"), F.col(text_col).rlike(SIGNS).alias("signed"), (F.length(text_col) < 300).alias("short"))
    strata = [hash_sample(known.where(which), "i", most) for which, most in (("true", TRAIN_RECORDS), ("signed", TRAIN_SIGNED), ("short", TRAIN_SHORT))]
    chosen = reduce(DataFrame.unionByName, strata).select("i", "k").distinct()
    texts = df.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(chosen.select("i"), "i", "left_semi")
    sent = manifest.select(F.col(key).alias("k"), F.col("http.status_code").alias("status"), F.lower(F.try_parse_url("http.url", F.lit("HOST"))).alias("host"))
    answered = chosen.join(sent, "k").groupBy("i").agg(F.max("status").alias("status"), F.min("host").alias("host"))
    return texts.join(answered, "i", "left").select("i", "t", "status", "host").orderBy("i").collect()


def labelled(rows: list) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, list[str]]:
    """Features, labels and weights of the sample's units, each kind of unit of a host once with its weight, and their hosts.

    A unit that only the status speaks of counts as residue and as none, each by
    the share that residue by phrases has among short texts of failed responses.
    """
    weights: defaultdict[tuple[str, bytes], np.ndarray] = defaultdict(lambda: np.zeros(2))
    open_units: Counter = Counter()
    failed = np.zeros(2)
    for r in sorted(rows, key=lambda r: zlib.crc32(str(r["i"]).encode())):
        if len(weights) + len(open_units) >= TRAIN_UNITS:
            break
        parts = sentences(r["t"])
        chars, host = sum(map(len, parts)), r["host"] or ""
        labels = [weak_label(s, chars, r["status"]) for s in parts]
        if chars < SHORT and (r["status"] or 0) >= 400:
            failed[int(1 in labels)] += 1
        for k, (s, label) in enumerate(zip(parts, labels)):
            def key(u: str, k: int = k) -> tuple[str, bytes]:
                return host, np.array(features(u, k, chars), np.int64).tobytes()

            if label != 1 and 1 in labels and chars < SHORT:
                continue  # what stands beside residue in a short text may belong to it
            if label is None:
                open_units[key(s)] += 1
                continue
            # ordinary sentences are many: one in three of them stays
            if label == 0 and chars > 300 and zlib.crc32(s.encode("utf-8", "replace")) % 3 and not is_mention(s):
                continue
            whole, *near = units(s)
            named = [u for u in near if residue_phrase(u)] if label else near
            # a whole is a case by itself if no words around a sign are
            for u in named if label and named else [whole, *named]:
                weights[key(u)][label] += 1
                hit = PLACEHOLDER.search(u) if label else None
                if hit and len(u) - len(hit.group()) > 20 and not residue_phrase(rest := u[: hit.start()] + u[hit.end() :]):
                    weights[key(rest)][0] += 1  # the words without the placeholder are ordinary ones
    one, none = (sum(w[label] for w in weights.values()) for label in (1, 0))
    even = max(1.0, 0.5 * none / one) if one else 1.0
    for w in weights.values():
        w[1] *= even
    share = (failed[1] + 1) / (failed.sum() + 2)
    for u, n in open_units.items():
        weights[u] += STATUS_WEIGHT * n * np.array([1 - share, share])
    several = [(u, label, w[label]) for u, w in weights.items() for label in (0, 1) if w[label]]
    x = [np.frombuffer(u[1], np.int64) for u, _, _ in several]
    y, weight = np.array([label for _, label, _ in several], float), np.array([w for _, _, w in several], float)
    return x, y, weight, [u[0] for u, _, _ in several]


@lru_cache(maxsize=1)
def _zeros() -> np.ndarray:
    """Tables of what 2^b zero bytes after a text do to its CRC-32, by the four bytes of the latter."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, byte >> 1 ^ 0xEDB88320, byte >> 1).astype(np.uint32)
    at = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    tables = [at >> 8 ^ byte[at & 255]]
    for _ in range(31):
        tables.append(_through(tables[-1], tables[-1]))
    return np.array(tables)


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


def joined_crc(before: np.ndarray, after: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two texts put together, from that of each and the bytes of the second."""
    out, tables = np.array(before, np.uint32), _zeros()
    for b in range(int(length.max(initial=0)).bit_length()):
        at = np.flatnonzero(length >> b & 1)
        out[at] = _through(tables[b], out[at])
    return out ^ after


class Vocabulary(dict):
    """A number for each token met, and of its forms inside a unit and at its start what features need."""

    #: CRC-32 of the form, and of a space and the form, its bytes, whether it is a sign, and CRC-32 after each extent.
    COLUMNS = 7
    EXTENTS = ("tiny", "short", "long")

    def __init__(self):
        self.forms, self.signs = array("I"), array("B")

    def __missing__(self, t: str) -> int:
        self[t] = n = len(self)
        for first in (False, True):
            form = token_form(t, first)
            raw = form.encode()
            self.forms.extend((zlib.crc32(raw), zlib.crc32(b" " + raw), len(raw), _is_sign(form), *(zlib.crc32(f"{x}\t{form}".encode()) for x in self.EXTENTS)))
        self.signs.append(_stands_alone(t))
        return n


class Scorer:
    """Scores of the units of many sentences at once: the sums of the weights of their features."""

    def __init__(self, w: np.ndarray):
        self.w, self.words = w, Vocabulary()
        crc = [[[[zlib.crc32(f.encode()) for f in _frame(k, x, n)] for n in range(13)] for x in Vocabulary.EXTENTS] for k in (0, 1)]
        self.frame = self._weight(np.array(crc, np.uint32)).sum(-1, dtype=float) + float(w[-1])

    def _weight(self, crc: np.ndarray) -> np.ndarray:
        return self.w[crc & np.uint32(DIMENSIONS - 1)]

    def _units(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first token, token behind the last, sentence) of each unit, as `units` has them."""
        ends = np.cumsum(sizes)
        sentence = np.repeat(np.arange(len(sizes)), sizes)
        signs = np.array(self.words.signs, bool)
        at = np.flatnonzero(signs[ids] & (sizes > 2 * AROUND + 2)[sentence])
        spans: list[list[int]] = []
        for i, s, start, end in zip(at.tolist(), sentence[at].tolist(), (ends - sizes)[sentence[at]].tolist(), ends[sentence[at]].tolist()):
            lo, hi = max(start, i - AROUND), min(end, i + AROUND + 1)
            if spans and spans[-1][2] == s and lo <= spans[-1][1] - AROUND:
                spans[-1][1] = hi
            else:
                spans.append([lo, hi, s])
        near = np.array(spans, np.int64).reshape(-1, 3).T
        return tuple(np.concatenate(v) for v in zip((ends - sizes, ends, np.arange(len(sizes))), near))

    def scores(self, ids: list[int], sizes: list[int], title: list[bool], extent: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(score, sentence) of the units of some sentences."""
        ids, sizes = np.array(ids, np.int64), np.array(sizes, np.int64)
        lo, hi, sentence = self._units(ids, sizes)
        n = hi - lo
        extent = np.array(extent)[sentence]
        out = self.frame[np.where(np.array(title)[sentence], 0, 1), extent, np.minimum(n, 12)]

        def add(unit: np.ndarray, crc: np.ndarray) -> None:
            out[:] += np.bincount(unit, self._weight(crc), len(out))

        unit = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(unit)) + np.repeat(lo - (np.cumsum(n) - n), n)
        form = 2 * ids[at] + (at == lo[unit])
        table = np.array(self.words.forms, np.uint32).reshape(-1, Vocabulary.COLUMNS)
        one, spaced, size, sign = (table[:, c][form] for c in range(4))
        add(unit, one)
        add(unit, table[form, 4 + extent[unit]])
        size, sign = size.astype(np.int64), sign > 0
        i = np.flatnonzero(unit[1:] == unit[:-1])
        two = np.zeros(len(unit), np.uint32)
        two[i] = joined_crc(one[i], spaced[i + 1], size[i + 1] + 1)
        add(unit[i], two[i])
        near = [(unit[sign], one[sign], size[sign])]
        i = i[sign[i] | sign[i + 1]]
        near.append((unit[i], two[i], size[i] + size[i + 1] + 1))
        i = np.flatnonzero(unit[2:] == unit[:-2])
        i = i[sign[i] | sign[i + 1] | sign[i + 2] | (extent[unit[i]] < 2)]
        three = joined_crc(two[i], spaced[i + 2], size[i + 2] + 1)
        short = extent[unit[i]] < 2
        add(unit[i[short]], three[short])
        signed = sign[i] | sign[i + 1] | sign[i + 2]
        i = i[signed]
        near.append((unit[i], three[signed], size[i] + size[i + 1] + size[i + 2] + 2))
        unit, crc, size = (np.concatenate(v) for v in zip(*near))
        for k in "abc":
            add(unit, joined_crc(np.full(len(crc), zlib.crc32(f"{k}\t".encode()), np.uint32), crc, size))
        return out, sentence


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(model.value)
    for b in batches:
        texts = b.column(1).to_pylist()
        best = np.full(len(texts), -np.inf)
        ids, sizes, title, extent, owner = [], [], [], [], []

        def flush() -> None:
            if sizes:
                score, sentence = scorer.scores(ids, sizes, title, extent)
                np.maximum.at(best, np.array(owner)[sentence], score)
            for held in (ids, sizes, title, extent, owner):
                held.clear()
            if len(scorer.words) > VOCABULARY:
                scorer.words = Vocabulary()

        for n, t in enumerate(texts):
            parts = sentences(t)
            whole = Vocabulary.EXTENTS.index(_extent(sum(map(len, parts))))
            for k, s in enumerate(parts):
                before = len(ids)
                ids.extend(map(scorer.words.__getitem__, _TOKEN.findall(s)))
                sizes.append(len(ids) - before)
                title.append(k == 0)
                extent.append(whole)
                owner.append(n)
                if len(ids) + len(sizes) > FLUSH:
                    flush()
        flush()
        p = 1 / (1 + np.exp(-np.clip(best, -30, 30)))
        p[[t is None for t in texts]] = np.nan
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, from_pandas=True)], names=["id", "score"])


def residue_scores(df: DataFrame, manifest: DataFrame, id_col: str, text_col: str, key: str) -> DataFrame:
    """(id, score, is_residue) of every record."""
    x, y, weight, _ = labelled(training_sample(df, manifest, id_col, text_col, key))
    w = fit(x, y, weight) if len(set(y)) > 1 else np.append(np.zeros(DIMENSIONS), -30).astype(np.float32)
    model = df.sparkSession.sparkContext.broadcast(w)  # one megabyte, fixed
    scored = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(partial(_score, model=model), "id bigint, score double")
    return scored.select(F.col("id").alias(id_col), "score", F.coalesce(F.col("score") >= THRESHOLD, F.lit(False)).alias("is_residue"))


def validation(df: DataFrame, manifest: DataFrame, id_col: str, text_col: str, key: str) -> DataFrame:
    """Agreement with the weak labels, by weight, on hosts outside the training: one row."""
    x, y, weight, host = labelled(training_sample(df, manifest, id_col, text_col, key))
    held = np.array([zlib.crc32(h.encode()) % 4 == 0 for h in host])
    row = (0, 0, 0.0, 0.0)
    if held.any() and len(set(y[~held])) > 1:
        w = fit([v for v, h in zip(x, held) if not h], y[~held], weight[~held])
        said = np.array([w[v].sum() + w[-1] > np.log(THRESHOLD / (1 - THRESHOLD)) for v, h in zip(x, held) if h])
        true, by = y[held] == 1, weight[held]
        both = by[said & true].sum()
        row = (len({h for h, z in zip(host, held) if z}), int(held.sum()), float(both / max(1e-9, by[said].sum())), float(both / max(1e-9, by[true].sum())))
    return df.sparkSession.createDataFrame([row], "unseen_hosts bigint, units bigint, precision double, recall double")
