"""Text functions of columns (T-01 to T-28), native where Spark can say it."""

from __future__ import annotations

import html
import io
import unicodedata
import zipfile
from collections.abc import Sequence
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provlake.functions.hashing import SPACE

# Typographic joins and the letters they stand for; marks of forms and their meaning.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "ft", "ﬆ": "st"}
GLYPHS = {"☒": "⊠", "☑": "⊠", "✓": "⊠", "✔": "⊠", "■": "⊠", "☐": "⊡", "□": "⊡", "▢": "⊡", "✗": "⊗", "✘": "⊗"}
MARKS = "".join(GLYPHS)
# Bytes of UTF-8 read as another encoding; a web archive's snapshot.
MOJIBAKE = "â€|Ã¢|Ã©|Ã¨|�"
SNAPSHOT = r"^https://web\.archive\.org/web/(\d{14})(?:id_|if_|im_)?/(.+)$"
# Phrases of a summary, those that little else has, and how many a summary has at least.
TEMPLATE_MARKERS = (
    "public summary of training content", "summary of the content used for training", "article 53", "general-purpose ai",
    "modalities", "size of dataset per modality", "data collection", "training data",
)
DISTINCTIVE_MARKERS = ("public summary of training content", "summary of the content used for training", "size of dataset per modality", "article 53")
MIN_MARKERS = 2

#: Word class of Python's \w without Java's extra marks.
WORD = r"[\p{L}\p{N}_]"


def spell_ligatures(text: Column, long_s_t: str = "st") -> Column:
    """Joined letters spelled out; the long s with t is read either way."""
    for a, b in (LIGATURES | {"ﬅ": long_s_t}).items():
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def normalize(text: Column) -> Column:
    """T-01: ligatures spelled, one kind of line end, no trailing blanks, at most one empty line, one final newline."""
    lines = F.split(F.regexp_replace(spell_ligatures(text), "\r\n?", "\n"), "\n")
    bare = F.array_join(F.transform(lines, lambda x: F.regexp_replace(x, SPACE + r"\z", "")), "\n")
    return F.concat(F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, "\n{3,}", "\n\n"), r"\A" + SPACE, ""), SPACE + r"\z", ""), F.lit("\n"))


def html_text_rx(page: Column) -> Column:
    """T-02 as an expression: text nodes of well-formed HTML, one a line; entities stay."""
    shorn = F.regexp_replace(page, r"(?is)<(script|style|noscript)\b.*?</\1\s*>", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(shorn, r"(?s)<!--.*?-->", ""), "<[^>]*>", "\n"), r"\n\s*", "\n")


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.deaf = [], 0

    def handle_starttag(self, tag, attrs):
        self.deaf += tag in ("script", "style", "noscript")

    def handle_endtag(self, tag):
        self.deaf -= tag in ("script", "style", "noscript") and self.deaf > 0

    def handle_data(self, data):
        if not self.deaf:
            self.parts.append(data)


def text_of_html(page: str | None) -> str | None:
    """T-02: text nodes joined by newlines, scripts and styles left out."""
    if page is None:
        return None
    p = _Text()
    p.feed(page)
    p.close()
    return "\n".join(p.parts)


@F.pandas_udf(T.StringType())
def html_text(page: pd.Series) -> pd.Series:
    """T-02 with a parser: entities resolved."""
    return page.map(text_of_html)


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Composed form; Spark has no function for it."""
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


#: A character outside blocks of which composition changes nothing.
UNSETTLED = r"[^\x00-\u02ff\u0370-\u0373\u0375-\u037d\u037f-\u0386\u0388-\u0482\u048a-\u052f\u2002-\u20cf]"


def composed(text: Column) -> Column:
    """Composed form; only texts that may change are sent to Python."""
    return F.coalesce(nfc(F.when(text.rlike(UNSETTLED), text)), text)


def words_of(text: Column) -> Column:
    """T-09: the diff's tokens: banners dropped, composed, ligatures spelled, marks of forms kept."""
    plain = F.regexp_replace(text, r"(?m)^=====.*=====$", "")
    plain = spell_ligatures(composed(plain), "ft")
    return F.regexp_extract_all(plain, F.lit(rf"[{MARKS}]|[\p{{L}}\p{{N}}_€%.\-/:@,]+"), F.lit(0))


def identity(words: Column) -> Column:
    """T-10: what must be equal for two texts to say the same.

    Marks of forms by meaning, separators between digits as one sign, other
    characters that are no letter or digit left out; case stays.
    """
    line = F.translate(F.array_join(words, " "), MARKS, "".join(GLYPHS.values()))
    line = F.regexp_replace(line, r"(?<=\p{Nd})[.,](?=\p{Nd})", "·")
    return F.regexp_replace(line, r"[^\p{L}\p{N}_⊠⊡⊗·]", "")


def char_stream(text: Column, cap: int = 20_000) -> Column:
    """T-12: ASCII letters and digits, lower case, up to the cap (whole with cap 0)."""
    s = F.regexp_replace(F.lower(text), "[^a-z0-9]", "")
    return F.substring(s, 1, cap) if cap else s


def name_tokens(name: Column) -> Column:
    """T-13: identity-bearing tokens of a name."""
    return F.filter(F.split(F.lower(name), "[^0-9a-z]+"), lambda x: x != "")


def slug_variants(name: Column) -> Column:
    """T-14: spellings of a name in URLs, each once, in order; none for a name without tokens."""
    t = name_tokens(name)
    dashed = F.array_join(t, "-")
    first = F.when(F.size(t) > 1, F.concat(t[0], t[1], F.array_join(F.transform(F.slice(t, 3, F.size(t)), lambda x: F.concat(F.lit("-"), x)), ""))).otherwise(F.array_join(t, ""))
    return F.when(F.size(t) > 0, F.array_distinct(F.array(dashed, F.array_join(t, "_"), F.array_join(t, ""), F.array_join(t, "."), first))).otherwise(F.array().cast("array<string>"))


def marker_count(text: Column, markers: Sequence[str] = TEMPLATE_MARKERS) -> Column:
    """T-15: how many of the phrases stand in the text, whitespace collapsed and case ignored."""
    low = F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")))
    return sum((F.contains(low, F.lit(m)).cast("bigint") for m in markers), F.lit(0).cast("bigint"))


def is_summary(text: Column) -> Column:
    """T-15: enough phrases of a summary, one of them of those that little else has."""
    return (marker_count(text) >= MIN_MARKERS) & (marker_count(text, DISTINCTIVE_MARKERS) > 0)


def yaml_scalar(value: Column) -> Column:
    """T-17: a hand-written scalar: trimmed, spelled-out nulls empty, a date without its clock."""
    t = F.coalesce(F.trim(value), F.lit(""))
    t = F.when(t.isin("None", "null"), "").otherwise(t)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2})?$"), F.substring(t, 1, 10)).otherwise(t)


def slugify(stem: Column) -> Column:
    """T-18: lower case with dashes for underscore, dot and blank."""
    return F.translate(F.lower(stem), "_. ", "---")


def alnum(text: Column) -> Column:
    """T-18: letters and digits in lower case, to compare names by."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]", "")


def dashed(text: Column) -> Column:
    """T-18: runs of other characters as one dash, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def without_owner(slug: Column, owner: Column, name: Column) -> Column:
    """T-19: a slug without its owner's prefix, unless the prefix belongs to the name; a doubled one loses a copy."""
    prefix = F.concat(owner, F.lit("-"))
    rest = F.substr(slug, F.length(prefix) + 1)
    doubled = (rest == owner) | F.startswith(rest, prefix)
    ours = F.startswith(alnum(name), alnum(owner))
    return F.when(F.startswith(slug, prefix) & (doubled | ~ours), rest).otherwise(slug)


def command(comment: Column) -> Column:
    """T-20: struct of action, id and note of the first command line; null fields without one."""
    rx = r"(?im)^\s*/(approve|reject)\b[ \t]*(.*)$"
    act, rest = F.lower(F.regexp_extract(comment, rx, 1)), F.trim(F.regexp_extract(comment, rx, 2))
    ident, note = F.regexp_extract(rest, r"(?i)^id=(\S+)\s*(.*)$", 1), F.trim(F.regexp_extract(rest, r"(?i)^id=(\S+)\s*(.*)$", 2))
    given = F.length(act) > 0
    return F.struct(F.when(given, act).alias("action"), F.when(given & (ident != ""), ident).alias("ident"), F.when(given, F.when(ident != "", note).otherwise(rest)).alias("note"))


def fenced_json(report: Column, schema: str, mark: str = "json") -> Column:
    """T-21: the array in the first fenced block of a report; null if unreadable."""
    return F.from_json(F.regexp_extract(report, rf"(?is)```{mark}\s*(.*?)```", 1), schema)


def members_text(text: Column) -> Column:
    """T-22: (name, text) of the parts of an archive's text, split at its banners."""
    names = F.regexp_extract_all(text, F.lit(r"(?m)^===== (.*) =====$"), F.lit(1))
    parts = F.slice(F.split(text, r"(?m)^===== .* =====$"), 2, 1_000_000)
    return F.transform(F.arrays_zip(names.alias("names"), parts.alias("parts")), lambda z: F.struct(z["names"].alias("name"), F.replace(z["parts"], F.lit("\x00")).alias("text")))


def is_mojibake(text: Column) -> Column:
    """T-23: bytes of UTF-8 read as another encoding."""
    return text.rlike(MOJIBAKE)


def escape_html(text: Column) -> Column:
    """T-24: text that is safe in HTML; null gives the empty text."""
    t = F.coalesce(text, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def safe_href(url: Column) -> Column:
    """T-24: an href with a harmless scheme, else '#'."""
    u = F.trim(F.coalesce(url, F.lit("")))
    harmless = u.rlike("^(https?://|/|#|mailto:)") & ~F.startswith(u, F.lit("//"))
    return F.when(harmless, escape_html(u)).otherwise("#")


def json_in_script(json: Column) -> Column:
    """T-24: JSON that cannot close the element that holds it."""
    for a, b in (("<", "\\u003c"), (">", "\\u003e"), ("&", "\\u0026")):
        json = F.replace(json, F.lit(a), F.lit(b))
    return json


def word_count(text: Column) -> Column:
    """T-25: words as whitespace separates them."""
    return F.size(F.filter(F.split(text, SPACE), lambda x: x != "")).cast("bigint")


def public_notes(notes: Column, internal: list[str]) -> Column:
    """T-26: notes without those that carry an internal marker."""
    return F.filter(notes, lambda n: ~F.exists(F.array(*map(F.lit, internal)), lambda m: F.contains(n, m)))


def snapshot_parts(url: Column) -> Column:
    """T-27: (14-digit time, archived URL) of a web archive's snapshot; null fields otherwise."""
    got = url.rlike(SNAPSHOT)
    return F.struct(F.when(got, F.regexp_extract(url, SNAPSHOT, 1)).alias("stamp"), F.when(got, F.regexp_extract(url, SNAPSHOT, 2)).alias("archived"))


# Suffix by media type, and types that say nothing.
SUFFIX_OF_TYPE = {"application/pdf": ".pdf", "application/zip": ".zip", "text/html": ".html", "application/xhtml+xml": ".html", "text/markdown": ".md", "text/plain": ".txt", "application/json": ".json", "application/msword": ".doc", "application/vnd.openxmlformats-officedocument.wordprocessingml.document": ".docx", "text/yaml": ".yaml", "application/yaml": ".yaml"}
GENERIC_TYPES = ("text/plain", "application/octet-stream")
URL_SUFFIXES = (".pdf", ".zip", ".html", ".md", ".txt", ".docx", ".doc", ".json", ".yaml", ".yml")


def file_type(content_type: Column, url: Column, head: Column | None = None) -> Column:
    """T-08: suffix by media type, unless generic and the URL has one, then by the URL, then by the first bytes."""
    media = F.lower(F.trim(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))
    tail = F.lower(F.substring_index(F.coalesce(url, F.lit("")), "?", 1))
    by_url = F.coalesce(*[F.when(F.endswith(tail, F.lit(s)), s) for s in URL_SUFFIXES])
    by_type = F.coalesce(*[F.when(media == m, s) for m, s in SUFFIX_OF_TYPE.items()])
    found = F.coalesce(F.when(~(media.isin(*GENERIC_TYPES) & by_url.isNotNull()), by_type), by_url)
    if head is not None:
        hexed = F.hex(head)
        found = F.coalesce(found, F.when(F.startswith(hexed, F.lit("255044462D")), ".pdf").when(F.startswith(hexed, F.lit("504B0304")), ".zip").when(F.lower(F.ltrim(F.decode(F.substring(head, 1, 200), "ISO-8859-1"))).rlike("^(<!doctype html|<html)"), ".html"))
    return F.coalesce(found, F.lit(".bin"))


def extractor(stored_as: Column) -> Column:
    """T-28: the reader for a stored file, by its suffix."""
    ext = F.regexp_extract(stored_as, r"(\..*)$", 1)
    return (
        F.when(ext.isin(".pdf", ".zip"), "pdf reader").when(ext == ".html", "html parser").when(ext.isin(".md", ".txt", ".json"), "utf-8 decode")
        .otherwise(F.concat(F.lit("no extractor for "), F.when(ext == "", "this format").otherwise(ext)))
    )


# ---- archives and office files: bytes in, text out (T-03 to T-07) ----------

MAX_MEMBERS, MAX_MEMBER, MAX_TOTAL = 2_000, 100 << 20, 200 << 20


EXTRACTED = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("members", T.ArrayType(T.StructType([T.StructField("inner_file", T.StringType()), T.StructField("inner_sha256", T.StringType())]))),
    T.StructField("note", T.StringType()),
])


def zip_members(content: bytes) -> list[tuple[str, bytes]]:
    """T-05: members sorted by name, within the caps on number and size; raises beyond them."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        infos = sorted((i for i in z.infolist() if not i.is_dir()), key=lambda i: i.filename)
        if len(infos) > MAX_MEMBERS or sum(i.file_size for i in infos) > MAX_TOTAL:
            raise ValueError("archive beyond the caps")
        found, total = [], 0
        for i in infos:
            with z.open(i) as f:
                data = f.read(MAX_MEMBER + 1)
            total += len(data)
            if len(data) > MAX_MEMBER or total > MAX_TOTAL:
                raise ValueError("archive beyond the caps")
            found.append((i.filename, data))
        return found


def docx_text(content: bytes) -> str:
    """T-04: paragraphs of the document and its notes; runs joined, breaks and tabs kept.

    Files that declare a document type or entity are refused.
    """
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    fallback = "{http://schemas.openxmlformats.org/markup-compatibility/2006}Fallback"
    parts = dict(zip_members(content))
    names = [n for n in parts if n == "word/document.xml"] + sorted(n for n in parts if n.startswith(("word/footnotes", "word/endnotes", "word/header", "word/footer")) and n.endswith(".xml"))

    def walk(node, out):
        for child in node:
            if child.tag == fallback:
                continue
            if child.tag == w + "t":
                out.append(child.text or "")
            elif child.tag in (w + "br", w + "cr"):
                out.append("\n")
            elif child.tag == w + "tab":
                out.append("\t")
            else:
                walk(child, out)

    lines = []
    for name in names:
        if b"<!DOCTYPE" in parts[name] or b"<!ENTITY" in parts[name]:
            raise ValueError("document type declared")
        for p in ElementTree.fromstring(parts[name]).iter(w + "p"):
            out: list[str] = []
            walk(p, out)
            lines.append("".join(out))
    return "\n".join(lines)


def extract(content: bytes | None, suffix: str | None) -> tuple[str | None, list[tuple[str, str]], str]:
    """T-03 to T-06: (text, members with hashes, note); never raises: a file without text has a note instead."""
    import hashlib

    if content is None:
        return None, [], "no bytes"
    try:
        if suffix == ".html":
            return text_of_html(content.decode("utf-8", "replace")), [], ""
        if suffix in (".md", ".txt", ".json", ".yaml", ".yml"):
            text = content.decode("utf-8", "replace")
            lost = text.count("�")
            return text, [], f"{lost} undecodable bytes" if lost else ""
        if suffix == ".docx":
            return docx_text(content), [], ""
        if suffix == ".pdf":
            try:
                import pypdf
            except ImportError:
                return None, [], "no pdf reader here"
            return "\n".join(p.extract_text() or "" for p in pypdf.PdfReader(io.BytesIO(content)).pages), [], ""
        if suffix == ".zip":
            parts, members = [], []
            for name, data in zip_members(content):
                members.append((name, hashlib.sha256(data).hexdigest()))
                text, _, _ = extract(data, "." + name.rsplit(".", 1)[-1].lower()) if not name.lower().endswith(".zip") else (None, [], "")
                if text:
                    parts.append(f"===== {name} =====\n{text}")
            return "\n".join(parts) or None, members, "" if parts else "no text in the archive"
        return None, [], f"no extractor for {suffix or 'this format'}"
    except Exception as e:  # noqa: BLE001: the text is derived, the document is the evidence
        return None, [], f"extraction failed: {type(e).__name__}"


@F.pandas_udf(EXTRACTED)
def extract_text(content: pd.Series, suffix: pd.Series) -> pd.DataFrame:
    """T-06 over columns of bytes and suffixes."""
    rows = [extract(c, s) for c, s in zip(content, suffix)]
    return pd.DataFrame({"text": [r[0] for r in rows], "members": [[{"inner_file": a, "inner_sha256": b} for a, b in r[1]] for r in rows], "note": [r[2] for r in rows]})


def in_scope(members: Column, wanted: str, unwanted: str) -> Column:
    """T-07: members whose names match one pattern and not the other."""
    return F.filter(members, lambda m: m["inner_file"].rlike(wanted) & ~m["inner_file"].rlike(unwanted))


@F.pandas_udf(T.BooleanType())
def names_model(text: pd.Series, model: pd.Series, siblings: pd.Series) -> pd.Series:
    """T-16: whether the head of a text names the model, and not a longer-named sibling.

    Tokens stand next to each other, at most three separators apart; a name that
    ends in a number is not followed by another number.
    """
    import re

    def tokens(s):
        return re.findall("[0-9a-z]+", (s or "").lower())

    def named(text, model, siblings):
        own = tokens(model)
        if not own or text is None:
            return False
        found = [(m.group(), m.start(), m.end()) for m in re.finditer("[0-9a-z]+", text[:3000].lower())]
        longer = [t[len(own) :] for t in map(tokens, siblings if siblings is not None else ()) if len(t) > len(own) and t[: len(own)] == own]

        def follows(at, wanted):
            part = found[at : at + len(wanted)]
            return len(part) == len(wanted) and all(p[0] == t for p, t in zip(part, wanted)) and all(found[k][1] - found[k - 1][2] <= 3 for k in range(max(at, 1), at + len(wanted)))

        for at in range(len(found)):
            part = found[at : at + len(own)]
            if [p[0] for p in part] != own or any(b[1] - a[2] > 3 for a, b in zip(part, part[1:])):
                continue
            after = at + len(own)
            if own[-1].isdigit() and after < len(found) and found[after][0][0].isdigit() and found[after][1] - found[after - 1][2] <= 3:
                continue
            if any(follows(after, t) for t in longer):
                continue
            return True
        return False

    return pd.Series([named(t, m, s) for t, m, s in zip(text, model, siblings)])


def unescape(text: str) -> str:
    """Entities of an HTML text resolved."""
    return html.unescape(text)
