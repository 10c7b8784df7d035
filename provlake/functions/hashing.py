"""Content identity: hashes of bytes, texts, links, members and keys (H-01 to H-07).

All functions take and give columns; a null input gives null unless said
otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whitespace as Python's str.split has it.
SPACE = r"(?U)[\s\x1c-\x1f]+"

# Suffixes of linked documents.
DOCUMENT_LINKS = (".pdf", ".docx", ".doc", ".zip", ".md", ".txt", ".json")


def sha256_hex(data: Column) -> Column:
    """H-01: SHA-256 of bytes or of a text's UTF-8."""
    return F.sha2(data, 256)


def collapsed(text: Column) -> Column:
    """The text with runs of whitespace as one space and none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def canonical_sha(text: Column) -> Column:
    """H-02: the hash by which a change of content is told from one of layout."""
    return F.sha2(collapsed(text), 256)


def target_slug(kind: Column, url: Column) -> Column:
    """H-03: kind and the first eight digits of the URL's hash."""
    return F.concat(kind, F.lit("-"), F.substring(F.sha2(url, 256), 1, 8))


def document_links(html: Column, suffixes: tuple[str, ...] = DOCUMENT_LINKS) -> Column:
    """Sorted distinct hrefs of anchors whose path ends as a document's does."""
    found = F.regexp_extract_all(html, F.lit(r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1))
    hrefs = F.transform(found, F.trim)
    path = lambda h: F.lower(F.substring_index(F.substring_index(h, "?", 1), "#", 1))
    ends = lambda h: F.exists(F.array(*map(F.lit, suffixes)), lambda s: F.endswith(path(h), s))
    return F.array_sort(F.array_distinct(F.filter(hrefs, ends)))


def links_sha(html: Column, suffixes: tuple[str, ...] = DOCUMENT_LINKS) -> Column:
    """H-04: hash of the document links of a page; null without any."""
    links = document_links(html, suffixes)
    return F.when(F.size(links) > 0, F.sha2(F.array_join(links, "\n"), 256))


def member_key(members: Column) -> Column:
    """H-05: hash of an archive's sorted (name, hash) pairs, written as JSON with Python's separators.

    Names keep their characters; backslash and quote are escaped.
    """
    quoted = lambda s: F.concat(F.lit('"'), F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    pairs = F.transform(F.array_sort(members), lambda m: F.concat(F.lit("["), quoted(m["inner_file"]), F.lit(", "), quoted(m["inner_sha256"]), F.lit("]")))
    return F.sha2(F.concat(F.lit("["), F.array_join(pairs, ", "), F.lit("]")), 256)


def candidate_key(*parts: Column) -> Column:
    """H-06: sixteen digits for a candidate; nulls count as empty."""
    return F.substring(F.sha2(F.concat_ws("|", *(F.coalesce(p, F.lit("")) for p in parts)), 256), 1, 16)


def week_bucket(url: Column) -> Column:
    """H-07: the URL's hash modulo 7, Monday 0: the weekday of its full fetch.

    16 to the 15th leaves 1 when divided by 7, so chunks of fifteen digits can
    be added up.
    """
    h = F.sha2(url, 256)
    chunks = [(1, 4), *((5 + 15 * k, 15) for k in range(4))]
    return F.pmod(sum((F.conv(F.substring(h, a, n), 16, 10).cast("bigint") % 7 for a, n in chunks), F.lit(0)), F.lit(7)).cast("bigint")
