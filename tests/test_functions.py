"""Scalar functions against small models written afresh in Python."""

import hashlib
import io
import json
import random
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from provlake.functions import hashing, text, times, urls


def column(spark, values, expr, kind="string"):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", expr(F.col("v")).alias("x"))
    return [r["x"] for r in df.orderBy("i").collect()]


STRINGS = ["", " ", "a b", "a b\t\nc\x1fd", "x\r\ny \r z\n\n\n\nw  ", "ﬁx ﬅone", "Ünï 1,5 và 2.5", "☒ ja ☐ nein", "é", "café_1 –", None, " lead", "no_break tail　"]


def test_canonical_hash(spark):
    want = [None if s is None else hashlib.sha256(" ".join(s.split()).encode()).hexdigest() for s in STRINGS]
    assert column(spark, STRINGS, hashing.canonical_sha) == want


def test_normalize(spark):
    joins = str.maketrans({**text.LIGATURES, "ﬅ": "st"})

    def model(s):
        import re

        s = s.translate(joins).replace("\r\n", "\n").replace("\r", "\n")
        return re.sub(r"\n{3,}", "\n\n", "\n".join(x.rstrip() for x in s.split("\n"))).strip() + "\n"

    rng = random.Random(0)
    more = ["".join(rng.choice("ab \t\r\n  ﬁ\x1c") for _ in range(30)) for _ in range(300)]
    values = [s for s in STRINGS if s is not None] + more
    assert column(spark, values, text.normalize) == [model(s) for s in values]


def test_identity_truths(spark):
    """Texts that must differ, and texts that must not."""
    pairs = [("☒ a ☐ b", "☐ a ☒ b", False), ("1.5", "15", False), ("2.5%", "25%", False), ("Ab", "ab", False), ("λόγος", "λόγοι", False), ("train ing", "training", True), ("well-known", "wellknown", True), ("1,5", "1.5", True), ("ﬁnal", "final", True), ("é", "é", True), ("a - b", "a b", True)]
    df = spark.createDataFrame(pairs, "a string, b string, same boolean")
    got = df.select((text.identity(text.words_of(F.col("a"))) == text.identity(text.words_of(F.col("b")))).alias("x"), "same").collect()
    assert [r["x"] for r in got] == [p[2] for p in pairs]


def test_composed(spark):
    import re
    import unicodedata

    blocks = re.compile(text.UNSETTLED)
    settled = [chr(c) for c in range(0x3000) if not blocks.search(chr(c))]
    assert all(unicodedata.normalize("NFC", c) == c and not unicodedata.combining(c) for c in settled)
    values = ["cafe\u0301", "caf\u00e9", "\u212a", "\u03ac\u03b1\u0301", "plain", "", None, "\ud55c"]
    assert column(spark, values, text.composed) == [None if v is None else unicodedata.normalize("NFC", v) for v in values]


def test_week_bucket_and_member_key(spark):
    u = [f"https://x.example/{k}" for k in range(60)]
    assert column(spark, u, hashing.week_bucket) == [int(hashlib.sha256(x.encode()).hexdigest(), 16) % 7 for x in u]
    members = [("b.pdf", "22"), ('a "q" \\ é.pdf', "11")]
    want = hashlib.sha256(json.dumps(sorted(map(list, members)), ensure_ascii=False).encode()).hexdigest()
    df = spark.createDataFrame([(members,)], "m array<struct<inner_file:string,inner_sha256:string>>")
    assert df.select(hashing.member_key(F.col("m"))).collect()[0][0] == want


def test_links(spark):
    page = '<a href="/x.PDF?v=1">a</a><A class=q href=\'y.zip#t\'>b</A><a href="z.html">c</a><a href="/x.PDF?v=1">again</a>'
    assert column(spark, [page, "<p>none</p>", None], hashing.document_links) == [["/x.PDF?v=1", "y.zip#t"], [], None]
    assert column(spark, ["<p>none</p>"], hashing.links_sha) == [None]


def test_slug_variants(spark):
    assert column(spark, ["GPT-5.6 Sol", "one", "", None], text.slug_variants)[:3] == [["gpt-5-6-sol", "gpt_5_6_sol", "gpt56sol", "gpt.5.6.sol", "gpt5-6-sol"], ["one"], []]


def test_names_model(spark):
    rows = [("MAI-Image-2.5 summary", "MAI-Image-2", [], False), ("Summary of MAI Image 2", "MAI-Image-2", [], True), ("FLUX.2 Klein", "FLUX.2", ["FLUX.2 Klein"], False), ("FLUX.2 and more", "FLUX.2", ["FLUX.2 Klein"], True), ("x " * 2000 + "Apertus", "Apertus", [], False), ("", "a", [], False), (None, "a", [], False), ("a", "", [], False)]
    df = spark.createDataFrame(rows, "t string, m string, s array<string>, want boolean")
    assert [r[0] for r in df.select(text.names_model("t", "m", "s")).collect()] == [r[3] for r in rows]


def test_extraction():
    def archive(**members):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, data in members.items():
                z.writestr(name.replace("__", "."), data)
        return out.getvalue()

    got, members, note = text.extract(archive(b__txt=b"two", a__txt=b"one", c__bin=b"\x00"), ".zip")
    assert got == "===== a.txt =====\none\n===== b.txt =====\ntwo" and [m[0] for m in members] == ["a.txt", "b.txt", "c.bin"] and note == ""
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    docx = io.BytesIO()
    with zipfile.ZipFile(docx, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:p><w:r><w:t>He</w:t></w:r><w:r><w:t>llo</w:t><w:br/><w:t>you</w:t></w:r></w:p></w:document>")
        z.writestr("word/footnotes.xml", f"<w:footnotes {w}><w:p><w:r><w:t>note</w:t></w:r></w:p></w:footnotes>")
    assert text.extract(docx.getvalue(), ".docx")[0] == "Hello\nyou\nnote"
    bad = io.BytesIO()
    with zipfile.ZipFile(bad, "w") as z:
        z.writestr("word/document.xml", "<!DOCTYPE x><x/>")
    assert text.extract(bad.getvalue(), ".docx")[0] is None
    assert text.extract(b"broken", ".zip")[2].startswith("extraction failed")
    assert text.extract(None, ".txt")[0] is None and text.extract(b"\xff", ".txt")[2] == "1 undecodable bytes"
    assert text.extract(b"<p>a &amp; b</p><script>x</script>", ".html")[0] == "a & b"


def test_urls(spark):
    assert column(spark, [" x.example/a?utm_source=1&b=2 ", "https://y/?gclid=3", "", None], urls.normalize_url) == ["https://x.example/a?b=2", "https://y/", "", None]
    df = spark.createDataFrame([("https://a/b%20c/", "https://a/b c"), ("https://a/100%", "https://a/100%/"), ("https://a/x+y", "https://a/x y"), (None, "")], "a string, b string")
    assert [r[0] for r in df.select(urls.same_url(F.col("a"), F.col("b"))).collect()] == [True, True, False, True]
    hosts = ["localhost", "10.0.0.1", "8.8.8.8", "0x7f.1", "example.com", "127.1", "[::1]", None, "a.local"]
    assert column(spark, hosts, urls.public_host) == [False, False, True, False, True, False, False, False, False]
    assert column(spark, ["captures/a/kind-x-12ab/2025", "a\\b-1\\c", "x", None], urls.kind_of_dir) == ["kind-x", "b", "", ""]
    assert column(spark, ["public/archive/a/B.PDF", "evals/x.yaml", "evals/d/x.yaml", "else"], lambda p: urls.route(p, [("evals/", False, (".yaml",), "e"), ("public/archive/", True, (".pdf",), "a")])) == ["a", "e", None, None]


def test_times(spark):
    assert column(spark, ["20260811T102809Z", "junk", "20261345T000000Z"], times.human_date) == ["11 Aug 2026", "junk", "20261345T000000Z"]
    df = spark.createDataFrame([("20260101000000", "2026-01-01T01:00:00Z", True), ("20260101000000", "2026-01-01T01:00:01Z", False), ("20260101020000", "2026-01-01T00:00:00Z", True), (None, "2026-01-01T00:00:00Z", None), ("x", "y", None)], "s string, a string, want boolean")
    assert [r[0] for r in df.select(times.is_fresh(F.col("s"), F.col("a"))).collect()] == [r["want"] for r in df.collect()]
    assert column(spark, ["20", "x", None, "99999", " 70 "], lambda c: times.clamped(c, 900, 60, 3600)) == [60.0, 900.0, 900.0, 3600.0, 70.0]


def test_html_escapes(spark):
    assert column(spark, ["javascript:x", "//evil", "https://a?b&c", None], text.safe_href) == ["#", "#", "https://a?b&amp;c", "#"]
    assert text.html_text.func(pd.Series(["<b>x</b>", None])).tolist()[0] == "x"
