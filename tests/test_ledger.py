"""Versions, entities, integrity, files and sinks on small synthetic corpora."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from provlake.operators import integrity, ordered, versions
from provlake.sources import readers, sinks


def test_lag_over_hot_key_and_nulls(spark):
    rows = [("hot", k, k * 2) for k in range(500)] + [(f"k{k}", k, k) for k in range(50)] + [(None, 1, 7), (None, 2, 8)]
    df = spark.createDataFrame(rows, "k string, o int, v int").repartition(7)
    got = {(r["k"], r["o"]): r["prior_v"] for r in ordered.lag_over(df, ["k"], ["o"], ["v"]).collect()}
    assert got["hot", 0] is None and all(got["hot", k] == 2 * k - 2 for k in range(1, 500)) and got[None, 2] == 7 and got[None, 1] is None and got["k7", 7] is None
    assert ordered.lag_over(df.limit(0), ["k"], ["o"], ["v"]).count() == 0


def test_numbers_and_places(spark, tmp_path):
    import random

    values = list(range(2000))
    random.Random(3).shuffle(values)
    df = spark.createDataFrame([(v, v % 7) for v in values], "v int, w int").repartition(5)
    got = ordered.ranked(df, ["w", "v"], "place").orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(1, 2001)) and [(r["w"], r["v"]) for r in got] == sorted((v % 7, v) for v in values)
    (tmp_path / "lines.txt").write_text("".join(f"line {k}\n" for k in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = ordered.numbered(spark.read.text(str(tmp_path / "lines.txt")), "seq").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r["seq"], r["value"]) for r in rows) == [(k + 1, f"line {k}") for k in range(5000)]


def test_change_detect(spark):
    rows = [(1, "a", "x"), (2, "a", "x"), (3, "b", "x "), (4, "c", "y"), (5, "d", " x"), (6, None, None), (7, "e", None)]
    df = spark.createDataFrame([(i, "s", "t", f"d{i}", i, sha, txt) for i, sha, txt in rows], "capture_id int, source_id string, target string, capture_dir string, captured_at int, sha256 string, extracted_txt string")
    got = {r["capture_id"]: r["change"] for r in versions.change_detect(df).collect()}
    assert got == {1: "new", 2: "unchanged", 3: "unchanged-content", 4: "new-version", 5: "unchanged-content", 6: "new-version", 7: "new-version"}


def test_entities(spark):
    reg = spark.createDataFrame([("a", "Org", "M-1", [("u1",)]), ("b", "Org", "M 2", [("u2",), ("u3",)]), ("c", "org", "m2", [("u3",), ("u4",)])], "source_id string, provider string, model string, targets array<struct<url:string>>")
    items = spark.createDataFrame([(1, "ORG", "M1", None), (2, "Org", "M2", "u2"), (3, "x", "y", "u3"), (4, None, None, "u4"), (5, None, None, None)], "i int, provider string, model string, url string")
    got = {r["i"]: (r["resolved"], r["how"]) for r in versions.resolve_entities(items, reg, "none").collect()}
    assert got == {1: ("a", "name"), 2: ("b", "url"), 3: ("none", "fallback"), 4: ("c", "url"), 5: ("none", "fallback")}


def test_survivors_never_name_a_victim(spark):
    caps = spark.createDataFrame([(k, "h" if k < 6 else f"h{k}", f"s{k % 2}", f"d{k}") for k in range(8)], "capture_id int, sha256 string, source_id string, capture_dir string")
    gone = caps.where("capture_id in (0, 1, 6)").withColumnRenamed("capture_id", "key")
    got = {r["key"]: r["survives_in"] for r in versions.survivors(caps, gone).collect()}
    assert got == {0: "d2", 1: "d3", 6: None}


@pytest.fixture
def corpus(tmp_path):
    def add(stamp, raw, text, name="raw.pdf", manifest=True, **extra):
        d = tmp_path / "captures" / "prov__model" / "provider-live-aaaa1111" / stamp
        d.mkdir(parents=True)
        (d / name).write_bytes(raw)
        (d / "extracted.txt").write_text(text, newline="")
        m = {"source_id": "prov/model", "stored_as": name, "sha256": hashlib.sha256(raw).hexdigest(), "size_bytes": len(raw), "text_sha256": hashlib.sha256(" ".join(text.split()).encode()).hexdigest(), "extraction_notes": ["x", {"inner_file": "a"}], "ots": {"ok": True, "calendars": []}, "http": {"status_code": 200}, **extra}
        if manifest:
            (d / "manifest.json").write_text(json.dumps(m, indent=1))
        return d

    return tmp_path, add


def test_files(spark, corpus):
    root, add = corpus
    add("20260801T000000Z", b"%PDF one", "a\r\nb\rc")
    add("20260802T000000Z", b"%PDF two", "text", size_bytes=3)
    add("20260803T000000Z", b"%PDF three", "text", sha256="00")
    bad = add("20260804T000000Z", b"x", "text", manifest=False)
    (bad / "manifest.json").write_text("{ broken")
    m = readers.manifests(spark, str(root))
    assert m.count() == 3 and {r["capture_dir"][-16:] for r in m.collect()} == {"20260801T000000Z", "20260802T000000Z", "20260803T000000Z"}
    files = readers.raw_files(spark, str(root))
    assert files.count() == 4
    found = {r["key"][-16:]: r["message"] for r in integrity.bytes_match(m, files).collect()}
    assert found == {"20260802T000000Z": "other size", "20260803T000000Z": "other bytes"}
    assert {r["text"] for r in readers.extracted_texts(spark, str(root)).collect()} == {"a\nb\nc", "text"}
    proofs = spark.createDataFrame([(r["capture_dir"], None if "0802" in r["capture_dir"] else r["sha256"]) for r in m.collect() if "0803" not in r["capture_dir"]] + [("captures/other", "00")], "capture_dir string, digest string")
    got = {(r["key"][-16:], r["message"]) for r in integrity.proofs_match(m, proofs).collect()}
    assert got == {("20260802T000000Z", "proof unreadable"), ("20260803T000000Z", "proof missing"), ("captures/other", "orphan proof")}


def test_readers(spark, tmp_path):
    (tmp_path / "events.jsonl").write_text('{"ts": "2026-01-01", "outcome": "new"}\nnot json\n[1]\n\n{"outcome": "error"}\n')
    log = readers.event_log(spark, str(tmp_path / "events.jsonl")).orderBy("seq").collect()
    assert [r["seq"] for r in log] == [1, 2, 3, 4, 5] and [r["e"] is not None for r in log] == [True, False, False, False, True]
    (tmp_path / "state.json").write_text(json.dumps({"a/b::t-1": {"last_sha256": "x", "versions": [{"sha256": "1", "dir": "d1"}, {"sha256": "2", "dir": "d2"}]}, "c::u": {"versions": []}}))
    targets, vs = readers.state_versions(spark, str(tmp_path / "state.json"))
    assert targets.count() == 2 and [(r["source_id"], r["target"], r["ord"], r["dir"]) for r in vs.orderBy("ord").collect()] == [("a/b", "t-1", 0, "d1"), ("a/b", "t-1", 1, "d2")]
    (tmp_path / "sources.json").write_text(json.dumps({"counts": {}, "sources": [{"id": "a/b", "provider": "A", "targets": [{"kind": "k", "url": "u"}]}]}))
    assert readers.registry(spark, str(tmp_path / "sources.json")).collect()[0]["source_id"] == "a/b"
    (tmp_path / "batch.tsv").write_text("# c\ns\tt\treason\n")
    assert readers.batch_lines(spark, str(tmp_path / "batch.tsv"), ["a", "b", "c"]).collect()[0]["c"] == "reason"
    (tmp_path / "bad.tsv").write_text("s\tt\n")
    with pytest.raises(Exception, match="wrong number of fields"):
        readers.batch_lines(spark, str(tmp_path / "bad.tsv"), ["a", "b", "c"]).collect()
    (tmp_path / "a.yaml").write_text("name: x\nwhen: 2026-01-01\nlist: [1]\n")
    (tmp_path / "b.yaml").write_text("- 1\n")
    got = {r["path"][-6:]: r["fields"] for r in readers.yaml_headers(spark, str(tmp_path / "*.yaml")).collect()}
    assert got["b.yaml"] is None and (got["a.yaml"] is None or got["a.yaml"]["name"] == "x")


def test_mining(spark):
    page = '"series_title":"Other","x":[{"file_url":"https:\\/\\/h\\/0"}],"series_title":"Mine","e":[{"period":"2026\\u20132027","file_url":"https:\\/\\/h\\/a.pdf"},{"file_url":"https:\\/\\/h\\/b.pdf","period":"1"}],"series_title":"Next","e":[{"file_url":"https:\\/\\/h\\/z"}]'
    df = spark.createDataFrame([(page, "<a href='version-2026-01-02/'>x</a><a href=\"https://o.example/version-2026-01-01\">y</a><a href=\"/v/version-2026-01-01\">z</a><a href='version-2026-01-02/'>x</a>")], "p string, q string")
    assert [tuple(e) for e in df.select(readers.embedded_editions(F.col("p"), "Mine")).collect()[0][0]] == [("https://h/a.pdf", "2026-2027"), ("https://h/b.pdf", "1")]
    assert df.select(readers.dated_links(F.col("q"), F.lit("https://h.example/docs/index.html"))).collect()[0][0] == ["https://h.example/docs/version-2026-01-02/", "https://h.example/v/version-2026-01-01"]
    xml = spark.createDataFrame([("<loc> https://a </loc><loc>https://b</loc><loc>https://a</loc>", 'x "https://s.example/f.zip?r=1&amp;k=2" y')], "x string, y string")
    assert xml.select(readers.locations(F.col("x"))).collect()[0][0] == ["https://a", "https://b"]
    assert tuple(xml.select(readers.signed_links(F.col("y"), "s.example")).collect()[0][0][0]) == ("https://s.example/f.zip?r=1&k=2", "https://s.example/f.zip")


FETCH = "source_id string, target string, capture_dir string, fetched_at string, sha256 string, text_sha string"


def test_write_path(spark, tmp_path):
    held = spark.createDataFrame([("s", "t", "d1", "1", "a", "x"), ("s", "t", "d2", "2", "b", "y")], FETCH)
    fetched = spark.createDataFrame([("s", "t", "d3", "3", "c", "x"), ("s", "u", "d4", "3", "a", "x"), ("s", "v", "d5", "3", "e", None)], FETCH)
    new, log = sinks.store_versions(fetched, held)
    assert {(r["target"], r["prior_sha256"]) for r in new.collect()} == {("u", None), ("v", None)}
    assert {r["target"]: (r["outcome"], r["matches"]) for r in log.collect()} == {"t": ("unchanged-content", "d1"), "u": ("new", None), "v": ("new", None)}
    write = sinks.version_writer(str(tmp_path))
    write(held, 0)
    write(fetched, 1)
    write(fetched, 1)  # the batch comes again after a failure
    assert {(r["target"], r["capture_dir"]) for r in spark.read.parquet(str(tmp_path / "versions")).collect()} == {("t", "d2"), ("t", "d3"), ("u", "d4"), ("v", "d5")}


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.replace_table(spark.range(3), path)
    sinks.replace_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["table"]
    sinks.append_events(spark.createDataFrame([("new",)], "outcome string"), str(tmp_path / "log"), "eu-1")
    row = spark.read.json(str(tmp_path / "log")).collect()[0]
    assert row["vantage"] == "eu-1" and row["ts"].endswith("Z")
    feed = sinks.change_feed_xml(spark.createDataFrame([("a&b", "2026-01-01", "<x>"), ("c", "2026-01-02", "y")], "id string, updated string, text string"), "t").collect()[0][0]
    assert feed.index("<id>c</id>") < feed.index("a&amp;b") and "&lt;x&gt;" in feed
    records = spark.createDataFrame([("k", "open", [("replace", "a", "b")]), ("l", "shut", [("replace", "secret", "b")])], "key string, source_id string, changes array<struct<op:string,old:string,new:string>>")
    sinks.write_ledger(records, str(tmp_path / "ledger"), spark.createDataFrame([("shut",)], "source_id string"))
    assert "secret" not in "".join(p.read_text() for p in (tmp_path / "ledger").glob("*.json"))


def test_lint(spark):
    ok = '<link rel="canonical" href="/a">text'
    rows = [("/a", "A", "d", ok), ("/b", "B", "d", ok + '<a href="/none">x</a>'), ("/c", "A", "", "{placeholder} â€ <pre class='extract'>{fine}</pre>"), ("/d", "D", "d", ok + "<pre class='extract'>{fine} â€</pre>")]
    pages = spark.createDataFrame(rows, "path string, title string, description string, html string")
    got = {(r["check"], r["key"]) for r in integrity.lint_pages(pages, spark.createDataFrame([("x.html",), ("x.html.txt",)], "name string")).collect()}
    assert got == {("L1", "/b"), ("L2", "/c"), ("L6", "/c"), ("L7", "/a"), ("L12", "/c"), ("L13", "/c"), ("L10", "x.html")}
    assert integrity.lint_pages(pages.limit(0)).count() == 0
    with pytest.raises(Exception, match="dropped id"):
        integrity.require_empty(pages, "dropped id").collect()
    assert integrity.require_empty(pages.limit(0), "dropped id").collect() == []


def test_index_checks(spark):
    state = spark.createDataFrame(
        [("s::t", "s", "t", "2", "./c/20260102T000000Z", [("1", "c/20260101T000000Z"), ("2", "c/20260102T000000Z/")]), ("s::u", "s", "u", "9", "x", [("1", "d/20260103T000000Z"), ("2", "d/20260101T000000Z")]), ("s::v", "s", "v", None, None, []), ("s::w", "s", "w", None, None, None)],
        "state_key string, source_id string, target string, last_sha256 string, last_capture string, versions array<struct<sha256:string,dir:string>>",
    )
    assert {r["key"] for r in integrity.tails_match(state).collect()} == {"s::u"}
    assert {r["key"] for r in integrity.without_versions(state).collect()} == {"s::v", "s::w"}
    assert [r["key"] for r in integrity.in_order(state).collect()] == ["d/20260101T000000Z"]
    caps = spark.createDataFrame([("c/20260101T000000Z",), ("e",), (None,)], "capture_dir string")
    assert {(r["key"], r["message"]) for r in integrity.index_matches(state, caps).collect()} == {("c/20260102T000000Z", "indexed, not stored"), ("d/20260103T000000Z", "indexed, not stored"), ("d/20260101T000000Z", "indexed, not stored"), ("e", "stored, not indexed")}
