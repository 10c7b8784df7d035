"""Schema drift: profiles, flooding, renames and the consistent table (problem 2)."""

import json
import random

from provlake.operators import schema_drift as drift

SCHEMA = "feed string, file_no int, rec_no int, body string"


def record(i, rng):
    return {"model_name": f"Name {rng.choice('ABCDEF')}{rng.randrange(9)}", "size": rng.randrange(10_000, 99_999), "wayback": {"ok": rng.random() < 0.5, "url": f"https://x.example/{i}"}, "ots": {"calendars": [f"https://cal-{k}.example" for k in range(rng.randrange(3))]}}


def feed(spark):
    rng, rows = random.Random(1), []
    for no in range(1, 7):
        for i in range(40):
            r = record(i, rng)
            if no >= 2:
                r["identity"] = {"model": r.pop("model_name")}
            if no >= 3:
                r["wayback"]["ok"] = str(r["wayback"]["ok"]).lower()
            if no >= 4:
                r["weight"] = rng.random()
                r.pop("size")
            if no == 4 and i < 3:
                r["rare"] = 1  # fewer than a tenth
            if no >= 5:
                r["calendars"] = r.pop("ots")["calendars"]
            if no == 6:
                r["empty"] = {}
                r["void"] = None
            rows.append(("f", no, i, json.dumps(r)))
    rows += [("f", 1, 90, None), ("f", 1, 91, "not json"), ("f", 1, 92, "[1]"), ("g", 3, 0, '{"a": 1}'), ("g", 5, 0, '{"b": 1}'), (None, 1, 1, "{}")]
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as path", "1 as c")


def test_changes(spark):
    got = {tuple(r)[1:] for r in drift.schema_changes(feed(spark)).collect()}
    assert got == {
        (2, "model_name", "renamed", "identity.model"), (3, "wayback.ok", "type_changed", ""), (4, "weight", "added", ""), (4, "size", "removed", ""), (5, "ots.calendars", "renamed", "calendars"), (6, "void", "added", ""),
    }
    assert drift.schema_changes(feed(spark).limit(0)).count() == 0


def test_consistent_table(spark):
    df = feed(spark)
    table = drift.consistent_table(df)
    assert table.count() == df.count()
    assert {"model_name", "ots_calendars", "wayback_ok", "wayback_url", "weight", "size"} <= set(table.columns) and "identity_model" not in table.columns
    f = table.where("feed = 'f' and rec_no < 40")
    assert f.where("model_name is null").count() == 0
    kinds = dict(table.dtypes)
    assert kinds["size"] == "double" and kinds["wayback_ok"] == "string"
    assert f.where("file_no < 3 and wayback_ok not in ('true', 'false')").count() == 0


def alias_rows(spark, changes, files):
    df = drift.aliases(spark.createDataFrame(changes, drift.CHANGES), spark.createDataFrame([("f", n) for n in files], "feed string, file_no int"))
    return {r["file_no"]: (r["names"], set(r["past"])) for r in df.collect()}


def test_earlier_names_stay_known(spark):
    """Any earlier name of a field is known in later files, also after two renames and a removal, until it is taken anew."""
    got = alias_rows(spark, [("f", 2, "a", "renamed", "b"), ("f", 3, "b", "renamed", "c"), ("f", 5, "c", "removed", ""), ("f", 6, "b", "added", "")], range(1, 7))
    assert got[1] == ({}, set()) and got[2] == ({"b": "a"}, {"a"})
    assert got[3] == got[4] == ({"b": "a", "c": "a"}, {"a", "b"})
    assert got[5] == ({"b": "a", "c": "a"}, {"a", "b", "c"}) and got[6] == ({"c": "a"}, {"a", "c"})


def table_of(spark, rows):
    return drift.consistent_table(spark.createDataFrame(rows, SCHEMA))


def named(rng):
    return {"model_name": f"Name {rng.choice('ABCDEF')}{rng.randrange(9)}", "size": rng.randrange(10_000, 99_999)}


def test_colliding_names_have_their_own_columns(spark):
    """Paths that would make one column name, in whatever case, and the key columns stay apart."""
    body = {"wayback": {"ok": True}, "wayback_ok": "no", "Wayback_OK": 7, "feed": "x", "rest": [1]}
    t = table_of(spark, [("f", 1, i, json.dumps(body)) for i in range(5)])
    assert len({c.lower() for c in t.columns}) == len(t.columns) == 4 + 5
    r = t.first().asDict()
    assert r["feed"] == "f" and r["feed_2"] == "x" and r["rest"] is None and r["rest_2"] == "[1]"
    assert (r["Wayback_OK"], r["wayback_ok_2"], r["wayback_ok_3"]) == (7.0, True, "no")


def test_one_name_over_feeds_and_gaps(spark):
    """Feeds that begin with other spellings, and a rename across a missing file, share one column."""
    rng = random.Random(3)
    rows = []
    for feed, no, key in (("a", 1, "model_name"), ("a", 2, "model_name"), ("b", 1, "modelName"), ("c", 1, "model_name"), ("c", 4, "model_title")):
        for i in range(60):
            r = named(rng)
            r[key] = r.pop("model_name")
            rows.append((feed, no, i, json.dumps(r)))
    t = table_of(spark, rows)
    assert set(t.columns) == {"feed", "file_no", "rec_no", "model_name", "size", "rest"}
    assert t.where("model_name is null or size is null or rest is not null").count() == 0


def test_nothing_is_lost(spark):
    """Rare fields have columns; values that cannot be cast, and those under a second name, are in rest."""
    rows = [("f", 1, i, json.dumps({"n": i, "flag": True})) for i in range(30)]
    rows += [("f", 1, 30, '{"n": "many", "flag": "TRUE", "rare": {"deep": [1]}}'), ("f", 1, 31, '{"n": 9007199254740993, "flag": 2}'), ("f", 1, 32, '{"n": "4.5", "odd\\ud800": 1}'), ("f", 1, 33, None)]
    t = table_of(spark, rows)
    got = {r["rec_no"]: r.asDict() for r in t.collect()}
    assert got[3]["n"] == 3.0 and got[30]["n"] is None and json.loads(got[30]["rest"]) == {"n": "many"} and got[30]["flag"] is True and got[30]["rare_deep"] == "[1]"
    assert json.loads(got[31]["rest"]) == {"n": 9007199254740993, "flag": 2} and got[32]["n"] == 4.5 and got[33]["n"] is None
    kept = drift.values_kept(t).first()
    assert kept["n_records"] == 34 and kept["n_values"] == 60 + 3 + 2 + 2


def test_second_names_in_one_record(spark):
    """The present name counts, in whatever order the keys stand; the other value is kept in rest."""
    rng, rows = random.Random(5), []
    for no, key in ((1, "model_name"), (2, "modelTitle")):
        for i in range(40):
            r = named(rng)
            r[key] = r.pop("model_name")
            rows.append(("f", no, i, json.dumps(r)))
    rows += [("f", 2, 90, '{"model_name": "old", "modelTitle": "new", "size": 1}'), ("f", 2, 91, '{"modelTitle": "new", "model_name": "old", "size": 1}'), ("f", 2, 92, '{"model_name": "late", "size": 1}')]
    got = {(r["file_no"], r["rec_no"]): (r["model_name"], r["rest"]) for r in table_of(spark, rows).collect()}
    assert got[2, 90] == got[2, 91] == ("new", '{"model_name": "old"}') and got[2, 92] == ("late", None)


def test_empty_table_of_records(spark):
    t = drift.consistent_table(feed(spark).limit(0))
    assert t.columns == ["feed", "file_no", "rec_no", "rest"] and t.count() == 0


def test_flooding_prefers_the_neighbour(spark):
    """Two fields of like values are told apart by name and nesting."""
    counts = lambda n: {"n": n, "t:string": n, "w:1": n, "s:1": n, "l:3": n, "c:9": 8 * n}
    old = {p: drift.Field(p, counts(10), 10) for p in ("a.start", "a.stop", "x.kept")}
    new = {p: drift.Field(p, counts(10), 10) for p in ("a.start_time", "a.stop_time", "x.kept")}
    assert drift.correspondences(old, new) == {"a.start": "a.start_time", "a.stop": "a.stop_time"}


def test_name_similarity():
    assert drift.name_similarity("model_name", "modelName") > 0.9
    assert drift.name_similarity("total_score", "weight") < 0.1


def looks(value):
    return dict(drift.looks([value]))


def test_whole_values_are_profiled():
    """Values that agree at the start and differ later have other histograms."""
    start = [f"https://one.example/{k}" for k in range(8)]
    assert looks(start + ["note"]) != looks(start)
    assert sum(n for k, n in looks("word " * 50).items() if k.startswith("w:")) == 50
    assert looks("x" * 100 + "!")["c:!"] == 1
    long = "a-" * 30
    assert {k for k in looks(long + "b/9") if k.startswith("s:")} != {k for k in looks(long + "b.9") if k.startswith("s:")}


def test_rename_of_values_alike_at_the_start():
    """Removed and added fields are told apart by what follows a long common start."""
    start = "https://archive.example/" + "path/" * 45
    a, b = ({"n": 1, "t:string": 1, **looks(start + end)} for end in ("?" + "=7&" * 60, "#" + "Zq_" * 60))
    old = {"first": drift.Field("first", a, 1), "second": drift.Field("second", b, 1)}
    new = {"some": drift.Field("some", a, 1), "other": drift.Field("other", b, 1)}
    assert drift.correspondences(old, new) == {"first": "some", "second": "other"}
