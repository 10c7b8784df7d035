"""Folds of the event log against a line-by-line loop, batch against stream, and hot keys."""

import random

from pyspark.sql import functions as F

from provlake.operators import events
from provlake.streaming import folds

LOG = "seq bigint, ts string, source string, target string, url string, kind string, outcome string, sha256 string, dir string, absence string, confirmed_by array<string>, witness struct<saw:boolean,reason:string>, observations array<struct<status_code:int,headers:string,error:string,ts:string>>, status_code int, vantage string"


def make(n, seed, keys=6):
    rng, rows = random.Random(seed), []
    for i in range(1, n + 1):
        key = 0 if rng.random() < 0.34 else rng.randrange(keys)  # one target holds a third
        outcome = rng.choice(["error"] * 6 + ["new", "unchanged", "live-attested", "UNCHANGED", "host-unreachable"])
        absence = rng.choice([None, None, "confirmed", "persistent", "unconfirmed", "contradicted"]) if outcome == "error" else None
        by = [rng.choice(["witness", "operator", None])] if absence == "confirmed" else None
        day = f"2026-01-{rng.randrange(1, 28):02d}T00:00:00Z" if rng.random() < 0.95 else rng.choice([None, "n/a"])
        rows.append((i, day, f"s{key % 3}" if rng.random() < 0.98 else None, f"t{key}", f"https://h{key}.example/x", rng.choice(["provider-live", "watch-page"]), outcome, None, None, absence, by, None, None, rng.choice([None, 404, 503, 200]), "eu"))
    return rows


def loop_streaks(rows):
    last, live = {}, {}
    for seq, ts, s, t, url, kind, outcome, _, _, absence, *_ in rows:
        outcome = outcome.lower()
        if outcome == "error" and absence not in (None, "confirmed", "persistent"):
            continue
        if outcome == "error":
            e = last.setdefault((s, t), [0, url, ""])
            e[0] += 1
            e[1] = url or e[1]
            e[2] = ts if ts and ts.startswith("20") else e[2]
        elif outcome in (*events.SUCCESS, "live-attested"):
            last.pop((s, t), None)
            if kind == "provider-live":
                live[s] = max(live.get(s, ""), ts if ts and ts.startswith("20") else "")
    return {(s, t): v[0] for (s, t), v in last.items() if v[0] >= 2 and (not live.get(s) or live[s] < v[2])}


def loop_absences(rows):
    state = {}
    for seq, ts, s, t, _, _, outcome, _, _, absence, by, *_ in rows:
        outcome = outcome.lower()
        if outcome in events.SUCCESS:
            state.pop((s, t), None)
        elif ts and ts[:2] == "20" and (outcome == "live-attested" or (outcome == "error" and absence)):
            e = state.setdefault((s, t), {"a": set(), "c": set(), "x": set(), "by": set()})
            if outcome == "live-attested" or absence == "contradicted":
                e["x"].add(ts[:10])
                for k in ("a", "c", "by"):
                    e[k].clear()
            else:
                e["a"].add(ts[:10])
                if absence == "confirmed":
                    e["c"].add(ts[:10])
                    e["by"].update(x for x in by if x)
    return state


def test_folds_equal_the_loop(spark):
    for seed in range(3):
        rows = make(400, seed)
        df = spark.createDataFrame(rows + rows[:50], LOG)
        assert {(r["source"], r["target"]): r["streak"] for r in events.error_streaks(df).collect()} == loop_streaks(rows)
        want = loop_absences(rows)
        got = {(r["source"], r["target"]): r for r in events.absence_streaks(df).collect()}
        assert set(got) == set(want)
        for k, w in want.items():
            assert {str(d) for d in got[k]["absent_on"]} == w["a"] and {str(d) for d in got[k]["contradicted_on"]} == w["x"] and {x for x in got[k]["confirmed_by"] if x} == w["by"]


def test_empty_log(spark):
    df = spark.createDataFrame([], LOG)
    for f in (events.error_streaks, events.absence_streaks, events.gone_targets, events.two_strike, events.pruned_map, events.attestations, events.superseded_claims):
        assert f(df).count() == 0


def test_stream_equals_batch(spark, tmp_path):
    rows = make(600, 11)
    df = spark.createDataFrame(rows, LOG).withColumn("ingested_at", F.current_timestamp())
    df.repartition(5).write.parquet(str(tmp_path / "check_log.parquet"))
    got = {(r["source"], r["target"]): r["streak"] for r in folds.run_streaks(spark, str(tmp_path)).collect()}
    failed = events.after_last(events.lines(df), F.col("outcome").isin(*events.SUCCESS, "live-attested")).where("outcome = 'error' and (absence is null or absence in ('confirmed', 'persistent')) and source is not null")
    want = {(r["source"], r["target"]): r["count"] for r in failed.groupBy("source", "target").count().where("count >= 2").collect()}
    assert got == want
    days = {r["day"]: r["n"] for r in folds.run_daily_counts(spark, str(tmp_path)).collect()}
    assert sum(days.values()) == sum(1 for r in rows if r[1] and r[1].startswith("20"))


def test_absence_classes(spark):
    import datetime as dt

    d = lambda *n: [dt.date(2026, 1, k) for k in n]
    rows = [  # status, rechecked, saw, absent_on, contradicted_on, confirmed, by -> absence, reddens, known
        (404, 404, None, [], [], False, [], "unconfirmed", False, False), (404, 404, None, d(9), [], False, [], "persistent", True, False), (404, 404, None, d(10), [], False, [], "unconfirmed", False, False),
        (404, None, None, d(6), [], False, [], "unconfirmed", False, False), (410, 404, None, d(7), [], False, [], "persistent", True, False), (404, 404, None, d(8, 9), d(7), False, [], "unconfirmed", False, False),
        (404, 404, None, d(9), d(3), False, [], "persistent", True, False), (404, 404, None, d(9), [], True, ["operator"], "confirmed", False, True), (404, 404, False, [], [], False, [], "confirmed", True, False),
        (404, 404, False, [], [], True, ["operator"], "confirmed", False, True), (404, 404, True, [], [], False, [], "contradicted", False, False), (404, 404, True, [], d(8, 9), False, [], "contradicted", True, False),
        (404, 404, True, [], d(2, 3), False, [], "contradicted", False, False), (500, None, None, [], [], False, [], "error", True, False), (410, 200, None, [], [], False, [], "recheck-recovered", False, False), (404, 503, None, [], [], False, [], "error", True, False),
    ]
    df = spark.createDataFrame([(k, "s", "t", d(10)[0], *r) for k, r in enumerate(rows)], "seq int, source string, target string, day date, status int, rechecked int, saw boolean, absent_on array<date>, contradicted_on array<date>, confirmed boolean, confirmed_by array<string>, absence string, r boolean, k boolean")
    got = {r["seq"]: r for r in events.classify_absence(df.drop("absence", "r", "k")).collect()}
    assert [(got[k]["absence"], got[k]["reddens"], got[k]["known"]) for k in range(len(rows))] == [r[-3:] for r in rows]
    assert got[9]["by"] == ["operator", "witness"] and got[7]["by"] == ["operator"] and got[8]["by"] == ["witness"]


def test_absence_is_judged_by_what_came_before(spark):
    """The state before every line equals that of a loop which stops there; later confirmations decide nothing."""
    rows = make(300, 5)
    got = {r["seq"]: r for r in events.absence_before(spark.createDataFrame(rows + rows[:20], LOG).repartition(7)).collect()}
    assert set(got) == {r[0] for r in rows if r[6] == "error"}
    for k, row in enumerate(rows):
        if row[0] in got:
            w = loop_absences(rows[:k]).get((row[2], row[3]), {"a": set(), "c": set(), "x": set(), "by": set()})
            g = got[row[0]]
            assert ({str(x) for x in g["absent_on"]}, {str(x) for x in g["contradicted_on"]}, set(g["confirmed_by"]), g["confirmed"]) == (w["a"], w["x"], w["by"], bool(w["c"])), row


def test_running_folds(spark):
    """Folds over the rows before, also over a key that fills several partitions and over null keys."""
    from provlake.operators.ordered import running

    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 4 + ["a", "b", None]), k, rng.randrange(50)) for k in range(500)]
    df = spark.createDataFrame(rows, "k string, seq int, v int").repartition(5)
    got = {r["seq"]: (r["most"], r["total"]) for r in running(df, ["k"], ["seq"], {"most": (F.when(F.col("v") % 2 == 0, F.col("v")), "max"), "total": (F.col("v"), "sum")}).collect()}
    for k, seq, _ in rows:
        before = [v for key, s, v in rows if key == k and s < seq]
        assert got[seq] == (max((v for v in before if v % 2 == 0), default=None), sum(before) if before else None)
    assert running(df.limit(0), ["k"], ["seq"], {"m": (F.col("v"), "max")}).count() == 0


def test_breaker_and_budgets(spark):
    df = spark.createDataFrame([(k, "r", "h", f, 90) for k, f in enumerate([True, True, False, True, True, True, True])], "seq int, run string, host string, failed boolean, cost int")
    assert [r["tripped_at"] for r in events.host_breaker(df, 3).collect()] == [5]
    assert [r["allowed"] for r in events.within_budget(df, "cost", 200).orderBy("seq").collect()] == [True] * 3 + [False] * 4
    w = spark.createDataFrame([(k, "r", s) for k, s in enumerate([200, 200, 429, 200])], "seq int, run string, status_code int")
    assert [r["allowed"] for r in events.witness_budget(w).orderBy("seq").collect()] == [True, True, True, False]
