"""State machines of the event log, as folds of sets (ST-01 to ST-16).

Order is the line number `seq`, never the time.  A run that a success resets is
found without a window: the last resetting line of each key is an aggregate
that combines before the shuffle, and only later lines count.  So a key with a
third of all lines is joined, not sorted in one task.  Lines delivered twice
count once; lines without source or target are keys of their own (nulls are
equal).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.functions.times import day_of
from provlake.operators.ordered import running
from provlake.operators.references import utc_timestamp

KEY = ["source", "target"]
# Outcomes that show a target alive.
SUCCESS = ("new", "unchanged", "unchanged-content", "recheck-recovered")
TRANSPORT = (429, 500, 502, 503, 504)
# Fixed value: URLs whose signature expires, so that asking again is of no use.
SIGNED = r"X-Amz-Signature=|[?&]oh=|Key-Pair-Id=|[?&]Policy=|trust-zip\?r="
# Days of absence that are persistent, days within which one counts, contradicted days that alert.
PERSISTENT_AFTER_DAYS, ABSENCE_WINDOW_DAYS, CONTRADICTED_ALERT_DAYS = 2, 3, 3


def lines(log: DataFrame) -> DataFrame:
    """Each line once, outcomes in lower case, with the calendar day of its time."""
    once = log.dropDuplicates(["seq"])  # copies are equal in all columns
    return once.withColumn("outcome", F.lower("outcome")).withColumn("day", day_of(F.col("ts")))


def after_last(rows: DataFrame, resets: Column, keys: list[str] = KEY) -> DataFrame:
    """The rows of each key after its last resetting row."""
    last = rows.where(resets).groupBy(*keys).agg(F.max("seq").alias("__reset"))
    on = [F.col(f"r.{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys]
    both = rows.alias("r").join(last.alias("l"), on, "left")
    return both.where("l.__reset is null or r.seq > l.__reset").select("r.*")


def error_streaks(log: DataFrame, least: int = 2) -> DataFrame:
    """ST-02, W-06: targets that fail since their last success, and whose source had none after them.

    Absences that are unconfirmed or contradicted neither count nor reset.  Times
    are compared as instants; a target none of whose failures has a readable
    time is kept only if its source never succeeded at a readable one.
    """
    e = lines(log).withColumn("at", utc_timestamp(F.col("ts")))
    alive = e["outcome"].isin(*SUCCESS, "live-attested")
    failed = after_last(e, F.col("outcome").isin(*SUCCESS, "live-attested")).where("outcome = 'error' and (absence is null or absence in ('confirmed', 'persistent'))")
    streak = failed.groupBy(*KEY).agg(F.count("*").alias("streak"), F.max_by("url", F.when(F.col("url").isNotNull(), F.col("seq"))).alias("url"), F.max_by("at", F.when(F.col("at").isNotNull(), F.col("seq"))).alias("last_at"))
    live = e.where(alive & (F.col("kind") == "provider-live")).groupBy("source").agg(F.max("at").alias("live_at"))
    return streak.where(F.col("streak") >= least).join(live, "source", "left").where("live_at is null or live_at < last_at").select("source", "target", "streak", "url", "last_at")


def absences(log: DataFrame) -> DataFrame:
    """Lines since each target's last success that say something about an absence."""
    e = after_last(lines(log), F.col("outcome").isin(*SUCCESS)).where("day is not null and (outcome = 'live-attested' or (outcome = 'error' and absence is not null))")
    return e.withColumn("against", (F.col("outcome") == "live-attested") | (F.col("absence") == "contradicted"))


def absence_streaks(log: DataFrame) -> DataFrame:
    """ST-01: days a target was absent, confirmed absent, or contradicted, since its last success.

    A contradiction clears the days of absence before it.
    """
    a = absences(log)
    clear = a.where("against").groupBy(*KEY).agg(F.max("seq").alias("c"), F.array_sort(F.collect_set("day")).alias("contradicted_on"))
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"c.{k}")) for k in KEY]
    later = a.alias("a").join(clear.select(*KEY, "c").alias("c"), on, "left").where("not a.against and (c.c is null or a.seq > c.c)").select("a.*")
    named = later.groupBy(*KEY).agg(
        F.array_sort(F.collect_set("day")).alias("absent_on"), F.array_sort(F.collect_set(F.when(F.col("absence") == "confirmed", F.col("day")))).alias("confirmed_on"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("absence") == "confirmed", F.col("confirmed_by")))))).alias("confirmed_by"),
    )
    keys = a.select(*KEY).distinct()
    null_on = lambda x, y: [F.col(f"{x}.{k}").eqNullSafe(F.col(f"{y}.{k}")) for k in KEY]
    whole = keys.alias("k").join(named.alias("n"), null_on("k", "n"), "left").join(clear.alias("c"), null_on("k", "c"), "left")
    none = F.array().cast("array<date>")
    return whole.select("k.source", "k.target", *[F.coalesce(c, none).alias(c) for c in ("absent_on", "confirmed_on", "contradicted_on")], F.coalesce("confirmed_by", F.array().cast("array<string>")).alias("confirmed_by"))


def absence_before(log: DataFrame) -> DataFrame:
    """Every failing line with the state of its target's absence just before it, in line order.

    absent_on and contradicted_on hold days, confirmed whether another vantage
    had confirmed the absence and confirmed_by which; all since the last
    success, and the former also since the last contradiction.  Days are counted
    once before they meet, so an array is no longer than the calendar.
    """
    e = lines(log).select("seq", *KEY, "outcome", "absence", "confirmed_by", "status_code", "observations", "witness", "day")
    seen = F.col("day").isNotNull() & ((F.col("outcome") == "live-attested") | ((F.col("outcome") == "error") & F.coalesce(F.col("absence") == "contradicted", F.lit(False))))
    gone = F.col("day").isNotNull() & (F.col("outcome") == "error") & F.coalesce(F.col("absence") != "contradicted", F.lit(False))
    marked = e.withColumn("seen", seen).withColumn("gone", gone)
    r = running(marked, KEY, ["seq"], {"ok_at": (F.when(F.col("outcome").isin(*SUCCESS), F.col("seq")), "max"), "seen_at": (F.when(F.col("seen"), F.col("seq")), "max")})
    r = r.withColumn("since_ok", F.coalesce("ok_at", F.lit(-1))).withColumn("since", F.greatest("since_ok", F.coalesce("seen_at", F.lit(-1))))

    def by_day(rows: DataFrame, since: str, name: str) -> DataFrame:
        days = rows.groupBy(*KEY, since, "day").agg(F.min("seq").alias("at"))
        return days.groupBy(*KEY, since).agg(F.collect_list(F.struct("day", "at")).alias(name))

    claimed = r.where(F.col("gone") & (F.col("absence") == "confirmed"))
    named = claimed.select(*KEY, "since", "seq", F.explode_outer("confirmed_by").alias("v")).groupBy(*KEY, "since", "v").agg(F.min("seq").alias("at"))
    sides = [(by_day(r.where("gone"), "since", "gone_days"), "since"), (by_day(r.where("seen"), "since_ok", "seen_days"), "since_ok"), (named.groupBy(*KEY, "since").agg(F.collect_list(F.struct("v", "at")).alias("vantages")), "since")]
    out = r.where("outcome = 'error'")
    for side, since in sides:
        on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in KEY] + [F.col(f"l.{since}") == F.col(f"r.{since}")]
        out = out.alias("l").join(side.alias("r"), on, "left").select("l.*", f"r.{side.columns[-1]}")
    past = lambda c, what: F.transform(F.filter(c, lambda x: x["at"] < F.col("seq")), lambda x: x[what])
    none = F.array().cast("array<date>")
    vantages = F.coalesce(past("vantages", "v"), F.array().cast("array<string>"))
    return out.select("seq", *KEY, "status_code", "observations", "witness", "day", F.coalesce(past("gone_days", "day"), none).alias("absent_on"), F.coalesce(past("seen_days", "day"), none).alias("contradicted_on"), (F.size(vantages) > 0).alias("confirmed"), F.array_compact(vantages).alias("confirmed_by"))


def classify_absence(claims: DataFrame) -> DataFrame:
    """ST-04: what each claim amounts to, given the state before it: (seq, source, target, absence, by, reddens, known).

    claims: seq, source, target, status, rechecked, saw, day and the columns of
    `absence_before`.  saw null: no witness.  reddens tells whether the run must
    show it, known that it was published before.  A claim without a readable day
    is a plain error.
    """
    today = F.col("day")
    other = lambda days: F.filter(days, lambda d: d != today)
    n_days = lambda days: F.size(other(F.col(days))) + 1
    within = lambda days: F.coalesce(F.date_diff(today, F.array_max(other(F.col(days)))) <= ABSENCE_WINDOW_DAYS, F.lit(False))
    live = F.coalesce(F.date_diff(today, F.array_max("contradicted_on")) <= ABSENCE_WINDOW_DAYS, F.lit(False))
    gone = F.coalesce(F.col("status").isin(404, 410), F.lit(False)) & today.isNotNull()
    absence = (
        F.when(~gone, "error").when(F.col("rechecked") == 200, "recheck-recovered").when(~F.coalesce(F.col("rechecked").isin(404, 410), F.lit(True)), "error")
        .when(F.col("saw"), "contradicted").when(~F.col("saw") | F.col("confirmed"), "confirmed")
        .when((n_days("absent_on") >= PERSISTENT_AFTER_DAYS) & within("absent_on") & ~live, "persistent").otherwise("unconfirmed")
    )
    alert = (n_days("contradicted_on") >= CONTRADICTED_ALERT_DAYS) & within("contradicted_on")
    known = (absence == "confirmed") & F.col("confirmed")
    reddens = absence.isin("error", "persistent") | ((absence == "contradicted") & alert) | ((absence == "confirmed") & ~F.col("confirmed"))
    witness = F.when(~F.col("saw"), F.array(F.lit("witness"))).otherwise(F.array().cast("array<string>"))
    by = F.when(absence == "confirmed", F.array_sort(F.array_union(witness, F.col("confirmed_by")))).otherwise(F.array().cast("array<string>"))
    return claims.select("seq", *KEY, absence.alias("absence"), by.alias("by"), reddens.alias("reddens"), known.alias("known"))


def gone_targets(log: DataFrame) -> DataFrame:
    """ST-03: targets confirmed absent and not seen since: first and last time, who confirmed, in order of first mention."""
    e = after_last(lines(log), F.col("outcome").isin(*SUCCESS, "live-attested") | F.coalesce(F.col("absence") == "contradicted", F.lit(False)))
    claims = e.where("outcome = 'error' and absence = 'confirmed'")
    found = claims.groupBy(*KEY).agg(
        F.min_by("ts", F.when(F.col("ts").isNotNull(), F.col("seq"))).alias("first_ts"), F.max_by("ts", F.when(F.col("ts").isNotNull(), F.col("seq"))).alias("last_ts"),
        F.min_by("url", F.when(F.col("url").isNotNull(), F.col("seq"))).alias("url"), F.min_by("kind", F.when(F.col("kind").isNotNull(), F.col("seq"))).alias("kind"),
    )
    # A-09: vantages in the order of their first line; one row per vantage before they meet
    by = claims.select(*KEY, "seq", F.explode("confirmed_by").alias("v")).where("v is not null").groupBy(*KEY, "v").agg(F.min("seq").alias("at"))
    named = by.groupBy(*KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("by"))
    on = [F.col(f"f.{k}").eqNullSafe(F.col(f"n.{k}")) for k in KEY]
    return found.alias("f").join(named.alias("n"), on, "left").select("f.*", F.coalesce("n.by", F.array().cast("array<string>")).alias("by"))


def last_checked(log: DataFrame, active: DataFrame) -> DataFrame:
    """A-06: per source the oldest of its active targets' last checks, as instants, and how many were never checked at a readable time."""
    seen = lines(log).where("outcome not in ('host-unreachable', 'sweep-budget-exhausted')").groupBy(*KEY).agg(F.max(utc_timestamp(F.col("ts"))).alias("last_at"))
    both = active.join(seen, KEY, "left")
    return both.groupBy("source").agg(F.min("last_at").alias("oldest_check"), F.count_if(F.col("last_at").isNull()).alias("never_checked"), F.count("*").alias("n_targets"))


def pruned_map(log: DataFrame) -> DataFrame:
    """A-07: bytes hash -> the last line that pruned it; the hash comes from the line that stored the directory where it is missing."""
    e = lines(log)
    stored = e.where("outcome = 'new' and dir is not null and sha256 is not null").groupBy("dir").agg(F.max_by("sha256", "seq").alias("stored_sha"))
    p = e.where("outcome like 'pruned%'").join(stored, "dir", "left").withColumn("sha", F.coalesce("sha256", "stored_sha")).where("sha is not null")
    return p.groupBy("sha").agg(F.max("seq").alias("seq"), F.max_by("outcome", "seq").alias("outcome"))


def is_transport_failure(error: Column, status: Column) -> Column:
    """P-07: the attempt never reached a verdict: no answer, or one that only puts off."""
    return (status.isNull() & error.isNotNull()) | F.coalesce(status.isin(*TRANSPORT), F.lit(False))


def host_breaker(attempts: DataFrame, least: int = 3) -> DataFrame:
    """W-07, ST-07: per run and host the first attempt after `least` transport failures in a row.

    Islands by a running count of answers; within them failures are counted on.
    """
    rows = running(attempts.select("run", "host", "seq", "failed"), ["run", "host"], ["seq"], {"answers": (F.when(F.col("failed"), 0).otherwise(1), "sum")})
    failed = rows.where("failed").select("run", "host", "seq", F.coalesce("answers", F.lit(0)).alias("island"))
    row = running(failed, ["run", "host", "island"], ["seq"], {"k": (F.lit(1), "sum")})
    return row.where(F.coalesce("k", F.lit(0)) + 1 == least).groupBy("run", "host").agg(F.min("seq").alias("tripped_at"))


def breaker_loop(attempts: DataFrame, least: int = 3) -> DataFrame:
    """ST-07 as a machine: (run, host, seq, made): once tripped, a host's further attempts of the run are not made.

    What is skipped cannot answer, so a tripped host stays so for its run: the
    attempts made are those up to the tripping one.
    """
    t = host_breaker(attempts, least)
    both = attempts.join(t, ["run", "host"], "left")
    return both.select("run", "host", "seq", F.coalesce(F.col("seq") <= F.col("tripped_at"), F.lit(True)).alias("made"))


def within_budget(attempts: DataFrame, cost: str, budget: float) -> DataFrame:
    """ST-08: attempts of a run that begin within its budget, by a running sum in order.

    As what is skipped costs nothing and the sum only grows, the attempts made
    are the same whether those skipped count on or not.
    """
    rows = running(attempts, ["run"], ["seq"], {"spent": (F.col(cost), "sum")})
    return rows.withColumn("spent", F.coalesce("spent", F.lit(0))).withColumn("allowed", F.col("spent") <= budget)


def witness_budget(attempts: DataFrame, most: int = 5) -> DataFrame:
    """ST-09: witness calls of a run until the most are made or one is refused with 429."""
    rows = running(attempts, ["run"], ["seq"], {"n": (F.lit(1), "sum"), "refused": (F.when(F.col("status_code") == 429, 1).otherwise(0), "max")})
    return rows.withColumn("allowed", (F.coalesce("n", F.lit(0)) < most) & (F.coalesce("refused", F.lit(0)) == 0))


def two_strike(log: DataFrame) -> DataFrame:
    """ST-10: targets that were found gone on two dates since they last answered: suspect on the first, demoted on the second.

    Only 404 and 410 are strikes; timeouts, throttling and other failures say nothing.
    """
    failed = after_last(lines(log), F.col("outcome").isin(*SUCCESS)).where("outcome = 'error' and status_code in (404, 410) and day is not null")
    return failed.groupBy(*KEY).agg(F.min("day").alias("suspect_since"), F.countDistinct("day").alias("n_days")).withColumn("demoted", F.col("n_days") >= 2)


def retry_budget(attempts: DataFrame, most_answers: int = 5, most_days: int = 30) -> DataFrame:
    """ST-11: whether to give a target up: enough answered attempts that nothing superseded, attempts on enough dates, or a signed URL."""
    answered = F.col("status_code").isNotNull() & ~F.col("status_code").isin(*TRANSPORT) & ~F.col("superseded")
    g = attempts.groupBy(*KEY).agg(F.count_if(answered).alias("answered"), F.countDistinct("day").alias("days"), F.bool_or(F.col("url").rlike(SIGNED)).alias("signed"))
    return g.withColumn("gave_up", (F.col("answered") >= most_answers) | (F.col("days") >= most_days) | F.col("signed"))


def witness_verdict(observations: DataFrame, slack_s: int = 120) -> DataFrame:
    """ST-12: the first decisive observation of each line: live, absent, or inconclusive without one.

    An observation before the request (less the slack) decides nothing.
    """
    good = F.col("seen_at").isNull() | F.col("asked_at").isNull() | (F.unix_timestamp("seen_at") >= F.unix_timestamp("asked_at") - slack_s)
    said = F.when(good & (F.col("status_code") == 200), "live").when(good & F.col("status_code").isin(404, 410), "absent")
    return observations.withColumn("said", said).groupBy("seq").agg(F.coalesce(F.min_by("said", F.when(F.col("said").isNotNull(), F.col("pos"))), F.lit("inconclusive")).alias("verdict"))


def proof_state(manifest: DataFrame) -> DataFrame:
    """ST-13: missing, failed, pending or anchored, by what the proof says."""
    o = F.col("ots")
    state = F.when(o.isNull(), "missing").when(~F.coalesce(o["ok"], F.lit(False)), "restamp").when(F.size(F.coalesce(o["calendars"], F.array().cast("array<string>"))) > 0, "pending").otherwise("anchored")
    return manifest.select("capture_dir", state.alias("state"))


def validators(urls: DataFrame, weekday: int) -> DataFrame:
    """ST-14: what a conditional request may send; null on the URL's weekly day, without a good prior answer, or without any validator."""
    ok = (F.col("bucket") != weekday) & (F.col("status_code") == 200) & (F.col("etag").isNotNull() | F.col("last_modified").isNotNull())
    return urls.select("capture_dir", F.when(F.coalesce(ok, F.lit(False)), F.coalesce("etag", "last_modified")).alias("validator"))


def attestations(log: DataFrame) -> DataFrame:
    """ST-15: each live attestation with the last absence before it that it supersedes, by a running maximum in line order."""
    e = lines(log).where("outcome = 'live-attested' or (outcome = 'error' and absence is not null)").select("seq", *KEY, "outcome")
    r = running(e, KEY, ["seq"], {"supersedes": (F.when(F.col("outcome") == "error", F.col("seq")), "max")})
    return r.where("outcome = 'live-attested'").select("seq", *KEY, "supersedes")


def superseded_claims(log: DataFrame) -> DataFrame:
    """ST-06: errors of a day after which the same URL answered on that day."""
    e = lines(log).where("url is not null and day is not null")
    alive = e.where(F.col("outcome").isin(*SUCCESS)).groupBy("url", "day").agg(F.max("seq").alias("alive_at"))
    return e.where("outcome = 'error'").join(alive, ["url", "day"]).where("alive_at > seq").select("seq", "url", "alive_at")


def decide(queue: DataFrame, commands: DataFrame, trusted: tuple[str, ...]) -> DataFrame:
    """ST-16: candidates with the first command of a trusted person; the others stay pending."""
    first = commands.where(F.col("association").isin(*trusted) & F.col("action").isNotNull()).groupBy("key").agg(F.min_by("action", "seq").alias("action"))
    return queue.join(first, "key", "left").select("key", F.when(F.col("action") == "approve", "approved").when(F.col("action") == "reject", "rejected").otherwise("pending").alias("state"))
