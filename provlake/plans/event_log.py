"""Queries over the event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import hashing, urls
from provlake.operators import events, references, versions
from provlake.plans.book import Book
from provlake.plans.ledger import M
from provlake.plans.scalars import TARGETS

book = Book()

_L = "(select distinct on (seq) * replace (lower(outcome) as outcome), try_cast(substr(ts, 1, 10) as date) as day from check_log)"
_OK = "('new', 'unchanged', 'unchanged-content', 'recheck-recovered')"
_OK5 = "('new', 'unchanged', 'unchanged-content', 'recheck-recovered', 'live-attested')"


def _after(resets: str) -> str:
    """Lines after the last resetting one of their target."""
    return f"l as (select * from {_L}), r as (select source, target, max(seq) as reset from l where {resets} group by 1, 2), a as (select l.* from l left join r on l.source is not distinct from r.source and l.target is not distinct from r.target where r.reset is null or l.seq > r.reset)"


#: A time in any spelling as an instant, and an instant as text.
_AT = r"case when regexp_matches(trim(ts), '^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}') then try_cast(case when regexp_matches(trim(ts), '([zZ]|[+-]\d{2}:?\d{2})$') then trim(ts) else trim(ts) || 'Z' end as timestamptz) end"
_SAID = "strftime(timezone('UTC', {0}), '%Y-%m-%d %H:%M:%S')"


def utc_text(c):
    return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")


def planted(log):
    """The log and two targets that fail after their last success, told in other spellings and out of the order of texts."""
    def line(seq, ts, target, outcome):
        return log.sparkSession.createDataFrame([(seq, ts, "planted/one", target, f"https://p.example/{target}", "provider-live", outcome)], "seq bigint, ts string, source string, target string, url string, kind string, outcome string")

    lines = [line(-9, "2026-03-01 23:30:00+02:00", "a", "new"), line(-8, "2026-03-01T22:00:00Z", "b", "error"), line(-7, "2026-03-01 21:45", "b", "ERROR"), line(-6, "n/a", "b", "error"), line(-5, "2026-03-01T20:00:00Z", "c", "error"), line(-4, "2026-03-01T21:00:00Z", "c", "error")]
    for x in lines:
        log = log.unionByName(x, allowMissingColumns=True)
    return log


_PLANTED = f"(select seq, ts, source, target, url, kind, outcome, absence from {_L} union all select *, null from (values (-9, '2026-03-01 23:30:00+02:00', 'planted/one', 'a', 'https://p.example/a', 'provider-live', 'new'), (-8, '2026-03-01T22:00:00Z', 'planted/one', 'b', 'https://p.example/b', 'provider-live', 'error'), (-7, '2026-03-01 21:45', 'planted/one', 'b', 'https://p.example/b', 'provider-live', 'error'), (-6, 'n/a', 'planted/one', 'b', 'https://p.example/b', 'provider-live', 'error'), (-5, '2026-03-01T20:00:00Z', 'planted/one', 'c', 'https://p.example/c', 'provider-live', 'error'), (-4, '2026-03-01T21:00:00Z', 'planted/one', 'c', 'https://p.example/c', 'provider-live', 'error')))"


@book.add(
    f"""with l as (select *, {_AT} as moment from {_PLANTED}), r as (select source, target, max(seq) as reset from l where outcome in {_OK5} group by 1, 2), a as (select l.* from l left join r on l.source is not distinct from r.source and l.target is not distinct from r.target where r.reset is null or l.seq > r.reset),
    s as (select source, target, count(*) as streak, arg_max(url, seq) filter (url is not null) as url, arg_max(moment, seq) filter (moment is not null) as last_at from a where outcome = 'error' and (absence is null or absence in ('confirmed', 'persistent')) group by 1, 2),
    v as (select source, max(moment) as live_at from l where outcome in {_OK5} and kind = 'provider-live' group by 1) select s.source, target, streak, url, {_SAID.format('last_at')} as last_at from s left join v on v.source = s.source where streak >= 2 and (live_at is null or live_at < last_at)"""
)
def error_streaks(t):
    """ST-02, W-06, with planted lines; of their targets b stays, c does not."""
    return events.error_streaks(planted(t("check_log"))).withColumn("last_at", utc_text(F.col("last_at")))


_ABS = f"""with {_after(f'outcome in {_OK}')}, b as (select *, outcome = 'live-attested' or coalesce(absence = 'contradicted', false) as against from a where day is not null and (outcome = 'live-attested' or (outcome = 'error' and absence is not null))),
  c as (select source, target, max(seq) as c, array_to_string(list_sort(list(distinct day)), ',') as contradicted_on from b where against group by 1, 2),
  d as (select b.* from b left join c on b.source is not distinct from c.source and b.target is not distinct from c.target where not against and (c.c is null or b.seq > c.c)),
  n as (select source, target, array_to_string(list_sort(list(distinct day)), ',') as absent_on, coalesce(array_to_string(list_sort(list(distinct day) filter (absence = 'confirmed')), ','), '') as confirmed_on,
    coalesce(array_to_string(list_sort(list_distinct(flatten(list(confirmed_by) filter (absence = 'confirmed' and confirmed_by is not null)))), ','), '') as confirmed_by from d group by 1, 2),
  k as (select distinct source, target from b)
  select k.source, k.target, coalesce(absent_on, '') as absent_on, coalesce(confirmed_on, '') as confirmed_on, coalesce(contradicted_on, '') as contradicted_on, coalesce(confirmed_by, '') as confirmed_by from k left join n on k.source is not distinct from n.source and k.target is not distinct from n.target left join c on k.source is not distinct from c.source and k.target is not distinct from c.target"""


@book.add(_ABS)
def absence_streaks(t):
    s = events.absence_streaks(t("check_log"))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return s.select("source", "target", *map(text, ("absent_on", "confirmed_on", "contradicted_on", "confirmed_by")))


_BEFORE = "over (partition by source, target order by seq rows between unbounded preceding and 1 preceding)"


@book.add(
    f"""with l as (select *, day is not null and (outcome = 'live-attested' or (outcome = 'error' and coalesce(absence = 'contradicted', false))) as seen, day is not null and outcome = 'error' and coalesce(absence <> 'contradicted', false) as gone from {_L}),
    r as (select *, coalesce(max(case when outcome in {_OK} then seq end) {_BEFORE}, -1) as ok, greatest(coalesce(max(case when outcome in {_OK} then seq end) {_BEFORE}, -1), coalesce(max(case when seen then seq end) {_BEFORE}, -1)) as since from l),
    c as (select seq, source, target, ok, since, day, status_code as status, observations[1].status_code as rechecked, witness.saw as saw from r where outcome = 'error'),
    g as (select c.seq, count(distinct r.day) filter (r.day <> c.day) + 1 as n, max(r.day) filter (r.day <> c.day) as latest, coalesce(bool_or(r.absence = 'confirmed'), false) as confirmed, list(r.confirmed_by) filter (r.absence = 'confirmed' and r.confirmed_by is not null) as named from c left join r on r.source is not distinct from c.source and r.target is not distinct from c.target and r.gone and r.since = c.since and r.seq < c.seq group by 1),
    k as (select c.seq, count(distinct r.day) filter (r.day <> c.day) + 1 as n, max(r.day) filter (r.day <> c.day) as latest, max(r.day) as newest from c left join r on r.source is not distinct from c.source and r.target is not distinct from c.target and r.seen and r.ok = c.ok and r.seq < c.seq group by 1),
    x as (select c.*, g.confirmed, coalesce(list_distinct(flatten(g.named)), []) as named, k.n >= 3 and coalesce(c.day - k.latest <= 3, false) as alert,
      case when not coalesce(status in (404, 410), false) or day is null then 'error' when rechecked = 200 then 'recheck-recovered' when not coalesce(rechecked in (404, 410), true) then 'error' when saw then 'contradicted' when not saw or g.confirmed then 'confirmed'
        when g.n >= 2 and coalesce(c.day - g.latest <= 3, false) and not coalesce(c.day - k.newest <= 3, false) then 'persistent' else 'unconfirmed' end as absence from c join g using (seq) join k using (seq))
    select seq, source, target, absence, case when absence = 'confirmed' then array_to_string(list_sort(list_distinct(list_concat([x for x in named if x is not null], case when saw = false then ['witness'] else [] end))), ',') else '' end as by_,
      absence in ('error', 'persistent') or (absence = 'contradicted' and alert) or (absence = 'confirmed' and not confirmed) as reddens, absence = 'confirmed' and confirmed as known from x"""
)
def absence_classify(t):
    """ST-04: each failing line, judged by what the log said of its target before it."""
    claims = events.absence_before(t("check_log")).select("*", F.col("status_code").alias("status"), F.get("observations", F.lit(0))["status_code"].alias("rechecked"), F.col("witness.saw").alias("saw"))
    return events.classify_absence(claims).withColumn("by_", F.array_join("by", ",")).drop("by")


@book.add(
    f"""with {_after(f"outcome in {_OK5} or coalesce(absence = 'contradicted', false)")}, x as (select * from a where outcome = 'error' and absence = 'confirmed'),
    f as (select source, target, arg_min(ts, seq) filter (ts is not null) as first_ts, arg_max(ts, seq) filter (ts is not null) as last_ts, arg_min(url, seq) filter (url is not null) as url, arg_min(kind, seq) filter (kind is not null) as kind from x group by 1, 2),
    v as (select source, target, v, min(seq) as pos from (select source, target, seq, unnest(confirmed_by) as v from x) where v is not null group by 1, 2, 3), n as (select source, target, string_agg(v, ',' order by pos, v) as by_ from v group by 1, 2)
    select f.*, coalesce(n.by_, '') as vantages from f left join n on f.source is not distinct from n.source and f.target is not distinct from n.target"""
)
def gone_targets(t):
    return events.gone_targets(t("check_log")).withColumn("vantages", F.array_join("by", ",")).drop("by")


@book.add(
    f"""with l as (select * from {_L}), s as (select source, target, max({_AT}) as last_at from l where outcome not in ('host-unreachable', 'sweep-budget-exhausted') group by 1, 2),
    a as (select distinct source_id as source, kind || '-' || substr(sha256(url), 1, 8) as target from {TARGETS} where retired is null)
    select a.source, {_SAID.format('min(last_at)')} as oldest_check, count(*) filter (last_at is null) as never_checked, count(*) as n_targets from a left join s on s.source = a.source and s.target = a.target group by 1"""
)
def last_checked(t):
    from provlake.plans.scalars import targets

    active = targets(t).where("retired is null").select(F.col("source_id").alias("source"), hashing.target_slug(F.col("kind"), F.col("url")).alias("target")).distinct()
    return events.last_checked(t("check_log"), active).withColumn("oldest_check", utc_text(F.col("oldest_check")))


@book.add(
    f"""with l as (select * from {_L}), n as (select dir, arg_max(sha256, seq) as s from l where outcome = 'new' and dir is not null and sha256 is not null group by 1), p as (select l.seq, l.outcome, coalesce(l.sha256, n.s) as sha from l left join n on n.dir = l.dir where outcome like 'pruned%')
    select sha, max(seq) as seq, arg_max(outcome, seq) as outcome from p where sha is not null group by 1"""
)
def pruned_map(t):
    return events.pruned_map(t("check_log"))


@book.add(f"select seq, (status_code is null and outcome = 'host-unreachable') or coalesce(status_code in (429, 500, 502, 503, 504), false) as transport from {_L}")
def transport_failures(t):
    e = events.lines(t("check_log"))
    return e.select("seq", events.is_transport_failure(F.when(F.col("outcome") == "host-unreachable", "no answer"), F.col("status_code")).alias("transport"))


def attempts(t):
    """Lines of a day's run with host and whether the attempt failed to arrive."""
    e = events.lines(t("check_log")).where("day is not null and url is not null")
    return e.select("seq", "source", "target", "url", "day", "outcome", "status_code", F.col("day").cast("string").alias("run"), urls.host_of(F.col("url")).alias("host"), ((F.col("outcome") == "host-unreachable") | F.coalesce(F.col("status_code").isin(*events.TRANSPORT), F.lit(False))).alias("failed"))


_A = f"(select seq, source, target, day, outcome, status_code, day::varchar as run, lower(regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1)) as host, outcome = 'host-unreachable' or coalesce(status_code in (429, 500, 502, 503, 504), false) as failed from {_L} where day is not null and url is not null)"


@book.add(
    f"""with x as (select *, sum(case when failed then 0 else 1 end) over (partition by run, host order by seq) as island from {_A}), y as (select *, row_number() over (partition by run, host, island order by seq) as k from x where failed)
    select run, host, min(seq) as tripped_at from y where k = 3 group by 1, 2"""
)
def host_breaker(t):
    return events.host_breaker(attempts(t))


@book.add(
    f"""with x as (select *, sum(case when failed then 0 else 1 end) over (partition by run, host order by seq) as island from {_A}), y as (select *, row_number() over (partition by run, host, island order by seq) as k from x where failed), t as (select run, host, min(seq) as tripped_at from y where k = 3 group by 1, 2)
    select seq, coalesce(seq <= tripped_at, true) as made from {_A} a left join t on t.run = a.run and t.host is not distinct from a.host"""
)
def breaker_attempts(t):
    """ST-07: which attempts a sweep with the breaker makes."""
    return events.breaker_loop(attempts(t)).select("seq", "made")


@book.add(
    f"""with x as (select *, sum(case when failed then 0 else 1 end) over (partition by run order by seq) as island from {_A}), y as (select *, row_number() over (partition by run, island order by seq) as k from x where failed)
    select run, min(seq) as stopped_at from y where k = 3 group by 1"""
)
def retry_pass_stop(t):
    """ST-11: where a pass over all hosts stops: at its third transport failure in a row."""
    return events.host_breaker(attempts(t).withColumn("host", F.lit("pass"))).select("run", F.col("tripped_at").alias("stopped_at"))


@book.add(f"select seq, coalesce(sum(case when failed then 90 else 5 end) over (partition by run order by seq rows between unbounded preceding and 1 preceding), 0)::bigint as spent, coalesce(sum(case when failed then 90 else 5 end) over (partition by run order by seq rows between unbounded preceding and 1 preceding), 0) <= 600 as allowed from {_A}")
def sweep_budget(t):
    a = attempts(t).withColumn("cost", F.when(F.col("failed"), 90).otherwise(5))
    return events.within_budget(a, "cost", 600).select("seq", F.col("spent").cast("bigint").alias("spent"), "allowed")


@book.add(f"with x as (select seq, run, status_code, row_number() over (partition by run order by seq) as n, coalesce(max(coalesce(status_code = 429, false)::int) over (partition by run order by seq rows between unbounded preceding and 1 preceding), 0) = 1 as halted from {_A} where outcome = 'error') select seq, n <= 5 and not halted as allowed from x")
def witness_budget(t):
    return events.witness_budget(attempts(t).where("outcome = 'error'").withColumn("status_code", F.coalesce("status_code", F.lit(0)))).select("seq", "allowed")


@book.add(f"with {_after(f'outcome in {_OK}')} select source, target, min(day)::varchar as suspect_since, count(distinct day) as n_days, count(distinct day) >= 2 as demoted from a where outcome = 'error' and status_code in (404, 410) and day is not null group by 1, 2")
def two_strike(t):
    return events.two_strike(t("check_log")).withColumn("suspect_since", F.col("suspect_since").cast("string"))


_SIGNED = events.SIGNED


@book.add(
    f"""with x as (select a.*, l.url, l.url is not null and exists (select 1 from {_L} v where v.url = l.url and v.day = l.day and v.outcome in {_OK} and v.seq > l.seq) as superseded from {_A} a join {_L} l using (seq) where a.outcome = 'error'),
    g as (select source, target, count(*) filter (status_code not in (429, 500, 502, 503, 504) and not superseded) as answered, count(distinct day) as days, bool_or(regexp_matches(url, '{_SIGNED}')) as signed from x group by 1, 2)
    select source, target, answered, days, signed, answered >= 5 or days >= 30 or signed as gave_up from g"""
)
def retry_budget(t):
    """ST-11: targets to give up; an attempt after which its URL answered on that day does not count."""
    log = t("check_log")
    e = attempts(t).where("outcome = 'error'").join(events.superseded_claims(log).select("seq", F.lit(True).alias("superseded")), "seq", "left")
    return events.retry_budget(e.withColumn("superseded", F.coalesce("superseded", F.lit(False))))


@book.add(f"select source, target, seq from {_A} where failed order by (status_code is null) desc, source, target, seq limit 25")
def retry_queue_topk(t):
    """O-01: the twenty-five first in line, those without an answer before the others."""
    return attempts(t).where("failed").orderBy(F.col("status_code").isNull().desc(), F.asc_nulls_last("source"), F.asc_nulls_last("target"), "seq").limit(25).select("source", "target", "seq")


@book.add(
    f"""with o as (select seq, {_AT} as asked, unnest(observations) as o, generate_subscripts(observations, 1) as pos from (select distinct on (seq) seq, ts, observations from check_log) where observations is not null),
    x as (select seq, pos, asked, o.status_code as s, {_AT.replace('ts', 'o.ts')} as seen from o), y as (select *, coalesce(seen >= asked - interval 120 second, true) as good from x)
    select seq, coalesce(arg_min(case when s = 200 then 'live' else 'absent' end, pos) filter (good and s in (200, 404, 410)), 'inconclusive') as verdict from y group by 1"""
)
def witness_verdict(t):
    """ST-12, with the times of the observations and of the line that asked for them."""
    o = events.lines(t("check_log")).select("seq", references.utc_timestamp(F.col("ts")).alias("asked_at"), F.posexplode("observations").alias("pos", "o"))
    return events.witness_verdict(o.select("seq", "pos", "asked_at", "o.status_code", references.utc_timestamp(F.col("o.ts")).alias("seen_at")))


@book.add(f"select capture_dir, case when ots is null then 'missing' when not coalesce(ots.ok, false) then 'restamp' when len(coalesce(ots.calendars, [])) > 0 then 'pending' else 'anchored' end as state from {M}")
def proof_state(t):
    return events.proof_state(versions.once(t("manifest")))


@book.add(
    f"""with x as (select capture_dir, http.status_code as s, http.etag as e, http.last_modified as l, http.url as url, sha256(http.url) as h from {M}), y as (select *, (('0x' || substr(h, 1, 4))::bigint % 7 + ('0x' || substr(h, 5, 15))::bigint % 7 + ('0x' || substr(h, 20, 15))::bigint % 7 + ('0x' || substr(h, 35, 15))::bigint % 7 + ('0x' || substr(h, 50, 15))::bigint % 7) % 7 as b from x)
    select capture_dir, case when b <> 2 and s = 200 and (e is not null or l is not null) then coalesce(e, l) end as validator from y"""
)
def conditional_validators(t):
    m = versions.once(t("manifest")).select("capture_dir", "http.status_code", "http.etag", "http.last_modified", hashing.week_bucket(F.col("http.url")).alias("bucket"))
    return events.validators(m, weekday=2)


@book.add(f"with l as (select * from {_L}) select a.seq, a.source, a.target, max(c.seq) as supersedes from l a left join l c on c.source is not distinct from a.source and c.target is not distinct from a.target and c.outcome = 'error' and c.absence is not null and c.seq < a.seq where a.outcome = 'live-attested' group by 1, 2, 3")
def attestations(t):
    return events.attestations(t("check_log"))


@book.add(f"with l as (select * from {_L} where url is not null and day is not null), v as (select url, day, max(seq) as alive_at from l where outcome in {_OK} group by 1, 2) select l.seq, l.url, v.alive_at from l join v on v.url = l.url and v.day = l.day where l.outcome = 'error' and alive_at > seq")
def superseded_claims(t):
    return events.superseded_claims(t("check_log"))


@book.add(
    f"""with q as (select distinct substr(sha256(source_id || '|' || url), 1, 16) as key, source_id, status from {TARGETS}) select key, case when status = 'published' then 'approved' when status = 'missing' then 'rejected' else 'pending' end as state from q"""
)
def decided_candidates(t):
    from provlake.plans.scalars import targets

    q = targets(t).select(hashing.candidate_key(F.col("source_id"), F.col("url")).alias("key"), "status").distinct()
    said = F.when(F.col("status") == "published", "approve").when(F.col("status") == "missing", "reject")
    commands = q.select("key", said.alias("action"), F.lit("OWNER").alias("association"), F.lit(1).alias("seq")).unionByName(q.select("key", F.lit("reject").alias("action"), F.lit("NONE").alias("association"), F.lit(0).alias("seq")))
    return events.decide(q.select("key"), commands, ("OWNER",))


@book.add(f"select run, sum(case outcome when 'error' then 1 else 0 end)::bigint as errors, sum(case outcome when 'error' then 1 when 'recheck-recovered' then -1 else 0 end)::bigint as net from {_A} group by 1")
def sweep_stats(t):
    """A-10: counts of a run, with withdrawals taken off."""
    e = attempts(t)
    return e.groupBy("run").agg(F.count_if(F.col("outcome") == "error").alias("errors"), F.sum(F.when(F.col("outcome") == "error", 1).when(F.col("outcome") == "recheck-recovered", -1).otherwise(0)).alias("net"))


@book.add(f"select host, count(*) as n, count(distinct target) as n_targets, min(target) as first_target from {_A} where failed group by 1")
def skipped_per_host(t):
    """A-14: what a host's failures held up; counts instead of lists that could grow without bound."""
    return attempts(t).where("failed").groupBy("host").agg(F.count("*").alias("n"), F.countDistinct("target").alias("n_targets"), F.min("target").alias("first_target"))


@book.add(f"with d as (select day, count(*) as n, count(*) filter (outcome = 'error') as errors from {_L} where day is not null group by 1) select day::varchar as day, n, errors from d")
def daily_counts(t):
    return events.lines(t("check_log")).where("day is not null").groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"), F.count_if(F.col("outcome") == "error").alias("errors"))


_SESS = "with x as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) <= interval 30 minute then 0 else 1 end as s from events), y as (select user_id, ts, sum(s) over (partition by user_id order by ts rows unbounded preceding) as k from x) select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as started, count(*) as n from y group by user_id, k"


@book.add(_SESS)
def user_sessions(t):
    """Sessions of thirty minutes over a plain event stream."""
    s = t("events").groupBy("user_id", F.session_window(F.col("ts").cast("timestamp"), "30 minutes").alias("w")).agg(F.count("*").alias("n"))
    return s.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("started"), "n")


@book.add("select n_name, o_orderpriority, count(*) as n, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where l_shipdate >= timestamp '1995-01-01' group by 1, 2")
def revenue_by_nation(t):
    """A star join with pushed filters, as a check of the relational path."""
    l = t("lineitem").where("l_shipdate >= timestamp'1995-01-01'").select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("v"))  # noqa: E741
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = t("customer").select("c_custkey", "c_nationkey").join(t("nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    return l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("n_name", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("v"), 2).alias("revenue"))
