"""Queries of discovery: mining pages, naming, placing and continuing what was found."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import hashing, text
from provlake.operators import ordered, versions
from provlake.plans.book import Book
from provlake.plans.diffs import drift_status, pairs
from provlake.plans.ledger import CHAIN, FOLD, M, METHOD, RENDER, TEXT_SHA, V, plant
from provlake.plans.scalars import TARGETS, targets
from provlake.sources import readers

book = Book()


@book.add(f"select source_id, kind, url, url as first_loc, 2 as n from {TARGETS}")
def sitemap_locations(t):
    """S-10: entries of a listing, in order and each once."""
    xml = F.concat(F.lit("<urlset><url><loc> "), "url", F.lit(" </loc></url><url><loc>"), "url", F.lit("/b</loc></url><url><loc>"), "url", F.lit("</loc></url></urlset>"))
    found = targets(t).select("source_id", "kind", "url", readers.locations(xml).alias("l"))
    return found.select("source_id", "kind", "url", F.get("l", F.lit(0)).alias("first_loc"), F.size("l").alias("n"))


@book.add(f"select source_id, kind, url || '/e.pdf' as edition_url, '2025-' || length(url)::varchar as period from {TARGETS}")
def embedded_editions(t):
    """S-11: editions in one series of a page's embedded JSON."""
    page = F.concat(F.lit('x {"series_title":"A","e":[{"file_url":"https:\\/\\/no"}],"series_title":"B","e":[{"period":"2025\\u2013'), F.length("url").cast("string"), F.lit('","file_url":"'), F.replace("url", F.lit("/"), F.lit("\\/")), F.lit('\\/e.pdf"}],"series_title":"C","e":[{"file_url":"https:\\/\\/no"}]} y'))
    found = targets(t).select("source_id", "kind", F.explode(readers.embedded_editions(page, "B")).alias("e"))
    return found.select("source_id", "kind", F.col("e.url").alias("edition_url"), F.col("e.period").alias("period"))


@book.add(f"select source_id, kind, url, regexp_extract(url, '^([a-z]+://[^/]+)', 1) || '/v/version-2025-01-02' as link from {TARGETS}")
def dated_links(t):
    """S-12: links to dated versions on the page's own host."""
    page = F.lit("<a href='/v/version-2025-01-02'>a</a> <a href=\"https://other.example/version-2025-01-02\">b</a> <a href='/v/version-2025-01-02'>c</a> <a href='/none'>d</a>")
    return targets(t).select("source_id", "kind", "url", F.explode(readers.dated_links(page, F.col("url"))).alias("link"))


@book.add(f"select source_id, kind, url, 'https://files.example/' || substr(sha256(url), 1, 8) || '.zip' as key from {TARGETS}")
def signed_links(t):
    """S-13: links to a file host, keyed without their signatures."""
    page = F.concat(F.lit('<a href="https://files.example/'), F.substring(F.sha2("url", 256), 1, 8), F.lit('.zip?r=1&amp;Signature=abc">x</a> https://else.example/y'))
    found = targets(t).select("source_id", "kind", "url", F.explode(readers.signed_links(page, "files.example")).alias("e"))
    return found.select("source_id", "kind", "url", F.col("e.key").alias("key"))


@book.add("select sha, min(received_at)::date::varchar as first_day, count(*) as n from (select (body->>'$.sha256') as sha, received_at from raw_record) where sha is not null group by 1")
def delivered_states(t):
    """S-14: deliveries of a state over all feeds, each state once with its first day."""
    r = t("raw_record").select(F.get_json_object("body", "$.sha256").alias("sha"), "received_at").where("sha is not null")
    return r.groupBy("sha").agg(F.date_format(F.min("received_at"), "yyyy-MM-dd").alias("first_day"), F.count("*").alias("n"))


@book.add("select seq, source from (select distinct on (seq) seq, source, ingested_at from check_log) where ingested_at >= timestamptz '2026-12-01 00:00:00+00' - interval 30 day")
def recent_lines(t):
    """S-15: entries of the last thirty days before a given moment."""
    log = t("check_log").dropDuplicates(["seq"])
    return readers.recent(log, "ingested_at", F.lit("2026-12-01 00:00:00+00:00").cast("timestamp"), 30).select("seq", "source")


@book.add()
def names_model(t):
    """T-16: whether the head of a document names its model and none of that provider's longer-named ones."""
    models = t("registry").select("provider", "model").distinct()
    # the models of one provider, as the registry has them
    siblings = models.groupBy("provider").agg(F.array_sort(F.collect_set("model")).alias("siblings"))
    d = t("documents").select("doc_id", "text", "provider", "model").join(siblings, "provider", "left")
    return d.select("doc_id", text.names_model("text", "model", "siblings").alias("named"))


@book.add(
    f"""with m as (select capture_dir, target_kind, {FOLD.format('model')} as n, lower(sha256) as sha from {M}), r as (select {FOLD.format('model')} as n, min(source_id) as by_name from registry group by 1 having count(*) = 1),
    c as (select lower(sha256) as sha, min(source_id) as by_hash from captures where sha256 is not null group by 1 having count(distinct source_id) = 1)
    select capture_dir, case when target_kind = 'aial-archive' then coalesce(by_hash, by_name, 'unplaced') else coalesce(by_name, by_hash, 'unplaced') end as placed from m left join r on r.n = m.n left join c on c.sha = m.sha"""
)
def placed(t):
    """J-13: routing by kind: archives by their bytes first, others by their name."""
    fold = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")
    m = versions.once(t("manifest")).select("capture_dir", "target_kind", fold("model").alias("n"), F.lower("sha256").alias("sha"))
    r = t("registry").groupBy(fold("model").alias("n")).agg(F.min("source_id").alias("by_name"), F.count("*").alias("k")).where("k = 1").drop("k")
    c = t("captures").where("sha256 is not null").groupBy(F.lower("sha256").alias("sha")).agg(F.min("source_id").alias("by_hash"), F.countDistinct("source_id").alias("k")).where("k = 1").drop("k")
    both = m.join(r, "n", "left").join(c, "sha", "left")
    return both.select("capture_dir", F.when(F.col("target_kind") == "aial-archive", F.coalesce("by_hash", "by_name", F.lit("unplaced"))).otherwise(F.coalesce("by_name", "by_hash", F.lit("unplaced"))).alias("placed"))


HEADS = "select 'planted/' || feed, file_no::varchar, (body->>'$.sha256'), 0 from raw_record where rec_no = 1 and (body->>'$.sha256') is not null"


@book.add(
    f"""with h as (select source_id, target, arg_max(sha256, ord) as head from (select source_id, target, sha256, ord from {V} union all {HEADS}) group by 1, 2), r as (select feed, file_no, rec_no, (body->>'$.sha256') as sha from raw_record)
    select r.feed, r.file_no, r.rec_no, min(h.source_id || '::' || h.target) as continues from r join h on h.head = r.sha group by 1, 2, 3"""
)
def rename_continuation(t):
    """J-14: delivered states that are the head of a known chain, with a planted chain for every first record of a file."""
    planted = t("raw_record").where("rec_no = 1 and get_json_object(body, '$.sha256') is not null").select(F.concat(F.lit("planted/"), "feed").alias("source_id"), F.col("file_no").cast("string").alias("target"), F.get_json_object("body", "$.sha256").alias("sha256"), F.lit(0).alias("ord"))
    heads = versions.index_versions(t("state_index")).select("source_id", "target", "sha256", "ord").unionByName(planted).groupBy("source_id", "target").agg(F.max_by("sha256", "ord").alias("sha")).groupBy("sha").agg(F.min(F.concat("source_id", F.lit("::"), "target")).alias("continues"))
    r = t("raw_record").select("feed", "file_no", "rec_no", F.get_json_object("body", "$.sha256").alias("sha"))
    return r.join(heads, "sha").groupBy("feed", "file_no", "rec_no").agg(F.min("continues").alias("continues"))


@book.add(
    f"""with x as (select capture_id, source_id, target, captured_at, sha256, {TEXT_SHA} as ts from captures), y as (select *, lag(capture_id) {CHAIN} as p, lag(sha256) {CHAIN} as ps, lag(ts) {CHAIN} as pt, row_number() over (partition by source_id, target order by captured_at desc, capture_id desc) as k from x)
    select source_id, target, case when p is null then 'single-version' when sha256 is null or ps is null then 'incomplete' when sha256 = ps then 'identical-bytes' when ts is null or pt is null then 'format-mismatch' when ts = pt then 'same-content' else 'drift-candidate' end as verdict from y where k = 1"""
)
def newest_pair_record(t):
    """J-03, G-11: the record of each target's newest pair; a target of one version says so."""
    records = drift_status(t).select(F.split_part("key", F.lit(">"), F.lit(2)).cast("bigint").alias("capture_id"), "verdict")
    newest = versions.newest(t("captures").select("source_id", "target", "captured_at", "capture_id"), versions.KEY, ["captured_at", "capture_id"])
    return newest.join(records, "capture_id", "left").select("source_id", "target", F.coalesce("verdict", F.lit("single-version")).alias("verdict"))


@book.add(
    f"""with x as (select capture_dir, source_id, split_part(capture_dir, '/', 3) as target, stored_as, {METHOD} as method from {M} m left join {RENDER} on r.url = m.http.url),
    y as (select capture_dir, stored_as, method, lag(stored_as) over w as ps, lag(method) over w as pm from x window w as (partition by source_id, target order by capture_dir))
    select capture_dir, method is distinct from pm as method_changed from y where ends_with(stored_as, '.html') and ends_with(ps, '.html')"""
)
def method_changed(t):
    """P-08: pages whose way of capture differs from the one before; unknown equals unknown."""
    m = versions.method_of(versions.once(t("manifest")), t("registry"))
    x = m.select("capture_dir", "source_id", F.split_part("capture_dir", F.lit("/"), F.lit(3)).alias("target"), "stored_as", "method")
    y = ordered.lag_over(x, versions.KEY, ["capture_dir"], ["stored_as", "method"]).where("endswith(stored_as, '.html') and endswith(prior_stored_as, '.html')")
    return y.select("capture_dir", (~F.col("method").eqNullSafe(F.col("prior_method"))).alias("method_changed"))


@book.add(
    f"""with x as (select lag(capture_id) {CHAIN} || '>' || capture_id as key, lag(capture_id) {CHAIN} as p, sha256, lag(sha256) {CHAIN} as ps, {TEXT_SHA} as ts, lag({TEXT_SHA}) {CHAIN} as pt from captures),
    v as (select key, case when sha256 is null or ps is null then 'incomplete' when sha256 = ps then 'identical-bytes' when ts is null or pt is null then 'format-mismatch' when ts = pt then 'same-content' else 'drift-candidate' end as verdict from x where p is not null)
    select verdict, count(*) as n, min(key) as first_key, case verdict when 'drift-candidate' then 1 when 'incomplete' then 2 when 'format-mismatch' then 3 else 4 end as severity from v group by 1"""
)
def verdict_report(t):
    """A-02, O-04: verdicts with their severity, for the order of a report."""
    v = drift_status(t)
    rank = F.element_at(F.create_map(*[F.lit(x) for kv in {"drift-candidate": 1, "incomplete": 2, "format-mismatch": 3, "identical-bytes": 4, "same-content": 4}.items() for x in kv]), F.col("verdict"))
    return v.groupBy("verdict").agg(F.count("*").alias("n"), F.min("key").alias("first_key")).withColumn("severity", rank)


@book.add()
def redacted_changes(t):
    """G-20: changes of pairs without the words of restricted sources."""
    from provlake.operators import diff

    shut = t("registry").where("restricted").select("source_id").withColumn("shut", F.lit(True))
    p = pairs(t).where(~F.coalesce(diff.same_identity(F.col("old_text"), F.col("new_text")), F.lit(True))).repartition(F.xxhash64("key"))
    r = p.select("key", "source_id", diff.compare_texts("old_text", "new_text").alias("r")).join(shut, "source_id", "left")
    return r.select("key", F.col("r.word_delta").alias("word_delta"), F.size(diff.redacted(F.col("r.changes"), F.coalesce("shut", F.lit(False)))).alias("n_listed"), F.coalesce("shut", F.lit(False)).alias("withheld"))


@book.add(f"select source_id, target, count(*) as n_versions, min(d) as first_dir, max(d) as last_dir, count(distinct sha256) as n_distinct from (select source_id, target, dir as d, sha256 from {V}) group by 1, 2")
def target_pages(t):
    """K-09: the rows behind a target's page."""
    return versions.index_versions(t("state_index")).groupBy("source_id", "target").agg(F.count("*").alias("n_versions"), F.min("dir").alias("first_dir"), F.max("dir").alias("last_dir"), F.countDistinct("sha256").alias("n_distinct"))


@book.add(f"select source_id, url, {FOLD.format('kind')} as kind from (select distinct source as source_id, url, kind from check_log where source is not null and url is not null) f where not exists (select 1 from {TARGETS} h where h.source_id = f.source_id and h.url = f.url)")
def fresh_relocations(t):
    """K-11: found addresses that a source does not have yet, each once."""
    found = t("check_log").where("source is not null and url is not null").select(F.col("source").alias("source_id"), "url", "kind").distinct()
    return found.join(targets(t).select("source_id", "url"), ["source_id", "url"], "left_anti").select("source_id", "url", text.alnum(F.col("kind")).alias("kind"))


@book.add(f"select key, n from (select substr(sha256(url), 1, 2) as key, count(*) as n from {TARGETS} group by 1)")
def key_spread(t):
    """How evenly content addresses fall into folders by their first digits."""
    return targets(t).groupBy(F.substring(hashing.sha256_hex(F.col("url")), 1, 2).alias("key")).agg(F.count("*").alias("n"))
