"""Queries over versions, manifests, the index and the registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import hashing
from provlake.operators import ordered, versions
from provlake.plans.book import Book
from provlake.plans.scalars import TARGETS, WS, collapsed, targets

book = Book()


def plant(df, sql: str):
    """The table and a few rows that make a case, told by SQL that either engine reads."""
    return df.unionByName(df.sparkSession.sql(sql), allowMissingColumns=True)

M = "(select distinct * from manifest)"
V = "(select source_id, target, generate_subscripts(versions, 1) - 1 as ord, unnest(versions).sha256 as sha256, unnest(versions).dir as dir from state_index)"
TEXT_SHA = f"sha256({collapsed('extracted_txt')})"
CHAIN = "over (partition by source_id, target order by captured_at, capture_id)"
FOLD = r"regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}]', '', 'g')"
RENDER = "(select url, bool_or(coalesce(render, false)) as rendered from (select unnest(targets, recursive := true) from registry) group by 1) r"
METHOD = "struct_pack(a := coalesce(r.rendered, false), b := coalesce(len([x for x in m.extraction_notes if contains(x, 'frame')]) > 0, false), c := len([x for x in m.extraction_notes if contains(x, 'consent banner removed')]), d := coalesce(len([x for x in m.extraction_notes if contains(x, 'consent dismissed')]) > 0, false))"
ASSESS = "('aial-eval', 'aial-eval-history', 'aial-eval-page', 'aial-method')"


def index(t):
    return versions.index_versions(t("state_index"))


@book.add(f"select source_id, target, ord, sha256, dir from {V}")
def index_versions(t):
    return index(t)


@book.add(f"select capture_id, source_id, target, capture_dir, strftime(captured_at, '%Y-%m-%d %H:%M:%S') as captured_at, sha256, lag(capture_id) {CHAIN} as prior_capture_id, lag(sha256) {CHAIN} as prior_sha256, lag(capture_dir) {CHAIN} as prior_capture_dir from captures")
def version_chain(t):
    return versions.chain(t("captures")).withColumn("captured_at", F.date_format("captured_at", "yyyy-MM-dd HH:mm:ss"))


@book.add(f"with x as (select source_id, target, ord, dir, lag(dir) over (partition by source_id, target order by ord) as from_dir from {V}) select source_id, target, from_dir, dir as to_dir from x where from_dir is not null")
def version_pairs(t):
    """W-02."""
    return ordered.lag_over(index(t), versions.KEY, ["ord"], ["dir"]).where("prior_dir is not null").select("source_id", "target", F.col("prior_dir").alias("from_dir"), F.col("dir").alias("to_dir"))


@book.add(
    f"""with x as (select capture_id, source_id, target, captured_at, sha256, {TEXT_SHA} as ts from captures), y as (select *, lag(capture_id) {CHAIN} as p, lag(sha256) {CHAIN} as ps,
      case when ts is not null then first_value(capture_id) over (partition by source_id, target, ts order by captured_at, capture_id) end as f from x)
    select capture_id, source_id, target, case when p is null then 'new' when sha256 = ps then 'unchanged' when f is not null and f <> capture_id then 'unchanged-content' else 'new-version' end as change, p as prior_capture_id, f as same_text_as from y"""
)
def change_detect(t):
    return versions.change_detect(t("captures"))


@book.add(f"with x as (select capture_id, source_id, target, captured_at, {TEXT_SHA} as ts from captures), y as (select *, lag(ts) {CHAIN} as p from x) select capture_id, source_id, target, strftime(captured_at, '%Y-%m-%d %H:%M:%S') as changed_at from y where ts <> p order by captured_at desc, capture_id limit 50")
def change_feed(t):
    """G-32, K-06, O-05: the newest fifty changes of content."""
    rows = t("captures").select("capture_id", "source_id", "target", "captured_at", hashing.canonical_sha(F.col("extracted_txt")).alias("text_sha"))
    changed = ordered.lag_over(rows, versions.KEY, ["captured_at", "capture_id"], ["text_sha"]).where("text_sha <> prior_text_sha")
    return changed.orderBy(F.desc("captured_at"), "capture_id").limit(50).select("capture_id", "source_id", "target", F.date_format("captured_at", "yyyy-MM-dd HH:mm:ss").alias("changed_at"))


@book.add("select sha256, min(struct_pack(a := capture_dir, b := source_id)).a as first_dir, min(struct_pack(a := capture_dir, b := source_id)).b as first_source, count(*) as n from captures where sha256 is not null group by 1")
def first_sighting(t):
    """A-05."""
    c = t("captures").where("sha256 is not null").groupBy("sha256").agg(F.min(F.struct("capture_dir", "source_id")).alias("f"), F.count("*").alias("n"))
    return c.select("sha256", F.col("f.capture_dir").alias("first_dir"), F.col("f.source_id").alias("first_source"), "n")


@book.add(f"select v.source_id, v.target, lower(m.text_sha256) as text_sha, arg_max(v.dir, struct_pack(a := ord, b := dir)) as dir from {V} v join {M} m on m.capture_dir = v.dir where m.text_sha256 is not null group by 1, 2, 3")
def known_text_lookup(t):
    return versions.known_texts(index(t), t("manifest"))


@book.add(f"select lower(sha256) as sha, arg_min(capture_dir, capture_dir) as capture_dir, arg_min(source_id, capture_dir) as source_id, arg_min(provider, capture_dir) as provider, arg_min(model, capture_dir) as model from {M} where sha256 is not null and source_id not in (select source_id from registry where retired is not null) group by 1")
def owner_by_hash(t):
    return versions.owners(t("manifest"), t("registry"))


@book.add(f"with x as (select lower(text_sha256) as sha, capture_dir, source_id from {M} union all select lower(sha256), capture_dir, source_id from {M}) select sha, arg_min(capture_dir, struct_pack(a := capture_dir, b := source_id)) as capture_dir, arg_min(source_id, struct_pack(a := capture_dir, b := source_id)) as source_id from x where sha is not null group by 1")
def text_hash_owner(t):
    return versions.text_owners(t("manifest"))


@book.add("select coalesce(status, 'total') as status, count(*) as n from registry where status is not null group by rollup(status)")
def status_counts(t):
    """A-01: by status, with the total."""
    return t("registry").where("status is not null").rollup("status").agg(F.count("*").alias("n")).select(F.coalesce("status", F.lit("total")).alias("status"), "n")


@book.add("select lower(outcome) as outcome, count(*) as n, count(distinct source) as n_sources from (select distinct * from check_log) group by 1")
def outcome_counts(t):
    """A-02."""
    return t("check_log").dropDuplicates(["seq"]).groupBy(F.lower("outcome").alias("outcome")).agg(F.count("*").alias("n"), F.countDistinct("source").alias("n_sources"))


_DOC = f"not coalesce(m.target_kind in {ASSESS}, false) and (coalesce(regexp_matches(m.stored_as, '(\\.pdf|\\.zip|\\.md|\\.txt|\\.docx|\\.doc|\\.xml)$'), false) or coalesce(i.inpage, false) or s.managed is not null)"
_ROWS = f"(select m.*, coalesce(i.inpage, false) as inpage, s.managed, r.retired from {M} m left join (select url, bool_or(coalesce(inpage, false)) as inpage from {TARGETS} group by 1) i on i.url = m.http.url left join (select source_id, target, min(managed) as managed from state_index group by 1, 2) s on s.source_id = m.source_id and s.target = split_part(m.capture_dir, '/', 3) left join registry r on r.source_id = m.source_id)"


def enriched(t):
    """Manifest rows with what registry and index say of their target."""
    inpage = targets(t).groupBy("url").agg(F.max(F.coalesce("inpage", F.lit(False))).alias("inpage"))
    state = t("state_index").groupBy("source_id", "target").agg(F.min("managed").alias("managed"))
    m = versions.once(t("manifest")).withColumn("target", F.split_part("capture_dir", F.lit("/"), F.lit(3))).withColumn("url", F.col("http.url"))
    out = m.join(inpage, "url", "left").join(state, ["source_id", "target"], "left").join(t("registry").select("source_id", "retired"), "source_id", "left")
    return out.withColumn("document", versions.is_document(F.col("target_kind"), F.col("stored_as"), F.col("inpage"), F.col("managed")))


_E = f"(select m.*, s.managed, r.retired, {_DOC} as document from {M} m left join (select url, bool_or(coalesce(inpage, false)) as inpage from {TARGETS} group by 1) i on i.url = m.http.url left join (select source_id, target, min(managed) as managed from state_index group by 1, 2) s on s.source_id = m.source_id and s.target = split_part(m.capture_dir, '/', 3) left join registry r on r.source_id = m.source_id)"


@book.add(f"select source_id, count(distinct lower(coalesce(text_sha256, sha256))) as n_documents from {_E} where document and retired is null group by 1")
def distinct_documents(t):
    """A-03."""
    return enriched(t).where("document and retired is null").groupBy("source_id").agg(F.countDistinct(F.lower(F.coalesce("text_sha256", "sha256"))).alias("n_documents"))


@book.add(f"select capture_dir, document, case when retired is not null then 'superseded' when target_kind = 'aial-method' then 'method' when target_kind in {ASSESS} then 'evaluation' when document then 'document' else 'surface' end as class from {_E}")
def capture_class(t):
    """P-01, P-05."""
    e = enriched(t)
    return e.select("capture_dir", "document", versions.capture_class(F.col("target_kind"), F.col("document"), F.col("retired").isNull()).alias("class"))


RESTRICTED = "select null as source_id, true as restricted"


@book.add(f"select capture_dir, coalesce(case when r.restricted then 'source' end, case when m.target_kind in {ASSESS} then 'kind' end, case when m.http.url in (select url from {TARGETS} where kind in {ASSESS}) or m.http.final_url in (select url from {TARGETS} where kind in {ASSESS}) then 'url' end) as restriction from {M} m left join (select * from registry union all by name {RESTRICTED}) r on r.source_id = m.source_id")
def restriction(t):
    """P-02: why a capture's text is withheld: first by source, then kind, then a URL, asked for or arrived at, at which an assessment is."""
    m = versions.once(t("manifest")).join(plant(t("registry"), RESTRICTED).select("source_id", "restricted"), "source_id", "left")
    shut = targets(t).where(F.col("kind").isin(*versions.ASSESSMENTS)).select("url").distinct().withColumn("shut", F.lit(True))
    for c in ("url", "final_url"):
        m = m.withColumn("asked", F.col(f"http.{c}")).join(shut.select(F.col("url").alias("asked"), F.col("shut").alias(f"by_{c}")), "asked", "left").drop("asked")
    why = F.coalesce(F.when(F.col("restricted"), "source"), F.when(F.col("target_kind").isin(*versions.ASSESSMENTS), "kind"), F.when(F.coalesce("by_url", "by_final_url"), "url"))
    return m.select("capture_dir", why.alias("restriction"))


@book.add("select capture_id from captures where stored_as = 'raw.html' and octet_length(encode(extracted_txt)) < 600")
def app_shells(t):
    """P-03: pages whose text is too short to be one."""
    return t("captures").where((F.col("stored_as") == "raw.html") & (F.octet_length("extracted_txt") < 600)).select("capture_id")


@book.add(f"select (select count(*) from registry) as n_sources, (select count(distinct lower(provider)) from registry) as n_providers, (select count(*) from registry where status = 'published') as n_published, (select count(*) from captures) as n_captures, (select strftime(max(captured_at), '%Y-%m-%d') from captures) as newest")
def site_stats(t):
    """A-04: aggregates of one row each, put side by side."""
    r = t("registry").agg(F.count("*").alias("n_sources"), F.countDistinct(F.lower("provider")).alias("n_providers"), F.count_if(F.col("status") == "published").alias("n_published"))
    return r.crossJoin(t("captures").agg(F.count("*").alias("n_captures"), F.date_format(F.max("captured_at"), "yyyy-MM-dd").alias("newest")))


@book.add(f"select capture_dir, count(*) over (partition by strftime(captured_at, '%Y-%m-%d')) as n_that_day, strftime(captured_at, '%Y-%m-%d') as day from captures")
def counts_per_date(t):
    """A-13: by an aggregate joined back, so that a busy day is no single task."""
    c = t("captures").select("capture_dir", F.date_format("captured_at", "yyyy-MM-dd").alias("day"))
    return c.join(c.groupBy("day").agg(F.count("*").alias("n_that_day")), "day").select("capture_dir", "n_that_day", "day")


@book.add(f"select source_id, count(*) as n, sum(size_bytes)::bigint as total_bytes, coalesce(sum(size_bytes) > 100000, false) as over_limit from {M} group by 1")
def stored_bytes(t):
    """A-12, L16."""
    return versions.once(t("manifest")).groupBy("source_id").agg(F.count("*").alias("n"), F.sum("size_bytes").alias("total_bytes"), F.coalesce(F.sum("size_bytes") > 100000, F.lit(False)).alias("over_limit"))


@book.add("select lower(trim(split_part(text, chr(10), 1))) as title, count(*) as n, min(doc_id) as first_doc from documents where text is not null group by 1 having count(*) > 1")
def duplicate_titles(t):
    """A-08, L7: first lines that several documents share."""
    d = t("documents").where("text is not null").groupBy(F.lower(F.trim(F.split_part("text", F.lit("\n"), F.lit(1)))).alias("title"))
    return d.agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


@book.add(f"select lower(split_part(url, '#', 1)) as claim, count(distinct source_id) as n_sources, min(source_id) as first_source from (select source_id, url from {TARGETS} union all select source, url from check_log where source is not null and url is not null union all select 'planted/mirror', upper(substr(url, 1, 8)) || substr(url, 9) || '#top' from {TARGETS}) group by 1 having count(distinct source_id) > 1")
def claims_shared(t):
    """J-19: one URL claimed by several sources, in registry, log or a planted mirror of all targets."""
    mirror = targets(t).select(F.lit("planted/mirror").alias("source_id"), F.concat(F.upper(F.substring("url", 1, 8)), F.expr("substr(url, 9)"), F.lit("#top")).alias("url"))
    claims = targets(t).select("source_id", "url").unionByName(t("check_log").where("source is not null and url is not null").select(F.col("source").alias("source_id"), "url")).unionByName(mirror)
    return claims.groupBy(F.lower(F.substring_index("url", "#", 1)).alias("claim")).agg(F.countDistinct("source_id").alias("n_sources"), F.min("source_id").alias("first_source")).where("n_sources > 1")


@book.add(f"with a as (select s.source_id, s.target, s.state_key, t.kind as kind from state_index s left join {TARGETS} t on t.source_id = s.source_id and t.kind || '-' || substr(sha256(t.url), 1, 8) = s.target) select state_key, kind, kind is not null as active from a")
def active_targets(t):
    """J-01, V-C8."""
    known = targets(t).select("source_id", hashing.target_slug(F.col("kind"), F.col("url")).alias("target"), "kind")
    return t("state_index").select("state_key", "source_id", "target").join(known, ["source_id", "target"], "left").select("state_key", "kind", F.col("kind").isNotNull().alias("active"))


@book.add(f"select v.source_id, v.target, v.ord, v.dir from {V} v where not exists (select 1 from manifest m where m.capture_dir = v.dir)")
def versions_without_manifest(t):
    """J-02."""
    return index(t).join(t("manifest").select(F.col("capture_dir").alias("dir")), "dir", "left_anti").select("source_id", "target", "ord", "dir")


@book.add(f"select source_id, arg_max(capture_dir, struct_pack(a := substr(capture_dir, instr(capture_dir, '/20') + 1), b := capture_dir)) as live_dir from {M} where target_kind = 'provider-live' group by 1")
def newest_live(t):
    """J-04, W-05: by the time in the last part of the path, not by the path."""
    m = versions.once(t("manifest")).where("target_kind = 'provider-live'").select("source_id", "capture_dir", F.expr("substr(capture_dir, instr(capture_dir, '/20') + 1)").alias("stamp"))
    return versions.newest(m, ["source_id"], ["stamp", "capture_dir"]).select("source_id", F.col("capture_dir").alias("live_dir"))


@book.add("select feed, file_no, rec_no from raw_record r where not exists (select 1 from manifest m where m.sha256 = (r.body->>'$.sha256')) and (r.body->>'$.sha256') is not null")
def already_held_anti(t):
    """J-05: delivered records whose bytes are not held."""
    r = t("raw_record").select("feed", "file_no", "rec_no", F.get_json_object("body", "$.sha256").alias("sha256")).where("sha256 is not null")
    return r.join(t("manifest").select("sha256"), "sha256", "left_anti").select("feed", "file_no", "rec_no")


@book.add("select distinct (body->>'$.archive_file_name') as name from raw_record where (body->>'$.archive_file_name') is not null and (body->>'$.archive_file_name') not in (select regexp_extract(url, '([^/]*)$', 1) from " + TARGETS + ")")
def wanted_names_anti(t):
    """J-06."""
    wanted = t("raw_record").select(F.get_json_object("body", "$.archive_file_name").alias("name")).where("name is not null").distinct()
    return wanted.join(targets(t).select(F.regexp_extract("url", "([^/]*)$", 1).alias("name")), "name", "left_anti")


@book.add(f"with c as (select distinct source_id, url, substr(sha256(source_id || '|' || url), 1, 16) as key from check_log_c), p as (select distinct substr(sha256(source_id || '|' || url), 1, 16) as key from {TARGETS}) select source_id, url, key from c where key not in (select key from p)".replace("check_log_c", "(select source as source_id, url from check_log where source is not null and url is not null)"))
def new_candidates(t):
    """J-07: candidates neither pending nor decided, each once."""
    c = t("check_log").where("source is not null and url is not null").select(F.col("source").alias("source_id"), "url").distinct().withColumn("key", hashing.candidate_key(F.col("source_id"), F.col("url")))
    return c.join(targets(t).select(hashing.candidate_key(F.col("source_id"), F.col("url")).alias("key")), "key", "left_anti").select("source_id", "url", "key")


LOST_STATE = "select 'planted/gone::x' as state_key, 'planted/gone' as source_id, 'x' as target"


@book.add(f"select state_key from (select state_key, source_id from state_index union all select state_key, source_id from ({LOST_STATE})) where source_id not in (select source_id from registry where source_id is not null)")
def orphan_state_keys(t):
    """J-08, L11, with a planted key."""
    return plant(t("state_index"), LOST_STATE).select("state_key", "source_id").join(t("registry").select("source_id"), "source_id", "left_anti").select("state_key")


@book.add(f"select distinct c.capture_id from captures c where exists (select 1 from {V} v where v.source_id = c.source_id and v.target = c.target and v.sha256 = c.sha256 and v.dir <> c.capture_dir)")
def byte_identical_semi(t):
    """J-09: captures with the bytes of another archived version of their target."""
    v = index(t).select("source_id", "target", "sha256", "dir").distinct()
    return t("captures").alias("c").join(v.alias("v"), (F.col("c.source_id") == F.col("v.source_id")) & (F.col("c.target") == F.col("v.target")) & (F.col("c.sha256") == F.col("v.sha256")) & (F.col("c.capture_dir") != F.col("v.dir")), "left_semi").select("capture_id")


@book.add(
    """with l as (select distinct on (seq) * from check_log), n as (select dir, arg_max(sha256, seq) as s from l where lower(outcome) = 'new' and dir is not null and sha256 is not null group by 1),
    v as (select l.seq as key, coalesce(l.sha256, n.s) as sha256, l.source as source_id, l.dir from l left join n on n.dir = l.dir where lower(l.outcome) like 'pruned%'), s as (select sha256, source_id, min(capture_dir) as d from captures where capture_dir not in (select dir from v where dir is not null) group by 1, 2), a as (select sha256, min(d) as d from s group by 1)
    select v.key, coalesce(s.d, a.d) as survives_in from v left join s on s.sha256 = v.sha256 and s.source_id = v.source_id left join a on a.sha256 = v.sha256"""
)
def survivors(t):
    """J-10, for what the log says was pruned; the hash comes from the line that stored the directory where it is missing."""
    log = t("check_log").dropDuplicates(["seq"])
    stored = log.where("lower(outcome) = 'new' and dir is not null and sha256 is not null").groupBy("dir").agg(F.max_by("sha256", "seq").alias("stored_sha"))
    gone = log.where("lower(outcome) like 'pruned%'").join(stored, "dir", "left").select(F.col("seq").alias("key"), F.coalesce("sha256", "stored_sha").alias("sha256"), F.col("source").alias("source_id"), F.col("dir").alias("capture_dir"))
    return versions.survivors(t("captures"), gone)


@book.add(
    f"""with i as (select capture_dir, provider, model, http.url as url from {M}), n as (select {FOLD.format('provider')} as p, {FOLD.format('model')} as m, min(source_id) as s from registry group by 1, 2 having count(distinct source_id) = 1),
    u as (select url, min(source_id) as s from {TARGETS} group by 1 having count(distinct source_id) = 1)
    select i.capture_dir, coalesce(n.s, u.s, 'unplaced') as resolved, case when n.s is not null then 'name' when u.s is not null then 'url' else 'fallback' end as how from i left join n on n.p = {FOLD.format('i.provider')} and n.m = {FOLD.format('i.model')} left join u on u.url = i.url"""
)
def entity_resolution_chain(t):
    items = versions.once(t("manifest")).select("capture_dir", "provider", "model", F.col("http.url").alias("url"))
    return versions.resolve_entities(items, t("registry"), "unplaced").select("capture_dir", "resolved", "how")


@book.add(f"select url, min(source_id) as owner from {TARGETS} group by 1 having count(distinct source_id) = 1")
def unique_owner_urls(t):
    return targets(t).groupBy("url").agg(F.min("source_id").alias("owner"), F.countDistinct("source_id").alias("k")).where("k = 1").drop("k")


@book.add(
    f"""with n as (select distinct source_id, {FOLD.format('provider')} as p, {FOLD.format('model')} as m from (select source_id, provider, model from {M} union all select 'renamed/' || source_id, upper(provider), '_' || model from registry) where source_id is not null), r as (select {FOLD.format('provider')} as p, {FOLD.format('model')} as m, min(source_id) as s from registry group by 1, 2 having count(*) = 1)
    select n.source_id, r.s as renamed_to from n join r on r.p = n.p and r.m = n.m where n.source_id not in (select source_id from registry)"""
)
def renamed_sources(t):
    """J-12: ids that are not tracked, with the one tracked source of the same names."""
    fold = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")
    old = t("registry").select(F.concat(F.lit("renamed/"), "source_id").alias("source_id"), F.upper("provider").alias("provider"), F.concat(F.lit("_"), "model").alias("model"))  # planted: every source under an id of before
    n = versions.once(t("manifest")).select("source_id", "provider", "model").unionByName(old).where("source_id is not null").select("source_id", fold("provider").alias("p"), fold("model").alias("m")).distinct().join(t("registry").select("source_id"), "source_id", "left_anti")
    r = t("registry").groupBy(fold("provider").alias("p"), fold("model").alias("m")).agg(F.min("source_id").alias("renamed_to"), F.count("*").alias("k")).where("k = 1")
    return n.join(r, ["p", "m"]).select("source_id", "renamed_to")


@book.add(
    f"""with x as (select source_id, split_part(capture_dir, '/', 3) as target, capture_dir, {METHOD} as method from {M} m left join {RENDER} on r.url = m.http.url)
    select capture_dir, lag(capture_dir) over (partition by source_id, target, method order by capture_dir) as like_capture_dir from x"""
)
def like_for_like_asof(t):
    m = versions.method_of(versions.once(t("manifest")), t("registry")).select("source_id", F.split_part("capture_dir", F.lit("/"), F.lit(3)).alias("target"), "capture_dir", "method")
    return versions.like_for_like(m, versions.KEY, "method", "capture_dir", "capture_dir").select("capture_dir", "like_capture_dir")


@book.add(f"with x as (select capture_dir, source_id, captured_at from captures) select a.capture_dir as dir_a, b.capture_dir as dir_b from x a join x b on a.source_id = b.source_id and a.capture_dir < b.capture_dir and abs(epoch(a.captured_at) - epoch(b.captured_at)) <= 3600")
def concurrent_captures(t):
    """J-18: captures of a source within an hour of each other, by hour buckets instead of a pair of everything."""
    x = t("captures").select("capture_dir", "source_id", F.unix_timestamp("captured_at").alias("s"))
    a = x.select(F.col("capture_dir").alias("dir_a"), "source_id", F.col("s").alias("sa"), F.expr("s div 3600").alias("hour"))
    b = x.select(F.col("capture_dir").alias("dir_b"), "source_id", F.col("s").alias("sb"), F.explode(F.expr("sequence(s div 3600 - 1, s div 3600 + 1)")).alias("hour"))
    return a.join(b, ["source_id", "hour"]).where("dir_a < dir_b and abs(sa - sb) <= 3600").select("dir_a", "dir_b")


@book.add(f"with x as (select lower(text_sha256) as h, source_id from {M} where text_sha256 is not null), g as (select h, min(source_id) as a, max(source_id) as b, count(distinct source_id) as k from x group by 1) select h as text_sha, a as source_a, b as source_b, k as n_sources from g where k > 1")
def text_clash(t):
    """J-20: a text held for several sources; one row per text, however many hold it."""
    x = versions.once(t("manifest")).where("text_sha256 is not null").groupBy(F.lower("text_sha256").alias("text_sha")).agg(F.min("source_id").alias("source_a"), F.max("source_id").alias("source_b"), F.countDistinct("source_id").alias("n_sources"))
    return x.where("n_sources > 1").select("text_sha", "source_a", "source_b", "n_sources")


@book.add(
    f"""with h as (select source_id, kind, url from {TARGETS}), f as (select distinct source as source_id, kind, url from check_log where url is not null and source in (select source_id from registry)), n as (select * from f where not exists (select 1 from h where h.source_id = f.source_id and h.url = f.url)),
    e as (select *, false as added from h union all select *, true from n) select e.source_id, e.kind, e.url, e.added, case when r.status = 'missing' and exists (select 1 from n where n.source_id = e.source_id) then 'published' else r.status end as status from e join registry r on r.source_id = e.source_id"""
)
def registry_upsert(t):
    found = t("check_log").where("url is not null").select(F.col("source").alias("source_id"), "kind", "url").join(t("registry").select("source_id"), "source_id", "left_semi")
    return versions.upsert_targets(t("registry"), found)


@book.add(
    """with l as (select distinct * from check_log), n as (select seq, dir, sha256 from l where lower(outcome) = 'new' and dir is not null), p as (select dir from l where lower(outcome) like 'pruned%'), s as (select unnest(versions).dir as dir from state_index)
    select seq from n where dir not in (select capture_dir from captures) and dir not in (select dir from p where dir is not null) and dir not in (select dir from s where dir is not null)"""
)
def unexplained_news(t):
    """J-22: new versions in no place: three anti-joins for one disjunction."""
    log = t("check_log").dropDuplicates(["seq"])
    n = log.where("lower(outcome) = 'new' and dir is not null").select("seq", "dir")
    for other in (t("captures").select(F.col("capture_dir").alias("dir")), log.where("lower(outcome) like 'pruned%'").select("dir"), index(t).select("dir")):
        n = n.join(other, "dir", "left_anti")
    return n.select("seq")


@book.add(f"select url from (select distinct url from check_log where url is not null) l where not exists (select 1 from {TARGETS} t where t.url = l.url) and not exists (select 1 from manifest m where m.http.url = l.url or m.http.final_url = l.url)")
def broken_links(t):
    """J-23, L1."""
    m = t("manifest")
    pages = targets(t).select("url").unionByName(m.select(F.col("http.url").alias("url"))).unionByName(m.select(F.col("http.final_url").alias("url")))
    return t("check_log").where("url is not null").select("url").distinct().join(pages, "url", "left_anti")


@book.add(f"select l.source as source, l.url as url from (select distinct source, url from check_log where source is not null and url is not null) l where not exists (select 1 from {TARGETS} t where t.url = l.url and t.source_id <> l.source)")
def not_tracked_elsewhere(t):
    """J-24."""
    owners = targets(t).groupBy("url").agg(F.min("source_id").alias("lo"), F.max("source_id").alias("hi"))
    l = t("check_log").where("source is not null and url is not null").select("source", "url").distinct()  # noqa: E741
    return l.join(owners, "url", "left").where("not coalesce(lo <> source or hi <> source, false)").select("source", "url")


@book.add("select feed, sha, min(file_no) as file_no, arg_min(rec_no, struct_pack(a := file_no, b := rec_no)) as rec_no from (select feed, file_no, rec_no, (body->>'$.sha256') as sha from raw_record) where sha is not null group by 1, 2")
def first_commit_state(t):
    """W-03: the first delivery of each distinct state."""
    r = t("raw_record").select("feed", F.get_json_object("body", "$.sha256").alias("sha"), "file_no", "rec_no").where("sha is not null")
    return ordered.first_of(r, ["feed", "sha"], ["file_no", "rec_no"])


BACKWARDS = "select 'planted/back' as source_id, 'x' as target, {0} as ord, 'captures/planted__back/x/{1}' as dir"


@book.add(f"with v as (select source_id, target, ord, dir from {V} union all {BACKWARDS.format(0, '20260301T000000Z')} union all {BACKWARDS.format(1, '20260228T235959Z')} union all {BACKWARDS.format(2, '20260301T000000Z-2')}), x as (select source_id, target, ord, regexp_extract(dir, '(\\d{{8}}T\\d{{6}}Z)', 1) as s, lag(regexp_extract(dir, '(\\d{{8}}T\\d{{6}}Z)', 1)) over (partition by source_id, target order by ord) as p from v) select source_id, target, ord from x where s < p")
def capture_order_violations(t):
    """W-04, V-C10, with a planted target that goes back once."""
    planted = index(t).select("source_id", "target", "ord", "dir")
    for k, stamp in enumerate(("20260301T000000Z", "20260228T235959Z", "20260301T000000Z-2")):
        planted = plant(planted, BACKWARDS.format(k, stamp))
    v = planted.withColumn("stamp", F.regexp_extract("dir", r"(\d{8}T\d{6}Z)", 1))
    return ordered.lag_over(v, versions.KEY, ["ord"], ["stamp"]).where("stamp < prior_stamp").select("source_id", "target", "ord")


@book.add("with x as (select feed, file_no, rec_no, received_at, max(received_at) over (partition by feed order by file_no, rec_no rows between unbounded preceding and 1 preceding) as m from (select distinct feed, file_no, min(rec_no) as rec_no, min(received_at) as received_at from raw_record group by feed, file_no)) select feed, file_no from x where received_at < m")
def monotonic_guard(t):
    """W-08: files older than the newest before them; a running maximum over files, not records."""
    from pyspark.sql import Window

    f = t("raw_record").groupBy("feed", "file_no").agg(F.min("received_at").alias("received_at"))
    before = F.max("received_at").over(Window.partitionBy("feed").orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1))
    return f.withColumn("newest", before).where("received_at < newest").select("feed", "file_no")


@book.add(f"with x as (select capture_id, source_id, target, captured_at, {TEXT_SHA} as ts from captures), y as (select *, lag(ts) {CHAIN} as p from x) select capture_id, source_id, target from y where ts = p")
def noise_prune(t):
    return versions.noise_versions(t("captures"))


@book.add(f"select capture_dir, sha256 || regexp_extract(stored_as, 'raw(.*)$', 1) || case when ends_with(stored_as, '.html') then '.txt' else '' end as blob, sha256 || regexp_extract(stored_as, 'raw(.*)$', 1) || '.' || regexp_extract(capture_dir, '([^/]*)$', 1) || '.ots' as proof from {M} where stored_as is not null and sha256 is not null")
def blob_names(t):
    """K-04."""
    m = versions.once(t("manifest")).where("stored_as is not null and sha256 is not null")
    return m.select("capture_dir", versions.blob_name(F.col("stored_as"), F.col("sha256")).alias("blob"), F.concat("sha256", F.regexp_extract("stored_as", "raw(.*)$", 1), F.lit("."), F.regexp_extract("capture_dir", "([^/]*)$", 1), F.lit(".ots")).alias("proof"))


@book.add(f"select c.capture_id, c.source_id, c.target, c.capture_dir, c.sha256, m.model as model, m.http.url as url, m.http.status_code as status_code, coalesce(m.wayback.ok, false) as witnessed, coalesce(m.ots.ok, false) as proved from captures c left join {M} m on m.capture_dir = c.capture_dir")
def export_rows(t):
    """K-05: one row per stored version for the published data set."""
    m = versions.once(t("manifest")).select("capture_dir", "model", F.col("http.url").alias("url"), F.col("http.status_code").alias("status_code"), F.col("wayback.ok").alias("w"), F.col("ots.ok").alias("o"))
    return t("captures").join(m, "capture_dir", "left").select("capture_id", "source_id", "target", "capture_dir", "sha256", "model", "url", "status_code", F.coalesce("w", F.lit(False)).alias("witnessed"), F.coalesce("o", F.lit(False)).alias("proved"))


@book.add("select 'models/' || replace(c.source_id, '/', '__') as path, strftime(max(c.captured_at), '%Y-%m-%d') as lastmod from captures c join registry r on r.source_id = c.source_id where r.retired is null group by 1")
def sitemap(t):
    """K-07, L14: canonical pages with the date of their newest version."""
    live = t("registry").where("retired is null").select("source_id")
    return t("captures").join(live, "source_id").groupBy(F.concat(F.lit("models/"), F.replace("source_id", F.lit("/"), F.lit("__"))).alias("path")).agg(F.date_format(F.max("captured_at"), "yyyy-MM-dd").alias("lastmod"))


@book.add("select '| ' || r.source_id || ' | ' || coalesce(r.status, '-') || ' | ' || (select count(*) from captures c where c.source_id = r.source_id)::varchar || ' |' as line from registry r")
def markdown_report(t):
    """K-08."""
    n = t("captures").groupBy("source_id").agg(F.count("*").alias("n"))
    r = t("registry").join(n, "source_id", "left").select("source_id", "status", F.coalesce("n", F.lit(0)).alias("n"))
    return r.select(F.concat(F.lit("| "), "source_id", F.lit(" | "), F.coalesce("status", F.lit("-")), F.lit(" | "), F.col("n").cast("string"), F.lit(" |")).alias("line"))


@book.add(f"select source_id, provider, model, 'registry' as origin, null as url from registry union all select distinct source_id, provider, model, 'manifest', http.url from {M} where source_id not in (select source_id from registry where source_id is not null)")
def union_registry(t):
    """X-01: sources of several origins under one schema."""
    a = t("registry").select("source_id", "provider", "model", F.lit("registry").alias("origin"))
    b = versions.once(t("manifest")).select("source_id", "provider", "model", F.lit("manifest").alias("origin"), F.col("http.url").alias("url")).distinct().join(t("registry").select("source_id"), "source_id", "left_anti").where("source_id is not null")
    return a.unionByName(b, allowMissingColumns=True)


@book.add("(select source_id, target from captures except select source_id, target from state_index) union all (select source_id || '!', target from (select source_id, target from state_index except select source_id, target from captures))")
def set_diff_targets(t):
    """X-02: targets on one side only; those of the index alone are marked."""
    a, b = t("captures").select("source_id", "target"), t("state_index").select("source_id", "target")
    return a.subtract(b).unionByName(b.subtract(a).withColumn("source_id", F.concat("source_id", F.lit("!"))))


@book.add("select url, min(seq) as seq, arg_min(kind, seq) as kind from (select distinct seq, url, kind from check_log) where url is not null group by 1")
def ordered_dedup(t):
    """X-03: the first line of each URL."""
    return ordered.first_of(t("check_log").where("url is not null").select("url", "seq", "kind"), ["url"], ["seq"])


@book.add(f"with x as (select url, kind, ends_with(url, '.pdf') as pdf, source_id from {TARGETS}) select url, kind, source_id from x order by not pdf, url, source_id, kind limit 40")
def top_candidates(t):
    """O-02: forty candidates, documents first."""
    return targets(t).orderBy(~F.endswith("url", F.lit(".pdf")), "url", "source_id", "kind").limit(40).select("url", "kind", "source_id")


@book.add("with x as (select source_id, capture_id, row_number() over (partition by source_id order by captured_at desc, capture_id) as k from captures) select source_id, capture_id, k from x where k <= 5")
def newest_per_source(t):
    """O-07: at most five per source; each task keeps its own five before the shuffle."""
    from pyspark.sql import Window

    w = Window.partitionBy("source_id").orderBy(F.desc("captured_at"), "capture_id")
    return t("captures").select("source_id", "capture_id", "captured_at").withColumn("k", F.row_number().over(w)).where("k <= 5").select("source_id", "capture_id", "k")


@book.add("select row_number() over (order by lower(provider), lower(model), source_id) as place, source_id from registry")
def name_order(t):
    """O-06: places in a case-insensitive order."""
    r = t("registry").select("source_id", F.lower("provider").alias("p"), F.lower("model").alias("m"))
    return ordered.ranked(r, ["p", "m", "source_id"], "place").select("place", "source_id")


@book.add("with n as (select distinct upper(file_name) as name from raw_record union select distinct file_name from raw_record), k as (select distinct file_name as name from raw_record), l as (select lower(name) as low, min(name) as loose from k group by 1 having count(*) = 1) select n.name, coalesce(k.name, l.loose) as held_as from n left join k on k.name = n.name left join l on l.low = lower(n.name)")
def repaired_names(t):
    """P-12."""
    r = t("raw_record").select(F.col("file_name").alias("name"), "file_no")
    asked = r.select(F.upper("name").alias("name")).unionByName(r.select("name")).distinct()
    return versions.repaired_names(asked, r)


@book.add(f"with m as (select capture_dir, lower(prior_sha256) as p from {M} where prior_sha256 is not null), l as (select distinct * from check_log) select capture_dir, case when p in (select lower(sha256) from captures where sha256 is not null) then 'held' when p in (select lower(sha256) from l where sha256 is not null and lower(outcome) like 'pruned%') then 'pruned' when p in (select lower(sha256) from l where sha256 is not null) then 'logged' else 'unknown' end as prior from m")
def prior_explained(t):
    """P-13: where the version before is: held, pruned, only logged, or unknown."""
    m = versions.once(t("manifest")).where("prior_sha256 is not null").select("capture_dir", F.lower("prior_sha256").alias("p"))
    log = t("check_log").where("sha256 is not null")
    marks = (
        t("captures").where("sha256 is not null").select(F.lower("sha256").alias("p"), F.lit(1).alias("r"))
        .unionByName(log.where("lower(outcome) like 'pruned%'").select(F.lower("sha256").alias("p"), F.lit(2).alias("r")))
        .unionByName(log.select(F.lower("sha256").alias("p"), F.lit(3).alias("r"))).groupBy("p").agg(F.min("r").alias("r"))
    )
    return m.join(marks, "p", "left").select("capture_dir", F.when(F.col("r") == 1, "held").when(F.col("r") == 2, "pruned").when(F.col("r") == 3, "logged").otherwise("unknown").alias("prior"))


@book.add("select source_id from registry where contains(lower(source_id), 'research')")
def only_filter(t):
    """P-14: a pattern with a slash is an id, one without is a part of it; case ignored."""
    pattern = "Research"
    low = F.lower(F.lit(pattern))
    return t("registry").where(F.when(F.contains(low, F.lit("/")), F.lower("source_id") == low).otherwise(F.contains(F.lower("source_id"), low))).select("source_id")


@book.add("with o as (select source_id, 'missing' as expected, 'watch' as becomes from registry) select r.source_id, case when r.status = o.expected and r.note is not null then o.becomes else r.status end as status, r.status is distinct from o.expected as spent from registry r left join o on o.source_id = r.source_id")
def guarded_override(t):
    """P-11: a correction that stands only while the value is the one it was written for."""
    o = t("registry").select("source_id", F.lit("missing").alias("expected"), F.lit("watch").alias("becomes"))
    r = t("registry").join(o, "source_id", "left")
    return r.select("source_id", F.when((F.col("status") == F.col("expected")) & F.col("note").isNotNull(), F.col("becomes")).otherwise(F.col("status")).alias("status"), (~F.col("status").eqNullSafe(F.col("expected"))).alias("spent"))
