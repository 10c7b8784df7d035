"""Queries over pairs of versions, and the integrity checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import hashing, text
from provlake.operators import diff, integrity, ordered, references, versions
from provlake.plans.book import Book
from provlake.plans.ledger import CHAIN, LOST_STATE, M, TEXT_SHA, V, plant
from provlake.plans.scalars import _IDENTITY, _WORDS, collapsed

book = Book()


def linked(t):
    """Consecutive captures of a target, by ids and hashes alone."""
    rows = t("captures").select("capture_id", "source_id", "target", "captured_at", "sha256", hashing.canonical_sha(F.col("extracted_txt")).alias("text_sha"))
    chained = ordered.lag_over(rows, versions.KEY, ["captured_at", "capture_id"], ["capture_id", "sha256", "text_sha"]).where("prior_capture_id is not null")
    return chained.select(F.concat_ws(">", "prior_capture_id", "capture_id").alias("key"), "source_id", "target", F.col("prior_capture_id").alias("old_id"), F.col("capture_id").alias("new_id"), F.col("prior_sha256").alias("old_sha"), F.col("sha256").alias("new_sha"), F.col("prior_text_sha").alias("old_text_sha"), F.col("text_sha").alias("new_text_sha"))


def with_texts(t, rows):
    """Rows of old_id and new_id with both texts."""
    c = t("captures")
    for side in ("old", "new"):
        rows = rows.join(c.select(F.col("capture_id").alias(f"{side}_id"), F.col("extracted_txt").alias(f"{side}_text")), f"{side}_id", "left")
    return rows


def pairs(t):
    """Consecutive captures of a target with their texts."""
    return with_texts(t, linked(t))


def records(t, rows):
    """Records of pairs: equal hashes of texts decide, texts are fetched only for pairs whose hashes differ."""
    same = F.col("old_text_sha") == F.col("new_text_sha")
    alike = rows.where(same).select("key", F.lit("identical-text").alias("verdict"), F.lit(1.0).alias("similarity"), *[F.lit(0).alias(c) for c in ("word_delta", "moved_words", "n_changes")])
    return alike.unionByName(diff.pair_records(with_texts(t, rows.where(~F.coalesce(same, F.lit(False)))).select("key", "old_text", "new_text")))


_PAIRS = f"p as (select lag(capture_id) {CHAIN} || '>' || capture_id as key, capture_id, lag(extracted_txt) {CHAIN} as old_text, extracted_txt as new_text, lag(sha256) {CHAIN} as old_sha, sha256 as new_sha, lag(capture_id) {CHAIN} as prior from captures)"


@book.add(f"with {_PAIRS}, w as (select key, prior, (select {_IDENTITY} from (select {_WORDS.replace('(text,', '(old_text,')} as w)) as a, (select {_IDENTITY} from (select {_WORDS.replace('(text,', '(new_text,')} as w)) as b from p where prior is not null) select key, a = b as same from w")
def pair_identity(t):
    """G-02."""
    return pairs(t).select("key", diff.same_identity(F.col("old_text"), F.col("new_text")).alias("same"))


@book.add()
def pair_diff(t):
    """G-01 to G-08: every consecutive pair of versions."""
    return records(t, linked(t))


@book.add()
def diff_ledger(t):
    """G-09: records of pairs that a ledger lacks under the present rule, merged into it.

    The ledger holds the pairs of equal bytes under the present rule and all pairs of equal texts under the one before.
    """
    p = linked(t)
    held = [p.where(which).select("key", F.lit("identical-text").alias("verdict"), F.lit(1.0).alias("similarity"), F.lit(rule).alias("rule")) for which, rule in (("old_sha = new_sha", "identity-v4"), ("old_text_sha = new_text_sha and old_sha <> new_sha", "identity-v3"))]
    ledger = held[0].unionByName(held[1])
    fresh = records(t, diff.pending_pairs(p, ledger, "identity-v4"))
    return diff.merge_records(ledger, fresh, "identity-v4").withColumn("verdicts", F.array_join("verdicts", ","))


@book.add()
def pair_ledger(t):
    """G-08, G-09: the whole ledger: changes between captures made by other methods rescued like for like, or set down as such."""
    methods = versions.method_of(versions.once(t("manifest")), t("registry")).select("capture_dir", "stored_as", "method")
    dirs = t("captures").select("capture_id", "capture_dir", "source_id", "target", "captured_at").join(methods, "capture_dir", "left")
    alike = ordered.lag_over(dirs.where("stored_as like '%.html'").select("capture_id", "source_id", "target", "captured_at", "method"), [*versions.KEY, "method"], ["captured_at", "capture_id"], ["capture_id"], prefix="like_")
    p = linked(t)
    for side in ("old", "new"):
        p = p.join(dirs.select(F.col("capture_id").alias(f"{side}_id"), F.col("stored_as").alias(f"{side}_as"), F.col("method").alias(f"{side}_method")), f"{side}_id", "left")
    p = p.join(alike.select(F.col("capture_id").alias("new_id"), F.col("like_capture_id").alias("like_id")), "new_id", "left")
    flapped = F.coalesce(F.col("old_as").endswith(".html") & F.col("new_as").endswith(".html") & ~F.col("old_method").eqNullSafe(F.col("new_method")), F.lit(False))
    p = p.withColumn("flapped", flapped)
    first = records(t, p).join(p.select("key", "flapped", "like_id", "new_id"), "key")
    again = first.where("flapped and verdict = 'changed' and like_id is not null").select("key", F.col("like_id").alias("old_id"), "new_id")
    second = diff.pair_records(with_texts(t, again).select("key", "old_text", "new_text")).select("key", *[F.col(c).alias(f"like_{c}") for c in ("verdict", "similarity", "word_delta", "moved_words")])
    return diff.rescued(first.join(second, "key", "left")).select("key", "verdict", "similarity", "word_delta", "moved_words", "like_for_like")


@book.add()
def drift_chain(t):
    """G-10, J-04, G-11: per published source its live document against the archived copy, or an in-page one against its own last version."""
    published = t("registry").where("status = 'published'").select("source_id", F.transform(F.filter("targets", lambda x: F.coalesce(x["inpage"], F.lit(False))), lambda x: x["url"]).alias("inpage_urls"))
    m = versions.once(t("manifest")).select("capture_dir", "stored_as", F.col("http.url").alias("url"))
    s = t("state_index").where("size(versions) > 0").select("source_id", "target", "managed", "last_sha256", references.clean_dir(F.col("last_capture")).alias("capture_dir"), F.size("versions").alias("n_versions"))
    s = s.withColumn("stamp", F.regexp_extract("capture_dir", "([^/]*)$", 1)).join(m, "capture_dir", "left").join(published, "source_id")
    live = s.where("target like 'provider-live%' or target like 'provider-page%'").withColumn("inpage", F.coalesce(F.array_contains("inpage_urls", F.col("url")), F.lit(False)))
    document = F.coalesce(F.col("stored_as").rlike(r"\.(pdf|zip|md|txt|docx)$"), F.lit(False)) | F.col("inpage") | F.col("managed").isNotNull()
    order = ["stamp", "target"]
    best = ordered.last_of(live.where(document & F.col("stored_as").isNotNull()).select("source_id", *order, "capture_dir", "last_sha256", "inpage", "n_versions"), ["source_id"], order)
    archive = ordered.last_of(s.where("target like 'aial-archive%'").select("source_id", *order, F.col("capture_dir").alias("archive_dir"), F.col("last_sha256").alias("archive_sha")), ["source_id"], order).drop(*order)
    counts = live.groupBy("source_id").agg(F.count("*").alias("n_live"))
    rows = published.select("source_id").join(counts, "source_id", "left").join(archive, "source_id", "left").join(best.drop("stamp"), "source_id", "left")
    text = t("captures").select(references.clean_dir(F.col("capture_dir")).alias("dir"), "capture_id", "extracted_txt")
    both = rows.where("not inpage and archive_dir is not null and last_sha256 <> archive_sha")
    both = both.join(text.select(F.col("dir").alias("archive_dir"), F.col("extracted_txt").alias("old_text")), "archive_dir", "left").join(text.select(F.col("dir").alias("capture_dir"), F.col("extracted_txt").alias("new_text")), "capture_dir", "left")
    pair = diff.pair_records(both.select(F.col("source_id").alias("key"), "old_text", "new_text")).select(F.col("key").alias("source_id"), F.col("verdict").alias("pair_verdict"), "similarity")
    history = pair_ledger(t).select(F.split_part("key", F.lit(">"), F.lit(2)).cast("bigint").alias("capture_id"), F.col("verdict").alias("history"), F.col("similarity").alias("history_similarity"))
    own = rows.where("inpage").select("source_id", "capture_dir").join(text.select(F.col("dir").alias("capture_dir"), "capture_id"), "capture_dir").join(history, "capture_id").select("source_id", "history", "history_similarity")
    whole = rows.join(pair, "source_id", "left").join(own, "source_id", "left").withColumn("bundled", F.lit(False))
    return whole.select("source_id", diff.drift_chain_verdict().alias("verdict"), F.coalesce(F.when(F.col("inpage"), F.col("history_similarity")), "similarity").alias("similarity"))


@book.add(
    f"""with {_PAIRS}, x as (select key, old_sha, new_sha, trim(regexp_replace(old_text, '[\\s\\x0b\\x1c-\\x1f\\x85\\p{{Z}}]+', ' ', 'g')) as a, trim(regexp_replace(new_text, '[\\s\\x0b\\x1c-\\x1f\\x85\\p{{Z}}]+', ' ', 'g')) as b from p where prior is not null)
    select key, case when old_sha is null or new_sha is null then 'incomplete' when old_sha = new_sha then 'identical-bytes' when a is null or b is null then 'format-mismatch' when a = b then 'same-content' else 'drift-candidate' end as verdict from x"""
)
def drift_status(t):
    """G-10 without scores: what native comparison decides, by hashes of bytes and texts."""
    verdict = diff.drift_verdict(F.col("old_sha"), F.col("new_sha"), F.col("old_text_sha"), F.col("new_text_sha"), F.lit("x"), F.lit("x"), F.lit(0.0))
    return linked(t).select("key", verdict.alias("verdict"))


@book.add(
    f"""with {_PAIRS} select key, 2.0 * least(length(a), length(b)) / (length(a) + length(b)) >= 0.85 as candidate from (select key, substr(regexp_replace(lower(old_text), '[^a-z0-9]', '', 'g'), 1, 20000) as a, substr(regexp_replace(lower(new_text), '[^a-z0-9]', '', 'g'), 1, 20000) as b from p where prior is not null)
    where length(a) + length(b) > 0"""
)
def similarity_candidates(t):
    """J-16, G-30: the length bound before any alignment."""
    s = pairs(t).select("key", text.char_stream(F.col("old_text")).alias("a"), text.char_stream(F.col("new_text")).alias("b")).where("length(a) + length(b) > 0")
    return s.select("key", (diff.length_bound(F.col("a"), F.col("b")) >= diff.REVIEWED).alias("candidate"))


def scored(t):
    s = pairs(t).select("key", "source_id", "new_sha", text.char_stream(F.col("old_text")).alias("a"), text.char_stream(F.col("new_text")).alias("b")).where("length(a) + length(b) > 0")
    near = s.where(diff.length_bound(F.col("a"), F.col("b")) >= diff.REVIEWED).repartition(F.xxhash64("key"))
    return near.select("key", "source_id", "new_sha", diff.stream_similarity("a", "b").alias("similarity"))


@book.add()
def similarity_scored(t):
    """G-30: candidates within reach of the review threshold, scored."""
    return scored(t).select("key", F.round("similarity", 4).alias("similarity"))


@book.add()
def judged(t):
    """J-16, G-31: per source the best-scored candidate: versions scored against the one before, the strong ones also against the newest texts of the provider's other sources."""
    s = scored(t).withColumn("new_id", F.split_part("key", F.lit(">"), F.lit(2)).cast("bigint"))
    owners = t("registry").where("retired is null").select("source_id", F.lower("provider").alias("provider"), "model")
    newest = versions.newest(t("captures").where("extracted_txt is not null").select("source_id", "captured_at", "capture_id"), ["source_id"], ["captured_at", "capture_id"]).join(owners, "source_id")
    text_of = t("captures").select("capture_id", "extracted_txt")
    others = newest.join(text_of, "capture_id").select(F.col("source_id").alias("other"), "provider", text.char_stream(F.col("extracted_txt")).alias("b"))
    names = owners.groupBy("provider").agg(F.array_sort(F.collect_set("model")).alias("siblings"))  # the models of one provider, as the registry has them
    strong = s.where(F.col("similarity") >= diff.CONFIRMED).join(owners, "source_id").join(names, "provider").join(text_of.withColumnRenamed("capture_id", "new_id"), "new_id")
    strong = strong.select("key", "source_id", "provider", text.names_model("extracted_txt", "model", "siblings").alias("named"), text.char_stream(F.col("extracted_txt")).alias("a"))
    near = strong.join(others, (strong["provider"] == others["provider"]) & (F.col("other") != F.col("source_id")) & (diff.length_bound(F.col("a"), F.col("b")) >= diff.REVIEWED))
    sibling = near.repartition(F.xxhash64("key", "other")).select("key", diff.stream_similarity("a", "b").alias("v")).groupBy("key").agg(F.max("v").alias("sibling"))
    both = s.join(strong.select("key", "named"), "key", "left").join(sibling, "key", "left")
    rows = both.select(F.col("source_id").alias("key"), "similarity", F.col("key").alias("url"), F.col("new_sha").alias("sha256"), F.coalesce("sibling", F.lit(0.0)).alias("sibling"), F.coalesce("named", F.lit(False)).alias("named"))
    pruned = t("check_log").where("lower(outcome) like 'pruned%' and sha256 is not null").select(F.col("source").alias("key"), "sha256")
    return diff.judge(rows, pruned)


@book.add(f"with x as (select capture_id, source_id, target, captured_at, {TEXT_SHA} as ts, case when len(regexp_extract_all(extracted_txt, 'https?://[!-~]+')) > 0 then sha256(array_to_string(list_sort(list_distinct(regexp_extract_all(extracted_txt, 'https?://[!-~]+'))), chr(10))) end as links from captures), y as (select *, lag(ts) {CHAIN} as pt, lag(links) {CHAIN} as pl from x) select capture_id, coalesce(ts = pt and links <> pl, false) as links_changed from y")
def links_changed(t):
    """G-33, with the links that the text spells out."""
    found = F.regexp_extract_all("extracted_txt", F.lit("https?://[!-~]+"), F.lit(0))
    links = F.when(F.size(found) > 0, F.sha2(F.array_join(F.array_sort(F.array_distinct(found)), "\n"), 256))
    rows = t("captures").select("capture_id", "source_id", "target", "captured_at", hashing.canonical_sha(F.col("extracted_txt")).alias("ts"), links.alias("links"))
    y = ordered.lag_over(rows, versions.KEY, ["captured_at", "capture_id"], ["ts", "links"])
    return y.select("capture_id", diff.links_changed(F.col("ts"), F.col("prior_ts"), F.col("links"), F.col("prior_links")).alias("links_changed"))


_CLEAN = r"regexp_replace(regexp_replace(regexp_replace(trim({0}), '/{{2,}}', '/', 'g'), '^(\./)+', ''), '/+$', '')"


@book.add(f"with i as (select distinct {_CLEAN.format('dir')} as d from {V} where dir is not null), s as (select distinct {_CLEAN.format('capture_dir')} as d from captures) select 'C3' as \"check\", d as key, 'indexed, not stored' as message from i where d not in (select d from s) union all select 'C3', d, 'stored, not indexed' from s where d not in (select d from i)")
def index_against_store(t):
    return integrity.index_matches(t("state_index"), t("captures"))


BARE = "select -1L as seq, 'Pruned-noise' as outcome, '2026-01-01T00:00:00Z' as ts, 'x' as dir"


@book.add(f"select 'C4' as \"check\", seq::varchar as key, 'bare prune' as message from (select distinct on (seq) seq, outcome, ts, sha256, dir from check_log union all select seq, outcome, ts, null, dir from ({BARE.replace('-1L', '-1')})) where lower(outcome) like 'pruned%' and (ts is null or sha256 is null or dir is null)")
def bare_prunes(t):
    return integrity.prunes_explained(plant(t("check_log"), BARE))


@book.add(f"with x as (select c.capture_dir, sha256({collapsed('c.extracted_txt')}) as t, lower(m.text_sha256) as h from captures c join {M} m on m.capture_dir = c.capture_dir) select 'C5' as \"check\", capture_dir as key, case when h is null then 'text without hash' else 'other text' end as message from x where t is not null and (h is null or t <> h)")
def text_hash_check(t):
    return integrity.texts_match(t("manifest"), t("captures"))


@book.add(
    f"""with x as (select state_key, last_sha256, {_CLEAN.format('last_capture')} as tail, versions[len(versions)].sha256 as s, {_CLEAN.format('versions[len(versions)].dir')} as d from state_index where len(versions) > 0)
    select 'C6' as "check", state_key as key, case when last_sha256 is distinct from s then 'other hash' else 'other directory' end as message from x where last_sha256 is distinct from s or tail is distinct from d"""
)
def tail_pointer_check(t):
    return integrity.tails_match(t("state_index"))


@book.add(f"select 'C7' as \"check\", state_key as key, 'no versions' as message from (select state_key, len(versions) as n from state_index union all select state_key, null from ({LOST_STATE})) where coalesce(n, 0) = 0")
def empty_targets(t):
    return integrity.without_versions(plant(t("state_index"), LOST_STATE))


@book.add()
def corpus_checks(t):
    """All findings of the verifier."""
    return integrity.verify(t("state_index"), t("captures"), t("manifest"), t("check_log"))
