"""Version chains, content change, owners and entities of a ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.functions import hashing
from provlake.operators.ordered import first_of, lag_over, last_of

KEY = ["source_id", "target"]
# Kinds that assess a document instead of being it; suffixes of documents.
ASSESSMENTS = ("aial-eval", "aial-eval-history", "aial-eval-page", "aial-method")
DOCUMENTS = (".pdf", ".zip", ".md", ".txt", ".docx", ".doc", ".xml")


def once(manifest: DataFrame) -> DataFrame:
    """Manifest rows delivered twice, once: the greatest per directory where copies differ."""
    rest = [c for c in manifest.columns if c != "capture_dir"]
    return manifest.groupBy("capture_dir").agg(F.max(F.struct(*rest)).alias("r")).select("capture_dir", "r.*")


def index_versions(state: DataFrame) -> DataFrame:
    """S-05: (source_id, target, ord, sha256, dir) of the version index, in its order."""
    return state.select("source_id", "target", F.posexplode("versions").alias("ord", "v")).select("source_id", "target", "ord", "v.sha256", "v.dir")


def chain(captures: DataFrame) -> DataFrame:
    """W-01: every stored version with the one before it on its target."""
    rows = captures.select("capture_id", "source_id", "target", "capture_dir", "captured_at", "sha256")
    return lag_over(rows, KEY, ["captured_at", "capture_id"], ["capture_id", "sha256", "capture_dir"])


def change_detect(captures: DataFrame) -> DataFrame:
    """ST-05: what each capture brought: new, unchanged, unchanged-content or new-version.

    unchanged: the bytes are those of the version before; unchanged-content: the
    text, whitespace aside, was seen earlier on this target; null texts are told
    apart by their bytes alone.
    """
    rows = captures.select("capture_id", "source_id", "target", "captured_at", "sha256", hashing.canonical_sha(F.col("extracted_txt")).alias("text_sha"))
    seen = rows.where("text_sha is not null").groupBy(*KEY, "text_sha").agg(F.min(F.struct("captured_at", "capture_id")).alias("first"))
    linked = lag_over(rows, KEY, ["captured_at", "capture_id"], ["capture_id", "sha256"])
    both = linked.join(seen, [*KEY, "text_sha"], "left")
    label = (
        F.when(F.col("prior_capture_id").isNull(), "new").when(F.col("sha256") == F.col("prior_sha256"), "unchanged")
        .when(F.col("first") < F.struct("captured_at", "capture_id"), "unchanged-content").otherwise("new-version")
    )
    return both.select("capture_id", "source_id", "target", label.alias("change"), "prior_capture_id", F.col("first.capture_id").alias("same_text_as"))


def known_texts(versions: DataFrame, manifest: DataFrame) -> DataFrame:
    """H-08: text hash -> directory over all retained versions of a target; the later version wins."""
    m = once(manifest).where("text_sha256 is not null").select(F.col("capture_dir").alias("dir"), F.lower("text_sha256").alias("text_sha"))
    return versions.join(m, "dir").groupBy(*KEY, "text_sha").agg(F.max_by("dir", F.struct("ord", "dir")).alias("dir"))


def owners(manifest: DataFrame, registry: DataFrame) -> DataFrame:
    """H-09: bytes hash -> the first (source, provider, model) in path order, retired sources left out."""
    live = once(manifest).join(registry.where("retired is not null").select("source_id"), "source_id", "left_anti").where("sha256 is not null")
    rows = live.select(F.lower("sha256").alias("sha"), "capture_dir", "source_id", "provider", "model")
    return first_of(rows, ["sha"], ["capture_dir"])


def text_owners(manifest: DataFrame) -> DataFrame:
    """H-10, X-04: a hash of either column -> its source, the first in path order."""
    m = once(manifest)
    both = m.select(F.lower("text_sha256").alias("sha"), "capture_dir", "source_id").unionByName(m.select(F.lower("sha256").alias("sha"), "capture_dir", "source_id")).where("sha is not null")
    return first_of(both, ["sha"], ["capture_dir", "source_id"])


def is_document(kind: Column, stored_as: Column, inpage: Column, managed: Column) -> Column:
    """P-01: a version of the document itself: no assessment, and a document's suffix, an in-page text or a managed target."""
    suffix = stored_as.rlike("(" + "|".join(s.replace(".", r"\.") for s in DOCUMENTS) + ")$")
    return ~F.coalesce(kind.isin(*ASSESSMENTS), F.lit(False)) & (F.coalesce(suffix, F.lit(False)) | F.coalesce(inpage, F.lit(False)) | managed.isNotNull())


def capture_class(kind: Column, document: Column, active: Column) -> Column:
    """P-05: superseded, evaluation, method, document or surface."""
    return F.when(~active, "superseded").when(kind == "aial-method", "method").when(kind.isin(*ASSESSMENTS), "evaluation").when(document, "document").otherwise("surface")


def method(rendered: Column, frames: Column, consent: Column, dismissed: Column) -> Column:
    """P-08: what of the way of capture changes a page's text: rendering, frames, consent layers removed (null: unknown then) and dismissed.

    Two methods are compared null-safe: unknown equals unknown alone.
    """
    no = F.lit(False)
    return F.struct(F.coalesce(rendered, no).alias("rendered"), F.coalesce(frames, no).alias("frames"), consent.cast("int").alias("consent"), F.coalesce(dismissed, no).alias("dismissed"))


def method_of(manifest: DataFrame, registry: DataFrame) -> DataFrame:
    """Manifest rows with their method: whether the target at their URL is rendered, and what the notes say of frames and consent layers."""
    render = registry.select(F.inline("targets")).groupBy("url").agg(F.max(F.coalesce("render", F.lit(False))).alias("rendered"))
    m = manifest.withColumn("url", F.col("http.url")).join(render, "url", "left").drop("url")
    counted = lambda words: F.size(F.filter("extraction_notes", lambda n: F.contains(n, F.lit(words))))
    consent = F.when(F.col("extraction_notes").isNotNull(), counted("consent banner removed"))
    return m.withColumn("method", method(F.col("rendered"), F.coalesce(counted("frame") > 0, F.lit(False)), consent, F.coalesce(counted("consent dismissed") > 0, F.lit(False)))).drop("rendered")


def like_for_like(pairs: DataFrame, keys: list[str], method_col: str, order: str, value: str) -> DataFrame:
    """J-17: the newest earlier version made by the same method: an as-of join within (key, method)."""
    return lag_over(pairs, [*keys, method_col], [order], [value], prefix="like_")


def resolve_entities(items: DataFrame, registry: DataFrame, fallback: str) -> DataFrame:
    """J-11: item -> source by (provider, model), else by a URL that one source alone owns, else the fallback.

    Each dimension has one row per key: keys of several sources resolve nothing.
    """
    fold = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")
    by_name = registry.groupBy(fold("provider").alias("p"), fold("model").alias("m")).agg(F.min("source_id").alias("by_name"), F.countDistinct("source_id").alias("k")).where("k = 1").drop("k")
    by_url = registry.select("source_id", F.explode("targets.url").alias("url")).groupBy("url").agg(F.min("source_id").alias("by_url"), F.countDistinct("source_id").alias("k")).where("k = 1").drop("k")
    named = items.withColumn("p", fold("provider")).withColumn("m", fold("model")).join(by_name, ["p", "m"], "left").join(by_url, "url", "left")
    return named.select(*items.columns, F.coalesce("by_name", "by_url", F.lit(fallback)).alias("resolved"), F.when(F.col("by_name").isNotNull(), "name").when(F.col("by_url").isNotNull(), "url").otherwise("fallback").alias("how"))


def repaired_names(names: DataFrame, known: DataFrame) -> DataFrame:
    """P-12: a file name as it is held: exact, else the one that differs in case alone, else null."""
    exact = known.select("name").distinct().withColumn("exact", F.col("name"))
    loose = known.select("name").distinct().groupBy(F.lower("name").alias("low")).agg(F.min("name").alias("loose"), F.count("*").alias("k")).where("k = 1").drop("k")
    return names.join(exact, "name", "left").join(loose, F.lower(names["name"]) == loose["low"], "left").select("name", F.coalesce("exact", "loose").alias("held_as"))


def survivors(captures: DataFrame, victims: DataFrame) -> DataFrame:
    """J-10: for each victim (key, sha256, source_id, capture_dir) a capture of its bytes in another directory, of its own source if there is one.

    Directories of victims do not count as places where bytes survive.
    """
    stay = captures.join(victims.select("capture_dir"), "capture_dir", "left_anti").select("sha256", F.col("capture_dir").alias("dir"), F.col("source_id").alias("owner"))
    gone = victims.select("key", "sha256", "source_id")
    # a hash with very many copies needs one survivor per source, and one at all
    per_source = stay.groupBy("sha256", "owner").agg(F.min("dir").alias("dir"))
    any_one = per_source.groupBy("sha256").agg(F.min("dir").alias("any_dir"))
    own = per_source.withColumnRenamed("owner", "source_id").withColumnRenamed("dir", "own_dir")
    return gone.join(own, ["sha256", "source_id"], "left").join(any_one, "sha256", "left").select("key", F.coalesce("own_dir", "any_dir").alias("survives_in"))


def upsert_targets(registry: DataFrame, found: DataFrame) -> DataFrame:
    """J-21, K-11: registry targets with those found whose URL is new to the source; a missing source with a find is published."""
    have = registry.select("source_id", F.explode_outer("targets").alias("x")).select("source_id", "x.kind", "x.url")
    fresh = found.select("source_id", "kind", "url").distinct().join(have, ["source_id", "url"], "left_anti").select("source_id", "kind", "url").withColumn("added", F.lit(True))
    status = registry.select("source_id", "status")
    every = have.where("url is not null").withColumn("added", F.lit(False)).unionByName(fresh)
    got = fresh.select("source_id").distinct().withColumn("got", F.lit(True))
    return every.join(status, "source_id").join(got, "source_id", "left").select("source_id", "kind", "url", "added", F.when((F.col("status") == "missing") & F.col("got"), "published").otherwise(F.col("status")).alias("status"))


def noise_versions(captures: DataFrame) -> DataFrame:
    """W-09: versions whose text is that of the version just before, whitespace aside."""
    rows = captures.select("capture_id", "source_id", "target", "captured_at", hashing.canonical_sha(F.col("extracted_txt")).alias("text_sha"))
    return lag_over(rows, KEY, ["captured_at", "capture_id"], ["text_sha"]).where("text_sha = prior_text_sha").select("capture_id", "source_id", "target")


def blob_name(stored_as: Column, sha: Column) -> Column:
    """K-04: content address of the stored bytes; HTML is served as text."""
    ext = F.regexp_extract(stored_as, "raw(.*)$", 1)
    return F.concat(sha, ext, F.when(ext == ".html", ".txt").otherwise(""))


def newest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """W-05, A-11: the newest row of each key."""
    return last_of(df, keys, order)
