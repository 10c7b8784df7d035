"""Integrity of a corpus and of its published pages (V-C1 to V-C11, L1 to L20).

Every check gives rows (check, key, message); a corpus is sound if there are
none.  An empty table is sound.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.functions import hashing, text
from provlake.operators import versions
from provlake.operators.ordered import lag_over
from provlake.operators.references import clean_dir


def finding(df: DataFrame, check: str, key: Column, message: Column | str) -> DataFrame:
    return df.select(F.lit(check).alias("check"), key.cast("string").alias("key"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def bytes_match(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """V-C1: stored bytes are those of the manifest, in hash and size, and there."""
    f = files.select("capture_dir", "stored_as", F.length("content").alias("n"), hashing.sha256_hex(F.col("content")).alias("sha"))
    m = manifest.join(f, ["capture_dir", "stored_as"], "left")
    why = F.when(F.col("sha").isNull(), "file missing").when(F.col("sha") != F.lower("sha256"), "other bytes").when(F.col("n") != F.col("size_bytes"), "other size")
    return finding(m.withColumn("why", why).where("why is not null"), "C1", F.col("capture_dir"), F.col("why"))


def proofs_match(manifest: DataFrame, proofs: DataFrame) -> DataFrame:
    """V-C2: a claimed proof is there and of these bytes, and no proof is without a capture.

    proofs: capture_dir, digest (null where the proof cannot be read).
    """
    claimed = manifest.where("coalesce(ots.ok, false)").select("capture_dir", F.lower("sha256").alias("sha")).join(proofs.select("capture_dir", F.lit(True).alias("held"), "digest"), "capture_dir", "left")
    why = F.when(F.col("held").isNull(), "proof missing").when(F.col("digest").isNull(), "proof unreadable").when(F.col("digest") != F.col("sha"), "proof of other bytes")
    orphan = proofs.join(manifest, "capture_dir", "left_anti")
    return finding(claimed.withColumn("why", why).where("why is not null"), "C2", F.col("capture_dir"), F.col("why")).unionByName(finding(orphan, "C2", F.col("capture_dir"), "orphan proof"))


def index_matches(state: DataFrame, captures: DataFrame) -> DataFrame:
    """V-C3: directories of the index and of the table, each way."""
    indexed = versions.index_versions(state).select(clean_dir(F.col("dir")).alias("d")).where("d is not null").distinct()
    stored = captures.select(clean_dir(F.col("capture_dir")).alias("d")).where("d is not null").distinct()
    return finding(indexed.join(stored, "d", "left_anti"), "C3", F.col("d"), "indexed, not stored").unionByName(finding(stored.join(indexed, "d", "left_anti"), "C3", F.col("d"), "stored, not indexed"))


def prunes_explained(log: DataFrame) -> DataFrame:
    """V-C4: lines that prune name a time, the bytes and a directory."""
    p = log.dropDuplicates(["seq"]).where("lower(outcome) like 'pruned%' and (ts is null or sha256 is null or dir is null)")
    return finding(p, "C4", F.col("seq"), "bare prune")


def texts_match(manifest: DataFrame, captures: DataFrame) -> DataFrame:
    """V-C5: the manifest's text hash is that of the text; a text has a hash."""
    m = versions.once(manifest).select("capture_dir", F.lower("text_sha256").alias("h"))
    c = captures.select("capture_dir", hashing.canonical_sha(F.col("extracted_txt")).alias("t")).join(m, "capture_dir")
    why = F.when(F.col("t").isNotNull() & F.col("h").isNull(), "text without hash").when(F.col("t") != F.col("h"), "other text")
    return finding(c.withColumn("why", why).where("why is not null"), "C5", F.col("capture_dir"), F.col("why"))


def tails_match(state: DataFrame) -> DataFrame:
    """V-C6: the tail pointers of a target are those of its last version."""
    s = state.where("size(versions) > 0").select("state_key", "last_sha256", clean_dir(F.col("last_capture")).alias("tail"), F.try_element_at("versions", F.lit(-1)).alias("v"))
    why = F.when(~F.col("last_sha256").eqNullSafe(F.col("v.sha256")), "other hash").when(~F.col("tail").eqNullSafe(clean_dir(F.col("v.dir"))), "other directory")
    return finding(s.withColumn("why", why).where("why is not null"), "C6", F.col("state_key"), F.col("why"))


def without_versions(state: DataFrame) -> DataFrame:
    """V-C7: targets without any version."""
    return finding(state.where("coalesce(size(versions), 0) <= 0"), "C7", F.col("state_key"), "no versions")


def in_order(state: DataFrame) -> DataFrame:
    """V-C10: versions stand in the order of their capture."""
    v = versions.index_versions(state).withColumn("stamp", F.regexp_extract("dir", r"(\d{8}T\d{6}Z)", 1))
    return finding(lag_over(v, versions.KEY, ["ord"], ["stamp"]).where("stamp < prior_stamp"), "C10", F.col("dir"), "out of order")


def verify(state: DataFrame, captures: DataFrame, manifest: DataFrame, log: DataFrame) -> DataFrame:
    """All checks that tables allow."""
    parts = [index_matches(state, captures), prunes_explained(log), texts_match(manifest, captures), tails_match(state), without_versions(state), in_order(state)]
    return reduce(DataFrame.unionByName, parts)


def lint_pages(pages: DataFrame, blobs: DataFrame | None = None) -> DataFrame:
    """L1, L2, L6, L7, L10, L12, L13: pages (path, title, description, html) that should not be published."""
    links = pages.select("path", F.explode(F.regexp_extract_all("html", F.lit(r"""href=["'](/[^"'#?]*)"""), F.lit(1))).alias("to")).distinct()
    dead = links.join(pages.select(F.col("path").alias("to")), "to", "left_anti")
    twice = pages.groupBy("title").agg(F.count("*").alias("n"), F.min("path").alias("path")).where("n > 1")
    prose = F.regexp_replace("html", r"(?s)<pre class='extract'>.*?</pre>", "")
    parts = [
        finding(dead, "L1", F.col("path"), F.concat(F.lit("dead link "), "to")),
        finding(pages.where(text.is_mojibake(prose)), "L2", F.col("path"), "broken characters"),
        finding(pages.where(prose.rlike(r"\{[a-z_]+\}|<class '|Traceback \(most recent")), "L6", F.col("path"), "placeholder"),
        finding(twice, "L7", F.col("path"), "title not unique"),
        finding(pages.where(~F.col("html").contains("rel=\"canonical\"")), "L12", F.col("path"), "no canonical link"),
        finding(pages.where("coalesce(description, '') = ''"), "L13", F.col("path"), "no description"),
    ]
    if blobs is not None:
        parts.append(finding(blobs.where(F.endswith("name", F.lit(".html"))), "L10", F.col("name"), "executable page"))
    return reduce(DataFrame.unionByName, parts)


def require_empty(df: DataFrame, message: str) -> DataFrame:
    """A fail-closed assertion: the read stops at the first row."""
    return df.where(F.raise_error(F.lit(message)).isNull())
