"""Readers of a ledger's files (S-01 to S-15): tolerant, as the files are.

Unreadable files and lines are skipped or marked, never fatal, unless a reader
says so.  Paths may be globs.  An empty folder gives an empty table.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provlake.operators.ordered import numbered

MANIFEST = """source_id string, provider string, model string, target_kind string, sha256 string, size_bytes bigint, stored_as string, text_sha256 string, doc_links_sha256 string,
extraction_notes array<string>, http struct<url:string,final_url:string,status_code:int,content_type:string,etag:string,last_modified:string,content_length:string,fetched_at:string,rendered:boolean,consent_nodes_removed:int,consent_dismissed:boolean,frames_captured:array<string>>,
prior_sha256 string, extracted_text_sha256 string, wayback struct<ok:boolean,status_code:int,snapshot:string,at:string,fresh:boolean,error:string,answered:boolean>, wayback_attempts array<struct<ok:boolean,status_code:int,at:string,answered:boolean,superseded:boolean,error:string>>,
ots struct<ok:boolean,calendars:array<string>,at:string,restamped_at:string,note:string>, git_commit string, git_path string, git_blob_sha string"""

EVENT = """ts string, source string, target string, url string, kind string, outcome string, sha256 string, text_sha256 string, dir string, absence string, confirmed_by array<string>, witness struct<saw:boolean,reason:string>,
observations array<struct<status_code:int,headers:string,error:string,ts:string>>, status_code int, error string, vantage string, reason string, survives_in string"""


def is_object(json: Column) -> Column:
    """Readable JSON that is an object; a reader of one field alone would not notice broken text."""
    return F.ltrim(json).startswith("{") & F.coalesce(F.try_parse_json(json).isNotNull(), F.lit(False))


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """S-01: manifests below captures/<source>/<target>/<stamp>/, with the keys of their paths; invalid ones skipped."""
    texts = spark.read.text(f"{root}/captures/*/*/*/manifest.json", wholetext=True)
    whole = texts.where(is_object(F.col("value")))
    return whole.select(F.regexp_extract(F.col("_metadata.file_path"), r"(captures/[^/]+/[^/]+/[^/]+)/manifest\.json$", 1).alias("capture_dir"), F.from_json("value", MANIFEST).alias("m")).select("capture_dir", "m.*")


def raw_files(spark: SparkSession, root: str) -> DataFrame:
    """S-02: stored bytes with their length; the content is read only where it is asked for."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", "raw.*").option("recursiveFileLookup", True).load(f"{root}/captures")
    return df.select(F.regexp_extract("path", r"(captures/[^/]+/[^/]+/[^/]+)/[^/]+$", 1).alias("capture_dir"), F.regexp_extract("path", "([^/]+)$", 1).alias("stored_as"), "length", "content")


def extracted_texts(spark: SparkSession, root: str) -> DataFrame:
    """S-03: extracted texts with one kind of line end."""
    df = spark.read.option("pathGlobFilter", "extracted.txt").option("recursiveFileLookup", True).text(f"{root}/captures", wholetext=True)
    return df.select(F.regexp_extract(F.col("_metadata.file_path"), r"(captures/[^/]+/[^/]+/[^/]+)/[^/]+$", 1).alias("capture_dir"), F.regexp_replace("value", "\r\n?", "\n").alias("text"))


def event_log(spark: SparkSession, path: str) -> DataFrame:
    """S-04: lines of one file in order with their number; lines that are no JSON object keep a null event.

    A line's number is its place in its block of the file plus the lines of the
    blocks before it, so nothing is sorted or moved.
    """
    rows = numbered(spark.read.text(path).withColumnRenamed("value", "line"), "seq")
    return rows.select("seq", "line", F.when(is_object(F.col("line")), F.from_json("line", EVENT)).alias("e"))


def state_versions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S-05: (targets, versions) of the index; versions are numbered in order."""
    shape = "map<string,struct<last_sha256:string,last_text_sha256:string,last_capture:string,managed:string,retired:string,versions:array<struct<sha256:string,dir:string>>>>"
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", shape)).alias("state_key", "s"))
    keyed = whole.select("state_key", F.substring_index("state_key", "::", 1).alias("source_id"), F.substring_index("state_key", "::", -1).alias("target"), "s.*")
    return keyed.drop("versions"), keyed.select("source_id", "target", F.posexplode("versions").alias("ord", "v")).select("source_id", "target", "ord", "v.sha256", "v.dir")


def registry(spark: SparkSession, path: str) -> DataFrame:
    """S-06: sources with their targets."""
    shape = "sources array<struct<id:string,provider:string,model:string,status:string,note:string,targets:array<struct<kind:string,url:string,note:string,render:boolean,inpage:boolean>>,retired:string,restricted:string>>"
    return spark.read.schema(shape).option("multiLine", True).json(path).select(F.inline("sources")).withColumnRenamed("id", "source_id")


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def _yaml(content: pd.Series) -> pd.Series:
    try:
        import yaml
    except ImportError:  # no YAML reader here
        return pd.Series([None] * len(content))

    def read(raw):
        try:
            doc = yaml.safe_load(bytes(raw).decode("utf-8"))
        except Exception:  # noqa: BLE001: unreadable files are skipped
            return None
        return {str(k): None if v is None else str(v) for k, v in doc.items() if not isinstance(v, (dict, list))} if isinstance(doc, dict) else None

    return content.map(read)


def yaml_headers(spark: SparkSession, glob: str) -> DataFrame:
    """S-07: scalar fields at the top of YAML files; null for files that are none."""
    return spark.read.format("binaryFile").load(glob).select("path", _yaml("content").alias("fields"))


def flat_field(text: Column, name: str) -> Column:
    """S-08: a top-level field of a YAML text without a parser; empty if absent."""
    return F.regexp_extract(text, rf'(?m)^{name}:\s*"?(.*?)"?\s*$', 1)


def batch_lines(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """S-09: a tab-separated batch; a line with another number of fields stops the read."""
    parts = F.split("value", "\t")
    checked = F.when(F.size(parts) == len(fields), parts).otherwise(F.raise_error(F.concat(F.lit("wrong number of fields: "), "value")))
    return spark.read.text(path).where("trim(value) <> '' and not startswith(value, '#')").select(checked.alias("p")).select(*[F.trim(F.col("p")[k]).alias(f) for k, f in enumerate(fields)])


def locations(xml: Column, most: int = 500) -> Column:
    """S-10: <loc> entries of a sitemap or listing, in order, each once, at most so many."""
    return F.array_distinct(F.slice(F.regexp_extract_all(xml, F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1)), 1, most))


def embedded_editions(page: Column, series: str) -> Column:
    """S-11: (url, period) of the objects in one series of a page's embedded JSON, whatever the order of their keys."""
    mark = f'"series_title":"{series}"'
    segment = F.substring_index(F.when(F.contains(page, F.lit(mark)), F.substring_index(page, mark, -1)), '"series_title"', 1)
    objects = F.regexp_extract_all(segment, F.lit(r'(\{[^{}]*"file_url"[^{}]*\})'), F.lit(1))
    url = lambda o: F.replace(F.regexp_extract(o, r'"file_url":"(https:[^"]+)"', 1), F.lit("\\/"), F.lit("/"))
    period = lambda o: F.regexp_replace(F.regexp_extract(o, r'"period":"([^"]*)"', 1), r"\\u2013|–|—", "-")
    return F.filter(F.transform(objects, lambda o: F.struct(url(o).alias("url"), period(o).alias("period"))), lambda e: e["url"] != "")


def dated_links(page: Column, base: Column) -> Column:
    """S-12: absolute links to dated versions of a page, on its own host, in order and each once."""
    host = F.regexp_extract(base, "^([a-z]+://[^/]+)", 1)
    hrefs = F.regexp_extract_all(page, F.lit(r"""href=["']([^"']*version-\d{4}-\d{2}-\d{2}[^"']*)["']"""), F.lit(1))
    joined = F.transform(hrefs, lambda h: F.when(h.rlike("^[a-z]+://"), h).when(F.startswith(h, F.lit("/")), F.concat(host, h)).otherwise(F.concat(F.regexp_replace(base, "[^/]*$", ""), h)))
    return F.array_distinct(F.filter(joined, lambda u: F.startswith(u, F.concat(host, F.lit("/")))))


def signed_links(page: Column, host: str) -> Column:
    """S-13: (url, key) of links to one host; the key is the URL without its query."""
    found = F.regexp_extract_all(F.replace(page, F.lit("&amp;"), F.lit("&")), F.lit(rf"""(https://{host.replace('.', chr(92) + '.')}/[^\s"'<>]+)"""), F.lit(1))
    return F.transform(F.array_distinct(found), lambda u: F.struct(u.alias("url"), F.substring_index(u, "?", 1).alias("key")))


def commit_walk(commits: DataFrame, truncated: Column | None = None) -> DataFrame:
    """S-14: commits of several paths, each once, oldest first; a truncated listing stops the read."""
    seen = commits.dropDuplicates(["sha"]).orderBy("author_date", "sha")
    return seen if truncated is None else seen.where(F.assert_true(~truncated, "truncated listing").isNull())


def recent(listing: DataFrame, created: str, now: Column, days: int) -> DataFrame:
    """S-15: entries made within so many days; unreadable dates are left out."""
    return listing.where(F.col(created).try_cast("timestamp") >= now - F.make_interval(days=F.lit(days)))


