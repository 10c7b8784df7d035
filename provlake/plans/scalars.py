"""Queries of the scalar operators: hashing, text, URLs, times."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import hashing, text, times, urls
from provlake.plans.book import Book

book = Book()

#: Whitespace as Python splits on it, for RE2.
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"


def collapsed(column: str) -> str:
    return f"trim(regexp_replace({column}, '{WS}', ' ', 'g'))"


TARGETS = "(select source_id, provider, model, status, retired, unnest(targets, recursive := true) from registry)"
RULES = [("captures/a", True, (".pdf",), "archive"), ("manifest-", True, (".jsonl",), "manifest"), ("eval-", True, (".jsonl", ".json"), "evaluation"), ("", False, (".yaml",), "flat")]


def targets(t):
    """Registry targets, one row each."""
    return t("registry").select("source_id", "provider", "model", "status", "retired", F.inline("targets"))


def page_of(url):
    """A small page that links to a document, its copy and another page."""
    return F.concat(F.lit('<html><head><style>p {}</style></head><body><p>See <a href="'), url, F.lit('.PDF?v=1">the file</a> or <a class="x" href="'), url, F.lit('/annex.zip#top">annex</a>,\n<a href="'), url, F.lit('">page</a> &amp; more</p><script>var a = 1;</script></body></html>'))


PAGE = """'<html><head><style>p {}</style></head><body><p>See <a href="' || url || '.PDF?v=1">the file</a> or <a class="x" href="' || url || '/annex.zip#top">annex</a>,' || chr(10) || '<a href="' || url || '">page</a> &amp; more</p><script>var a = 1;</script></body></html>'"""


@book.add("select doc_id, sha256(text) as sha from documents")
def doc_raw_sha256(t):
    return t("documents").select("doc_id", hashing.sha256_hex(F.col("text")).alias("sha"))


@book.add(f"select doc_id, sha256({collapsed('text')}) as sha from documents")
def doc_canonical_sha(t):
    return t("documents").select("doc_id", hashing.canonical_sha(F.col("text")).alias("sha"))


@book.add(f"select source_id, url, kind || '-' || substr(sha256(url), 1, 8) as slug from {TARGETS}")
def target_slug(t):
    return targets(t).select("source_id", "url", hashing.target_slug(F.col("kind"), F.col("url")).alias("slug"))


@book.add(
    f"""with p as (select source_id, kind, url, [x for x in regexp_extract_all({PAGE}, '(?i)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1)
    if regexp_matches(lower(split_part(split_part(x, '?', 1), '#', 1)), '\\.(pdf|docx|doc|zip|md|txt|json)$')] as l from {TARGETS})
    select source_id, kind, url, case when len(l) > 0 then sha256(array_to_string(list_sort(list_distinct(l)), chr(10))) end as links_sha from p"""
)
def link_fingerprint(t):
    return targets(t).select("source_id", "kind", "url", hashing.links_sha(page_of(F.col("url"))).alias("links_sha"))


@book.add(
    """with m as (select source_id, list_sort(list(distinct {'a': stored_as, 'b': sha256})) as m from captures where stored_as is not null and sha256 is not null group by 1)
    select source_id, sha256('[' || array_to_string([ '["' || x.a || '", "' || x.b || '"]' for x in m ], ', ') || ']') as member_key from m"""
)
def source_member_key(t):
    m = t("captures").where("stored_as is not null and sha256 is not null").groupBy("source_id").agg(F.collect_set(F.struct(F.col("stored_as").alias("inner_file"), F.col("sha256").alias("inner_sha256"))).alias("m"))
    return m.select("source_id", hashing.member_key(F.col("m")).alias("member_key"))


@book.add(f"select source_id, url, substr(sha256(coalesce(source_id,'')||'|'||coalesce(provider,'')||'|'||coalesce(model,'')||'|'||coalesce(url,'')), 1, 16) as key from {TARGETS}")
def candidate_key(t):
    return targets(t).select("source_id", "url", hashing.candidate_key(*map(F.col, ("source_id", "provider", "model", "url"))).alias("key"))


@book.add(
    "with h as (select distinct url, sha256(url) as h from check_log where url is not null) select url, (('0x' || substr(h, 1, 4))::bigint % 7 + ('0x' || substr(h, 5, 15))::bigint % 7 + ('0x' || substr(h, 20, 15))::bigint % 7"
    " + ('0x' || substr(h, 35, 15))::bigint % 7 + ('0x' || substr(h, 50, 15))::bigint % 7) % 7 as bucket from h"
)
def weekly_full_fetch_bucket(t):
    return t("check_log").where("url is not null").select("url").distinct().select("url", hashing.week_bucket(F.col("url")).alias("bucket"))


_NORM = r"regexp_replace(regexp_replace(regexp_replace(array_to_string([regexp_replace(x, '[\s\x0b\x1c-\x1f\x85\p{Z}]+$', '') for x in string_split(regexp_replace(replace(replace(replace(replace(replace(replace(replace(extracted_txt,'ﬀ','ff'),'ﬁ','fi'),'ﬂ','fl'),'ﬃ','ffi'),'ﬄ','ffl'),'ﬆ','st'),'ﬅ','st'), '\r\n?', chr(10), 'g'), chr(10))], chr(10)), '\n{3,}', chr(10)||chr(10), 'g'), '^[\s\x0b\x1c-\x1f\x85\p{Z}]+', ''), '[\s\x0b\x1c-\x1f\x85\p{Z}]+$', '') || chr(10)"


@book.add(f"select capture_id, {_NORM} as normalized from captures")
def normalize_text(t):
    return t("captures").select("capture_id", text.normalize(F.col("extracted_txt")).alias("normalized"))


@book.add(
    f"select source_id, kind, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace({PAGE}, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<noscript\\b.*?</noscript\\s*>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '<[^>]*>', chr(10), 'g'), '\\n\\s*', chr(10), 'g') as page_text from {TARGETS}"
)
def html_text_regex(t):
    return targets(t).select("source_id", "kind", "url", text.html_text_rx(page_of(F.col("url"))).alias("page_text"))


@book.add()
def html_text_parser(t):
    return targets(t).select("source_id", "kind", "url", text.html_text(page_of(F.col("url"))).alias("page_text"))


_WORDS = r"regexp_extract_all(replace(replace(replace(replace(replace(replace(replace(nfc_normalize(regexp_replace(text, '(?m)^=====.*=====$', '', 'g')),'ﬀ','ff'),'ﬁ','fi'),'ﬂ','fl'),'ﬃ','ffi'),'ﬄ','ffl'),'ﬆ','st'),'ﬅ','ft'), '[☒☑✓✔■☐□▢✗✘]|[\p{L}\p{N}_€%.\-/:@,]+')"
_IDENTITY = r"regexp_replace(regexp_replace(regexp_replace(translate(array_to_string(w, ' '), '☒☑✓✔■☐□▢✗✘', '⊠⊠⊠⊠⊠⊡⊡⊡⊗⊗'), '(\p{Nd})[.,](\p{Nd})', '\1·\2', 'g'), '(\p{Nd})[.,](\p{Nd})', '\1·\2', 'g'), '[^\p{L}\p{N}_⊠⊡⊗·]', '', 'g')"


@book.add(f"with x as (select doc_id, {_WORDS} as w from documents) select doc_id, len(w) as n_words, sha256({_IDENTITY}) as identity_sha from x")
def words_and_identity(t):
    w = t("documents").select("doc_id", text.words_of(F.col("text")).alias("w"))
    return w.select("doc_id", F.size("w").cast("bigint").alias("n_words"), F.sha2(text.identity(F.col("w")), 256).alias("identity_sha"))


@book.add("select doc_id, substr(regexp_replace(lower(text), '[^a-z0-9]', '', 'g'), 1, 20000) as stream from documents")
def char_stream_fingerprint(t):
    return t("documents").select("doc_id", text.char_stream(F.col("text")).alias("stream"))


@book.add("select source_id, array_to_string([x for x in string_split_regex(lower(model), '[^0-9a-z]+') if x <> ''], ' ') as tokens from registry")
def name_tokens(t):
    return t("registry").select("source_id", F.array_join(text.name_tokens(F.col("model")), " ").alias("tokens"))


@book.add(
    """with x as (select source_id, [x for x in string_split_regex(lower(model), '[^0-9a-z]+') if x <> ''] as t from registry), y as (
    select source_id, case when len(t) = 0 then [] else [array_to_string(t,'-'), array_to_string(t,'_'), array_to_string(t,''), array_to_string(t,'.'),
      case when len(t) > 1 then regexp_replace(array_to_string(t,'-'), '-', '') else array_to_string(t,'') end] end as v from x)
    select source_id, v[1] as dashed, len(list_distinct(v)) as n_variants, array_to_string(list_sort(list_distinct(v)), ' ') as variants from y"""
)
def slug_variants(t):
    v = t("registry").select("source_id", text.slug_variants(F.col("model")).alias("v"))
    return v.select("source_id", F.get("v", F.lit(0)).alias("dashed"), F.size("v").cast("bigint").alias("n_variants"), F.array_join(F.array_sort("v"), " ").alias("variants"))


@book.add(f"with x as (select doc_id, lower({collapsed('text')}) as t from documents) select doc_id, " + (_N := " + ".join(f"contains(t, '{m}')::bigint" for m in text.TEMPLATE_MARKERS)) + " as n_markers, " + _N + " >= 2 and (" + " or ".join(f"contains(t, '{m}')" for m in text.DISTINCTIVE_MARKERS) + ") as is_summary from x")
def marker_count(t):
    """T-15."""
    return t("documents").select("doc_id", text.marker_count(F.col("text")).alias("n_markers"), text.is_summary(F.col("text")).alias("is_summary"))


@book.add(
    r"""with x as (select feed, file_no, rec_no, case when trim(coalesce(body->>'$.evaluation_date','')) in ('None','null') then '' else trim(coalesce(body->>'$.evaluation_date','')) end as v from raw_record)
    select feed, file_no, rec_no, case when regexp_matches(v, '^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2})?$') then substr(v, 1, 10) else v end as evaluated from x"""
)
def yaml_scalar(t):
    return t("raw_record").select("feed", "file_no", "rec_no", text.yaml_scalar(F.get_json_object("body", "$.evaluation_date")).alias("evaluated"))


@book.add("select source_id, translate(lower(model), '_. ', '---') as slug, regexp_replace(lower(model), '[^\\p{L}\\p{N}]', '', 'g') as folded, regexp_replace(regexp_replace(lower(provider), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as dashed from registry")
def slugify(t):
    return t("registry").select("source_id", text.slugify(F.col("model")).alias("slug"), text.alnum(F.col("model")).alias("folded"), text.dashed(F.col("provider")).alias("dashed"))


@book.add(
    r"""with x as (select source_id, provider, model, translate(lower(provider || ' ' || model), '_. ', '---') as slug, translate(lower(provider), '_. ', '---') as owner from registry),
    y as (select *, substr(slug, length(owner) + 2) as rest from x) select source_id, case when starts_with(slug, owner || '-') and ((rest = owner or starts_with(rest, owner || '-')) or
      not starts_with(regexp_replace(lower(model), '[^\p{L}\p{N}]', '', 'g'), regexp_replace(owner, '[^\p{L}\p{N}]', '', 'g'))) then rest else slug end as slug from y"""
)
def owner_prefix_drop(t):
    r = t("registry").select("source_id", "model", text.slugify(F.concat_ws(" ", "provider", "model")).alias("slug"), text.slugify(F.col("provider")).alias("owner"))
    return r.select("source_id", text.without_owner(F.col("slug"), F.col("owner"), F.col("model")).alias("slug"))


@book.add(
    r"""with x as (select source_id, 'On this:' || chr(10) || case when status = 'published' then '/approve id=' || source_id || ' ' || coalesce(note, 'fine') when status = 'missing' then ' /Reject ' || coalesce(note, '') else 'no command' end || chr(10) || '/reject later' as c from registry where status <> 'watch'),
    y as (select source_id, lower(regexp_extract(c, '(?im)^\s*/(approve|reject)\b[ \t]*(.*)$', 1)) as a, trim(regexp_extract(c, '(?im)^\s*/(approve|reject)\b[ \t]*(.*)$', 2)) as r from x)
    select source_id, nullif(a, '') as action, nullif(regexp_extract(r, '(?i)^id=(\S+)\s*(.*)$', 1), '') as ident, case when a = '' then null when regexp_matches(r, '(?i)^id=\S+') then trim(regexp_extract(r, '(?i)^id=(\S+)\s*(.*)$', 2)) else r end as note from y"""
)
def command_parse(t):
    line = F.when(F.col("status") == "published", F.concat(F.lit("/approve id="), "source_id", F.lit(" "), F.coalesce("note", F.lit("fine")))).when(F.col("status") == "missing", F.concat(F.lit(" /Reject "), F.coalesce("note", F.lit("")))).otherwise("no command")
    c = t("registry").where("status <> 'watch'").select("source_id", text.command(F.concat(F.lit("On this:\n"), line, F.lit("\n/reject later"))).alias("c"))
    return c.select("source_id", "c.action", "c.ident", "c.note")


@book.add("select source_id, kind, url, url as found_url, provider as found_provider from " + TARGETS)
def fenced_candidates(t):
    block = F.concat(F.lit("Report\n```json\n"), F.to_json(F.array(F.struct("url", "provider"))), F.lit("\n```\n"))
    found = targets(t).select("source_id", "kind", "url", F.element_at(text.fenced_json(block, "array<struct<url:string,provider:string>>"), 1).alias("c"))
    return found.select("source_id", "kind", "url", F.col("c.url").alias("found_url"), F.col("c.provider").alias("found_provider"))


@book.add("select capture_id, 2 as n_members, stored_as as last_name, length(replace(extracted_txt, '=====', '-----'))::bigint + length(source_id) as n_chars from captures where extracted_txt is not null and stored_as is not null")
def archive_members(t):
    banner = lambda c: F.concat(F.lit("===== "), c, F.lit(" =====\n"))
    whole = F.concat(banner(F.col("sha256")), F.replace("extracted_txt", F.lit("====="), F.lit("-----")), F.lit("\n"), banner(F.col("stored_as")), "source_id")
    m = t("captures").where("extracted_txt is not null and stored_as is not null").select("capture_id", text.members_text(F.coalesce(whole, F.lit(""))).alias("m"))
    chars = F.aggregate("m", F.lit(0), lambda n, x: n + F.length(F.regexp_replace(x["text"], r"\A\n|\n\z", "")))
    return m.select("capture_id", F.size("m").alias("n_members"), F.try_element_at("m", F.lit(-1))["name"].alias("last_name"), chars.cast("bigint").alias("n_chars"))


@book.add("select doc_id from documents where regexp_matches(text, 'â€|Ã¢|Ã©|Ã¨|�')")
def mojibake_rows(t):
    return t("documents").where(text.is_mojibake(F.col("text"))).select("doc_id")


@book.add(
    "select source_id, replace(replace(replace(replace(replace(coalesce(note, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') as note,"
    " case when regexp_matches(trim(url), '^(https?://|/|#|mailto:)') and not starts_with(trim(url), '//') then replace(trim(url), '&', '&amp;') else '#' end as href from " + TARGETS
)
def escaped(t):
    return targets(t).select("source_id", text.escape_html(F.col("note")).alias("note"), text.safe_href(F.col("url")).alias("href"))


@book.add(f"select doc_id, len([x for x in string_split_regex(text, '{WS}') if x <> '']) as n_words from documents")
def word_count(t):
    return t("documents").select("doc_id", text.word_count(F.col("text")).alias("n_words"))


@book.add("select distinct capture_dir, array_to_string([n for n in extraction_notes if not contains(n, 'text_sha256') and not contains(n, 'stable')], '; ') as notes from manifest")
def reader_notes(t):
    return t("manifest").select("capture_dir", F.array_join(text.public_notes(F.col("extraction_notes"), ["text_sha256", "stable"]), "; ").alias("notes")).distinct()


@book.add(
    r"""with x as (select distinct capture_dir, 'https://web.archive.org/web/' || regexp_replace(regexp_extract(wayback.snapshot, '(\d{8}T\d{6})Z?', 1), 'T', '') || case when http.status_code = 200 then 'id_' else '' end || '/' || http.url as u from manifest)
    select capture_dir, nullif(regexp_extract(u, '^https://web\.archive\.org/web/(\d{14})(?:id_|if_|im_)?/(.+)$', 1), '') as stamp, nullif(regexp_extract(u, '^https://web\.archive\.org/web/(\d{14})(?:id_|if_|im_)?/(.+)$', 2), '') as archived from x"""
)
def snapshot_parts(t):
    stamp = F.replace(F.regexp_extract("wayback.snapshot", r"(\d{8}T\d{6})Z?", 1), F.lit("T"))
    u = F.concat(F.lit("https://web.archive.org/web/"), stamp, F.when(F.col("http.status_code") == 200, "id_").otherwise(""), F.lit("/"), F.col("http.url"))
    return t("manifest").select("capture_dir", text.snapshot_parts(u).alias("p")).distinct().select("capture_dir", "p.stamp", "p.archived")


_BY_TYPE = "case lower(trim(split_part(coalesce(http.content_type, ''), ';', 1))) " + " ".join(f"when '{k}' then '{v}'" for k, v in text.SUFFIX_OF_TYPE.items()) + " end"
_BY_URL = "coalesce(" + ", ".join(f"case when ends_with(lower(split_part(coalesce(http.url, ''), '?', 1)), '{s}') then '{s}' end" for s in text.URL_SUFFIXES) + ")"


@book.add(
    f"select distinct capture_dir, coalesce(case when not (lower(trim(split_part(coalesce(http.content_type, ''), ';', 1))) in ('text/plain', 'application/octet-stream') and {_BY_URL} is not null) then {_BY_TYPE} end, {_BY_URL}, '.bin') as file_type from manifest"
)
def file_type(t):
    return t("manifest").select("capture_dir", text.file_type(F.col("http.content_type"), F.col("http.url")).alias("file_type")).distinct()


@book.add(
    r"""with x as (select capture_id, regexp_extract(stored_as, '(\..*)$', 1) as e from captures) select capture_id, case when e in ('.pdf', '.zip') then 'pdf reader' when e = '.html' then 'html parser'
    when e in ('.md', '.txt', '.json') then 'utf-8 decode' else 'no extractor for ' || case when e = '' then 'this format' else e end end as extractor from x"""
)
def extractor_label(t):
    return t("captures").select("capture_id", text.extractor(F.col("stored_as")).alias("extractor"))


@book.add(
    r"""with x as (select distinct source_id, regexp_extract(note, '(?i)lab', 0) as hit, provider, model from registry) select source_id, regexp_extract('organization: "' || provider || '"' || chr(10) || 'model_name:  ' || model, '(?m)^organization:\s*"?(.*?)"?\s*$', 1) as organization,
    regexp_extract('organization: "' || provider || '"' || chr(10) || 'model_name:  ' || model, '(?m)^model_name:\s*"?(.*?)"?\s*$', 1) as model_name from x"""
)
def flat_fields(t):
    from provlake.sources.readers import flat_field

    doc = F.concat(F.lit('organization: "'), "provider", F.lit('"\nmodel_name:  '), "model")
    return t("registry").select("source_id", flat_field(doc, "organization").alias("organization"), flat_field(doc, "model_name").alias("model_name"))


# ---- URLs ------------------------------------------------------------------

_DIRTY = "'  ' || regexp_replace(url, '^https://', '') || '?utm_source=x&b=2&FBCLID=9&a=1 '"
DIRTY = lambda: F.concat(F.lit("  "), F.regexp_replace("url", "^https://", ""), F.lit("?utm_source=x&b=2&FBCLID=9&a=1 "))


@book.add(
    f"""with x as (select source_id, kind, url, trim({_DIRTY}) as u from {TARGETS}), y as (select *, array_to_string([k for k in string_split(substr(u, instr(u, '?') + 1), '&') if lower(split_part(k, '=', 1)) not in ({', '.join(repr(p) for p in urls.TRACKING)})], '&') as q from x)
    select source_id, kind, 'https://' || split_part(u, '?', 1) || case when q <> '' then '?' || q else '' end as normalized from y"""
)
def url_normalize(t):
    return targets(t).select("source_id", "kind", urls.normalize_url(DIRTY()).alias("normalized"))


_IDENT = "regexp_replace(regexp_replace(lower(trim(split_part(split_part(coalesce(http.final_url, ''), '?', 1), '#', 1))), '^https?://', ''), '/+$', '')"


@book.add(f"select distinct capture_dir, {_IDENT} as ident from manifest")
def url_identity(t):
    return t("manifest").select("capture_dir", urls.url_identity(F.col("http.final_url")).alias("ident")).distinct()


@book.add("select distinct capture_dir, regexp_replace(coalesce(http.url, ''), '/+$', '') = regexp_replace(url_decode(replace(coalesce(http.final_url, ''), '+', '%2B')), '/+$', '') as same from manifest")
def same_url(t):
    return t("manifest").select("capture_dir", urls.same_url(F.col("http.url"), F.col("http.final_url")).alias("same")).distinct()


@book.add("select distinct url, lower(regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1)) as host from check_log where url is not null")
def url_host(t):
    return t("check_log").where("url is not null").select("url", urls.host_of(F.col("url")).alias("host")).distinct()


@book.add(
    r"""select distinct source_id, url, starts_with(url, 'https://') and (regexp_extract(url, '^https://(?:www\.)?([^/:?#]*)', 1) = dom or ends_with(regexp_extract(url, '^https://(?:www\.)?([^/:?#]*)', 1), '.' || dom)) as same
    from (select source_id, url, regexp_replace(translate(lower(provider), '_. ', '---'), '[^a-z0-9-]', '', 'g') || '.example' as dom from """ + TARGETS + ")"
)
def same_site(t):
    dom = F.concat(F.regexp_replace(text.slugify(F.col("provider")), "[^a-z0-9-]", ""), F.lit(".example"))
    return targets(t).select("source_id", "url", urls.same_site(F.col("url"), dom).alias("same")).distinct()


@book.add(
    "with x as (select distinct regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1)), '^www\\.', '') as host from check_log where url is not null) select host, ends_with(host, '.example') or host = 'example' as below, contains(host, 'labs') or contains(host, 'research') as held from x"
)
def host_class(t):
    hosts = t("check_log").where("url is not null").select(urls.bare_host(urls.host_of(F.col("url"))).alias("host")).distinct()
    return hosts.select("host", urls.below_any(F.col("host"), ["example"]).alias("below"), urls.holds_any(F.col("host"), ["labs", "research"]).alias("held"))


@book.add()
def public_hosts(t):
    return t("check_log").where("url is not null").select(urls.host_of(F.col("url")).alias("host")).distinct().select("host", urls.public_host("host").alias("public"))


_SECRET = "'([?&](?:" + "|".join(urls.SECRET) + r")=)[^&\s]+'"


@book.add(
    f"""with x as (select distinct url || '?Signature=abcdef&_nc_cat=1&page=1&efg=' || substr(sha256(url), 1, 30) as u from check_log where url is not null), y as (select u, regexp_replace(u, {_SECRET}, '\\1…', 'g') as m from x), z as (select u, m, regexp_replace(m, '^.*?://', '') as s from y)
    select u, m as masked, case when length(s) <= 72 then s else substr(s, 1, 40) || '…' || right(s, 30) end as short, regexp_matches(u, '[?&](?:{"|".join(urls.SIGNING)})=') as signed from z"""
)
def masked_urls(t):
    x = t("check_log").where("url is not null").select(F.concat("url", F.lit("?Signature=abcdef&_nc_cat=1&page=1&efg="), F.substring(F.sha2("url", 256), 1, 30)).alias("u")).distinct()
    return x.select("u", urls.masked(F.col("u")).alias("masked"), urls.short_url(F.col("u")).alias("short"), urls.is_signed(F.col("u")).alias("signed"))


@book.add("select distinct capture_dir, lower(split_part(split_part(coalesce(http.final_url, ''), '#', 1), '?', 1)) || regexp_extract(split_part(coalesce(http.final_url, ''), '#', 1), '(\\?.*)$', 1) as claim from manifest")
def claim_key(t):
    return t("manifest").select("capture_dir", urls.claim_key(F.col("http.final_url")).alias("claim")).distinct()


@book.add("select distinct file_name, 'https://raw.example/repo/' || substr(sha256(feed), 1, 8) || '/' || replace(url_encode(file_name || ' copy'), '%2F', '/') as pinned from raw_record")
def pinned_url(t):
    return t("raw_record").select("file_name", urls.pinned_url(F.lit("https://raw.example/repo"), F.substring(F.sha2("feed", 256), 1, 8), F.concat("file_name", F.lit(" copy"))).alias("pinned")).distinct()


@book.add(
    r"""select file_name, case when starts_with(file_name, 'captures/a') and regexp_matches(lower(file_name), '\.pdf$') then 'archive' when starts_with(file_name, 'manifest-') and regexp_matches(lower(file_name), '\.jsonl$') then 'manifest'
    when starts_with(file_name, 'eval-') and regexp_matches(lower(file_name), '(\.jsonl|\.json)$') then 'evaluation' when regexp_matches(lower(file_name), '\.yaml$') and not contains(file_name, '/') then 'flat' end as grp from (select distinct file_name from raw_record)"""
)
def route_path(t):
    return t("raw_record").select("file_name").distinct().select("file_name", urls.route(F.col("file_name"), RULES).alias("grp"))


@book.add(
    r"""with r as (select distinct provider, url, array_to_string([x for x in string_split_regex(lower(model), '[^0-9a-z]+') if x <> ''], '-') as slug from """ + TARGETS + r"""),
    p as (select provider, slug as known, url from r where slug <> '' and contains(regexp_replace(url, '^[a-z]+://[^/]*', ''), slug)), m as (select distinct provider, slug from r)
    select distinct p.provider, p.url, m.slug, regexp_extract(p.url, '^([a-z]+://[^/]*)', 1) || replace(substr(p.url, length(regexp_extract(p.url, '^([a-z]+://[^/]*)', 1)) + 1), p.known, m.slug) as candidate from p join m on p.provider = m.provider and p.known <> m.slug and m.slug <> ''"""
)
def candidate_urls(t):
    """J-15, U-12: published URL patterns of a provider with the names of its other models."""
    r = targets(t).select("provider", "url", F.array_join(text.name_tokens(F.col("model")), "-").alias("slug")).distinct()
    p = r.where("slug <> ''").where(F.contains(F.regexp_replace("url", "^[a-z]+://[^/]*", ""), F.col("slug"))).select("provider", F.col("slug").alias("known"), "url")
    m = r.select("provider", "slug").where("slug <> ''").distinct()
    return p.join(m, "provider").where("known <> slug").select("provider", "url", "slug", urls.substituted(F.col("url"), F.col("known"), F.col("slug")).alias("candidate")).distinct()


@book.add(
    r"""select distinct url, case when regexp_matches(url, '(?i)\.(png|jpe?g|svg|gif|css|js|woff2?|ico|mp4|webm|zip)($|\?)') then 'skip' when regexp_matches(url, '(?i)\.pdf($|\?)|summary|training|transparen|ai-?act|article.?53|legal|policy') then 'document' else 'other' end as class from check_log where url is not null"""
)
def link_class(t):
    return t("check_log").where("url is not null").select("url", urls.link_class(F.col("url")).alias("class")).distinct()


@book.add(r"with x as (select capture_dir, [p for p in string_split(capture_dir, '/') if p <> ''] as p from captures) select capture_dir, case when len(p) >= 2 then regexp_replace(p[len(p) - 1], '-[^-]*$', '') else '' end as kind from x")
def dir_kind(t):
    return t("captures").select("capture_dir", urls.kind_of_dir(F.col("capture_dir")).alias("kind"))


# ---- times -----------------------------------------------------------------


@book.add(
    r"""with x as (select capture_dir, regexp_extract(capture_dir, '(\d{8}T\d{6}Z)[^/]*/*$', 1) as s from captures) select capture_dir, case when s <> '' then regexp_replace(s, '^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2}).*', '\1-\2-\3T\4:\5:\6Z') else '' end as iso,
    case when s <> '' then strftime(strptime(substr(s, 1, 8), '%Y%m%d'), '%-d %b %Y') else s end as human from x"""
)
def slug_dates(t):
    s = times.stamp_of(F.col("capture_dir"))
    return t("captures").select("capture_dir", times.iso_of_stamp(s).alias("iso"), times.human_date(s).alias("human"))


@book.add(
    "with x as (select seq, try_cast(substr(ts, 1, 10) as date) as d, ingested_at from check_log) select seq, date_diff('day', d, cast(ingested_at as date)) as days from x"
)
def days_between(t):
    """D-02."""
    return t("check_log").select("seq", F.date_diff(F.to_date("ingested_at"), times.day_of(F.col("ts"))).cast("bigint").alias("days"))


_SNAP = r"try_strptime(regexp_replace(regexp_extract(wayback.snapshot, '(\d{8}T?\d{6})Z?', 1), 'T', ''), '%Y%m%d%H%M%S')"
SNAP = lambda: F.nullif(F.replace(F.regexp_extract("wayback.snapshot", r"(\d{8}T?\d{6})Z?", 1), F.lit("T")), F.lit(""))
_FETCHED = "try_strptime(http.fetched_at, '%Y-%m-%dT%H:%M:%SZ')"


@book.add(f"select distinct capture_dir, epoch({_FETCHED}) - epoch({_SNAP}) <= 3600 as fresh from manifest")
def freshness_window(t):
    return t("manifest").select("capture_dir", times.is_fresh(SNAP(), F.col("http.fetched_at")).alias("fresh")).distinct()


@book.add(f"select distinct capture_dir, case when coalesce(wayback.ok, false) then abs(epoch({_FETCHED}) - epoch({_SNAP})) <= 3600 end as witnesses from manifest")
def two_sided_witness(t):
    return t("manifest").select("capture_dir", F.when(F.coalesce("wayback.ok", F.lit(False)), times.witnesses(SNAP(), F.col("http.fetched_at"))).alias("witnesses")).distinct()


@book.add(
    r"""select capture_dir, coalesce((epoch(timestamp '2027-01-01') - epoch(try_strptime(regexp_extract(capture_dir, '(\d{8}T\d{6}Z)[^/]*/*$', 1), '%Y%m%dT%H%M%SZ'))) / 3600, 'infinity'::double) as hours from captures"""
)
def proof_age(t):
    return t("captures").select("capture_dir", times.age_hours(times.stamp_of(F.col("capture_dir")), F.lit("2027-01-01 00:00:00").cast("timestamp")).alias("hours"))


@book.add("with x as (select distinct capture_dir, try_strptime(ots.at, '%Y-%m-%dT%H:%M:%SZ') as a from manifest where coalesce(ots.ok, false) and len(ots.calendars) > 0) select capture_dir, floor((epoch(timestamp '2027-01-01') - epoch(a)) / 86400)::bigint as days from x where floor((epoch(timestamp '2027-01-01') - epoch(a)) / 86400) > 7")
def pending_days(t):
    """D-06, V-C9: proofs pending for more than a week."""
    age = F.floor((F.unix_timestamp(F.lit("2027-01-01 00:00:00").cast("timestamp")) - times.epoch_of_stamp(F.col("ots.at"), "yyyy-MM-dd'T'HH:mm:ss'Z'")) / 86400)
    return t("manifest").where("coalesce(ots.ok, false) and size(ots.calendars) > 0").select("capture_dir", age.alias("days")).where("days > 7").distinct()


_TS = r"try_cast(case when regexp_matches(ts, '([zZ]|[+-]\d{2}:?\d{2})$') then ts else ts || 'Z' end as timestamptz)"


@book.add(f"with x as (select max({_TS}) as m from check_log), y as (select max(ingested_at) as n from check_log) select strftime(timezone('UTC', m), '%Y-%m-%d %H:%M:%S') as newest, epoch(cast(n as timestamptz)) - epoch(m) > 48 * 3600 as stale from x, y")
def log_freshness(t):
    """D-07, V-C11."""
    from provlake.operators.references import utc_timestamp

    log = t("check_log").agg(F.max(utc_timestamp(F.col("ts"))).alias("m"), F.max("ingested_at").alias("n"))
    return log.select(F.date_format(F.to_utc_timestamp("m", F.current_timezone()), "yyyy-MM-dd HH:mm:ss").alias("newest"), ((F.unix_timestamp("n") - F.unix_timestamp("m")) > 48 * 3600).alias("stale"))


@book.add("select distinct capture_dir, greatest(60.0, least(3600.0, coalesce(try_cast(trim(http.content_length) as double), 900.0)))::double as budget from manifest")
def clamped_setting(t):
    return t("manifest").select("capture_dir", times.clamped(F.col("http.content_length"), 900, 60, 3600).alias("budget")).distinct()
