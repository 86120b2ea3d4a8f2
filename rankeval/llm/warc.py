"""Not-modified revisit resolution for web-archive records.

A revisit record holds only the headers of a 304 answer.  It is resolved to the latest earlier full response of
the same canonical URL (an as-of join), its validators are checked against that response's, and the permitted
headers of the 304 replace the stored ones.

As-of join without one task per URL: records are cut into time slices.  (1) The last full response of every
(URL, slice) is found by a partial aggregation; (2) one row per (URL, slice) carries the last response of earlier
slices forward; (3) inside a slice a running ``last`` finds the rest.  A URL with a third of all records is thus
spread over its slices.  Only keys and headers move, never payloads.

Checks: every validator that both sides have (ETag, weakly compared; Last-Modified; payload digest) must agree,
and at least one must be there.  Outcomes: resolved, validator_mismatch, no_validator, no_earlier_response, no_url.

Headers: those of the 304 replace stored ones of the same name, except connection-level fields and those that
describe the stored body (``KEPT``, after RFC 9111 section 3.2).

Defined cases: null URLs resolve to nothing; a response at the revisit's own second is not earlier; of responses in
the same second the one with the highest record id counts; records without a time are never matched; null header
maps are empty; repeated revisits give a row each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table

SLICE_SECONDS = 6 * 3600
#: Header names that a 304 never changes.
KEPT = ("connection", "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "keep-alive", "te",
        "trailer", "transfer-encoding", "upgrade", "content-encoding", "content-length", "content-range", "content-type")
#: Query parameters that do not select content.
TRACKING = r"^(utm_[a-z]+|gclid|fbclid|ref)(=|$)"
URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no user, default port, fragment or tracking parameters, sorted query."""
    scheme = F.lower(F.regexp_extract(url, URL, 1))
    host = F.regexp_replace(F.lower(F.regexp_extract(url, URL, 2)), r"^.*@", "")
    host = F.when(scheme == "http", F.regexp_replace(host, r"\.?(:80)?$", "")).when(
        scheme == "https", F.regexp_replace(host, r"\.?(:443)?$", "")).otherwise(host)
    path = F.regexp_extract(url, URL, 3)
    query = F.substring(F.regexp_extract(url, URL, 4), 2, 1 << 30)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    whole = F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path), query)
    return F.when(url.isNull() | (F.trim(url) == ""), None).when(url.rlike(URL), whole).otherwise(
        F.regexp_replace(F.trim(url), "#.*$", ""))


def _header(headers: Column, name: str) -> Column:
    return F.element_at(headers, name)


def _weak(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def resolve_revisits(records: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """``records``: record_id, url, ts (epoch seconds), kind (response | revisit), status, headers (map with
    lower-case names), payload_digest.  One row per revisit."""
    found = records.select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), F.col("ts").cast("long").alias("ts"), "kind", "status",
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"), "payload_digest")
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("ts").isNotNull() & F.col("url_key").isNotNull()
    revisit = F.col("kind") == "revisit"
    # an array of pairs, unlike a map, can be compared, so responses can go through max()
    stored = F.when(full, F.struct("ts", "record_id", F.array_sort(F.map_entries("headers")).alias("headers"), "payload_digest"))
    rows = found.filter(revisit | full).select(
        "record_id", "url_key", "ts", revisit.alias("revisit"), "headers", "payload_digest", stored.alias("stored"),
        F.floor(F.col("ts") / slice_seconds).alias("slice"))
    keyed = rows.filter(F.col("url_key").isNotNull() & F.col("ts").isNotNull())
    last = keyed.groupBy("url_key", "slice").agg(F.max("stored").alias("last"))
    earlier = W.partitionBy("url_key").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    carried = last.select("url_key", "slice", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    # at one second revisits come first: an equal time is not earlier
    inside = W.partitionBy("url_key", "slice").orderBy("ts", F.desc("revisit"), "record_id").rowsBetween(
        W.unboundedPreceding, W.currentRow)
    near = keyed.select("record_id", "url_key", "ts", "revisit", "headers", "payload_digest", "slice",
                        F.last("stored", ignorenulls=True).over(inside).alias("near")).filter("revisit")
    joined = near.join(carried, ["url_key", "slice"], "left").select(
        "record_id", "url_key", "ts", "headers", "payload_digest", F.coalesce("near", "carried").alias("found"))
    unkeyed = rows.filter(revisit & (F.col("url_key").isNull() | F.col("ts").isNull())).select(
        "record_id", "url_key", "ts", "headers", "payload_digest", F.lit(None).cast(joined.schema["found"].dataType).alias("found"))
    joined = joined.unionByName(unkeyed).withColumn("old", F.map_from_entries("found.headers"))
    pairs = [(_weak(_header(F.col("headers"), "etag")), _weak(_header(F.col("old"), "etag"))),
             (_header(F.col("headers"), "last-modified"), _header(F.col("old"), "last-modified")),
             (F.col("payload_digest"), F.col("found.payload_digest"))]
    tests = F.array_compact(F.array(*[a == b for a, b in pairs]))
    outcome = (F.when(F.col("url_key").isNull(), "no_url").when(F.col("found").isNull(), "no_earlier_response")
               .when(F.size(tests) == 0, "no_validator").when(F.exists(tests, lambda t: ~t), "validator_mismatch")
               .otherwise("resolved"))
    new = F.map_filter("headers", lambda k, v: ~k.isin(*KEPT))
    merged = F.map_concat(F.map_filter("old", lambda k, v: ~F.array_contains(F.map_keys(new), k)), new)
    done = F.col("outcome") == "resolved"
    return joined.withColumn("outcome", outcome).select(
        "record_id", "url_key", "ts", "outcome", F.when(done, F.col("found.record_id")).alias("response_id"),
        F.when(done, F.col("found.payload_digest")).alias("payload_digest"), F.when(done, merged).alias("headers"))


def derived_records(pages: DataFrame) -> DataFrame:
    """Archive records made from ``pages``: a response per page and three later or earlier 304 records under spellings of
    its URL, some with a wrong or no validator.  Times, faults and spellings follow from page_id and the html."""
    digest = F.md5(F.coalesce("html", F.lit("")))
    start = F.lit(1_700_000_000) + F.pmod(F.col("page_id") * 7919, F.lit(400_000))
    base = pages.select("page_id", "url", digest.alias("digest"), start.alias("start"),
                        F.octet_length(F.coalesce("html", F.lit(""))).cast("string").alias("length"))
    response = base.select(
        (F.col("page_id") * 4).alias("record_id"), "url", F.col("start").alias("ts"), F.lit("response").alias("kind"),
        F.when(F.pmod("page_id", F.lit(17)) == 0, 206).otherwise(200).alias("status"),
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), F.col("length"),
                     F.lit("etag"), F.concat(F.lit('W/"'), "digest", F.lit('"')),
                     F.lit("cache-control"), F.lit("max-age=60"), F.lit("server"), F.lit("origin")).alias("headers"),
        F.col("digest").alias("payload_digest"))
    seen = base.withColumn("k", F.explode(F.array(*[F.lit(k) for k in (1, 2, 3)])))
    fault = F.pmod(F.col("page_id") + F.col("k"), F.lit(11))
    spelt = F.when(F.col("k") == 1, F.concat(F.col("url"), F.lit("#again"))).when(
        F.col("k") == 2, F.regexp_replace("url", "^http", "HTTP")).otherwise(F.col("url"))
    revisit = seen.select(
        (F.col("page_id") * 4 + F.col("k")).alias("record_id"), spelt.alias("url"),
        (F.col("start") + F.col("k") * 30_000 - F.when(fault == 5, 200_000).otherwise(0)).alias("ts"),
        F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
        F.map_filter(F.create_map(
            F.lit("etag"), F.when(fault == 3, '"other"').when(fault == 4, None).otherwise(F.concat(F.lit('"'), "digest", F.lit('"'))),
            F.lit("cache-control"), F.concat(F.lit("max-age="), (F.col("k") * 100).cast("string")),
            F.lit("content-length"), F.lit("0"), F.lit("age"), F.col("k").cast("string")), lambda n, v: v.isNotNull()).alias("headers"),
        F.lit(None).cast("string").alias("payload_digest"))
    return response.unionByName(revisit)


def op9_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(derived_records(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.select("record_id", "url_key", "ts", "outcome", "response_id", "payload_digest",
                        F.when(F.col("headers").isNotNull(), F.array_join(lines, "\n")).alias("headers"))


_CANONICAL_SQL = f"""CASE WHEN url IS NULL OR trim(url) = '' THEN NULL
 WHEN regexp_matches(url, '{URL}') THEN
  scheme || '://' || CASE scheme WHEN 'http' THEN regexp_replace(host, '\\.?(:80)?$', '')
    WHEN 'https' THEN regexp_replace(host, '\\.?(:443)?$', '') ELSE host END
  || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END
 ELSE regexp_replace(trim(url), '#.*$', '') END"""

OP9_SQL = f"""WITH base AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS digest, 1700000000 + (page_id * 7919) % 400000 AS start,
         CAST(strlen(coalesce(html, '')) AS VARCHAR) AS length FROM pages),
records AS (
  SELECT page_id * 4 AS record_id, url, start AS ts, 'response' AS kind, CASE WHEN page_id % 17 = 0 THEN 206 ELSE 200 END AS status,
         'W/"' || digest || '"' AS etag, digest, length, 0 AS k FROM base
  UNION ALL
  SELECT page_id * 4 + k, CASE k WHEN 1 THEN url || '#again' WHEN 2 THEN regexp_replace(url, '^http', 'HTTP') ELSE url END,
         start + k * 30000 - CASE WHEN (page_id + k) % 11 = 5 THEN 200000 ELSE 0 END, 'revisit', 304,
         CASE (page_id + k) % 11 WHEN 3 THEN '"other"' WHEN 4 THEN NULL ELSE '"' || digest || '"' END, NULL, NULL, k
  FROM base, (VALUES (1), (2), (3)) AS v(k)),
cut AS (SELECT *, lower(regexp_extract(url, '{URL}', 1)) AS scheme,
  regexp_replace(lower(regexp_extract(url, '{URL}', 2)), '^.*@', '') AS host, regexp_extract(url, '{URL}', 3) AS path,
  list_sort(list_filter(string_split(substr(regexp_extract(url, '{URL}', 4), 2), '&'),
            lambda p: p <> '' AND NOT regexp_matches(lower(p), '{TRACKING}'))) AS params FROM records),
keyed AS (SELECT *, {_CANONICAL_SQL} AS url_key FROM cut),
full_ AS (SELECT url_key, ts, max(record_id) AS record_id FROM keyed WHERE kind = 'response' AND status = 200 GROUP BY ALL),
answers AS (SELECT k.* FROM keyed k JOIN full_ f ON k.record_id = f.record_id AND k.kind = 'response'),
matched AS (SELECT r.record_id, r.url_key, r.ts, r.etag, r.k, a.record_id AS found, a.etag AS old_etag, a.digest AS old_digest, a.length
  FROM (SELECT * FROM keyed WHERE kind = 'revisit') r ASOF LEFT JOIN answers a ON r.url_key = a.url_key AND r.ts > a.ts),
judged AS (SELECT *, CASE WHEN url_key IS NULL THEN 'no_url' WHEN found IS NULL THEN 'no_earlier_response'
  WHEN etag IS NULL THEN 'no_validator' WHEN replace(old_etag, 'W/', '') <> etag THEN 'validator_mismatch' ELSE 'resolved' END AS outcome
  FROM matched)
SELECT record_id, url_key, ts, outcome, CASE WHEN outcome = 'resolved' THEN found END AS response_id,
  CASE WHEN outcome = 'resolved' THEN old_digest END AS payload_digest,
  CASE WHEN outcome = 'resolved' THEN 'age: ' || k || chr(10) || 'cache-control: max-age=' || k * 100 || chr(10) || 'content-length: '
    || length || chr(10) || 'content-type: text/html' || chr(10) || 'etag: ' || etag || chr(10) || 'server: origin' END AS headers
FROM judged"""
