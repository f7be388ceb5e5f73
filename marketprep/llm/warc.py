"""Not-modified revisit resolution for web archives.

A revisit record says that a page had not changed; its body is that of the
latest earlier full response of the same canonical URL.  The validators of the
two are compared, and the revisit's permitted headers replace the response's.

The as-of join runs in two levels: within (URL, time bucket) a running
maximum, and across the buckets of a URL one row each.  A URL with a large
share of all captures is so spread over its buckets.

Defined cases: ``no_key`` for a null url or time, ``no_response`` without an
earlier full response, ``mismatch`` when validators differ (headers stay
empty), ``unchecked`` when there is no validator to compare, else
``resolved``.  Responses of the same moment: the largest record id is the
latest; a response at the revisit's own moment is not earlier.  A response
with a null id cannot be referred to and hides no other; a revisit with a null
id resolves like any other.  Each revisit row gives one row, whatever id and
moment it shares with others; of responses that share id, URL and moment the
one with the largest digest, then headers, counts.  Dot segments and the case
of percent codes are left as they are.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# FIXED VALUES: header fields that a not-modified response may update
# --------------------------------------------------------------------------
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")

BUCKET = 86_400     # time units of a bucket

DEFAULT_PORTS = (r"(?s)^([Hh][Tt][Tt][Pp]://[^/?]*):80([/?].*)?$", r"(?s)^([Hh][Tt][Tt][Pp][Ss]://[^/?]*):443([/?].*)?$")

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(url: Column) -> Column:
    """Host, path and query without scheme, the scheme's default port,
    fragment, case of the host and ``utm_`` parameters; an empty path is ``/``."""
    u = F.regexp_replace(url, r"#.*$", "")
    for pattern in DEFAULT_PORTS:
        u = F.regexp_replace(u, pattern, "$1$2")
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.translate(F.regexp_extract(u, r"^([^/?]*)", 1), UPPER, SMALL)
    path = F.regexp_extract(u, r"^[^/?]*([^?]*)", 1)
    query = F.regexp_extract(u, r"^[^?]*\?(.*)$", 1)
    query = F.regexp_replace(query, r"(^|&)utm_[^&]*", "")
    query = F.regexp_replace(query, r"^&", "")
    return F.concat(host, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def _bare(tag: Column) -> Column:
    return F.regexp_replace(tag, r"^W/", "")


def resolve(records: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``records``: ``record_id, url, at`` (a number), ``kind`` (``response``
    or ``revisit``), ``headers`` (map, lower-case names), ``digest`` of the body.

    Returns per revisit ``(record_id, url_key, outcome, refers_to, digest,
    headers)``.
    """
    rec = records.select("record_id", "kind", F.col("at").cast("long").alias("at"), canonical(F.col("url")).alias("url_key"),
                         "headers", "digest").withColumn("bucket", F.floor(F.col("at") / bucket))
    slim = (rec.where("url_key is not null and at is not null "
                      "and (kind = 'revisit' or kind = 'response' and record_id is not null)")
            .select("record_id", "kind", "at", "url_key", "bucket"))
    full = F.when(F.col("kind") == "response", F.struct("at", "record_id"))
    near = Window.partitionBy("url_key", "bucket").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    inner = slim.withColumn("near", F.max(full).over(near)).where("kind = 'revisit'")
    ends = slim.where("kind = 'response'").groupBy("url_key", "bucket").agg(F.max(F.struct("at", "record_id")).alias("last"))
    # every bucket of a URL that has a revisit or a response, one row each
    marks = slim.select("url_key", "bucket").distinct().join(ends, ["url_key", "bucket"], "left")
    before = Window.partitionBy("url_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    far = marks.select("url_key", "bucket", F.max("last").over(before).alias("far"))
    # what a revisit refers to follows from its URL and moment, so no id names it
    ref = inner.join(far, ["url_key", "bucket"], "left").select("url_key", "at", F.coalesce("near", "far").alias("ref")).distinct()
    visits = rec.where("kind = 'revisit'").join(ref, ["url_key", "at"], "left")
    resp = (rec.where("kind = 'response' and record_id is not null")
            .groupBy(F.col("url_key").alias("_url"), F.col("at").alias("_at"), F.col("record_id").alias("_id"))
            .agg(F.max(F.struct("digest", F.array_sort(F.map_entries("headers")).alias("h"))).alias("r"))
            .select("_url", "_at", "_id", F.map_from_entries("r.h").alias("old"), F.col("r.digest").alias("old_digest")))
    both = visits.join(resp, (F.col("url_key") == F.col("_url")) & (F.col("ref.at") == F.col("_at"))
                       & (F.col("ref.record_id") == F.col("_id")), "left")
    tag, old_tag = F.col("headers")["etag"], F.col("old")["etag"]
    when, old_when = F.col("headers")["last-modified"], F.col("old")["last-modified"]
    outcome = (F.when(F.col("url_key").isNull() | F.col("at").isNull(), "no_key")
               .when(F.col("ref").isNull(), "no_response")
               .when(tag.isNotNull() & old_tag.isNotNull(),
                     F.when(_bare(tag) == _bare(old_tag), "resolved").otherwise("mismatch"))
               .when(when.isNotNull() & old_when.isNotNull(),
                     F.when(when == old_when, "resolved").otherwise("mismatch"))
               .otherwise("unchecked"))
    both = both.withColumn("outcome", outcome)
    news = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("old", lambda k, v: ~F.coalesce(F.map_contains_key(news, k), F.lit(False))), news)
    good = F.col("outcome").isin("resolved", "unchecked")
    return both.select("record_id", "url_key", "outcome", F.col("ref.record_id").alias("refers_to"),
                       F.when(good, F.col("old_digest")).alias("digest"), F.when(good, merged).alias("headers"))


def header_lines(headers: Column) -> Column:
    """``name: value`` lines sorted by name."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)),
                                    lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def captures(pages: DataFrame) -> DataFrame:
    """A capture history derived from ``pages``: each page as a full response
    and, half a step later, a revisit of a differently written URL whose
    validators agree, differ, are weak or are missing by the page's id."""
    pid = F.col("page_id")
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    stamp = F.concat(F.lit("t"), F.pmod(pid, F.lit(97)).cast("string"))
    response = pages.select(
        (pid * 2).alias("record_id"), "url", (pid * 3600).alias("at"), F.lit("response").alias("kind"),
        F.map_filter(F.create_map(
            F.lit("cache-control"), F.lit("max-age=60"), F.lit("content-length"), F.length("html").cast("string"),
            F.lit("content-type"), F.lit("text/html"), F.lit("date"), F.concat(F.lit("d"), (pid * 3600).cast("string")),
            F.lit("etag"), F.when(pid % 11 != 0, tag), F.lit("last-modified"), stamp),
            lambda k, v: v.isNotNull()).alias("headers"), F.md5("html").alias("digest"))
    other = F.when(pid % 13 == 0, F.concat(F.col("url"), F.lit("/never"))).otherwise(
        F.concat(F.regexp_replace("url", r"^(https?)://", "$1://"), F.when(F.instr("url", "#") > 0, "").otherwise("#again")))
    revisit = pages.select(
        (pid * 2 + 1).alias("record_id"), other.alias("url"), (pid * 3600 + 200_000).alias("at"), F.lit("revisit").alias("kind"),
        F.map_filter(F.create_map(
            F.lit("cache-control"), F.lit("max-age=120"), F.lit("content-length"), F.lit("0"),
            F.lit("date"), F.concat(F.lit("d"), (pid * 3600 + 200_000).cast("string")),
            F.lit("etag"), F.when(pid % 7 == 0, F.concat(F.lit("W/"), tag)).when(pid % 5 == 0, '"other"')
            .when(pid % 3 != 0, tag),
            F.lit("last-modified"), F.when(pid % 17 != 0, stamp), F.lit("server"), F.lit("s")),
            lambda k, v: v.isNotNull()).alias("headers"), F.lit(None).cast("string").alias("digest"))
    return response.unionByName(revisit)


def _canonical_sql(u: str) -> str:
    u = f"regexp_replace({u}, '#.*$', '')"
    for pattern in DEFAULT_PORTS:
        u = f"regexp_replace({u}, '{pattern}', '\\1\\2')"
    u = f"regexp_replace({u}, '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
    host = f"translate(regexp_extract({u}, '^([^/?]*)', 1), '{UPPER}', '{SMALL}')"
    path = f"regexp_extract({u}, '^[^/?]*([^?]*)', 1)"
    query = f"regexp_extract({u}, '^[^?]*\\?(.*)$', 1)"
    query = f"regexp_replace(regexp_replace({query}, '(^|&)utm_[^&]*', '', 'g'), '^&', '')"
    return (f"{host} || CASE WHEN {path} = '' THEN '/' ELSE {path} END || "
            f"CASE WHEN {query} = '' THEN '' ELSE '?' || {query} END")


ORACLE_SQL = f"""
WITH base AS (
  SELECT page_id AS p, url, '"' || md5(html) || '"' AS tag, 't' || (page_id % 97) AS stamp, length(html) AS n, md5(html) AS dg
  FROM pages),
resp AS (
  SELECT p * 2 AS record_id, {_canonical_sql('url')} AS k, p * 3600 AS ts, dg, n, stamp,
         CASE WHEN p % 11 <> 0 THEN tag END AS tag FROM base),
rev AS (
  SELECT p * 2 + 1 AS record_id, {_canonical_sql("CASE WHEN p % 13 = 0 THEN url || '/never' ELSE url END")} AS k,
         p * 3600 + 200000 AS ts,
         CASE WHEN p % 7 = 0 THEN 'W/' || tag WHEN p % 5 = 0 THEN '"other"' WHEN p % 3 <> 0 THEN tag END AS tag,
         CASE WHEN p % 17 <> 0 THEN stamp END AS stamp FROM base),
best AS (
  SELECT v.record_id, v.k, v.ts, v.tag, v.stamp, arg_max(r, (r.ts, r.record_id)) AS r
  FROM rev v LEFT JOIN resp r ON v.k = r.k AND r.ts < v.ts GROUP BY ALL),
o AS (
  SELECT *, CASE WHEN r IS NULL OR r.record_id IS NULL THEN 'no_response'
    WHEN tag IS NOT NULL AND r.tag IS NOT NULL THEN
      CASE WHEN regexp_replace(tag, '^W/', '') = r.tag THEN 'resolved' ELSE 'mismatch' END
    WHEN stamp IS NOT NULL AND r.stamp IS NOT NULL THEN
      CASE WHEN stamp = r.stamp THEN 'resolved' ELSE 'mismatch' END
    ELSE 'unchecked' END AS outcome FROM best)
SELECT record_id, k AS url_key, outcome, r.record_id AS refers_to,
  CASE WHEN outcome IN ('resolved', 'unchecked') THEN r.dg END AS digest,
  CASE WHEN outcome IN ('resolved', 'unchecked') THEN
    'cache-control: max-age=120' || chr(10) || 'content-length: ' || r.n || chr(10) || 'content-type: text/html' || chr(10)
    || 'date: d' || ts || coalesce(chr(10) || 'etag: ' || coalesce(tag, r.tag), '')
    || chr(10) || 'last-modified: ' || r.stamp END AS headers
FROM o"""
