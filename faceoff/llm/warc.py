"""Resolution of not-modified revisit records of web archives.

A revisit says that a page had not changed: it holds the headers of a 304 answer and no
body. It is resolved to the latest earlier full response (type ``response``, status 200)
of the same canonical URL: that response's body, and its headers updated by those of the
revisit (RFC 9111, 3.2 and 4.3.4). Method:

1. Slim rows (key, time, kind, id, validators, headers of the revisits; no body) are
   dealt by ranges of (URL, time, kind, id), so the rows of a hot URL are spread over as
   many tasks as they fill, and written with the number of their range.
2. Each (URL, range) gives its last response. The running maximum over the ranges of a
   URL, a row for each range, is what every range starts with.
3. Inside a (URL, range) a running maximum gives the last response so far. Of equal
   times revisits come first: a response of the same time is not earlier.
4. Validators are compared, and headers and body of the responses found are fetched by
   id; a response with over ``SHARE`` revisits is fetched in as many copies as they need. Revisits that are not resolved
   are dealt by their own ids.

Validators: a strong ETag of the revisit has to equal a strong one of the response, a
weak one is compared without its mark. A revisit without ETag is compared by
Last-Modified; one with neither fits only a response with neither.

Cases: a null URL or time gives the resolution ``incomplete``; a revisit without id is kept,
a response without id is not referred to; of several full responses of one id the first counts (by
time, null last, then URL, validators and content), repeated revisits are resolved one by one; null headers
count as none, header names compare without case, repeated headers are kept; other columns are
ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faceoff.llm.common import written

RECORD = ("record_id long, type string, status int, url string, time long, "
          "headers array<struct<name: string, value: string>>, body string")
HEADERS = "array<struct<name: string, value: string>>"
#: Headers of one connection, and those that describe a body the revisit doesn't have.
NOT_MERGED = ["connection", "keep-alive", "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection",
              "te", "trailer", "transfer-encoding", "upgrade", "content-encoding", "content-length", "content-range", "content-type"]
#: Query arguments that don't choose the page.
DROPPED_ARGUMENT = r"^(?:utm_[^=]*|sid|sessionid|phpsessid|jsessionid)(?:=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without last slash, sorted query
    without tracking arguments; no scheme and no fragment."""
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^[^/?]*", 0))
    port = F.when(F.lower(u).startswith("https:"), F.regexp_replace(host, r":443$", "")).otherwise(F.regexp_replace(host, r":80$", ""))
    host = F.regexp_replace(port, r"^www\d*\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"^[^?]*\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda a: (a != "") & ~F.lower(a).rlike(DROPPED_ARGUMENT)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _list(headers: Column) -> Column:
    return F.coalesce(headers, F.array().cast(HEADERS))


def header(headers: Column, name: str) -> Column:
    """The first value of a header, trimmed; null without one."""
    return F.trim(F.get(F.filter(_list(headers), lambda h: F.lower(h["name"]) == name), F.lit(0))["value"])


def merged_headers(stored: Column, new: Column) -> Column:
    """Stored headers, replaced by name by those of the revisit that may be taken over."""
    listed = F.flatten(F.transform(F.filter(_list(new), lambda h: F.lower(h["name"]) == "connection"),
                                   lambda h: F.transform(F.split(F.lower(h["value"]), ","), lambda x: F.trim(x))))
    barred = F.concat(F.array(*[F.lit(n) for n in NOT_MERGED]), listed)
    take = F.filter(_list(new), lambda h: h["name"].isNotNull() & ~F.coalesce(F.array_contains(barred, F.lower(h["name"])), F.lit(False)))
    names = F.transform(take, lambda h: F.lower(h["name"]))
    stay = F.filter(_list(stored), lambda h: ~F.coalesce(F.array_contains(names, F.lower(h["name"])), F.lit(False)))
    return F.concat(stay, take)


def _fits(etag: Column, modified: Column, of: Column) -> Column:
    weak = lambda e: F.regexp_replace(e, r"^W/", "")
    by_etag = F.when(etag.startswith("W/"), weak(etag) == weak(of["etag"])).otherwise(etag == of["etag"])
    fits = (F.when(etag.isNotNull(), by_etag).when(modified.isNotNull(), modified == of["modified"])
            .otherwise(of["etag"].isNull() & of["modified"].isNull()))
    return F.coalesce(fits, F.lit(False))


#: Revisits that one copy of a response serves.
SHARE = 10_000
#: The order of responses of one id.
ORDER = ("no_time", "time", "canonical", "etag", "modified")


def _response() -> list[Column]:
    """What is needed of a record to find and order responses."""
    return [F.col("record_id"), F.col("time").isNull().alias("no_time"), F.col("time"), canonical_url(F.col("url")).alias("canonical"),
            header(F.col("headers"), "etag").alias("etag"), header(F.col("headers"), "last-modified").alias("modified")]


def resolve(records: DataFrame) -> DataFrame:
    """Every revisit of ``records`` (columns of RECORD) with ``canonical``, ``resolution``
    (resolved, validator_mismatch, no_earlier_response, incomplete), ``refers_to`` and, if
    resolved, the merged ``headers`` and the ``body``."""
    spark = records.sparkSession
    full = F.col("type").eqNullSafe("response") & F.col("status").eqNullSafe(200) & F.col("record_id").isNotNull()
    # of several responses of one id the first counts
    answers = records.where(full).select(*_response()).groupBy("record_id").agg(F.min(F.struct(*ORDER)).alias("_r"))
    empty = F.lit(None).cast(records.schema["headers"].dataType).alias("_new")
    answers = answers.select("record_id", F.col("_r.canonical"), F.col("_r.time"), F.lit(1).alias("kind"), F.col("_r.etag"), F.col("_r.modified"), empty)
    asks = records.where(~full & (F.col("type") == "revisit")).select(*_response(), F.lit(0).alias("kind"), F.col("headers").alias("_new"))
    slim = answers.unionByName(asks.drop("no_time"))
    order = ["canonical", "time", "kind", "record_id"]
    slim = written(spark, slim.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "captures")
    placed = slim.where("canonical is not null and time is not null")
    response = F.when(F.col("kind") == 1, F.struct("time", "record_id", "etag", "modified"))
    ends = placed.groupBy("canonical", "part").agg(F.max(response).alias("_end"))
    before = Window.partitionBy("canonical").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("canonical", "part", F.max("_end").over(before).alias("_before"))
    inside = Window.partitionBy("canonical", "part").orderBy("time", "kind", "record_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = placed.withColumn("_so_far", F.max(response).over(inside)).where("kind = 0").join(ends, ["canonical", "part"])
    found = found.withColumn("_of", F.coalesce("_so_far", "_before"))
    fits = _fits(F.col("etag"), F.col("modified"), F.col("_of"))
    said = F.when(F.col("_of").isNull(), "no_earlier_response").when(fits, "resolved").otherwise("validator_mismatch")
    found = found.select("record_id", "canonical", "time", "_new", said.alias("resolution"), F.col("_of")["record_id"].alias("refers_to"))
    odd = slim.where("kind = 0 and (canonical is null or time is null)").select(
        "record_id", "canonical", "time", "_new", F.lit("incomplete").alias("resolution"), F.lit(None).cast("long").alias("refers_to"))
    links = written(spark, found.unionByName(odd), "links")
    known = F.col("resolution") == "resolved"
    # a response with very many revisits is copied for every ``SHARE`` of them, and they are spread over its copies
    referred = links.where(known).groupBy(F.col("refers_to").alias("_id")).agg(F.ceil(F.count("*") / SHARE).cast("int").alias("_copies"))
    referred = written(spark, referred, "referred")
    stored = records.where(full).select(*_response(), F.col("headers").alias("_stored"), "body").join(referred, F.col("record_id") == F.col("_id"))
    first = Window.partitionBy("_id").orderBy(*ORDER, F.xxhash64("_stored", "body"))
    stored = stored.withColumn("_k", F.row_number().over(first)).where("_k = 1")
    stored = stored.select(F.col("_id").cast("string").alias("_target"), F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("_copy"), "_stored", "body")
    target = F.when(known, F.col("refers_to").cast("string")).otherwise(F.concat(F.lit("none for "), F.coalesce(F.col("record_id").cast("string"), F.lit(""))))
    busy = referred.where("_copies > 1")
    spread = links.join(busy, known & (F.col("refers_to") == F.col("_id")), "left").withColumn("_at", target)
    spread = spread.withColumn("_of", F.coalesce(F.pmod(F.xxhash64("record_id", "time"), F.col("_copies")).cast("int"), F.lit(0))).drop("_id", "_copies")
    out = spread.join(stored, (F.col("_at") == F.col("_target")) & (F.col("_of") == F.col("_copy")), "left")
    merged = F.when(known, merged_headers(F.col("_stored"), F.col("_new")))
    return out.select("record_id", "canonical", "time", "resolution", "refers_to", merged.alias("headers"), "body")


def standin_records(pages: DataFrame) -> DataFrame:
    """Two records of each page, since ``pages`` holds neither times nor revisits: a response with the
    page as body, and a revisit of its URL around that time, now and then with other validators."""
    p = F.col("page_id")
    head = lambda *pairs: F.filter(F.array(*[F.struct(F.lit(n).alias("name"), v.cast("string").alias("value")) for n, v in pairs]), lambda h: h["value"].isNotNull())
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 12), F.lit('"'))
    day = F.concat(F.lit("day "), p % 9)
    at = (p * 7919) % 1_000_003
    response = pages.select(
        (p * 2).alias("record_id"), F.lit("response").alias("type"), F.when(p % 17 == 3, 404).otherwise(200).alias("status"), "url", at.alias("time"),
        head(("Content-Type", F.lit("text/html")), ("Content-Length", F.length("html")), ("Cache-Control", F.lit("max-age=60")),
             ("ETag", F.when(p % 4 != 0, tag)), ("Last-Modified", F.when(p % 4 != 1, day))).alias("headers"), F.col("html").alias("body"))
    revisit = pages.select(
        (p * 2 + 1).alias("record_id"), F.lit("revisit").alias("type"), F.lit(304).alias("status"), "url", (at + (p * 10_007) % 6_000 - 600).alias("time"),
        head(("etag", F.when(p % 4 != 0, F.when(p % 11 == 0, F.lit('"other"')).when(p % 5 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag))),
             ("Last-Modified", F.when(p % 4 != 1, day)), ("cache-control", F.concat(F.lit("max-age="), p % 100)), ("Content-Length", F.lit("0")),
             ("Connection", F.lit("close, X-Hop")), ("x-hop", F.lit("1")), ("Date", at)).alias("headers"), F.lit(None).cast("string").alias("body"))
    return response.unionByName(revisit)
