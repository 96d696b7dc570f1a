"""Not-modified revisits of a web archive resolved to the response they stand for.

A capture is a full response or a revisit that says "not modified". A revisit takes the latest earlier full response of
its canonical URL (as-of join); if the validators agree, it gets that response's payload and its headers, updated by
those of the revisit that may be. DataFrame functions only.

Defined results: a revisit without a URL or time is returned as ``unresolved``; a response at the time of the revisit is not
earlier; of responses with one time the larger ``record_id`` is the later one, a null one the earliest; repeated rows are
captures of their own, ids need not be unique; an empty table gives an empty result. A revisit whose validators contradict is
``mismatch`` and gets nothing, one with no validator in common is ``unverified`` and gets the response (``strict=True``:
nothing). Other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import saved

#: Header fields that a not-modified answer never updates: they describe the stored payload or the connection.
KEPT_HEADERS = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "etag",
    "keep-alive", "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding",
    "upgrade",
)
#: Query parameters that do not change what is served.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid|sessionid|sid"


def canonical_url(url: Column | str) -> Column:
    """One spelling for addresses of the same page: no scheme, user, default port, leading ``www.``, fragment, tracking
    parameters, directory index or slash at the end; host in lower case, parameters in order."""
    u = F.trim(F.col(url) if isinstance(url, str) else url)
    u = F.regexp_replace(u, r"#.*$", "")
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(u, r"^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)$", "")
    host = F.regexp_replace(F.regexp_replace(host, r"\.$", ""), r"^www[0-9]*\.", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[^/?]*([^?]*)", 1), r"/(index\.(html?|php))?$", "")
    query = F.filter(
        F.split(F.regexp_extract(u, r"^[^?]*\?(.*)$", 1), "&"),
        lambda p: (p != "") & ~p.rlike(rf"(?i)^({TRACKING})(=|$)"),
    )
    tail = F.array_join(F.array_sort(query), "&")
    return F.when(host != "", F.concat(host, path, F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise("")))


def _weak(tag: Column) -> Column:
    """An entity tag for the weak comparison."""
    return F.regexp_replace(tag, r"^[Ww]/", "")


def lower_names(headers: Column) -> Column:
    """Headers with names in lower case; of fields that then coincide the last one stays."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["key"] == e["key"]))
    return F.map_from_entries(last)


def merged_headers(stored: Column, update: Column) -> Column:
    """Stored headers, with fields of the update in place of theirs where that is permitted."""
    allowed = F.map_filter(F.coalesce(update, F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin(*KEPT_HEADERS))
    rest = F.map_filter(stored, lambda k, v: ~F.coalesce(F.map_contains_key(allowed, k), F.lit(False)))
    return F.map_concat(rest, allowed)


def _row_key(rows: DataFrame) -> Column:
    """A digest of all that a capture holds: rows with one key are equal, so they stand for each other."""
    held = F.struct("record_id", "kind", "url", "time", F.map_entries("headers").alias("headers"), F.md5("payload").alias("payload"))
    return F.md5(F.to_json(held, {"ignoreNullFields": "false"}))


def resolve_revisits(captures: DataFrame, strict: bool = False, ranges: int | None = None) -> DataFrame:
    """``captures(record_id, kind, url, time, headers, payload)`` gives one row each: ``record_id, kind, url, canonical, time,
    status, source_id, headers, payload``. Kinds are ``response`` and ``revisit``; any other comes back as it is, with the
    status ``other``.

    The as-of join is a running maximum over the captures of a URL without their payloads. They are sorted by URL and time
    over all tasks, and the captures of a URL within one range of that sort are one stretch; so a URL is cut by the number of
    its captures, however close in time they are. Each stretch starts from the last response of the ones before it, one small
    row per stretch. ``ranges`` is the number of ranges, that of shuffle partitions by default. The captures are read three times, so store them first where they are costly to make.
    """
    rows = captures.select(
        "record_id", F.lower("kind").alias("kind"), "url", canonical_url("url").alias("canonical"), "time",
        lower_names(F.col("headers")).alias("headers"), "payload",
    )
    rows = rows.withColumn("key", _row_key(rows))
    # At one time revisits come before responses, so what stands before a revisit is strictly earlier.
    order = ["time", "answers", "record_id", "key"]
    keys = rows.filter("canonical is not null and time is not null and kind in ('response', 'revisit')").select(
        "canonical", "time", (F.col("kind") == "response").alias("answers"), "record_id", "key",
        F.col("headers")["etag"].alias("etag"), F.col("headers")["last-modified"].alias("modified"),
    )
    laid = keys.repartitionByRange(*([ranges] if ranges else []), "canonical", *order).withColumn("stretch", F.spark_partition_id())
    placed = saved(laid, "warc-keys").withColumn(
        "full", F.when(F.col("answers"), F.struct("time", "record_id", "key", "etag", "modified"))
    )
    ends = placed.groupBy("canonical", "stretch").agg(F.max("full").alias("last"))
    earlier = W.partitionBy("canonical").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select("canonical", "stretch", F.max("last").over(earlier).alias("carried"))
    before = W.partitionBy("canonical", "stretch").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    found = (
        placed.withColumn("within", F.max("full").over(before)).filter("not answers").join(carried, ["canonical", "stretch"])
        .withColumn("base", F.coalesce("within", "carried"))
    )
    tags = F.when(F.col("etag").isNotNull() & F.col("base.etag").isNotNull(), _weak(F.col("etag")) == _weak(F.col("base.etag")))
    dates = F.when(F.col("modified").isNotNull() & F.col("base.modified").isNotNull(), F.col("modified") == F.col("base.modified"))
    agree = F.coalesce(tags, dates)  # an entity tag counts before a date
    status = (
        F.when(F.col("base").isNull(), "unresolved").when(agree, "resolved").when(~agree, "mismatch").otherwise("unverified")
    )
    good = F.col("status") == "resolved" if strict else F.col("status").isin("resolved", "unverified")
    links = found.select("key", status.alias("status"), F.col("base.record_id").alias("record_id"), F.col("base.key").alias("base")).select(
        F.col("key").alias("revisit_key"), F.col("status").alias("found_status"), F.when(good, F.col("record_id")).alias("found_id"),
        F.when(good, F.col("base")).alias("found_key"),
    ).dropDuplicates(["revisit_key"])
    stored = rows.filter("kind = 'response'").select(
        F.col("key").alias("stored_key"), F.col("headers").alias("stored_headers"), F.col("payload").alias("stored_payload")
    ).dropDuplicates(["stored_key"])
    revisits = (
        rows.filter("kind = 'revisit'").drop("payload").join(links, F.col("key") == F.col("revisit_key"), "left")
        .join(stored, F.col("found_key") == F.col("stored_key"), "left")
        .select(
            "record_id", "kind", "url", "canonical", "time", F.coalesce("found_status", F.lit("unresolved")).alias("status"),
            F.col("found_id").alias("source_id"),
            F.when(F.col("stored_key").isNotNull(), merged_headers(F.col("stored_headers"), F.col("headers")))
            .otherwise(F.col("headers")).alias("headers"),
            F.col("stored_payload").alias("payload"),
        )
    )
    answers = F.coalesce(F.col("kind") == "response", F.lit(False))
    others = rows.filter(answers | F.col("kind").isNull() | (F.col("kind") != "revisit")).select(
        "record_id", "kind", "url", "canonical", "time", F.when(answers, "response").otherwise("other").alias("status"),
        F.when(answers, F.col("record_id")).alias("source_id"), "headers", "payload",
    )
    return others.unionByName(revisits)
