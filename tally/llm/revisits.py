"""WARC not-modified revisits: as-of join to the latest earlier full response.

A revisit record (a 304 answer) stands for the latest response of the same
canonical URL captured before it. The response is taken if a validator agrees:
entity tags by weak comparison, else modification dates; otherwise the revisit
stays unresolved. The resolved headers are the response's, replaced or
completed by those header fields that a 304 answer may update.

The as-of join is cut into time slices: each (URL, slice) keeps its last
response (pre-aggregated), a window over a URL's slices carries it forward, and
only rows of one URL and slice are ordered against each other. A URL with a
third of all captures is spread over its slices.

Null URLs or times never match (status no_response). Equal times are not
earlier. Among responses of one time the largest record id is the latest.
Repeated revisit rows give repeated results. Header names are compared in
lower case; of a repeated field the last counts. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.store import prepare

SLICE_SECONDS = 3600
#: Fields that a 304 answer may update (fixed values of the HTTP standard, with the other validator).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without trailing slash, query
    without tracking parameters; no scheme and no fragment."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), r"^www\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    query = F.regexp_replace(F.regexp_replace(query, "(^|&)utm_[^&]*", ""), "^&", "")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def merged_headers(response: Column, revisit: Column) -> Column:
    """Header fields (name, value), sorted by name: permitted ones of the revisit before the response's."""
    fields = F.array_distinct(F.transform(F.concat(response, revisit), lambda h: F.lower(h["name"])))
    newer = lambda n: F.when(n.isin(PERMITTED), _last(revisit, n))
    both = F.transform(F.array_sort(fields), lambda n: F.struct(
        n.alias("name"), F.coalesce(newer(n), _last(response, n)).alias("value")))
    return F.filter(both, lambda h: h["value"].isNotNull())


def _last(headers: Column, name) -> Column:
    found = F.filter(headers, lambda h: F.lower(h["name"]) == name)
    return F.get(found, F.size(found) - 1)["value"]


def resolve_revisits(responses: DataFrame, revisits: DataFrame, *, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """One row per revisit: record_id, url_key, response_id, status, headers and the response's payload columns.

    Both take record_id, url, ts (seconds, long) and headers (array of
    struct(name, value)); responses also payload_digest and payload_bytes.
    status: resolved, validator_mismatch, no_validator or no_response.
    """
    prepare(responses.sparkSession)
    headers = "array<struct<name:string,value:string>>"
    common = ["record_id", canonical_url(F.col("url")).alias("key"), F.col("ts").cast("long").alias("ts"),
              F.coalesce(F.col("headers").cast(headers), F.array().cast(headers)).alias("headers")]
    full = responses.select(*common, "payload_digest", "payload_bytes").where("key is not null and ts is not null")
    full = full.select("key", "ts", F.lit(1).alias("kind"), F.struct(
        "ts", "record_id", "headers", "payload_digest", "payload_bytes").alias("response"), F.lit(None).alias("revisit"))
    asks = revisits.select(*common)
    usable = asks.where("key is not null and ts is not null").select(
        "key", "ts", F.lit(0).alias("kind"), F.lit(None).alias("response"), F.struct("record_id", "headers").alias("revisit"))
    both = full.unionByName(usable).withColumn("slice", F.floor(F.col("ts") / slice_seconds))

    ends = both.groupBy("key", "slice").agg(F.max("response").alias("end"))
    carried = ends.select("key", "slice", F.last("end", ignorenulls=True).over(
        Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    # a revisit of the same second comes before the responses, which are not earlier
    order = Window.partitionBy("key", "slice").orderBy("ts", "kind", "response.record_id").rowsBetween(
        Window.unboundedPreceding, 0)
    inside = both.withColumn("own", F.last("response", ignorenulls=True).over(order)).where("kind = 0")
    found = inside.join(carried, ["key", "slice"]).select(
        "key", "revisit.record_id", "revisit.headers", F.coalesce("own", "before").alias("r"))
    found = found.unionByName(asks.where("key is null or ts is null").select(
        "key", "record_id", "headers", F.lit(None).alias("r")))

    etag = lambda h: F.regexp_replace(_last(h, "etag"), "^W/", "")
    mine, theirs = F.col("headers"), F.col("r.headers")
    agree = F.coalesce(etag(mine) == etag(theirs), _last(mine, "last-modified") == _last(theirs, "last-modified"))
    status = (F.when(F.col("r").isNull(), "no_response").when(agree.isNull(), "no_validator")
              .when(agree, "resolved").otherwise("validator_mismatch"))
    judged = found.withColumn("status", status)
    ok = F.col("status") == "resolved"
    return judged.select(
        "record_id", F.col("key").alias("url_key"), F.col("r.record_id").alias("response_id"), "status",
        F.when(ok, merged_headers(theirs, mine)).otherwise(mine).alias("headers"),
        F.when(ok, F.col("r.payload_digest")).alias("payload_digest"),
        F.when(ok, F.col("r.payload_bytes")).alias("payload_bytes"))
