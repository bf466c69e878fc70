"""Not-modified revisits of a crawl, resolved to the full response they stand for.

A revisit says that a page had not changed; its content is that of the latest earlier full response
of the same canonical URL. This is an as-of join: responses and revisits of a URL on one timeline,
the last response carried forward. A URL with very many captures is cut into slices of its timeline
(``functions.timeline``). Only ids, validators and headers are carried; payloads are joined
afterwards, by the id of the response.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timeline import ROWS_PER_SLICE, Timeline, latest
from tidemark.llm.text import without

#: The header fields that a not-modified answer may renew.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]

#: Query parameters that name a visit, not a page.
TRACKING = r"^(utm_[a-z]+|gclid|fbclid|ref)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without a closing slash, query parameters sorted and without
    those of tracking; scheme and fragment do not count. What has no scheme stays as it is, trimmed."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    parts = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)([^?]*)\??(.*)$"
    host = F.regexp_replace(F.lower(F.regexp_extract(plain, parts, 1)), r"(^www\.|:80$|:443$)", "")
    path = F.regexp_replace(F.regexp_extract(plain, parts, 2), "/+$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(plain, parts, 3), "&"),
                                  lambda p: (p != "") & ~p.rlike(TRACKING)))
    full = F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))
    return F.when(plain.rlike(parts), full).otherwise(plain)


def _tag(etag: Column) -> Column:
    """Entity tags compare weakly: the mark of a weak tag does not count."""
    return F.regexp_replace(F.trim(etag), "^W/", "")


def _lower_names(headers: Column) -> Column:
    """A header that occurs twice under different capitals keeps the value that sorts last."""
    entries = F.array_sort(F.transform(F.map_entries(headers), lambda e: F.struct(
        F.lower(e["key"]).alias("key"), e["value"].alias("value"))))
    return F.aggregate(entries, F.create_map().cast("map<string,string>"), lambda m, e: F.map_concat(
        F.map_filter(m, lambda k, _: k != e["key"]), F.create_map(e["key"], e["value"])))


def merged_headers(original: Column, renewed: Column) -> Column:
    """The response's headers with the permitted ones of the revisit in place of its own; names in lower case."""
    empty = F.create_map().cast("map<string,string>")
    old, new = F.coalesce(_lower_names(original), empty), F.coalesce(_lower_names(renewed), empty)
    fresh = F.map_filter(new, lambda k, v: k.isin(PERMITTED) & v.isNotNull())
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(fresh, k)), fresh)


def resolve(records: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """The revisits of ``records`` (``record_id``, ``url``, ``captured_at``, ``kind``, ``status``, ``etag``, ``last_modified``, ``headers``),
    with ``canonical_url``, ``original_id`` (the latest earlier full response), ``outcome`` and ``merged_headers``.

    Full is a ``response`` with status 200. Of responses at one time the one with the largest id counts; one at the
    revisit's own time is not earlier. Outcomes: ``resolved`` if the validators agree (the entity tags, if both
    have one, else the dates of last change), ``changed`` if they differ, ``unchecked`` if the two have no
    validator in common, ``no_original``. Headers are merged only when resolved, else they are the revisit's own. A
    revisit without URL or time has no original; equal revisits stay separate rows."""
    kept = without(records, ["kind", "status", "canonical_url", "original_id", "outcome", "merged_headers", "payload"])
    url = canonical_url(F.col("url"))
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("record_id").isNotNull()
    lined = records.where((F.col("kind") == "revisit") | full).select(
        *kept, url.alias("canonical_url"), F.coalesce(full, F.lit(False)).alias("_full"))
    placed = F.col("canonical_url").isNotNull() & F.col("captured_at").isNotNull()
    here = F.struct(F.col("record_id").alias("id"), "etag", "last_modified", "headers")
    # at equal times revisits come first: the carried response is strictly earlier
    line = Timeline(lined.where(placed), ["canonical_url"], ["captured_at", "_full", "record_id"], rows_per_slice)
    seen = line.running(_original=latest(F.when(F.col("_full"), here))).rows
    lost = lined.where(~placed)
    found = seen.unionByName(lost.withColumn("_original", F.lit(None).cast(seen.schema["_original"].dataType))).where(
        "not _full")
    tags = F.col("etag").isNotNull() & F.col("_original.etag").isNotNull()
    dates = F.col("last_modified").isNotNull() & F.col("_original.last_modified").isNotNull()
    same = F.when(tags, _tag(F.col("etag")) == _tag(F.col("_original.etag"))).when(
        dates, F.trim("last_modified") == F.trim(F.col("_original.last_modified")))
    outcome = F.when(F.col("_original").isNull(), "no_original").when(same, "resolved").when(
        ~same, "changed").otherwise("unchecked")
    judged = found.withColumn("outcome", outcome)
    headers = F.when(F.col("outcome") == "resolved", merged_headers(F.col("_original.headers"), F.col("headers"))).otherwise(
        _lower_names(F.col("headers")))
    return judged.select(*kept, "canonical_url", F.col("_original.id").alias("original_id"), "outcome",
                         headers.alias("merged_headers"))


def with_payload(resolved: DataFrame, records: DataFrame) -> DataFrame:
    """Add the ``payload`` of the response to resolved revisits; null for others. A record_id that occurs more than once among the
    responses takes the least payload. Revisits that are not resolved have keys of their own in the join, which meet nothing and
    are spread over its tasks."""
    alone = F.concat(F.lit("none "), F.xxhash64("record_id", "url", "captured_at").cast("string"))
    key = F.when(F.col("outcome") == "resolved", F.col("original_id").cast("string")).otherwise(alone)
    content = records.where("kind = 'response' and status = 200 and record_id is not null").groupBy(
        F.col("record_id").cast("string").alias("_id")).agg(F.min("payload").alias("payload"))
    kept = without(resolved, ["payload", "_key", "_id"])
    return resolved.select(*kept, key.alias("_key")).join(content, F.col("_key") == F.col("_id"), "left").select(*kept, "payload")
