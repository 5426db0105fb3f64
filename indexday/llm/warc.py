"""Resolving not-modified revisits of web archives to the full response they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexday.llm.common import part_of, prepared, put_in_order

# Header fields of a 304 that must not replace those of the stored response: they speak of the message, not of
# the resource.
NOT_MERGED = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)

TRACKING = r"(?:utm_[^&=]*|ref|fbclid|gclid)(?:=[^&]*)?"


def canonical_url(url: str | Column) -> Column:
    """Host without ``www.`` and default port, path without trailing slash, sorted query without tracking
    parameters; scheme, user and fragment go. Null if there is no host."""
    url = F.col(url) if isinstance(url, str) else url
    bare = F.regexp_replace(url, r"#.*$", "")
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?@]*@)?", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1)), r"^www\.|:(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^{TRACKING}$"))
    joined = F.array_join(F.array_sort(kept), "&")
    return F.when(host != "", F.concat(host, path, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise("")))


def _lower_names(headers: Column) -> Column:
    """Header names in lower case; of names that differ in case only the last one stays."""
    lines = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.transform(lines, lambda e: e["key"])
    later = lambda e, i: F.exists(F.slice(names, i + 2, F.size(names) + 1), lambda n: n == e["key"])
    return F.map_from_entries(F.filter(lines, lambda e, i: ~later(e, i)))


def resolve(records: DataFrame) -> DataFrame:
    """The revisits of ``records`` with what they stand for.

    ``records`` holds record_id, url, captured_at, kind (``response`` or ``revisit``), status, headers (a map) and
    body. A revisit of status 304 is joined to the latest full response (a ``response`` of status 200) captured before it under
    the same canonical url; of those captured at the same time the one of largest record_id is the latest. Their validators
    must agree: entity tags if both have one (compared weakly), else modification dates. The result has record_id,
    canonical_url, captured_at, refers_to, ``outcome`` (``resolved``, ``no_response``, ``no_validator`` or
    ``changed``), and for resolved ones ``headers``, the response's with the permitted ones of the revisit over
    them, and ``body``.

    Records are written in order of url and time, so the as-of step is a running maximum over parts of the order
    that are bounded however hot a url is; headers and bodies are not part of it and are joined by row number.
    A null url, time or record has no match (``no_response``); null headers are none. Repeated rows are resolved
    each. An empty table gives no rows. Other columns are not read.
    """
    spark = records.sparkSession
    store = prepared(spark)
    none = F.create_map().cast("map<string,string>")
    rows = records.select(
        "record_id", "captured_at", "kind", "status", "body", canonical_url("url").alias("canonical_url"),
        F.coalesce(_lower_names(F.col("headers")), none).alias("headers"),
    )
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("canonical_url").isNotNull() & F.col("captured_at").isNotNull()
    rows = rows.withColumn("full", F.coalesce(full, F.lit(False)))
    # Of one moment, revisits come first: a response is earlier only if its time is.
    order = [F.col(c) for c in ("canonical_url", "captured_at", "full", "record_id")]
    ordered = put_in_order(rows, order, store, "records")

    light = ordered.select("row_at", "canonical_url", part_of().alias("part"), F.when(F.col("full"), F.col("row_at")).alias("at"))
    last = light.groupBy("canonical_url", "part").agg(F.max("at").alias("at"))
    earlier = Window.partitionBy("canonical_url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("canonical_url", "part", F.max("at").over(earlier).alias("carried"))
    running = Window.partitionBy("canonical_url", "part").orderBy("row_at").rowsBetween(Window.unboundedPreceding, -1)
    own = light.select("row_at", "canonical_url", "part", F.max("at").over(running).alias("own"))
    match = own.join(carried, ["canonical_url", "part"]).select("row_at", F.coalesce("own", "carried").alias("match"))

    revisits = ordered.filter("kind = 'revisit' AND status = 304").select(
        "row_at", "record_id", "canonical_url", "captured_at", F.col("headers").alias("new")
    )
    known = revisits.join(match.filter("match IS NOT NULL"), "row_at", "left")
    known = known.withColumn("match", F.when(F.col("captured_at").isNotNull(), F.col("match")))
    responses = ordered.filter("full").select(
        F.col("row_at").alias("match"), F.col("record_id").alias("refers_to"), F.col("headers").alias("old"), "body"
    )
    joined = known.join(responses, "match", "left")

    tag = lambda h: F.regexp_replace(h["etag"], r"^W/", "")
    tags = tag(F.col("old")) == tag(F.col("new"))
    dates = F.col("old")["last-modified"] == F.col("new")["last-modified"]
    agree = F.coalesce(tags, dates)
    outcome = (
        F.when(F.col("old").isNull(), "no_response").when(agree.isNull(), "no_validator").when(agree, "resolved").otherwise("changed")
    )
    permitted = F.map_filter("new", lambda k, _: ~k.isin(*NOT_MERGED))
    merged = F.map_concat(F.map_filter("old", lambda k, _: ~F.map_contains_key(permitted, k)), permitted)
    done = F.col("outcome") == "resolved"
    return joined.withColumn("outcome", outcome).select(
        "record_id", "canonical_url", "captured_at", "refers_to", "outcome",
        F.when(done, merged).alias("headers"), F.when(done, F.col("body")).alias("body"),
    )


def capture_log(pages: DataFrame) -> DataFrame:
    """Records as a crawler would have left them for ``pages``: each page once in full, and a later revisit of it.

    Every fifth revisit has another entity tag, every fifth a weak one and every fifth a modification date only.
    """
    md5, turn = F.md5(F.col("html").cast("binary")), F.pmod("page_id", F.lit(5))
    tag = F.concat(F.lit('"'), md5, F.lit('"'))
    date = F.concat(F.lit("day "), F.col("page_id").cast("string"))

    def record(number: int, delay: int, kind: str, status: int, body: Column, **headers: Column) -> DataFrame:
        lines = F.array(*[F.struct(F.lit(k.replace("_", "-")).alias("k"), v.cast("string").alias("v")) for k, v in headers.items()])
        return pages.select(
            (F.col("page_id") * 2 + number).alias("record_id"), "url", (F.col("page_id") + delay).alias("captured_at"),
            F.lit(kind).alias("kind"), F.lit(status).alias("status"),
            F.map_from_entries(F.filter(lines, lambda x: x["v"].isNotNull())).alias("headers"), body.alias("body"),
        )

    new_tag = F.when(turn == 0, F.lit('"new"')).when(turn == 1, F.concat(F.lit("W/"), tag)).when(turn > 2, tag)
    return record(
        0, 0, "response", 200, F.col("html"), ETag=tag, Last_Modified=date, Content_Length=F.octet_length("html"),
        Cache_Control=F.lit("max-age=60"),
    ).unionAll(
        record(
            1, 1000, "revisit", 304, F.lit(None).cast("string"), etag=new_tag, last_modified=date, content_length=F.lit("0"),
            cache_control=F.lit("max-age=120"), Date=F.concat(F.lit("later than "), date),
        )
    )
