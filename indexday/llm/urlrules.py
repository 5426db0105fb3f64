"""Allow and block rules on URLs: a sorted sweep over reversed-host keys and nested rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexday.llm.common import part_of, pieces, prepared, put_in_order
from indexday.operators.sizing import broadcast_if_small
from indexday.sources import StageStore

ALLOW, BLOCK = "allow", "block"
OPEN, POINT, CLOSE = 0, 1, 2
AFTER_ALL = "X'FF'"  # no byte of UTF-8 is as high, so it ends the interval of keys that a prefix starts


def _lower(text: str | Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: str | Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased."""
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: str) -> Column:
    """The labels of a host, the top domain first."""
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column, path: Column) -> Column:
    """Bytes of the reversed labels, a slash (no host holds one) and the path: a rule's key starts those it fits."""
    return F.concat(F.concat_ws(".", labels), F.lit("/"), path).cast("binary")


def sweep(events: DataFrame, n: int, store: StageStore) -> DataFrame:
    """(row, rule) for each point with an open rule, from events (key, kind, row, rule): the innermost open rule.

    A rule opens before and closes after all keys that it starts, so open rules are nested and form a stack. Its top at
    depth d is the last rule opened at depth d: had that one been closed, the next to reach d would be later.
    Sorted ranges are swept apart: a range gets the depth at its beginning and, for each depth, the last rule opened
    there before, at most one line per depth and range.
    """
    step = F.when(F.col("kind") == OPEN, 1).when(F.col("kind") == CLOSE, -1).otherwise(0)
    ordered = put_in_order(events, [F.col("key"), F.col("kind"), F.col("row")], store, "url_events", n=n)
    placed = ordered.select("row_at", part_of().alias("part"), "kind", "row", "rule", step.alias("step"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    steps = placed.groupBy("part").agg(F.sum("step").alias("steps"))
    entry = steps.select("part", F.coalesce(F.sum("steps").over(before), F.lit(0)).alias("entry"))
    so_far = Window.partitionBy("part").orderBy("row_at").rowsBetween(Window.unboundedPreceding, 0)
    depth = F.col("entry") + F.sum("step").over(so_far)
    deep = placed.join(broadcast_if_small(entry), "part").withColumn("depth", depth)
    deep = deep.filter((F.col("kind") != CLOSE) & (F.col("depth") > 0)).drop("entry", "step")
    deep = store.put("url_depths", deep)

    opened = F.when(F.col("kind") == OPEN, F.col("row_at"))
    earlier = Window.partitionBy("depth").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    levels = deep.groupBy("part", "depth").agg(F.max_by("rule", opened).alias("last_opened"))
    carried = F.last("last_opened", ignorenulls=True).over(earlier)
    levels = store.put("url_levels", levels.select("part", "depth", carried.alias("carried")))
    here = Window.partitionBy("part", "depth").orderBy("row_at").rowsBetween(Window.unboundedPreceding, 0)
    top = F.coalesce(F.last("rule", ignorenulls=True).over(here), F.col("carried"))
    swept = deep.join(broadcast_if_small(levels), ["part", "depth"]).withColumn("top", top)
    return swept.filter(F.col("kind") == POINT).select("row", F.col("top").alias("rule"))


def judge(pages: DataFrame, rules: DataFrame, id: str = "page_id", url: str = "url", default: str = ALLOW) -> DataFrame:
    """(id, host, path, rule, verdict) for each row of ``pages``, by its URL.

    ``rules`` holds host, path and verdict (``allow`` or ``block``). A rule fits its host and all subdomains where the
    URL's path starts with the rule's. The longest (host and path together, then host, in characters) decides. Without one, ``rule``
    is null and the verdict ``default``.

    A URL is a point once for each domain its host lies in, up to the most labels of a rule's host, and a rule the
    interval of keys that its own key starts; both are sorted together and swept. A key keeps as much of
    the path as the longest rule has, since what follows cannot matter. Equal keys are ordered by row, so a URL on a third
    of all rows fills as many ranges as it needs.

    Null URLs and those without ``://`` have an empty host and path, and fit no rule. Rules with a null or empty
    host or a null verdict are left out; a null path is empty and fits every path; of rules with equal host and path,
    block wins. Repeated rows and null ids are judged each. Empty tables give no rows, or the default for all. Other columns are
    not read.
    """
    store = prepared(pages.sparkSession)
    known = rules.select(_lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    known = known.filter("host <> '' AND verdict IS NOT NULL").groupBy("host", "path")
    known = store.put("url_rules", known.agg(F.max("verdict").alias("verdict")))
    longest = known.agg(
        F.coalesce(F.max(F.size(_labels("host"))), F.lit(0)).alias("labels"),
        F.coalesce(F.max(F.char_length("path")), F.lit(0)).alias("path"),
    ).first()
    parsed = pages.select(
        F.col(f"`{id}`").alias("id"), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path")
    )
    urls = store.put("urls", parsed.withColumn("row", F.monotonically_increasing_id()))
    rule = F.struct(
        F.char_length(F.concat("host", "path")).alias("size"),
        F.char_length("host").alias("host_size"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    none = F.lit(None).cast("long").alias("row")
    own = known.select(_key(_labels("host"), F.col("path")).alias("key"), rule.alias("rule"))
    opens = own.select("key", F.lit(OPEN).alias("kind"), none, "rule")
    closes = own.select(F.concat("key", F.expr(AFTER_ALL)).alias("key"), F.lit(CLOSE).alias("kind"), none, "rule")
    domains = F.sequence(F.lit(1), F.least(F.size(_labels("host")), F.lit(longest.labels)))
    start = F.substring("path", 1, longest.path)
    points = urls.filter(F.lit(longest.labels > 0) & (F.col("host") != "")).select("host", "path", "row", F.explode(domains).alias("n"))
    points = points.select(
        _key(F.slice(_labels("host"), 1, F.col("n")), start).alias("key"), F.lit(POINT).alias("kind"), "row",
        F.lit(None).cast(own.schema["rule"].dataType).alias("rule"),
    )
    found = sweep(opens.unionAll(points).unionAll(closes), pieces(urls), store)
    best = found.groupBy("row").agg(F.max("rule").alias("best"))
    return urls.join(best, "row", "left").select(
        F.col("id").alias(id), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
