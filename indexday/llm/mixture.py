"""Mixing sources to target weights by drawing fixed-length blocks of words."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexday.llm.common import free_name, part_of, prepared, put_in_order
from indexday.operators.sizing import broadcast_if_small

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BLOCK_WORDS = 512
SHARD_SLOTS = 1024
SEED = 5
UNIT = 1 << 53


def n_words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """(source, source_size) with ``source_no``, ``weight`` and ``target``.

    Sources are numbered by code point, null last, and weighted in turn. Targets share ``share`` times all
    sizes by weight, none above ``most`` times its source's size: in order of that bound per weight, a source
    stops at its bound if its part of what is left reaches it, and the others share the rest by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    numbered = sizes.withColumn("source_no", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.get(F.array(*[F.lit(w) for w in weights]), turn)
    )
    by_bound = Window.orderBy(F.col("bound") / F.col("weight"), "source_no")
    before, on = by_bound.rowsBetween(Window.unboundedPreceding, -1), by_bound.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    bounded = numbered.withColumn("bound", F.col("source_size") * F.lit(most)).withColumn(
        "total", F.sum("source_size").over(everything) * F.lit(share)
    )
    left = F.col("total") - F.coalesce(F.sum("bound").over(before), F.lit(0.0))
    full = bounded.withColumn("full", left * F.col("weight") / F.sum("weight").over(on) >= F.col("bound"))
    rest = F.col("total") - F.sum(F.when(F.col("full"), F.col("bound")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("full"), F.col("bound")).otherwise(rest * F.col("weight") / F.nullif(open_weight, F.lit(0)))
    return full.withColumn("target", target).select("source", "source_size", "source_no", "weight", "target")


@dataclass(frozen=True)
class Mixture:
    """A drawn mixture.

    ``rows``: the input's rows with ``row_at`` (their key), ``size``, ``source_no`` and ``start``, their place
    in their source's words. ``sources``: :func:`targets`. ``slots``: the mixture, (shard, slot, source_no, block,
    epoch, taken): block ``block`` of a source, the first ``taken`` words of it.
    """

    rows: DataFrame
    sources: DataFrame
    slots: DataFrame
    block_words: int

    def pieces(self) -> DataFrame:
        """(row_at, epoch, from_word, to_word): the words of each row that the mixture takes, block by block."""
        b = F.lit(self.block_words)
        end = F.col("start") + F.col("size")
        spread = self.rows.filter("size > 0").select(
            "row_at", "source_no", "start", end.alias("end"),
            F.explode(F.sequence((F.col("start") / b).cast("long"), ((end - 1) / b).cast("long"))).alias("block"),
        )
        first = F.greatest(F.col("start"), F.col("block") * b)
        used = F.least(F.col("end"), F.col("block") * b + F.col("taken"))
        slots = self.slots.select("source_no", "block", "epoch", "taken")
        return (
            spread.join(slots, ["source_no", "block"])
            .filter(used > first)
            .select("row_at", "epoch", (first - F.col("start")).alias("from_word"), (used - F.col("start")).alias("to_word"))
        )

    def taken(self) -> DataFrame:
        """``rows`` with ``taken``, the words the mixture takes of each, repeats counted."""
        sums = self.pieces().groupBy("row_at").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
        return self.rows.join(sums, "row_at", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))

    def documents(self, text_col: str = "text") -> DataFrame:
        """The mixture as documents: for each row and epoch its taken words, the whole text if all are taken.

        Words of partly taken rows stand between single spaces; ``whole`` tells them from the others.
        """
        spans = self.pieces().groupBy("row_at", "epoch").agg(
            F.sort_array(F.collect_list(F.struct("from_word", "to_word"))).alias("spans"),
            F.sum(F.col("to_word") - F.col("from_word")).alias("in_copy"),
        )
        words = F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0))
        # The words are bound once: an expression inside a lambda would be worked out for every span.
        piece = lambda w: F.transform("spans", lambda s: F.slice(w, s["from_word"] + 1, s["to_word"] - s["from_word"]))
        cut = F.transform(F.array(words), lambda w: F.concat_ws(" ", F.flatten(piece(w))))[0]
        joined = self.rows.join(spans, "row_at")
        joined = joined.withColumn("whole", F.col("in_copy") == F.col("size"))
        return joined.withColumn(text_col, F.when(F.col("whole"), F.col(text_col)).otherwise(cut)).drop("spans", "in_copy")


def mix(
    docs: DataFrame, keep: list[str] | None = None, source_col: str = "source", size: Column | None = None,
    order: list[str] | None = None, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED,
    weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
) -> Mixture:
    """Mix the rows of ``docs`` to the targets of :func:`targets`.

    Rows are laid end to end within their source, in the order of ``order`` (doc_id), and packed into blocks
    of ``block_words`` words. A source's blocks are put in a pseudorandom order once per epoch (a repeat of
    the source), so no word is taken more than twice. The output is a row of shards of ``shard_slots`` slots;
    every slot draws its source by target weight, which gives each shard a multinomial count per source. Where
    all shards together drew more of a source than its target holds, the last of these slots go to the
    sources drawn too rarely, so every source meets its target to the word. A source's i-th slot is joined
    with its i-th block. Draws hash the seed and the slot number, so reruns agree.

    Null texts and texts without words have size 0 and are never taken. A null source is a source of its own.
    Repeated rows each take their own place. An empty table, or one without words, gives an empty mixture.
    ``keep`` names the columns that ``rows`` carries (all if None; columns with the names ``rows`` needs for
    itself are left out).
    """
    spark = docs.sparkSession
    store = prepared(spark)
    own = {"row_at", "size", "source_no", "start", "source_size", "target", "source", "taken", "epoch", "whole"}
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in own]
    order = ["doc_id"] if order is None else order
    sized = docs.select(*keep, F.col(source_col).alias("source"), (n_words("text") if size is None else size).alias("size"))
    by = [F.col("source").asc_nulls_last(), *[F.col(c) for c in order if c in keep], F.col("size")]
    ordered = put_in_order(sized, by, store, "mixture_rows")

    per_part = ordered.groupBy("source", part_of().alias("part")).agg(F.sum("size").alias("words"))
    per_part = store.put("mixture_parts", per_part)
    sources = store.put("mixture_sources", targets(per_part.groupBy("source").agg(F.sum("words").alias("source_size"))))
    small = broadcast_if_small(sources)
    earlier = Window.partitionBy("source_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        per_part.withColumnRenamed("source", "s").join(small, F.col("s").eqNullSafe(F.col("source")))
        .select("part", "source_no", "source_size", "target", F.col("s"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    )
    in_part = Window.partitionBy(part_of(), "source").orderBy("row_at").rowsBetween(Window.unboundedPreceding, -1)
    local = ordered.select("row_at", "source", "size", F.coalesce(F.sum("size").over(in_part), F.lit(0)).alias("at"))
    local = local.withColumn("_part", part_of())
    starts = local.join(
        broadcast_if_small(offsets), (F.col("_part") == F.col("part")) & F.col("source").eqNullSafe(F.col("s"))
    ).select("row_at", "source_no", "source_size", "target", "source", "size", (F.col("offset") + F.col("at")).alias("start"))
    starts = store.put("mixture_starts", starts)
    rows = starts if not keep else ordered.select("row_at", *keep).join(starts, "row_at")

    b = block_words
    plan = _slot_counts(sources, b)
    blocks = _ordered_blocks(starts, plan, b, seed, store)
    drawn = _draw(spark, plan, shard_slots, seed, store)
    slots = drawn.join(blocks, ["source_no", "i"]).select("shard", "slot", "source_no", "block", "epoch", "taken")
    return Mixture(rows, sources, store.put("mixture_slots", slots), b)


def _slot_counts(sources: DataFrame, b: int) -> DataFrame:
    """For each source: whole blocks, words of the last short one, slots to fill and words in the last slot."""
    s, t = F.col("source_size"), F.col("words")
    return (
        sources.filter("source_size > 0 AND target > 0")
        .select("source_no", "source_size", "target", F.round("target").cast("long").alias("words"))
        .withColumn("whole", F.expr(f"source_size div {b}"))
        .withColumn("short", F.pmod(s, F.lit(b)))
        .withColumn("blocks", F.col("whole") + (F.col("short") > 0).cast("long"))
        .withColumn("epochs", F.expr("words div source_size"))
        .withColumn("rest", F.pmod(t, s))
        .withColumn("tail", F.pmod(F.col("rest"), F.lit(b)))
        .withColumn("slots", F.expr(f"epochs * blocks + rest div {b}") + (F.col("tail") > 0).cast("long"))
        .filter("slots > 0")
    )


def _ordered_blocks(starts: DataFrame, plan: DataFrame, b: int, seed: int, store) -> DataFrame:
    """(source_no, i, block, epoch, taken): the block that a source's i-th slot takes.

    A block comes from the row that holds its first word. Within an epoch a source's blocks are ordered by a
    hash, the short one last.
    """
    first = F.expr(f"(start + {b - 1}) div {b}")
    last = F.expr(f"(start + size + {b - 1}) div {b} - 1")
    begun = starts.filter("size > 0").select("source_no", first.alias("first"), last.alias("last")).filter("first <= last")
    blocks = begun.select("source_no", F.explode(F.sequence("first", "last")).alias("block"))
    plan = plan.select("source_no", "whole", "short", "blocks", "slots", "tail")
    epochs = F.expr("(slots + blocks - 1) div blocks - 1")
    planned = blocks.join(broadcast_if_small(plan), "source_no")
    each = planned.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), epochs)))
    mixed = F.xxhash64(F.lit(seed), "source_no", "epoch", "block")
    each = each.withColumn("short_one", F.col("block") == F.col("whole")).withColumn("at", mixed)
    ordered = put_in_order(each, [F.col(c) for c in ("source_no", "epoch", "short_one", "at", "block")], store, "mixture_order")
    groups = ordered.groupBy(part_of().alias("part"), "source_no").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = groups.select("part", "source_no", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("_part", "source_no").orderBy("row_at")
    placed = ordered.withColumn("_part", part_of()).withColumn("_row", F.row_number().over(inside) - 1)
    before = before.withColumnsRenamed({"part": "_part"})
    numbered = placed.join(broadcast_if_small(before), ["_part", "source_no"]).withColumn("i", F.col("before") + F.col("_row"))
    length = F.when(F.col("short_one"), F.col("short")).otherwise(F.lit(b))
    is_tail = (F.col("i") == F.col("slots") - 1) & (F.col("tail") > 0)
    return numbered.filter("i < slots").select(
        "source_no", "i", "block", "epoch", F.when(is_tail, F.col("tail")).otherwise(length).cast("long").alias("taken")
    )


def _draw(spark, plan: DataFrame, shard_slots: int, seed: int, store) -> DataFrame:
    """(shard, slot, source_no, i): every output slot's source, and its number among that source's slots."""
    plan = store.put("mixture_plan", plan)
    total = plan.agg(F.sum("slots")).first()[0] or 0
    running = Window.orderBy("source_no")
    shares = plan.select("source_no", F.sum("slots").over(running).alias("upto"))
    # One value: an entry per source.
    wheel = shares.agg(F.sort_array(F.collect_list(F.struct("upto", "source_no"))).alias("wheel"))
    point = F.pmod(F.xxhash64(F.lit(seed), F.lit("slot"), "id"), F.lit(UNIT)).cast("double") / F.lit(float(UNIT)) * F.lit(float(total))
    slots = spark.range(total).select(
        "id", F.expr(f"id div {shard_slots}").alias("shard"), F.expr(f"id % {shard_slots}").alias("slot"),
        point.alias("point"),
    )
    spun = slots.withColumn("wheel", wheel.scalar())
    under = F.size(F.filter("wheel", lambda w: w["upto"] <= F.col("point")))
    drawn = spun.select("id", "shard", "slot", F.get(F.col("wheel"), F.least(under, F.size("wheel") - 1))["source_no"].alias("source_no"))
    drawn = store.put("mixture_drawn", drawn)

    counts = drawn.groupBy("shard", "source_no").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "source_no", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "source_no").orderBy("id")
    numbered = (
        drawn.withColumn("_row", F.row_number().over(inside) - 1).join(before, ["shard", "source_no"])
        .select("id", "shard", "slot", "source_no", (F.col("before") + F.col("_row")).alias("i"))
    )

    # What was drawn too often is handed, slot by slot, to what was drawn too rarely.
    held = drawn.groupBy("source_no").agg(F.count("*").alias("drawn"))
    ledger = plan.select("source_no", "slots").join(held, "source_no", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    ledger = ledger.withColumn("over", F.greatest(F.col("drawn") - F.col("slots"), F.lit(0)))
    ledger = ledger.withColumn("under", F.greatest(F.col("slots") - F.col("drawn"), F.lit(0)))
    up_to = running.rowsBetween(Window.unboundedPreceding, -1)
    ledger = ledger.withColumn("over_before", F.coalesce(F.sum("over").over(up_to), F.lit(0)))
    ledger = store.put("mixture_ledger", ledger.withColumn("under_before", F.coalesce(F.sum("under").over(up_to), F.lit(0))))
    known = numbered.join(broadcast_if_small(ledger.select("source_no", "slots", "over_before")), "source_no")
    kept = known.filter("i < slots").select("shard", "slot", "source_no", "i")
    spare = known.filter("i >= slots").select("shard", "slot", (F.col("over_before") + F.col("i") - F.col("slots")).alias("number"))
    wanted = ledger.filter("under > 0").select(
        "source_no", "drawn", "under_before", F.explode(F.sequence(F.lit(0).cast("long"), F.col("under") - 1)).alias("j")
    )
    wanted = wanted.select("source_no", (F.col("drawn") + F.col("j")).alias("i"), (F.col("under_before") + F.col("j")).alias("number"))
    moved = spare.join(wanted, "number").select("shard", "slot", "source_no", "i")
    return kept.unionByName(moved)
