"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets: every source gets its weight's share of all sizes, but at most ``cap`` times its own size; what
exceeds that is shared again by weight until no source is above (one level computed from running sums).

Selection: a source first takes whole epochs (every document once each), then a fraction.  For the fraction
each document draws an exponential key, ``-ln(u) / weight`` with ``u`` hashed from its identity and
``weight`` its quality weight; the smallest keys come first and documents are taken while the running sum of
sizes stays within the rest of the budget (a document counts from its middle, so the miss is half of one
document at most).

The running sum never meets in one task for a whole source: the keys between the least and the greatest are cut into
``SLICES`` ranges, slice totals give the slice where the budget ends, and that slice is cut again until it holds
``EDGE`` rows at most; only those are ordered.  Keys that are equal (an identity that is null or comes again) are cut by a hash of
identity and text.  The outcome is one cut per source, so the rows themselves are joined with a table of one row per source and
are not moved.

Defined results: a null text has size 0; very long texts count whole; a null source is a source of its own and comes last; empty sources
have target 0; repeated rows, alike in identity and text, are taken or left together; an empty
table stays empty; other columns are kept and a column named like a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import WORD, durable, fresh

SLICES = 2048
EDGE = 1 << 12
#: Up to so many sources their cuts are sent to every executor; more are joined by a shuffle.
BROADCAST_SOURCES = 50_000
CYCLE = (5, 2, 1)
JUNK = r"[#$%&*|!<>{}0-9]"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def clean_weight(text: Column, size: Column) -> Column:
    """Quality weight from 0.25 to 1 that falls with the symbols and digits for each word."""
    junk = F.coalesce(F.regexp_count(text, F.lit(JUNK)), F.lit(0))
    return F.lit(0.25) + F.lit(0.75) / (F.lit(1.0) + junk.cast("double") / F.greatest(size, F.lit(1)).cast("double"))


def uniform(identity: Column, seed: int) -> Column:
    """52 hashed bits of the identity, strictly between 0 and 1."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), identity).cast("binary")), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, source: str, cap: float, cycle: tuple[int, ...]) -> DataFrame:
    """Per source: ``source_size``, ``target``.  ``sizes`` has one row per source, so the plain windows are small."""
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, cycle)), ((F.row_number().over(by_name) - 1) % len(cycle)).cast("int") + 1).cast("double")
    ranked = sizes.withColumn("w", weight).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    order = Window.orderBy((F.col("most") / F.col("w")).asc(), F.col(source).asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levelled = ranked.select(
        "*",
        F.sum("source_size").over(all_rows).cast("double").alias("total"),
        F.coalesce(F.sum("most").over(before), F.lit(0.0)).alias("spent"),
        F.sum("w").over(after).alias("open"),
    ).withColumn("level", (F.col("total") - F.col("spent")) / F.col("open"))
    fits = F.col("level") * F.col("w") <= F.col("most")
    final = F.min(F.when(fits, F.struct(F.col("most") / F.col("w"), F.col("level").alias("level")))).over(all_rows)["level"]
    target = F.least(F.col("most"), F.coalesce(final * F.col("w"), F.col("most")))
    return levelled.select(source, "source_size", target.alias("target"))


def mix_sources(
    df: DataFrame,
    identity: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weight: Column | None = None,
    cap: float = 3.0,
    cycle: tuple[int, ...] = CYCLE,
    seed: int = 11,
    size: Column | None = None,
    content: Column | None = None,
    edge: int = EDGE,
) -> DataFrame:
    """``size`` and ``content`` (what tells rows of one identity apart) spare the texts where they are known.

    Returns ``df`` with ``size``, ``source_size``, ``target``, ``times`` (whole copies to take) and ``taken`` (words)."""
    if cap < 1:
        raise ValueError("a cap below one cannot give out all sizes")
    key, tie, src, src2 = fresh(df, "mix_key", "mix_tie", "mix_source", "mix_source_right")
    name = F.coalesce(F.col(identity).cast("string"), F.lit(""))
    quality = weight if weight is not None else clean_weight(F.col(text), F.col("size"))
    keyed = df.withColumns({"size": word_count(F.col(text)) if size is None else size.cast("long"), src: F.col(source)})
    keyed = keyed.withColumns({key: -F.log(uniform(name, seed)) / quality, tie: F.xxhash64(name, F.xxhash64(text) if content is None else content)})
    # the narrow rows are used several times, the texts are read for them once
    cuts = _cuts(durable(keyed.select(F.col(src).alias("s"), F.col(key).alias("k"), F.col(tie).alias("h"), "size")), cap, cycle, edge)
    cuts = durable(cuts.withColumnRenamed("s", src2))
    cuts = F.broadcast(cuts) if cuts.count() <= BROADCAST_SOURCES else cuts
    one_key = F.col("k_low") == F.col("k_high")
    before = (F.col(key) < F.col("k_low")) | (one_key & (F.col(key) == F.col("k_low")) & (F.col(tie) < F.col("h_low")))
    within = (F.col(key) < F.col("cut_k")) | ((F.col(key) == F.col("cut_k")) & (F.col(tie) <= F.col("cut_h")))
    taken_again = (F.coalesce(before, F.lit(False)) | F.coalesce(within, F.lit(False))).cast("int")
    joined = keyed.drop("source_size", "target", "times", "taken").join(cuts, F.col(src).eqNullSafe(F.col(src2)))
    return (
        joined.withColumn("times", (F.col("epochs") + taken_again).cast("int"))
        .withColumn("taken", F.col("times") * F.col("size"))
        .drop(key, tie, src, src2, "epochs", "k_low", "k_high", "h_low", "cut_k", "cut_h")
    )


RANGE = ("k_low", "k_high", "h_low", "h_high")


def _spread() -> list[Column]:
    return [F.min("k").alias("k_low"), F.max("k").alias("k_high"), F.min("h").alias("h_low"), F.max("h").alias("h_high"), F.count("*").alias("n")]


def _inside(keyed: DataFrame, ranges: DataFrame) -> DataFrame:
    """The rows in their source's range."""
    right = ranges.withColumnRenamed("s", "rs")
    within = F.col("k").between(F.col("k_low"), F.col("k_high")) & F.col("h").between(F.col("h_low"), F.col("h_high"))
    return keyed.join(F.broadcast(right) if right.count() <= BROADCAST_SOURCES else right, F.col("s").eqNullSafe(F.col("rs")) & within).drop("rs")


def _narrowed(keyed: DataFrame, ranges: DataFrame) -> DataFrame:
    """The ranges cut to the slice where each budget ends."""
    rows = _inside(keyed, ranges)
    part = lambda x, low, high: F.least(F.floor((x - low) / (high - low) * SLICES), F.lit(SLICES - 1))
    hashed = [F.col(c).cast("double") for c in ("h", "h_low", "h_high")]
    by_hash = F.when(hashed[1] < hashed[2], part(*hashed)).otherwise(0)
    slice_ = F.when(F.col("k_low") < F.col("k_high"), part(*(F.col(c) for c in ("k", "k_low", "k_high")))).otherwise(by_hash).cast("int")
    # SLICES rows for a source at most
    slices = rows.groupBy("s", "start", "rest", slice_.alias("slice")).agg(F.sum("size").alias("slice_size"), *_spread())
    before = Window.partitionBy("s").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.withColumn("start", F.col("start") + F.coalesce(F.sum("slice_size").over(before), F.lit(0)))
    last = starts.where("start <= rest").groupBy("s").agg(F.max(F.struct("slice", "start", "rest", *RANGE, "n")).alias("x"))
    return durable(last.select("s", "x.start", "x.rest", *(f"x.{c}" for c in (*RANGE, "n"))))


def _cuts(keyed: DataFrame, cap: float, cycle: tuple[int, ...], edge: int) -> DataFrame:
    """Per source: its size, target, whole epochs, the range of keys where the fraction ends and the last key (with tie) it takes there."""
    sizes = keyed.groupBy("s").agg(F.sum("size").alias("source_size"), *_spread())
    targets = source_targets(sizes.select("s", "source_size"), "s", cap, cycle)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    plan = durable(targets.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    rests = plan.select(F.col("s").alias("ps"), "rest")
    ranges = sizes.join(rests, F.col("s").eqNullSafe(F.col("ps"))).select("s", F.lit(0).cast("long").alias("start"), "rest", *RANGE, "n")
    ranges = durable(ranges)
    wide = (F.col("n") > edge) & ((F.col("k_low") < F.col("k_high")) | (F.col("h_low").cast("double") < F.col("h_high").cast("double")))
    while not ranges.where(wide).isEmpty():
        ranges = _narrowed(keyed, ranges)
    rows = _inside(keyed, ranges).groupBy("s", "start", "rest", "k", "h").agg(F.sum("size").alias("size"))
    running = Window.partitionBy("s").orderBy("k", "h").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("prior", F.col("start") + F.coalesce(F.sum("size").over(running), F.lit(0)))
    # running middles grow with the key, so what fits is a prefix of the range
    found = rows.where((F.col("prior") + F.col("size") / 2) <= F.col("rest")).groupBy("s").agg(F.max(F.struct("k", "h")).alias("cut"))
    found = found.select(F.col("s").alias("fs"), F.col("cut.k").alias("cut_k"), F.col("cut.h").alias("cut_h"))
    ends = ranges.select(F.col("s").alias("es"), "k_low", "k_high", "h_low").join(found, F.col("es").eqNullSafe(F.col("fs")), "left").drop("fs")
    return plan.join(ends, F.col("s").eqNullSafe(F.col("es")), "left").select("s", "source_size", "target", "epochs", "k_low", "k_high", "h_low", "cut_k", "cut_h")
