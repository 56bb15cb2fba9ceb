"""Sharding by a Feistel permutation of global row numbers.

Every row gets a global number from the content alone (so files, partitions and executors do not matter),
a keyed Feistel network permutes the numbers of 0..N-1, walking the cycle while a value falls outside,
and the permuted number p gives shard ``p % shards`` and slot ``p // shards``.  The law is ``rows``: shard
sizes differ by one at most and slots have no gap.  Both directions can be computed without the data.

Numbering takes one wide shuffle: rows go to ``BUCKETS`` buckets by a hash of their key columns, are
numbered inside the bucket, and get the bucket's offset from a table of at most ``BUCKETS`` rows.  A source,
a text or any other value that many rows share does not make a bucket hot; only rows that are alike in
every key column meet.

Defined results: nulls hash like any other value; repeated rows get numbers next to each other, one each,
and it does not matter which of them gets which (they are the only ties, and share a bucket); very long texts only matter to
the hash; an empty table stays empty; other columns are kept, and one named like a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import fresh

BUCKETS = 1 << 16
ROUNDS = 6
WALK = 16
LAST_WALK = 192


def _mask(bits: str) -> str:
    return f"(shiftleft(1L, {bits}) - 1L)"


def _network(x: str, bits: str, seed: int) -> str:
    """SQL of one pass through the network over ``bits`` bits; the halves may differ in width by one."""
    low, high = f"cast({bits} / 2 as int)", f"cast({bits} - cast({bits} / 2 as int) as int)"
    state = f"named_struct('a', shiftright({x}, {low}), 'b', {x} & {_mask(low)})"
    for k in range(ROUNDS):
        if k % 2:
            state = f"transform(array({state}), s -> named_struct('a', s.a, 'b', s.b ^ (xxhash64(s.a, {seed + k}L) & {_mask(low)})))[0]"
        else:
            state = f"transform(array({state}), s -> named_struct('a', s.a ^ (xxhash64(s.b, {seed + k}L) & {_mask(high)}), 'b', s.b))[0]"
    return f"transform(array({state}), s -> shiftleft(s.a, {low}) | s.b)[0]"


def permuted(x: str, n: str, bits: str, seed: int) -> Column:
    """The permutation of 0..n-1 at ``x``; ``bits`` is the bit length of n - 1.

    Each step of the walk leaves less than half of the values outside; a value that were outside after all
    of ``WALK + LAST_WALK`` steps would stop the job rather than be misplaced.
    """
    walk = lambda start, steps: f"aggregate(sequence(1, {steps}), {start}, (v, i) -> if(v < {n}, v, {_network('v', bits, seed)}))"
    first = walk(_network(x, bits, seed), WALK)
    last = f"transform(array({walk('w', LAST_WALK)}), z -> if(z < {n}, z, cast(raise_error('cycle walk did not end') as bigint)))[0]"
    return F.expr(f"transform(array({first}), w -> if(w < {n}, w, {last}))[0]")


def number_rows(df: DataFrame, keys: list[str], number: str, total: str) -> DataFrame:
    """``df`` with its global row number and the number of all rows."""
    bucket, order, local, start = fresh(df, "bucket", "order", "local", "start")
    hashed = df.withColumn(order, F.xxhash64(*(F.col(k) for k in keys)))
    hashed = hashed.withColumn(bucket, F.pmod(F.col(order), F.lit(BUCKETS)).cast("int"))
    counts = hashed.groupBy(bucket).agg(F.count("*").alias("n"))
    running = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # one row for each bucket: at most BUCKETS rows, whatever the input
    offsets = counts.select(bucket, F.coalesce(F.sum("n").over(running), F.lit(0)).alias(start), F.sum("n").over(everything).alias(total))
    inside = Window.partitionBy(bucket).orderBy(order, *keys)
    return (
        hashed.withColumn(local, F.row_number().over(inside).cast("long") - 1)
        .join(F.broadcast(offsets), bucket)
        .withColumn(number, F.col(start) + F.col(local))
        .drop(bucket, order, local, start)
    )


def shard_rows(df: DataFrame, shards: int, keys: list[str], seed: int = 7) -> DataFrame:
    """``df`` with ``shard`` and ``slot``; ``keys`` are the columns that tell rows apart."""
    if shards < 1:
        raise ValueError("there must be one shard at least")
    number, total, bits, at = fresh(df, "row_number", "row_total", "row_bits", "row_permuted")
    numbered = number_rows(df, keys, number, total)
    numbered = numbered.withColumn(bits, F.expr(f"if({total} <= 1, 0, length(bin({total} - 1)))"))
    placed = numbered.withColumn(at, permuted(number, total, bits, seed))
    return placed.withColumns(
        {"shard": F.pmod(F.col(at), F.lit(shards)).cast("int"), "slot": F.expr(f"{at} div {shards}")}
    ).drop(number, total, bits, at)
