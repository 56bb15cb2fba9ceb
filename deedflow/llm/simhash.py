"""Near-duplicate documents by 64-bit SimHash and a tiled exact comparison.

Fingerprint: A-Z is lower-cased, words are runs without ASCII white space, shingles are ``width`` words
joined by one space (a shorter text is one shingle, a text without words has fingerprint zero); bit i is set
if more than half of the shingles' XXH64 hashes (seed 42) have it.

Comparison: distinct fingerprints (copies count once) are put into blocks by bit bands that agree: of
``bands`` bands, two that differ in ``radius`` bits at most agree on ``bands - radius``, so with a block for
every choice of so many bands no link is lost.  Few fingerprints need ``radius + 1`` bands; very many get more,
whose longer keys keep blocks small.  Every block is ordered by population count and cut into
tiles of about ``TILE`` fingerprints; pairs of tiles whose population counts differ
by more than the radius are skipped, all others are compared exactly with numpy exclusive-or and bit counts, in strips of
``STRIP`` rows that again skip what their population counts tell apart.
Large blocks thus become many independent tile pairs, and no task holds more than two tiles.  A tile pair
reports a spanning forest of its links instead of all of them, and components join the forests.

Defined results: null and empty texts have fingerprint zero and are linked like any other; long texts are hashed whole, in pieces; ties
(equal fingerprints, equal distances) need no order, as all links count; a null doc_id is
never a component's name unless the whole component has none; repeated rows get equal results; an empty table
stays empty; only the result columns are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected
from .runtime import durable, fresh, ship, trim

TILE = 4096
STRIP = 128
WIDTH = 3
RADIUS = 3
SEED = 42
#: A text is hashed in pieces of so many shingles, which bounds the memory of very long texts.
PIECE = 1 << 16


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The SimHash of one text as an unsigned 64-bit number."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line, digest = b" ".join(words), xxhash.xxh64_digest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[: max(1, len(words) - width + 1)], ends[min(width, len(words)) - 1 :]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(first), PIECE):
        hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(first[at : at + PIECE].tolist(), last[at : at + PIECE].tolist())])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        # sums of up to 255 rows fit a byte, which is the fast way to add up bits
        whole = len(bits) // 255 * 255
        if whole:
            ones += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += bits[whole:].sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(first)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str, name: str, width: int = WIDTH) -> DataFrame:
    """``docs`` with its text replaced by the fingerprint ``name`` (a signed long of the same bits)."""
    rest = [c for c in docs.columns if c != text]
    schema = docs.select(*rest, F.lit(0).cast("long").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(rest))
            prints = np.fromiter((fingerprint(t.as_py(), width) for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array(prints)], names=[*rest, name])
        trim()

    return docs.select(*rest, text).mapInArrow(run, schema)


def strips(a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[int, int, int, int]]:
    """Row ranges of ``a`` and ``b``, both ordered by population count, that may hold links."""
    ones_a, ones_b = np.bitwise_count(a).astype(np.int64), np.bitwise_count(b).astype(np.int64)
    for i in range(0, len(a), STRIP):
        j = min(i + STRIP, len(a))
        x, y = np.searchsorted(ones_b, ones_a[i] - radius), np.searchsorted(ones_b, ones_a[j - 1] + radius, side="right")
        if x < y:
            yield i, j, int(x), int(y)


def forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between ``a`` and ``b`` (or within ``a``, if they are the same)."""
    same = a is b
    a = a[np.argsort(np.bitwise_count(a), kind="stable")]
    b = a if same else b[np.argsort(np.bitwise_count(b), kind="stable")]
    nodes = np.unique(np.concatenate([a, b]))
    at_a, at_b = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
    label = np.arange(len(nodes))
    for i, j, x, y in strips(a, b, radius):
        row, column = np.nonzero(np.bitwise_count(a[i:j, None] ^ b[None, x:y]) <= radius)
        u, v = at_a[i + row], at_b[x + column]
        while True:
            lu, lv = label[u], label[v]
            apart = lu != lv
            if not apart.any():
                break
            u, v, lu, lv = u[apart], v[apart], lu[apart], lv[apart]
            np.minimum.at(label, np.maximum(lu, lv), np.minimum(lu, lv))
            while not np.array_equal(label, label[label]):
                label = label[label]
    member = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[member], nodes[label[member]]


def _compare(radius: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            us, vs = [], []
            for a, b in zip(frame["a"], frame["b"]):
                one = np.asarray(a, np.int64).view(np.uint64)
                two = one if b is None else np.asarray(b, np.int64).view(np.uint64)
                u, v = forest(one, two, radius)
                us.append(u.view(np.int64))
                vs.append(v.view(np.int64))
            if us:
                yield pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs)})

    return run


def bands_for(n: int, radius: int) -> int:
    """How many bands the bits are cut into: more when there are more fingerprints, so that a key of the bands that agree keeps blocks small."""
    bands = radius + 1
    while bands < 2 * radius and n >> (64 * (bands - radius) // bands) > 256:
        bands += 1
    return bands


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE, bands: int | None = None) -> DataFrame:
    """Distinct fingerprints (``fp``, signed longs) to edges (``u``, ``v``) that connect all within the radius."""
    bands = bands_for(prints.count(), radius) if bands is None else bands
    edges = [round(64 * i / bands) for i in range(bands + 1)]
    part = [F.shiftrightunsigned("fp", edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1).cast("long")) for i in range(bands)]
    # two within the radius agree on all bands but ``radius`` at least, so on all of one of these choices
    keys = [F.xxhash64(F.lit(n), *(part[i] for i in some)) for n, some in enumerate(combinations(range(bands), bands - radius))]
    blocks = prints.select("fp", F.bit_count("fp").alias("ones"), F.explode(F.array(*keys)).alias("block"))
    tiles = durable(tiles_of(blocks, tile))
    alone = tiles.select(F.col("fps").alias("a"), F.lit(None).cast("array<long>").alias("b"))
    # a block of one tile has no pairs
    pairs = tile_pairs(tiles.where(F.col("all") > tile), radius)
    left = tiles.select("block", "tile", F.col("fps").alias("a"))
    right = tiles.select("block", F.col("tile").alias("tile2"), F.col("fps").alias("b"))
    apart = pairs.join(left, ["block", "tile"]).join(right, ["block", "tile2"]).select("a", "b")
    work = alone.union(apart).hint("rebalance")
    return work.mapInPandas(_compare(radius), "u long, v long").distinct()


def tiles_of(blocks: DataFrame, tile: int) -> DataFrame:
    """Blocks (``fp``, ``ones``, ``block``) of two fingerprints or more cut by population count: ``block``, ``tile``, ``low``, ``high``, ``fps``.

    Small counts that follow each other share a tile; a count of more than a tile has several of its own.
    """
    # at most 65 rows for each block
    counts = blocks.groupBy("block", "ones").agg(F.count("*").alias("n"))
    every = Window.partitionBy("block")
    before = every.orderBy("ones").rowsBetween(Window.unboundedPreceding, -1)
    large = F.col("n") > tile
    counts = counts.withColumn("all", F.sum("n").over(every)).where("all > 1")
    counts = counts.withColumn("run", F.floor(F.coalesce(F.sum(F.when(~large, F.col("n"))).over(before), F.lit(0)) / tile))
    counts = counts.select("block", "ones", "all", "run", F.when(large, F.col("ones")).otherwise(-1).alias("level"), F.ceil(F.col("n") / tile).alias("parts"))
    part = F.when(F.col("level") < 0, 0).otherwise(F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts")))
    dealt = blocks.join(counts, ["block", "ones"]).withColumn("tile", F.struct("run", "level", part.alias("part")))
    return dealt.groupBy("block", "tile").agg(F.min("ones").alias("low"), F.max("ones").alias("high"), F.first("all").alias("all"), F.collect_list("fp").alias("fps"))


def tile_pairs(tiles: DataFrame, radius: int) -> DataFrame:
    """Pairs of tiles of a block whose population counts lie within the radius: ``block``, ``tile``, ``tile2``."""
    one = tiles.select("block", "tile", "low", "high")
    other = tiles.select(F.col("block").alias("block2"), F.col("tile").alias("tile2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    near = (F.col("low2") - F.col("high") <= radius) & (F.col("low") - F.col("high2") <= radius)
    return one.join(other, (F.col("block") == F.col("block2")) & (F.col("tile") < F.col("tile2")) & near).select("block", "tile", "tile2")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, radius: int = RADIUS, tile: int = TILE, extra: list[str] | None = None) -> DataFrame:
    """(doc_id, extra columns, ``fp``, ``root``, ``component_id``): component_id is the least doc_id reachable, root tells components apart."""
    (fp,) = fresh(docs, "fp")
    prints = durable(fingerprints(docs.select(doc_id, *(extra or []), text), text, fp, width))
    named = prints.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("least"))
    roots = connected(durable(links(named.select("fp"), radius, tile)))
    grouped = named.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    names = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = grouped.select("fp", F.col("root").alias("r")).join(names, F.col("r") == F.col("root")).select("fp", "root", "component_id")
    return prints.join(by_print, prints[fp] == by_print["fp"]).drop(fp)


ship(__name__)
