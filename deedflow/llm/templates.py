"""Benchmark decontamination by template canonicalisation.

Texts become token sequences (punctuation at the ends of a word is dropped, case is folded) in which numbers,
units after numbers, and, in a second view, names (capitalised words inside a sentence) are typed
placeholders.  Windows of ``WINDOW`` tokens are hashed with the placeholders' types in place of their values,
so a question asked again with other numbers or names has the same windows.  Document windows are
hash-joined with benchmark windows: first with those that few items share, which give the candidates, then all windows of these.  Windows equal in every slot value always count; of the others along one
alignment of document and item every slot value of the item must stand for one value of the document, else
they do not count.  A document is contaminated by
an item if consistent windows cover half of the item's windows or ``RUN`` windows of one alignment match.

The executors get a bitmap of the benchmark's window hashes that has a fixed size (``BITS`` bits), whatever
the size of the benchmark; it only thins out the windows that go into the join, and a false hit costs a row.
Windows with more than ``WINDOW - LITERALS`` numbers and units would fit unrelated tables as templates; they are
exact windows, hashed with their values, and templates that are longer to the right or to the left (up to ``WIDE``
tokens) until they have ``LITERALS`` literals.  So every window of an item counts.

Items shorter than a window are one window of their own length.  Items of less than ``LITERALS`` tokens can't be
told from common speech inside a sentence; they match exactly where they are whole sentences.  Defined results: null and empty texts match nothing;
long texts are matched whole, in pieces; ties (windows that several items share) count for each item;
repeated rows are matched alike and reported once (rows are told apart by doc_id and text); an empty table
on either side gives an empty result; only the result columns are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import durable, ship, trim

WINDOW = 8
WIDE = 32
LITERALS = 5
RUN = 6
COVER = 0.5
BITS = 22
CHUNK = 4 << 20
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”‘’„…–—·•¿¡"
#: Units that may follow a number.
UNITS = (
    "mg g kg t lb lbs oz mm cm m km in inch inches ft foot feet yd yard yards mile miles ml cl l liter liters litre litres gallon gallons "
    "ms s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years "
    "percent % cent cents dollar dollars euro euros pound pounds usd eur gbp k c f degree degrees meter meters metre metres "
    "kilometer kilometers kilometre kilometres gram grams kilogram kilograms mph kmh kph watt watts w kw volt volts v hz khz mhz ghz "
    "byte bytes kb mb gb tb people items"
).split()
NUMBER = r"^[+-]?[$€£]?\d+([.,:/]\d+)*(st|nd|rd|th|e|er)?$"
MEASURE = r"^[+-]?[$€£]?\d+([.,]\d+)*[a-z°µ]{1,4}$"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TYPES = {"number": np.uint64(0xA0761D6478BD642F), "unit": np.uint64(0xE7037ED1A0B428DB), "measure": np.uint64(0x8EBC6AF09C88C6E3), "name": np.uint64(0x589965CC75374CC3)}


def _avalanche(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts together: row of each token, its hash in the plain and in the named view, its slot value (0: literal in both)."""
    return _tokens(texts)[:4]


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``tokens`` and whether each token begins a sentence."""
    words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    row = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    coded = words.flatten().dictionary_encode()
    code, vocab = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    bare = pc.utf8_trim(vocab, PUNCTUATION)
    core = pc.utf8_lower(bare)
    flag = lambda mask: mask.to_numpy(zero_copy_only=False)
    digits = flag(pc.match_substring_regex(core, r"^[+-]?[$€£]?\d"))
    number = measure = np.zeros(len(vocab), bool)
    if digits.any():
        number = digits & flag(pc.match_substring_regex(core, NUMBER))
        measure = digits & ~number & flag(pc.match_substring_regex(core, MEASURE))
    unit = flag(pc.is_in(core, value_set=pa.array(UNITS, core.type)))
    percent = number & flag(pc.match_substring(vocab, "%"))
    number, measure = number & ~percent, measure | percent
    title = flag(pc.match_substring_regex(bare, r"^\p{Lu}.*\p{Ll}"))
    ending = flag(pc.match_substring_regex(vocab, r"[.!?:]['\")»”’]*$"))
    value = pd.util.hash_array(core.to_numpy(zero_copy_only=False), categorize=False) if len(core) else np.zeros(0, np.uint64)
    value = np.where(value == 0, np.uint64(1), value)
    plain = np.where(number, _TYPES["number"], np.where(measure, _TYPES["measure"], value))
    kept = flag(pc.not_equal(core, ""))[code] if len(vocab) else np.zeros(0, bool)
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | ending[code[:-1]]
    row, code, first = row[kept], code[kept], first[kept]
    out, values, slot = plain[code], value[code], (number | measure)[code]
    after = np.zeros(len(row), bool)
    after[1:] = number[code[:-1]] & (row[1:] == row[:-1])
    typed = unit[code] & after
    out = np.where(typed, _TYPES["unit"], out)
    slot |= typed
    name = title[code] & ~first & ~slot
    return row, out, np.where(name, _TYPES["name"], out), np.where(slot | name, values, np.uint64(0)).astype(np.uint64), first


def windows(texts: pa.Array, lengths: list[int], bitmap: np.ndarray | None) -> dict[str, np.ndarray]:
    """Windows of the given lengths (with ``bitmap``, those it has): row, pos, hash, slots (WIDE, by the first ``span``), n (tokens of the text), length (to the right of pos)."""
    row, plain, named, slots, first = _tokens(texts)
    # in the plain view names are literals
    numbers = np.where(named != plain, np.uint64(0), slots)
    literal = np.where(numbers != 0, numbers, plain)
    before = np.concatenate(([0], np.cumsum(numbers != 0)))
    begins = np.append(first, True)
    begins[1:-1] |= row[1:] != row[:-1]
    sizes = np.bincount(row, minlength=len(texts))
    start = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    found: list[tuple[np.ndarray, ...]] = []
    for length in lengths:
        count = len(row) - length + 1
        if count < 1:
            continue
        inside = row[length - 1 :] == row[:count]
        hashes = {}
        for view, tokens_of in (("plain", plain), ("named", named)):
            acc = np.full(count, length, np.uint64)
            for j in range(length):
                acc = (acc + tokens_of[j : j + count]) * _MIX
                acc ^= acc >> np.uint64(31)
            hashes[view] = _avalanche(acc)
        fresh = hashes["named"] != hashes["plain"]
        # windows of too few literals to be templates are exact; below LITERALS tokens, those that are whole sentences
        exact = np.nonzero(inside & (length - (before[length:] - before[:-length]) < LITERALS))[0]
        if length < LITERALS:
            exact = exact[begins[exact] & begins[exact + length]]
        acc = np.full(len(exact), ~np.uint64(length))
        for j in range(length):
            acc = (acc + literal[exact + j]) * _MIX
            acc ^= acc >> np.uint64(31)
        acc = _avalanche(acc)
        if bitmap is not None:
            known = bitmap[(acc >> np.uint64(64 - BITS)).astype(np.int64)]
            exact, acc = exact[known], acc[known]
        if length == WINDOW:
            heavy = np.nonzero(inside & (length - (before[length:] - before[:-length]) < LITERALS))[0]
            found.extend(_longer(heavy, row, plain, numbers, start, sizes, bitmap))
        found.append((exact, acc, np.zeros((len(exact), WIDE), np.uint64), np.full(len(exact), length), np.full(len(exact), length)))
        for view, mask in (("plain", inside), ("named", inside & fresh)):
            h = hashes[view]
            at = np.nonzero(mask if bitmap is None else mask & bitmap[(h >> np.uint64(64 - BITS)).astype(np.int64)])[0]
            typed = slots if view == "named" else numbers
            grid = np.zeros((len(at), WIDE), np.uint64)
            grid[:, :length] = typed[at[:, None] + np.arange(length)]
            enough = length - (grid != 0).sum(axis=1) >= LITERALS
            found.append((at[enough], h[at[enough]], grid[enough], *[np.full(int(enough.sum()), length)] * 2))
    empty = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros((0, WIDE), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    at, hashed, grid, length, span = (np.concatenate(x) for x in zip(empty, *found))
    return {"row": row[at], "pos": at - start[row[at]], "hash": hashed, "slots": grid, "n": sizes[row[at]], "length": length, "span": span}


def _longer(at: np.ndarray, row: np.ndarray, plain: np.ndarray, numbers: np.ndarray, start: np.ndarray, sizes: np.ndarray, bitmap: np.ndarray | None) -> Iterator[tuple]:
    """Windows at ``at`` that go on to the right or to the left until they have LITERALS literals."""
    literals = np.concatenate(([0], np.cumsum(numbers == 0)))
    low, high = start[row[at]], (start + sizes)[row[at]]
    right = np.searchsorted(literals, literals[at] + LITERALS, side="left")
    left = np.searchsorted(literals, literals[at + WINDOW] - LITERALS, side="right") - 1
    for side, (begin, end) in enumerate(((at, right), (left, at + WINDOW))):
        fits = (begin >= low) & (end <= high) & (end - begin <= WIDE)
        own, begin, span = at[fits], begin[fits], (end - begin)[fits]
        acc = span.astype(np.uint64) + np.uint64(1000 * (side + 1))
        grid = np.zeros((len(own), WIDE), np.uint64)
        for j in range(WIDE):
            more = np.nonzero(j < span)[0]
            x = (acc[more] + plain[begin[more] + j]) * _MIX
            acc[more] = x ^ (x >> np.uint64(31))
            grid[more, j] = numbers[begin[more] + j]
        acc = _avalanche(acc)
        known = np.ones(len(acc), bool) if bitmap is None else bitmap[(acc >> np.uint64(64 - BITS)).astype(np.int64)]
        yield own[known], acc[known], grid[known], (begin + span - own)[known], span[known]


def chunks(texts: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text; a longer text is a range of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, to - at
        at = to


def pieces(text: str, most: int = CHUNK) -> Iterator[tuple[bytes, int, int]]:
    """A very long text in pieces, each with the last tokens of the one before at its head.

    Yields the piece, how many tokens its head has, and the number of the text's tokens before the head.
    """
    data, at, head, known, before = text.encode("utf-8", "surrogatepass"), 0, b"", 0, 0
    while at < len(data):
        end = at + most
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        piece = head + data[at:end]
        yield piece, known, before
        total = before + len(tokens(pa.array([piece.decode("utf-8", "replace")]))[0])
        words = 4 * WINDOW
        while True:
            parts = piece.rsplit(None, words)
            head = b" ".join(parts[-words:]) + b" "
            known = len(tokens(pa.array([head.decode("utf-8", "replace")]))[0])
            if known > WIDE or len(parts) <= words:
                break
            words *= 2
        before, at = total - known, end


def _windows_of_pieces(text: str, lengths: list[int], bitmap: np.ndarray | None, most: int = CHUNK) -> Iterator[dict[str, np.ndarray]]:
    for piece, known, before in pieces(text, most):
        got = windows(pa.array([piece.decode("utf-8", "replace")]), lengths, bitmap)
        new = got["pos"] + got["length"] > known
        got = {k: v[new] for k, v in got.items()}
        yield got | {"pos": got["pos"] + before}


def _window_rows(lengths: list[int] | None, bitmap: np.ndarray | None):
    """Arrow batches of keys and a text (last) to a row for each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for at, n in chunks(texts):
                part = texts.slice(at, n)
                if lengths is None:  # a benchmark: items shorter than a window are one window
                    got = windows(part, [*range(1, WINDOW + 1)], bitmap)
                    own = (got["length"] >= WINDOW) | (got["length"] == got["n"])
                    found = [{k: v[own] for k, v in got.items()}]
                elif n == 1 and (pc.binary_length(part)[0].as_py() or 0) > 2 * CHUNK:
                    found = _windows_of_pieces(part[0].as_py(), lengths, bitmap)
                else:
                    found = [windows(part, lengths, bitmap)]
                for got in found:
                    row = pa.array(got["row"] + at)
                    keys = [batch.column(i).take(row) for i in range(batch.num_columns - 1)]
                    flat = pa.array(got["slots"][np.arange(WIDE) < got["span"][:, None]].view(np.int64))
                    slots = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(got["span"])), pa.int32()), flat)
                    yield pa.RecordBatch.from_arrays(
                        [*keys, pa.array(got["hash"].view(np.int64)), pa.array(got["pos"].astype(np.int64)), pa.array(got["n"].astype(np.int64)), slots],
                        names=[*batch.schema.names[:-1], "hash", "pos", "n", "slots"],
                    )

    return run


COLUMNS = "hash long, pos long, n long, slots array<long>"


def _rare(bench: DataFrame, totals: DataFrame, run: int, cover: float) -> DataFrame:
    """(hash, item_id): windows of which a contaminated document has one at least.

    It covers t places of an item's n, so one of any n - t + 1; those whose windows the fewest items share are taken.  A
    passage that many items have in common thus isn't matched for each of them, unless nothing else is left of an item.
    """
    shared = bench.groupBy("hash").agg(F.count_distinct("item_id").alias("items"))
    places = bench.join(shared, "hash").groupBy("item_id", "pos").agg(F.max("items").alias("items"))
    least = F.greatest(F.lit(1), F.least(F.lit(run), F.ceil(F.lit(cover) * F.col("n_windows"))))
    # as many rows as an item has places
    order = Window.partitionBy("item_id").orderBy("items", "pos")
    some = places.join(totals, "item_id").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= F.col("n_windows") - least + 1)
    return bench.join(some.select("item_id", "pos"), ["item_id", "pos"]).select("hash", "item_id").distinct()


def benchmark_windows(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    return items.mapInArrow(_window_rows(None, None), f"item_id long, {COLUMNS}").distinct()


def _bitmap(bench: DataFrame) -> np.ndarray:
    """Which of 2**BITS hash prefixes occur: at most 2**BITS / 64 rows come to the driver."""
    prefix = F.shiftrightunsigned("hash", 64 - BITS)
    rows = bench.select(F.shiftright(prefix, 6).alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - BITS}) & 63 as int))").alias("bit"))
    words = np.zeros(1 << (BITS - 6), np.int64)
    for word, bits in rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        words[word] = bits
    return words


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    run: int = RUN,
    cover: float = COVER,
) -> DataFrame:
    """A row for each contaminated document and item.

    ``doc_id``, ``text_hash`` (``xxhash64`` of the text), ``item_id``, ``n_windows`` (of the item),
    ``n_covered``, ``longest`` (windows of the best alignment), ``changed`` (whether a slot differs from the item).
    """
    bench = durable(benchmark_windows(benchmark, item_id, item_text))
    words = _bitmap(bench)
    # at most WINDOW values
    lengths = sorted({WINDOW} | {r[0] for r in bench.select(F.least("n", F.lit(WINDOW)).cast("int")).distinct().collect()})
    def thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.unpackbits(words.view(np.uint8), bitorder="little").astype(bool)
        yield from _window_rows(lengths, bitmap)(batches)
        trim()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = durable(rows.mapInArrow(thinned, f"doc_id {kind}, text_hash long, {COLUMNS}").drop("n").distinct())
    items = bench.select("hash", "item_id", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
    totals = bench.groupBy("item_id").agg(F.count_distinct("pos").alias("n_windows"))
    candidates = rows.join(_rare(bench, totals, run, cover), "hash").select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"), "item_id").distinct()
    windows_of = candidates.join(items, "item_id").withColumnRenamed("hash", "of_hash")
    same_doc = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_text")) & (F.col("hash") == F.col("of_hash"))
    hits = rows.join(windows_of, same_doc).drop("of_doc", "of_text", "of_hash")
    pairs = F.filter(F.arrays_zip("item_slots", "slots"), lambda p: p["item_slots"] != 0)
    same = ~F.exists("pairs", lambda p: p["item_slots"] != p["slots"])
    aligned = (
        hits.withColumn("pairs", pairs)
        .withColumn("same", same)
        .groupBy("doc_id", "text_hash", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"))
        .agg(
            F.collect_set("item_pos").alias("all"),
            F.collect_set(F.when(F.col("same"), F.col("item_pos"))).alias("equal"),
            F.array_distinct(F.flatten(F.collect_set(F.when(~F.col("same"), F.col("pairs"))))).alias("pairs"),
        )
    )
    one = F.size(F.array_distinct(F.transform("pairs", lambda p: p["item_slots"]))) == F.size("pairs")
    consistent = aligned.withColumn("at", F.when(one, F.col("all")).otherwise(F.col("equal"))).withColumn("changed", one & (F.size("pairs") > 0))
    each = consistent.select("doc_id", "text_hash", "item_id", "changed", F.size("at").alias("n_at"), F.explode("at").alias("pos"))
    each = each.groupBy("doc_id", "text_hash", "item_id", "pos").agg(F.max("n_at").alias("n_at"), F.min("changed").alias("changed"))
    summed = each.groupBy("doc_id", "text_hash", "item_id").agg(F.count("*").alias("n_covered"), F.max("n_at").alias("longest"), F.max("changed").alias("changed"))
    return (
        summed.join(totals, "item_id")
        .where((F.col("n_covered") >= F.lit(cover) * F.col("n_windows")) | (F.col("longest") >= run))
        .select("doc_id", "text_hash", "item_id", "n_windows", "n_covered", "longest", "changed")
    )


ship(__name__)
