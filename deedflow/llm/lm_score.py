"""Language-model scores by prediction by partial matching, beside a unigram baseline.

Everything is learned from all training rows.  One pass over the texts writes, for each block of texts (part
of an Arrow batch), the counts of its byte windows, its words with their training counts, and its texts.  Then

* byte windows are dealt into buckets by the two bytes before the symbol, so that all contexts of order 2 and
  more are whole in one bucket; those of order 1 and 0 have 2**16 windows at most and are sent to all.  Each
  bucket becomes one frozen trie with escapes and symbol exclusion (``trie``) and answers the distinct windows
  that the blocks ask for.  The order is ``ORDER`` at every size and no window is held outside its bucket;
* words are dealt into buckets by a hash, in the same way: what batches have learned is summed in a bucket, which answers
  the words that blocks ask for, packed, so a word that every block has is one of many in a row, and no vocabulary
  is ever held in one place;
* each block adds up the exact code lengths and the baseline of its texts from the answers.

Baseline: log10((c + 1) / (N + V + 1)) summed over the words and one end of the text, where c is the count of
the word in training, N all training tokens and V the distinct ones, ends included.

Defined results: a null text is an empty one and has one token, its end; without training rows every
symbol costs its share of the alphabet; very long texts count whole; repeated rows get equal scores (there are no ties);
other columns are not returned, whatever their names; an empty table stays empty.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import trie
from .runtime import durable, ship, trim, written

BLOCK_BYTES = 8 << 20
ORDER = 5
#: Parts that the pairs of bytes before a symbol are dealt into; the most frequent pair sets the size of the largest one.
BUCKETS = 256
#: Parts that words are dealt into.
WORD_BUCKETS = 1024
#: So many windows are answered at once.
ANSWERS = 1 << 17
WINDOWS = 3_000_000


def lowered(texts: pa.Array) -> pa.Array:
    return pc.ascii_lower(pc.fill_null(texts, ""))


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer text is a range of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, to - at
        at = to


def coded(texts: pa.Array, train: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words by falling frequency, the end of a text (empty word) first; their counts in training; words of each text; all codes."""
    lists = pc.ascii_split_whitespace(texts)
    row = np.repeat(np.arange(len(texts), dtype=np.int32), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    flat = lists.flatten().dictionary_encode()
    del lists
    code, vocab = flat.indices.to_numpy(zero_copy_only=False), flat.dictionary
    real = pc.not_equal(vocab, "").to_numpy(zero_copy_only=False)
    if not real.all():
        kept = real[code]
        row, code = row[kept], code[kept]
    total = np.bincount(code, minlength=len(vocab))
    order = np.argsort(-total, kind="stable")
    order = order[real[order]]
    place = np.zeros(len(vocab), np.int32)
    place[order] = np.arange(1, len(order) + 1, dtype=np.int32)
    learned = np.bincount(code[train[row]], minlength=len(vocab))[order]
    words = pa.concat_arrays([pa.array([""], vocab.type), vocab.take(pa.array(order))])
    return words, np.concatenate(([int(train.sum())], learned)), np.bincount(row, minlength=len(texts)), place[code]


def packed(codes: np.ndarray) -> bytes:
    """Codes as compressed planes of their low 16 and their higher bits."""
    low, high = (codes & 0xFFFF).astype(np.uint16).tobytes(), (codes >> 16).astype(np.uint16).tobytes()
    return pa.compress(low + high, codec="zstd", asbytes=True) if len(codes) else b""


def unpacked(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    both = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint16)
    return both[:n].astype(np.int64) | (both[n:].astype(np.int64) << 16)


def turned(keys: np.ndarray) -> np.ndarray:
    """Windows with their contexts' bytes reversed (the nearest first), and back; sorted this way they compress well."""
    out = np.zeros((len(keys), 8), np.uint8)
    out[:, : ORDER + 1] = np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, [0, *range(ORDER, 0, -1)]]
    return out.reshape(-1).view(np.uint64)


def packed_keys(keys: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, : ORDER + 1].T).tobytes(), codec="zstd", asbytes=True)


def unpacked_keys(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=(ORDER + 1) * n, codec="zstd", asbytes=True), np.uint8).reshape(ORDER + 1, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, : ORDER + 1] = planes.T
    return out.reshape(-1).view(np.uint64)


def dealt(keys: np.ndarray, counts: np.ndarray | None) -> Iterator[dict]:
    """A row for each bucket that has some of the windows."""
    pair = (keys >> np.uint64(8)) & np.uint64(0xFFFF)
    bucket = ((pair * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.int64) % BUCKETS
    by = np.lexsort((turned(keys), bucket))
    keys, bucket = keys[by], bucket[by]
    ends = np.cumsum(np.bincount(bucket, minlength=BUCKETS))
    for b, (i, j) in enumerate(zip(np.append(0, ends[:-1]).tolist(), ends.tolist())):
        if i < j:
            yield {"bucket": b, "n": j - i, "data": packed_keys(keys[i:j])} | ({} if counts is None else {"more": packed(counts[by[i:j]])})


def packed_long(counts: np.ndarray) -> bytes:
    """Counts as compressed planes of 16 bits."""
    return pa.compress(np.ascontiguousarray(counts.astype("<i8").view(np.uint16).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def unpacked_long(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint16)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<i8").reshape(-1).astype(np.int64)


def word_buckets(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words' places by bucket, and where each bucket ends."""
    hashed = pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False) if len(words) else np.zeros(0, np.uint64)
    bucket = (hashed % np.uint64(WORD_BUCKETS)).astype(np.int64)
    return np.argsort(bucket, kind="stable"), np.cumsum(np.bincount(bucket, minlength=WORD_BUCKETS))


def dealt_words(words: pa.Array, counts: np.ndarray | None) -> Iterator[dict]:
    """A row for each bucket that has some of the words; a word holds no line feed."""
    order, ends = word_buckets(words)
    starts = np.append(0, ends[:-1])
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), words.take(pa.array(order)))
    for b, (i, j, line) in enumerate(zip(starts.tolist(), ends.tolist(), pc.binary_join(lists, "\n"))):
        if i < j:
            text = line.as_buffer()
            yield {"bucket": b, "n": j - i, "size": text.size, "data": pa.compress(text, codec="zstd", asbytes=True)} | ({} if counts is None else {"more": packed_long(counts[order[i:j]])})


def unpacked_words(data: list[bytes], sizes: list[int]) -> pa.Array:
    lines = pa.array([pa.decompress(d, decompressed_size=n, codec="zstd", asbytes=True) for d, n in zip(data, sizes)], pa.binary()).cast(pa.string())
    return pc.split_pattern(lines, "\n").flatten().cast(pa.large_string())


ROW = (
    "kind int, block long, ids array<{id}>, held array<boolean>, raw binary, size long, counts array<long>, keys array<long>, "
    "bucket int, n int, data binary, more binary, tokens long"
)
#: Lists are sent in rows of so many items, which keeps rows small where they are taken apart.
ITEMS = 1 << 14


def _gather(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(*some: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in some], f.type) for f in schema], schema=schema)

        trim()
        for batch in batches:
            windows: tuple[list, list] = ([], [])
            for at, n in blocks(batch.column(2)):
                ids, train, raw = (batch.column(i).slice(at, n) for i in range(3))
                texts, learn = lowered(raw), train.to_numpy(zero_copy_only=False)
                block = uuid.uuid4().int >> 65
                words, counts, _, codes = coded(texts, learn)
                del codes
                tokens = int(counts.sum())
                some = [{"kind": 6, "block": block} | r for r in dealt_words(words, None)]
                learned = np.nonzero(counts)[0]
                some += [{"kind": 5} | r for r in dealt_words(words.take(pa.array(learned)), counts[learned])]
                for i in range(0, len(some), 128):
                    yield rows(*some[i : i + 128])
                del words, counts, some
                bare = texts.cast(pa.binary())
                del texts
                whole = trie.joined(bare.to_pylist(), ORDER)[0]
                yield rows({"kind": 0, "block": block, "ids": ids.to_pylist(), "held": ~learn, "raw": pa.compress(whole, codec="zstd", asbytes=True), "size": len(whole), "tokens": tokens})
                known = trie.grams(trie.joined(bare.filter(pa.array(learn)).to_pylist(), ORDER)[0], ORDER)
                for found, kept in zip(known, windows):
                    kept.append(found)
                asked = trie.grams(trie.joined(bare.filter(pa.array(~learn)).to_pylist(), ORDER)[0], ORDER)[0]
                asked = np.union1d(known[0], asked)
                del whole, bare
                some = [{"kind": 3, "block": block} | r for r in dealt(asked, None)]
                for i in range(0, len(some), 32):
                    yield rows(*some[i : i + 32])
                del some, asked
                trim()
            keys, seen = trie.summed(*windows)
            some = [{"kind": 2} | r for r in dealt(keys, seen)]
            for i in range(0, len(some), 32):
                yield rows(*some[i : i + 32])
            keys, seen = trie.summed([keys & np.uint64(0xFFFF)], [seen])
            for i in range(0, len(keys), ITEMS):
                yield rows({"kind": 4, "keys": keys[i : i + ITEMS].astype(np.int64), "counts": seen[i : i + ITEMS]})
            del keys, seen, windows, some
            trim()

    return run


def _answered(low, schema: pa.Schema):
    """Rows of a bucket, trained windows first (kind 2), to answers for the windows that blocks ask for (kind 3)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, learned, kept, model, asked, open_ = None, ([], []), 0, None, [], 0

        def answers() -> pa.RecordBatch:
            values = model.of_windows(np.concatenate([k for _, _, k in asked])).astype(np.float32)
            ends = np.cumsum([len(k) for _, _, k in asked])
            parts = [values[j - len(k) : j].tobytes() for (_, _, k), j in zip(asked, ends.tolist())]
            columns = [[b for b, _, _ in asked], [len(k) for _, _, k in asked], [d for _, d, _ in asked], parts]
            asked.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                bucket, kind, block, n, data, more = (batch.column(j)[i].as_py() for j in range(6))
                if bucket != at:
                    if asked:
                        yield answers()
                    at, learned, kept, model, open_ = bucket, ([], []), 0, None, 0
                    trim()
                keys = unpacked_keys(data, n)
                if kind == 2:
                    learned[0].append(keys)
                    learned[1].append(unpacked(more, n))
                    open_ += n
                    if open_ > max(ANSWERS, kept):  # what is held stays near the distinct windows
                        k, c = trie.summed(*learned)
                        learned, kept, open_ = ([k], [c]), len(k), 0
                    continue
                if model is None:
                    model, learned, open_ = trie.Trie(*trie.summed(*learned), ORDER, low.value), ([], []), 0
                asked.append((block, data, keys))
                open_ += n
                if open_ > ANSWERS:
                    yield answers()
                    open_ = 0
        if asked:
            yield answers()
        trim()

    return run


class Vocabulary:
    """The words that one bucket has learned, with their counts."""

    def __init__(self) -> None:
        self.words, self.counts = pa.array([], pa.large_string()), np.zeros(0, np.int64)
        self.waiting: list[tuple] = []
        self.open, self.told = 0, False

    def learn(self, n: int, size: int, data: bytes, more: bytes) -> None:
        self.waiting.append((n, size, data, more))
        self.open += n
        if self.open > max(ANSWERS, len(self.words)):  # what is held stays near the distinct words
            self.settle()

    def settle(self) -> None:
        if self.waiting:
            n, sizes, data, more = zip(*self.waiting)
            coded_ = pa.concat_arrays([self.words, unpacked_words(data, sizes)]).dictionary_encode()
            counts = np.concatenate([self.counts, *map(unpacked_long, more, n)])
            self.words, self.counts = coded_.dictionary, np.zeros(len(coded_.dictionary), np.int64)
            np.add.at(self.counts, coded_.indices.to_numpy(), counts)
            self.waiting, self.open = [], 0

    def fresh(self) -> int:
        """How many words were learned, told once."""
        told, self.told = self.told, True
        return 0 if told else len(self.words)

    def answer(self, words: pa.Array) -> np.ndarray:
        place = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        return np.append(self.counts, 0)[place]


def _counted(schema: pa.Schema):
    """Rows of a bucket of words, what was learned first (kind 5), to counts for the words that blocks ask for (kind 6)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, vocabulary, asked, open_ = None, Vocabulary(), [], 0

        def answers() -> pa.RecordBatch:
            vocabulary.settle()
            blocks_, ns, sizes, data = zip(*asked)
            counts = vocabulary.answer(unpacked_words(data, sizes))
            parts = [packed_long(counts[j - n : j]) for n, j in zip(ns, np.cumsum(ns).tolist())]
            fresh = [vocabulary.fresh()] + [0] * (len(asked) - 1)
            asked.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((blocks_, [at] * len(ns), ns, parts, fresh), schema)], schema=schema)

        for batch in batches:
            for bucket, kind, block, n, size, data, more in zip(*(batch.column(j).to_pylist() for j in range(7))):
                if bucket != at:
                    if asked:
                        yield answers()
                    at, vocabulary, open_ = bucket, Vocabulary(), 0
                if kind == 5:
                    vocabulary.learn(n, size, data, more)
                    continue
                asked.append((block, n, size, data))
                open_ += n
                if open_ > ANSWERS:
                    yield answers()
                    open_ = 0
        if asked:
            yield answers()
        trim()

    return run


def _scored(schema: pa.Schema):
    """Blocks with their answers to code lengths and sums of log10(c + 1), without the denominator that is the same for all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, held, raw, length, counts, new, replies = (batch.column(j).slice(i, 1) for j in range(7))
                whole = np.frombuffer(pa.decompress(raw[0].as_buffer(), decompressed_size=length[0].as_py(), codec="zstd", asbytes=True), np.uint8)
                ends = np.nonzero(whole == trie.EOS)[0]
                starts = np.concatenate(([0], ends[:-1] + 1)).astype(np.int64)
                offsets = np.concatenate(([0], np.cumsum(ends - starts - ORDER))).astype(np.int32)
                body = whole[(whole != trie.BOS) & (whole != trie.EOS)]
                texts = pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(body))
                words, _, size, codes = coded(texts, np.zeros(len(ends), bool))
                del texts, body
                order, last = word_buckets(words)
                c = np.zeros(len(words), np.int64)
                for part in counts.flatten().to_pylist():
                    to = int(last[part["bucket"]])
                    c[order[to - part["n"] : to]] = unpacked_long(part["counts"], part["n"])
                del words, order
                logs = np.log10(c + 1.0)
                row = np.repeat(np.arange(len(size), dtype=np.int32), size)
                base = np.bincount(row, weights=logs[codes], minlength=len(size)) + logs[0]
                known = np.bincount(row, weights=(c > 0)[codes], minlength=len(size)) + (c[0] > 0)
                del codes, row
                fresh = np.zeros(len(size), np.int64)
                fresh[0] = new[0].as_py()
                got = replies.flatten()
                sizes = pc.struct_field(got, "n").to_pylist()
                keys = np.concatenate([unpacked_keys(d, n) for d, n in zip(pc.struct_field(got, "data").to_pylist(), sizes)])
                values = np.concatenate([np.frombuffer(v, np.float32) for v in pc.struct_field(got, "answer").to_pylist()])
                look = trie.Lookup(keys)
                values = values[look.order]
                del keys

                def values_of(part: np.ndarray) -> np.ndarray:
                    out = np.zeros(len(part) - ORDER)
                    real = part[ORDER:] != trie.BOS
                    out[real] = values[look.find(trie.windows(part, ORDER)[real])]
                    return out

                lengths = trie.totals(values_of, whole, starts, ORDER)
                columns = [ids.flatten(), held.flatten(), pa.array(size + 1), pa.array(known.astype(np.int64)), pa.array(base), pa.array(lengths), pa.array(fresh)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                del look, values, whole
            trim()

    return run


def model_of(grams: DataFrame, most: int = WINDOWS) -> trie.Trie:
    """A trie of at most ``most`` summed windows (``gram`` of ORDER + 1 bytes, ``n``), of a lower order if need be; ``score`` doesn't use it."""
    for order in range(ORDER, -1, -1):
        if order < ORDER:
            grams = grams.groupBy(F.col("gram").bitwiseAND(F.lit((1 << (8 * (order + 1))) - 1)).alias("gram")).agg(F.sum("n").alias("n"))
        if order <= 1 or grams.count() <= most:  # there are 2**16 windows of order 1 at most
            found = grams.select("gram", "n").toArrow()
            keys, counts = found["gram"].to_numpy().view(np.uint64), found["n"].to_numpy()
            del found
            trim()
            return trie.Trie(keys, counts, order)
    raise AssertionError


def score(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = ROW.format(id=kind)
    gathered = written(rows.mapInArrow(_gather(_arrow(rows, shape)), shape))
    words = gathered.where("kind in (5, 6)").select("bucket", "kind", "block", "n", "size", "data", "more").repartition("bucket").sortWithinPartitions("bucket", "kind")
    part = "block long, bucket int, n int, counts binary, new long"
    answers = words.mapInArrow(_counted(_arrow(rows, part)), part).groupBy("block").agg(F.collect_list(F.struct("bucket", "n", "counts")).alias("counts"), F.sum("new").alias("new"))
    grams = gathered.where("kind = 4").select(F.explode(F.arrays_zip("keys", "counts")).alias("g")).groupBy(F.col("g.keys").alias("gram")).agg(F.sum("g.counts").alias("n"))
    found = grams.toArrow()  # of order 1, so 2**16 at most
    low = docs.sparkSession.sparkContext.broadcast((found["gram"].to_numpy().astype(np.uint64), found["n"].to_numpy().astype(np.int64)))
    windows = gathered.where("kind in (2, 3)").select("bucket", "kind", "block", "n", "data", "more").repartition("bucket").sortWithinPartitions("bucket", "kind")
    reply = "block long, n int, data binary, answer binary"
    replies = windows.mapInArrow(_answered(low, _arrow(rows, reply)), reply).groupBy("block").agg(F.collect_list(F.struct("n", "data", "answer")).alias("replies"))
    texts = gathered.where("kind = 0").select("block", "ids", "held", "raw", "size")
    joined = texts.join(answers, "block").join(replies, "block").select("ids", "held", "raw", "size", "counts", "new", "replies")
    out = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, logs double, score double, new long"
    sums = durable(joined.mapInArrow(_scored(_arrow(rows, out)), out))
    distinct = sums.agg(F.coalesce(F.sum("new"), F.lit(0))).first()[0]
    tokens = gathered.where("kind = 0").agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    base = F.col("logs") - F.col("n_tokens") * F.lit(math.log10(tokens + distinct + 1))
    return sums.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def _arrow(df: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


ship(__name__)
