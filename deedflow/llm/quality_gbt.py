"""Document quality by histogram gradient-boosted trees over document statistics.

Trees are grown on binned statistics with the logistic loss and flattened into arrays (feature, bin
threshold, children, leaf value), so a batch of documents walks all trees with a few numpy gathers.

The fit uses at most ``SAMPLE`` labelled rows, those with the least hash; scoring covers every row.

Defined results: null and empty texts have all statistics zero and get a score like any other; without
labels of both classes every score is the share of label 1 (0.5 without labels); repeated label rows count
repeatedly, of rows that share an id one text is learned from; long texts are measured whole; of splits that gain alike the first is taken; an empty table stays empty; columns named like the result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import durable, fresh, ship

SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, L2, LEAST = 80, 4, 64, 0.15, 1.0, 20
FEATURES = (
    "bytes", "words", "lines", "mean_word", "longest_word", "distinct_words", "distinct_lines", "commonest_line", "upper", "digits", "white", "periods", "commas",
    "pipes", "bangs", "hashes", "currency", "other_symbols", "high_bytes", "entropy", "words_a_line", "capital_words", "short_words", "commonest_word", "long_words",
)


def statistics(text: str | None) -> np.ndarray:
    """FEATURES of the whole text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(len(FEATURES))
    if not data:
        return out
    n = len(data)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    w, ln = max(1, len(words)), max(1, len(lines))
    share = counts[counts > 0] / n
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    tally: dict[bytes, int] = {}
    for x in words:
        tally[x] = tally.get(x, 0) + 1
    repeats: dict[bytes, int] = {}
    for x in lines:
        repeats[x] = repeats.get(x, 0) + 1
    letters = max(1, int(counts[65:91].sum() + counts[97:123].sum()))
    c = lambda marks: counts[list(marks)].sum()
    out[:] = (
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), sizes.mean(), sizes.max(), len(tally) / w, len(repeats) / ln,
        max(repeats.values(), default=0) / ln, counts[65:91].sum() / letters, counts[48:58].sum() / n, c(b" \t\n\r\v\f") / n, c(b".") / w, c(b",") / w,
        c(b"|") / w, c(b"!") / w, c(b"#*&") / w, c(b"$%") / w, c(b"<>{}[]()=+_/\\~^@:;\"'-?") / w, counts[128:].sum() / n, -(share * np.log2(share)).sum(),
        len(words) / ln, counts[65:91].sum() / w, (sizes <= 3).sum() / w, max(tally.values(), default=0) / w, (sizes >= 14).sum() / w,
    )
    return out


@dataclass
class Forest:
    """All trees in flat arrays; node 2i+1 and 2i+2 are the children of node i of a tree."""

    edges: list[np.ndarray]
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1) if len(self.edges) else np.zeros((len(x), 0), np.int64)

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if len(self.feature):
            b, row = self.binned(x), np.arange(len(x))
            for t in range(len(self.feature)):
                node = np.zeros(len(x), np.int64)
                for _ in range(DEPTH):
                    node = 2 * node + 1 + (b[row, self.feature[t, node]] > self.threshold[t, node])
                total += self.value[t, node]
        return 1.0 / (1.0 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees for 0/1 targets."""
    share = float(y.mean()) if len(y) else 0.5
    if len(y) == 0 or share in (0.0, 1.0):
        bounded = min(max(share, 1e-6), 1 - 1e-6)
        return Forest([], np.zeros((0, 0), np.int64), np.zeros((0, 0)), np.zeros((0, 0)), float(np.log(bounded / (1 - bounded))))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    nodes = 2 ** (DEPTH + 1) - 1
    forest = Forest(edges, np.zeros((TREES, nodes), np.int64), np.full((TREES, nodes), BINS + 1.0), np.zeros((TREES, nodes)), float(np.log(share / (1 - share))))
    b = forest.binned(x)
    flat = b + np.arange(b.shape[1]) * (BINS + 1)
    raw = np.full(len(y), forest.base)
    for t in range(TREES):
        p = 1.0 / (1.0 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        at = np.zeros(len(y), np.int64)
        for depth in range(DEPTH + 1):
            for node in range(2**depth - 1, 2 ** (depth + 1) - 1):
                rows = np.nonzero(at == node)[0]
                if not len(rows):
                    continue
                gs, hs = g[rows].sum(), h[rows].sum()
                forest.value[t, node] = -RATE * gs / (hs + L2)
                if depth == DEPTH:
                    continue
                size = b.shape[1] * (BINS + 1)
                key = flat[rows].ravel()
                bins = lambda v: np.bincount(key, weights=np.repeat(v[rows], b.shape[1]), minlength=size).reshape(b.shape[1], BINS + 1).cumsum(axis=1)  # noqa: B023, E731
                gl, hl, nl = bins(g), bins(h), bins(np.ones(len(y)))
                gain = gl**2 / (hl + L2) + (gs - gl) ** 2 / (hs - hl + L2) - gs**2 / (hs + L2)
                gain[(nl < LEAST) | (len(rows) - nl < LEAST)] = -1.0
                j, k = np.unravel_index(int(gain.argmax()), gain.shape)
                go_left = gain[j, k] <= 1e-6
                # a node that isn't split sends all rows to its left child, which has the same value
                forest.feature[t, node], forest.threshold[t, node] = (0, BINS + 1) if go_left else (j, k)
                at[rows] = 2 * node + 1 + (b[rows, forest.feature[t, node]] > forest.threshold[t, node])
        raw += forest.value[t, at]
    return forest


def _measured(docs: DataFrame, rest: list[str], text: str, name: str, kind: str, one) -> DataFrame:
    """``rest`` and the column ``name`` that ``one`` makes of a list of texts."""
    schema = docs.select(*rest, F.lit(None).cast(kind).alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], one(batch.column(len(rest)))], names=[*rest, name])

    return docs.select(*rest, F.col(text)).mapInArrow(run, schema)


def _matrix(texts: pa.Array) -> np.ndarray:
    return np.array([statistics(t.as_py()) for t in texts]).reshape(len(texts), len(FEATURES))


def fit(docs: DataFrame, labels: DataFrame, train: Column, label: str, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Forest:
    """Trees from at most ``sample`` labelled rows; ``train`` (on the labels) tells those that may be used."""
    rows = labels.where(F.coalesce(train, F.lit(False)) & F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    chosen = durable(rows.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample))
    # at most ``sample`` rows, and one text for each
    once = F.broadcast(chosen.groupBy("doc_id", "label").agg(F.count("*").alias("n")))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(once, "doc_id").groupBy("doc_id", "label", "n").agg(F.min("text").alias("text"))
    arrays = lambda t: pa.FixedSizeListArray.from_arrays(pa.array(_matrix(t).ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
    found = _measured(texts, ["label", "n"], "text", "x", "array<double>", arrays).toPandas()
    x = np.stack(found["x"].to_numpy()) if len(found) else np.zeros((0, len(FEATURES)))
    times = found["n"].to_numpy(np.int64)
    by = np.lexsort((*x.T, found["label"].to_numpy(np.float64))) if len(x) else np.zeros(0, np.int64)  # the same sums whatever the order of arrival
    return grow(np.repeat(x[by], times[by], axis=0), np.repeat(found["label"].to_numpy(np.float64)[by], times[by]))


def judge(docs: DataFrame, forest: Forest, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` without its text, with the score."""
    rest = [c for c in docs.columns if c not in (text, score)]
    (work,) = fresh(docs, "text_to_score")
    return _measured(docs.withColumn(work, F.col(text)), rest, work, score, "double", lambda t: pa.array(forest.scores(_matrix(t))))


ship(__name__)
