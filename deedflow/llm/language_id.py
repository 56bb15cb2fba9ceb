"""Language identification by prediction by partial matching.

Each language has its own variable-order trie of byte contexts with escape probabilities (see ``ppm``),
frozen after training; a text's exact code length under every trie is compared and the shortest wins (ties:
the first language by name).  The score is the winner's share when code lengths are read as likelihoods.

Training counts byte windows of at most ``SAMPLE`` whole texts of each language, those with the least hash of id,
language and text (repeated rows count once); only the summed counts come to the driver.  Rows are thinned by their
hash first, at a rate from the language's number of different rows, so a language that holds most rows sends no more than another.

Code length: a text whose best trie needs ``UNEXPLAINED`` bits for each of its bytes, or more, is not explained better than
by drawing bytes at random; ``judge`` can return the bits.

Defined results: ``und`` with score 0 for a null text, a text without a letter, and for everything when
there is nothing to learn from; long texts are scored whole; repeated rows are judged alike; an empty table stays empty; columns named
like result columns are replaced, all others kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ppm
from .runtime import durable, ship, trim

SAMPLE = 400
#: A language's hash threshold lets about this many times the sample through, and ``LEAST`` more.
ROOM, LEAST = 4, 64
#: Bits of a byte drawn at random from the alphabet.
UNEXPLAINED = float(np.log2(ppm.ALPHABET))
#: Sample keys up to this number are sent to every executor; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: The windows of a language's sample are counted in so many tasks.
PARTS = 8
UNKNOWN = "und"


def prepared(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lang, keys, counts = None, [], []
    for batch in batches:
        if batch.num_rows:
            lang = batch.column(0)[0].as_py()
            k, n = ppm.grams(ppm.joined([prepared(text.as_py()) for text in batch.column(1)])[0])
            keys.append(k)
            counts.append(n)
    k, n = ppm.summed(keys, counts)
    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])


def windows(picked: DataFrame) -> DataFrame:
    """(lang, gram, n): windows of the texts of (``lang``, ``text``, ``order``), summed in ``PARTS`` parts of a language.

    The parts follow from the rows, so the number of sums is the same over any number of partitions.
    """
    parts = picked.select("lang", "text", F.pmod("order", F.lit(PARTS)).alias("part"))
    return parts.groupBy("lang", "part").applyInArrow(_count, "lang string, gram long, n long")


def learn(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> tuple[list[str], ppm.Model | ppm.Tries | None]:
    """Languages in order and their common model; ``train`` tells the rows that may be learned from."""
    rows = docs.where(F.coalesce(train, F.lit(False)) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    order = F.xxhash64(F.col(doc_id), F.col(lang), F.col(text))
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), order.alias("order"))
    # as many rows as there are languages
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("order").alias("rows"))
    share = F.least(F.lit(1.0), F.lit(float(ROOM * sample + LEAST)) / F.col("rows"))
    limits = F.broadcast(durable(sizes.select(F.col("lang").alias("of"), (F.lit(-(2.0**63)) + share * F.lit(2.0**64)).alias("limit"))))
    keys = rows.select("lang", "order").join(limits, F.col("lang") == F.col("of")).where(F.col("order") <= F.col("limit"))
    first = Window.partitionBy("lang").orderBy("order")
    keys = keys.groupBy("lang", "order").agg(F.count("*").alias("n")).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= sample)
    chosen = durable(keys.select("order").distinct())
    few = chosen.count() <= BROADCAST_ROWS
    picked = rows.join(F.broadcast(chosen) if few else chosen, "order", "left_semi").groupBy("lang", "order").agg(F.first("text").alias("text"))
    counts = windows(picked).groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    names = sorted(counts["lang"].unique())
    parts = [counts[counts["lang"] == name].sort_values("gram") for name in names]
    if not names:
        return [], None
    return names, ppm.model_of([(p["gram"].to_numpy(np.int64), p["n"].to_numpy(np.int64)) for p in parts])


def judge(docs: DataFrame, names: list[str], model: ppm.Model | ppm.Tries | None, text: str = "text", keep: list[str] | None = None, lang_pred: str = "lang_pred", score: str = "score", bits: str | None = None) -> DataFrame:
    """The columns ``keep`` (all, if not given) with the predicted language and the score.

    ``bits`` names a column of the bits for each byte (the end counts as one) under the best trie, null without a verdict.
    """
    rest = [c for c in keep or docs.columns if c not in (lang_pred, score, bits)]
    sent = rest if text in rest else [*rest, text]
    at = sent.index(text)
    more = [] if bits is None else [F.lit(None).cast("double").alias(bits)]
    schema = docs.select(*rest, F.lit("").alias(lang_pred), F.lit(0.0).alias(score), *more).schema
    languages = np.array([*names, UNKNOWN], object)
    shared = docs.sparkSession.sparkContext.broadcast(model.state()) if model is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        letter = re.compile(r"[^\W\d_]")
        frozen = ppm.frozen(shared.value) if shared is not None else None
        for batch in batches:
            texts = batch.column(at).to_pylist()
            known = np.fromiter((bool(t) and letter.search(t) is not None for t in texts), bool, len(texts))
            best, share, length = np.full(len(texts), len(names)), np.zeros(len(texts)), np.full(len(texts), np.nan)
            if frozen is not None and known.any():
                some = [prepared(t) for t, k in zip(texts, known) if k]
                logs = frozen.scores(some)
                best[known] = logs.argmax(axis=1)
                share[known] = 1.0 / (10.0 ** np.maximum(logs - logs.max(axis=1, keepdims=True), -300)).sum(axis=1)
                length[known] = -logs.max(axis=1) / np.log10(2.0) / (np.fromiter(map(len, some), np.int64, len(some)) + 1)
            columns = [*batch.columns[: len(rest)], pa.array(languages[best], pa.string()), pa.array(share)]
            if bits is not None:
                columns.append(pa.array(length, from_pandas=True))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        trim()

    return docs.select(*sent).mapInArrow(run, schema)


ship(__name__)
