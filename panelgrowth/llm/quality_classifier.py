"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on each document.
Expectation-maximisation over the counts of all vote patterns (statistics of
every document; at most 3^labellers patterns) estimates how each labeller votes
on good and on bad documents, and the share of good ones.  The posterior of a
document's votes is its label.  A linear scorer over hashed features of the
text is trained on these labels and scores every document.

Only the scorer's fit uses a sample: the ``SAMPLE_DOCS`` distinct documents (id
and text) with the smallest hash (the documented bound).  Votes, pattern counts,
posteriors and scores cover all documents.

Defined results: a NULL or empty text has no features; its score is the
posterior of a wordless text's votes.  A document with a NULL id is labelled, drawn
and scored like others; texts that share an id are drawn each by itself.  Repeated rows get equal scores.  An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelgrowth.llm import wordhash
from panelgrowth.llm.common import only, written
from panelgrowth.llm.quality_rules import features

SAMPLE_DOCS = 6000
DIM = 1 << 12        # hashed features
ROUNDS = 60          # of expectation-maximisation
MOST_RIGHT = 0.9     # no labeller is trusted more: their errors are not independent
EPOCHS = 12          # of the scorer's fit
KEEP_ABOVE = 0.2
SEED = 7


def labellers() -> dict[str, tuple[Column, Column]]:
    """name: (votes bad, votes good); neither: abstains.  Over ``features``."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    visible = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    upper, stop = F.col("chars")[0] / visible, F.col("chars")[3] / n
    symbols = F.col("chars")[2] / visible
    common = F.lit(1.0) - F.get("common", F.size("common") - 1) / n
    word = F.col("word_chars") / n
    some, many = F.col("n_words") >= 16, F.col("n_words") >= 40
    no = F.lit(False)
    return {
        "empty": (F.col("n_words") < 3, no),
        "repeats": (F.col("n_repeat_words") > 0.3 * n, no),
        "echoes": (F.col("n_repeat_words") > 0.15 * n, no),
        "loops": (F.col("n_repeat_words") > 0.5 * n, no),
        "symbols": (some & (symbols > 0.08), no),
        "bars": (many & (F.col("n_symbols") > 0.2 * n), no),
        "upper": (some & (upper > 0.3), no),
        "word_length": (some & ~word.between(2.5, 12.0), no),
        "sentences": (many & ((stop < 0.01) | (stop > 0.6)), some & stop.between(0.03, 0.4)),
        "common": (many & (common < 0.08), some & (common > 0.15)),
    }


def votes(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_words and ``votes``: one digit per labeller, 0 bad, 1 abstains, 2 good."""
    f = features(docs, hashed=True)
    digit = [F.when(F.coalesce(bad, F.lit(False)), "0").when(F.coalesce(good, F.lit(False)), "2").otherwise("1")
             for bad, good in labellers().values()]
    return f.select("doc_id", "text_hash", "n_words", F.concat(*digit).alias("votes"))


def fit_votes(patterns: dict[str, int], rounds: int = ROUNDS) -> dict[str, float]:
    """Posterior of "good" for each vote pattern, by expectation-maximisation
    on the pattern counts.

    Two classes; a labeller that votes is right with its own accuracy,
    independent of the others, whatever the class.  The start is the majority
    vote, which also says which class is the good one; an accuracy stays above
    one half, so the classes cannot change places.
    """
    if not patterns:
        return {}
    keys = sorted(patterns)
    v = np.array([[int(c) for c in k] for k in keys]) - 1.0   # -1 bad, 0 abstains, 1 good
    n = np.array([patterns[k] for k in keys], float)
    good = 1 / (1 + np.exp(-2.0 * v.sum(1) - 1.0))
    for _ in range(rounds):
        right = (n * (good * (v > 0).T + (1 - good) * (v < 0).T)).sum(1) + 2.0
        accuracy = np.clip(right / ((n * (v != 0).T).sum(1) + 3.0), 0.55, MOST_RIGHT)
        prior = np.clip((n * good).sum() / n.sum(), 0.25, 0.75)
        z = np.log(prior / (1 - prior)) + v @ np.log(accuracy / (1 - accuracy))
        good = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    return dict(zip(keys, good.tolist()))


def hashed(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, value, first feature of each text): hashed byte pairs, words,
    repeated neighbours and the share of new words (longer texts), each family of norm 1."""
    data, offsets = wordhash.text_bytes(column)
    n = len(offsets) - 1
    out_f, out_v, out_t = [], [], []

    def family(feature: np.ndarray, text: np.ndarray) -> None:
        key = text.astype(np.int64) * DIM + feature.astype(np.int64)
        key, count = np.unique(key, return_counts=True)
        t = key // DIM
        value = np.sqrt(count.astype(np.float64))
        norm = np.sqrt(np.bincount(t, value * value, n))
        out_f.append(key % DIM)
        out_v.append(value / norm[t])
        out_t.append(t)

    def slot(h: np.ndarray, salt: int) -> np.ndarray:
        return wordhash.mix64(h + np.uint64(salt)) >> np.uint64(64 - DIM.bit_length() + 1)

    text = np.repeat(np.arange(n), np.diff(offsets))
    if len(data) > 1:
        same = text[1:] == text[:-1]
        pairs = data[:-1].astype(np.uint64) * np.uint64(256) + data[1:]
        family(slot(pairs[same], 1), text[:-1][same])
    h, first = wordhash.words(data, offsets, lower=True)
    word_text = np.repeat(np.arange(n), np.diff(first))
    if len(h):
        family(slot(h, 2), word_text)
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (word_text[1:] == word_text[:-1])
        d, dfirst = wordhash.distinct(h, first)
        count = np.diff(first)
        some = np.flatnonzero(count)
        share = np.diff(dfirst)[some] / count[some]
        near = np.bincount(word_text, again, n)[some] / count[some]
        long = count[some] >= 40  # the share of new words says little on few words
        family(slot(np.floor(share[long] * 10).astype(np.uint64), 3), some[long])
        family(slot(np.floor(near * 10).astype(np.uint64), 4), some)
    if not out_t:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(n + 1, np.int64)
    t = np.concatenate(out_t)
    order = np.argsort(t, kind="stable")
    first = np.searchsorted(t[order], np.arange(n + 1))
    return np.concatenate(out_f)[order], np.concatenate(out_v)[order], first


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, to bound a task's memory."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray,
               epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by adaptive gradient steps; a rarer
    class weighs more, by the root of its rarity."""
    w, g2, b, gb = np.zeros(DIM), np.full(DIM, 1e-8), 0.0, 1e-8
    good = max(labels.sum(), 1e-9)
    bad = max((1 - labels).sum(), 1e-9)
    weight = labels * np.sqrt(len(labels) / (2 * good)) + (1 - labels) * np.sqrt(len(labels) / (2 * bad))
    rng = np.random.default_rng(SEED)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            f, v = rows[i]
            p = 1 / (1 + np.exp(-np.clip(w[f] @ v + b, -30, 30)))
            step = min(weight[i], 10.0) * (p - labels[i])
            grad = step * v + 1e-6 * w[f]
            np.add.at(g2, f, grad * grad)
            np.add.at(w, f, -0.3 * grad / np.sqrt(g2[f]))
            gb += step * step
            b -= 0.1 * step / np.sqrt(gb)
    return w, b


def quality_classifier(docs: DataFrame, sample_docs: int = SAMPLE_DOCS,
                       keep_above: float = KEEP_ABOVE) -> DataFrame:
    """doc_id, score (0 bad .. 1 good), kept: one row per input row."""
    spark = docs.sparkSession
    d = only(docs, doc_id=("doc_id", "long"), text=("text", "string"))
    voted = written(votes(docs), "classifier-votes")
    posterior = fit_votes({r[0]: r[1] for r in voted.groupBy("votes").count().collect()})
    if not posterior:
        return spark.createDataFrame([], "doc_id long, score double, kept boolean")
    # at most 3^labellers rows
    table = spark.createDataFrame([(k, float(p)) for k, p in posterior.items()], "votes string, posterior double")
    weak = voted.join(F.broadcast(table), "votes")
    # the bounded sample: smallest hashes of the (id, text), each of them once
    draw = F.xxhash64(F.lit(SEED), "doc_id", "text_hash")
    chosen = (weak.groupBy("doc_id", "text_hash").agg(F.min("posterior").alias("posterior")).withColumn("draw", draw)
              .orderBy("draw", "doc_id", "text_hash").limit(sample_docs))
    ids = {(r["doc_id"], r["text_hash"]): r["posterior"] for r in chosen.collect()}
    last = spark.createDataFrame(list(ids), "_id long, _hash long")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            f, v, first = hashed(batch.column(1))
            cut = pa.array(first, pa.int32())
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(cut, pa.array(f, pa.int32())),
                                   pa.ListArray.from_arrays(cut, pa.array(v, pa.float64())), batch.column(2)],
                                  names=["doc_id", "f", "v", "h"])

    own = d.withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    drawn = own.join(F.broadcast(last), own["doc_id"].eqNullSafe(F.col("_id")) & (own["h"] == F.col("_hash")), "left_semi")
    got = (drawn.groupBy("doc_id", "h").agg(F.min("text").alias("text")).select("doc_id", "text", "h")
           .mapInArrow(extract, "doc_id long, f array<int>, v array<double>, h long").collect())
    got.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["h"]))
    rows = [(np.asarray(r["f"], np.int64), np.asarray(r["v"], np.float64)) for r in got]
    weights, bias = fit_scorer(rows, np.array([ids[r["doc_id"], r["h"]] for r in got]))
    shared = spark.sparkContext.broadcast((weights, bias))

    # texts without features get the posterior of a wordless text's votes
    none = voted.where("n_words = 0").select("votes").head()
    without = posterior[none[0]] if none else 0.0

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = shared.value
        for batch in _parts(batches):
            f, v, first = hashed(batch.column(1))
            text = np.repeat(np.arange(len(first) - 1), np.diff(first))
            z = np.bincount(text, w[f] * v, len(first) - 1) + b
            s = np.where(first[1:] > first[:-1], 1 / (1 + np.exp(-np.clip(z, -30, 30))), without)
            yield pa.record_batch([batch.column(0), pa.array(s)], names=["doc_id", "score"])

    return d.mapInArrow(score, "doc_id long, score double").withColumn("kept", F.col("score") > keep_above)
