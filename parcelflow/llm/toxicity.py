"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives, other texts count as unlabelled, whatever a label says of them. A linear
classifier over hashed words is trained on the risk ``prior * R(P, +) + max(0, R(U, -) - prior * R(P, -))``: the
unlabelled texts hold positives too, and the class prior takes their part out again. Where the corrected negative part
falls below zero, its gradient is turned around, which is what keeps the classifier from fitting that noise.

Features are words and their first bytes, which compounds share. Each is scaled by how much more often positives have it
than unlabelled texts, smoothed, so that rare words weigh little until enough positives have them.

Several classifiers are trained side by side, one in each task, on separate bounded samples; their mean scores texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.llm.shared import PIECE_BYTES, mapped, written
from parcelflow.llm.words import PLAIN, Words, paired, pieces

#: Buckets that words and their beginnings are hashed to, and the lengths of these in bytes (8 at most).
BUCKETS, BEGINNINGS = 1 << 16, (4, 6, 8)
#: Classifiers, and the texts that each is trained on at most: positives and unlabelled ones.
CLASSIFIERS, POSITIVES, UNLABELLED = 4, 1_000, 4_000
#: Steps of the optimiser, its rate, the weight decay and the bound below which the negative part is turned around.
STEPS, RATE, DECAY, BOUND = 500, 0.1, 1e-4, 0.0
#: Positives that are added to the count of each feature and to what is expected of it, and the least log ratio that counts.
SMOOTHING, RATIO = 2.0, 0.1
#: Score from which a text is called toxic.
LEAST = 0.7


def word_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and weights of the texts' words and their beginnings, and where those of each text begin.

    A bucket weighs 1 + log of its count, over the log of the number of words of the text and two.
    """
    words = Words(texts, PLAIN, lower=True)
    owner = words.owners()
    hashes, owners = [words.hashes()], [owner]
    padded = np.zeros(len(words.data) + 8, np.uint8)
    padded[: len(words.data)] = words.data
    eight = np.ndarray(len(words.data) + 1, "<u8", padded.data, strides=(1,))[words.start]
    for length in BEGINNINGS:
        long_ = np.flatnonzero(words.end - words.start >= length)
        begin = eight[long_] & np.uint64((1 << 8 * length) - 1)
        hashes.append(paired(np.full(len(long_), length, np.uint64), begin))
        owners.append(owner[long_])
    key = np.concatenate(owners) * BUCKETS + (np.concatenate(hashes) & np.uint64(BUCKETS - 1)).astype(np.int64)
    key, count = np.unique(key, return_counts=True)
    owner = key // BUCKETS
    weight = (1 + np.log(count)) / np.log(2 + words.counts)[owner]
    return (key % BUCKETS).astype(np.int32), weight.astype(np.float32), np.searchsorted(owner, np.arange(len(texts) + 1))


def _features(batch: pa.RecordBatch):
    for row, texts in pieces(batch, batch["text"], PIECE_BYTES):
        here = batch.slice(row, len(texts))
        bucket, weight, first = word_counts(texts)
        ends = pa.array(first, pa.int32())
        yield pa.record_batch(
            [here["bag"], here["positive"], here["turn"], pa.ListArray.from_arrays(ends, pa.array(bucket)), pa.ListArray.from_arrays(ends, pa.array(weight))],
            ["bag", "positive", "turn", "bucket", "weight"],
        )


def fitted(bucket: np.ndarray, weight: np.ndarray, first: np.ndarray, positive: np.ndarray, prior: float) -> np.ndarray:
    """Weights of the buckets, and the intercept behind them, that make the non-negative risk small.

    Logistic loss; Adam on the whole sample. ``positive`` marks rows of P, all others are U.
    """
    rows = np.repeat(np.arange(len(positive)), np.diff(first))
    plus, rest = positive, ~positive
    n_plus, n_rest = max(1, plus.sum()), max(1, rest.sum())
    met = np.bincount(bucket[plus[rows]], minlength=BUCKETS)
    expected = np.bincount(bucket[rest[rows]], minlength=BUCKETS) / n_rest * n_plus
    scale = np.log((met + SMOOTHING) / (expected + SMOOTHING))
    scale[np.abs(scale) < RATIO] = 0
    used = scale[bucket] != 0
    rows, bucket, weight = rows[used], bucket[used], weight[used] * scale[bucket[used]]
    out = np.zeros(BUCKETS + 1)
    out[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(out), np.zeros_like(out)
    for step in range(1, STEPS + 1):
        margin = np.bincount(rows, weights=weight * out[bucket], minlength=len(positive)) + out[-1]
        chance = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        loss_minus = np.logaddexp(0, margin)
        negative = loss_minus[rest].sum() / n_rest - prior * loss_minus[plus].sum() / n_plus
        # Slopes of the losses by the margin: chance - 1 for +, chance for -.
        slope_negative = np.where(plus, -prior * chance / n_plus, chance / n_rest)
        slope_positive = np.where(plus, prior * (chance - 1) / n_plus, 0.0)
        slope = slope_positive + slope_negative if negative >= -BOUND else -slope_negative
        gradient = np.append(np.bincount(bucket, weights=weight * slope[rows], minlength=BUCKETS), slope.sum())
        gradient[:-1] += DECAY * out[:-1]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        out -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    out[:-1] *= scale
    return out


def _train(prior: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["positive", "turn"])
        sizes = rows["bucket"].map(len).to_numpy()
        first = np.concatenate(([0], np.cumsum(sizes)))
        bucket = np.concatenate([*rows["bucket"], np.zeros(0, np.int32)]).astype(np.int64)
        weight = np.concatenate([*rows["weight"], np.zeros(0, np.float32)]).astype(np.float64)
        model = fitted(bucket, weight, first, rows["positive"].to_numpy(), prior)
        return pd.DataFrame({"bag": [key[0]], "model": [model.astype(np.float32).tobytes()]})

    return run


def _sampled(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows by their ``turn``, an even hash; all of them if there are no more."""
    number = rows.count()
    if number <= most:
        return rows
    # Not a sort: rows below the hash value that holds the wanted share.
    limit = int((2 * most / number - 1) * (1 << 63)) if most < number else (1 << 63) - 1
    return rows.where(F.col("turn") < F.lit(limit))


def trained(docs: DataFrame, toxic: DataFrame, prior: float, seed: int = 0) -> np.ndarray:
    """Mean of the classifiers learnt from ``docs`` (doc_id, text), of which ``toxic`` (doc_id) are confirmed positives.

    At most about ``CLASSIFIERS * POSITIVES`` positives and ``CLASSIFIERS * UNLABELLED`` unlabelled texts are used,
    drawn by a hash of doc_id and text. All texts of ``docs`` are drawn from as unlabelled, the confirmed ones included,
    as the risk asks for. Without a positive text the model calls nothing toxic, so neither do empty tables. A null text
    counts as an empty one. Repeated rows are drawn together; an id that is confirmed twice counts once.
    """
    turn = F.xxhash64(F.lit(seed), "doc_id", "text")
    rows = docs.select("doc_id", "text", turn.alias("turn"))
    confirmed = _sampled(rows.join(toxic.select("doc_id").distinct(), "doc_id"), CLASSIFIERS * POSITIVES)
    unlabelled = _sampled(rows, CLASSIFIERS * UNLABELLED)
    number = confirmed.count()
    if not number:
        model = np.zeros(BUCKETS + 1, np.float32)
        model[-1] = -10
        return model
    # Few positives go to every classifier, many are dealt out; unlabelled texts are always dealt out.
    parts = min(CLASSIFIERS, -(-number // POSITIVES))
    part = F.pmod(F.xxhash64(F.lit(seed + 1), "turn"), F.lit(parts))
    bags = F.filter(F.sequence(F.lit(0), F.lit(CLASSIFIERS - 1)), lambda b: b % parts == part)
    bag = F.pmod(F.xxhash64(F.lit(seed + 2), "turn"), F.lit(CLASSIFIERS)).cast("int")
    sample = confirmed.select(F.explode(bags).alias("bag"), F.lit(True).alias("positive"), "turn", "text").union(
        unlabelled.select(bag.alias("bag"), F.lit(False).alias("positive"), "turn", "text")
    )
    kind = "bag int, positive boolean, turn long, bucket array<int>, weight array<float>"
    sample = written(mapped(sample, _features, kind))
    models = sample.groupBy("bag").applyInPandas(_train(prior), "bag int, model binary").collect()
    return np.mean([np.frombuffer(r["model"], np.float32) for r in sorted(models, key=lambda r: r["bag"])], axis=0)


def _score(model, kept: list[str]):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        by = model.value
        for row, texts in pieces(batch, batch["row"].field("text"), PIECE_BYTES):
            here = batch.slice(row, len(texts))["row"]
            bucket, weight, first = word_counts(texts)
            sums = np.concatenate(([0.0], np.cumsum(weight.astype(np.float64) * by[bucket])))
            margin = np.diff(sums[first]) + by[-1]
            score = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
            rows = pa.StructArray.from_arrays([here.field(c) for c in kept], kept)
            yield pa.record_batch([rows, pa.array(score, pa.float64())], ["row", "score"])

    return run


def scored(docs: DataFrame, model: np.ndarray, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns of ``docs``, or those of ``keep``) and ``score`` of each text.

    A null or empty text has no words; its score is that of the intercept, as is that of a text of blanks.
    """
    keep = keep or docs.columns
    wanted = [*keep] if "text" in keep else [*keep, "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in wanted]).alias("row"))
    kind = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in keep])
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return mapped(rows, _score(sent, keep), T.StructType().add("row", kind).add("score", "double"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are not learnt from: a third, by the CRC of the id as text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3 == 1


def learnt(docs: DataFrame, labels: DataFrame, seed: int = 0) -> np.ndarray:
    """The classifier for ``docs`` (doc_id, text) by ``labels`` (doc_id, toxic), of which held-out rows are not looked at.

    The class prior is the share of toxic rows among the labelled ones.
    """
    known = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    share = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    prior = min(0.5, max(0.001, share if share is not None else 0.001))
    return trained(docs.where(~held_out()).select("doc_id", "text"), known.where("toxic = 1"), prior, seed)
