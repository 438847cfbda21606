"""Language identification by averaged hashed subword embeddings.

A text is the average of the embeddings of its subwords (three- and four-byte runs
inside words, with the word's edges), hashed to a fixed number of rows; a linear softmax
stands on top. Both are trained with stochastic gradient descent on a bounded sample.
Since the average and the softmax input are linear, a fitted model is folded into one
table of subword scores by language, which is what predicting tasks receive.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import balanced_sample
from .words import STEP_BYTES, Texts, steps

UNKNOWN = "und"
_EDGE = np.arange(256, dtype=np.uint32)
_EDGE[65:91] += 32
_EDGE[[9, 10, 11, 12, 13]] = 32


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 16
    dimensions: int = 16
    #: Texts that the model is fitted on, at most about this many of each language.
    texts_per_language: int = 1500
    epochs: int = 4
    rate: float = 0.5
    #: Share of the sample that is kept from training, to fit temperature and rejection.
    calibration: float = 0.2
    #: A prediction is rejected below the confidence at which this share of calibration texts is right.
    accuracy: float = 0.99
    seed: int = 7


def _subwords(texts: Texts, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bucket and text of every subword, by length."""
    codes = _EDGE[texts.buffer]
    owners = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(texts.bounds))
    gap = codes == 32
    out = []
    for n, inner in ((3, (1,)), (4, (1, 2))):
        size = len(codes) - n + 1
        if size <= 0:
            continue
        whole = owners[:size] == owners[n - 1 :]
        for i in inner:
            whole &= ~gap[i : i + size]
        at = np.flatnonzero(whole)
        key = codes[at]
        for i in range(1, n):
            key = key | (codes[at + i] << np.uint32(8 * i))
        key = (key ^ (key >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
        key = (key ^ (key >> np.uint32(12))) * np.uint32(0x297A2D39)
        out.append(((key >> np.uint32(32 - bits)).astype(np.int64), owners[at]))
    return out


def _bags(bits: int):
    """Distinct subword buckets of a text and their counts; the number of buckets bounds the size."""

    @F.arrow_udf("struct<bucket:array<int>,n:array<int>>")
    def of(texts: pa.Array) -> pa.Array:
        buckets, counts, lengths = [], [], []
        for text in steps(texts):
            parts = _subwords(text, bits)
            keys = np.concatenate([o.astype(np.int64) << bits | b for b, o in parts]) if parts else np.zeros(0, np.int64)
            keys, n = np.unique(keys, return_counts=True)
            buckets.append(keys & ((1 << bits) - 1))
            counts.append(n)
            lengths.append(np.bincount(keys >> bits, minlength=len(text)))
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(lengths)))) if lengths else np.zeros(1, np.int64)
        flat = [pa.array(np.concatenate(x) if x else np.zeros(0), pa.int32()) for x in (buckets, counts)]
        arrays = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), x) for x in flat]
        return pa.StructArray.from_arrays(arrays, ["bucket", "n"])

    return of


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def logits(self, total: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (total / np.maximum(n, 1)[:, None] + self.bias) / self.temperature


def fit(rows: DataFrame, text_column: str, language_column: str, settings: Settings | None = None) -> Model:
    """Train on a bounded sample of rows whose text and language are not null.

    The sample is of distinct texts: about ``texts_per_language`` of each language, fewer where there are so many languages
    that all together would pass ``sampling.MAX_ROWS``; more than ``sampling.MAX_LABELS`` of them raise an error.
    Ids play no part, so repeated or null ones change nothing. With no such row the model knows no language and every prediction is ``und``.
    """
    settings = settings or Settings()
    bits = settings.buckets.bit_length() - 1
    named = rows.where(F.col(text_column).isNotNull() & F.col(language_column).isNotNull())
    named = named.select(F.col(language_column).alias("_lang"), F.col(text_column).alias("_text"))
    sample = balanced_sample(named, F.col("_text"), "_lang", settings.texts_per_language, "language")
    bags = sample.select("_draw", "_lang", _bags(bits)("_text").alias("bag")).select("_draw", "_lang", "bag.*").toArrow()
    if not bags.num_rows:
        return Model((), np.zeros((settings.buckets, 0), np.float32), np.zeros(0), 1.0, 0.0)
    bags = bags.sort_by([("_draw", "ascending"), ("_lang", "ascending")])
    names = np.array(bags["_lang"].to_pylist(), object)
    languages = tuple(sorted(set(names)))
    truth = np.searchsorted(np.array(languages, object), names)
    items = [
        (b.values.to_numpy(), n.values.to_numpy())
        for b, n in zip(bags["bucket"].combine_chunks(), bags["n"].combine_chunks())
    ]
    rng = np.random.default_rng(settings.seed)
    order = rng.permutation(len(items))
    cut = int(len(items) * settings.calibration) if len(items) >= 10 else 0
    held, learned = order[:cut], order[cut:]
    vectors = rng.normal(0, 0.1, (settings.buckets, settings.dimensions))
    weights = np.zeros((settings.dimensions, len(languages)))
    bias = np.zeros(len(languages))
    done, total = 0, settings.epochs * len(learned)
    for _ in range(settings.epochs):
        for i in rng.permutation(learned):
            rate = settings.rate * (1 - done / total)
            done += 1
            buckets, n = items[i]
            if not len(buckets):
                continue
            share = n / n.sum()
            mean = share @ vectors[buckets]
            slope = _softmax(mean @ weights + bias)
            slope[truth[i]] -= 1
            back = weights @ slope
            weights -= rate * np.outer(mean, slope)
            bias -= rate * 0.1 * slope
            vectors[buckets] -= (rate * 10) * share[:, None] * back
    scores = vectors @ weights

    def raw(which: np.ndarray) -> np.ndarray:
        rows = [(n / max(1, n.sum())) @ scores[b] if len(b) else np.zeros(len(languages)) for b, n in (items[i] for i in which)]
        return np.array(rows).reshape(-1, len(languages)) + bias

    judged = held if len(held) else learned
    z, y = raw(judged), truth[judged]
    grid = np.geomspace(0.05, 20, 60)
    losses = [-np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(losses))])
    p = _softmax(z / temperature)
    sure, right = p.max(axis=1), p.argmax(axis=1) == y
    by = np.argsort(-sure)
    good = np.flatnonzero(np.cumsum(right[by]) >= settings.accuracy * np.arange(1, len(by) + 1))
    threshold = float(sure[by[good[-1]]]) if len(good) else 1.0
    return Model(languages, scores.astype(np.float32), bias, temperature, threshold)


def predict(text: Column, model: Model) -> Column:
    """A struct ``lang_pred, score, rejected`` for each whole text.

    A null text, and one without a letter, is ``und`` with score 0 and rejected; so is
    every text if the model knows no language. Otherwise ``score`` is the calibrated
    probability of the predicted language, and ``rejected`` says that it is too low.
    """
    bits = len(model.scores).bit_length() - 1

    @F.arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def of(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for part in steps(texts, STEP_BYTES // 2):
            n = np.zeros(len(part))
            total = np.zeros((len(part), len(model.languages)))
            for buckets, owners in _subwords(part, bits):
                counts = np.bincount(owners, minlength=len(part))
                n += counts
                held = np.flatnonzero(counts)
                if len(held):
                    begins = (np.cumsum(counts) - counts)[held]
                    total[held] += np.add.reduceat(model.scores[buckets], begins, axis=0)
            p = _softmax(model.logits(total, n))
            best = p.argmax(axis=1)
            names.append(best)
            scores.append(p[np.arange(len(best)), best])
        best = np.concatenate(names) if names else np.zeros(0, np.int64)
        score = np.concatenate(scores) if scores else np.zeros(0)
        labels = pa.array(model.languages, pa.string()).take(pa.array(best))
        return pa.StructArray.from_arrays(
            [labels, pa.array(score), pa.array(score < model.threshold)], ["lang_pred", "score", "rejected"]
        )

    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    if not model.languages:
        return unknown
    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), of(text)).otherwise(unknown)
