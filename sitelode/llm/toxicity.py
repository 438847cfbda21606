"""Toxicity by weak supervision.

Terms (words, their first letters and their last letters) that stand out in a bounded
sample of labelled texts form lexicons; a fixed list of insults and writing patterns are
added. Each is a voter that fires or not. A generative model of the votes, a tree of
dependences for either class fitted by expectation-maximisation, estimates how accurate
the voters are and which depend on each other, and gives every sampled text a posterior; the given label is one voter among them. A linear classifier on the terms is trained on these posteriors and scores whole texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .sampling import balanced_sample
from .words import NOT_LETTERS, Texts, find_words, hash_spans, mix, steps

# Common English insults.
INSULTS = (
    "awful", "bastard", "brainless", "clown", "coward", "creep", "cretin", "crook", "degenerate", "despicable",
    "dimwit", "disgrace", "disgusting", "dumb", "dumbass", "filth", "filthy", "fool", "freak", "garbage", "hateful",
    "idiot", "idiotic", "ignorant", "imbecile", "jerk", "liar", "loser", "lunatic", "maggot", "moron", "moronic",
    "nasty", "parasite", "pathetic", "pig", "rat", "repulsive", "scum", "scumbag", "sicko", "slime", "stupid", "trash",
    "traitor", "ugly", "useless", "vermin", "vile", "weirdo", "worthless", "wretch",
)

#: Kinds of terms: the whole word, or so many bytes of its beginning or end.
KINDS = (("word", 0), ("begins", 4), ("begins", 5), ("begins", 6), ("ends", 5))


@dataclass(frozen=True)
class Settings:
    #: Labelled texts that lexicons, label model and classifier are fitted on, about this many of each label.
    texts_per_label: int = 6000
    #: Largest number of terms in the lexicons.
    terms: int = 4096
    #: Least ratio of a term's odds in positive and negative texts, two standard errors below the estimate.
    odds: float = 8.0
    #: Number of lexicons that the terms are dealt to.
    lexicons: int = 12
    #: Trusted reliability of given labels: the chance that they say 1 on the negative and on the positive class.
    label_says: tuple[float, float] = (0.02, 0.95)
    rounds: int = 60
    epochs: int = 400


def _terms(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every term, repeats included."""
    found = find_words(texts, NOT_LETTERS)
    owners, length = found.owners(), found.ends - found.starts
    keys, of = [], []
    for i, (kind, size) in enumerate(KINDS):
        long = np.flatnonzero(length > size)
        begins, ends = found.starts[long], found.ends[long]
        if kind == "begins":
            ends = begins + size
        elif kind == "ends":
            begins = ends - size
        hashes = hash_spans(texts.buffer, begins, ends, lower=True)
        # The kind is kept in the lowest three bits.
        keys.append((mix(hashes + np.uint64(i + 1)) & ~np.uint64(7)) | np.uint64(i))
        of.append(owners[long])
    return np.concatenate(keys), np.concatenate(of)


def _patterns(texts: Texts) -> np.ndarray:
    """Votes of the fixed list and of writing patterns."""
    found = find_words(texts, NOT_LETTERS)
    n = len(texts)
    hashes = hash_spans(texts.buffer, found.starts, found.ends, lower=True)
    insult = np.bincount(found.owners(), np.isin(hashes, _INSULT_HASHES), n) > 0
    size = np.maximum(np.diff(texts.bounds), 1)
    owners = np.repeat(np.arange(n), np.diff(texts.bounds))
    marks = np.bincount(owners, texts.buffer == 33, n) > 0.01 * size
    loud = np.bincount(owners, (texts.buffer >= 65) & (texts.buffer <= 90), n) > 0.3 * size
    return np.stack([insult, marks, loud], axis=1)


def _hashes_of(words: tuple[str, ...]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return hash_spans(data, np.concatenate(([0], ends[:-1])), ends, lower=True)


_INSULT_HASHES = _hashes_of(INSULTS)


@dataclass(frozen=True)
class Lexicon:
    """Chosen terms in ascending order, with a bitmap of their upper bits that rules most others out."""

    terms: np.ndarray
    bitmap: np.ndarray

    @classmethod
    def of(cls, terms: np.ndarray) -> Lexicon:
        terms = np.unique(terms)
        bitmap = np.zeros(1 << 20, bool)
        bitmap[(terms >> np.uint64(44)).astype(np.int64)] = True
        return cls(terms, bitmap)

    def hits(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of a text and a place in ``terms``."""
        keys, owners = _terms(texts)
        near = np.flatnonzero(self.bitmap[(keys >> np.uint64(44)).astype(np.int64)])
        keys, owners = keys[near], owners[near]
        at = np.searchsorted(self.terms, keys)
        inside = at < len(self.terms)
        inside[inside] = self.terms[at[inside]] == keys[inside]
        pairs = np.unique(owners[inside].astype(np.int64) * len(self.terms) + at[inside])
        return pairs // max(1, len(self.terms)), pairs % max(1, len(self.terms))


@dataclass(frozen=True)
class LabelModel:
    """Votes of each voter given its parent's vote and the class; ``parent`` is -1 at the root of the tree."""

    prior: float
    parent: np.ndarray
    #: By voter, class and the parent's vote: the chance that the voter fires.
    fires: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        log = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for j, up in enumerate(self.parent):
            given = votes[:, up].astype(int) if up >= 0 else np.zeros(len(votes), int)
            p = self.fires[j][:, given].T
            log += np.where(votes[:, j, None], np.log(p), np.log(1 - p))
        odds = np.clip(log[:, 0] - log[:, 1], -500, 500)
        return 1 / (1 + np.exp(odds))

    @property
    def accuracies(self) -> np.ndarray:
        """Of each voter: the chances that it fires on the positive and stays silent on the negative class."""
        return np.stack([self.fires[:, 1].mean(axis=1), 1 - self.fires[:, 0].mean(axis=1)], axis=1)


def _tree(votes: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Parents in the maximum spanning tree of the voters' mutual information given the class."""
    n, m = votes.shape
    information = np.zeros((m, m))
    v = votes.astype(float)
    for weight in (q, 1 - q):
        total = weight.sum() + 1e-9
        one = (weight @ v) / total
        both = (v * weight[:, None]).T @ v / total
        for a in (0, 1):
            for b in (0, 1):
                pa_, pb = (one if a else 1 - one), (one if b else 1 - one)
                joint = (
                    both if a and b else one[:, None] - both if a else one[None, :] - both if b
                    else 1 - one[:, None] - one[None, :] + both
                )
                joint = np.maximum(joint, 1e-12)
                information += total / n * joint * np.log(joint / np.maximum(np.outer(pa_, pb), 1e-12))
    parent = np.full(m, -1)
    best, link, inside = np.full(m, -np.inf), np.full(m, -1), np.zeros(m, bool)
    best[0] = 0
    for _ in range(m):
        j = int(np.argmax(np.where(inside, -np.inf, best)))
        inside[j], parent[j] = True, link[j]
        better = ~inside & (information[j] > best)
        best[better], link[better] = information[j][better], j
    return parent


def fit_label_model(votes: np.ndarray, given: np.ndarray, settings: Settings) -> tuple[LabelModel, np.ndarray]:
    """Expectation-maximisation on votes; also the posteriors of the rows.

    The given labels are the first guess and stay a voter outside the tree whose
    reliability is not re-estimated. It holds the classes to their meaning, since
    votes alone would also be explained by the language or the length of a text.
    """
    negative, positive = settings.label_says
    evidence = np.where(given, np.log(positive / negative), np.log((1 - positive) / (1 - negative)))

    def judged(model: LabelModel) -> np.ndarray:
        p = np.clip(model.posterior(votes), 1e-12, 1 - 1e-12)
        return 1 / (1 + np.exp(-np.clip(np.log(p / (1 - p)) + evidence, -500, 500)))

    q = np.where(given, positive, negative)
    parent = _tree(votes, q)
    m = votes.shape[1]
    model = LabelModel(0.5, parent, np.full((m, 2, 2), 0.5))
    for _ in range(settings.rounds):
        fires = np.zeros((m, 2, 2))
        for j, up in enumerate(parent):
            for c, weight in enumerate((1 - q, q)):
                for given in (0, 1):
                    rows = weight * (votes[:, up] == given) if up >= 0 else weight
                    fires[j, c, given] = (rows @ votes[:, j] + 0.1) / (rows.sum() + 0.2)
        model = LabelModel(float(np.clip(q.mean(), 1e-3, 1 - 1e-3)), parent, np.clip(fires, 1e-4, 1 - 1e-4))
        new = judged(model)
        moved = float(np.abs(new - q).max()) if len(q) else 0.0
        q = new
        if moved < 1e-5:
            break
    return model, q


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    #: Weights of the terms, then of the pattern votes.
    weights: np.ndarray
    bias: float
    label_model: LabelModel | None


def _sample_terms(texts: pa.Array) -> pa.Array:
    """Distinct terms of each text."""
    flat, lengths = [], []
    for part in steps(texts):
        keys, owners = _terms(part)
        order = np.lexsort((keys, owners))
        keys, owners = keys[order], owners[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
        flat.append(keys[new])
        lengths.append(np.bincount(owners[new], minlength=len(part)))
    offsets = np.concatenate(([0], np.cumsum(np.concatenate(lengths)))) if lengths else np.zeros(1, np.int64)
    values = np.concatenate(flat).view(np.int64) if flat else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def _chosen(sample: DataFrame, settings: Settings, size: tuple[int, int]) -> list[int]:
    """Terms that stand out in the positive texts of the sample; the surest, if too many."""
    positive, negative = size
    terms = F.arrow_udf(_sample_terms, "array<bigint>")
    counts = (
        sample.select("toxic", F.explode(terms("text")).alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b"))
    )
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (positive + 1 - a)) - F.log(b / (negative + 1 - b))
    # The odds must be this high even two standard errors lower, so rare terms need clean counts.
    least = odds - 2 * F.sqrt(1 / a + 1 / b)
    picked = counts.select("term", least.alias("g")).where(F.col("g") >= math.log(settings.odds))
    top = picked.orderBy(F.desc("g"), "term").limit(settings.terms).select("term")
    return [r[0] for r in top.collect()]


def fit(documents: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    """Fit on ``documents`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``), null labels left out.

    The sample of labels is bounded by ``texts_per_label``, so its ids may be broadcast. A
    document with several labels takes the highest, and an id with several texts stands for one of them, the same in every run. Without a positive or a negative text
    only the fixed list and patterns vote, and the score is the share of the positive label.
    """
    settings = settings or Settings()
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic")
    )
    sizes = dict(known.groupBy("toxic").count().collect())
    rate = (sizes.get(1, 0) + 0.5) / (sum(sizes.values()) + 1)
    chosen = balanced_sample(known, F.col("doc_id"), "toxic", settings.texts_per_label, "toxicity")
    chosen = chosen.select("doc_id", "toxic")
    labelled = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    # Read three times, and bounded: documents are scanned for it once.
    sample = cut_lineage(labelled.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text")))
    drawn = dict(sample.groupBy("toxic").count().collect())
    positive, negative = drawn.get(1, 0), drawn.get(0, 0)
    picked = _chosen(sample, settings, (positive, negative)) if positive and negative else []
    lexicon = Lexicon.of(np.array(picked, np.int64).view(np.uint64))
    blank = Model(lexicon, np.zeros(len(lexicon.terms) + 3), float(np.log(rate / (1 - rate))), None)
    if not positive or not negative:
        return blank

    @F.arrow_udf("struct<hits:array<int>,votes:array<boolean>>")
    def features(texts: pa.Array) -> pa.Array:
        hits, lengths, votes = [], [], []
        for part in steps(texts):
            owner, at = lexicon.hits(part)
            hits.append(at)
            lengths.append(np.bincount(owner, minlength=len(part)))
            votes.append(_patterns(part))
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(lengths)))) if lengths else np.zeros(1, np.int64)
        found = pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), pa.array(np.concatenate(hits) if hits else [], pa.int32())
        )
        flat = np.concatenate(votes).ravel() if votes else np.zeros(0, bool)
        marks = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, 3), pa.int32()), pa.array(flat))
        return pa.StructArray.from_arrays([found, marks], ["hits", "votes"])

    rows = sample.select("doc_id", "toxic", features("text").alias("f")).select("doc_id", "toxic", "f.*").toArrow()
    rows = rows.sort_by([("doc_id", "ascending")])
    x = np.zeros((len(rows), len(lexicon.terms)), np.float32)
    for i, at in enumerate(rows["hits"].combine_chunks()):
        x[i, at.values.to_numpy()] = 1
    marks = np.array(rows["votes"].to_pylist(), bool).reshape(-1, 3)
    # Every lexicon gets an arbitrary share of the terms, so none stands for one language or one kind.
    group = (mix(lexicon.terms) % np.uint64(settings.lexicons)).astype(int)
    voters = [marks[:, i] for i in range(3)]
    voters += [x[:, group == g].any(axis=1) for g in range(settings.lexicons) if (group == g).any()]
    given = rows["toxic"].to_numpy() > 0
    label_model, target = fit_label_model(np.stack(voters, axis=1), given, settings)

    full = np.concatenate((x, marks), axis=1).astype(np.float64)
    weights, bias = np.zeros(full.shape[1]), 0.0
    momentum, spread = np.zeros(full.shape[1] + 1), np.zeros(full.shape[1] + 1)
    for step in range(1, settings.epochs + 1):
        slope = 1 / (1 + np.exp(-(full @ weights + bias))) - target
        grad = np.append(full.T @ slope / len(full) + 1e-4 * weights, slope.mean())
        momentum = 0.9 * momentum + 0.1 * grad
        spread = 0.99 * spread + 0.01 * grad * grad
        move = 0.05 * (momentum / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - float(move[-1])
    # The sample is balanced; the bias goes back to the labels' own share.
    share = positive / (positive + negative)
    return Model(lexicon, weights, bias + float(np.log(rate / (1 - rate)) - np.log(share / (1 - share))), label_model)


def score(text: Column, model: Model) -> Column:
    """Chance of label 1 for each whole text; a null text counts as empty, and an empty one has no term."""

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        out = []
        size = len(model.lexicon.terms)
        for part in steps(texts):
            owner, at = model.lexicon.hits(part)
            z = np.bincount(owner, model.weights[:size][at], len(part)) + _patterns(part) @ model.weights[size:]
            out.append(1 / (1 + np.exp(-np.clip(z + model.bias, -500, 500))))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return of(text)
