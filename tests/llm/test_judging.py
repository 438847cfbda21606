"""Quality rules, language, toxicity, language model and neighbours: brute force, or accuracy on texts held out."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from sitelode.llm import ann, language, lm, queries, toxicity
from sitelode.llm.sampling import TooManyLabels, balanced_sample

ODD = [(None, None), (900, None), (901, ""), (902, " \n "), (903, "1234 !!"), (903, "1234 !!"), (904, "é"), (905, "a\n\na\nb a")]


def crc(doc_id, folds):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen, lines = Counter(windows), set()
    inside = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 3)}
    repeated = 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in lines
            lines.add(line)
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(inside), failed


def plain_kept(text, failed):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    chars = max(1, sum(map(len, words)))
    for k, limit in {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}.items():
        runs = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
        seen = Counter(runs)
        inside = {j for i, r in enumerate(runs) if seen[r] > 1 for j in range(i, i + k)}
        if sum(len(words[j]) for j in inside) > limit * chars:
            return False
    lines, again = set(), 0
    for line in (text or "").split("\n"):
        if line in lines:
            again += sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", line)))
        lines.add(line)
    return not failed and again <= 0.20 * chars


def test_repetition_query_matches_brute_force(spark, documents, table_dir, prose):
    rng = random.Random(1)
    texts = [prose(i, rng.randrange(1, 300), rng.choice((5, 40, 4000))) for i in range(80)]
    texts += [t.replace(" ", "\n", rng.randrange(9)) + "\nw1 w2 w3\nw1 w2 w3\n" for t in texts[:40]]
    texts += ["\n".join([prose(i, 12)] * 3 + [prose(i + 99, 80)]) + "#|<é" for i in range(20)]
    rows = [*enumerate(texts), *ODD]
    got = queries.op3_repetition(spark, table_dir(documents=documents(rows, extra=True)))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert got.columns[:8] == names
    want = [(i, *c, plain_kept(t, c[5])) for i, t in rows for c in (plain_counts(t),)]
    assert sorted((tuple(r)[:8] for r in got.collect()), key=str) == sorted(want, key=str)
    assert {w[-1] for w in want} == {True, False}


def tongues(n, seed):
    syllables = {"aa": ["ka", "ro", "ti", "mun"], "bb": ["esch", "ung", "ver", "tz"], "cc": ["eau", "ille", "ré", "que"]}
    rng = random.Random(seed)
    for i in range(n):
        lang = rng.choice(list(syllables))
        yield i, " ".join("".join(rng.choices(syllables[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60))), lang


def test_languages_of_held_out_texts(spark, documents, table_dir):
    rows = list(tongues(400, 1)) + [(i, t, "aa") for i, t in ODD]
    sf_dir = table_dir(documents=documents(rows, extra=True))
    got = queries.op6_language(spark, sf_dir).collect()
    assert len(got) == len(rows)
    truth = {i: lang for i, _, lang in rows}
    held = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.held_out]
    assert len(held) > 80 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    for r in got:
        assert r.held_out == (crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1
        if r.doc_id in (None, 900, 901, 902, 903):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in ("aa", "bb", "cc")


def test_no_language_is_known_without_labels(spark, documents):
    table = documents([(1, "some text"), *ODD])
    model = language.fit(table, "text", "lang")
    assert {r[0] for r in table.select(language.predict(F.col("text"), model)["lang_pred"]).collect()} == {"und"}
    assert table.limit(0).select(language.predict(F.col("text"), model)).count() == 0


def insulting(n, seed, prose):
    rng = random.Random(seed)
    for i in range(n):
        words, toxic = prose(f"x{i}", rng.randrange(20, 200)).split(), rng.random() < 0.25
        if toxic:
            for w in rng.choices(["idiot", "Moron,", "scum.", "zorgling", "zorgles"], k=rng.randrange(2, 6)):
                words.insert(rng.randrange(len(words)), w)
        yield i, " ".join(words), int(toxic)


def test_toxicity_of_held_out_texts(spark, documents, table_dir, prose):
    rows = list(insulting(700, 2, prose))
    labels = [(i, None, t if i % 13 else 1 - t) for i, _, t in rows] + [(None, 1, 1), (5, 0, None)]
    sf_dir = table_dir(
        documents=documents([(i, t) for i, t, _ in rows] + ODD, extra=True),
        labels=spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )
    got = queries.op10_toxicity(spark, sf_dir).collect()
    assert len(got) == len(rows) + len(ODD)
    truth = {i: t for i, _, t in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    right = Counter((truth[r.doc_id], r.predicted) for r in held)
    assert right[1, 1] >= 0.9 * (right[1, 0] + right[1, 1]) and right[0, 1] <= 0.02 * right[0, 0]
    for r in got:
        assert r.held_out == (crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert r.doc_id is not None and r.doc_id in truth or r.predicted == 0


def test_toxicity_without_labels(spark, documents):
    table = documents([(1, "you idiot"), *ODD])
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.fit(table, none)
    assert table.select(toxicity.score(F.col("text"), model)).count() == len(ODD) + 1


def test_label_model_finds_accuracies_and_dependences():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.3
    fires = [(0.9, 0.05), (0.7, 0.02), (0.6, 0.1)]
    votes = np.stack([np.where(y, rng.random(4000) < a, rng.random(4000) < b) for a, b in fires], axis=1)
    copy = np.where(rng.random(4000) < 0.95, votes[:, 0], ~votes[:, 0])
    votes = np.concatenate((votes, copy[:, None]), axis=1)
    given = np.where(rng.random(4000) < 0.02, ~y, y)
    model, q = toxicity.fit_label_model(votes, given, toxicity.Settings())
    assert np.mean((q > 0.5) == y) > np.mean(given == y)
    assert model.parent[3] == 0 or model.parent[0] == 3
    assert abs(model.prior - 0.3) < 0.03


def test_lm_query_matches_brute_force(spark, documents, table_dir, prose):
    rows = [(i, prose(f"l{i % 40}", 30 + i % 50, 60).upper() if i % 5 else prose(i, 20, 60)) for i in range(200)] + ODD
    got = queries.op9_lm(spark, table_dir(documents=documents(rows, extra=True)))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert got.columns[:7] == names
    tokens = [[*(w.lower() for w in (t or "").split()), "\n"] for _, t in rows]
    train = [i for i, (d, _) in enumerate(rows) if crc(d, 7) != 2]
    count = Counter(w for i in train for w in tokens[i])
    total = sum(count.values())
    want = [
        (
            d, crc(d, 7) == 2, len(w), sum(count[x] > 0 for x in w), total,
            sum(math.log10((count[x] + 1) / (total + len(count) + 1)) for x in w),
        )
        for (d, _), w in zip(rows, tokens)
    ]
    found = sorted(got.collect(), key=lambda r: str(tuple(r)[:5]) + f"{r.base_score:.6f}")
    want.sort(key=lambda r: str(r[:5]) + f"{r[5]:.6f}")
    assert [tuple(r)[:5] for r in found] == [w[:5] for w in want]
    assert np.allclose([r.base_score for r in found], [w[5] for w in want])
    # The interpolation by plain counts, with the weights that the operator learned.
    levels, cells = lm.Settings().levels, []
    own = [i for i in train if crc(rows[i][0], 7) == 3]
    fixed = [i for i in train if i not in own]
    counted = Counter(w for i in fixed for w in tokens[i])
    pairs = Counter(p for i in fixed for p in zip(["\n", *tokens[i]], tokens[i]))
    n, v, r = sum(counted.values()), len(counted), lm.Settings().resolution
    level = lambda c: min(levels, int(math.log2(c)) + 1) if c else 0
    step = lambda x: round(r * math.log2(x * (v + 1))) if x else -1000
    for i in own:
        for h, w in zip(["\n", *tokens[i]], tokens[i]):
            c = counted[h]
            cells.append((level(c), step(pairs[h, w] / c if c else 0), step(counted[w] / n)))
    table = Counter(cells)
    weights = lm.learn_weights(np.array([(*k, m) for k, m in table.items()]), lm.Settings())
    all_pairs = Counter(p for i in train for p in zip(["\n", *tokens[i]], tokens[i]))

    def plain(words):
        out = 0.0
        for h, w in zip(["\n", *words], words):
            a, b, d = weights[level(count[h])]
            out += math.log10(a * (all_pairs[h, w] / count[h] if count[h] else 0) + b * count[w] / total + d / (len(count) + 1))
        return out

    assert np.allclose(sorted(r.score for r in found), sorted(map(plain, tokens)), rtol=1e-6)
    held = [r for r in found if r.held_out and r.doc_id < 200]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_of_small_blocks_and_no_rows(spark, documents, prose):
    table = documents([(i, prose(i, 50, 30)) for i in range(30)])
    role = F.when(F.col("doc_id") % 3 == 0, lm.HELD_OUT).when(F.col("doc_id") % 3 == 1, lm.DELETED).otherwise(lm.COUNTED)
    runs = []
    for size in (64, 1 << 20):
        rows = lm.score(table, "doc_id", "text", role, lm.Settings(block_tokens=size)).collect()
        runs.append(sorted((r.doc_id, round(r.score, 6), round(r.base_score, 6)) for r in rows))
    assert runs[0] == runs[1] and len(runs[0]) == 30
    assert lm.score(table.limit(0), "doc_id", "text", role).count() == 0
    alone = lm.score(table.limit(1), "doc_id", "text", F.lit(lm.HELD_OUT)).first()
    assert alone.n_known == 0 and math.isfinite(alone.score)


def test_neighbours_against_brute_force(spark, table_dir):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 24))
    vectors = [(i, (centres[i % 8] + 0.3 * rng.normal(size=24)).tolist()) for i in range(1500)]
    vectors += [(2000 + i, vectors[3][1]) for i in range(40)]
    vectors += [(3000, None), (3100, [0.0] * 24), (3200, [None] * 24), (3300, [float("nan")] * 24), (3400, [1.0]), (None, vectors[0][1])]
    table = spark.createDataFrame([(*v, "x") for v in vectors], "vec_id bigint, embedding array<float>, score string")
    got = queries.op5_neighbours(spark, table_dir(embeddings=table.repartition(3))).collect()
    kept = [(i, np.array(v, np.float32).astype(float)) for i, v in vectors[:1540]]
    ids, data = np.array([i for i, _ in kept]), np.stack([v for _, v in kept])
    hits = wanted = 0
    asked = [i for i in ids if i % 100 == 0]
    assert {r.query_id for r in got} == set(asked)
    for q in asked:
        d = np.sqrt(((data - data[ids == q][0]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        best = set(ids[np.lexsort((ids, d))[:10]].tolist())
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert [(s, v) for _, v, s in own] == sorted((s, v) for _, v, s in own)
        assert all(abs(s - d[ids == v][0]) < 1e-12 for _, v, s in own)
        hits += len(best & {v for _, v, _ in own})
        wanted += 10
    assert hits >= 0.9 * wanted


def test_few_neighbours_and_small_blocks(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0])], "vec_id int, embedding array<double>")
    rows = ann.nearest(table, F.col("vec_id") == 0, 10, settings=ann.Settings(block_rows=2)).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in rows] == [(2, 0.0), (2, 0.0), (1, math.sqrt(2))]
    assert ann.nearest(table.limit(0), F.col("vec_id") == 0).count() == 0
    assert ann.nearest(table, F.col("vec_id") == 77).count() == 0


def test_sample_holds_every_label(spark):
    rows = spark.createDataFrame([(i, f"l{i % 300}") for i in range(600)] + [(1000, "once")], "id bigint, label string")
    assert balanced_sample(rows, F.col("id"), "label", 5, "x").select("label").distinct().count() == 301


def test_one_id_or_one_text_neither_empties_nor_swells_a_sample(spark):
    # One id on all rows; another text on every row, or the same on half of them.
    rows = spark.range(4000).select(
        F.lit(7).alias("id"), F.when(F.col("id") < 2000, F.concat(F.lit("t"), "id")).otherwise("same").alias("text"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("label"),
    )
    for seed in ("language", "toxicity", "x"):
        drawn = balanced_sample(rows, F.col("text"), "label", 200, seed).groupBy("label").count().collect()
        assert {r.label for r in drawn} == {"a", "b"} and all(120 < r["count"] < 280 for r in drawn), drawn
        hot = balanced_sample(rows, F.col("id"), "label", 200, seed).groupBy("label").count().collect()
        assert {tuple(r) for r in hot} == {("a", 1), ("b", 1)}
    nulls = rows.withColumn("label", F.lit(None).cast("string"))
    assert balanced_sample(nulls, F.col("text"), "label", 200, "x").count() == 0
    several = balanced_sample(rows, F.col("text"), "label", 10**6, "x", max_rows=400).count()
    assert 280 < several < 520
    with pytest.raises(TooManyLabels):
        balanced_sample(rows, F.col("text"), "text", 5, "x", max_labels=100)


def test_models_are_learned_from_rows_of_one_id(spark, documents, prose):
    table = documents([(None if i % 2 else 3, t, lang) for i, t, lang in tongues(400, 1)])
    model = language.fit(table, "text", "lang")
    assert model.languages == ("aa", "bb", "cc")
    texts = list(insulting(300, 4, prose))
    # One labelled id stands on a thousand rows: one text counts for it, the same in every run.
    many = documents([(i, t) for i, t, _ in texts] + [(2, f"you are a fool {i}") for i in range(1000)])
    labels = spark.createDataFrame([(i, y) for i, _, y in texts], "doc_id bigint, toxic int")
    first, again = (toxicity.fit(many, labels) for _ in range(2))
    assert first.bias == again.bias and (first.weights == again.weights).all()
