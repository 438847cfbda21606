"""The pipeline's stages, each on what the one before kept, against brute force on planted cases."""

import random
import re
from collections import defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from .test_copies import survivors

STAGES = dict(corpus_pipeline.STAGES)
ODD = [(None, "null id here", None, None), (5000, None, "en", "b"), (5001, "", "en", None), (5002, "one", None, "b"), (5002, "one", None, "b")]


@pytest.fixture(scope="module")
def planted(documents, table_dir, prose, spark):
    rng = random.Random(9)
    rows, toxic = [], set()
    for i in range(500):
        words = prose(f"d{i}", rng.randrange(60, 200)).split()
        if i % 5 == 0:
            toxic.add(i)
            for w in rng.choices(["idiot", "moron", "scum", "zorgling"], k=4):
                words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words), "en", f"s{i % 4}"))
    clean = [r for r in rows if r[0] not in toxic]
    copies = [(600 + i, r[1], "en", "s9") for i, r in enumerate(clean[:20])]
    near = [(700 + i, r[1] + " tail", "en", "s9") for i, r in enumerate(clean[20:40])]
    passage = prose("shared passage", 70)
    holders = [(800 + i, f"{prose(f'a{i}', 90)} {passage} {prose(f'b{i}', 90)}", "en", "s1") for i in range(8)]
    every = rows + copies + near + holders + ODD
    place = table_dir(
        documents=documents(every),
        labels=spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(500)], "doc_id bigint, quality int, toxic int"),
    )
    return place, every, toxic, passage


def stage(spark, name, docs, place):
    return STAGES[name](spark, docs, place)


def test_toxic_documents_go_and_clean_ones_stay(spark, planted):
    place, rows, toxic, _ = planted
    docs = spark.read.parquet(f"{place}/documents.parquet")
    kept = stage(spark, "toxicity", docs, place)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(toxic & set(ids)) <= 0.1 * len(toxic)
    want = [r[0] for r in rows if r[0] not in toxic]
    assert len([i for i in ids if i not in toxic]) >= 0.99 * len(want)


def test_one_of_each_group_stays(spark, planted):
    place, rows, _, _ = planted
    docs = spark.read.parquet(f"{place}/documents.parquet")
    kept = stage(spark, "simhash", docs, place)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    want = survivors([r[:2] for r in rows])
    assert sorted((i is None, i or 0) for i in ids) == want
    assert not {i for i in ids if i is not None and 600 <= i < 700}


def test_passages_stay_once(spark, planted):
    place, rows, _, passage = planted
    docs = spark.read.parquet(f"{place}/documents.parquet").where("doc_id < 500 or doc_id >= 800 or doc_id is null")
    left = stage(spark, "suffix_dedup", docs, place)
    assert left.columns == docs.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    assert sum(passage in (t or "") for t in texts.values()) == 1
    before = {r[0]: r[1] for r in rows}
    assert all(texts[i] == before[i] for i in texts if i is not None and i < 500)


def test_mix_and_packing_lose_nothing(spark, planted):
    place, rows, _, _ = planted
    docs = spark.read.parquet(f"{place}/documents.parquet")
    mixed = stage(spark, "mixing", docs, place)
    assert mixed.columns == docs.columns
    words = re.compile(r"[^\x20\x09-\x0D]+")
    size, taken = defaultdict(int), 0
    for r in rows:
        size[r[3]] += len(words.findall(r[1] or ""))
    for r in mixed.collect():
        taken += len(words.findall(r.text))
        assert r.n_chars == len(r.text)
    assert abs(taken - 1.5 * sum(size.values())) <= 256 * len(size)
    packed = stage(spark, "packing", mixed, place)
    assert packed.select("doc_id", "row").distinct().count() == mixed.select("doc_id", "text").distinct().count()
    full = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert full.where("n > 4096 or n <> end").count() == 0


def test_whole_run_and_empty_tables(spark, planted, documents, table_dir):
    place, rows, toxic, _ = planted
    packed = corpus_pipeline.run(spark, place)
    ids = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    assert len(ids & toxic) <= 0.1 * len(toxic) and not {600, 601, 602} <= ids
    nothing = table_dir(documents=documents([]), labels=spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert corpus_pipeline.run(spark, nothing).count() == 0
