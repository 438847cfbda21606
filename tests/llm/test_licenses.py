"""Licence scans against every block compared with every template."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sitelode.llm import licenses
from sitelode.llm.oracle import ORACLE
from sitelode.llm.queries import op13_licenses

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def by_hand(text, settings):
    words = words_of(text)
    starts, base = [], set()
    for phrase, label in settings.phrases.items():
        parts = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(parts)] == parts:
                starts.append(i)
                base.add(label)
    sets = [set(t.split()) for t, _ in settings.notices]
    best, more = 0.0, set()
    for size in set(licenses.template_sizes(settings)):
        for at in range(0, len(words), size):
            block = set(words[at : at + 2 * size])
            met = [
                i for i, own in enumerate(licenses.template_sizes(settings))
                if own == size and len(block & sets[i]) >= licenses._needed(len(sets[i]), settings.threshold)
            ]
            for i in met:
                if not any(sets[i] < sets[j] for j in met):
                    more.add(settings.notices[i][1])
                    best = max(best, len(block & sets[i]) / len(sets[i]))
    labels = ",".join(sorted(base | more))
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), labels, 1.0 if starts else best)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    notices = [t for t, _ in licenses.NOTICES]
    plain = "the of and to work any this version in license ö straße under 2 0 terms all rights".split()
    rows = [None, "", "  \n", "CC BY", "cc-by MIT License, mit license", "gnu general public", "ÄPACHE license", "gnu\x00general public license"]
    for _ in range(120):
        words = [rng.choice(plain) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            notice = rng.choice(notices).split()
            for _ in range(rng.choice([0, 0, 1, 3])):
                notice[rng.randrange(len(notice))] = rng.choice(["x", "", "THE", "nc"])
            at = rng.randrange(len(words) + 1)
            words[at:at] = notice
        rows.append(rng.choice([" ", "\n", "-- "]).join(words))
    rows.append(" ".join(rng.choice(plain) for _ in range(300_000)) + " Released under the MIT license.")
    return rows


def scanned(spark, texts, settings=None):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    rows = licenses.license_scan(table, "text", ["doc_id"], settings).collect()
    return {r.doc_id: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("threshold", [0.9, 0.6])
def test_join_finds_every_block_that_meets_a_template(spark, texts, threshold):
    settings = licenses.Settings(threshold=threshold)
    got = scanned(spark, texts, settings)
    assert got == {i: by_hand(t, settings) for i, t in enumerate(texts)}


def test_random_templates_and_classes(spark):
    rng = random.Random(11)
    letters = [chr(97 + i) for i in range(14)]
    notices = [(" ".join(rng.choices(letters, k=rng.randrange(1, 9))), f"l{i}") for i in range(12)]
    settings = licenses.Settings(threshold=0.7, classes=(2, 4), phrases={"a b": "ab", "c": "c"}, notices=notices)
    texts = [" ".join(rng.choices(letters, k=rng.randrange(25))) for _ in range(80)]
    assert scanned(spark, texts, settings) == {i: by_hand(t, settings) for i, t in enumerate(texts)}


def test_a_more_special_notice_hides_a_plainer_one(spark):
    got = scanned(spark, ["Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0.", "license MIT"])
    assert [got[i][4:] for i in range(3)] == [("cc-by", "cc-by,cc-by-nc-4.0", 1.0), ("cc-by", "cc-by,cc-by-4.0", 1.0), ("", "", 0.0)]


def test_odd_rows_empty_tables_and_the_given_sql(documents, texts, table_dir):
    import duckdb

    rows = [(i % 20, t, "en", "hot") for i, t in enumerate(texts[:-1])] + [(None, "the mit license", None, None), (3, texts[9], "en", "hot")]
    table = documents(rows, extra=True)
    for name in ("row", "labels", "blocks", "r", "_c0"):
        table = table.withColumn(name, F.lit("x"))
    place = table_dir(documents=table)
    got = op13_licenses(table.sparkSession, place)
    base = duckdb.connect()
    base.execute(f"create view documents as select * from '{place}/documents.parquet/*.parquet'")
    want = base.sql(ORACLE["op13_licenses"])
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())
    assert op13_licenses(table.sparkSession, table_dir(documents=table.limit(0))).collect() == []
