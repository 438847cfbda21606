"""Repairs of conversations against every possible repair, and against the given SQL."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from sitelode.llm import conversations
from sitelode.llm.oracle import ORACLE
from sitelode.llm.queries import op12_conversations

TURNS = "conv_id bigint, turn bigint, role string, text string"


def every_repair(codes):
    """Cost and audit of all edit sequences with at most two inserts anywhere, least first."""
    good = []
    gaps = [range(3)] * (len(codes) + 1)
    for inserts in itertools.product(*gaps):
        if sum(inserts) > 2:
            continue
        for choice in itertools.product("KRD", repeat=len(codes)):
            audit, cost, shape = "", 0, ""
            for at in range(len(codes) + 1):
                for _ in range(inserts[at]):
                    shape += "a" if shape.endswith("u") else "u"
                    audit, cost = audit + "I", cost + 5
                if at < len(codes):
                    initial, fault = codes[at]
                    audit += choice[at]
                    cost += {"K": 0, "R": 1, "D": 2}[choice[at]]
                    if choice[at] != "D":
                        cost += 1000 if fault == "d" else 5 * (fault == "t")
                        shape += initial if choice[at] == "K" else "a" if shape.endswith("u") else "u"
            body = shape[shape.startswith("s") :]
            if shape == "" or (body and body == "ua" * (len(body) // 2)):
                good.append((cost, audit))
    return min(good)


def test_search_finds_the_least_of_all_repairs():
    rng = random.Random(5)
    for _ in range(150):
        codes = [rng.choice("suaaxu") + rng.choice("kkkktd") for _ in range(rng.randrange(5))]
        assert conversations.cheapest("".join(codes)) == every_repair(codes), codes


def test_segments_join_to_the_search_over_all_rows():
    rng = random.Random(6)
    for _ in range(120):
        codes = [rng.choice("suaau") + rng.choice("kkkktd") for _ in range(rng.randrange(1, 40))]
        cuts = sorted({0, len(codes), *(rng.randrange(len(codes)) for _ in range(3))})
        whole = None
        for a, b in itertools.pairwise(cuts):
            part = conversations.summary("".join(codes[a:b]))
            whole = part if whole is None else conversations.join(whole, part)
        assert conversations._close(whole) == conversations.cheapest("".join(codes))


@pytest.fixture(scope="module")
def hostile():
    rng = random.Random(7)
    roles = ["system", "user", "assistant", "user", "assistant", None, "", "tool", "User", "unknown"]
    texts = ["Hello there.", "Why?", "no end", "", None, "  \n\t", "Same.", "Ends!  \n", "line\nof text.", "éß \U0001f600.", " "]
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, None if rng.random() < 0.05 else turn + rng.choice([0, 0, 0, 3]), rng.choice(roles), rng.choice(texts)))
    rows += [(None, i % 40, rng.choice(roles[:5]), f"Hot {i % 70}.") for i in range(150)]
    rows += [(9999, None, "user", "All null."), (9999, None, "user", "All null.")]
    # Longer than a segment, with places for inserts at the seams.
    rows += [(500, i, ("user", "assistant")[i % 2] if i % 97 else "assistant", f"Turn {i if i % 11 else 0}" + "." * (i % 13 > 0)) for i in range(700)]
    return rows


def test_damaged_tables_equal_the_given_sql(spark, hostile, table_dir, monkeypatch):
    import duckdb

    monkeypatch.setattr(conversations, "JOINED", 2)
    table = spark.createDataFrame(hostile, TURNS).repartition(5)
    for name in ("conv", "pos", "fault", "seg", "line", "said", "audit", "cost"):
        table = table.withColumn(name, F.lit("x"))
    place = table_dir(conversations=table)
    got = op12_conversations(spark, place)
    base = duckdb.connect()
    base.execute(f"create view conversations as select * from '{place}/conversations.parquet/*.parquet'")
    want = base.sql(ORACLE["op12_conversations"])
    order = [want.columns.index(c) for c in got.columns]
    told = sorted(map(repr, map(tuple, got.collect())))
    assert told == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())
    assert len(told) == 153


def test_repaired_rows_keep_their_texts_and_alternate(spark):
    turns = [("c", 0, "system", "Be kind."), ("c", 1, "assistant", "Hi."), ("c", 2, "assistant", "Yes."), ("c", 3, "assistant", "Yes."), ("d", 0, "user", "")]
    repaired = conversations.repair(spark.createDataFrame(turns, "conv string, turn bigint, role string, text string"))
    lines = [tuple(r) for r in repaired.lines.orderBy("conv", "line").collect()]
    assert lines == [("c", 0, "system", "Be kind."), ("c", 1, "user", "Hi."), ("c", 2, "assistant", "Yes.")]
    facts = {r.conv: r.asDict() for r in repaired.summary.collect()}
    assert (facts["c"]["audit"], facts["c"]["cost"], facts["c"]["duplicate"], facts["c"]["illegal"]) == ("KRKD", 3, 1, 3)
    assert (facts["d"]["audit"], facts["d"]["cost"], facts["d"]["blank"], facts["d"]["gaps"]) == ("D", 2, 1, 0)


def test_an_empty_table(spark, table_dir):
    place = table_dir(conversations=spark.createDataFrame([], TURNS))
    assert op12_conversations(spark, place).collect() == []
