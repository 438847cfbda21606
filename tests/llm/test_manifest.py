"""The manifest against a tree built on one list, for several shapes and for rows that are odd."""

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from sitelode.llm import manifest
from sitelode.llm.oracle import ORACLE
from sitelode.llm.queries import op11_manifest

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row):
    return digest("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def whole_tree(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return levels


def path(levels, place, fanout):
    steps = []
    for level in levels[:-1]:
        first = place // fanout * fanout
        steps.append(("".join(level[first:place]), "".join(level[place + 1 : first + fanout])))
        place //= fanout
    return steps


def expected(rows, fanout):
    groups = {}
    for row in rows:
        groups.setdefault(row.source, []).append((row.doc_id is not None, row.doc_id or 0, leaf_of(row), row.doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {name: whole_tree([m[2] for m in sorted(groups[name], key=lambda m: m[:3])], fanout) for name in names}
    top = whole_tree([trees[name][-1][0] for name in names], fanout)
    out = []
    for at, name in enumerate(names):
        for place, member in enumerate(sorted(groups[name], key=lambda m: m[:3])):
            steps = path(trees[name], place, fanout) + path(top, at, fanout)
            out.append((member[3], name, member[2], trees[name][-1][0], top[-1][0], steps))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shape", [manifest.Shape(3, 1), manifest.Shape(2, 1), manifest.Shape(3, 2), manifest.Shape()])
def test_every_proof_is_that_of_the_whole_tree(documents, shape):
    rows = [(i, f"text {i}\nof {i % 7}", "en", "hot") for i in range(83)]
    rows += [(i, None, None, f"s{i % 11}") for i in range(100, 139)]
    rows += [(None, "x", "en", "hot"), (5, "text 5\nof 5", "en", "hot"), (5, "other", "en", None), (900, "", "é", "ß"), (901, "é" * 9, "en", "lone")]
    table = documents(rows, extra=True)
    got = manifest.manifest(table, "doc_id", "source", FIELDS, shape=shape).collect()
    told = sorted(
        ((r.doc_id, r.source, r.leaf, r.subroot, r.root, [(p.left, p.right) for p in r.proof]) for r in got), key=repr
    )
    assert told == expected(table.collect(), shape.fanout)


def test_blocks_meet_in_lanes_of_at_most_the_fanout(spark):
    for blocks in (2, 4, 10, 28, 29):
        state = spark.range(blocks).select(
            F.lit("g").alias("group"), F.col("id").alias("block"), F.lit(blocks).cast("bigint").alias("blocks"),
            F.concat(F.lit("n"), "id").alias("node"), F.array().cast("array<struct<left:string,right:string>>").alias("proof"),
        )
        round_ = 0
        while 3**round_ < blocks:
            state = manifest._exchange(state, round_, manifest.Shape(3, 1))
            round_ += 1
        rows = state.collect()
        assert sorted(r.block for r in rows) == list(range(blocks))
        assert {r.node for r in rows} == {whole_tree([f"n{i}" for i in range(blocks)], 3)[-1][0]}


def test_a_proof_refuses_any_other_leaf(documents):
    table = documents([(i, f"a\nb {i}", "en", "s") for i in range(10)])
    proven = manifest.manifest(table, "doc_id", "source", FIELDS)
    right, wrong = proven.select(
        F.count_if(manifest.folded(F.col("leaf"), F.col("proof")) == F.col("root")),
        F.count_if(manifest.folded(manifest.digest(F.lit("x")), F.col("proof")) == F.col("root")),
    ).first()
    assert (right, wrong) == (10, 0)


def test_empty_tables_and_the_given_sql(documents, table_dir):
    import duckdb

    spark = documents([(0, "a", "en", "s")]).sparkSession
    empty = table_dir(documents=documents([(0, "a", "en", "s")]).limit(0))
    assert op11_manifest(spark, empty).collect() == []
    rows = [(i, "line\n" * (i % 3) + str(i), None if i % 5 else "en", None if i % 4 == 0 else f"s{i % 6}") for i in range(60)]
    place = table_dir(documents=documents([*rows, (None, None, None, None), (3, None, "de", "s3")], extra=True))
    got = op11_manifest(spark, place)
    base = duckdb.connect()
    base.execute(f"create view documents as select * from '{place}/documents.parquet/*.parquet'")
    want = base.sql(ORACLE["op11_manifest"])
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())
