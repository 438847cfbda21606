"""Packing, mixing and sharding: whole results, exact sizes, reruns."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sitelode.llm import mixing, packing, queries, sharding
from sitelode.llm.tokens import Encoder
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    (None, None, None, None), (1, "", None, "b"), (2, " \n", None, None), (3, "one", None, "é"), (3, "one", None, "é"),
    (4, "Don't <|endoftext|> <|ENDOFTEXT|> a—. b…, it's İstanbul éa x y 12a 😀 ﬁ", None, "a"),
]


@pytest.fixture(scope="module")
def sf_dir(documents, table_dir, prose):
    rng = random.Random(4)
    rows = [(10 + i, prose(i, int(rng.lognormvariate(5, 1)) + 1), None, "hot" if i % 3 else f"s{i % 5}") for i in range(150)]
    rows += [(500, prose("long", 9000), None, "hot"), (501, prose("long", 9000), None, "s1"), *ODD]
    table = documents(rows, extra=True)
    place = table_dir(documents=table, embeddings=table.limit(0))
    return place, rows


def test_words_encoded_once_give_the_tokenizer_s_ids(sf_dir):
    texts = [r[1] for r in sf_dir[1]]
    encoder = Encoder(PATH, kept_words=50)
    got = [ids[a:b].tolist() for ids, bounds in encoder.batches(pa.array(texts)) for a, b in zip(bounds, bounds[1:])]
    got += [ids[a:b].tolist() for ids, bounds in encoder.batches(pa.array(texts)) for a, b in zip(bounds, bounds[1:])]
    plain = Tokenizer.from_file(PATH)
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert got == want + want


def test_every_piece_is_placed_once_without_gaps(spark, sf_dir):
    place, rows = sf_dir
    got = queries.op1_packing(spark, place).collect()
    plain = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text, *_ in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        for i, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want.append((doc_id, i, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == Counter(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 4096
    assert len(sequences) <= -(-sum(r.length for r in got) // 4096) + 1


@pytest.mark.parametrize("seed", range(4))
def test_plans_use_every_piece_and_waste_little(seed):
    rng = random.Random(seed)
    counts = Counter(min(100, int(rng.lognormvariate(3, 1)) + 1) for _ in range(500))
    runs = packing.plan(dict(counts), 100)
    used, filled = Counter(), defaultdict(list)
    for r in runs:
        used[r.length] += r.count
        for i in range(r.count):
            filled[r.sequence + i].append((r.offset, r.length))
    assert used == counts
    for parts in filled.values():
        parts.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and parts[0][0] == 0
        assert sum(n for _, n in parts) <= 100
    assert len(filled) <= -(-sum(n * c for n, c in counts.items()) // 100) + 2


def test_exact_complements_leave_no_waste():
    counts = {60: 4, 40: 4, 50: 2, 30: 3, 20: 6, 25: 4, 45: 1, 15: 1, 10: 3}
    total = sum(n * c for n, c in counts.items())
    assert max(r.sequence + r.count for r in packing.plan(counts, 100)) == -(-total // 100)
    assert packing.plan({}, 100) == []


def test_sums_are_indexed_whole_and_pairs_are_counted_as_they_go():
    rng = random.Random(6)
    lengths = rng.sample(range(1, 61), 25)
    sums = packing._Sums(lengths, 60)
    available = np.zeros(61, bool)
    available[lengths] = True
    for gone in [None, *lengths[:10]]:
        if gone is not None:
            sums.use_up(gone, available)
            available[gone] = False
        for total in range(61):
            pairs = [(a, total - a) for a in sorted(lengths, reverse=True) if total - a in lengths and 2 * a >= total]
            triples = {x for x in lengths for a in lengths if a <= x and total - x - a in lengths and total - x - a <= a}
            assert sums.pairs(total).tolist() == [a for a, _ in pairs]
            assert sums.triples(total).tolist() == sorted(triples, reverse=True)
            assert sums.alive[total] == sum(bool(available[a] and available[b]) for a, b in pairs)


def test_no_exact_combination_of_up_to_four_is_left():
    rng = random.Random(7)
    for _ in range(20):
        counts = {n: rng.randrange(1, 4) for n in rng.sample(range(1, 41), 15)}
        made = packing._Plan(counts, 40)
        made.exact()
        rest = [n for n, c in made.left.items() for _ in range(c)]
        for size in (1, 2, 3, 4):
            assert not any(sum(parts) == 40 for parts in combinations(rest, size))


def test_packing_rejects_bad_lengths_and_takes_empty_tables(spark):
    table = spark.createDataFrame([(1, 5)], "id int, length bigint")
    with pytest.raises(ValueError, match="between 1 and 4"):
        packing.pack(table, 4)
    assert packing.pack(table.limit(0), 4).count() == 0
    kept = packing.pack(table.withColumn("offset", F.lit("x")), 8).collect()
    assert [tuple(r) for r in kept] == [(1, 5, 0, 0)]


def test_targets_share_what_a_source_cannot_give():
    settings = mixing.Settings()
    got = mixing.targets([("b", 100), (None, 10), ("a", 10), ("c", 1000)], settings)
    # Weights 5, 2, 1, 5 for a, b, c and null; a and null stop at twice their size.
    assert got["a"] == 20 and got[None] == 20
    left = 1.5 * 1120 - 40
    assert got["b"] == 200 and got["c"] == pytest.approx(left - 200)
    assert mixing.targets([], settings) == {}


def test_permutation_is_one():
    for size in (1, 2, 7, 64, 1000):
        index = np.arange(size)
        out = mixing.permute(index, np.full(size, size), np.full(size, 99))
        assert sorted(out.tolist()) == index.tolist()
    assert (out != index).mean() > 0.9


def test_drawn_shards_add_up():
    drawn = mixing.draw_shards([1000, 0, 7, 30000], mixing.Settings(shards=16))
    assert drawn.sum(axis=0).tolist() == [1000, 0, 7, 30000]
    assert set(drawn.sum(axis=1).tolist()) <= {31007 // 16, 31007 // 16 + 1}
    assert mixing.draw_shards([0], mixing.Settings()).sum() == 0


def test_mix_meets_targets(spark, sf_dir):
    place, rows = sf_dir
    got = queries.op2_mixing(spark, place)
    assert sorted(map(str, got.collect())) == sorted(map(str, queries.op2_mixing(spark, place).collect()))
    names = ["doc_id", "size", "source_size", "target", "taken"]
    assert got.columns[:5] == names
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    source = {r[0]: r[3] for r in rows}
    for r in got.collect():
        s = source[r.doc_id]
        sizes[s] += r.size
        taken[s] += r.taken
        targets[s] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert Counter((r.doc_id, r.size) for r in got.collect()) == Counter((r[0], len((r[1] or "").encode().split())) for r in rows)
    assert targets == pytest.approx(mixing.targets(list(sizes.items()), mixing.Settings()))
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 64 + 0.001 * targets[s]


def test_mixed_documents_hold_what_was_taken(spark, sf_dir):
    place, rows = sf_dir
    table = spark.read.parquet(f"{place}/documents.parquet")
    mixed = mixing.mixed_documents(table)
    assert mixed.columns == table.columns
    words = Counter()
    whole = {r[0]: (r[1] or "") for r in rows}
    for r in mixed.collect():
        assert r.text in whole[r.doc_id]
        words[r.doc_id] += len(r.text.encode().split())
    want = Counter()
    for r in queries.op2_mixing(spark, place).collect():
        want[r.doc_id] += r.taken
    assert words == +want
    assert mixing.mixed_documents(table.limit(0)).count() == 0
    assert mixing.taken_words(mixing.mix_sources(table.where("doc_id = 1"))).first().taken == 0


def test_equal_rows_of_two_sources_give_what_each_source_owes(spark, documents):
    text = " ".join(f"w{i}" for i in range(2000))
    rows = [(1, text, "en", "x"), (1, text, "en", "y"), (1, text, "en", None), (2, text, "en", "x"), (2, text, "en", "x")]
    table = documents(rows)
    settings = mixing.Settings(block=50)
    owed = {r.source_size: r.target for r in mixing.mix_sources(table, settings=settings).sources.collect()}
    mixed = mixing.mixed_documents(table, settings=settings).collect()
    got = Counter()
    for r in mixed:
        got[r.source] += len(r.text.split())
    want = mixing.targets([("x", 6000), ("y", 2000), (None, 2000)], settings)
    assert owed and all(abs(got[s] - want[s]) <= 50 for s in want), (got, want)


def test_shards_are_exact_and_whole(spark, sf_dir):
    place, rows = sf_dir
    got = queries.op4_sharding(spark, place).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({len(s) for s in slots.values()}) <= 2
    table = spark.read.parquet(f"{place}/documents.parquet")
    few = sharding.shuffle_to_shards(table.limit(3), 5)
    assert few.count() == 3 and few.columns.count("shard") == 1
    assert sharding.shuffle_to_shards(table.limit(0), 5).count() == 0


def test_matrix_has_the_law_of_a_random_deal(spark):
    sizes = spark.createDataFrame([(i, n) for i, n in enumerate([30, 0, 50, 20])], "part int, n bigint")
    cells = []
    for seed in range(60):
        lines = {r.part: r.line for r in sharding.communication_matrix(sizes, 3, seed, 4).collect()}
        assert {p: sum(x) for p, x in lines.items()} == {0: 30, 1: 0, 2: 50, 3: 20}
        assert sorted(sum(x[k] for x in lines.values()) for k in range(3)) == [33, 33, 34]
        cells.append(lines[2][0])
    # Hypergeometric: mean 100/3 * 50/100, variance near 5.6.
    assert abs(np.mean(cells) - 16.67) < 1.3 and 2.5 < np.var(cells) < 10


def test_hypergeometric_draws(spark):
    for good, bad, draws in ((30, 50, 20), (0, 4, 2), (3, 0, 2), (5, 2, 6), (0, 0, 0), (400, 1200, 800)):
        args = [F.lit(x).cast("bigint") for x in (good, bad, draws)]
        u = (F.col("id") + 0.5) / 1000
        x = spark.range(1000).select(sharding.hypergeometric(*args, u).alias("x")).toPandas().x
        assert x.between(max(0, draws - bad), min(draws, good)).all()
        if good + bad:
            assert abs(x.mean() - draws * good / (good + bad)) < 0.05
