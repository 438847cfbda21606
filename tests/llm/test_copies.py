"""SimHash groups, repeated passages and link components, against brute force."""

import random
from collections import defaultdict

import xxhash
from sitelode.llm import queries, simhash, suffixes
from sitelode.llm.graph import components

ODD = [(None, "null id"), (5, None), (6, ""), (7, " \n\t"), (8, "one"), (8, "one"), (9, "two words")]


def plain_fingerprint(text):
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    width = min(3, len(tokens))
    hashes = [xxhash.xxh64_intdigest(b" ".join(tokens[i : i + width]), 42) for i in range(len(tokens) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(items, linked):
    parent = {i: i for i in items}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        parent[root(a)] = root(b)
    return {i: root(i) for i in items}


def edited(text, changes, seed):
    rng, words = random.Random(seed), text.split()
    for i in range(changes):
        words[rng.randrange(len(words))] = f"edit{seed}x{i}"
    return " ".join(words)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    pairs += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    found = {r.vertex: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    whole = closure({x for p in pairs for x in p}, pairs)
    least = defaultdict(list)
    for v, r in whole.items():
        least[r].append(v)
    assert found == {v: min(least[r]) for v, r in whole.items() if len(least[r]) > 1}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_tree_search_is_exact():
    rng = random.Random(1)
    values = [rng.getrandbits(64) for _ in range(300)]
    values += [v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for v in values[:100]]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in values[::7]:
        assert sorted(tree.within(q, 2)) == [i for i, v in enumerate(values) if (v ^ q).bit_count() <= 2]


def test_simhash_query_matches_brute_force(spark, documents, table_dir, prose):
    rows = [(100 + i, prose(i, 4 + i)) for i in range(60)]
    rows += [(300 + i, rows[i][1].upper()) for i in range(0, 60, 7)]
    rows += [(400 + i, edited(prose(59, 400), 1, i)) for i in range(25)] + ODD
    sf_dir = table_dir(documents=documents(rows, extra=True))
    got = sorted(map(tuple, queries.op8_simhash(spark, sf_dir).collect()), key=str)
    prints = [plain_fingerprint(t) for _, t in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    roots = closure(range(len(rows)), near)
    ids = defaultdict(list)
    for i, r in roots.items():
        ids[r] += [rows[i][0]] if rows[i][0] is not None else []
    want = [(rows[i][0], f"{prints[i]:016x}", min(ids[roots[i]], default=None)) for i in range(len(rows))]
    assert got == sorted(want, key=str)


def test_small_shards_find_the_same_links(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    values = {base} | {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(200)}
    values |= {rng.getrandbits(64) for _ in range(50)}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    table = spark.createDataFrame(signed, "fingerprint bigint")
    groups = []
    for size in (16, 4096):
        links = simhash.near_links(table, 2, size)
        groups.append({(r.vertex, r.root) for r in components(links).collect()})
    assert groups[0] == groups[1] and groups[0]


def survivors(rows):
    """Ids and texts that stay of ``(id, text)`` rows: the least id of each group, null ids last."""
    prints = [plain_fingerprint(t) for _, t in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    groups = defaultdict(list)
    for i, root in closure(range(len(rows)), near).items():
        groups[root].append(rows[i][0])
    return sorted((min((x is None, x or 0) for x in ids) for ids in groups.values()))


def test_one_of_each_component_stays(spark, documents, prose):
    base = [prose(i, 300) for i in range(12)]
    rows = [(10 * i, t) for i, t in enumerate(base)] + [(10 * i + 2, t.upper()) for i, t in enumerate(base)]
    rows += [(10 * i + 1, edited(t, 1, i)) for i, t in enumerate(base)]
    rows += [(1000 + i, edited(t, 60, i)) for i, t in enumerate(base)]
    rows += [(2000 + i, edited(prose("long", 3000), 1 + i % 2, i)) for i in range(25)]
    rows += [(3000, rows[-1][1]), (None, base[0]), (None, "of no id alone"), (None, "of no id alone")]
    for extra in (False, True):
        table = documents(rows + ODD, extra=extra)
        kept = simhash.keep_one(table)
        assert kept.columns == table.columns
        want = survivors(rows + ODD)
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == want
        assert len(want) < len(rows)
    assert simhash.keep_one(documents([])).count() == 0


def test_a_hot_text_and_rows_of_one_id(spark, documents, prose):
    rows = [(7, "hot text of very many copies")] * 400 + [(i, "hot text of very many copies") for i in range(10, 300)]
    rows += [(7, prose("other text of that id", 80))] + [(None, None)] * 200
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in simhash.keep_one(documents(rows)).collect())
    assert kept == [(False, 7, "hot text of very many copies"), (False, 7, rows[690][1]), (True, 0, "")]


def test_repeated_passages_are_found_and_true(spark, documents, prose):
    shared, other = prose("p", 60), prose("q", 50)
    rows = [(i, f"{prose(('a', i).__repr__(), 30 + 9 * i)} {shared} {prose(('b', i).__repr__(), 25)}") for i in range(6)]
    rows += [(20, other), (21, f"x y z {other}"), (22, prose("c", 200)), (23, " ".join(["again"] * 120))]
    rows += [(30, prose("d", 49)), (31, prose("d", 49))]  # too short to count
    table = documents(rows + ODD, extra=True)
    words = {i: t.split() for i, t in rows}
    found = suffixes.repeated_passages(table).collect()
    for r in found:
        assert words[r.doc_id][r["first"] : r["last"]] == words[r.of_doc_id][r.of_first : r.of_last]
        assert r["last"] - r["first"] >= 50
    seen = {r.doc_id for r in found} | {r.of_doc_id for r in found}
    assert seen == {0, 1, 2, 3, 4, 5, 20, 21, 23}
    for i in range(6):
        at = " ".join(words[i]).split(shared)[0].count(" ")
        spans = [(r["first"], r["last"]) for r in found if r.doc_id == i] + [(r.of_first, r.of_last) for r in found if r.of_doc_id == i]
        assert any(a <= at and b >= at + 60 for a, b in spans)
    assert suffixes.repeated_passages(documents([])).count() == 0


def test_random_passages_against_all_windows(spark, documents, prose):
    rng = random.Random(3)
    pool = [prose(f"s{i}", rng.randrange(50, 90)) for i in range(6)]
    rows = []
    for i in range(40):
        parts = [prose(f"t{i}{j}", rng.randrange(5, 60)) for j in range(3)]
        for p in rng.sample(pool, rng.randrange(0, 3)):
            parts.insert(rng.randrange(len(parts)), p)
        rows.append((i, " ".join(parts)))
    words = {i: t.split() for i, t in rows}
    windows = defaultdict(set)
    for i, w in words.items():
        for at in range(len(w) - 49):
            windows[tuple(w[at : at + 50])].add((i, at))
    repeated = {i for places in windows.values() if len(places) > 1 for i, _ in places}
    found = suffixes.repeated_passages(documents(rows)).collect()
    assert {r.doc_id for r in found} | {r.of_doc_id for r in found} == repeated
    left = {r.doc_id: (r.text or "").split() for r in suffixes.without_repeats(documents(rows)).collect()}
    # Nothing is lost: every window of the input, as far as it was one passage, still stands somewhere.
    text = "\n".join(" ".join(w) for w in left.values())
    for p in pool:
        if sum(p in t for _, t in rows):
            assert p in text
    assert sum(map(len, left.values())) < sum(map(len, words.values()))


def missed(spark, table, rows):
    """Words of windows of fifty words that stand in an earlier place too and that no row reports."""
    keys = {r.doc_id: r.k for r in table.select("doc_id", suffixes.text_key("doc_id", "text").alias("k")).collect()}
    words = {i: t.split() for i, t in rows}
    windows, left = defaultdict(list), defaultdict(set)
    for i, w in words.items():
        for at in range(len(w) - 49):
            windows[tuple(w[at : at + 50])].append((keys[i], at, i))
    for places in windows.values():
        for _, at, i in sorted(places)[1:]:
            left[i] |= set(range(at, at + 50))
    assert left
    for r in suffixes.repeated_passages(table).collect():
        assert words[r.doc_id][r["first"] : r["last"]] == words[r.of_doc_id][r.of_first : r.of_last]
        assert r["last"] - r["first"] >= 50
        assert (keys[r.of_doc_id], r.of_first) < (keys[r.doc_id], r["first"])
        left[r.doc_id] -= set(range(r["first"], r["last"]))
    return {i: at for i, at in left.items() if at}


def test_passages_that_earlier_texts_hold_in_part(spark, documents, prose):
    rng, rows = random.Random(8), []
    for p in range(12):
        passage = prose(f"passage {p}", rng.randrange(50, 90)).split()
        for i in range(12):
            size = rng.randrange(35, 50) if i % 3 else len(passage)
            at = rng.choice((0, len(passage) - size, rng.randrange(len(passage) - size + 1)))
            part = " ".join(passage[at : at + size])
            before, after = prose(f"b{p} {i}", rng.randrange(40)), prose(f"a{p} {i}", rng.randrange(40))
            rows.append((100 * p + i, f"{before} {part} {after}"))
    header, groups = prose("header", 44), [prose(f"g{i}", rng.randrange(6, 40)) for i in range(12)]
    rows += [(5000 + i, f"{header} {groups[i % 12]} {prose(f'h{i}', 30)}") for i in range(120)]
    rows += [(6000, " ".join(["again"] * 130)), (6001, f"x {' '.join(['again'] * 70)} y")]
    table = documents(rows)
    assert missed(spark, table, rows) == {}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        assert missed(spark, table, rows) == {}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_cut_documents_keep_rows_and_columns(spark, documents, prose):
    copy = prose("z", 120)
    rows = [(1, copy), (2, copy), (3, prose("y", 80)), *ODD]
    table = documents(rows, extra=True)
    left = suffixes.without_repeats(table)
    assert left.columns == table.columns
    texts = [r.text for r in left.collect()]
    assert texts.count(copy) == 1 and len(texts) == len(rows) - 1
    assert suffixes.without_repeats(documents([])).count() == 0


def test_runs_over_several_partitions_have_one_head(spark, documents, prose):
    texts = documents([(i, prose("same", 300)) for i in range(90)] + [(100 + i, prose(i, 100)) for i in range(20)])
    keyed = texts.select(suffixes.text_key("doc_id", "text").alias("_doc"), "text")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = suffixes.matched_suffixes(keyed, suffixes.Settings()).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    first = min(r._doc for r in keyed.where("doc_id < 90").collect())
    assert {r.head_doc for r in found} == {first}
    assert all(r.at == r.head_at for r in found)
    places = {r.at for r in found}
    assert len(found) == 89 * len(places) and len(places) > 10
