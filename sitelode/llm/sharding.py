"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

How many rows each partition sends to each shard is drawn first, from the distribution that a
uniformly random deal would have: rows and columns of the matrix add up to the sizes of
partitions and shards. Every partition permutes its rows and cuts them by its line of the
matrix; after the exchange the shards permute what they got. Only DataFrame and SQL
functions are used; the matrix is drawn by splitting the partitions in halves, all parts
of a level at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import positions
from ..session import cut_lineage


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """The number of good ones among ``draws`` from ``good + bad``, by inversion of the uniform ``u``.

    Chances are summed up from nine standard deviations below the mode to nine above; what
    lies outside has a chance below 1e-18. Arguments are bigint, ``u`` a double below 1.
    """

    def bounds(s: Column) -> Column:
        total = (s["g"] + s["b"]).cast("double")
        mode = F.floor((s["n"] + 1) * (s["g"] + 1).cast("double") / (total + 2)).cast("bigint")
        spread = F.sqrt(
            s["n"] * (s["g"] / F.greatest(total, F.lit(1.0))) * (s["b"] / F.greatest(total, F.lit(1.0)))
            * ((total - s["n"]) / F.greatest(total - 1, F.lit(1.0)))
        )
        reach = F.ceil(9 * spread).cast("bigint") + 9
        least, most = F.greatest(F.lit(0).cast("bigint"), s["n"] - s["b"]), F.least(s["n"], s["g"])
        return F.struct(
            s["g"].cast("double").alias("g"), s["b"].cast("double").alias("b"), s["n"].cast("double").alias("n"), s["u"].alias("u"),
            F.sequence(F.least(F.greatest(least, mode - reach), most), F.greatest(F.least(most, mode + reach), least)).alias("x"),
        )

    def chosen(s: Column) -> Column:
        def next_weight(acc: Column, x: Column) -> Column:
            return acc["w"] * (s["g"] - x) * (s["n"] - x) / ((x + 1.0) * (s["b"] - s["n"] + x + 1.0))

        one, nothing = F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")
        whole = F.aggregate(
            s["x"], F.struct(one, nothing), lambda acc, x: F.struct(next_weight(acc, x).alias("w"), (acc["sum"] + acc["w"]).alias("sum"))
        )["sum"]
        return _let(
            whole * s["u"],
            lambda goal: F.aggregate(
                s["x"],
                F.struct(one, nothing, F.element_at(s["x"], 1).alias("pick")),
                lambda acc, x: F.struct(
                    next_weight(acc, x).alias("w"), (acc["sum"] + acc["w"]).alias("sum"),
                    F.when(acc["sum"] <= goal, x).otherwise(acc["pick"]).alias("pick"),
                ),
            )["pick"],
        )

    state = F.struct(good.alias("g"), bad.alias("b"), draws.alias("n"), u.alias("u"))
    return _let(state, lambda s: _let(bounds(s), chosen))


def _uniform(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _deal(room: Column, items: Column, node: Column, seed: int) -> Column:
    """How many of ``items`` rows go to each shard, given the room left in all of them."""
    start = F.struct(
        items.alias("n"), F.aggregate(room, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("pool"),
        F.array().cast("array<bigint>").alias("out"),
    )
    places = F.sequence(F.lit(0), F.size(room) - 1)

    def one(s: Column, k: Column) -> Column:
        here = room[k]
        drawn = hypergeometric(here, s["pool"] - here, s["n"], _uniform(node, k, F.lit(seed)))
        return _let(
            drawn,
            lambda x: F.struct(
                (s["n"] - x).alias("n"), (s["pool"] - here).alias("pool"), F.concat(s["out"], F.array(x)).alias("out")
            ),
        )

    return F.aggregate(places, start, one)["out"]


def communication_matrix(sizes: DataFrame, shards: int, seed: int, width: int) -> DataFrame:
    """``part, line``: for every partition of ``sizes`` (``part, n``) the number of rows for each shard.

    Shards take equal numbers of rows; which of them take one more, if it does not come out even, is drawn too.
    ``width`` is the number of partitions.
    """
    total = F.aggregate("items", F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
    order = F.array_sort(
        F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda k: F.struct(F.xxhash64(k, F.lit(seed)).alias("h"), k.alias("k")))
    )
    nodes = sizes.agg(F.array_sort(F.collect_list(F.struct("part", "n"))).alias("items")).select(
        "items", total.alias("total"), F.transform(order, lambda s: s["k"]).alias("order")
    ).where(F.size("items") > 0)
    nodes = nodes.select(
        "items",
        F.transform(
            F.sequence(F.lit(0), F.lit(shards - 1)),
            lambda k: F.floor(F.col("total") / shards).cast("bigint")
            + F.when(F.array_position("order", k) <= F.col("total") % shards, 1).otherwise(0),
        ).alias("room"),
    )
    level = 0
    while 1 << level < width:
        if level >= 3:
            nodes = nodes.repartition(min(1 << level, 1024), F.get("items", F.lit(0))["part"])
        half = F.ceil(F.size("items") / 2).cast("int")
        halves = nodes.select(
            "items", "room", F.slice("items", 1, half).alias("left"), F.slice("items", half + 1, F.size("items")).alias("right")
        )
        count = F.aggregate("left", F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
        drawn = halves.select(
            "left", "right", "room",
            _deal(F.col("room"), count, F.concat(F.get("items", F.lit(0))["part"].cast("string"), F.lit(f"/{level}")), seed).alias("mine"),
        )
        rest = F.zip_with("room", "mine", lambda r, m: r - m)
        nodes = drawn.select(
            F.explode(F.array(F.struct(F.col("left").alias("items"), F.col("mine").alias("room")), F.struct(F.col("right").alias("items"), rest.alias("room")))).alias("h")
        ).select("h.*").where(F.size("items") > 0)
        level += 1
    return nodes.select(F.get("items", F.lit(0))["part"].alias("part"), F.col("room").alias("line"))


def shuffle_to_shards(rows: DataFrame, shards: int = 40, seed: int = 11, rows_per_slice: int = 50_000) -> DataFrame:
    """``rows`` with ``shard`` (int, from 0) and ``slot`` (bigint, gapless from 0 in its shard).

    Row counts of shards differ by one at most, and every such arrangement is as likely as any other, given a
    random seed. All rows and columns are kept, repeated rows and nulls too; columns of these two names are
    replaced. With fewer rows than shards some shards stay empty, and no row gives no row.
    """
    rows = rows.drop("shard", "slot")
    # Partitions must stay what they are between counting and dealing.
    placed = cut_lineage(rows)
    inner = [F.to_json(F.col(c)) if kind.startswith(("map", "variant")) else F.col(c) for c, kind in placed.dtypes]
    local = placed.withColumn("_draw", F.xxhash64(*inner, F.lit(seed))).sortWithinPartitions("_draw")
    # Position in the permuted partition; the partition's number stands in the upper bits.
    numbered = local.withColumn("_at", F.monotonically_increasing_id()).drop("_draw")
    part = F.shiftright("_at", 33).cast("int")
    sizes = cut_lineage(numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n")))
    width, total = sizes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    matrix = cut_lineage(communication_matrix(sizes, shards, seed, width)).select(
        "part",
        F.aggregate(
            "line",
            F.array().cast("array<bigint>"),
            lambda done, n: F.concat(done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)) + n)),
        ).alias("_ends"),
    )
    at = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sent = numbered.join(matrix, part == matrix["part"]).withColumn("shard", F.size(F.filter("_ends", lambda e: e <= at)))
    slices = max(8, -(-total // (shards * rows_per_slice)))
    mixed = sent.withColumn("_again", F.shiftrightunsigned(F.xxhash64("_at", F.lit(seed + 1)), 1)).drop("part", "_ends", "_at")
    ranked = positions(mixed, ["shard"], ["_again"], "slot", F.floor(F.col("_again") / F.lit(float(1 << 63)) * slices))
    return ranked.select(*rows.columns, "shard", (F.col("slot") - 1).alias("slot"))
