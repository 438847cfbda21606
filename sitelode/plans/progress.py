"""Page caps, time budget, progress snapshots and the closing summary of each crawl."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import running_totals
from ..session import cut_lineage

# Time budget of a crawl and cadence of its snapshots.
TIME_BUDGET_MS = 240_000
SNAPSHOT_PAGES = 25
SNAPSHOT_MS = 5_000
_PAGES_PER_SLICE = 8192


def page_log(fetches: DataFrame, order: list[str], slice_by: Column | None = None) -> DataFrame:
    """Add ``page_no`` and ``t_ms`` to a fetch log ``(crawl_id, ..., has_content, elapsed_ms)``.

    Failed fetches take time but are no pages; the log comes back without them.
    """
    return running_totals(
        fetches,
        ["crawl_id"],
        order,
        {"page_no": F.col("has_content").cast("bigint"), "t_ms": F.col("elapsed_ms")},
        slice_by,
    ).filter("has_content")


def apply_caps(log: DataFrame, limits: DataFrame, budget_ms: int = TIME_BUDGET_MS) -> DataFrame:
    """Pages kept of a page log, with ``over_budget`` for crawls the budget ended.

    ``limits`` is ``(crawl_id, max_pages)``. The clock is read after a page was
    taken, so the last page kept is the first one at or past the budget.
    """
    capped = log.join(limits.select("crawl_id", "max_pages"), "crawl_id").filter("page_no <= max_pages")
    # Every later page is past the budget too, so the first one alone decides.
    last = (
        capped.filter(F.col("t_ms") >= budget_ms).groupBy("crawl_id").agg(F.min("page_no").alias("last_no"))
    )
    return (
        capped.join(last, "crawl_id", "left")
        .filter(F.col("last_no").isNull() | (F.col("page_no") <= F.col("last_no")))
        .withColumn("over_budget", F.col("last_no").isNotNull())
        .drop("max_pages", "last_no")
    )


def crawl_summary(kept: DataFrame, limits: DataFrame) -> DataFrame:
    """``(crawl_id, completed, total, capped, reason)`` for every crawl, also those without pages.

    ``limits`` is ``(crawl_id, max_pages, source_total)`` with a null total when the
    source is open-ended.
    """
    done = kept.groupBy("crawl_id").agg(
        F.count("*").alias("completed"), F.bool_or("over_budget").alias("over_budget")
    )
    joined = limits.join(done, "crawl_id", "left").withColumns(
        {"completed": F.coalesce("completed", F.lit(0)), "over_budget": F.coalesce("over_budget", F.lit(False))}
    )
    return close_crawls(joined).select("crawl_id", "completed", "total", "capped", "reason")


def close_crawls(counted: DataFrame) -> DataFrame:
    """Add ``reason, capped`` and the shown ``total`` to ``completed, over_budget, max_pages, source_total``.

    The budget is the reason before the cap, and the cap is one only where the source is known to hold more.
    """
    more = F.coalesce(F.col("source_total") > F.col("max_pages"), F.lit(False))
    reason = (
        F.when(F.col("over_budget"), F.lit("time_budget"))
        .when((F.col("completed") >= F.col("max_pages")) & more, F.lit("max_pages"))
        .otherwise(F.lit(""))
    )
    total = F.when((reason != "") & F.col("source_total").isNotNull(), F.col("source_total")).otherwise(F.col("completed"))
    return counted.withColumns({"reason": reason, "capped": reason != "", "total": total.cast("bigint")})


def _slice_runs(every_pages: int, every_ms: int, slice_rows: int):
    """Snapshots of one slice, for every state the slice may be entered in, many slices to a call.

    A state is how many pages ago the last snapshot was. It is below
    ``every_pages``, because that many pages always trigger one.
    """

    def run(number: int, pages: list[dict]) -> dict:
        first = number * slice_rows + 1
        # A time that is not known is no time to wait for.
        times = [(p["page_no"], math.nan if p["t_ms"] is None else p["t_ms"]) for p in pages]
        clock = dict(times)
        own = [(n, t) for n, t in times if n >= first]
        leave, taken = [], []
        for ago in range(min(every_pages, first)):
            last_n = first - 1 - ago
            last_t = clock.get(last_n, 0)
            due = []
            for n, t in own:
                if n - last_n >= every_pages or t - last_t >= every_ms:
                    last_n, last_t = n, t
                    due.append(n)
            leave.append(own[-1][0] - last_n)
            taken.append(due)
        return {"leave": leave, "taken": taken}

    @F.arrow_udf("struct<leave:array<int>,taken:array<array<bigint>>>")
    def runs(slices: pa.Array, pages: pa.Array) -> pa.Array:
        done = [run(*one) for one in zip(slices.to_pylist(), pages.to_pylist())]
        return pa.array(done, pa.struct({"leave": pa.list_(pa.int32()), "taken": pa.list_(pa.list_(pa.int64()))}))

    return runs


def _enter_states():
    """The state in which each slice of a crawl is entered, from its slices in order; each is one small entry."""

    def walk(slices: list[dict]) -> list[dict]:
        state, out = 0, []
        for one in slices:
            out.append({"slice": one["slice"], "enter": state})
            state = one["leave"][state]
        return out

    @F.arrow_udf("array<struct<slice:bigint,enter:int>>")
    def entered(slices: pa.Array) -> pa.Array:
        return pa.array([walk(s) for s in slices.to_pylist()], pa.list_(pa.struct({"slice": pa.int64(), "enter": pa.int32()})))

    return entered


def snapshot_pages(
    kept: DataFrame, every_pages: int = SNAPSHOT_PAGES, every_ms: int = SNAPSHOT_MS, slice_rows: int = _PAGES_PER_SLICE
) -> DataFrame:
    """Pages at which a snapshot is due: ``(crawl_id, page_no)``.

    The trigger restarts at each snapshot, so it is a fold over the whole crawl.
    Slices of fixed length are folded in parallel from every possible state, then
    the right state is picked slice by slice.
    """
    if every_pages > slice_rows:
        raise ValueError("a slice must hold at least every_pages pages")
    own = F.floor((F.col("page_no") - 1) / slice_rows)
    # The tail of a slice is also needed by the next one, to know when its last snapshot was.
    in_tail = F.col("page_no") > (own + 1) * slice_rows - every_pages
    placed = kept.select(
        "crawl_id", "page_no", "t_ms", F.explode(F.when(in_tail, F.array(own, own + 1)).otherwise(F.array(own))).alias("slice")
    )
    last = kept.groupBy("crawl_id").agg(F.max(own).alias("last_slice"))
    # A slice is gathered into one row, and rows go to Python by the batch: a call for each of very many small crawls costs far more.
    pages = F.array_sort(F.collect_list(F.struct("page_no", "t_ms"))).alias("pages")
    gathered = placed.join(last, "crawl_id").filter("slice <= last_slice").groupBy("crawl_id", "slice").agg(pages)
    run = _slice_runs(every_pages, every_ms, slice_rows)(F.col("slice"), F.col("pages"))
    runs = cut_lineage(gathered.select("crawl_id", "slice", run.alias("run")).select("crawl_id", "slice", "run.leave", "run.taken"))
    ordered = runs.groupBy("crawl_id").agg(F.array_sort(F.collect_list(F.struct("slice", "leave"))).alias("slices"))
    entered = ordered.select("crawl_id", F.inline(_enter_states()(F.col("slices"))))
    return runs.join(entered, ["crawl_id", "slice"]).select(
        "crawl_id", F.explode(F.element_at("taken", F.col("enter") + 1)).alias("page_no")
    )


def progress_table(
    kept: DataFrame,
    limits: DataFrame,
    every_pages: int = SNAPSHOT_PAGES,
    every_ms: int = SNAPSHOT_MS,
    slice_rows: int = _PAGES_PER_SLICE,
) -> DataFrame:
    """Every message of every crawl: the opening one, its snapshots and the completion."""
    nothing = [F.lit(False).alias("capped"), F.lit("").alias("reason")]
    zero = F.lit(0).cast("bigint")
    opening = limits.select(
        "crawl_id", zero.alias("completed"), zero.alias("total"), F.lit("processing").alias("status"), *nothing,
        F.lit(0).alias("stage"),
    )
    snapshots = (
        snapshot_pages(kept, every_pages, every_ms, slice_rows)
        .join(limits, "crawl_id")
        .select(
            "crawl_id",
            F.col("page_no").alias("completed"),
            F.greatest(F.coalesce("source_total", zero), "page_no").cast("bigint").alias("total"),
            F.lit("processing").alias("status"),
            *nothing,
            F.lit(1).alias("stage"),
        )
    )
    closing = crawl_summary(kept, limits).select(
        "crawl_id", "completed", "total", F.lit("completed").alias("status"), "capped", "reason", F.lit(2).alias("stage")
    )
    every = opening.unionByName(snapshots).unionByName(closing)
    numbered = running_totals(every, ["crawl_id"], ["stage", "completed"], {"n": F.lit(1).cast("bigint")})
    return numbered.select(
        "crawl_id", (F.col("n") - 1).cast("int").alias("seq"), "completed", "total", "status", "capped", "reason"
    )
