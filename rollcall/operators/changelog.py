"""The arrival-driven left join: what is emitted when every arrival fires.

Each arrival in a group (keys and window) makes the group emit all rows it has
so far: left rows with blanks while no right row is there, afterwards the first
left row with every right row. Written out, that grows with the square of the
group. Here every distinct emitted row appears once, with the first and last
arrival number that emits it; :func:`expand` writes the repeats out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.operators.join import KEYS, Side
from rollcall.operators.skew import any_null, split_left_join
from rollcall.session import keep

ARRIVALS_PER_CHUNK = 1_000_000
ROWS_PER_RANGE = 200_000
PLACES = 1 << 33  # of rows of a partition in Spark's increasing ids


def arrival_changelog(
    left: Side,
    right: Side,
    keys: Sequence[str] = KEYS,
    window: str = "window",
    arrivals_per_chunk: int = ARRIVALS_PER_CHUNK,
) -> DataFrame:
    """Emitted rows with ``first_arrival``, ``last_arrival`` and ``emissions``.

    The order columns of both sides count one common arrival sequence and are
    unique across both. Arrivals are numbered within stretches of a group (of
    about ``arrivals_per_chunk`` rows) and the numbers of earlier stretches are
    added from their totals, so no task sorts a whole group.
    """
    on = [*keys, window]
    lcols = [c for c in left.df.columns if c not in on]
    rcols = [c for c in right.df.columns if c not in on]
    lside = left.df.select(
        *on,
        F.col(left.order).cast("bigint").alias("_o"),
        F.struct(*lcols).alias("_l"),
        F.lit(None).cast(right.df.select(F.struct(*rcols)).schema[0].dataType).alias("_r"),
    )
    rside = right.df.select(
        *on,
        F.col(right.order).cast("bigint").alias("_o"),
        F.lit(None).cast(left.df.select(F.struct(*lcols)).schema[0].dataType).alias("_l"),
        F.struct(*rcols).alias("_r"),
    )
    chunk = [*on, "_chunk"]
    is_left = F.col("_l").isNotNull()
    rows = stretches(lside.unionByName(rside).where(~any_null(on)), on, "_o", arrivals_per_chunk)
    in_chunk = Window.partitionBy(*chunk).orderBy("_o")
    rows = rows.withColumn("_i", F.row_number().over(in_chunk))

    totals = rows.groupBy(*chunk).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(F.when(is_left, F.col("_i"))).alias("_li"),
        F.min(F.when(~is_left, F.col("_i"))).alias("_ri"),
        F.min_by("_l", F.when(is_left, F.col("_o"))).alias("_lrow"),
    )
    group = Window.partitionBy(*on)
    before = F.coalesce(
        F.sum("_n").over(group.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    totals = totals.withColumn("_before", before)
    totals = totals.select(
        *chunk,
        "_before",
        F.sum("_n").over(group).alias("_all"),
        F.min(F.col("_before") + F.col("_li")).over(group).alias("_first_left"),
        F.min(F.col("_before") + F.col("_ri")).over(group).alias("_first_right"),
        F.min_by("_lrow", F.when(F.col("_li").isNotNull(), F.col("_chunk")))
        .over(group)
        .alias("_head"),
    )
    number = F.col("_before") + F.col("_i")
    both = rows.join(totals, chunk).withColumn("_number", number)
    first = F.when(is_left, F.col("_number")).otherwise(
        F.greatest(F.col("_number"), F.col("_first_left"))
    )
    last = F.when(
        is_left, F.coalesce(F.col("_first_right") - 1, F.col("_all"))
    ).otherwise(F.col("_all"))
    out = (
        both.withColumn("first_arrival", first)
        .withColumn("last_arrival", last)
        .where(
            F.when(is_left, F.col("first_arrival") <= F.col("last_arrival")).otherwise(
                F.col("_first_left").isNotNull()
            )
        )
    )
    shown = F.when(is_left, F.col("_l")).otherwise(F.col("_head"))
    # A row without a key joins nothing and is a group of its own.
    alone = lside.where(any_null(on))
    out = out.select(
        *on, shown.alias("_l"), "_r", F.col("first_arrival").cast("bigint"),
        F.col("last_arrival").cast("bigint"),
    ).unionByName(
        alone.select(
            *on, "_l", "_r", F.lit(1).cast("bigint").alias("first_arrival"),
            F.lit(1).cast("bigint").alias("last_arrival"),
        )
    )
    return out.select(
        *on,
        *[F.col("_l")[c].alias(c) for c in lcols],
        *[F.col("_r")[c].alias(c) for c in rcols],
        "first_arrival",
        "last_arrival",
        (F.col("last_arrival") - F.col("first_arrival") + 1).alias("emissions"),
    )


def expand(changelog: DataFrame) -> DataFrame:
    """One row per emission, with its arrival number ``arrival``."""
    return changelog.withColumn(
        "arrival", F.explode(F.sequence("first_arrival", "last_arrival"))
    ).drop("first_arrival", "last_arrival", "emissions")


def stretches(rows: DataFrame, on: Sequence[str], order: str, arrivals_per_chunk: int) -> DataFrame:
    """``rows`` with ``_chunk``: stretches of a group's arrivals of at most that many rows, in their order.

    The rows are dealt by ranges of group and order, so that a large group lies
    in as many ranges as its rows ask for, whatever its order numbers are. Short
    stretches share a range; a task takes about ``ROWS_PER_RANGE`` rows.
    """
    parts = max(1, -(-rows.count() // max(arrivals_per_chunk, ROWS_PER_RANGE)))
    ranged = rows.repartitionByRange(parts, *on, order).sortWithinPartitions(*on, order)
    # The range's number is above the row's place in it.
    place = F.monotonically_increasing_id()
    in_range = F.floor(place.bitwiseAND(F.lit(PLACES - 1)) / arrivals_per_chunk)
    return keep(ranged.withColumn("_chunk", place.bitwiseAND(F.lit(-PLACES)) + in_range))


def running(rows: DataFrame, on: Sequence[str], order: str, **sums: Column) -> DataFrame:
    """``rows`` with running sums over their group, this row included; two levels, by ``_chunk``."""
    chunk = [*on, "_chunk"]
    inside = Window.partitionBy(*chunk).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*on).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*chunk).agg(*(F.sum(c).alias(f"_t_{n}") for n, c in sums.items()))
    earlier = totals.select(*chunk, *(F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_t_{n}") for n in sums))
    summed = rows.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()}).join(earlier, chunk)
    return summed.withColumns({n: F.col(n) + F.col(f"_t_{n}") for n in sums}).drop(*(f"_t_{n}" for n in sums))


def arrival_changelog_twice(
    left: Side,
    right: Side,
    last: Side,
    keys: Sequence[str] = KEYS,
    window: str = "window",
    arrivals_per_chunk: int = ARRIVALS_PER_CHUNK,
) -> DataFrame:
    """The changelog of a join whose left input is itself the changelog of ``left`` and ``right``.

    Every row that the first join emits, repeats included, is an arrival of the
    second one, in the order of the arrival that made it come out and of its
    place among the rows of that emission; the rows of ``last`` arrive between
    them. Returns the distinct rows of the second join: keys, window, the
    payloads of all sides, ``first_arrival`` and ``last_arrival``, counted in
    the second join, and ``emissions`` (over all repeats of a row). There are
    at most as many as arrivals, though the first join alone may emit their
    square: how often a row comes is a difference of running sums.

    The order columns count one arrival sequence, unique across the sides. Left
    rows without a key join nothing and come out once, others not at all.
    """
    on = [*keys, window]
    sides = (left, right, last)
    tagged = [
        s.df.select(*on, F.lit(i).alias("_side"), F.col(s.order).cast("bigint").alias("_o")) for i, s in enumerate(sides)
    ]
    rows = stretches(reduce(DataFrame.unionByName, tagged).where(~any_null(on)), on, "_o", arrivals_per_chunk)
    side = F.col("_side")
    one = lambda i: (side == i).cast("bigint")
    rows = running(rows, on, "_o", _lefts=one(0), _rights=one(1))
    # What the first join emits at this arrival.
    size = F.when(F.col("_rights") == 0, F.col("_lefts")).when(F.col("_lefts") > 0, F.col("_rights")).otherwise(0)
    rows = rows.withColumn("_size", F.when(side < 2, size).otherwise(0).cast("bigint"))
    rows = running(rows, on, "_o", _number=F.col("_size") + one(2))
    # Arrivals of the second join before those of this one, and their sum over the first join's arrivals.
    base = F.col("_number") - F.col("_size")
    rows = keep(running(rows, on, "_o", _bases=F.when(side < 2, base).otherwise(0)))

    first_last = F.min(F.when(side == 2, F.col("_o"))).alias("_last_o")
    firsts = rows.groupBy(*on).agg(
        first_last, F.min(F.when(side == 1, F.col("_o"))).alias("_right_o"), F.min(F.when(side == 0, F.col("_o"))).alias("_left_o"),
        F.max("_number").alias("_all"), F.min(F.when(side == 2, F.col("_number"))).alias("_paid"),
        F.min(F.when(F.col("_size") > 0, base + 1)).alias("_head"),
    )
    marked = rows.join(firsts, on)
    arrivals = F.col("_lefts") + F.col("_rights")
    open_ = (side < 2) & (F.col("_last_o").isNull() | (F.col("_o") < F.col("_last_o")))
    blank = open_ & (F.col("_rights") == 0)
    own = (side == 0) & (F.col("_o") == F.col("_left_o"))
    at = lambda test, name: [
        F.max(F.when(test, arrivals)).alias(f"_n_{name}"), F.max(F.when(test, F.col("_bases"))).alias(f"_s_{name}")
    ]
    ends = marked.groupBy(*on).agg(
        *at(blank, "blank"), *at(open_, "open"), F.max(F.when(own, arrivals)).alias("_n_own"),
        F.max(F.when(own, F.col("_bases"))).alias("_s_own"), F.max(F.when(own, base)).alias("_b_own"),
        F.max(F.when(own, F.col("_rights"))).alias("_r_own"),
    )
    marked = marked.join(ends, on)
    until = F.coalesce(F.col("_paid"), F.col("_all") + 1)
    left_first = F.col("_lefts") > 0
    # A right row comes out with the first left row, from whichever of them arrives later.
    late = (side == 1) & ~left_first
    begin = {
        "_n": F.when(late, F.col("_n_own")).otherwise(arrivals) - 1,
        "_s": F.when(late, F.col("_s_own") - F.col("_b_own")).otherwise(F.col("_bases") - base),
        "_b": F.when(late, F.col("_b_own")).otherwise(base),
        "_place": F.when(side == 0, F.col("_lefts")).otherwise(F.col("_rights")),
    }
    single = (side == 0) & (F.col("_rights") == 0)
    count = F.when(single, F.col("_n_blank")).otherwise(F.col("_n_open")) - F.col("_n")
    total = F.when(single, F.col("_s_blank")).otherwise(F.col("_s_open")) - F.col("_s")
    unpaid = (
        marked.withColumns(begin).where((single | (side == 1)) & F.col("_left_o").isNotNull() & (count > 0))
        .select(
            *on, F.when(side == 0, F.col("_o")).otherwise(F.col("_left_o")).alias("_o0"),
            F.when(side == 1, F.col("_o")).alias("_o1"), F.lit(None).cast("bigint").alias("_o2"),
            (F.col("_b") + F.col("_place")).alias("first_arrival"),
            # A single row is last repeated when another first-join row takes its place, but stays a row of the second.
            (until - 1).alias("last_arrival"), (count * (until - F.col("_place")) - total).alias("emissions"),
        )
    )
    shown = F.greatest(F.col("_number"), F.col("_head"))
    paid = marked.where((side == 2) & F.col("_head").isNotNull()).select(
        *on, F.col("_left_o").alias("_o0"), F.when(F.col("_r_own") > 0, F.col("_right_o")).alias("_o1"), F.col("_o").alias("_o2"),
        shown.alias("first_arrival"), F.col("_all").alias("last_arrival"), (F.col("_all") - shown + 1).alias("emissions"),
    )
    once = F.lit(1).cast("bigint")
    alone = left.df.where(any_null(on)).select(
        *on, F.col(left.order).cast("bigint").alias("_o0"), F.lit(None).cast("bigint").alias("_o1"), F.lit(None).cast("bigint").alias("_o2"),
        once.alias("first_arrival"), once.alias("last_arrival"), once.alias("emissions"),
    )
    out = unpaid.unionByName(paid).unionByName(alone)
    names = []
    for i, s in enumerate(sides):
        payload = [c for c in s.df.columns if c not in on]
        body = s.df.select(F.col(s.order).cast("bigint").alias(f"_o{i}"), F.struct(*payload).alias(f"_row{i}"))
        # One first row may stand in all rows of a large group.
        out = split_left_join(out, body, [f"_o{i}"], "first_arrival")
        names += [F.col(f"_row{i}")[c].alias(c) for c in payload]
    return out.select(*on, *names, "first_arrival", "last_arrival", "emissions")
