"""The wide member row: building, projecting, storing rules, running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rollcall.functions import money, salted_row_key, to_time
from rollcall.operators.join import KEYS, Side, windowed_left_join
from rollcall.operators.merge import MergeRules
from rollcall.schemas import FULL_COLUMNS, MEMBER_COLUMNS, PAYMONEY_COLUMNS, REGTYPE_COLUMNS, WIDE_COLUMNS

# Arrival order of joined rows: the completing arrival, then what it completed.
JOINED_ORDER = ("seq", "paymoney_seq", "regtype_seq", "member_seq")

# Columns of the wide row that a blank leaves as stored.
KEPT_WHEN_BLANK = ("vip_start_time", "vip_end_time", "vip_last_modify_time", "paymoney")


def member_side(members: DataFrame) -> Side:
    return Side(
        members.select(*KEYS, "window", *MEMBER_COLUMNS, F.col("seq").alias("member_seq")),
        "member_seq",
    )


def regtype_side(regtypes: DataFrame) -> Side:
    return Side(
        regtypes.select(*KEYS, "window", *REGTYPE_COLUMNS, F.col("seq").alias("regtype_seq")),
        "regtype_seq",
    )


def paymoney_side(payments: DataFrame) -> Side:
    return Side(
        payments.select(*KEYS, "window", *PAYMONEY_COLUMNS, F.col("seq").alias("paymoney_seq")),
        "paymoney_seq",
    )


def join_facts(members: DataFrame, regtypes: DataFrame, payments: DataFrame, **options) -> DataFrame:
    """Members with their registrations and payments of the same window.

    ``seq`` is the arrival that completed the row; rows completed by one
    arrival are told apart by the member and registration behind them.
    """
    joined = windowed_left_join(
        member_side(members), regtype_side(regtypes), paymoney_side(payments), **options
    )
    return joined.withColumn("seq", F.greatest("member_seq", "regtype_seq", "paymoney_seq"))


def wide_row(looked_up: DataFrame, missing_id_as_zero: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """The 37 stored columns, typed; ``carry`` keeps further columns."""
    id_default = F.lit(0) if missing_id_as_zero else F.lit(None).cast("int")
    columns = []
    for name, source, kind in WIDE_COLUMNS:
        if name == "id":
            value = salted_row_key("uid", "dn")
        elif name == "paymoney":
            value = money(source)
        elif kind == "timestamp" and dict(looked_up.dtypes)[source] == "string":
            value = to_time(source)
        elif name in ("siteid", "vip_id"):
            value = F.coalesce(F.col(source).cast("int"), id_default)
        else:
            value = F.col(source).cast(kind)
        columns.append(value.alias(name))
    return looked_up.select(*columns, *carry)


def full_row(looked_up: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """All 41 columns of the full member record."""
    named = looked_up.withColumnRenamed("createtime", "regtype_createtime")
    return named.select(*FULL_COLUMNS, *carry)


def total_row(looked_up: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The full record with the payment as an amount that can be added up."""
    amount = money("paymoney").cast("decimal(38,2)")
    return full_row(looked_up.withColumn("paymoney", amount), carry)


def wide_rules(dynamic: bool = False) -> MergeRules:
    """Latest row wins; blanks keep the four typed columns, or all of them."""
    names = [name for name, _, _ in WIDE_COLUMNS if name != "id"]
    if dynamic:
        return MergeRules(last_set=tuple(names))
    return MergeRules.latest(names).with_rule(last_set=KEPT_WHEN_BLANK)


def total_rules() -> MergeRules:
    """First row wins, payments add up."""
    names = [c for c in FULL_COLUMNS if c not in KEYS]
    return MergeRules(first=tuple(names)).with_rule(total=("paymoney",))


def payment_totals(payments: DataFrame) -> DataFrame:
    """Sum of payments per member; blank counts as zero."""
    amount = F.coalesce(money("paymoney"), F.lit(0).cast("decimal(18,2)"))
    return payments.groupBy(*KEYS).agg(F.sum(amount).cast("decimal(38,2)").alias("paymoney"))
