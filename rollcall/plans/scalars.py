"""Scalar functions over the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions import (
    blank_to_null, composite_key, date_text, event_time, int_to_ipv4, json_int, json_text, money,
    money_text, partition_date, record_json, salted_row_key, timestamp_text, to_millis, to_time,
)
from rollcall.plans import roles
from rollcall.plans.base_sql import FACTS, with_
from rollcall.plans.registry import query


def _events(spark, sf_dir):
    return roles.table(spark, sf_dir, "events")


@query(
    "salted_row_key",
    with_(FACTS)
    + """SELECT uid, dn, substr(md5(CAST(uid AS VARCHAR)), 1, 5) || uid || dn AS id,
       member_seq AS seq FROM member""",
)
def salted_row_key_(spark, sf_dir):
    members = roles.facts(spark, sf_dir, roles.MEMBER, window=None)
    return members.select("uid", "dn", salted_row_key("uid", "dn").alias("id"), "seq")


@query(
    "composite_key",
    """SELECT event_id, CAST(user_id AS VARCHAR) || '_' || nullif(event_type, 'error') AS k
FROM events""",
)
def composite_key_(spark, sf_dir):
    group = F.nullif("event_type", F.lit("error"))
    return _events(spark, sf_dir).select("event_id", composite_key("user_id", group).alias("k"))


@query(
    "json_field_access",
    """SELECT event_id, json_extract_string(props, '$.k') AS k_text,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int, CAST(NULL AS INTEGER) AS absent_int,
  0 AS absent_zero, TRY_CAST(event_type AS INTEGER) AS word_int,
  CASE WHEN event_type <> 'click' THEN event_type END AS set_text
FROM events""",
)
def json_field_access(spark, sf_dir):
    shown = F.when(F.col("event_type") == "click", F.lit("  ")).otherwise(F.col("event_type"))
    return _events(spark, sf_dir).select(
        "event_id",
        json_text("props", "k").alias("k_text"),
        json_int("props", "k").alias("k_int"),
        json_int("props", "absent").alias("absent_int"),
        json_int("props", "absent", default=0).alias("absent_zero"),
        F.col("event_type").try_cast("int").alias("word_int"),
        blank_to_null(shown).alias("set_text"),
    )


@query(
    "to_json_roundtrip",
    """SELECT event_id, CASE WHEN event_type = 'error'
    THEN CAST(json_object('uid', user_id) AS VARCHAR)
    ELSE CAST(json_object('uid', user_id, 'kind', event_type) AS VARCHAR) END AS body,
  user_id AS uid_back, CASE WHEN event_type <> 'error' THEN event_type END AS kind_back
FROM events""",
)
def to_json_roundtrip(spark, sf_dir):
    written = _events(spark, sf_dir).select(
        "event_id",
        record_json(
            F.col("user_id").alias("uid"), F.nullif("event_type", F.lit("error")).alias("kind")
        ).alias("body"),
    )
    return written.select(
        "event_id",
        "body",
        json_text("body", "uid").cast("bigint").alias("uid_back"),
        json_text("body", "kind").alias("kind_back"),
    )


@query(
    "event_time_from_millis",
    """SELECT event_id, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS millis,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS moment FROM events""",
)
def event_time_from_millis(spark, sf_dir):
    millis = to_millis("ts").cast("string")
    return (
        _events(spark, sf_dir)
        .select("event_id", millis.alias("millis"))
        .withColumn(
            "moment", F.date_format(event_time("millis"), "yyyy-MM-dd HH:mm:ss.SSS")
        )
    )


@query(
    "timestamp_text",
    """SELECT event_id, CAST(ts AS VARCHAR) AS with_fraction,
  strftime(ts, '%Y-%m-%d %H:%M:%S') || '.0' AS whole_seconds,
  strftime(ts, '%Y-%m-%d %H:%M:%S') || '.0' AS reread
FROM events""",
)
def timestamp_text_(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id",
        timestamp_text("ts").alias("with_fraction"),
        timestamp_text(F.date_trunc("second", "ts")).alias("whole_seconds"),
        timestamp_text(to_time(date_text("ts", with_time=True))).alias("reread"),
    )


@query(
    "money_text",
    """SELECT event_id, printf('%.2f', value / 8) AS eighth, printf('%.2f', value) AS plain,
  CAST(printf('%.2f', value) AS DECIMAL(18,2)) AS amount FROM events""",
)
def money_text_(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id",
        money_text(F.col("value") / 8).alias("eighth"),
        money_text("value").alias("plain"),
        money(money_text("value")).alias("amount"),
    )


@query(
    "dt_partition",
    """SELECT event_id, strftime(CAST(ts AS DATE) - 8, '%Y%m%d') AS dt,
  strftime(ts, '%Y-%m-%d') AS day_text, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second_text
FROM events""",
)
def dt_partition(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id",
        partition_date("ts").alias("dt"),
        date_text("ts").alias("day_text"),
        date_text("ts", with_time=True).alias("second_text"),
    )


_ADDRESS = "CAST(event_id * 2654435761 % 4294967296 AS BIGINT)"


@query(
    "int_to_ipv4",
    f"""SELECT event_id, ({_ADDRESS} >> 24) || '.' || (({_ADDRESS} >> 16) & 255) || '.'
  || (({_ADDRESS} >> 8) & 255) || '.' || ({_ADDRESS} & 255) AS ip FROM events""",
)
def int_to_ipv4_(spark, sf_dir):
    bits = F.pmod(F.col("event_id") * 2654435761, F.lit(4294967296))
    signed = F.when(bits >= 2147483648, bits - 4294967296).otherwise(bits)
    return _events(spark, sf_dir).select("event_id", int_to_ipv4(signed).alias("ip"))
