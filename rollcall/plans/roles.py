"""The warehouse's inputs taken from the driver tables.

Events supply the facts (sign-ups are members, views are registrations,
purchases are payments) and the arrival order; nations, suppliers and regions
supply the ad, site and vip dimensions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollcall.functions import int_to_ipv4, money_text, record_json
from rollcall.schemas import BASE_AD, BASE_SITE, BASE_VIP, MEMBER, PAYMONEY, REGTYPE, RecordSpec
from rollcall.sources.typed import typed_columns, with_window

# Windows of the join queries; sign-ups, views and purchases of one member
# rarely fall into the same ten minutes in these tables.
WINDOW = "1 day"
DIM_SITES = ("webA", "webB")
FIRST_ADDRESS = 607649792
DASH = "'-'"

ROLE_OF_EVENT = {"signup": MEMBER, "view": REGTYPE, "purchase": PAYMONEY}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Wire fields as SQL over an event; fields not named are a dash.
_COMMON = {
    "uid": "string(user_id)",
    "dt": "date_format(ts, 'yyyyMMdd')",
    "dn": "concat('web', substring('ABC', int(user_id % 3) + 1, 1))",
}
_MILLIS = "string(unix_millis(timestamp(ts)))"
_FACT_SQL = {
    "member": {
        "ad_id": "string(user_id % 30)",
        "birthday": "date_format(date_add(date'1960-01-01', int(user_id * 37 % 14610)), 'yyyy-MM-dd')",
        "email": "concat('u', user_id, '@example.org')",
        "fullname": "concat('成员', user_id)",
        "memberlevel": "string(user_id % 8 + 1)",
        "register": _MILLIS,
    },
    "memberregtype": {
        "appregurl": "concat('u', event_id)",
        "createtime": _MILLIS,
        "regsource": "string(event_id % 5)",
        "websiteid": "string(user_id % 5)",
    },
    "memberpaymoney": {
        "siteid": "string(user_id % 110)",
        "vip_id": "string(event_id % 6)",
        "createtime": _MILLIS,
    },
}
# Wire fields as SQL over a dimension's id, name and dn.
_DIM_SQL = {
    "adid": "string(id)",
    "adname": "name",
    "siteid": "string(id)",
    "sitename": "name",
    "siteurl": "concat(name, '/', dn)",
    "delete": "'0'",
    "createtime": "'2000-01-01'",
    "creator": "'admin'",
    "vip_id": "string(id)",
    "vip_level": "name",
    "start_time": "concat(date_format(date_add(date'2015-01-01', int(id)), 'yyyy-MM-dd'), ' 00:00:00')",
    "end_time": "concat(date_format(date_add(date'2016-01-01', int(id)), 'yyyy-MM-dd'), ' 12:30:00')",
    "last_modify_time": "concat(date_format(date_add(date'2019-06-01', int(id)), 'yyyy-MM-dd'), ' 08:15:30')",
    "operator": "'update'",
    "dn": "dn",
}


def fact_fields(spec: RecordSpec) -> list[Column]:
    """Wire fields, all text, of a fact made from an event."""
    made = {
        "userip": int_to_ipv4(F.col("user_id") + FIRST_ADDRESS) if spec is MEMBER else None,
        "paymoney": money_text("value") if spec is PAYMONEY else None,
    }
    sql = {**_FACT_SQL[spec.topic], **_COMMON}
    return [
        made[f].alias(f) if made.get(f) is not None else F.expr(f"{sql.get(f, DASH)} AS {f}")
        for f in spec.fields
    ]


def dim_fields(spec: RecordSpec) -> list[Column]:
    """Wire fields of a dimension row made from ``id``, ``name`` and ``dn``."""
    return [F.expr(f"{_DIM_SQL.get(f, DASH)} AS `{f}`") for f in spec.fields]


def events_of(spark, sf_dir: str, spec: RecordSpec) -> DataFrame:
    kind = next(k for k, s in ROLE_OF_EVENT.items() if s is spec)
    return table(spark, sf_dir, "events").where(F.col("event_type") == kind)


def facts(spark, sf_dir: str, spec: RecordSpec, window: str | None = WINDOW) -> DataFrame:
    """Typed facts with ``seq``, ``ts`` and their window."""
    wire = events_of(spark, sf_dir, spec).select(*fact_fields(spec), F.col("event_id").alias("seq"))
    typed = wire.select(*typed_columns(spec), "seq")
    return with_window(typed, spec, window) if window else typed


_DIM_SOURCE = {
    "basead": ("nation", "n_nationkey", "n_name"),
    "basewebsite": ("supplier", "s_suppkey", "s_name"),
    "membervip": ("region", "r_regionkey", "r_name"),
}
DIM_SPECS = {s.topic: s for s in (BASE_AD, BASE_SITE, BASE_VIP)}


def dim_wire(spark, sf_dir: str, topic: str) -> DataFrame:
    """Dimension rows, all text, for two of the three site groups."""
    name, key, label = _DIM_SOURCE[topic]
    base = table(spark, sf_dir, name).select(
        F.col(key).cast("bigint").alias("id"),
        F.col(label).alias("name"),
        F.posexplode(F.array(*[F.lit(s) for s in DIM_SITES])).alias("_pos", "dn"),
    )
    return base.select(*dim_fields(DIM_SPECS[topic]), (F.col("id") * 2 + F.col("_pos")).alias("seq"))


def dim(spark, sf_dir: str, topic: str) -> DataFrame:
    wire = dim_wire(spark, sf_dir, topic)
    return wire.select(*typed_columns(DIM_SPECS[topic]), "seq")


def dims(spark, sf_dir: str) -> dict[str, DataFrame]:
    return {topic: dim(spark, sf_dir, topic) for topic in DIM_SPECS}


def fact_envelope(spark, sf_dir: str) -> DataFrame:
    """One scan of the events: facts, planted bad values, and an unknown topic."""
    kind = F.col("event_type")
    topic = F.when(kind == "click", F.lit("click"))
    value = F.when(kind == "click", F.col("props"))
    for name, spec in ROLE_OF_EVENT.items():
        topic = topic.when(kind == name, F.lit(spec.topic))
        value = value.when(kind == name, record_json(*fact_fields(spec)))
    bad = F.element_at(
        F.array(*[F.lit(v) for v in ("[1]", "null", "{bad", "5", "{}")]),
        (F.col("event_id") % 5 + 1).cast("int"),
    )
    # A generator makes each text once, as if it were a column of a stored log;
    # otherwise filters on it would make it again.
    return table(spark, sf_dir, "events").select(
        topic.otherwise(F.lit("member")).alias("topic"),
        F.explode(F.array(value.otherwise(bad))).alias("value"),
        F.col("event_id").alias("seq"),
    )


def dim_envelope(spark, sf_dir: str) -> DataFrame:
    frames = []
    for topic in DIM_SPECS:
        wire = dim_wire(spark, sf_dir, topic)
        fields = [c for c in wire.columns if c != "seq"]
        frames.append(
            wire.select(F.lit(topic).alias("topic"), record_json(*fields).alias("value"), "seq")
        )
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def envelope(spark, sf_dir: str) -> DataFrame:
    return fact_envelope(spark, sf_dir).unionByName(dim_envelope(spark, sf_dir))
