"""Sources, filters, routing and point reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.operators.route import (
    dimension_side, fact_side, is_dimension, keep_json_objects, quarantine, to_second_layer,
)
from rollcall.plans import roles
from rollcall.plans.base_sql import DIMS, FACTS, with_
from rollcall.plans.registry import query
from rollcall.schemas import BASE_AD, BASE_SITE, MEMBER, MEMBER_COLUMNS, PAYMONEY, REGTYPE
from rollcall.session import scratch_dir
from rollcall.sinks.dims import by_rowkey, put_by_rowkey
from rollcall.sources.envelope import decode
from rollcall.sources.tables import scan_many_rowkeys, scan_rowkeys, scan_where
from rollcall.sources.typed import parse_record


def _json(fields: str) -> str:
    pairs = ", ".join(f"'{f}', \"{f}\"" for f in fields.split())
    return f"CAST(json_object({pairs}) AS VARCHAR)"


ENVELOPE = f"""
wire_member AS (
  SELECT member_seq AS seq, CAST(uid AS VARCHAR) AS uid, CAST(ad_id AS VARCHAR) AS ad_id, birthday,
         email, fullname, iconurl, lastlogin, mailaddr, memberlevel, password, '-' AS paymoney,
         phone, qq, register, regupdatetime, unitname, userip, zipcode, dt, dn
  FROM member),
wire_regtype AS (SELECT regtype_seq AS seq, * REPLACE (CAST(uid AS VARCHAR) AS uid) FROM regtype),
wire_pay AS (
  SELECT paymoney_seq AS seq, * REPLACE (CAST(uid AS VARCHAR) AS uid,
         CAST(siteid AS VARCHAR) AS siteid, CAST(vip_id AS VARCHAR) AS vip_id)
  FROM pay),
env AS (
  SELECT 'member' AS topic, {_json(' '.join(MEMBER.fields))} AS value, seq FROM wire_member
  UNION ALL
  SELECT 'memberregtype', {_json(' '.join(REGTYPE.fields))}, seq FROM wire_regtype
  UNION ALL
  SELECT 'memberpaymoney', {_json(' '.join(PAYMONEY.fields))}, seq FROM wire_pay
  UNION ALL
  SELECT 'click', props, event_id FROM events WHERE event_type = 'click'
  UNION ALL
  SELECT 'member', ['[1]', 'null', '{{bad', '5', '{{}}'][CAST(event_id % 5 AS INTEGER) + 1], event_id
  FROM events WHERE event_type = 'error'
  UNION ALL
  SELECT 'basead', '{{}}', seq FROM ad
  UNION ALL
  SELECT 'basewebsite', '{{}}', seq FROM site
  UNION ALL
  SELECT 'membervip', '{{}}', seq FROM vip),
kept AS (
  SELECT * FROM env
  WHERE CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE false END)
"""


@query(
    "src_envelope_counts",
    with_(FACTS, DIMS, ENVELOPE) + "SELECT topic, count(*) AS n FROM env GROUP BY topic",
)
def src_envelope_counts(spark, sf_dir):
    return roles.envelope(spark, sf_dir).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query(
    "src_member_typed",
    with_(FACTS)
    + f"SELECT uid, {', '.join(MEMBER_COLUMNS)}, dn, member_seq AS seq FROM member",
)
def src_member_typed(spark, sf_dir):
    return parse_record(roles.fact_envelope(spark, sf_dir), MEMBER).select("uid", *MEMBER_COLUMNS, "dn", "seq")


@query(
    "src_regtype_typed",
    with_(FACTS)
    + "SELECT uid, appkey, appregurl, bdp_uuid, createtime, isranreg, regsource, websiteid, dt, dn,"
    " regtype_seq AS seq FROM regtype",
)
def src_regtype_typed(spark, sf_dir):
    return parse_record(roles.fact_envelope(spark, sf_dir), REGTYPE)


@query(
    "src_paymoney_typed",
    with_(FACTS)
    + "SELECT uid, paymoney, siteid, vip_id, createtime, dt, dn, paymoney_seq AS seq FROM pay",
)
def src_paymoney_typed(spark, sf_dir):
    return parse_record(roles.fact_envelope(spark, sf_dir), PAYMONEY)


@query(
    "src_dims_typed",
    with_(DIMS)
    + """SELECT 'basead' AS topic, adid AS id, adname AS name, dn, NULL AS siteurl,
       CAST(NULL AS VARCHAR) AS start_time FROM ad
UNION ALL SELECT 'basewebsite', siteid, sitename, dn, siteurl, NULL FROM site
UNION ALL SELECT 'membervip', vip_id, vip_level, dn, NULL, start_time FROM vip""",
)
def src_dims_typed(spark, sf_dir):
    envelope = roles.dim_envelope(spark, sf_dir)
    shapes = {
        "basead": ("adid", "adname", None, None),
        "basewebsite": ("siteid", "sitename", "siteurl", None),
        "membervip": ("vip_id", "vip_level", None, "start_time"),
    }
    frames = []
    for topic, (key, name, url, start) in shapes.items():
        frames.append(
            parse_record(envelope, roles.DIM_SPECS[topic]).select(
                F.lit(topic).alias("topic"),
                F.col(key).alias("id"),
                F.col(name).alias("name"),
                "dn",
                (F.col(url) if url else F.lit(None).cast("string")).alias("siteurl"),
                (F.col(start) if start else F.lit(None).cast("string")).alias("start_time"),
            )
        )
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("filter_json_objects", with_(FACTS, DIMS, ENVELOPE) + "SELECT topic, seq FROM kept")
def filter_json_objects(spark, sf_dir):
    return keep_json_objects(roles.envelope(spark, sf_dir)).select("topic", "seq")


@query(
    "route_counts",
    with_(FACTS, DIMS, ENVELOPE)
    + """SELECT topic, CASE WHEN topic IN ('basead', 'basewebsite', 'membervip') THEN 'dimension'
       ELSE 'fact' END AS side, count(*) AS n FROM kept GROUP BY 1, 2""",
)
def route_counts(spark, sf_dir):
    kept = keep_json_objects(roles.envelope(spark, sf_dir))
    side = F.when(is_dimension(), F.lit("dimension")).otherwise(F.lit("fact"))
    return kept.groupBy("topic", side.alias("side")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "route_facts",
    with_(FACTS, DIMS, ENVELOPE)
    + "SELECT topic, seq FROM kept WHERE topic NOT IN ('basead', 'basewebsite', 'membervip')",
)
def route_facts(spark, sf_dir):
    return fact_side(keep_json_objects(roles.envelope(spark, sf_dir))).select("topic", "seq")


@query(
    "route_dims",
    with_(FACTS, DIMS, ENVELOPE)
    + "SELECT topic, seq FROM kept WHERE topic IN ('basead', 'basewebsite', 'membervip')",
)
def route_dims(spark, sf_dir):
    return dimension_side(keep_json_objects(roles.envelope(spark, sf_dir))).select("topic", "seq")


@query(
    "sink_dwd_topic",
    with_(FACTS, DIMS, ENVELOPE)
    + """SELECT 'dwd' || topic AS topic, CAST(NULL AS VARCHAR) AS key, value, seq FROM kept
       WHERE topic NOT IN ('basead', 'basewebsite', 'membervip')""",
)
def sink_dwd_topic(spark, sf_dir):
    return to_second_layer(fact_side(keep_json_objects(roles.envelope(spark, sf_dir))))


BAD_ROWS = """SELECT topic, seq, CASE WHEN value = '{}' THEN 'no uid' ELSE 'not a json object' END AS reason
FROM env WHERE topic = 'member' AND (NOT json_valid(value) OR json_type(value) <> 'OBJECT' OR value = '{}')"""


@query(
    "src_envelope_decoded",
    """SELECT event_type AS topic, event_id * 65536 + event_id % 8 AS seq,
  CASE WHEN event_id % 10 = 0 THEN props || chr(65533) ELSE props END AS value FROM events""",
)
def src_envelope_decoded(spark, sf_dir):
    """Rows as a log reader gives them, every tenth with a byte that is no text."""
    text = F.col("props").cast("binary")
    broken = F.concat(text, F.unhex(F.lit("FF")))
    log = roles.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"),
        F.when(F.col("event_id") % 10 == 0, broken).otherwise(text).alias("value"),
        (F.col("event_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    return decode(log)


@query("quarantine_rows", with_(FACTS, DIMS, ENVELOPE) + BAD_ROWS)
def quarantine_rows(spark, sf_dir):
    return quarantine(roles.envelope(spark, sf_dir)).select("topic", "seq", "reason")


@query(
    "scan_dim_point",
    with_(DIMS)
    + """SELECT sitename, siteurl, "delete", createtime, creator FROM site
       WHERE siteid = 7 AND dn = 'webA'""",
)
def scan_dim_point(spark, sf_dir):
    """One site out of the stored site table; the test reaches the Parquet scan."""
    table = _stored_sites(spark, sf_dir)
    columns = ["sitename", "siteurl", "delete", "createtime", "creator"]
    return scan_where(table, columns, siteid=7, dn="webA")


def _stored_sites(spark, sf_dir):
    path = scratch_dir(spark, "sites")
    return put_by_rowkey(roles.dim(spark, sf_dir, "basewebsite"), BASE_SITE, path)


@query(
    "scan_dim_by_rowkey",
    with_(DIMS)
    + """SELECT siteid || '_' || dn AS rowkey, sitename, siteurl, creator FROM site
       WHERE siteid || '_' || dn IN ('3_webA', '8_webB')""",
)
def scan_dim_by_rowkey(spark, sf_dir):
    table = _stored_sites(spark, sf_dir)
    return scan_rowkeys(table, ["3_webA", "8_webB"], ["sitename", "siteurl", "creator"])


@query(
    "scan_many_rowkeys",
    """WITH o AS (
  SELECT CAST(o_orderkey AS INTEGER) AS adid, o_orderpriority AS adname,
         'web' || substr('ABC', CAST(o_custkey % 3 AS INTEGER) + 1, 1) AS dn, o_orderdate FROM orders)
SELECT adid || '_' || dn AS rowkey, adname FROM o ORDER BY o_orderdate DESC, adid LIMIT 1000""",
)
def scan_many_rowkeys_query(spark, sf_dir):
    """The rows of the 1,000 newest orders out of a table of all orders by row key."""
    orders = roles.table(spark, sf_dir, "orders").selectExpr(
        "int(o_orderkey) AS adid", "o_orderpriority AS adname",
        "concat('web', substring('ABC', int(o_custkey % 3) + 1, 1)) AS dn", "o_orderdate",
    )
    stored = put_by_rowkey(orders.drop("o_orderdate"), BASE_AD, scratch_dir(spark, "many-rowkeys"))
    newest = orders.orderBy(F.desc("o_orderdate"), "adid").limit(1000)
    return scan_many_rowkeys(stored, by_rowkey(newest, BASE_AD), ["adname"])
