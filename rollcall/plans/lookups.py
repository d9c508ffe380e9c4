"""Dimension lookups and the wide member row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollcall.operators.lookup import AD_LOOKUP, SITE_LOOKUP, VIP_LOOKUP, enrich, fill_blank, lookup
from rollcall.operators.route import dimension_side, fact_side
from rollcall.operators.wide import full_row, join_facts, wide_row
from rollcall.plans import roles
from rollcall.plans.base_sql import DIMS, FACTS, FIRST_LEFT, WIDE_SELECT, looked_up, with_
from rollcall.plans.joins import facts
from rollcall.plans.registry import query
from rollcall.schemas import FULL_COLUMNS, MEMBER, PAYMONEY, REGTYPE
from rollcall.session import staged
from rollcall.sources.typed import parse_record, with_window

_SEQS = ("member_seq", "regtype_seq", "paymoney_seq")
_SITE_COLUMNS = "sitename, siteurl, \"delete\", site_createtime, site_creator"
_VIP_COLUMNS = (
    "vip_level, vip_start_time, vip_end_time, last_modify_time, max_free, min_free, "
    "next_level, operator"
)
ENRICHED = with_(FACTS, FIRST_LEFT, DIMS, looked_up("f2"))


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as other engines store them."""
    return df.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def _list(columns: str) -> list[str]:
    return [c.strip().strip('"') for c in columns.split(",")]


def joined_and_looked_up(spark, sf_dir) -> DataFrame:
    return enrich(join_facts(*facts(spark, sf_dir)), roles.dims(spark, sf_dir))


@query(
    "dim_lookup_ad",
    with_(FACTS, DIMS)
    + """SELECT m.uid, m.dn, m.ad_id, m.member_seq AS seq, a.adname FROM member m
LEFT JOIN ad a ON m.ad_id = a.adid AND m.dn = a.dn""",
)
def dim_lookup_ad(spark, sf_dir):
    members = roles.facts(spark, sf_dir, MEMBER, window=None).select("uid", "dn", "ad_id", "seq")
    return lookup(members, roles.dim(spark, sf_dir, "basead"), AD_LOOKUP)


@query(
    "dim_lookup_site",
    with_(FACTS, DIMS)
    + """SELECT p.uid, p.dn, p.siteid, p.paymoney_seq AS seq, s.sitename, s.siteurl, s."delete",
  s.createtime AS site_createtime, s.creator AS site_creator FROM pay p
LEFT JOIN site s ON p.siteid = s.siteid AND p.dn = s.dn""",
)
def dim_lookup_site(spark, sf_dir):
    payments = roles.facts(spark, sf_dir, PAYMONEY, window=None)
    return lookup(
        payments.select("uid", "dn", "siteid", "seq"),
        roles.dim(spark, sf_dir, "basewebsite"),
        SITE_LOOKUP,
    )


@query(
    "dim_lookup_site_shuffled",
    with_(FACTS, DIMS)
    + """SELECT p.uid, p.dn, p.siteid, p.paymoney_seq AS seq, s.sitename FROM pay p
LEFT JOIN site s ON p.siteid = s.siteid AND p.dn = s.dn""",
)
def dim_lookup_site_shuffled(spark, sf_dir):
    """The way of a dimension too large to broadcast, hot ids cut into parts."""
    payments = roles.facts(spark, sf_dir, PAYMONEY, window=None)
    found = lookup(
        payments.select("uid", "dn", "siteid", "seq"),
        roles.dim(spark, sf_dir, "basewebsite"),
        SITE_LOOKUP,
        max_rows=0,
        rows_per_task=10,
    )
    return found.select("uid", "dn", "siteid", "seq", "sitename")


@query(
    "dim_lookup_vip",
    with_(FACTS, DIMS)
    + """SELECT p.uid, p.dn, p.vip_id, p.paymoney_seq AS seq, v.vip_level,
  v.start_time AS vip_start_time, v.end_time AS vip_end_time, v.last_modify_time, v.max_free,
  v.min_free, v.next_level, v.operator FROM pay p
LEFT JOIN vip v ON p.vip_id = v.vip_id AND p.dn = v.dn""",
)
def dim_lookup_vip(spark, sf_dir):
    payments = roles.facts(spark, sf_dir, PAYMONEY, window=None)
    return lookup(
        payments.select("uid", "dn", "vip_id", "seq"),
        roles.dim(spark, sf_dir, "membervip"),
        VIP_LOOKUP,
    )


@query(
    "dim_lookup_all",
    ENRICHED
    + f"SELECT uid, dn, {', '.join(_SEQS)}, adname, {_SITE_COLUMNS}, {_VIP_COLUMNS} FROM e",
)
def dim_lookup_all(spark, sf_dir):
    return joined_and_looked_up(spark, sf_dir).select(
        "uid", "dn", *_SEQS, "adname", *_list(_SITE_COLUMNS), *_list(_VIP_COLUMNS)
    )


@query(
    "dim_lookup_missing_ids",
    with_(FACTS, DIMS)
    + """SELECT p.uid, p.dn, p.paymoney_seq AS seq, s.sitename, v.vip_level
FROM (SELECT *, CASE WHEN paymoney_seq % 7 <> 0 THEN siteid END AS site_or_null,
        CASE WHEN uid % 2 = 0 THEN vip_id END AS vip_or_null FROM pay) p
LEFT JOIN site s ON p.site_or_null = s.siteid AND p.dn = s.dn
LEFT JOIN vip v ON p.vip_or_null = v.vip_id AND p.dn = v.dn""",
)
def dim_lookup_missing_ids(spark, sf_dir):
    """Blank and unknown ids stay in the output without a match."""
    payments = roles.facts(spark, sf_dir, PAYMONEY, window=None).select("uid", "dn", "siteid", "vip_id", "seq")
    blanked = payments.withColumns(
        {
            "siteid": F.when(F.col("seq") % 7 != 0, F.col("siteid")),
            "vip_id": F.when(F.col("uid") % 2 == 0, F.col("vip_id")),
        }
    )
    found = enrich(blanked, roles.dims(spark, sf_dir), specs=(SITE_LOOKUP, VIP_LOOKUP))
    return found.select("uid", "dn", "seq", "sitename", "vip_level")


_BLANKS = (
    "appkey", "appregurl", "bdp_uuid", "createtime", "isranreg", "regsource", "websiteid",
    "paymoney", "siteid", "vip_id", "sitename", "vip_level",
)


@query(
    "fill_blank_defaults",
    ENRICHED
    + "SELECT uid, dn, member_seq, "
    + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}" for c in _BLANKS)
    + " FROM e",
)
def fill_blank_defaults(spark, sf_dir):
    found = joined_and_looked_up(spark, sf_dir)
    return fill_blank(found.select("uid", "dn", "member_seq", *_BLANKS), _BLANKS)


@query("dws_member_wide", ENRICHED + f"SELECT {WIDE_SELECT}, {', '.join(_SEQS)} FROM e")
def dws_member_wide(spark, sf_dir):
    """Log envelopes to wide rows: filter, route, parse, join, look up, project.

    The parsed facts are stored: the join reads their keys more than once.
    """
    fact_rows = fact_side(roles.fact_envelope(spark, sf_dir))
    dim_rows = dimension_side(roles.dim_envelope(spark, sf_dir))
    typed = [
        with_window(staged(parse_record(fact_rows, s), s.topic), s, roles.WINDOW)
        for s in (MEMBER, REGTYPE, PAYMONEY)
    ]
    dims = {t: parse_record(dim_rows, s) for t, s in roles.DIM_SPECS.items()}
    return plain_times(wide_row(enrich(join_facts(*typed), dims), carry=_SEQS))


@query(
    "dws_member_zero_ids",
    ENRICHED
    + f"""SELECT uid, dn, member_seq, coalesce(siteid, 0) AS siteid, coalesce(vip_id, 0) AS vip_id
FROM e""",
)
def dws_member_zero_ids(spark, sf_dir):
    """Wide rows that store a missing site or vip id as zero."""
    rows = wide_row(
        joined_and_looked_up(spark, sf_dir), missing_id_as_zero=True, carry=["member_seq"]
    )
    return rows.select("uid", "dn", "member_seq", "siteid", "vip_id")


@query(
    "member_full_record",
    ENRICHED
    + "SELECT "
    + ", ".join(
        "createtime AS regtype_createtime" if c == "regtype_createtime" else c for c in FULL_COLUMNS
    )
    + ", member_seq FROM e",
)
def member_full_record(spark, sf_dir):
    return full_row(joined_and_looked_up(spark, sf_dir), carry=["member_seq"])
