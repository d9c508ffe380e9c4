"""Windowed joins of the facts, and window aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollcall.operators.changelog import arrival_changelog, arrival_changelog_twice
from rollcall.operators.join import windowed_left_join
from rollcall.operators.sessions import session_counts, sliding_counts
from rollcall.operators.wide import join_facts, member_side, paymoney_side, regtype_side
from rollcall.plans import roles
from rollcall.plans.base_sql import FACTS, FIRST_LEFT, LEFT_OUTER, with_
from rollcall.plans.registry import query
from rollcall.schemas import MEMBER, PAYMONEY, REGTYPE

_START = "strftime(win, '%Y-%m-%d %H:%M:%S') AS window_start"
_PAIR = "uid, dn, member_seq, regtype_seq, register, fullname, appregurl, websiteid, createtime"
_TRIPLE = _PAIR + ", paymoney, siteid, vip_id, paymoney_seq"


def window_start():
    return F.date_format(F.col("window.start"), "yyyy-MM-dd HH:mm:ss").alias("window_start")


def _shown(df: DataFrame, columns: str) -> DataFrame:
    return df.select(*[c.strip() for c in columns.split(",")], window_start())


def facts(spark, sf_dir, window=roles.WINDOW):
    return [roles.facts(spark, sf_dir, s, window) for s in (MEMBER, REGTYPE, PAYMONEY)]


@query("join_member_regtype", with_(FACTS, LEFT_OUTER) + f"SELECT {_PAIR}, {_START} FROM j1")
def join_member_regtype(spark, sf_dir):
    members, regtypes, _ = facts(spark, sf_dir)
    joined = windowed_left_join(
        member_side(members), regtype_side(regtypes), multiplicity="left_outer"
    )
    return _shown(joined, _PAIR)


@query(
    "join_member_regtype_paymoney",
    with_(FACTS, LEFT_OUTER) + f"SELECT {_TRIPLE}, {_START} FROM j2",
)
def join_member_regtype_paymoney(spark, sf_dir):
    return _shown(join_facts(*facts(spark, sf_dir), multiplicity="left_outer"), _TRIPLE)


@query("join_first_left", with_(FACTS, FIRST_LEFT) + f"SELECT {_PAIR}, {_START} FROM f1")
def join_first_left(spark, sf_dir):
    members, regtypes, _ = facts(spark, sf_dir)
    return _shown(windowed_left_join(member_side(members), regtype_side(regtypes)), _PAIR)


@query(
    "join_first_left_paymoney",
    with_(FACTS, FIRST_LEFT) + f"SELECT {_TRIPLE}, {_START} FROM f2",
)
def join_first_left_paymoney(spark, sf_dir):
    return _shown(join_facts(*facts(spark, sf_dir)), _TRIPLE)


# With these bounds most groups count as hot.
TINY_TASKS = 2
TINY_STRETCH = 100


@query("join_first_left_split", with_(FACTS, FIRST_LEFT) + f"SELECT {_TRIPLE}, {_START} FROM f2")
def join_first_left_split(spark, sf_dir):
    """The first-left join with groups cut into parts."""
    return _shown(join_facts(*facts(spark, sf_dir), rows_per_task=TINY_TASKS), _TRIPLE)


@query("join_left_outer_split", with_(FACTS, LEFT_OUTER) + f"SELECT {_TRIPLE}, {_START} FROM j2")
def join_left_outer_split(spark, sf_dir):
    """The chain of left joins with groups cut into a grid of parts."""
    joined = join_facts(
        *facts(spark, sf_dir), multiplicity="left_outer", rows_per_task=TINY_TASKS
    )
    return _shown(joined, _TRIPLE)


# The ten-minute windows of the fact join, on which few rows meet in these tables.
_TEN = (
    FACTS.replace("date_trunc('day', ts)", "time_bucket(INTERVAL 10 MINUTE, ts)")
)


@query(
    "join_ten_minutes",
    with_(_TEN, FIRST_LEFT) + f"SELECT {_TRIPLE}, {_START} FROM f2",
)
def join_ten_minutes(spark, sf_dir):
    return _shown(join_facts(*facts(spark, sf_dir, window="10 minutes")), _TRIPLE)


CHANGELOG = """
arrivals AS (
  SELECT uid, dn, win, member_seq AS seq, true AS is_left FROM member
  UNION ALL
  SELECT uid, dn, win, regtype_seq, false FROM regtype),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY uid, dn, win ORDER BY seq) AS a FROM arrivals),
firsts AS (
  SELECT uid, dn, win, min(CASE WHEN is_left THEN a END) AS left_a,
         min(CASE WHEN NOT is_left THEN a END) AS right_a,
         min(CASE WHEN is_left THEN seq END) AS left_seq
  FROM numbered GROUP BY uid, dn, win),
emitted AS (
  SELECT f.uid, f.dn, f.win, f.left_seq AS member_seq, r.seq AS regtype_seq, e.a
  FROM numbered r JOIN firsts f ON f.uid = r.uid AND f.dn = r.dn AND f.win = r.win
  JOIN numbered e ON e.uid = r.uid AND e.dn = r.dn AND e.win = r.win
  WHERE NOT r.is_left AND e.a >= r.a AND e.a >= f.left_a
  UNION ALL
  SELECT l.uid, l.dn, l.win, l.seq, NULL, e.a
  FROM numbered l JOIN firsts f ON f.uid = l.uid AND f.dn = l.dn AND f.win = l.win
  JOIN numbered e ON e.uid = l.uid AND e.dn = l.dn AND e.win = l.win
  WHERE l.is_left AND e.a >= l.a AND (f.right_a IS NULL OR e.a < f.right_a))
"""


@query(
    "join_arrival_changelog",
    with_(FACTS, CHANGELOG)
    + f"""SELECT uid, dn, {_START}, member_seq, regtype_seq, min(a) AS first_arrival,
  max(a) AS last_arrival, count(*) AS emissions
FROM emitted GROUP BY uid, dn, win, member_seq, regtype_seq""",
)
def join_arrival_changelog(spark, sf_dir):
    members, regtypes, _ = facts(spark, sf_dir)
    log = arrival_changelog(member_side(members), regtype_side(regtypes))
    columns = "uid, dn, member_seq, regtype_seq, first_arrival, last_arrival, emissions"
    return _shown(log, columns)


@query(
    "join_arrival_changelog_stretches",
    with_(FACTS, CHANGELOG)
    + f"""SELECT uid, dn, {_START}, member_seq, regtype_seq, min(a) AS first_arrival,
  max(a) AS last_arrival, count(*) AS emissions
FROM emitted GROUP BY uid, dn, win, member_seq, regtype_seq""",
)
def join_arrival_changelog_stretches(spark, sf_dir):
    """The changelog with arrivals numbered in short stretches."""
    members, regtypes, _ = facts(spark, sf_dir)
    log = arrival_changelog(
        member_side(members), regtype_side(regtypes), arrivals_per_chunk=TINY_STRETCH
    )
    columns = "uid, dn, member_seq, regtype_seq, first_arrival, last_arrival, emissions"
    return _shown(log, columns)


# The second join's arrivals: what the first one emits at each of its arrivals, and the payments between.
CHANGELOG_TWICE = """
first_left AS (
  SELECT uid, dn, win, min(member_seq) AS head FROM member GROUP BY ALL),
fired AS (
  SELECT uid, dn, win, member_seq AS tick FROM member UNION ALL SELECT uid, dn, win, regtype_seq FROM regtype),
emitted1 AS (
  SELECT f.uid, f.dn, f.win, f.tick, m.member_seq, NULL::BIGINT AS regtype_seq
  FROM fired f JOIN member m ON f.uid = m.uid AND f.dn = m.dn AND f.win = m.win AND m.member_seq <= f.tick
  WHERE NOT EXISTS (SELECT 1 FROM regtype r WHERE r.uid = f.uid AND r.dn = f.dn AND r.win = f.win AND r.regtype_seq <= f.tick)
  UNION ALL
  SELECT f.uid, f.dn, f.win, f.tick, h.head, r.regtype_seq
  FROM fired f JOIN first_left h ON f.uid = h.uid AND f.dn = h.dn AND f.win = h.win AND h.head <= f.tick
  JOIN regtype r ON r.uid = f.uid AND r.dn = f.dn AND r.win = f.win AND r.regtype_seq <= f.tick),
elements AS (
  SELECT *, row_number() OVER (PARTITION BY uid, dn, win ORDER BY tick, member_seq, regtype_seq) AS n
  FROM (SELECT *, NULL::BIGINT AS paymoney_seq FROM emitted1
        UNION ALL SELECT uid, dn, win, paymoney_seq, NULL, NULL, paymoney_seq FROM pay)),
second_head AS (
  SELECT uid, dn, win, min(n) AS head FROM elements WHERE paymoney_seq IS NULL GROUP BY ALL),
emitted2 AS (
  SELECT f.uid, f.dn, f.win, f.n AS a, e.member_seq, e.regtype_seq, NULL::BIGINT AS paymoney_seq
  FROM elements f JOIN elements e ON f.uid = e.uid AND f.dn = e.dn AND f.win = e.win AND e.n <= f.n
  WHERE e.paymoney_seq IS NULL AND NOT EXISTS (
    FROM elements p WHERE p.uid = f.uid AND p.dn = f.dn AND p.win = f.win AND p.n <= f.n AND p.paymoney_seq IS NOT NULL)
  UNION ALL
  SELECT f.uid, f.dn, f.win, f.n, h.member_seq, h.regtype_seq, p.paymoney_seq
  FROM elements f JOIN second_head s ON f.uid = s.uid AND f.dn = s.dn AND f.win = s.win AND s.head <= f.n
  JOIN elements h ON h.uid = s.uid AND h.dn = s.dn AND h.win = s.win AND h.n = s.head
  JOIN elements p ON p.uid = f.uid AND p.dn = f.dn AND p.win = f.win AND p.n <= f.n AND p.paymoney_seq IS NOT NULL)
"""


@query(
    "join_arrival_changelog_paymoney",
    with_(FACTS, CHANGELOG_TWICE)
    + f"""SELECT uid, dn, {_START}, member_seq, regtype_seq, paymoney_seq, min(a) AS first_arrival,
  max(a) AS last_arrival, count(*) AS emissions
FROM emitted2 GROUP BY uid, dn, win, member_seq, regtype_seq, paymoney_seq""",
)
def join_arrival_changelog_paymoney(spark, sf_dir):
    """Both joins fire at every arrival; what the first one emits are arrivals of the second."""
    members, regtypes, payments = facts(spark, sf_dir)
    log = arrival_changelog_twice(member_side(members), regtype_side(regtypes), paymoney_side(payments))
    columns = "uid, dn, member_seq, regtype_seq, paymoney_seq, first_arrival, last_arrival, emissions"
    return _shown(log, columns)


_SITE = "'web' || substr('ABC', CAST(user_id % 3 AS INTEGER) + 1, 1)"


def _site_events(spark, sf_dir):
    dn = F.concat(F.lit("web"), F.substring(F.lit("ABC"), (F.col("user_id") % 3 + 1).cast("int"), 1))
    return roles.table(spark, sf_dir, "events").select(
        dn.alias("dn"), F.col("ts").cast("timestamp").alias("ts")
    )


def _text(moment):
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")


SLIDING_SQL = f"""WITH w AS (
  SELECT {_SITE} AS dn, time_bucket(INTERVAL 5 SECOND, ts) - INTERVAL 5 SECOND * k AS s
  FROM events, (SELECT unnest([0, 1]) AS k))
SELECT dn, strftime(s, '%Y-%m-%d %H:%M:%S.%f') AS window_start, count(*) AS n FROM w GROUP BY dn, s"""


@query("window_sliding_counts", SLIDING_SQL)
def window_sliding_counts(spark, sf_dir):
    return sliding_counts(_site_events(spark, sf_dir), ["dn"]).select(
        "dn", _text("window.start").alias("window_start"), "n"
    )


SESSION_SQL = f"""WITH e AS (SELECT {_SITE} AS dn, ts FROM events),
g AS (
  SELECT dn, ts, CASE WHEN ts <= lag(ts) OVER (PARTITION BY dn ORDER BY ts) + INTERVAL 5 SECOND
                      THEN 0 ELSE 1 END AS fresh FROM e),
s AS (SELECT dn, ts, sum(fresh) OVER (PARTITION BY dn ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT dn, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start,
  strftime(max(ts) + INTERVAL 5 SECOND, '%Y-%m-%d %H:%M:%S.%f') AS session_end, count(*) AS n
FROM s GROUP BY dn, k"""


@query("window_session_counts", SESSION_SQL)
def window_session_counts(spark, sf_dir):
    return session_counts(_site_events(spark, sf_dir), ["dn"]).select(
        "dn",
        _text("session.start").alias("session_start"),
        _text("session.end").alias("session_end"),
        "n",
    )


@query(
    "window_session_hours",
    f"""WITH e AS (SELECT {_SITE} AS dn, ts FROM events),
g AS (
  SELECT dn, ts, CASE WHEN ts <= lag(ts) OVER (PARTITION BY dn ORDER BY ts) + INTERVAL 20 MINUTE
                      THEN 0 ELSE 1 END AS fresh FROM e),
s AS (SELECT dn, ts, sum(fresh) OVER (PARTITION BY dn ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT dn, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start,
  strftime(max(ts) + INTERVAL 20 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS session_end, count(*) AS n
FROM s GROUP BY dn, k""",
)
def window_session_hours(spark, sf_dir):
    """Sessions with a gap of twenty minutes, most of which span several events."""
    found = session_counts(_site_events(spark, sf_dir), ["dn"], gap="20 minutes")
    return found.select(
        "dn",
        _text("session.start").alias("session_start"),
        _text("session.end").alias("session_end"),
        "n",
    )
