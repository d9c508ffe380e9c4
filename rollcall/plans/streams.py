"""Streaming forms of the operators, run over all rows of the tables.

Each query stages the events as log envelopes in the shared folder, lets the
stream read what is there, stages more, and lets it go on from its checkpoint.
A last row per topic, days past the newest event, moves the watermark over
the last window.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from rollcall.operators.join import Side
from rollcall.operators.lookup import SITE_LOOKUP, VIP_LOOKUP, lookup
from rollcall.operators.merge import MergeRules
from rollcall.operators.sessions import session_counts, sliding_counts
from rollcall.operators.wide import member_side, regtype_side, total_row, wide_row
from rollcall.functions import money, record_json, to_millis
from rollcall.plans import roles
from rollcall.plans.base_sql import DIMS, FACTS, FIRST_LEFT, LEFT_OUTER, WIDE_SELECT, looked_up, with_
from rollcall.plans.joins import (
    _PAIR, _START, _TRIPLE, CHANGELOG, SESSION_SQL, SLIDING_SQL, _shown, _site_events, _text,
)
from rollcall.plans.lookups import ENRICHED, plain_times
from rollcall.plans.registry import query
from rollcall.plans.scans import BAD_ROWS, ENVELOPE
from rollcall.plans.upserts import _FULL_NAMES, _KEPT, _ORDER_SQL, _TABLE_SQL, _last, _last_set, _names
from rollcall.schemas import MEMBER, PAYMONEY, REGTYPE, SECOND_LAYER_PREFIX
from rollcall.session import scratch_dir, stream_session
from rollcall.sinks.columns import OpenTable
from rollcall.sinks.dims import DimTables, lookup_form
from rollcall.sinks.table import KeyedTable
from rollcall.sinks.topics import file_writer
from rollcall.sources.envelope import file_envelope
from rollcall.sources.typed import parse_record
from rollcall.streaming.changelog import stream_changelog
from rollcall.streaming.facts import DELAY, stream_first_left_join, stream_left_join, watermarked
from rollcall.streaming.jobs import (
    ALL_AVAILABLE, closed_stream, first_left_of_closed, joined_stream, once_per_batch, start_columns, start_split,
    start_wide, total_table, wide_table,
)
from rollcall.streaming.refresh import DimSnapshots, TableSnapshots
from rollcall.streaming.retractions import folded, stream_changes

FACT_SPECS = (MEMBER, REGTYPE, PAYMONEY)
# Stage borders lie within a window, so that state is carried over a restart.
FIRST_BORDER, SECOND_BORDER = "2024-01-11 12:00:00", "2024-01-21 12:00:00"
LATENESS = "5 days"


class Stage:
    """Input folder, checkpoint and output of one streaming query."""

    def __init__(self, spark: SparkSession, sf_dir: str, label: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = scratch_dir(spark, label)
        self.stream = stream_session(spark)
        self.rounds = 0

    def put(self, spec, where=None) -> None:
        """Adds the events of a role, or some of them, as envelopes."""
        events = roles.events_of(self.spark, self.sf_dir, spec)
        if where is not None:
            events = events.where(where)
        rows = events.select(
            F.lit(spec.topic).alias("topic"),
            record_json(*roles.fact_fields(spec)).alias("value"),
            F.col("event_id").alias("seq"),
        )
        rows.write.mode("append").parquet(f"{self.root}/{spec.topic}")

    def close_windows(self, *specs, days: int = 2) -> None:
        """Adds a row some days past the newest event to each topic."""
        last = roles.table(self.spark, self.sf_dir, "events").agg(F.max("ts").alias("ts"))
        for number, spec in enumerate(specs, 1):
            moment = (to_millis("ts") + days * 24 * 60 * 60 * 1000).cast("string")
            fields = [
                F.lit(str(-number)).alias("uid"), F.lit("webA").alias("dn"),
                moment.alias(spec.event_time),
            ]
            rows = last.select(
                F.lit(spec.topic).alias("topic"),
                record_json(*fields).alias("value"),
                F.lit(-number).cast("bigint").alias("seq"),
            )
            rows.write.mode("append").parquet(f"{self.root}/{spec.topic}")

    def typed(self, spec) -> DataFrame:
        return parse_record(file_envelope(self.stream, f"{self.root}/{spec.topic}"), spec)

    def facts(self, spec, delay: str = DELAY) -> DataFrame:
        return watermarked(self.typed(spec), spec, roles.WINDOW, delay)

    def run(self, rows: DataFrame) -> None:
        """Processes what is there, going on from the last round."""
        (
            rows.writeStream.format("parquet")
            .option("path", f"{self.root}/out")
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(**ALL_AVAILABLE)
            .start()
            .awaitTermination()
        )

    def result(self, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/out")


def _plain_window(df: DataFrame) -> DataFrame:
    """Window bounds without the watermark mark, to be written to files."""
    return df.withColumn(
        "window", F.struct(F.col("window.start").alias("start"), F.col("window.end").alias("end"))
    )


def _pair(stage: Stage, delay: str = DELAY):
    return (
        member_side(stage.facts(MEMBER, delay)).df,
        regtype_side(stage.facts(REGTYPE, delay)).df,
    )


@query("stream_join_final", with_(FACTS, LEFT_OUTER) + f"SELECT {_TRIPLE}, {_START} FROM j2")
def stream_join_final(spark, sf_dir):
    stage = Stage(spark, sf_dir, "join-final")
    for spec in FACT_SPECS:
        stage.put(spec)
    rows = _plain_window(
        joined_stream(*[stage.facts(s) for s in FACT_SPECS], multiplicity="left_outer")
    )
    stage.run(rows)
    stage.close_windows(*FACT_SPECS)
    stage.run(rows)
    return _shown(stage.result(rows.schema), _TRIPLE)


@query("stream_join_first_left", with_(FACTS, FIRST_LEFT) + f"SELECT {_PAIR}, {_START} FROM f1")
def stream_join_first_left(spark, sf_dir):
    stage = Stage(spark, sf_dir, "join-first-left")
    for spec in (MEMBER, REGTYPE):
        stage.put(spec)
    rows = _plain_window(stream_first_left_join(member_side(stage.facts(MEMBER)), regtype_side(stage.facts(REGTYPE))))
    stage.run(rows)
    stage.close_windows(MEMBER, REGTYPE)
    stage.run(rows)
    return _shown(stage.result(rows.schema), _PAIR)


@query(
    "stream_first_left_paymoney",
    with_(FACTS, FIRST_LEFT) + f"SELECT {_TRIPLE}, {_START} FROM f2",
)
def stream_first_left_paymoney(spark, sf_dir):
    stage = Stage(spark, sf_dir, "first-left-paymoney")
    for spec in FACT_SPECS:
        stage.put(spec)
    rows = _plain_window(joined_stream(*[stage.facts(s) for s in FACT_SPECS]))
    stage.run(rows)
    stage.close_windows(*FACT_SPECS)
    stage.run(rows)
    return _shown(stage.result(rows.schema), _TRIPLE)


def _between(low: str | None, high: str | None):
    test = F.lit(True)
    if low:
        test = test & (F.col("ts") >= F.lit(low).cast("timestamp_ntz"))
    if high:
        test = test & (F.col("ts") < F.lit(high).cast("timestamp_ntz"))
    return test


STAGES = ((None, FIRST_BORDER), (FIRST_BORDER, SECOND_BORDER), (SECOND_BORDER, None))


@query(
    "stream_arrival_changelog",
    with_(FACTS, CHANGELOG)
    + f"""SELECT uid, dn, {_START}, member_seq, regtype_seq, min(a) AS first_arrival
FROM emitted GROUP BY uid, dn, win, member_seq, regtype_seq""",
)
def stream_arrival_changelog(spark, sf_dir):
    stage = Stage(spark, sf_dir, "changelog")
    rows = None
    for low, high in STAGES:
        for spec in (MEMBER, REGTYPE):
            stage.put(spec, _between(low, high))
        if rows is None:
            rows = stream_changelog(stage.facts(MEMBER), stage.facts(REGTYPE))
        stage.run(rows)
    day = 24 * 60 * 60
    start = F.timestamp_seconds(F.col("window_end_ms") / 1000 - day)
    return stage.result(rows.schema).select(
        "uid",
        "dn",
        F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.get_json_object("left_row", "$.seq").cast("bigint").alias("member_seq"),
        F.get_json_object("right_row", "$.seq").cast("bigint").alias("regtype_seq"),
        "first_arrival",
    )


def _changes_of(stage: Stage, schema: StructType) -> DataFrame:
    """The stream's changes, added up by the rows they are of."""
    start = F.timestamp_seconds(F.col("window_end_ms") / 1000 - 24 * 60 * 60)
    rows = stage.result(schema).where("uid >= 0").select(
        "uid", "dn", F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("window_start"), "change", "arrival",
        F.get_json_object("left_row", "$.seq").cast("bigint").alias("member_seq"),
        F.get_json_object("right_row", "$.seq").cast("bigint").alias("regtype_seq"),
    )
    return folded(rows, "uid", "dn", "window_start", "member_seq", "regtype_seq")


@query(
    "stream_changelog_retractions",
    with_(FACTS, CHANGELOG)
    + f"""SELECT e.uid, e.dn, {_START}, member_seq, regtype_seq, min(a) AS first_arrival,
  min(CASE WHEN regtype_seq IS NULL THEN right_a END) AS retracted_at,
  regtype_seq IS NOT NULL OR min(right_a) IS NULL AS present
FROM emitted e JOIN firsts USING (uid, dn, win) GROUP BY e.uid, e.dn, win, member_seq, regtype_seq""",
)
def stream_changelog_retractions(spark, sf_dir):
    """Rows of the first-left join as they come and go, over three restarts."""
    stage = Stage(spark, sf_dir, "retractions")
    rows = None
    for low, high in STAGES:
        for spec in (MEMBER, REGTYPE):
            stage.put(spec, _between(low, high))
        if rows is None:
            rows = stream_changes(stage.facts(MEMBER), stage.facts(REGTYPE))
        stage.run(rows)
    return _changes_of(stage, rows.schema)


def _late_sql(delay: str) -> str:
    """Every tenth event comes after the others; it counts if its window is still open."""
    return f"""
mark AS (
  SELECT least(max(ts) FILTER (WHERE event_type = 'signup'),
               max(ts) FILTER (WHERE event_type = 'view')) - INTERVAL {delay} AS w
  FROM events WHERE event_id % 10 <> 9),
m AS (SELECT * FROM member, mark WHERE member_seq % 10 <> 9 OR win + INTERVAL 1 DAY > w),
r AS (SELECT * FROM regtype, mark WHERE regtype_seq % 10 <> 9 OR win + INTERVAL 1 DAY > w),
late AS (
  SELECT m.*, r.appregurl, r.websiteid, r.createtime, r.regtype_seq
  FROM m LEFT JOIN r ON m.uid = r.uid AND m.dn = r.dn AND m.win = r.win)
"""


def _late(spark, sf_dir, label, delay, days):
    stage = Stage(spark, sf_dir, label)
    specs = (MEMBER, REGTYPE)
    for spec in specs:
        stage.put(spec, F.col("event_id") % 10 != 9)
    rows = _plain_window(stream_left_join(*_pair(stage, delay)))
    stage.run(rows)
    for spec in specs:
        stage.put(spec, F.col("event_id") % 10 == 9)
    stage.run(rows)
    stage.close_windows(*specs, days=days)
    stage.run(rows)
    return _shown(stage.result(rows.schema), _PAIR)


@query(
    "stream_late_drop",
    with_(FACTS, _late_sql("10 SECOND")) + f"SELECT {_PAIR}, {_START} FROM late",
)
def stream_late_drop(spark, sf_dir):
    return _late(spark, sf_dir, "late-drop", DELAY, days=2)


@query(
    "stream_join_allowed_lateness",
    with_(FACTS, _late_sql("5 DAY")) + f"SELECT {_PAIR}, {_START} FROM late",
)
def stream_join_allowed_lateness(spark, sf_dir):
    return _late(spark, sf_dir, "allowed-lateness", LATENESS, days=7)


@query(
    "stream_late_refire",
    with_(FACTS, _late_sql("5 DAY"))
    + f""",
lf AS (SELECT *, row_number() OVER (PARTITION BY uid, dn, win ORDER BY member_seq % 10 = 9, member_seq) AS rn FROM m)
SELECT uid, dn, {_START}, member_seq, regtype_seq
FROM lf LEFT JOIN (SELECT uid, dn, win, regtype_seq FROM r) r USING (uid, dn, win)
WHERE lf.rn = 1 OR regtype_seq IS NULL""",
)
def stream_late_refire(spark, sf_dir):
    """Windows come out when they close; rows of the next five days change them again."""
    stage = Stage(spark, sf_dir, "late-refire")
    specs = (MEMBER, REGTYPE)
    for spec in specs:
        stage.put(spec, F.col("event_id") % 10 != 9)
    rows = stream_changes(*[stage.facts(s, LATENESS) for s in specs], lateness_ms=5 * 24 * 60 * 60 * 1000)
    stage.run(rows)
    for spec in specs:
        stage.put(spec, F.col("event_id") % 10 == 9)
    stage.run(rows)
    stage.close_windows(*specs, days=7)
    stage.run(rows)
    return _changes_of(stage, rows.schema).where("present").select("uid", "dn", "window_start", "member_seq", "regtype_seq")


@query(
    "stream_dim_refresh",
    with_(FACTS, DIMS)
    + f"""SELECT p.uid, p.dn, p.vip_id, p.paymoney_seq AS seq, v.vip_level || CASE
  WHEN e.ts < TIMESTAMP '{FIRST_BORDER}' THEN '' ELSE '/new' END AS vip_level,
  v.start_time || '.0' AS vip_start_time
FROM pay p JOIN ev e ON e.event_id = p.paymoney_seq
LEFT JOIN vip v ON p.vip_id = v.vip_id AND p.dn = v.dn""",
)
def stream_dim_refresh(spark, sf_dir):
    """Payments of each round see the vip table as it is then."""
    stage = Stage(spark, sf_dir, "dim-refresh")
    tables = DimTables(f"{stage.root}/dims")
    dim_rows = roles.dim_envelope(spark, sf_dir)
    renamed = F.regexp_replace("value", r'("vip_level":"[^"]*)"', r'$1/new"')
    changed = dim_rows.withColumn("value", renamed).withColumn("seq", F.col("seq") + 1_000_000_000_000)
    now = [0.0]
    snapshots = DimSnapshots(lambda: tables.lookups(stage.stream), seconds=60, clock=lambda: now[0])

    def handle(frame: DataFrame, batch_id: int, query_id: str) -> None:
        found = lookup(frame, snapshots.get()["membervip"], VIP_LOOKUP, unique=True)
        found.write.mode("overwrite").parquet(f"{stage.root}/out/batch={batch_id}")

    for version, (dims, bounds) in enumerate(
        [(dim_rows, (None, FIRST_BORDER)), (changed, (FIRST_BORDER, None))]
    ):
        tables.apply(dims, version)
        if version == 1:
            # Within the interval the old rows are still seen; they come again below.
            snapshots.get()
            now[0] += 59
            stale = snapshots.get()["membervip"].where(F.col("vip_level").endswith("/new"))
            if not stale.isEmpty():
                raise AssertionError("a snapshot changed before its time")
            now[0] += 1
        stage.put(PAYMONEY, _between(*bounds))
        payments = stage.typed(PAYMONEY).select("uid", "dn", "vip_id", "seq")
        once_per_batch(
            payments, f"{stage.root}/checkpoint", handle, ALL_AVAILABLE
        ).awaitTermination()
    out = spark.read.parquet(f"{stage.root}/out")
    return out.select("uid", "dn", "vip_id", "seq", "vip_level", "vip_start_time")


@query(
    "stream_restart_idempotent",
    with_(FACTS)
    + """SELECT uid, dn, CAST(sum(CAST(paymoney AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS paymoney
FROM pay GROUP BY uid, dn""",
)
def stream_restart_idempotent(spark, sf_dir):
    """Running totals over three restarts, then the first batches once more."""
    stage = Stage(spark, sf_dir, "restart")
    table = KeyedTable(
        f"{stage.root}/totals",
        StructType.fromDDL("uid int, dn string, paymoney decimal(38,2)"),
        ("uid", "dn"),
        MergeRules(total=("paymoney",)),
        compact_every=2,
    )

    def run(checkpoint: str) -> None:
        amounts = stage.typed(PAYMONEY).select(
            "uid", "dn", money("paymoney").cast("decimal(38,2)").alias("paymoney"), "seq"
        )
        once_per_batch(
            amounts, f"{stage.root}/{checkpoint}", table.apply, ALL_AVAILABLE
        ).awaitTermination()

    for low, high in STAGES:
        stage.put(PAYMONEY, _between(low, high))
        run("checkpoint")
    # A job that lost its checkpoint starts at the first batch again.
    run("checkpoint-lost")
    return table.current(spark)


@query(
    "stream_new_checkpoint",
    with_(FACTS)
    + """SELECT uid, dn, CAST(sum(CAST(paymoney AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS paymoney,
  max_by(vip_id, paymoney_seq) AS vip_id
FROM pay GROUP BY uid, dn""",
)
def stream_new_checkpoint(spark, sf_dir):
    """A job loses its checkpoint: what comes afterwards counts, what it reads again does not."""
    stage = Stage(spark, sf_dir, "new-checkpoint")
    table = KeyedTable(
        f"{stage.root}/totals",
        StructType.fromDDL("uid int, dn string, vip_id int, paymoney decimal(38,2)"),
        ("uid", "dn"),
        MergeRules(last=("vip_id",), total=("paymoney",)),
        compact_every=2,
    )
    for number, (low, high) in enumerate(STAGES):
        stage.put(PAYMONEY, _between(low, high))
        amounts = stage.typed(PAYMONEY).select(
            "uid", "dn", "vip_id", money("paymoney").cast("decimal(38,2)").alias("paymoney"), "seq"
        )
        checkpoint = f"{stage.root}/checkpoint-{max(0, number - 1)}"
        once_per_batch(amounts, checkpoint, table.apply, ALL_AVAILABLE).awaitTermination()
    return table.current(spark)


_NULL_DN = """
n AS (SELECT uid, CASE WHEN member_seq % 7 = 0 THEN NULL ELSE dn END AS dn, register, iconurl, win, member_seq
      FROM member),
nf AS (SELECT *, row_number() OVER (PARTITION BY uid, dn, win ORDER BY member_seq) AS ord FROM n),
nj AS (
  SELECT nf.uid, nf.dn, nf.win, nf.member_seq, r.regtype_seq FROM nf
  LEFT JOIN regtype r ON nf.uid = r.uid AND nf.dn = r.dn AND nf.win = r.win
  WHERE r.uid IS NULL OR nf.ord = 1)
"""


@query(
    "stream_first_left_null_dn",
    with_(FACTS, _NULL_DN) + f"SELECT uid, dn, member_seq, regtype_seq, {_START} FROM nj",
)
def stream_first_left_null_dn(spark, sf_dir):
    """Members without a dn join nothing, and none of them is lost."""
    stage = Stage(spark, sf_dir, "first-left-null-dn")
    for spec in (MEMBER, REGTYPE):
        stage.put(spec)
    left, right = _pair(stage)
    left = left.withColumn("dn", F.when(F.col("member_seq") % 7 != 0, F.col("dn")))
    rows = _plain_window(stream_first_left_join(Side(left, "member_seq"), Side(right, "regtype_seq")))
    stage.run(rows)
    stage.close_windows(MEMBER, REGTYPE)
    stage.run(rows)
    out = _shown(stage.result(rows.schema), _PAIR)
    return out.select("uid", "dn", "member_seq", "regtype_seq", "window_start")


@query(
    "stream_first_left_narrow",
    with_(FACTS, FIRST_LEFT) + "SELECT uid, dn, member_seq FROM f2",
)
def stream_first_left_narrow(spark, sf_dir):
    """The rows do not depend on the columns that are asked for."""
    stage = Stage(spark, sf_dir, "first-left-narrow")
    for spec in FACT_SPECS:
        stage.put(spec)
    rows = joined_stream(*[stage.facts(s) for s in FACT_SPECS]).select("uid", "dn", "member_seq")
    stage.run(rows)
    stage.close_windows(*FACT_SPECS)
    stage.run(rows)
    return stage.result(rows.schema).where("uid >= 0")


def _counted(spark, sf_dir, label, counts, column):
    """Window counts of the events' sites as a stream, closed by a last event."""
    stage = Stage(spark, sf_dir, label)
    events = _site_events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    last = events.agg(F.max("ts").alias("ts")).select(F.lit("end").alias("dn"), F.col("ts") + F.expr("INTERVAL 2 DAYS"))
    path = f"{stage.root}/events"
    events.select("dn", "ts").write.parquet(path)
    stream = stage.stream.readStream.schema("dn string, ts timestamp").parquet(path).withWatermark("ts", DELAY)
    found = counts(stream, ["dn"])
    rows = found.select(
        "dn", F.col(f"{column}.start").alias("start"), F.col(f"{column}.end").alias("end"), "n"
    )
    stage.run(rows)
    last.toDF("dn", "ts").write.mode("append").parquet(path)
    stage.run(rows)
    return stage.result(rows.schema).where("dn <> 'end'")


@query("stream_sliding_counts", SLIDING_SQL)
def stream_sliding_counts(spark, sf_dir):
    found = _counted(spark, sf_dir, "sliding", sliding_counts, "window")
    return found.select("dn", _text("start").alias("window_start"), "n")


@query("stream_session_counts", SESSION_SQL)
def stream_session_counts(spark, sf_dir):
    found = _counted(spark, sf_dir, "session", session_counts, "session")
    return found.select("dn", _text("start").alias("session_start"), _text("end").alias("session_end"), "n")


@query("stream_quarantine", with_(FACTS, DIMS, ENVELOPE) + BAD_ROWS)
def stream_quarantine(spark, sf_dir):
    """What the splitting job puts aside."""
    stage = Stage(spark, sf_dir, "quarantine")
    roles.envelope(spark, sf_dir).write.parquet(f"{stage.root}/log")
    queries = start_split(
        file_envelope(stage.stream, f"{stage.root}/log"),
        DimTables(f"{stage.root}/dims"),
        partial(file_writer, path=f"{stage.root}/second"),
        f"{stage.root}/split",
        ALL_AVAILABLE,
        write_bad=partial(file_writer, path=f"{stage.root}/bad"),
    )
    for q in queries:
        q.awaitTermination()
    bad = spark.read.schema("value string, seq bigint, reason string, topic string").parquet(f"{stage.root}/bad")
    return bad.select("topic", "seq", "reason")


_WIDE_OUTER = with_(FACTS, LEFT_OUTER, DIMS, looked_up("j2")) + f""",
w AS (SELECT {WIDE_SELECT}, row_number() OVER (PARTITION BY uid, dn ORDER BY {_ORDER_SQL}) AS ord
      FROM e),
wn AS (SELECT *, max(ord) OVER (PARTITION BY id) AS n FROM w)
"""


@query(
    "stream_wide_member",
    _WIDE_OUTER
    + "SELECT id, "
    + ", ".join(_last_set(c) if c in _KEPT else _last(c) for c in _names())
    + " FROM wn GROUP BY id",
)
def stream_wide_member(spark, sf_dir):
    """Both standing jobs end to end: log, dimension tables, joins, wide table."""
    return _wide_member(spark, sf_dir, "left_outer")


@query(
    "stream_wide_member_first_left",
    _TABLE_SQL
    + "SELECT id, "
    + ", ".join(_last_set(c) if c in _KEPT else _last(c) for c in _names())
    + " FROM wn GROUP BY id",
)
def stream_wide_member_first_left(spark, sf_dir):
    """The same with the default join; gives the rows of the batch table."""
    return _wide_member(spark, sf_dir, "first_left")


_TIMES = ("vip_start_time", "vip_end_time", "last_modify_time")


@query(
    "stream_member_accumulate",
    ENRICHED
    + f""",
r AS (SELECT * REPLACE ({', '.join(f"{c} || '.0' AS {c}" for c in _TIMES)}) RENAME (createtime AS regtype_createtime),
        row_number() OVER (PARTITION BY uid, dn ORDER BY {_ORDER_SQL}) AS ord FROM e)
SELECT uid, dn, {', '.join(f'any_value({c}) FILTER (WHERE ord = 1) AS {c}' for c in _FULL_NAMES)},
  CAST(sum(coalesce(CAST(paymoney AS DECIMAL(18,2)), 0)) AS DECIMAL(38,2)) AS paymoney
FROM r GROUP BY uid, dn""",
)
def stream_member_accumulate(spark, sf_dir):
    """The standing job that adds payments up, with a restart, and once more after its checkpoint was lost."""
    return _wide_member(spark, sf_dir, "first_left", total_table, total_row, replay=True)


def _wide_member(spark, sf_dir, multiplicity, make=wide_table, row=wide_row, replay=False):
    stage = Stage(spark, sf_dir, "wide-member")
    log = f"{stage.root}/log"
    tables = DimTables(f"{stage.root}/dims")
    table = make(f"{stage.root}/wide", buckets=4)
    roles.envelope(spark, sf_dir).write.parquet(log)
    second = f"{stage.root}/second"

    def split() -> None:
        queries = start_split(
            file_envelope(stage.stream, log),
            tables,
            partial(file_writer, path=second),
            f"{stage.root}/split",
            ALL_AVAILABLE,
            write_bad=partial(file_writer, path=f"{stage.root}/bad"),
        )
        for q in queries:
            q.awaitTermination()

    def widen(checkpoint: str = "widen") -> None:
        layer = stage.stream.readStream.schema("value string, seq bigint, topic string").parquet(second)
        facts = [
            watermarked(parse_record(layer, s, SECOND_LAYER_PREFIX + s.topic), s, roles.WINDOW)
            for s in FACT_SPECS
        ]
        snapshots = DimSnapshots(lambda: tables.lookups(stage.stream))
        rows, options = joined_stream(*facts, multiplicity=multiplicity), {}
        if multiplicity == "first_left":
            rows, options = closed_stream(*facts), {"join": first_left_of_closed}
        start_wide(
            rows, snapshots, table, f"{stage.root}/{checkpoint}", ALL_AVAILABLE, row, **options
        ).awaitTermination()

    split()
    widen()
    stage.close_windows(*FACT_SPECS)
    for spec in FACT_SPECS:
        file_envelope(spark, f"{stage.root}/{spec.topic}", stream=False).write.mode("append").parquet(log)
    split()
    widen()
    if replay:
        widen("replayed")
    return plain_times(table.current(spark))


@query(
    "table_new_columns",
    with_(FACTS)
    + f"""SELECT CAST(user_id AS INTEGER) AS uid, dn,
  arg_max(ms, event_id) AS register,
  arg_max('m' || (event_id % 8), event_id) FILTER (WHERE ts < '{SECOND_BORDER}') AS memberlevel,
  arg_max('c' || (event_id % 7), event_id)
    FILTER (WHERE ts >= '{FIRST_BORDER}' AND event_id % 3 <> 0) AS channel,
  arg_max(json_extract_string(props, '$.k'), event_id) FILTER (WHERE ts >= '{SECOND_BORDER}') AS k
FROM ev WHERE event_type = 'signup' GROUP BY user_id, dn""",
)
def table_new_columns(spark, sf_dir):
    """Members whose JSON gets one more field in the second batch and another in the third, where one is left out."""
    stage = Stage(spark, sf_dir, "new-columns")
    key = StructType().add("uid", "integer").add("dn", "string")
    table = OpenTable(f"{stage.root}/table", key, buckets=4)
    wire = dict(zip(MEMBER.fields, roles.fact_fields(MEMBER), strict=True))
    fields = [wire[f] for f in ("uid", "dn", "register")]
    level = F.concat(F.lit("m"), (F.col("event_id") % 8).cast("string")).alias("memberlevel")
    channel = F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("c"), (F.col("event_id") % 7).cast("string")))
    third = F.get_json_object("props", "$.k").alias("k")
    rounds = (
        (_between(None, FIRST_BORDER), (level,)),
        (_between(FIRST_BORDER, SECOND_BORDER), (level, channel.alias("channel"))),
        (_between(SECOND_BORDER, None), (channel.alias("channel"), third)),
    )
    for days, more in rounds:
        rows = roles.events_of(spark, sf_dir, MEMBER).where(days).select(
            F.lit(MEMBER.topic).alias("topic"),
            record_json(*fields, *more).alias("value"),
            F.col("event_id").alias("seq"),
        )
        rows.write.mode("append").parquet(f"{stage.root}/log")
        log = file_envelope(stage.stream, f"{stage.root}/log")
        start_columns(log, MEMBER.topic, table, f"{stage.root}/columns", ALL_AVAILABLE).awaitTermination()
    return table.current(spark)


def _renamed_sites(dims: DataFrame) -> DataFrame:
    """Every seventh site once more, later and under another name."""
    sites = dims.where((F.col("topic") == "basewebsite") & (F.get_json_object("value", "$.siteid").cast("int") % 7 == 0))
    value = F.regexp_replace("value", r'("sitename":"[^"]*)"', r'$1/1"')
    return sites.withColumn("value", value).withColumn("seq", F.col("seq") + 1_000_000_000_000)


def _owned_sites(dims: DataFrame) -> DataFrame:
    """Every fifth site once more, later still, with another creator."""
    sites = dims.where((F.col("topic") == "basewebsite") & (F.get_json_object("value", "$.siteid").cast("int") % 5 == 0))
    value = F.regexp_replace("value", r'"creator":"admin"', '"creator":"admin/2"')
    return sites.withColumn("value", value).withColumn("seq", F.col("seq") + 2_000_000_000_000)


@query(
    "dim_changes_since",
    with_(DIMS)
    + """SELECT siteid, CASE WHEN siteid % 5 = 0 THEN sitename ELSE sitename || '/1' END AS sitename, siteurl, "delete",
  createtime, CASE WHEN siteid % 5 = 0 THEN 'admin/2' ELSE creator END AS creator, dn
FROM site WHERE siteid % 7 = 0 OR siteid % 5 = 0""",
)
def dim_changes_since(spark, sf_dir):
    """Sites touched after the first batch, one of the later batches being merged into a base meanwhile."""
    dims = roles.dim_envelope(spark, sf_dir)
    tables = DimTables(scratch_dir(spark, "changes"))
    site = tables.table("basewebsite")
    tables.apply(dims, 0)
    since = site.mark(spark)
    tables.apply(_renamed_sites(dims), 1)
    site.compact(spark)
    tables.apply(_owned_sites(dims), 2)
    return site.changes(spark, since)


@query(
    "stream_dim_incremental",
    with_(FACTS, DIMS)
    + f"""SELECT p.uid, p.dn, p.siteid, p.paymoney_seq AS seq,
  s.sitename || CASE WHEN e.ts >= TIMESTAMP '{FIRST_BORDER}' AND s.siteid % 7 = 0
    AND (e.ts < TIMESTAMP '{SECOND_BORDER}' OR s.siteid % 5 <> 0) THEN '/1' ELSE '' END AS sitename,
  CASE WHEN e.ts >= TIMESTAMP '{SECOND_BORDER}' AND s.siteid % 5 = 0 THEN 'admin/2' ELSE s.creator END AS site_creator
FROM pay p JOIN ev e ON e.event_id = p.paymoney_seq
LEFT JOIN site s ON p.siteid = s.siteid AND p.dn = s.dn""",
)
def stream_dim_incremental(spark, sf_dir):
    """Payments of each round see the site table as it is then, through a snapshot that takes in the changes."""
    stage = Stage(spark, sf_dir, "dim-incremental")
    dims = roles.dim_envelope(spark, sf_dir)
    tables = DimTables(f"{stage.root}/dims")
    snapshots = TableSnapshots(stage.stream, tables.tables(), lookup_form, seconds=0)

    def handle(frame: DataFrame, batch_id: int, query_id: str) -> None:
        found = lookup(frame, snapshots.get()["basewebsite"], SITE_LOOKUP, unique=True)
        found.write.mode("overwrite").parquet(f"{stage.root}/out/batch={batch_id}")

    for version, (rows, bounds) in enumerate(zip((dims, _renamed_sites(dims), _owned_sites(dims)), STAGES, strict=True)):
        tables.apply(rows, version)
        stage.put(PAYMONEY, _between(*bounds))
        payments = stage.typed(PAYMONEY).select("uid", "dn", "siteid", "seq")
        once_per_batch(payments, f"{stage.root}/checkpoint", handle, ALL_AVAILABLE).awaitTermination()
    out = spark.read.parquet(f"{stage.root}/out")
    return out.select("uid", "dn", "siteid", "seq", "sitename", "site_creator")
