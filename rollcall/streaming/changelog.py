"""The arrival-driven join as a stream: rows come out the moment they arise."""

from __future__ import annotations

import json
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, GroupedData, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rollcall.operators.join import KEYS
from rollcall.session import COUNTED

# Members are dealt to so many shares; a share's open windows are one state.
SHARES = 1024

# Open windows as JSON: [uid, dn, end, arrivals, first left row, has right, waiting] each.
_STATE = "panes string"
_OUTPUT = (
    "uid int, dn string, window_end_ms bigint, left_row string, right_row string, "
    "first_arrival bigint"
)


def _arrive(pane: list, is_left: bool, row: str) -> list[tuple[str, str | None]]:
    """Counts one arrival of a window and returns the rows it newly emits."""
    count, head, has_right, waiting = pane
    pane[0] = count + 1
    if not is_left:
        pane[2] = True
        if head is None:
            waiting.append(row)
            return []
        return [(head, row)]
    if head is None:
        pane[1] = row
        pane[3] = []
        return [(row, right) for right in waiting] if has_right else [(row, None)]
    return [] if has_right else [(row, None)]


def by_share(left: DataFrame, right: DataFrame, order: str, shares: int) -> GroupedData:
    """The rows of both streams in groups of members, with order, window end, side and payload as JSON."""

    def tagged(df: DataFrame, is_left: bool) -> DataFrame:
        body = [c for c in df.columns if c not in (*KEYS, "window")]
        return df.select(
            *KEYS,
            "window",
            F.col(order).alias("_o"),
            F.lit(is_left).alias("_is_left"),
            F.to_json(F.struct(*body)).alias("_row"),
        )

    # States are few here, and their number tells whether closed windows go.
    left.sparkSession.conf.set(COUNTED, "true")
    rows = tagged(left, True).unionByName(tagged(right, False))
    share = F.pmod(F.xxhash64(*KEYS), F.lit(shares)).cast("int")
    return rows.withColumn("_end", F.unix_millis("window.end")).withColumn("_share", share).groupBy("_share")


def arrivals_of(frames: Iterable[pd.DataFrame]) -> list[tuple]:
    """(order, window end, is left, row, uid, dn) of a share's rows of one micro-batch, by order."""
    out = []
    for f in frames:
        # A column with a null uid comes as floats.
        uids = [None if pd.isna(u) else int(u) for u in f["uid"]]
        out.extend(zip(f["_o"], f["_end"].astype("int64"), f["_is_left"].astype(bool), f["_row"], uids, f["dn"], strict=True))
    return sorted(out, key=lambda arrival: arrival[:4])


def rows_out(out: list[tuple], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(out, columns=columns).astype({"uid": "Int32"})


def _advance(key, frames: Iterable[pd.DataFrame], state: GroupState):
    """All open windows of a share of the members, one micro-batch.

    Members and windows share a call because a call costs more than many rows do.
    """
    watermark = int(state.getCurrentWatermarkMs())
    panes = {tuple(p[:3]): p[3:] for p in json.loads(state.get[0])} if state.exists else {}
    out = []
    if not state.hasTimedOut:
        for _, end, is_left, row, uid, dn in arrivals_of(frames):
            pane = panes.setdefault((uid, dn, end), [0, None, False, []])
            for left, right in _arrive(pane, is_left, row):
                out.append((uid, dn, end, left, right, pane[0]))
    panes = {at: pane for at, pane in panes.items() if at[2] > watermark}
    if panes:
        state.update((json.dumps([[*at, *pane] for at, pane in panes.items()]),))
        state.setTimeoutTimestamp(min(end for _, _, end in panes))
    elif state.exists:
        state.remove()
    if out:
        yield rows_out(out, ["uid", "dn", "window_end_ms", "left_row", "right_row", "first_arrival"])


def stream_changelog(left: DataFrame, right: DataFrame, order: str = "seq", shares: int = SHARES) -> DataFrame:
    """Emitted rows with ``first_arrival``, for watermarked streams with ``window``.

    Each row comes out once, at the arrival that first emits it; the repeats of
    later arrivals are not written. Rows of one micro-batch are taken by
    ``order``, so the source's rate limit bounds what a share of the members
    brings at a time. State goes when the watermark passes the window. The
    number of ``shares`` is fixed for the life of a checkpoint.
    """
    return by_share(left, right, order, shares).applyInPandasWithState(
        _advance, _OUTPUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
