"""The first-left join as a stream of changes: rows that come, and rows that are taken back.

Adding up the changes of a row gives whether it is in the join now. With
``lateness`` a window comes out when it closes; rows that are late by no more
than that change what was given before.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import astuple, dataclass, field
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rollcall.streaming.changelog import SHARES, arrivals_of, by_share, rows_out

# Open windows of a share of the members: arrivals so far, whether the window came out, its first left row, left
# rows shown without a right one, right rows that wait.
_PANE = (
    "uid: int, dn: string, end: bigint, arrivals: bigint, fired: boolean, has_right: boolean, head: string, singles: array<string>, waiting: array<string>"
)
_STATE = f"panes array<struct<{_PANE}>>"
_CHANGES = (
    "uid int, dn string, window_end_ms bigint, change int, arrival bigint, left_row string, right_row string"
)
_COLUMNS = [c.split()[0] for c in _CHANGES.split(", ")]


@dataclass
class _Pane:
    """The rows of one window of a member and the changes its arrivals make."""

    uid: int | None
    dn: str | None
    end: int
    arrivals: int = 0
    fired: bool = False
    has_right: bool = False
    head: str | None = None
    singles: list[str] = field(default_factory=list)
    waiting: list[str] = field(default_factory=list)

    def arrive(self, is_left: bool, row: str) -> list[tuple[int, str | None, str | None]]:
        """(change, left row, right row) of one arrival."""
        self.arrivals += 1
        if not is_left:
            self.has_right = True
            self.waiting.append(row)
            return self._pairs() if self.head is not None else []
        if self.head is None:
            self.head = row
            if self.has_right:
                return self._pairs()
        elif self.has_right:
            return []
        self.singles.append(row)
        return [(1, row, None)] if self.fired else []

    def _pairs(self) -> list[tuple[int, str | None, str | None]]:
        if not self.fired:
            return []
        return self.fire()

    def fire(self) -> list[tuple[int, str | None, str | None]]:
        """What the rows that wait change; all of the window the first time."""
        if self.has_right and self.head is not None:
            taken = [(-1, row, None) for row in self.singles] if self.fired else []
            out = taken + [(1, self.head, row) for row in self.waiting]
            self.singles, self.waiting = [], []
        else:
            out = [] if self.fired else [(1, row, None) for row in self.singles]
        self.fired = True
        return out


def _advance(key, frames: Iterable[pd.DataFrame], state: GroupState, lateness_ms: int | None):
    """All open windows of a share of the members, one micro-batch. The watermark lags behind by the lateness.

    Members and windows share a call because a call costs more than many rows do.
    """
    watermark, out = int(state.getCurrentWatermarkMs()), []
    panes = {tuple(p[:3]): _Pane(*p) for p in state.get[0]} if state.exists else {}

    def give(pane: _Pane, changes: list) -> None:
        out.extend((pane.uid, pane.dn, pane.end, change, pane.arrivals, x, y) for change, x, y in changes)

    if not state.hasTimedOut:
        for _, end, is_left, row, uid, dn in arrivals_of(frames):
            at = (uid, dn, end)
            if at not in panes:
                panes[at] = _Pane(*at, fired=lateness_ms is None)
            give(panes[at], panes[at].arrive(is_left, row))
    for pane in panes.values():
        if not pane.fired and watermark >= pane.end - lateness_ms:
            give(pane, pane.fire())
    left = [pane for pane in panes.values() if pane.end > watermark]
    if left:
        state.update(([astuple(pane) for pane in left],))
        state.setTimeoutTimestamp(min(p.end if p.fired else p.end - lateness_ms for p in left))
    elif state.exists:
        state.remove()
    if out:
        yield rows_out(out, _COLUMNS)


def stream_changes(
    left: DataFrame, right: DataFrame, order: str = "seq", lateness_ms: int | None = None, shares: int = SHARES
) -> DataFrame:
    """Changes (``change`` 1 or -1) of the first-left join of two watermarked streams with ``window``.

    Without ``lateness_ms`` every arrival changes the join at once: the first
    right row of a group takes the single left rows back. With it a window
    comes out when it closes, once, and rows up to ``lateness_ms`` later change
    it again; the streams' watermark delay must include the lateness. ``arrival``
    counts the arrivals of a window. Rows of one micro-batch are taken by
    ``order``. A window's state goes when the watermark passes its end; it holds
    the single left rows and the right rows that wait for a left one. The number
    of ``shares`` that members are dealt to is fixed for the life of a checkpoint.
    """

    return by_share(left, right, order, shares).applyInPandasWithState(
        partial(_advance, lateness_ms=lateness_ms), _CHANGES, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def folded(changes: DataFrame, *columns: str) -> DataFrame:
    """Every row that ever came, by ``columns``: whether it is there now, its first arrival, when it was taken back."""
    return changes.groupBy(*columns).agg(
        (F.sum("change") > 0).alias("present"),
        F.min(F.when(F.col("change") > 0, F.col("arrival"))).alias("first_arrival"),
        F.max(F.when(F.col("change") < 0, F.col("arrival"))).alias("retracted_at"),
    )
