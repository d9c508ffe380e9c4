"""Star lookups of facts against dimension tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from rollcall.operators.skew import ROWS_PER_TASK, split_left_join
from rollcall.session import staged

# Largest dimension that is sent whole to every executor.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class DimSpec:
    """A lookup: fact key, dimension key, and dimension columns by output name."""

    name: str
    fact_key: str
    dim_key: str
    columns: dict[str, str] = field(default_factory=dict)


# Looked-up columns and the names they get.
AD_LOOKUP = DimSpec("basead", "ad_id", "adid", {"adname": "adname"})
SITE_LOOKUP = DimSpec(
    "basewebsite",
    "siteid",
    "siteid",
    {
        "sitename": "sitename",
        "siteurl": "siteurl",
        "delete": "delete",
        "createtime": "site_createtime",
        "creator": "site_creator",
    },
)
VIP_LOOKUP = DimSpec(
    "membervip",
    "vip_id",
    "vip_id",
    {
        "vip_level": "vip_level",
        "start_time": "vip_start_time",
        "end_time": "vip_end_time",
        "last_modify_time": "last_modify_time",
        "max_free": "max_free",
        "min_free": "min_free",
        "next_level": "next_level",
        "operator": "operator",
    },
)
LOOKUPS = (AD_LOOKUP, SITE_LOOKUP, VIP_LOOKUP)


def latest_per_key(dim: DataFrame, keys: Sequence[str], order: str = "seq") -> DataFrame:
    """The last row per key by arrival, so that a lookup finds at most one."""
    rest = [c for c in dim.columns if c not in keys and c != order]
    return (
        dim.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), order).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


def measure(frames: Sequence[DataFrame]) -> list[tuple[int, int]]:
    """Rows and bytes of each frame, in one job; 16 bytes per value besides text."""
    counts = []
    for i, df in enumerate(frames):
        width = f"{16 * len(df.columns)}L"
        for name, kind in df.dtypes:
            if kind == "string":
                width += f" + coalesce(octet_length(`{name}`), 0)"
        counts.append(
            df.selectExpr(f"{i} AS i", f"{width} AS width")
            .groupBy("i")
            .agg(F.count("width").alias("n"), F.sum("width").alias("size"))
        )
    found = {r["i"]: (r["n"], r["size"]) for r in reduce(DataFrame.unionByName, counts).collect()}
    return [found.get(i, (0, 0)) for i in range(len(frames))]


def with_size(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The frames with their rows and bytes noted, so that ``enrich`` need not count them again."""
    for frame, size in zip(frames.values(), measure(list(frames.values())) if frames else ()):
        frame.measured = size
    return frames


def sizes(dims: Sequence[DataFrame], tables: Sequence[DataFrame]) -> list[tuple[int, int]]:
    """Rows and bytes of each looked-up table; what is noted of a dimension bounds its table."""
    noted = [vars(d).get("measured") for d in dims]
    unknown = [t for t, size in zip(tables, noted) if size is None]
    counted = iter(measure(unknown) if unknown else ())
    return [size or next(counted) for size in noted]


def narrow(dim: DataFrame, spec: DimSpec, unique: bool) -> DataFrame:
    """The looked-up columns of a dimension under the fact's key name, one row per key."""
    if not unique:
        dim = latest_per_key(dim, [spec.dim_key, "dn"])
    return dim.select(
        F.col(spec.dim_key).alias(spec.fact_key),
        "dn",
        *[F.col(c).alias(name) for c, name in spec.columns.items()],
    )


def enrich(
    facts: DataFrame,
    dims: dict[str, DataFrame],
    specs: Sequence[DimSpec] = LOOKUPS,
    order: str = "seq",
    unique: bool = False,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left joins on ``(fact_key, dn)``: by default ad, site, vip, one after the other.

    One row out per row in, misses are null. A dimension within the bounds is
    broadcast; a snapshot was counted when it was taken, others are counted here. A larger one is shuffled by key together with the facts, whose
    hot ids and missing ids are spread out by the arrival order ``order``; the
    facts are then stored first, to be counted by id. Streaming facts use
    Spark's plain join instead, their micro-batches being bounded by the source.
    Both are sort-merge joins by a hint: Spark goes by the size of a table's
    files, and would broadcast rows that take forty times as much on the driver.
    """
    tables = [narrow(dims[s.name], s, unique) for s in specs]
    found_sizes = sizes([dims[s.name] for s in specs], tables)
    small = [rows <= max_rows and size <= max_bytes for rows, size in found_sizes]
    if not all(small) and not facts.isStreaming:
        facts = staged(facts, "facts")
    found = facts
    for spec, table, fits in zip(specs, tables, small):
        on = [spec.fact_key, "dn"]
        if fits:
            found = found.join(F.broadcast(table), on, "left")
        elif facts.isStreaming:
            found = found.join(table.hint("merge"), on, "left")
        else:
            found = split_left_join(found, table, on, order, rows_per_task, counted=facts, shuffled=True)
    return found


def lookup(facts: DataFrame, dim: DataFrame, spec: DimSpec, **options) -> DataFrame:
    """One lookup; options as for :func:`enrich`."""
    return enrich(facts, {spec.name: dim}, (spec,), **options)


def fill_blank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values as empty text, for consumers that expect it."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns}
    )
