"""Prefix aggregates over a whole order, or within keys of any size, without ever sorting a key in one task.

Rows are ranged into blocks along the order and stored; each block gives one partial value a key; the partials are
scanned, in groups of `fan` blocks and then over the groups; and within a block each row's own prefix is combined with
what came before the block. Any associative aggregate that Spark can take over a window will do.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.sources import shared


@dataclass(frozen=True)
class Associative:
    """aggregate(column) over some rows, and combine(earlier, later) of two such values, either of which may be null.
    ordered: the aggregate depends on the order of its rows."""

    aggregate: Callable[[Column], Column]
    combine: Callable[[Column, Column], Column]
    ordered: bool = False


SUM = Associative(F.sum, lambda a, b: F.coalesce(a + b, a, b))
MAX = Associative(F.max, F.greatest)
MIN = Associative(F.min, F.least)
LAST = Associative(lambda c: F.last(c, ignorenulls=True), lambda a, b: F.coalesce(b, a), ordered=True)

Named = dict[str, Associative]  # column: what is scanned in it


def _totals(rows: DataFrame, place: list[str], order: list[Column], ops: Named) -> DataFrame:
    """One value of each operation for each place."""
    if not any(op.ordered for op in ops.values()):
        return rows.groupBy(*place).agg(*[op.aggregate(F.col(n)).alias(n) for n, op in ops.items()])
    whole = Window.partitionBy(*place).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.select(*place, *[op.aggregate(F.col(n)).over(whole).alias(n) for n, op in ops.items()]).distinct()


def _within(rows: DataFrame, keys: list[str], place: str, order: list[Column], earlier: DataFrame | None, ops: Named, last: int) -> DataFrame:
    """rows with each operation's prefix up to the `last`-th row from this one, in their place and all earlier ones;
    earlier(keys.., place, values): what came before each place."""
    if earlier is not None:
        names = {c: f"_of_{k}" for k, c in enumerate([*keys, place])}
        earlier = earlier.select(*[F.col(c).alias(n) for c, n in names.items()], *[F.col(c).alias(f"{c}_before") for c in ops])
        on = [rows[c].eqNullSafe(F.col(n)) for c, n in names.items()]
        rows = rows.join(earlier.hint("merge"), on, "left").drop(*names.values())
    own = Window.partitionBy(place, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    value = lambda c, op: op.aggregate(F.col(c)).over(own)
    found = {c: value(c, op) if earlier is None else op.combine(F.col(f"{c}_before"), value(c, op)) for c, op in ops.items()}
    return rows.select(*[found[c].alias(c) if c in found else c for c in rows.columns if not c.endswith("_before") or c.removesuffix("_before") not in ops])


def _before(totals: DataFrame, keys: list[str], place: str, places: int, fan: int, ops: Named) -> DataFrame:
    """totals(keys.., place, values) with the values of all earlier places of their key, null before the first: by prefixes
    in groups of `fan` places, and what came before each group in turn."""
    group = f"{place}g"
    grouped = totals.withColumn(group, F.expr(f"{place} div {fan}").cast("int"))
    above = None
    if places > fan:
        above = _before(_totals(grouped, [*keys, group], [F.col(place)], ops), keys, group, -(-places // fan), fan, ops)
    return _within(grouped, keys, group, [F.col(place)], above, ops, -1).drop(group)


def prefix_scan(rows: DataFrame, order: list[Column], aggregates: dict[str, tuple[Associative, Column]], keys: list[str] | None = None, exclusive: bool = False, blocks: int | None = None, fan: int = 1024) -> DataFrame:
    """rows with a column for each of `aggregates` (name: operation and its column): its value over the rows of the same
    keys up to this one in `order`, or, exclusive, up to the one before.

    Null keys are a key; rows with equal keys and order follow each other in any way. Rows are stored once, ranged by
    keys and order, in as many blocks as the shuffle has partitions unless `blocks` says so. An order that many rows
    share puts them in one block: end it with a column that tells rows apart.
    """
    keys = keys or []
    blocks = blocks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ops = {f"_scan{k}": op for k, (op, _) in enumerate(aggregates.values())}
    ready = rows.select("*", *[c.alias(n) for n, (_, c) in zip(ops, aggregates.values(), strict=True)])
    ranged = ready.repartitionByRange(blocks, *[F.col(f"`{k}`") for k in keys], *order).withColumn("_block", F.spark_partition_id())
    ranged = shared.stored(ranged, "scan")
    before = _before(_totals(ranged, [*keys, "_block"], order, ops), keys, "_block", blocks, fan, ops)
    out = _within(ranged, keys, "_block", order, before, ops, -1 if exclusive else 0)
    return out.select(*[f"`{c}`" for c in rows.columns], *[F.col(n).alias(name) for n, name in zip(ops, aggregates, strict=True)])


def numbered(rows: DataFrame, order: list[Column], name: str = "position", keys: list[str] | None = None, **kind) -> DataFrame:
    """rows numbered from 1 in `order`, over the table or within keys."""
    return prefix_scan(rows, order, {name: (SUM, F.lit(1).cast("long"))}, keys, **kind)
