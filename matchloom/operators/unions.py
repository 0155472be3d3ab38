"""Unions of frames whose columns and types drift, and the match bundle."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions import quoted

_WHOLE = [T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type both widen to; unlike types meet in string."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    numeric = (T.NumericType, T.BooleanType)
    if isinstance(a, numeric) and isinstance(b, numeric):
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def relaxed_union(frames: Sequence[DataFrame | None]) -> DataFrame:
    """UNION ALL by name; absent columns are null and clashing types widen.

    Types are settled before the union: left to itself an ANSI union of a number
    and a string would pick the number and fail at run time.
    """
    present = [f for f in frames if f is not None]
    if not present:
        raise ValueError("nothing to union")
    types: dict[str, T.DataType] = {}
    for f in present:
        for c in f.schema.fields:
            types[c.name] = common_type(types[c.name], c.dataType) if c.name in types else c.dataType

    def aligned(f: DataFrame) -> DataFrame:
        have = {c.name: c.dataType for c in f.schema.fields}
        return f.select(
            *[
                (F.lit(None) if n not in have else quoted(n)).cast(t).alias(n)
                if have.get(n) != t
                else quoted(n)
                for n, t in types.items()
            ]
        )

    return reduce(DataFrame.unionAll, [aligned(f) for f in present])


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def union_keys(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct keys of each frame, one after the other."""
    return relaxed_union([f.select(*map(quoted, keys)).distinct() for f in frames])


def union_present(a: DataFrame | None, b: DataFrame | None) -> DataFrame | None:
    if a is None or b is None:
        return b if a is None else a
    return relaxed_union([a, b])


@dataclass(frozen=True)
class MatchBundle:
    """The outputs of a set of match pages; a family that is absent has no entry."""

    summary: DataFrame | None = None
    lineups: DataFrame | None = None
    shooting: DataFrame | None = None
    team: dict[str, DataFrame] = field(default_factory=dict)
    player: dict[str, DataFrame] = field(default_factory=dict)

    def union(self, other: MatchBundle) -> MatchBundle:
        def merged(a: dict, b: dict) -> dict:
            return {k: union_present(a.get(k), b.get(k)) for k in {**a, **b}}

        return MatchBundle(
            union_present(self.summary, other.summary),
            union_present(self.lineups, other.lineups),
            union_present(self.shooting, other.shooting),
            merged(self.team, other.team),
            merged(self.player, other.player),
        )


def union_bundles(bundles: Sequence[MatchBundle | None]) -> MatchBundle:
    """Fold bundles into one; failed ones (None) are skipped."""
    return reduce(MatchBundle.union, [b for b in bundles if b is not None], MatchBundle())
