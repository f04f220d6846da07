"""Deterministic de-duplication.

``dropDuplicates([key])`` keeps an arbitrary row per key, so two runs over the
same input may keep different rows (SURVEY D1, Q11).  ``keep_first`` keeps the
row whose ``(order_by..., remaining columns)`` tuple is smallest, NULLs last --
the same row on every run and in every engine.

It is an aggregation, not a window: ``min(struct(...))`` is combined map-side
before the shuffle, so a key repeated millions of times (a replayed batch, a
default id) is reduced inside each map task instead of landing whole in one
reducer.

Columns whose type has no order (maps, variants) are compared by their JSON text.

Whole rows travel through the aggregation.  The other way, a narrow winner per
key first and then a join for the other columns, shuffles the narrow columns and
then every whole row once more for the join, where this shuffles one whole row
per key and map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def orderable(kind: DataType) -> bool:
    """Whether values of the type can be compared; maps and variants can't."""
    if isinstance(kind, StructType):
        return all(orderable(f.dataType) for f in kind.fields)
    return orderable(kind.elementType) if isinstance(kind, ArrayType) else not isinstance(kind, (MapType, VariantType))


def keep_first(df: DataFrame, key: str | list[str], order_by: list[str | Column] | None = None) -> DataFrame:
    """One row per ``key``: the smallest by ``order_by`` (names or expressions, ascending, NULLs
    last), then by every other column.  Column order of ``df`` is preserved."""
    keys = [key] if isinstance(key, str) else list(key)
    named = [c for c in (order_by or []) if not isinstance(c, str) or (c in df.columns and c not in keys)]
    order = [F.col(c) if isinstance(c, str) else c for c in named]
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    ranks = [x for i, c in enumerate(order) for x in (c.isNull().alias(f"n{i}"), c.alias(f"o{i}"))]
    plain = [orderable(df.schema[c].dataType) for c in rest]
    ordered = [F.col(c) if ok else F.to_json(F.struct(c)) for c, ok in zip(rest, plain)]
    # Where the whole row is compared, a column that ranks by itself travels once, as its rank.
    field = {c: f"o{i}" for i, c in enumerate(named) if isinstance(c, str)} if all(plain) else {}
    packed = F.struct(*ranks, *[x for i, (c, o) in enumerate(zip(rest, ordered)) if c not in field
                                for x in (F.col(c).isNull().alias(f"m{i}"), o.alias(f"f{i}"))])
    field = {c: field.get(c, f"f{i}") for i, c in enumerate(rest)}
    least = F.min(packed) if all(plain) else F.min_by(F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(rest)]), packed)
    winners = df.groupBy(*keys).agg(least.alias("_w"))
    return winners.select(*[F.col(c) if c in keys else F.col(f"_w.{field[c]}").alias(c) for c in df.columns])
