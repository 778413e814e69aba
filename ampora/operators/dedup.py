"""Keep the newest row per natural key (raw rewrite and staging dedup)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampora.constants import DEDUP_ORDER_COLUMN

_UNORDERABLE = (T.MapType, T.VariantType)


def _orderable(field: T.StructField) -> bool:
    dt = field.dataType
    if isinstance(dt, _UNORDERABLE):
        return False
    if isinstance(dt, (T.ArrayType, T.StructType)):
        return "map<" not in dt.simpleString() and "variant" not in dt.simpleString()
    return True


def dedup_latest(df: DataFrame, keys: list[str], order_by: str = DEDUP_ORDER_COLUMN,
                 tie_breakers: list[str] | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by order_by desc) = 1``.

    NULL order values sort last.  Ties on ``order_by`` are broken by every
    other orderable column (descending), so the result is deterministic --
    the warehouse original is not.  Catalyst plans ``row_number() = 1`` as a
    ``WindowGroupLimit`` that also runs *before* the shuffle, so each map task
    ships at most one row per key: a key holding a third of all rows costs a
    map-side sort, not one giant reduce task.
    """
    if not keys:
        raise ValueError("At least one unique key column is required.")
    missing = [k for k in keys + [order_by] if k not in df.columns]
    if missing:
        raise ValueError(f"Unknown columns: {missing}")
    if tie_breakers is None:
        tie_breakers = [f.name for f in df.schema.fields
                        if f.name not in keys and f.name != order_by and _orderable(f)]
    order = [F.col(order_by).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tie_breakers]
    w = Window.partitionBy(*keys).orderBy(*order)
    rn = "__ampora_rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)
