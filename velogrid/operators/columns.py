"""Header and column-set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velogrid.schemas import BASE_FEATURES, NOT_FEATURES


def folded(name: str) -> str:
    """Trip headers: lower case, accented e without its accent."""
    return name.lower().replace("é", "e")


def user_header(name: str) -> str:
    return name.lower().replace(".", "_").replace(" ", "").replace("__", "_")


def fold_headers(df: DataFrame, rule=folded) -> DataFrame:
    """Apply ``rule`` to every header; columns that become equal are merged, the first one leading."""
    names = [rule(c) for c in df.columns]
    if len(set(names)) == len(names):
        return df.toDF(*names)
    by_position = df.toDF(*[f"_{i}" for i in range(len(names))])
    places: dict[str, list[str]] = {}
    for i, name in enumerate(names):
        places.setdefault(name, []).append(f"_{i}")
    return by_position.select(*[F.coalesce(*[F.col(p) for p in at]).alias(name) for name, at in places.items()])


def drop_and_rename(df: DataFrame, drop=(), rename: dict[str, str] | None = None) -> DataFrame:
    """Names that are not there are ignored. Headers may hold dots, so columns go by position."""
    rename = rename or {}
    keep = [c for c in df.columns if c not in set(drop)]
    if len(keep) < len(df.columns):
        df = df.select(*[F.col(f"`{c}`") for c in keep])
    return df.toDF(*[rename.get(c, c) for c in keep]) if rename else df


def drop_prefixed(df: DataFrame, prefixes: list[str]) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(tuple(prefixes))])


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def feature_columns(df: DataFrame, history: bool = True) -> list[str]:
    """Numeric model inputs; without ``history`` every ``_prev`` column is left out."""
    names = numeric_columns(df, NOT_FEATURES)
    return names if history else [n for n in names if "_prev" not in n]


def with_missing(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """Add absent columns as typed nulls."""
    absent = {f.name: F.lit(None).cast(f.dataType) for f in fields if f.name not in df.columns}
    return df.withColumns(absent) if absent else df


def prepare_features(df: DataFrame, features: list[str] = BASE_FEATURES, keep=()) -> DataFrame:
    """Model inputs in fixed order: absent features and nulls become 0; ``keep`` columns stay in front."""
    kinds = dict(df.dtypes)
    chosen = [F.coalesce(F.col(f), F.lit(0).cast(kinds[f])).alias(f) if f in kinds else F.lit(0).alias(f) for f in features]
    ahead = [F.col(k) for k in keep if k in kinds and k not in features]
    return df.select(*ahead, *chosen)
