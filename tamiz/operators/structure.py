"""Structure: empty rows and columns, names, casts, order of columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import ACCENTS


def drop_empty(df: DataFrame) -> DataFrame:
    """Rows and columns with nothing but nulls go; one aggregate finds the columns."""
    df = df.na.drop("all")
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c]])


def unique_names(names: list[str]) -> list[str]:
    """The second and third of a name get _1 and _2."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        out.append(f"{n}_{seen[n]}" if n in seen else n)
        seen[n] = seen.get(n, 0) + 1
    return out


def snake_names(names: list[str]) -> list[str]:
    return [re.sub(r"[\s\W]+", "_", n.strip().lower()).strip("_") for n in names]


def plain_name(name: str) -> str:
    """Letters and digits only, without accents, for lookups."""
    return re.sub(r"[^a-z0-9]+", "", name.translate(str.maketrans(*ACCENTS)).lower())


def pick(df: DataFrame, *candidates: str) -> Column:
    """The first column whose plain name is a candidate; null if there is none."""
    by = {plain_name(c): c for c in reversed(df.columns)}
    return next((F.col(f"`{by[c]}`") for c in candidates if c in by), F.lit(None).cast("string"))


def drop_listed(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns go, then every row with a null."""
    return df.drop(*columns).na.drop("any")


def null_markers(df: DataFrame, marker: str = r"\N") -> DataFrame:
    return df.select(*[F.nullif(F.col(c), F.lit(marker)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def coerced(df: DataFrame, ints: list[str] = (), floats: list[str] = ()) -> DataFrame:
    """Values that aren't numbers become null."""
    return df.withColumns({c: F.col(c).try_cast("bigint") for c in ints} | {c: F.col(c).try_cast("double") for c in floats})


def with_key(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def reordered(df: DataFrame, canonical: list[str], strict: bool = False) -> DataFrame:
    """Known columns first, the others behind; strict: exactly the canonical ones, null where missing."""
    have = set(df.columns)
    if strict:
        return df.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in canonical])
    return df.select(*[c for c in canonical if c in have], *[c for c in df.columns if c not in canonical])
