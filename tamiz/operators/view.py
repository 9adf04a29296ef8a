"""Business views: which rows and columns of an enriched table a reader sees, and under which names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Technical names and the order of variants.
TECHNICAL = re.compile(r"^(quality_score|data_quality_)|(_confidence|_scale_corrected|_is_serial_date|_domain_flag|_parse_error|_raw|_monto_origen|_moneda_origen)$", re.I)
VARIANTS = ["_semantic", "_final", "_normalized", "_parsed", "_as_date"]
TRAILING = re.compile(r"[_\s]+(normalizado|original|limpio|final|semantic|parsed)$", re.I)
MONEY = ("precio", "monto", "costo", "valor", "total", "importe", "amount", "price")


def split_view(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(legit, foreign): not foreign with a positive amount, and flagged foreign; other rows are in neither."""
    flag = next((c for c in df.columns if c.endswith("_domain_flag")), None)
    if flag is None:
        return df, df.limit(0)
    foreign = F.coalesce(F.col(flag).isin("foreign", "unlikely"), F.lit(False))
    amounts = [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float") and any(m in c.lower() for m in MONEY)]
    paid = F.lit(False)
    for c in amounts:
        paid = paid | F.coalesce(F.col(c) > 0, F.lit(False))
    return df.where(~foreign & (paid if amounts else F.lit(True))), df.where(foreign)


def drop_technical(df: DataFrame, protected: list[str] = ()) -> DataFrame:
    return df.drop(*[c for c in df.columns if TECHNICAL.search(c) and c not in protected])


def base_name(column: str) -> str:
    for suffix in VARIANTS:
        column = column.removesuffix(suffix)
    return TRAILING.sub("", column).strip()


def best_variants(df: DataFrame, protected: list[str] = ()) -> DataFrame:
    """One column a family, under its base name: protected ones first, then by the order of VARIANTS."""
    families: dict[str, list[str]] = {}
    for c in df.columns:
        families.setdefault(base_name(c), []).append(c)

    def rank(c: str) -> int:
        return next((len(VARIANTS) - i for i, s in enumerate(VARIANTS) if c.lower().endswith(s)), 0)

    out = []
    for base, group in families.items():
        held = next((c for c in group if c in protected), None)
        best = held or max(group, key=rank)  # the first of equals
        out.append(F.col(f"`{best}`").alias(best if held else base))
    return df.select(*out)


def readable(columns: list[str], protected: list[str] = ()) -> dict[str, str]:
    """Title case, _currency as Moneda, no _sucio, no word twice in a row."""
    out = {}
    for c in columns:
        if c in protected:
            out[c] = c
            continue
        name = re.sub("_currency$", "_moneda", c).replace("_sucio", "").replace("_", " ").title().strip()
        words = name.split()
        out[c] = " ".join(w for i, w in enumerate(words) if i == 0 or w.lower() != words[i - 1].lower())
    return out


def collapse_currencies(df: DataFrame, base: str = "CLP") -> DataFrame:
    """Currency columns with nothing but the base go; one other becomes ``Moneda``; several stay. One aggregate."""
    found = [c for c in df.columns if re.search("moneda|currency", c, re.I)]
    if not found:
        return df
    seen = df.agg(*[F.count_if(F.col(f"`{c}`").isNotNull() & ~F.upper(F.trim(F.col(f"`{c}`").cast("string"))).isin(base, "DESCONOCIDA", "$", "")).alias(c) for c in found]).first()
    telling = [c for c in found if seen[c]]
    df = df.drop(*[c for c in found if c not in telling])
    return df.withColumnRenamed(telling[0], "Moneda") if len(telling) == 1 else df


def iso_dates(df: DataFrame) -> DataFrame:
    dated = [c for c, t in df.dtypes if t in ("date", "timestamp", "timestamp_ntz")]
    texts = [c for c, t in df.dtypes if t == "string" and re.search("fecha|date", c, re.I)]
    return df.withColumns({c: F.date_format(F.col(c), "yyyy-MM-dd") for c in dated} | {c: F.date_format(F.try_to_timestamp(F.col(c)), "yyyy-MM-dd") for c in texts})


def strict(df: DataFrame, columns: list[str], protected: list[str] = ()) -> DataFrame:
    wanted = [*columns, *[k for k in protected if k in df.columns and k not in columns]]
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in wanted])


def business_view(df: DataFrame, protected: list[str] = ()) -> DataFrame:
    legit, _ = split_view(df)
    out = best_variants(drop_technical(legit, protected), protected)
    out = collapse_currencies(iso_dates(out))
    return out.withColumnsRenamed(readable(out.columns, protected))
