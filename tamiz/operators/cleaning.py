"""Cleaners: a DataFrame in, a clean DataFrame with flags and score out. One projection each."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions import dates, money, text
from tamiz.operators import structure

# Name tokens, columns and penalties.
MONEY = ("monto", "precio", "total", "amount", "price")
CAR_DROPS = ["make", "model", "trim", "body", "vin", "state", "color", "interior", "seller", "saledate", "Unnamed: 0"]
CAR_COLUMNS = ["year", "transmission", "condition", "odometer", "mmr", "sellingprice"]
RETAIL_COLUMNS = [
    "data_quality_flags", "periodo", "fecha", "anio", "mes", "mes_nombre", "trimestre", "semestre", "grupo_cliente", "cliente_codigo", "cliente_nombre",
    "local_codigo", "local_nombre", "region_codigo", "region", "comuna", "tipo_reposicion", "producto", "producto_base", "categoria", "familia",
    "empaque", "formato_gramos", "formato", "unidades", "venta_clp", "costo_clp", "margen_clp", "margen_pct", "precio_unitario_clp", "costo_unitario_clp",
    "hoja_origen", "quality_score",
]
RETAIL_PENALTIES = {"periodo_invalido": 60, "metrica_no_numerica": 60, "unidades_no_positivas": 60, "venta_no_positiva": 60, "costo_no_positivo": 15, "margen_negativo": 10}


def flags(marks: list[tuple[Column, str]]) -> Column:
    """array<string> of the tags whose mark holds, in order."""
    return F.array_compact(F.array(*[F.when(mark, F.lit(tag)) for mark, tag in marks])) if marks else F.array().cast("array<string>")


def is_critical(name: str) -> bool:
    return bool(re.search("fecha|monto|venta|precio|total|id", name, re.I))


def quality_score(columns: list[str], state: str | None = None, tags: str | None = "data_quality_flags") -> Column:
    """100, less 20 for each null critical column, 10 for an unknown state, 10 for a missing_ or unknown flag."""
    score = F.lit(100)
    for c in columns:
        if is_critical(c):
            score = score - F.when(F.col(f"`{c}`").isNull(), 20).otherwise(0)
    if state:
        score = score - F.when(F.col(state) == "DESCONOCIDO", 10).otherwise(0)
    if tags:
        score = score - F.when(F.exists(tags, lambda t: t.contains("missing_") | t.contains("unknown")), 10).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(100), score)).cast("int")


def _is_id(name: str) -> bool:
    return bool(re.search("^id_|_id$|^codigo|trx|folio|transaccion", name, re.I))


def _is_product(name: str) -> bool:
    return bool(re.search("hardware|item|modelo|sku|producto", name, re.I))


def clean_transactional(df: DataFrame) -> DataFrame:
    """Ids, products, dates, money and states by the names of the columns; then movement, flags and score."""
    df = structure.drop_empty(df)
    df = df.toDF(*structure.unique_names(structure.snake_names(df.columns)))
    # Texts are parsed in a first projection; flags, movement and score only read what it made.
    parsed: dict[str, Column] = {}
    out: dict[str, Column] = {}
    marks: list[tuple[Column, str]] = []
    amount = state = None
    for c in df.columns:
        x, p = F.col(c), f"_parsed_{c}"
        if _is_id(c):
            parsed[p] = text.restore_id(x)
            out[c] = F.col(p)
            marks.append((F.col(p).isNotNull(), "id_fixed"))
        elif _is_product(c):
            out |= {c: x, f"{c}_normalized": text.normalize_product(x)}
        elif "fecha" in c or "date" in c:
            parsed[p] = dates.as_date(x, dict(df.dtypes)[c])
            out[c] = F.col(p)
            marks.append((F.col(p).isNull() & x.isNotNull() & ~F.trim(x.cast("string")).isin("", "nan", "None"), f"invalid_date_{c}"))
        elif any(k in c for k in MONEY):
            parsed[p] = money.parse_price(x.cast("string"))
            out |= {c: F.coalesce(F.col(p), F.lit(0.0)), f"{c}_original": x, f"{c}_currency": money.detect_currency(x.cast("string"))}
            marks.append((F.col(p).isNull(), f"imputed_0_{c}"))
            if amount is None and ("monto" in c or "precio" in c):
                amount = c
        else:
            out[c] = x
            if "estado" in c or "status" in c:
                out["estado_normalizado"] = text.normalize_state(x)
                state = c if c == "estado" else state
    cleaned = df.withColumns(parsed).select(flags(marks).alias("data_quality_flags"), *[v.alias(k) for k, v in out.items()])
    movement = text.classify_movement(F.col(amount) if amount else F.lit(None).cast("double"), F.col(state) if state else F.lit(None).cast("string"))
    cleaned = cleaned.withColumn("tipo_movimiento", movement)
    return cleaned.withColumn("quality_score", quality_score(cleaned.columns, "estado_normalizado" if "estado_normalizado" in cleaned.columns else None))


def clean_retail(df: DataFrame, sheet: str | None = None) -> DataFrame:
    """Monthly retail sales in 33 canonical columns."""
    pick = lambda *names: structure.pick(df, *names)
    period = dates.period_parts(pick("periodo").cast("string"))
    # Seven outputs read the product's name, so it is made in a projection of its own.
    df = df.withColumn("_product", text.retail_product(pick("descripcionproducto2", "descripcionproducto", "producto")))
    product = F.col("_product")
    units, sale, cost = (pick(*names).cast("string").try_cast("double") for names in (["unidades"], ["venta", "ventas"], ["costoproducto", "costo"]))
    marks = [
        (~period["ok"], "periodo_invalido"), (units.isNull() | sale.isNull(), "metrica_no_numerica"), (units <= 0, "unidades_no_positivas"),
        (sale <= 0, "venta_no_positiva"), (cost <= 0, "costo_no_positivo"), ((cost > sale) & (sale > 0), "margen_negativo"),
    ]
    per = lambda a, b: F.when(b != 0, a / b)
    local, region = pick("codlocaldescripcion"), pick("region")
    out = {k: period[k] for k in ("periodo", "fecha", "anio", "mes", "mes_nombre", "trimestre", "semestre")} | {
        "grupo_cliente": text.clean_text(pick("grupoclientes", "grupocliente")), "cliente_codigo": F.upper(text.clean_text(pick("codigodelcliente", "codigocliente"))),
        "cliente_nombre": text.strip_code_prefix(pick("nombredelcliente", "nombrecliente")), "local_codigo": text.local_code(local), "local_nombre": text.strip_code_prefix(local),
        "region_codigo": text.region_code(region), "region": text.region_name(region), "comuna": text.title_case(text.clean_text(pick("comuna"))),
        "tipo_reposicion": text.clean_text(pick("tipodereposicion", "tiporeposicion")), "producto": product, "producto_base": text.product_base(product),
        "categoria": text.keyword_class(product, text.CATEGORIES), "familia": text.keyword_class(product, text.FAMILIES), "empaque": text.packaging(product),
        "formato_gramos": text.pack_grams(product), "formato": text.pack_label(product), "unidades": units, "venta_clp": sale, "costo_clp": cost,
        "margen_clp": sale - cost, "margen_pct": per((sale - cost), sale) * 100, "precio_unitario_clp": per(sale, units), "costo_unitario_clp": per(cost, units),
        "hoja_origen": F.lit(sheet).cast("string") if sheet else pick("hojaorigen").cast("string"),
    }
    cleaned = df.select(flags(marks).alias("data_quality_flags"), *[v.alias(k) for k, v in out.items()])
    score = F.lit(100)
    for tag, penalty in RETAIL_PENALTIES.items():
        score = score - F.when(F.array_contains("data_quality_flags", tag), penalty).otherwise(0)
    for key in ("cliente_codigo", "producto", "comuna"):
        score = score - F.when(F.col(key).isNull(), 20).otherwise(0)
    return cleaned.withColumn("quality_score", F.greatest(F.lit(0), F.least(F.lit(100), score)).cast("int")).select(RETAIL_COLUMNS)


def clean_cars(df: DataFrame) -> DataFrame:
    kept = structure.drop_listed(df, CAR_DROPS)
    manual = F.when(F.lower(F.trim("transmission")) == "manual", 1).otherwise(0).cast("int")
    return structure.reordered(kept.withColumn("transmission", manual), CAR_COLUMNS)


def car_metrics(df: DataFrame) -> DataFrame:
    """Rows in and out, dropped rows and manual cars, in one pass."""
    wanted = [c for c in df.columns if c not in CAR_DROPS]
    whole = F.lit(True)
    for c in wanted:
        whole = whole & F.col(c).isNotNull()
    manual = whole & (F.lower(F.trim("transmission")) == "manual")
    return df.agg(F.count("*").alias("rows_in"), F.count_if(whole).alias("rows_out"), F.count_if(~whole).alias("dropped"), F.count_if(manual).alias("manual"))


def clean_titles(df: DataFrame) -> DataFrame:
    ints = [c for c in ("startYear", "endYear", "runtimeMinutes", "isAdult") if c in df.columns]
    return structure.with_key(structure.coerced(structure.null_markers(df), ints), "tconst")


def clean_ratings(df: DataFrame) -> DataFrame:
    return structure.with_key(structure.coerced(structure.null_markers(df), ["numVotes"], ["averageRating"]), "tconst")


@dataclass(frozen=True)
class Cleaner:
    name: str
    matches: Callable[[list[str]], bool]
    clean: Callable[[DataFrame], DataFrame]


# Columns by which a table is known.
_RETAIL = ({"periodo", "unidades", "venta", "comuna"}, {"grupoclientes", "codigodelcliente", "descripcionproducto2", "costoproducto", "tipodereposicion", "region"})
_TOKENS = ("monto", "precio", "total", "amount", "price", "fecha", "date", "estado", "status", "id_", "_id", "codigo", "trx", "folio", "transaccion")


def _retail(columns: list[str]) -> bool:
    plain = {structure.plain_name(c) for c in columns}
    return _RETAIL[0] <= plain and len(_RETAIL[1] & plain) >= 3


#: In order; the last one takes what the others leave.
CLEANERS = [
    Cleaner("retail_sales", _retail, clean_retail),
    Cleaner("car_prices", lambda c: {"transmission", "odometer", "sellingprice"} <= set(c), clean_cars),
    Cleaner("title_ratings", lambda c: {"tconst", "averageRating", "numVotes"} <= set(c), clean_ratings),
    Cleaner("title_basics", lambda c: {"tconst", "titleType", "primaryTitle"} <= set(c), clean_titles),
    Cleaner("transactional", lambda c: any(t in " ".join(c).lower() for t in _TOKENS), clean_transactional),
]


def choose(columns: list[str], name: str | None = None, hint: str = "") -> Cleaner | None:
    """By name, else by exact hint, else by a name within the hint, else the first that matches."""
    by = {c.name: c for c in CLEANERS}
    found = by.get(name or "") or by.get(hint) or next((c for c in CLEANERS if c.name in hint), None)
    return found or next((c for c in CLEANERS if c.matches(columns)), None)


def clean(df: DataFrame, name: str | None = None, hint: str = "") -> DataFrame:
    cleaner = choose(df.columns, name, hint)
    return cleaner.clean(df) if cleaner else df
