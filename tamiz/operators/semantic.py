"""Semantic enrichment: currencies, scale, exchange, domains and movements over whole columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.functions import dates, money, text
from tamiz.operators import statistics
from tamiz.operators.stage import staged
from tamiz.sources import files

# Exchange rates, bounds of domains, and name tokens.
RATES = {"USD": 950.0, "EUR": 1050.0}
BASE = "CLP"
SHIPPING = ("envio", "flete", "descuento", "shipping")
MONEY = ("precio", "monto", "costo", "valor", "total", "importe", "amount", "price")
PRODUCT = ("producto", "item", "descripcion", "nombre", "sku", "articulo", "product", "title")
STATE = ("estado", "status", "situacion", "movimiento")
NOTE = ("nota", "obs", "comentario", "detalle", "comment", "descripcion")
DERIVED = ("currency", "moneda", "_parsed", "_final", "_scale_corrected", "_flag", "_domain", "_confidence", "_semantic", "_as_date", "_original")


def named(df: DataFrame, tokens: tuple[str, ...]) -> list[str]:
    return [c for c in df.columns if any(t in c.lower() for t in tokens) and not any(t in c.lower() for t in DERIVED)]


@dataclass(frozen=True)
class Anchor:
    """What whole-column statistics tell of a money column: the currency of amounts that name none, and the scale's anchor."""

    currency: str
    anchor: float | None


@dataclass(frozen=True)
class Anchors:
    """The statistics of a table that ``enrich`` rests on; frozen, they let it run row by row, so on a stream too."""

    money: dict[str, Anchor]
    serial: list[str]

    def save(self, spark: SparkSession, path: str, rows: int | None = None) -> int:
        """Adds a version under ``path`` and returns its number. Earlier ones stay."""
        version = 1 + max([int(v) for v in (f.rsplit("=", 1)[-1] for f in files.listing(spark, path)) if v.isdigit()] if files.exists(spark, path) else [0])
        kept = [("money", c, a.currency, a.anchor, rows) for c, a in self.money.items()] + [("serial", c, None, None, rows) for c in self.serial]
        spark.createDataFrame(kept, ANCHORS).coalesce(1).write.parquet(f"{path}/version={version}")
        return version

    @staticmethod
    def read(spark: SparkSession, path: str, version: int | None = None) -> Anchors:
        """A version, the latest by default."""
        table = spark.read.parquet(path)
        version = version or table.agg(F.max("version")).first()[0]
        found = table.where(F.col("version") == version).collect()  # one row a column
        return Anchors({r["column_name"]: Anchor(r["currency"], r["anchor"]) for r in found if r["kind"] == "money"}, sorted(r["column_name"] for r in found if r["kind"] == "serial"))

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row with ``_anchors``, a map of the money columns, for a stream-static join."""
        rows = [({c: (a.currency, a.anchor) for c, a in self.money.items()},)]
        return spark.createDataFrame(rows, "_anchors map<string, struct<currency: string, anchor: double>>")


ANCHORS = "kind string, column_name string, currency string, anchor double, rows long"


def _positive(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (x > 0)


def _in_domain(domain: str | None) -> Column:
    return ~F.coalesce(F.col(domain).isin("foreign", "unlikely"), F.lit(False)) if domain else F.lit(True)


def _spread(df: DataFrame, columns: dict[str, tuple[str, str]], default: str) -> dict[str, str]:
    """name → (currency, amount) columns gives the currency of rows without one: the column's own, where one ($ is one too) is explicit in more than 80% of
    the labelled rows; but a foreign one is not spread over amounts whose median is local."""
    codes = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).alias("code")) for n, (c, _) in columns.items()]))
    counts = df.select(codes.alias("r")).where("r.code is not null").groupBy("r.name", "r.code").agg(F.count("*").alias("n"))  # one row a currency
    told = counts.groupBy("name").agg(F.sum("n").alias("all"), F.max(F.struct("n", "code")).alias("most")).collect()
    out = {r["name"]: r["most"]["code"] for r in told if r["most"]["n"] / r["all"] > 0.8}
    foreign = {n: (F.when(F.col(columns[n][0]).isNull(), F.col(columns[n][1])), 0.5) for n, code in out.items() if code in ("USD", "EUR")}
    for n, middle in (statistics.quantiles(df, foreign) if foreign else {}).items():
        out[n] = default if middle is not None and middle > 5000 else out[n]
    return {n: out.get(n, default) for n in columns}


def _scales(df: DataFrame, columns: dict[str, tuple[str, float, float]], domain: str | None) -> dict[str, float | None]:
    """name → (amount, low, high) gives the anchor of each: the median of in-range, in-domain values within the Tukey fence, by exact
    quantiles. All columns share their passes, so ``df`` should be cheap to read."""
    inside, some, asked = {}, {}, {}
    for n, (c, low, high) in columns.items():
        inside[n] = _positive(F.col(c)) & _in_domain(domain)
        some[n] = F.when(inside[n] & F.col(c).between(low, high), F.col(c))
        asked |= {f"{n} q1": (some[n], 0.25), f"{n} q3": (some[n], 0.75), f"{n} in_range": (some[n], 0.5), f"{n} overall": (F.when(inside[n], F.col(c)), 0.5)}
    told = statistics.quantiles(df, asked)
    out, fenced = {n: told[f"{n} overall"] for n in columns}, {}
    flat = [n for n in columns if told[f"{n} q1"] is not None and told[f"{n} q1"] == told[f"{n} q3"]]
    spreads = dict(zip(flat, df.agg(*[F.stddev_samp(some[n]) for n in flat]).first())) if flat else {}
    for n, (c, low, high) in columns.items():
        q1, q3 = told[f"{n} q1"], told[f"{n} q3"]
        if q1 is not None:
            width = q3 - q1 or spreads[n] or 1.0
            out[n] = told[f"{n} in_range"]
            fenced[n] = (F.when(inside[n] & F.col(c).between(max(q1 - 1.5 * width, low), min(q3 + 1.5 * width, high)), F.col(c)), 0.5)
    return out | {n: m for n, m in (statistics.quantiles(df, fenced) if fenced else {}).items() if m is not None}


def infer_currency(df: DataFrame, currency: str, amount: str, out: str, default: str = BASE) -> DataFrame:
    """Rows without a currency get the column's own."""
    return df.withColumn(out, F.coalesce(F.col(currency), F.lit(_spread(df, {"c": (currency, amount)}, default)["c"])))


def rescaled(amount: Column, anchor: Column, currency: Column | None, inside: Column, scale_down: bool) -> tuple[Column, Column]:
    """Amounts a thousand times too small or large against the anchor, moved by 1000, and whether they were. A move holds only if it comes nearer to
    the anchor (in logarithms) and stays within a hundredth and a hundred times of it."""
    factor = F.when(amount < anchor / 20, 1000.0)
    factor = factor.when(amount > anchor * 20, 0.001) if scale_down else factor
    factor = factor.otherwise(1.0)
    if currency is not None:
        factor = F.when(F.coalesce(currency.isin("USD", "EUR"), F.lit(False)), 1.0).otherwise(factor)
    moved = amount * factor
    nearer = F.abs(F.ln(moved) - F.ln(anchor)) < F.abs(F.ln(amount) - F.ln(anchor))
    takes = F.coalesce(_positive(amount) & inside & (factor != 1.0) & nearer & moved.between(anchor / 100, anchor * 100), F.lit(False))
    return F.when(takes, moved).otherwise(amount), takes


def normalize_scale(df: DataFrame, amount: str, out: str, low: float, high: float, currency: str | None = None, domain: str | None = None, scale_down: bool = True) -> DataFrame:
    """Amounts moved to the scale of their column's own anchor. Adds ``out`` and ``<out>_scaled``; NaN is no amount."""
    anchor = F.lit(_scales(df, {"c": (amount, low, high)}, domain)["c"]).cast("double")
    value, takes = rescaled(F.col(amount), anchor, F.col(currency) if currency else None, _in_domain(domain), scale_down)
    return df.withColumns({out: value, f"{out}_scaled": takes})


def scale_report(df: DataFrame, amount: str, scaled: str) -> DataFrame:
    return df.agg(F.count(amount).alias("processed"), F.count_if(F.col(scaled)).alias("corrected"))


def exchange(amount: Column, currency: Column, rates: dict[str, float] = RATES, base: str = BASE) -> tuple[Column, Column]:
    """Amount and currency after conversion to ``base``; unknown currencies and nulls stay as they are."""
    code, rate = F.upper(F.trim(currency)), F.lit(None).cast("double")
    for c, r in rates.items():
        rate = F.when(code == c, F.lit(float(r))).otherwise(rate)
    converts = amount.isNotNull() & (code != base) & rate.isNotNull()
    return F.when(converts, amount * rate).otherwise(amount), F.when(converts | (amount.isNotNull() & (code == base)), F.lit(base)).otherwise(currency)


def _is_shipping(target: str) -> bool:
    return any(k in target.lower() for k in SHIPPING)


def _bounds(target: str) -> tuple[float, float]:
    return (1000.0, 50000.0) if _is_shipping(target) else (5000.0, 5000000.0)


def _parsed(df: DataFrame, targets: list[str]) -> DataFrame:
    """Amount and currency of all money columns, in one projection."""
    out = {}
    for t in targets:
        raw = F.col(t).cast("string")
        out |= {f"{t}_parsed": money.parse_money_text(raw), f"_code_{t}": money.extract_currency(raw)}
    return df.withColumns(out)


def _learned(parsed: DataFrame, targets: list[str], domain: str | None) -> dict[str, Anchor]:
    currencies = _spread(parsed, {t: (f"_code_{t}", f"{t}_parsed") for t in targets}, BASE)
    scales = _scales(parsed, {t: (f"{t}_parsed", *_bounds(t)) for t in targets}, domain)
    return {t: Anchor(currencies[t], scales[t]) for t in targets}


def _normalized(df: DataFrame, targets: list[str], domain: str | None, anchors: dict[str, Anchor] | DataFrame | None) -> DataFrame:
    """Origin, scaled and converted amounts of ``targets``. Without anchors, texts are parsed once and stored, and the statistics read what is stored;
    with them, each row stands alone. Anchors may be a frame of one row, which a stream joins anew with each batch."""
    # Columns that end in _sucio go first, so such a target gives nothing.
    df = df.drop(*[c for c in df.columns if c.endswith("_sucio")])
    targets = [t for t in targets if t in df.columns]
    if not targets:
        return df
    before = df.columns
    df = _parsed(df, targets)
    if anchors is None:
        df = staged(df)
        anchors = _learned(df, targets, domain)
    joined = isinstance(anchors, DataFrame)
    df = df.join(F.broadcast(anchors)) if joined else df  # one row
    added = []
    for t in targets:
        of = (lambda what, t=t: F.col("_anchors")[t][what]) if joined else (lambda what, t=t: F.lit(getattr(anchors[t], what)))
        df = df.withColumn(f"{t}_moneda_origen", F.coalesce(F.col(f"_code_{t}"), of("currency")))
        value, takes = rescaled(F.col(f"{t}_parsed"), of("anchor").cast("double"), F.col(f"{t}_moneda_origen"), _in_domain(domain), not _is_shipping(t))
        df = df.withColumns({f"{t}_monto_origen": value, f"{t}_scale_corrected": takes})
        amount, code = exchange(F.col(f"{t}_monto_origen"), F.col(f"{t}_moneda_origen"))
        df = df.withColumns({f"{t}_final": amount, f"{t}_final_currency": code})
        added += [f"{t}_{x}" for x in ("parsed", "moneda_origen", "monto_origen", "final", "final_currency", "scale_corrected")]
    return df.select(*[F.col(f"`{c}`") for c in [*before, *added]])


def normalize_money(df: DataFrame, target: str, domain: str | None = None) -> DataFrame:
    """Parsed, scaled and converted amounts of a money column, with their origin."""
    if domain is None and (desc := next((c for c in df.columns if any(k in c.lower() for k in ("producto", "item", "descripcion", "nombre"))), None)):
        df, domain = df.withColumn("_domain_", text.classify_domain(F.col(desc))), "_domain_"
    return _normalized(df, [target], domain, None).drop("_domain_")


def annotate_movement(df: DataFrame) -> DataFrame:
    amounts, states, notes = named(df, MONEY), named(df, STATE), named(df, NOTE)
    if not amounts and not states:
        return df
    if states and notes:
        return df.withColumns({"tipo_movimiento": text.movement_from_note(F.col(notes[0]), F.col(states[0])), "tipo_confianza": text.note_confidence(F.col(notes[0]))})
    if states:
        return df.withColumns({"tipo_movimiento": F.upper(F.col(states[0]).cast("string")), "tipo_confianza": F.lit(0.5)})
    return df.withColumns({"tipo_movimiento": F.lit("VENTA"), "tipo_confianza": F.lit(0.3)})


def serial_date_columns(df: DataFrame) -> DataFrame:
    """(column, is_serial_date) of the numeric columns, from one aggregate."""
    numeric = [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float")]
    ok = lambda x: (F.count(x) > 0) & (F.count_if(x % 1 != 0) == 0) & (F.min(x) >= 30000) & (F.max(x) <= 60000) & (F.coalesce(F.stddev_samp(x) / F.avg(x), F.lit(0.0)) < 0.15)
    wide = df.agg(*[F.coalesce(ok(F.col(c).cast("double")), F.lit(False)).alias(c) for c in numeric])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("is_serial_date")) for c in numeric])).alias("r")).select("r.*")


def _flagged(df: DataFrame) -> tuple[DataFrame, list[str], str | None]:
    """``df`` with its domain flag and meaning of states, its money columns, and the flag's name."""
    moneys, states, products = named(df, MONEY), named(df, STATE), named(df, PRODUCT)
    if products and (moneys or states):
        df = df.withColumn(f"{products[0]}_domain_flag", text.classify_domain(F.col(products[0])))
    if states and (notes := named(df, NOTE)):
        df = df.withColumn(f"{states[0]}_semantic", text.movement_from_note(F.col(notes[0]), F.col(states[0])))
    return df, moneys, f"{products[0]}_domain_flag" if products else None


def _serial(df: DataFrame) -> list[str]:
    numeric = any(t in ("int", "bigint", "double", "float") for _, t in df.dtypes)
    return [r["column_name"] for r in serial_date_columns(df).where("is_serial_date").collect()] if numeric else []  # one row a column


def learn(df: DataFrame) -> Anchors:
    """The statistics of a whole table that ``enrich`` rests on, to be saved and used on rows that come later."""
    flagged, moneys, domain = _flagged(df)
    kept = flagged.select(*[c for c in flagged.columns if c in moneys and not c.endswith("_sucio") or c == domain])
    moneys = [c for c in moneys if c in kept.columns]
    return Anchors(_learned(staged(_parsed(kept, moneys).drop(*moneys)), moneys, domain) if moneys else {}, _serial(df))


def enrich(df: DataFrame, anchors: Anchors | None = None) -> DataFrame:
    """All phases that the columns' names call for: domains, movements, money, serial dates.

    Statistics come from ``df`` itself, or from ``anchors``: then nothing is counted, and ``df`` may be a stream.
    """
    given = df.columns
    df, moneys, domain = _flagged(df)
    frozen = None if anchors is None else anchors.frame(df.sparkSession) if df.isStreaming else anchors.money
    if anchors is not None:
        moneys = [c for c in moneys if c in anchors.money]
    df = _normalized(df, moneys, domain, frozen)
    # Told by what is stored by now, where money columns were parsed.
    serial = _serial(df.select(*[F.col(f"`{c}`") for c in given if c in df.columns])) if anchors is None else [c for c in anchors.serial if c in df.columns]
    return df.withColumns({f"{c}_as_date": dates.serial_to_date(F.col(c)) for c in serial})
