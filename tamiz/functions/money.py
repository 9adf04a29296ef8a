"""Amounts and currencies written by hand."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# Number words and magnitudes.
NUMBER_WORDS = {
    "cero": 0, "un": 1, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
    "diez": 10, "once": 11, "doce": 12, "trece": 13, "catorce": 14, "quince": 15, "dieciseis": 16, "dieciséis": 16, "diecisiete": 17,
    "dieciocho": 18, "diecinueve": 19, "veinte": 20, "veintiuno": 21, "veintidos": 22, "veintidós": 22, "veintitres": 23,
    "veintitrés": 23, "veinticuatro": 24, "veinticinco": 25, "veintiseis": 26, "veintiséis": 26, "veintisiete": 27, "veintiocho": 28,
    "veintinueve": 29, "treinta": 30, "cuarenta": 40, "cincuenta": 50, "sesenta": 60, "setenta": 70, "ochenta": 80, "noventa": 90,
    "cien": 100, "ciento": 100, "doscientos": 200, "trescientos": 300, "cuatrocientos": 400, "quinientos": 500, "seiscientos": 600,
    "setecientos": 700, "ochocientos": 800, "novecientos": 900,
}
MAGNITUDES = {"k": 1e3, "m": 1e6, "mil": 1e3, "miles": 1e3, "millon": 1e6, "millones": 1e6, "lucas": 1e3, "palo": 1e6, "palos": 1e6}
MULTIPLIERS = {"k": 1e3, "mil": 1e3, "miles": 1e3, "lucas": 1e3, "palo": 1e6, "palos": 1e6, "m": 1e6, "millon": 1e6, "millones": 1e6}
SMALL_WORDS = {
    "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9, "diez": 10, "veinte": 20,
    "treinta": 30, "cuarenta": 40, "cincuenta": 50, "sesenta": 60, "setenta": 70, "ochenta": 80, "noventa": 90, "cien": 100, "un": 1,
}
SYMBOLS = [("$", "CLP"), ("us$", "USD"), ("usd", "USD"), ("€", "EUR"), ("eur", "EUR"), ("clp", "CLP")]
KEYWORDS = [("usd", "USD"), ("dolar", "USD"), ("dólar", "USD"), ("dolares", "USD"), ("euros", "EUR"), ("euro", "EUR"), ("clp", "CLP"), ("peso", "CLP"), ("pesos", "CLP"), ("lucas", "CLP")]
_LETTER = "a-z0-9_áéíóúüñ"


def _whole(word: str) -> str:
    return rf"(?:^|[^{_LETTER}]){word}(?:[^{_LETTER}]|$)"


def _has(text: Column, word: str, pattern: str) -> Column:
    """``pattern`` holds, every match of which has ``word`` in it: a search for the word spares most texts the regex."""
    return text.contains(word) & text.rlike(pattern)


def words_to_number(c: Column) -> Column:
    """Number words add up; a magnitude multiplies what has been gathered (1 if nothing) and starts anew; 0 is null."""
    tokens = F.array_remove(F.split(F.regexp_replace(F.lower(c), r"[^a-záéíóúüñ0-9\s]", " "), r"\s+"), "")
    pairs = lambda table: F.create_map(*[F.lit(x) for k, v in table.items() for x in (k, float(v))])
    numbers, magnitudes = pairs(NUMBER_WORDS), pairs(MAGNITUDES)
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("current"))

    def step(a: Column, token: Column) -> Column:
        number = F.coalesce(F.try_element_at(numbers, token), F.when(token.rlike("^[0-9]+$"), token.try_cast("double")))
        times = F.try_element_at(magnitudes, token)
        grown = F.struct((a["total"] + F.when(a["current"] == 0, 1.0).otherwise(a["current"]) * times).alias("total"), F.lit(0.0).alias("current"))
        more = F.struct(a["total"].alias("total"), (a["current"] + number).alias("current"))
        return F.when(number.isNotNull(), more).when(times.isNotNull(), grown).otherwise(a)

    return let(F.aggregate(tokens, start, step, lambda a: a["total"] + a["current"]), lambda v: F.when(v > 0, v))


def _separators(body: Column) -> Column:
    """Decimal text of digits with points and commas."""
    def single(mark: str, other_is_decimal: Column) -> Column:
        parts = F.split(body, rf"[{mark}]")
        thousands = (F.size(parts) > 2) | ((F.length(F.element_at(parts, -1)) == 3) & F.length(F.get(parts, F.lit(0))).between(1, 3))
        return F.when(thousands, F.replace(body, F.lit(mark), F.lit(""))).otherwise(other_is_decimal)

    last = lambda mark: F.length(body) - F.length(F.substring_index(body, mark, -1))
    no_dots, no_commas = F.replace(body, F.lit("."), F.lit("")), F.replace(body, F.lit(","), F.lit(""))
    return (
        F.when(body.contains(".") & body.contains(","), F.when(last(",") > last("."), F.replace(no_dots, F.lit(","), F.lit("."))).otherwise(no_commas))
        .when(body.contains("."), single(".", body)).when(body.contains(","), single(",", F.replace(body, F.lit(","), F.lit(".")))).otherwise(body)
    )


def parse_price(c: Column) -> Column:
    """First number of a text, whichever separators it uses, times the first magnitude word; else number words."""
    kept = F.regexp_replace(c, r"[^0-9.,+\-\s  ]", " ")
    joined = F.regexp_replace(kept, r"(?<=[0-9])[\s  ]+(?=[0-9])", "")
    found = F.regexp_extract(joined, r"([+-]?[0-9]+(?:[.,][0-9]+)*)", 1)

    def number(f: Column) -> Column:
        amount = let(F.regexp_replace(f, "^[+-]", ""), lambda b: F.when(b != "", _separators(b)).try_cast("double"))
        return amount * F.when(f.startswith("-"), -1.0).otherwise(1.0)

    def magnitude(lower: Column) -> Column:
        times = F.lit(1.0)
        for word, value in reversed(MAGNITUDES.items()):
            times = F.when(_has(lower, word, _whole(word)), value).otherwise(times)
        return F.when(lower.rlike("|".join(MAGNITUDES)), times).otherwise(1.0)  # most amounts have no such word

    return let(let(found, number) * let(F.lower(c), magnitude), lambda v: F.when(v.isNotNull(), v).otherwise(words_to_number(c)))


def detect_currency(c: Column) -> Column:
    """Symbols in order ($ first, so US$ is CLP too), then whole keywords."""
    def read(text: Column) -> Column:
        out = F.lit("DESCONOCIDA")
        for word, code in reversed(KEYWORDS):
            out = F.when(_has(text, word, _whole(word)), code).otherwise(out)
        for symbol, code in reversed(SYMBOLS):
            out = F.when(text.contains(symbol), code).otherwise(out)
        return out

    return let(F.lower(F.trim(c)), read)


def parse_money_text(c: Column) -> Column:
    """Every multiplier word counts, alone or attached to digits; number words become digits; signs are lost."""
    words = list(MULTIPLIERS.items())

    def finish(text: Column, times: Column) -> Column:
        digits = text
        for word, value in SMALL_WORDS.items():
            digits = F.regexp_replace(digits, rf"\b{word}\b", str(value))
        spoken = text.rlike("[a-z]") & text.rlike(rf"\b(?:{'|'.join(SMALL_WORDS)})\b")  # one look spares most amounts the twenty replacements
        return let(F.regexp_replace(F.when(spoken, digits).otherwise(text), r"[a-z\s]", ""), lambda t: _plain(t).try_cast("double") * times)

    def step(a: Column, k: Column) -> Column:
        hit, cut = F.when(F.lit(False), False), F.when(F.lit(False), "")
        for i, (word, _) in enumerate(words):
            hit = hit.when(k == i, _has(a["t"], word, rf"(?:\b|[0-9]){word}\b"))
            cut = cut.when(k == i, F.trim(F.regexp_replace(a["t"], rf"{word}\b", "")))
        value = F.get(F.array(*[F.lit(v) for _, v in words]), k)
        return F.when(hit, F.struct(cut.alias("t"), (a["x"] * value).alias("x"))).otherwise(a)

    def cut_down(text: Column) -> Column:
        start = F.struct(text.alias("t"), F.lit(1.0).alias("x"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(len(words) - 1)), start, step, lambda a: finish(a["t"], a["x"]))

    # Most amounts have no multiplier at all, and need none of its steps.
    text = F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9\s.,]", ""))
    return let(text, lambda t: F.when(t.rlike("|".join(MULTIPLIERS)), cut_down(t)).otherwise(finish(t, F.lit(1.0))))


def _plain(text: Column) -> Column:
    last = lambda mark: F.length(text) - F.length(F.substring_index(text, mark, -1))
    no_dots, no_commas = F.replace(text, F.lit("."), F.lit("")), F.replace(text, F.lit(","), F.lit(""))
    return (
        F.when(text.rlike(r"^[0-9]{1,3}(\.[0-9]{3})+$"), no_dots).when(text.rlike(r"^[0-9]{1,3}(,[0-9]{3})+$"), no_commas)
        .when(text.contains(",") & text.contains("."), F.when(last(",") > last("."), F.replace(no_dots, F.lit(","), F.lit("."))).otherwise(no_commas))
        .otherwise(F.replace(text, F.lit(","), F.lit(".")))
    )


def extract_currency(c: Column) -> Column:
    code = F.regexp_extract(F.upper(c), r"\b(CLP|USD|EUR|GBP|MXN|ARS|BRL)\b", 1)
    return F.when(code != "", code).when(c.contains("$"), "$")
