"""Text columns: ids, products, places, ordered keyword classes. Every function is Column → Column."""

from __future__ import annotations

import functools
import json
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.money import let

# They must equal the original tables for equal results.
STATES = {"vendido": "VENDIDO", "comprado": "COMPRADO", "pendiente": "PENDIENTE", "devuelto": "DEVUELTO", "cambio": "CAMBIO"}
CATEGORIES = [
    ("PREPARADOS Y SOPAS", ["SOPA", "GUISO", "POTAGE", "SUPREMO"]),
    ("LEGUMBRES", ["ARVEJA", "LENTEJA", "POROTO", "GARBANZO"]),
    ("CEREALES Y HARINAS", ["CHUCHOCA", "CHUÑO", "CHUNO", "HARINA", "MAIZ", "POLENTA", "CEBADA", "TRIGO", "CURAGUA"]),
]
FAMILIES = [
    ("SOPA MIXTA", ["SOPA"]), ("GUISO DE LENTEJAS", ["GUISO"]), ("POTAGE DE GARBANZO", ["POTAGE"]), ("SUPREMO DE ARVEJAS", ["SUPREMO"]),
    ("ARVEJAS", ["ARVEJA"]), ("LENTEJAS", ["LENTEJA"]), ("POROTOS", ["POROTO"]), ("GARBANZOS", ["GARBANZO"]), ("CHUCHOCA", ["CHUCHOCA"]),
    ("CHUÑO", ["CHUÑO", "CHUNO"]), ("HARINA TOSTADA", ["HARINA"]), ("MAIZ", ["MAIZ", "CURAGUA"]), ("POLENTA", ["POLENTA"]),
    ("PERLAS DE CEBADA", ["CEBADA"]), ("TRIGO MOTE", ["TRIGO"]),
]
BRANDS = ["logitech", "samsung", "apple", "dell", "hp", "lenovo", "asus", "sony"]
TECH = [r"[0-9]{1,3}gb", r"[0-9]{1,3}tb", r"rtx\s?[0-9]{4}", r"gtx\s?[0-9]{4}", r"rx\s?[0-9]{4}", r"core\s?i[0-9]", r"ryzen\s?[0-9]"]
EXCLUSIONS = ["pizza", "flete", "empanada", "empanadas", "transporte", "envio", "comida"]
NOTE_SIGNALS = [(r"prest[eéó]", "PRESTAMO", 0.95), (r"devol(vi|ucion)", "DEVOLUCION", 0.90), (r"ajust[eo]", "AJUSTE", 0.85), (r"vend(id[oa]|i)", "VENTA", 0.80)]
ACCENTS = ("áéíóúüñÁÉÍÓÚÜÑ", "aeiouunAEIOUUN")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip_accents(c: Column) -> Column:
    return F.translate(c, *ACCENTS)


def clean_text(c: Column) -> Column:
    """Inner white space becomes one space; an empty text becomes null."""
    return blank_to_null(F.trim(F.regexp_replace(c, r"\s+", " ")))


def restore_id(c: Column, prefix: str = "TRX-") -> Column:
    """The first run of digits, padded to four, behind ``prefix``; null where there are no digits."""
    digits = F.regexp_extract(c, "([0-9]+)", 1)
    bare = F.regexp_replace(digits, "^0+", "")
    padded = F.when(F.length(bare) < 4, F.lpad(bare, 4, "0")).otherwise(bare)  # lpad alone would cut longer ids
    return F.when(digits != "", F.concat(F.lit(prefix), padded))


def normalize_product(c: Column) -> Column:
    return blank_to_null(F.trim(F.regexp_replace(F.upper(c), "[^A-Z0-9]+", " ")))


def normalize_state(c: Column) -> Column:
    known = F.lower(F.trim(c))
    out = F.lit("DESCONOCIDO")
    for text, state in STATES.items():
        out = F.when(known == text, state).otherwise(out)
    return out


def classify_movement(amount: Column, state: Column) -> Column:
    s = F.lower(F.trim(F.coalesce(state, F.lit(""))))
    negative = F.when(s.contains("devol"), "DEVOLUCION").when(s.contains("cambio") | s.contains("ajuste"), "AJUSTE").otherwise("REEMBOLSO")
    return (
        F.when(amount < 0, negative).when(s.contains("devol"), "DEVOLUCION").when(s.contains("cambio"), "CAMBIO")
        .when(s.contains("ajuste"), "AJUSTE").when(s.contains("reembol"), "REEMBOLSO").otherwise("VENTA")
    )


def strip_code_prefix(c: Column) -> Column:
    """Leading local codes go, however often repeated; inner dashes become spaces; upper case."""
    bare = F.regexp_replace(clean_text(c), r"(?i)^(?:\s*[A-Z]{0,2}[0-9]{2,5}\s*[-–]\s*)+", "")
    return clean_text(F.upper(F.regexp_replace(bare, r"\s*[-–]\s*", " ")))


def local_code(c: Column) -> Column:
    return F.upper(blank_to_null(F.regexp_extract(c, r"^\s*([A-Z]{0,2}[0-9]{2,5})\b", 1)))


def region_code(c: Column) -> Column:
    return blank_to_null(F.regexp_extract(clean_text(c), r"^([IVXRM]{1,4})\s*-", 1))


def region_name(c: Column) -> Column:
    return F.trim(F.regexp_replace(clean_text(c), r"^[IVXRM]{1,4}\s*-\s*", ""))


def title_case(c: Column) -> Column:
    """Capitals after white space, apostrophes and dashes alike."""
    marked = F.regexp_replace(F.lower(c), r"(['’-])", "$1\u0001 ")
    return F.replace(F.initcap(marked), F.lit("\u0001 "), F.lit(""))


# Typing errors of a brand with what they stand for, units of a pack, the packaging mark.
BRAND_TYPOS = [(r"\bMARITNI\b", "MARTINI"), (r"\bMART\s+INI\b", "MARTINI")]
PACK = r"(?i)([0-9]{2,4})\s*(KG|GRS|GR|G)\b\.?"
PACKAGING = r"\bRRP\b"


def retail_product(c: Column) -> Column:
    text = F.regexp_replace(F.upper(F.trim(F.regexp_replace(c, r"\s+", " "))), r"\.+$", "")
    for typo, brand in BRAND_TYPOS:
        text = F.regexp_replace(text, typo, brand)
    return blank_to_null(text)


def pack_grams(c: Column) -> Column:
    value = F.try_to_number(F.regexp_extract(c, PACK, 1), F.lit("9999")).cast("double")
    return value * F.when(F.upper(F.regexp_extract(c, PACK, 2)) == "KG", 1000.0).otherwise(1.0)


def pack_label(c: Column) -> Column:
    return F.concat(pack_grams(c).cast("long").cast("string"), F.lit(" g"))


def product_base(c: Column) -> Column:
    """The name without size, packaging mark and punctuation."""
    bare = F.regexp_replace(F.regexp_replace(c, PACK, " "), PACKAGING, " ")
    return clean_text(F.regexp_replace(F.upper(bare), r"[^A-ZÁÉÍÓÚÑ0-9/ ]+", " "))


def keyword_class(c: Column, table: list[tuple[str, list[str]]], other: str = "OTROS") -> Column:
    """The first label with a token that the text contains; null stays null."""
    def first_label(text: Column) -> Column:
        out = F.lit(other)
        for label, tokens in reversed(table):
            hit = F.lit(False)
            for token in tokens:
                hit = hit | text.contains(token)
            out = F.when(hit, label).otherwise(out)
        return F.when(text.isNotNull(), out)

    return let(F.upper(c), first_label)


def packaging(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")).rlike(PACKAGING), "RRP").otherwise("ESTANDAR")


def domain_score(c: Column) -> Column:
    """Tenths, so that sums are exact: brand +5 once, each technical pattern +3, each exclusion −7."""
    text = F.lower(c)
    brand = F.lit(False)
    for b in BRANDS:
        brand = brand | text.contains(b)
    score = F.when(brand, 5).otherwise(0)
    for p in TECH:
        score = score + F.when(text.rlike(p), 3).otherwise(0)
    for x in EXCLUSIONS:
        score = score - F.when(text.contains(x), 7).otherwise(0)
    return F.coalesce(score, F.lit(0))


def classify_domain(c: Column) -> Column:
    score = domain_score(c)
    return F.when(score < 0, "foreign").when(score > 0, "tech_product").otherwise("unknown")


def movement_from_note(note: Column, state: Column) -> Column:
    """The heaviest signal of the note, else the state in upper case."""
    text, out = F.lower(F.coalesce(note, F.lit(""))), F.upper(F.coalesce(state, F.lit("UNKNOWN")))
    for pattern, movement, _ in reversed(NOTE_SIGNALS):
        out = F.when(text.rlike(pattern), movement).otherwise(out)
    return out


def note_confidence(note: Column) -> Column:
    text, out = F.lower(F.coalesce(note, F.lit(""))), F.lit(0.5)
    for pattern, _, weight in reversed(NOTE_SIGNALS):
        out = F.when(text.rlike(pattern), weight).otherwise(out)
    return out


@functools.cache
def _compatibility() -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """What NFKC makes of single characters: one other character, several, or one for a letter and its marks.
    Made from Python's Unicode data for the Basic Multilingual Plane, but for Hangul syllables."""
    plane = [chr(i) for i in range(0x80, 0x10000) if not 0xD800 <= i < 0xE000 and not 0xAC00 <= i < 0xD7A4]
    plain = {c: n for c in plane if (n := unicodedata.normalize("NFKC", c)) != c}
    marked = {d: c for c in plane if c not in plain and len(d := unicodedata.normalize("NFD", c)) > 1}
    return {c: n for c, n in plain.items() if len(n) == 1}, {c: n for c, n in plain.items() if len(n) > 1}, marked


def nfkc(c: Column) -> Column:
    """Compatible forms to plain ones: full-width letters, ligatures, superscripts, circled digits, letters with
    separate accents. Texts of ASCII alone, nearly all, are passed at once."""
    single, several, marked = _compatibility()
    table = lambda d: F.from_json(F.lit(json.dumps(d)), "map<string,string>")  # noqa: E731  a constant
    mapped = lambda text, pattern, d: F.array_join(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.coalesce(F.try_element_at(table(d), x), x)), "")

    def spread(text: Column) -> Column:
        return F.when(F.translate(text, "".join(several), "") != text, mapped(text, "(?s).", several)).otherwise(text)

    def joined(text: Column) -> Column:
        return F.when(text.rlike(r"\p{M}"), mapped(text, r"(?s)\P{M}?\p{M}+|\P{M}", marked)).otherwise(text)

    full = let(let(F.translate(c, "".join(single), "".join(single.values())), spread), joined)
    return F.when(c.rlike(r"[^\x00-\x7F]"), full).otherwise(c)


def sanitize(c: Column) -> Column:
    """NFKC, control characters out, spaces collapsed, empty and nan to null."""
    text = F.trim(F.regexp_replace(F.regexp_replace(nfkc(c), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", ""), r"\s+", " "))
    return F.when(~F.lower(text).isin("", "nan"), text)
