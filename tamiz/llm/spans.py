"""Places of all matches of a pattern and the words around them, in SQL functions: the text is split by
the pattern, and a match starts after the pieces and matches before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_WHITE = "\t\n\x0b\x0c\r"


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def matches(text: Column, pattern: Column) -> Column:
    """array of (gap, value, before, after): length of the piece before each match, the match, the last three
    words before it (with the match before, if it is near) and the first word after it, whole and lower-case.
    What touches the match counts as a word."""

    def found(piece: Column, value: Column) -> Column:
        def one(v: Column, k: Column) -> Column:
            before = F.rtrim(F.translate(F.concat(F.coalesce(F.get(value, k - 1), F.lit("")), F.get(piece, k)), _WHITE, " " * 5))
            after = F.ltrim(F.translate(F.coalesce(F.get(piece, k + 1), F.lit("")), _WHITE, " " * 5))
            return F.struct(
                F.char_length(F.get(piece, k)).alias("gap"), v.alias("value"), F.lower(F.substring_index(before, " ", -3)).alias("before"), F.lower(F.substring_index(after, " ", 1)).alias("after"))

        return F.transform(value, one)

    return _let(F.split(text, pattern, -1), lambda piece: _let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda value: found(piece, value)))


def placed(rows: DataFrame, keys: list[str], found: str) -> DataFrame:
    """``rows`` with one row a match of the array ``found``: start and end (code points, end exclusive), value, before, after."""
    others = [c for c in rows.columns if c != found]
    one = rows.select(*others, F.posexplode(found).alias("_k", "_m"))
    order = Window.partitionBy(*keys).orderBy("_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("_m.gap") + F.char_length("_m.value")).over(order)
    one = one.withColumn("end", end.cast("long"))
    return one.select(*others, (F.col("end") - F.char_length("_m.value")).alias("start"), "end", F.col("_m.value").alias("value"), F.col("_m.before").alias("before"), F.col("_m.after").alias("after"))
