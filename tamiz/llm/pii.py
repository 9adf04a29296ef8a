"""Personal data by bootstrapped contextual extraction, in SQL functions only.

The base patterns find the seeds; long mixed strings of letters and digits are supposed to be secrets.
What stands around a seed makes lexical patterns of its kind: the word, the two and the three words before
it, and the words on both sides. Patterns and the identifiers that they introduce form a graph, which is
scored in rounds, until one finds no new identifier: a pattern is as good as the identifiers it introduces, an identifier as likely as its
patterns make it (noisy-or over the patterns of one sort, the best of the sorts, as these overlap).
Digit groups, words with an @ and mixed strings that the base patterns missed are taken where good
patterns introduce them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.common import documents, let, small_or_shuffled, stored
from tamiz.llm.spans import matches, placed

#: Kinds in order and their patterns. Possessive, so that long runs of digits need no
#: stack and no retries, and begun where a run begins, so that each is read once; what they match is the same.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have for a kind to be looked for.
GATES = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
#: Kinds that the method may find; secret has no base pattern.
ALL_KINDS = [*KINDS, "secret"]
#: name: (gate, pattern) of what may be an identifier: digit groups, words with an @, mixed strings.
CANDIDATES = {
    "group": (r"[0-9]", r"(?<![0-9A-Za-z_])\(?[0-9]++(?:[\x20().:-]{1,2}+[0-9]++)*+"),
    "at": (r"@", r"(?<![^\x20\x09-\x0D@])[^\x20\x09-\x0D@]++@[^\x20\x09-\x0D@]++"),
    "mixed": (r"[0-9]", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{12,}+"),
}
LEAST_SEEDS = 3
LEAST_CONFIDENCE = 0.8
#: Identifiers that a pattern is taken to have introduced wrongly before any is seen.
DOUBT = 1.0
#: A mixed string of so many characters is supposed to be a secret, a shorter one is a candidate.
SECRET_CHARACTERS = 32


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    figures = F.transform(F.split(F.reverse(_digits(value)), ""), lambda x: x.cast("int"))
    doubled = F.transform(figures, lambda x, i: F.when(i % 2 == 0, x).otherwise(x * 2 - F.when(x > 4, F.lit(9)).otherwise(F.lit(0))))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def is_valid(kind: Column, value: Column) -> Column:
    """The checks of each kind on a match of its pattern."""
    part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    n = F.char_length(_digits(value))
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", F.rlike(value, F.lit(rf"^{part}\.{part}\.{part}\.{part}$".replace("0*+", "0*"))))
        .when(kind == "card", F.when(n.between(16, 19), _luhn(value)).otherwise(F.lit(False)))
        .otherwise(n.between(8, 15))
    )


def _is_mixed(value: Column) -> Column:
    """Letters and several digits in turns, as in keys and hashes, and not in words or numbers."""
    turns = F.regexp_count(value, F.lit("[A-Za-z][0-9]")) + F.regexp_count(value, F.lit("[0-9][A-Za-z]"))
    return (F.char_length(_digits(value)) >= 3) & (turns * 8 >= F.char_length(value))


def _kinds_of(value: Column) -> Column:
    """The kinds that a candidate could be."""
    n, at = F.char_length(_digits(value)), value.contains("@")
    numeric = ~at & ~F.rlike(value, F.lit("[A-Za-z]"))
    return F.array_compact(F.array(
        F.when(at, F.lit("email")),
        F.when(F.rlike(value, F.lit(r"^[0-9]{1,3}+([.:][0-9]{1,3}+){3}$")), F.lit("ip")),
        F.when(numeric & n.between(12, 19), F.lit("card")),
        F.when(numeric & n.between(7, 15), F.lit("phone")),
        F.when(~at & ~numeric & _is_mixed(value), F.lit("secret")),
    ))


def _found(docs: DataFrame) -> DataFrame:
    """(doc_id, row, kinds): matches of each base kind and of candidates, of each whole text, in one pass."""
    text = F.coalesce(F.col("text"), F.lit(""))
    nothing = F.array().cast("array<struct<gap:int,value:string,before:string,after:string>>")
    patterns = {k: (GATES[k], p) for k, p in KINDS.items()} | CANDIDATES
    kinds = [F.struct(F.lit(kind).alias("kind"), F.when(F.rlike(text, F.lit(gate)), matches(text, F.lit(pattern))).otherwise(nothing).alias("found")) for kind, (gate, pattern) in patterns.items()]
    return stored(docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.filter(F.array(*kinds), lambda x: F.size(x["found"]) > 0).alias("kinds")))


def _contexts(before: Column, after: Column) -> Column:
    """(sort, pattern) of the words around a match."""
    word = F.substring_index(before, " ", -1)
    sorts = {"1": word, "2": F.substring_index(before, " ", -2), "3": before, "both": F.concat(word, F.lit(" _ "), after)}
    return F.filter(F.array(*[F.struct(F.lit(s).alias("sort"), p.alias("pattern")) for s, p in sorts.items()]), lambda c: F.length(F.trim(c["pattern"])) > 0)


def scored_graph(seeds: DataFrame, supposed: DataFrame, candidates: DataFrame) -> DataFrame:
    """(kind, instance, confidence, round) of identifiers that aren't seeds and get likely enough, with the first
    round in which they were. All three are (kind, value, before, after); equal values are one identifier.

    Seeds are certain. What is supposed to be an identifier counts for its patterns as a seed does, but
    is itself judged by its patterns, as candidates are. An identifier that isn't likely enough counts for nothing.
    A pattern's worth for an identifier comes from the others that it introduces.
    """
    edge = lambda df, sure, seed: df.select("kind", F.lower("value").alias("instance"), F.explode(_contexts(F.col("before"), F.col("after"))).alias("c"), F.lit(sure).alias("sure"), F.lit(seed).alias("seed"))
    edges = edge(seeds, True, 1.0).unionByName(edge(supposed, False, 1.0)).unionByName(edge(candidates, False, 0.0))
    edges = stored(edges.groupBy("kind", "c.sort", "c.pattern", "instance").agg(F.bool_or("sure").alias("sure"), F.max("seed").alias("seed")))
    # Patterns without seeds enough never count, so their edges go before the rounds.
    able = stored(edges.groupBy("kind", "sort", "pattern").agg(F.sum("seed").alias("seeds")).where(F.col("seeds") >= LEAST_SEEDS).drop("seeds"))
    edges = stored(edges.join(able, ["kind", "sort", "pattern"]))
    scored = edges.withColumns({"likely": F.lit(0.0), "round": F.lit(None).cast("int")})
    k, found_new = 0, True
    while found_new:  # a round finds an identifier for the first time, or is the last
        k += 1
        scored = scored.withColumn("counts", F.greatest("seed", F.when(F.col("likely") >= LEAST_CONFIDENCE, F.col("likely")).otherwise(F.lit(0.0))))
        patterns = stored(scored.groupBy("kind", "sort", "pattern").agg(F.sum("counts").alias("all"), F.count("*").alias("n")))
        score = (F.col("all") - F.col("counts")) / (F.col("n") - 1 + DOUBT)
        told = scored.join(patterns, ["kind", "sort", "pattern"]).withColumn("score", F.greatest(score, F.lit(0.0)))
        by_sort = told.groupBy("kind", "instance", "sort").agg(F.min("round").alias("round"), (1 - F.exp(F.sum(F.log1p(-F.col("score"))))).alias("likely"))
        likely = by_sort.groupBy("kind", "instance").agg(F.min("round").alias("round"), F.max("likely").alias("likely"))
        likely = likely.withColumn("round", F.coalesce("round", F.when(F.col("likely") >= LEAST_CONFIDENCE, F.lit(k))))
        scored = stored(edges.join(likely, ["kind", "instance"]))
        found_new = not scored.where(F.col("round") == k).isEmpty()
    new = scored.groupBy("kind", "instance").agg(F.bool_or("sure").alias("sure"), F.max("likely").alias("confidence"), F.min("round").alias("round"))
    return stored(new.where(~F.col("sure") & (F.col("confidence") >= LEAST_CONFIDENCE)).drop("sure"))


def _free(spans: DataFrame, taken: DataFrame) -> DataFrame:
    """``spans`` that overlap none of ``taken`` of the same row."""
    other = taken.select(F.col("row").alias("_row"), F.col("start").alias("_start"), F.col("end").alias("_end"))
    return spans.join(other, (F.col("row") == F.col("_row")) & (F.col("start") < F.col("_end")) & (F.col("_start") < F.col("end")), "left_anti")


def spans_of(found: DataFrame) -> DataFrame:
    """(row, kind, start, end, round) of all personal data; round is 0 for base matches, else the
    round of scoring that made the identifier likely enough."""
    per_kind = found.select("row", F.explode("kinds").alias("k")).select("row", "k.kind", "k.found")
    spans = stored(placed(per_kind, ["row", "kind"], "found"))
    base = stored(spans.where(F.col("kind").isin(*KINDS)).where(is_valid(F.col("kind"), F.col("value"))))
    may_be = spans.where(F.col("kind").isin(*CANDIDATES)).withColumn("value", F.regexp_replace("value", r"[^A-Za-z0-9=)]+$", ""))
    may_be = may_be.withColumn("end", F.col("start") + F.char_length("value")).drop("kind")
    may_be = stored(_free(may_be, base).select("*", F.explode(_kinds_of(F.col("value"))).alias("kind")))
    strong = (F.col("kind") == "secret") & (F.char_length("value") >= SECRET_CHARACTERS)
    accepted = scored_graph(base, may_be.where(strong), may_be.where(~strong))
    more = may_be.withColumn("instance", F.lower("value")).join(accepted, ["kind", "instance"])
    # Of the kinds that one place could be, and of candidates that overlap, the likeliest.
    best = more.groupBy("row", "start").agg(F.max(F.struct("confidence", "end", "kind", "round")).alias("b")).select("row", "start", "b.*")
    best = stored(best)
    clash = best.select(F.col("row").alias("_row"), F.col("start").alias("_start"), F.col("end").alias("_end"))
    earlier = (F.col("row") == F.col("_row")) & (F.col("_start") < F.col("start")) & (F.col("start") < F.col("_end"))
    best = best.join(clash, earlier, "left_anti")
    known = base.select("row", "kind", "start", "end", F.lit(0).alias("round"))
    return stored(known.unionByName(best.select("row", "kind", "start", "end", "round")))


def extracted(docs: DataFrame) -> DataFrame:
    """Counts and places of personal data in each document; has_personal_data tells whether there is any.

    A null text is empty and has none: its counts are 0, spans is an empty string and base_sha256 the
    hash of one. Repeated rows are searched each; an empty table gives an empty result; further
    columns are ignored. Texts and words may have any length.
    """
    found = _found(docs)
    order = F.array_position(F.array(*[F.lit(k) for k in ALL_KINDS]), F.col("kind")).cast("int")
    is_base = F.col("kind").isin(*KINDS) & (F.col("round") == 0)
    per_row = stored(spans_of(found).groupBy(F.col("row").alias("_row")).agg(
        *[F.count_if(is_base & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS], F.count_if(F.col("kind") == "secret").alias("n_secret"), F.count_if(F.col("round") > 0).alias("n_added"),
        F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col("start"), F.col("end"), F.col("kind"), is_base.alias("is_base")))).alias("all"),
    ))

    def printed(a: Column) -> Column:
        return F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    counts = [*[f"n_{k}" for k in KINDS], "n_secret", "n_added"]
    rows = found.select("doc_id", "row").join(small_or_shuffled(per_row, per_row.count()), F.col("row") == F.col("_row"), "left")
    every_span = F.coalesce("all", F.array().cast(per_row.schema["all"].dataType))
    return rows.select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.sha2(printed(F.filter(every_span, lambda x: x["is_base"])), 256).alias("base_sha256"), printed(every_span).alias("spans"),
        (F.size(every_span) > 0).alias("has_personal_data"),
    )


def op7_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(documents(spark, sf_dir))


QUERIES = {"op7_bootstrapped_pii": op7_bootstrapped_pii}
ORACLES: dict[str, str] = {}
