"""Host-level quality rules: failures of each rule by host, shrunk by an empirical beta prior, joined back.

A rule measures a document against a limit; above it the document fails. The hosts' own shares of failures fit a beta
prior of each rule: its mean, and the variance between hosts that is left when the variance of sampling is
taken off. A host's posterior rate then moves the limit for its documents: it is divided by the odds ratio of the posterior
against the prior. So a document of a host that fails often is turned down sooner, one of a host that hardly
ever fails later, and the host enters every verdict, by as much as its documents tell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.common import documents, let, small_or_shuffled, stored, words

WINDOW = 8
MIN_WORDS = 20
MOST_REPEATED_PERCENT = 30
#: A prior never counts for more documents than this. Where hosts differ no more than by sampling, the variance between
#: them can't be told from none, and the hosts' own documents still count.
MOST_STRENGTH = 100.0
#: A limit moves by this factor at most.
LARGEST_SHIFT = 4.0
#: A document's figure as a share of the rule's limit; null where there is nothing to measure.
RULES = {
    "repeats": "100 * n_repeat_words / nullif(30 * n_words, 0)",
    "symbols": "10 * n_symbols / nullif(n_words, 0)",
    "lines": "100 * n_dup_lines / nullif(30 * n_lines, 0)",
    "word_length": "greatest(2 * n_words / nullif(word_chars, 0), word_chars / nullif(20 * n_words, 0))",
}
SYMBOLS = "#*$%&|<>"


def _repeated_words(w: Column) -> Column:
    """Words covered by windows of WINDOW words that stand twice or more in the text."""

    def covered(keys: Column) -> Column:
        # Equal windows are neighbours after the sort; their places, sorted again, are covered from left to right.
        at = F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i")))
        twice = let(F.array_sort(at), lambda s: F.filter(s, lambda x, j: (
            ((j > 0) & (F.get(s, j - 1)["k"] == x["k"])) | F.coalesce(F.get(s, j + 1)["k"] == x["k"], F.lit(False)))))
        places = F.array_sort(F.transform(twice, lambda x: x["i"]))
        return let(places, lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x))

    keys = F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
    count = let(keys, lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), F.lit(0)).otherwise(covered(k)))
    return F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(count).cast("long")


def text_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the base figures of each whole text, in one pass over the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    figures = let(words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeated_words(w).alias("n_repeat_words"),
    ))
    return docs.select(
        "doc_id",
        F.col(host).alias("host"),
        figures.alias("f"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
    ).select("doc_id", "host", "f.*", "n_symbols", "l.*")


def host_verdicts(rows: DataFrame) -> DataFrame:
    """(host, <rule>_rate, <rule>_shift): posterior rates (failures + m s) / (documents + s), and their odds ratio against the prior.

    The prior of a rule has the mean m of the hosts' rates and the strength s = m (1 - m) / v - 1 for
    the variance v between hosts: that of the rates less what m (1 - m) / documents explains; at least 1, at most MOST_STRENGTH. A rule that
    no document fails, or every one, moves no limit; nor does the only host.
    """
    hosts = rows.groupBy("host").agg(F.count("*").alias("n"), *[F.count_if(F.col(r) > 1).alias(r) for r in RULES])
    prior = hosts.agg(F.avg(1 / F.col("n")).alias("inverse"), *[x for r in RULES for x in (F.avg(F.col(r) / F.col("n")).alias(f"{r}_m"), F.var_samp(F.col(r) / F.col("n")).alias(f"{r}_v"))])
    fitted = []
    for r in RULES:
        m = F.col(f"{r}_m")
        between = F.coalesce(F.col(f"{r}_v"), F.lit(0.0)) - m * (1 - m) * F.col("inverse")
        strength = F.when(between > 0, F.greatest(F.least(m * (1 - m) / between - 1, F.lit(MOST_STRENGTH)), F.lit(1.0))).otherwise(F.lit(MOST_STRENGTH))
        fitted += [m, strength.alias(f"{r}_s")]
    told = hosts.crossJoin(F.broadcast(prior.select(*fitted)))  # the prior is one row
    out = [F.col("host")]
    for r in RULES:
        m, s = F.col(f"{r}_m"), F.col(f"{r}_s")
        rate = F.round((F.col(r) + m * s) / (F.col("n") + s), 9)
        ratio = F.when((m > 0) & (m < 1), (rate / (1 - rate)) / (m / (1 - m))).otherwise(F.lit(1.0))
        out += [rate.alias(f"{r}_rate"), F.round(F.least(F.greatest(ratio, F.lit(1 / LARGEST_SHIFT)), F.lit(LARGEST_SHIFT)), 6).alias(f"{r}_shift")]
    return told.select(*out)


def judged(docs: DataFrame, host: str = "source") -> DataFrame:
    """Figures, base rule and verdict of each document.

    A null text has no words and fails the base rule; a null host is a host of its own; repeated
    rows count as often as they stand; an empty table gives an empty result; further columns are ignored.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    marks = [F.coalesce(F.expr(share), F.lit(0.0)).alias(r) for r, share in RULES.items()]
    rows = stored(text_rules(docs, host).select("*", failed.alias("base_failed"), *marks))
    verdicts = stored(host_verdicts(rows)).withColumnRenamed("host", "_host")
    joined = rows.join(small_or_shuffled(verdicts, verdicts.count()), rows.host.eqNullSafe(F.col("_host")), "left")
    turned_down = F.lit(False)
    for r in RULES:
        turned_down = turned_down | (F.col(r) * F.col(f"{r}_shift") > 1)
    return joined.withColumn("kept", ~F.col("base_failed") & ~turned_down).drop("_host")


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *[f"{r}_rate" for r in RULES]
    )


QUERIES = {"op2_host_rules": op2_host_rules}

ORACLES = {
    "op2_host_rules": r"""
WITH base AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
places AS (
  SELECT doc_id, i, hash(list_slice(w, i, i + 7)) AS k FROM base, unnest(generate_series(1, len(w) - 7)) AS t(i) WHERE len(w) >= 8),
twice AS (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM places) WHERE n > 1),
repeats AS (SELECT doc_id, sum(least(8, coalesce(j - i, 8)))::BIGINT AS n FROM twice GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS x FROM base),
figures AS (
  SELECT b.doc_id, b.source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(x)::BIGINT AS n_lines,
         (len(x) - len(list_distinct(x)))::BIGINT AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM base b JOIN lines USING (doc_id) LEFT JOIN repeats r USING (doc_id)),
marked AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, coalesce(100 * n_repeat_words / nullif(30 * n_words, 0), 0) AS x1,
         coalesce(10 * n_symbols / nullif(n_words, 0), 0) AS x2, coalesce(100 * n_dup_lines / nullif(30 * n_lines, 0), 0) AS x3,
         coalesce(greatest(2 * n_words / nullif(word_chars, 0), word_chars / nullif(20 * n_words, 0)), 0) AS x4
  FROM figures),
rules AS (
  SELECT source, rule, count(*) AS n, sum((x > 1)::INT)::DOUBLE AS failed
  FROM (SELECT source, unnest([1, 2, 3, 4]) AS rule, unnest([x1, x2, x3, x4]) AS x FROM marked) GROUP BY ALL),
moments AS (
  SELECT rule, avg(failed / n) AS m, coalesce(var_samp(failed / n), 0) - avg(failed / n) * (1 - avg(failed / n)) * avg(1 / n) AS v FROM rules GROUP BY rule),
prior AS (SELECT rule, m, CASE WHEN v > 0 THEN greatest(least(m * (1 - m) / v - 1, 100.0::DOUBLE), 1.0::DOUBLE) ELSE 100.0::DOUBLE END AS s FROM moments),
posterior AS (SELECT source, rule, m, round((failed + m * s) / (n + s), 9) AS rate FROM rules JOIN prior USING (rule)),
verdicts AS (
  SELECT source, map_from_entries(list((rule, rate))) AS rate,
         map_from_entries(list((rule, round(least(greatest(CASE WHEN m > 0 AND m < 1 THEN (rate / (1 - rate)) / (m / (1 - m)) ELSE 1 END, 0.25::DOUBLE), 4.0::DOUBLE), 6)))) AS shift
  FROM posterior GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR x1 * shift[1] > 1 OR x2 * shift[2] > 1 OR x3 * shift[3] > 1 OR x4 * shift[4] > 1) AS kept,
       rate[1] AS repeats_rate, rate[2] AS symbols_rate, rate[3] AS lines_rate, rate[4] AS word_length_rate
FROM marked m JOIN verdicts v ON m.source IS NOT DISTINCT FROM v.source
""",
}
