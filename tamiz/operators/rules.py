"""Declarative rules, quarantine and the gate of a run."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTIONS = ("warn", "quarantine", "fail")


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    kind: str
    on_violation: str = "warn"
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    pattern: str = ""
    dtype: str = ""


@dataclass(frozen=True)
class RuleSet:
    dataset: str
    required: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = field(default=())

    @staticmethod
    def from_file(path: str) -> RuleSet:
        """From a rule file, JSON or YAML by its ending. It is a file of the driver, as all settings."""
        with open(path, encoding="utf-8") as f:
            if path.endswith(".json"):
                return RuleSet.from_dict(json.load(f))
            import yaml  # only needed for YAML files

            return RuleSet.from_dict(yaml.safe_load(f) or {})

    @staticmethod
    def for_dataset(dataset: str, folder: str) -> RuleSet | None:
        """The rules of ``dataset`` in a folder of rule files named like data sets; None if it has none."""
        found = [p for end in (".yaml", ".yml", ".json") if os.path.exists(p := os.path.join(folder, dataset + end))]
        return RuleSet.from_file(found[0]) if found else None

    @staticmethod
    def from_dict(spec: dict) -> RuleSet:
        """From the mapping of a rule file."""
        made = [
            Rule(r["name"], r["column"], r["type"], r.get("on_violation", "warn"), r.get("min"), r.get("max"), tuple(r.get("values", ())), r.get("pattern", ""), r.get("dtype", ""))
            for r in spec.get("rules", [])
        ]
        return RuleSet(spec.get("dataset", "unknown"), tuple(spec.get("required_columns", ())), tuple(made))


def violation(rule: Rule) -> Column | None:
    """Where a row breaks the rule; None for kinds that aren't known. ``unique`` counts over the whole table."""
    x = F.col(rule.column)
    if rule.kind == "range":
        v = x.cast("string").try_cast("double")
        ok = v.isNotNull()
        ok = ok & (v >= rule.low) if rule.low is not None else ok
        ok = ok & (v <= rule.high) if rule.high is not None else ok
        return x.isNotNull() & ~F.coalesce(ok, F.lit(False))
    if rule.kind == "allowed_values":
        return x.isNotNull() & ~x.isin(*rule.values)
    if rule.kind == "regex":
        return x.isNotNull() & ~x.cast("string").rlike(f"^(?:{rule.pattern})")
    if rule.kind == "not_null":
        return x.isNull()
    if rule.kind == "unique":
        return x.isNotNull() & (F.col(f"_count_{rule.column}") > 1)
    if rule.kind == "dtype":
        text = x.cast("string")
        if rule.dtype == "date":
            bad = F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).isNull() & F.try_to_timestamp(text, F.lit("yyyy/MM/dd")).isNull()
        else:
            v = text.try_cast("double")
            bad = v.isNull() if rule.dtype == "float" else v.isNull() | (v % 1 != 0)
        return x.isNotNull() & bad
    return None


def with_key_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds _count_<c>. Counts come from a group-by and a join, which Spark combines before the shuffle
    and splits where one value is very common; a window would gather that value in one task."""
    for c in columns:
        # Only repeated values need to meet their rows.
        again = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("_v")).agg(F.count("*").alias(f"_count_{c}")).where(F.col(f"_count_{c}") > 1)
        df = df.join(again, df[c] == F.col("_v"), "left").drop("_v").na.fill(1, [f"_count_{c}"])
    return df


@dataclass
class Outcome:
    valid: DataFrame
    quarantined: DataFrame
    violations: DataFrame
    fatal: list[str]


def _marked(df: DataFrame, rules: RuleSet) -> tuple[DataFrame, dict[str, Column]]:
    usable = [r for r in rules.rules if r.column in df.columns]
    df = with_key_counts(df, sorted({r.column for r in usable if r.kind == "unique"}))
    marks = {r.name: F.coalesce(m, F.lit(False)) for r in usable if (m := violation(r)) is not None}
    return df.withColumn("_marks", F.struct(*[m.alias(n) for n, m in marks.items()])) if marks else df, marks


def violation_counts(df: DataFrame, rules: RuleSet) -> DataFrame:
    """(rule, action, n) of the rules that are broken, all counted in one aggregate."""
    marked, marks = _marked(df, rules)
    action = {r.name: r.on_violation for r in rules.rules}
    counts = marked.agg(*[F.count_if(F.col(f"_marks.{n}")).alias(n) for n in marks])
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(action[n]).alias("action"), F.col(n).alias("n")) for n in marks])
    return counts.select(F.explode(rows).alias("r")).select("r.*").where("n > 0")


def validate(df: DataFrame, rules: RuleSet) -> Outcome:
    """Valid and quarantined rows, counts by rule, and what is fatal. A missing required column is fatal at
    once; a rule over an absent column, or of an unknown kind, is left out."""
    missing = [c for c in rules.required if c not in df.columns]
    if missing:
        return Outcome(df.limit(0), df.limit(0), None, [f"missing column {c}" for c in missing])
    marked, marks = _marked(df, rules)
    out = F.lit(False)
    for r in rules.rules:
        if r.on_violation == "quarantine" and r.name in marks:
            out = out | F.col(f"_marks.{r.name}")
    counts = violation_counts(df, rules)
    failed = [r.name for r in rules.rules if r.on_violation == "fail" and r.name in marks]
    fatal = [f"{r['rule']}: {r['n']} rows" for r in counts.where(F.col("rule").isin(failed)).collect()] if failed else []  # one row a rule at most
    return Outcome(marked.where(~out).select(df.columns), marked.where(out).select(df.columns), counts, fatal)


def rejected_by_score(columns: list[str], least: int = 50) -> Column:
    """Whether a row's score or flags send it to quarantine; without these columns none does."""
    out = F.lit(False)
    if "quality_score" in columns:
        out = out | F.coalesce(F.col("quality_score") < least, F.lit(False))
    if "data_quality_flags" in columns:
        out = out | F.coalesce(F.exists("data_quality_flags", lambda t: t.contains("missing_id") | t.contains("invalid_id")), F.lit(False))
    return out


def split_by_score(df: DataFrame, least: int = 50) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined) by score and flags."""
    out = rejected_by_score(df.columns, least)
    return df.where(~out), df.where(out)


def gate(extracted: DataFrame, cleaned: DataFrame, quarantined: DataFrame, threshold: float = 0.05) -> DataFrame:
    """One row: counts, dropped rows, the rejected share (dropped rows count) and whether the run passes."""
    n = lambda df, name: df.agg(F.count("*").alias(name))
    row = n(extracted, "extracted").crossJoin(n(cleaned, "cleaned")).crossJoin(n(quarantined, "quarantined"))  # one row each
    rejected = F.col("extracted") - F.col("cleaned")
    share = F.when(F.col("extracted") > 0, F.round(rejected / F.col("extracted"), 6)).otherwise(0.0)
    return row.select("*", (rejected - F.col("quarantined")).alias("dropped"), share.alias("ratio"), (share <= threshold).alias("passed"))


def members_of_duplicates(df: DataFrame, columns: list[str]) -> DataFrame:
    """All rows whose key occurs more than once; nulls are equal. Keys are counted before the shuffle, and
    only the repeated ones meet their rows."""
    again = df.groupBy(*[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)]).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    same = F.lit(True)
    for i, c in enumerate(columns):
        same = same & df[c].eqNullSafe(F.col(f"_{i}"))
    return df.join(again, same, "left_semi")
