"""The whole run: discover, clean, check against the frozen schema, quarantine, enrich, validate, export."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tamiz.operators import cleaning, quality, rules, semantic
from tamiz.operators.stage import staged
from tamiz.sources import files, sinks
from tamiz.sources.schemas import DriftError, Evaluation, Registry


@dataclass
class Run:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    violations: dict[str, DataFrame] = field(default_factory=dict)
    #: Lines of delimited tables with another number of fields than the header's.
    rejected: dict[str, DataFrame] = field(default_factory=dict)
    #: What the registry told of each table.
    schemas: dict[str, Evaluation] = field(default_factory=dict)
    totals: DataFrame | None = None
    passed: bool = True


def process(df: DataFrame, hint: str, ruleset: rules.RuleSet | None = None, frozen: DataFrame | None = None, enrich: bool = True, check: Callable[[DataFrame], object] | None = None, anchors: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(valid, quarantined, violations) of one table. ``check`` sees the cleaned table and may stop it. The statistics that
    enrichment rests on are saved under ``anchors``, for streams of the same table."""
    cleaner = cleaning.choose(df.columns, hint=hint)
    cleaned = staged(cleaner.clean(df)) if cleaner else df  # kept, rejected and enriched rows all come from one parse
    if frozen is not None and (bad := quality.drift(frozen, cleaned).where("severity = 'fatal'").collect()):
        raise DriftError(", ".join(f"{r['column_name']} {r['change']}" for r in bad))
    if check is not None:
        check(cleaned)
    kept, rejected = rules.split_by_score(cleaned)
    if enrich and cleaner and cleaner.name == "transactional":
        learned = semantic.learn(kept) if anchors else None
        if learned is not None:
            learned.save(df.sparkSession, f"{anchors}/{hint}")
        kept = semantic.enrich(kept, learned)
    if ruleset is None:
        return kept, rejected, None
    outcome = rules.validate(kept, ruleset)
    if outcome.fatal:
        raise ValueError("; ".join(outcome.fatal))
    return outcome.valid, rejected.unionByName(outcome.quarantined, allowMissingColumns=True), outcome.violations


def run(spark: SparkSession, source: str, out: str, run_id: str, rulesets: dict[str, rules.RuleSet] | None = None, threshold: float = 0.05, schemas: str | None = None, anchors: str | None = None) -> Run:
    """Every table of a folder; one that fails is noted and the others go on. With ``schemas``, a registry's folder, the first
    run freezes each table's cleaned schema and later ones are held against it; under ``anchors`` each run adds a version of a table's statistics."""
    found = files.discover_tables(spark, source)
    registry = Registry(spark, schemas) if schemas else None
    done, frames = Run(errors=dict(found.errors)), {}
    for name, table in found.tables.items():
        try:
            check = (lambda df, name=name: done.schemas.setdefault(name, registry.check(name, df, run_id))) if registry else None
            valid, rejected, violations = process(table.df, name, (rulesets or {}).get(name), check=check, anchors=anchors)
            path = sinks.run_path(out, run_id, name)
            sinks.write_parquet(valid, f"{path}/clean")
            sinks.quarantine(rejected, f"{path}/quarantine", "score-or-rule")
            if table.rejected is not None:
                table.rejected.write.mode("overwrite").parquet(f"{path}/rejected-lines")
                done.rejected[name] = spark.read.parquet(f"{path}/rejected-lines")
            done.tables[name] = spark.read.parquet(f"{path}/clean")
            frames[name] = (table.df, done.tables[name], spark.read.parquet(f"{path}/quarantine"))
            if violations is not None:
                done.violations[name] = violations
        except Exception as error:  # noqa: BLE001  one bad table must not stop the others
            done.errors[name] = str(error)[:300]
    if frames:
        done.totals = quality.totals(frames)
        done.passed = rules.gate(*[_union([f[i] for f in frames.values()]) for i in range(3)], threshold).first()["passed"]
    clean = {name: f"{sinks.run_path(out, run_id, name)}/clean" for name in frames}
    inputs = {name: table.origin for name, table in found.tables.items()}
    sinks.manifest(spark, clean, {"threshold": str(threshold), "passed": str(done.passed)}, inputs, done.errors).coalesce(1).write.mode("overwrite").text(f"{out}/{run_id}/manifest")
    sinks.mark_latest(spark, out, run_id)
    return done


def _union(frames: list[DataFrame]) -> DataFrame:
    """Rows of all tables, for counting."""
    out = frames[0].selectExpr("1 AS one")
    for f in frames[1:]:
        out = out.unionByName(f.selectExpr("1 AS one"))
    return out
