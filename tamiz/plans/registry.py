"""Every query of the library, with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.operators import cleaning, rules
from tamiz.plans import q_bi, q_clean, q_files, q_lake, q_olap, q_rules, q_semantic  # noqa: F401  they register their queries
from tamiz.plans.catalog import ORACLES, QUERIES, query, table


def monthly_sales(d: DataFrame) -> DataFrame:
    """Dirty sales cleaned in one projection, split from quarantine and rolled up by month and movement."""
    # The score bounds the sums; a filter would be pushed below the projection and have every text parsed again.
    cleaned = cleaning.clean_transactional(d)
    kept = ~rules.rejected_by_score(cleaned.columns)
    month = F.date_format("fecha_venta", "yyyy-MM")
    sums = cleaned.groupBy(month.alias("month"), "tipo_movimiento").agg(
        F.count_if(kept).alias("n"), F.round(F.sum(F.when(kept, F.col("monto"))), 2).alias("total"), F.round(F.avg(F.when(kept, F.col("quality_score"))), 4).alias("score"))
    return sums.where("n > 0")


@query("flagship_monthly_sales", "dirty_sales", f"""SELECT strftime({q_clean.DATE}, '%Y-%m') AS month, {q_clean.MOVEMENT} AS tipo_movimiento, count(*) AS n, round(sum(coalesce({q_clean.PRICE}, 0)), 2) AS total, round(avg({q_clean.SCORE}), 4) AS score
 FROM dirty_sales WHERE {q_clean.SCORE} >= 50 GROUP BY 1, 2""")
def _(d):
    return monthly_sales(d)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_sales(table(spark, sf_dir, "dirty_sales"))


__all__ = ["ORACLES", "QUERIES", "flagship"]
