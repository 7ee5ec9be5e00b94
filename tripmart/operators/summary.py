"""Quality counts: by status, by rule, and the per-month validation summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.config import MONTH_COLUMNS
from tripmart.operators.classify import STATUSES


def status_counts(classified: DataFrame) -> DataFrame:
    """One row per status, zero when no trip has it."""
    counted = classified.agg(*[F.count_if(F.col("quality_status") == s).alias(s) for s in STATUSES])
    pairs = [F.struct(F.lit(s).alias("quality_status"), F.col(s).alias("row_count")) for s in STATUSES]
    return counted.select(F.inline(F.array(*pairs)))


def rule_counts(classified: DataFrame) -> DataFrame:
    """Rows per rule that fired at least once."""
    by_text = classified.groupBy("quality_reasons").agg(F.count("*").alias("n"))
    named = by_text.select(F.explode(F.split("quality_reasons", "[|]")).alias("rule"), "n")
    return named.where("rule <> ''").groupBy("rule").agg(F.sum("n").alias("row_count"))


def validation_summary(classified: DataFrame) -> DataFrame:
    """One row per month: total, count per status, map of rule to count.

    Trips are counted per (status, reason text) first, so only a few hundred rows per month
    leave the scan.
    """
    counted = classified.groupBy(*MONTH_COLUMNS, "quality_status", "quality_reasons").agg(
        F.count("*").alias("n"), F.max("ingested_at").alias("ingested_at")
    )
    rules = F.transform(
        F.filter(F.split("quality_reasons", "[|]"), lambda name: name != ""),
        lambda name: F.struct(F.lit("rule").alias("kind"), name.alias("name")),
    )
    status = F.array(F.struct(F.lit("status").alias("kind"), F.col("quality_status").alias("name")))
    named = (
        counted.select(*MONTH_COLUMNS, "ingested_at", "n", F.inline(F.concat(status, rules)))
        .groupBy(*MONTH_COLUMNS, "kind", "name")
        .agg(F.sum("n").alias("n"), F.max("ingested_at").alias("ingested_at"))
    )

    def of_status(name: str) -> Column:
        hit = (F.col("kind") == "status") & (F.col("name") == name)
        return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias(name)

    rule_pair = F.when(F.col("kind") == "rule", F.struct("name", "n"))
    return (
        named.groupBy(*MONTH_COLUMNS)
        .agg(
            F.max("ingested_at").alias("ingested_at"),
            *[of_status(name) for name in STATUSES],
            F.map_from_entries(F.sort_array(F.collect_list(rule_pair))).alias("rule_counts"),
        )
        .select(
            F.col("service"),
            F.col("source_year").alias("year"),
            F.col("source_month").alias("month"),
            F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("validated_at"),
            (F.col("valid") + F.col("warning") + F.col("rejected")).alias("total_rows"),
            F.struct(*STATUSES).alias("status_counts"),
            "rule_counts",
        )
    )
