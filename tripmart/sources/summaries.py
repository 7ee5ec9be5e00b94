"""History of quality summaries: writing, newest entry, malformed entries."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tripmart.errors import SummaryError

SUMMARY_SCHEMA = (
    "service string, year bigint, month bigint, validated_at string, total_rows bigint, "
    "status_counts struct<valid: bigint, warning: bigint, rejected: bigint>, "
    "rule_counts map<string, bigint>, source_path string, outputs struct<validated: string, rejected: string>"
)
# Fixed value: artifact names start with year and month. A document is named by the last folder that carries its
# name as partition value, or else by its file; folders further up play no part.
ARTIFACT_PATTERN = r"(?:/artifact_name=(validation_\d{4}_\d{2}[A-Za-z_]*)/[^/]*|/(validation_\d{4}_\d{2}[A-Za-z_]*)(?:\.[^/]*)?)$"


def write_summaries(summaries: DataFrame, root: str) -> None:
    """One JSON document per month; a rerun replaces the documents of its own months only."""
    named = summaries.withColumn(
        "artifact_name", F.format_string("validation_%04d_%02d_%s", "year", "month", "service")
    )
    (
        named.repartition("artifact_name")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("artifact_name")
        .json(root)
    )


def read_summaries(spark: SparkSession, root: str) -> DataFrame:
    """All stored summaries with their artifact name; paths are not carried over."""
    stored = (
        spark.read.schema(SUMMARY_SCHEMA)
        .option("multiLine", "true")
        .option("recursiveFileLookup", "true")
        .json(root)
    )
    location = F.col("_metadata.file_path")
    return stored.select(
        *stored.columns,
        F.concat(F.regexp_extract(location, ARTIFACT_PATTERN, 1), F.regexp_extract(location, ARTIFACT_PATTERN, 2)).alias("artifact_name"),
    ).where("artifact_name <> ''")


def well_formed() -> Column:
    """Fields present, counts not negative, month in the calendar, statuses adding up."""
    counts = [F.col("status_counts.valid"), F.col("status_counts.warning"), F.col("status_counts.rejected")]
    whole = [F.col("year"), F.col("total_rows"), *counts]
    test = F.col("service").rlike("\\S") & F.col("validated_at").rlike("\\S") & F.col("month").between(1, 12)
    for value in whole:
        test = test & (value >= 0)
    test = test & (counts[0] + counts[1] + counts[2] == F.col("total_rows"))
    rules_fine = F.forall(F.map_values("rule_counts"), lambda n: n >= 0)
    return F.coalesce(test & rules_fine, F.lit(False))


def malformed_summaries(summaries: DataFrame) -> DataFrame:
    return summaries.where(~well_formed())


def newest_summary(summaries: DataFrame) -> DataFrame:
    """The summary with the last artifact name, with a column telling whether it is sound."""
    named_rules = F.map_filter("rule_counts", lambda name, _: F.trim(name) != "")
    tidy = summaries.select(
        "service",
        "year",
        "month",
        "validated_at",
        "total_rows",
        "status_counts",
        named_rules.alias("rule_counts"),
        "artifact_name",
        well_formed().alias("well_formed"),
    )
    newest = tidy.agg(F.max_by(F.struct(*tidy.columns), "artifact_name").alias("newest"))
    return newest.where("newest IS NOT NULL").select("newest.*")


def latest_summary(spark: SparkSession, root: str) -> dict[str, Any]:
    """The newest summary as a document; an error when there is none or it is not sound."""
    try:
        row = newest_summary(read_summaries(spark, root)).first()
    except AnalysisException as error:
        raise SummaryError(f"no quality summary under {root}") from error
    if row is None:
        raise SummaryError(f"no quality summary under {root}")
    document = row.asDict(recursive=True)
    if not document.pop("well_formed"):
        raise SummaryError(f"summary {document['artifact_name']} has missing or inconsistent counts")
    document["rule_counts"] = dict(sorted(document["rule_counts"].items()))
    return document
