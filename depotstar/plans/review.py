"""Validation and first analysis of the newest cleaned file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotstar.functions import parse_timestamp, to_number
from depotstar.operators import checks, cleanse, profile, summary
from depotstar.plans.ingest import write_services
from depotstar.schemas import DATE_COLUMNS
from depotstar.session import stage
from depotstar.sources.csv import WRITTEN_TIME_FORMAT, newest_file, read_flat


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """A cleaned file with its numbers and dates typed; parsed once into a staged copy."""
    df = read_flat(spark, path)
    numbers = [*cleanse.NUMERIC_COLUMNS, "Late_delivery_risk", "data_quality_score"]
    typed = {c: to_number(F.col(f"`{c}`")) for c in numbers if c in df.columns}
    typed |= {
        c: parse_timestamp(F.col(f"`{c}`"), WRITTEN_TIME_FORMAT)
        for c in DATE_COLUMNS
        if c in df.columns
    }
    return stage(df.withColumns(typed), "cleaned")


def validate_newest(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Check results and verdict for the newest cleaned file of a folder."""
    df = read_cleaned(spark, newest_file(spark, folder))
    results = checks.run_checks(df, checks.standard_checks(df))
    return results, checks.verdict(results)


def analyse_newest(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Split the newest cleaned file into its services, and summarise it.

    Returns the summaries by name; those whose columns the file lacks are left out.
    """
    path = newest_file(spark, folder)
    df = read_cleaned(spark, path)
    write_services(df, path)
    found = {}
    if profile.numeric_columns(df):
        found["numbers"] = profile.describe_numeric(df)
    if profile.text_columns(df):
        found["texts"] = profile.describe_categorical(df)
    wanted = {
        "totals": (["Sales", "Benefit per order"], summary.totals),
        "top_products": (["Product Name", "Sales"], summary.top_groups),
        "delivery_status": (["Delivery Status"], summary.status_share),
        "late_rate": (["Late_delivery_risk"], summary.late_rate),
        "markets": (["Market", "Sales"], lambda d: summary.ranked_sums(d, "Market")),
    }
    for name, (columns, query) in wanted.items():
        if set(columns) <= set(df.columns):
            found[name] = query(df)
    return found
