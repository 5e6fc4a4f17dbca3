"""Measures of answers and searches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def variant_summary(responses: DataFrame) -> DataFrame:
    """One row for each variant: cases, reviewed cases, groundedness, hallucination, mean accuracy and latency.

    A case is reviewed when a reviewer and all three claim counts, none negative, are given. Shares of claims are null
    without any claim; the mean source accuracy is null as soon as one case has none, so that no figure is made up.
    """
    claims = ["supported", "unsupported", "contradicted"]
    reviewed = F.trim(F.coalesce("reviewer", F.lit(""))) != ""
    for c in claims:
        reviewed = reviewed & F.coalesce(F.col(c) >= 0, F.lit(False))
    sums = {c: F.sum(F.when(reviewed, F.col(c))) for c in claims}
    total = F.coalesce(sums["supported"] + sums["unsupported"] + sums["contradicted"], F.lit(0))
    share = lambda n: F.when(total > 0, F.round(n / total, 6))
    return responses.groupBy("variant").agg(
        F.count("*").alias("cases"),
        F.count_if(reviewed).alias("reviewed_cases"),
        share(sums["supported"]).alias("groundedness"),
        share(sums["unsupported"] + sums["contradicted"]).alias("hallucination"),
        F.round(F.avg("location_accuracy"), 6).alias("location_accuracy"),
        F.round(F.avg("latency_seconds"), 6).alias("latency_seconds"),
        F.when(F.count_if(F.col("source_accuracy").isNull()) == 0, F.round(F.avg("source_accuracy"), 6)).alias("source_accuracy"),
    )


def split_ratios(rows: DataFrame, split: str, linked: str) -> DataFrame:
    """(split, total, linked, share) of linked rows; the share of an empty split would be null."""
    return rows.groupBy(split).agg(F.count("*").alias("total"), F.count_if(linked).alias("linked"), F.round(F.count_if(linked) / F.nullif(F.count("*"), F.lit(0)), 6).alias("share"))
