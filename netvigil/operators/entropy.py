"""Shannon entropy of packet lengths per time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netvigil.functions.verdicts import entropy_flag, entropy_z
from netvigil.operators.ordering import moving


def symbol_counts(flows: DataFrame, width: str = "1 hour") -> DataFrame:
    """Flows per window and packet length; flows without a timestamp belong to no window."""
    return flows.groupBy(F.window("timestamp", width).alias("w"), "packet_length").agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.col("w.start").alias("window_start"), "packet_length", "n")


def entropy_of(counts: DataFrame) -> DataFrame:
    """Entropy in bits per window, unrounded, from symbol counts.

    H = log2(N) - sum(n * log2 n) / N needs only two sums, so a window that
    holds most of the data is still merged from per-task partial sums.
    """
    n = F.col("n")
    sums = counts.groupBy("window_start").agg(
        F.sum("n").alias("flows"),
        F.count(F.lit(1)).alias("distinct_lengths"),
        F.sum(n * F.log2(n)).alias("weighted_logs"),
    )
    return sums.select(
        "window_start", "flows", "distinct_lengths",
        (F.log2("flows") - F.col("weighted_logs") / F.col("flows")).alias("h"),
    )


def rounded(value, digits: int = 4):
    # Adding zero turns a rounded -0.0 into 0.0.
    return F.round(value, digits) + F.lit(0.0)


def packet_entropy(flows: DataFrame, width: str = "1 hour") -> DataFrame:
    return entropy_of(symbol_counts(flows, width)).select(
        "window_start", "flows", "distinct_lengths", rounded(F.col("h")).alias("entropy")
    )


def entropy_flags(entropy: DataFrame) -> DataFrame:
    """Distance from the baseline and anomaly flag of every window."""
    h = F.col("entropy")
    return entropy.select(
        "window_start", "entropy", entropy_z(h).alias("z_score"), entropy_flag(h).alias("anomaly_flag")
    )


def entropy_drift(flows: DataFrame, width: str = "1 hour", windows: int = 20) -> DataFrame:
    """Moving average of the entropy over the last ``windows`` windows.

    The windows are numbered and averaged in blocks, each with the windows before
    it that it needs, so that windows of a second over years do not meet in one task.
    """
    per_window = entropy_of(symbol_counts(flows, width)).select("window_start", "h")
    return moving(per_window, "window_start", windows, average=F.avg("h")).select(
        "window_start", rounded(F.col("h")).alias("entropy"), rounded(F.col("average")).alias("moving_avg"),
    )
