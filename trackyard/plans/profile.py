"""Quality profiles the data catalogue reports (P1 null rates, P2 key match rates, P3 domains)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _rate(part, whole):
    return F.round(part.cast("double") / whole.cast("double"), 6)


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: total_rows, null_rows, null_rate — from a single aggregation pass."""
    cols = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("__total")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(cols)]
    row = df.agg(*aggs)
    per_col = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"__n{i}").alias("null_rows"))
        for i, c in enumerate(cols)]))
    return (row.select(F.col("__total").alias("total_rows"), per_col.alias("__c"))
               .select("__c.column_name", "total_rows", "__c.null_rows",
                       _rate(F.col("__c.null_rows"), F.col("total_rows")).alias("null_rate")))


def match_rates(facts: Mapping[str, DataFrame], key: str = "subscriber_key") -> DataFrame:
    """Share of fact rows whose dimension key resolved, per fact."""
    out = None
    for name, fact in facts.items():
        one = fact.agg(F.count(key).alias("matched_rows"), F.count(F.lit(1)).alias("total_rows")).select(
            F.lit(name).alias("fact_name"), "matched_rows", "total_rows",
            _rate(F.col("matched_rows"), F.col("total_rows")).alias("match_rate"))
        out = one if out is None else out.unionByName(one)
    return out


def domain_check(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Value histogram of an enumerated column with an in-domain flag."""
    return (df.groupBy(F.col(column).alias("value"))
              .agg(F.count(F.lit(1)).alias("row_count"))
              .withColumn("allowed", F.col("value").isin(list(allowed))))


# ---------------------------------------------------------------------------
# FIXED VALUES: enumerated domains the data catalogue documents.
# An empty export field loads as NULL, which the catalogue lists as "unknown".
# ---------------------------------------------------------------------------
DOMAINS = [
    ("fact_etcs_call", "root_failure", ["Success", "Dropped", "Rejected"]),
    ("fact_transaction", "direction", ["Mobile Originated", "Mobile Terminated"]),
    ("fact_transaction", "transaction_type", ["Call"]),
    ("fact_transaction", "application_type", ["ETCS", "LDA"]),
    ("fact_transaction", "root_failure", ["Success", "Dropped", "Rejected"]),
    ("fact_group_call", "transaction_type", ["Call"]),
    ("fact_handover", "handover_end_event", ["HO Complete", "HO Performed", "HO Failure", "RLC HO Failure"]),
    ("fact_frame_error", "direction", ["Uplink", "Downlink"]),
]
DIM_NULL_COLUMNS = ["msisdn", "imei", "nid_engine", "imsi_last_time", "msisdn_last_time"]
# ---------------------------------------------------------------------------


def gold_report(gold: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """P1-P3 over a published gold snapshot: dimension null rates, fact key match
    rates, and value histograms of the enumerated columns with an in-domain flag."""
    facts = {name: df for name, df in gold.items() if name.startswith("fact_")}
    domains = None
    for fact, column, allowed in DOMAINS:
        if fact not in gold:
            continue
        hist = domain_check(gold[fact], column, allowed).select(
            F.lit(fact).alias("fact_name"), F.lit(column).alias("column_name"), "value", "row_count",
            (F.col("allowed") | F.col("value").isNull()).alias("allowed"))
        domains = hist if domains is None else domains.unionByName(hist)
    return {"null_rates": null_rates(gold["dim_subscriber"], DIM_NULL_COLUMNS),
            "match_rates": match_rates(facts),
            "domains": domains}
