"""Gold star schema: dim_subscriber (G1-G6) and six facts.

The dimension is built once per silver snapshot and materialised (its dense
key needs a frozen order anyway); every fact is a left join against it. Spark
decides by the materialised size whether a fact join broadcasts it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackyard.functions.parse import seconds_to_ms
from trackyard.operators.joins import left_join_dim
from trackyard.operators.ordinal import global_ordinal_counted

DIM_COLUMNS = ["subscriber_key", "imsi", "msisdn", "imei", "nid_engine", "imsi_last_time", "msisdn_last_time"]

# ---------------------------------------------------------------------------
# FIXED VALUES: the identity branches and the fact projections.
# Identity branch: silver table -> (msisdn, imei, nid_engine) present or not.
# ---------------------------------------------------------------------------
IDENTITY_BRANCHES = [
    ("exp_etcs_call", ("msisdn", "imei", "nid_engine")),
    ("exp_transaction_tracing", ("msisdn", "imei", "nid_engine")),
    ("exp_ho_tracing", ("msisdn", "imei")),
    ("exp_vgcs_vbs_rec_tracing", ("msisdn",)),
    ("exp_subscriber_matrix", ("msisdn", "nid_engine")),
]

# fact -> (silver table, fact join column, dimension join column, [(output, silver column)])
FACTS = {
    "fact_etcs_call": ("exp_etcs_call", "imsi", "imsi", [
        ("imsi", "imsi"), ("start_time", "start_time"), ("stop_time", "stop_time"),
        ("nid_engine", "nid_engine"), ("nid_operational", "nid_operational"),
        ("etcs_baseline", "etcs_baseline"), ("system_version", "system_version"),
        ("start_nid_c", "start_nid_c"), ("start_nid_bg", "start_nid_bg"), ("stop_nid_c", "stop_nid_c"),
        ("stop_nid_bg", "stop_nid_bg"), ("stop_d_lrbg", "stop_d_lrbg"), ("gsmr_connected", "gsmr_connected"),
        ("etcs_connected", "etcs_connected"), ("root_failure", "root_failure"), ("end_domain", "end_domain"),
        ("protocol_layer", "protocol_layer"), ("end_event", "end_event"), ("end_cause", "end_cause"),
        ("isdn_port_probe", "isdn_port_probe"), ("call_setup_duration_ms", "call_setup_duration"),
        ("transaction_duration_ms", "transaction_duration")]),
    "fact_transaction": ("exp_transaction_tracing", "imsi", "imsi", [
        ("imsi", "imsi"), ("start_time", "start_time"), ("stop_time", "stop_time"), ("nid_engine", "nid_engine"),
        ("start_lac", "start_lac"), ("start_ci", "start_ci"), ("stop_lac", "stop_lac"), ("stop_ci", "stop_ci"),
        ("tmsi", "tmsi"), ("reallocated_tmsi", "reallocated_tmsi"), ("direction", "direction"),
        ("transaction_type", "transaction_type"), ("transaction_subtype", "transaction_subtype"),
        ("application_type", "application_type"), ("functional_number", "functional_number"),
        ("dest_route_address", "dest_route_address"), ("gsmr_connected", "gsmr_connected"),
        ("priority", "priority"), ("gb_ciphering_algo", "gb_ciphering_algo"), ("root_failure", "root_failure"),
        ("protocol_layer", "protocol_layer"), ("end_event", "end_event"), ("end_cause", "end_cause"),
        ("call_setup_duration_ms", "call_setup_duration"), ("establishment_delay_ms", "establishment_delay"),
        ("transaction_duration_ms", "transaction_duration")]),
    "fact_group_call": ("exp_vgcs_vbs_rec_tracing", "imsi", "imsi", [
        ("imsi", "imsi"), ("start_time", "start_time"), ("stop_time", "stop_time"),
        ("functional_number", "functional_number"), ("gid", "gid"), ("area", "area"), ("gcr", "gcr"),
        ("application_type", "application_type"), ("transaction_type", "transaction_type"),
        ("transaction_subtype", "transaction_subtype"), ("priority", "priority"), ("start_lac", "start_lac"),
        ("start_ci", "start_ci"), ("end_user", "end_user"),
        ("sccp_success_numerator", "sccp_success_numerator"),
        ("sccp_success_denominator", "sccp_success_denominator"), ("sccp_success_rate", "sccp_success_rate"),
        ("cell_success_numerator", "cell_success_numerator"),
        ("cell_success_denominator", "cell_success_denominator"), ("cell_success_rate", "cell_success_rate"),
        ("dispatcher_success_numerator", "dispatcher_success_numerator"),
        ("dispatcher_success_denominator", "dispatcher_success_denominator"),
        ("dispatcher_success_rate", "dispatcher_success_rate"),
        ("establishment_delay_ms", "establishment_delay"), ("vgcs_duration_ms", "vgcs_duration")]),
    "fact_handover": ("exp_ho_tracing", "imsi", "imsi", [
        ("imsi", "imsi"), ("start_time", "start_time"), ("stop_time", "stop_time"),
        ("handover_start_time", "ho_start_time"), ("source_lac", "src_lac"), ("source_ci", "src_ci"),
        ("target_lac", "trg_lac"), ("target_ci", "trg_ci"), ("ms_power", "ms_power"), ("call_type", "call_type"),
        ("handover_type", "ho_type"), ("handover_end_event", "ho_end_event"),
        ("handover_end_cause", "ho_end_cause"), ("handover_cause", "ho_cause"),
        ("handover_duration_ms", "ho_duration")]),
    "fact_frame_error": ("exp_hdlc_frame_errors", "calling_number", "msisdn", [
        ("start_time", "start_time"), ("stop_time", "stop_time"), ("frame_error_time", "frame_error_time"),
        ("nid_engine", "nid_engine"), ("nid_operational", "nid_operational"),
        ("isdn_port_probe", "isdn_port_probe"), ("last_nid_c", "last_nid_c"), ("last_nid_bg", "last_nid_bg"),
        ("multiplexing_level", "m_level"), ("multiplexing_mode", "m_mode"), ("direction", "direction"),
        ("frame_error", "frame_error"),
        ("frame_error_retransmission_count", "frame_error_retransmission_count")]),
    "fact_ertms_disconnect": ("sp_ertms_disconnects", "imei", "imei", [
        ("incident_order", "nombre_ordre"), ("is_last_7_days", "derniere_7_jours"),
        ("disconnect_date", "date"), ("disconnect_time", "heure"), ("rame", "rame"),
        ("numero_train", "numero_train"), ("motrice_cab", "motrice_cab"), ("mrm", "mrm"), ("imei", "imei"),
        ("direction_sens", "sens"), ("km", "km"), ("etcs_level", "niveau_etcs"), ("event_type", "evenement"),
        ("intervalle", "intervalle"), ("root_cause", "cause_racine"), ("analysis_smmrgv", "analyse_smmrgv"),
        ("subsystem_at_fault", "sous_systeme_mis_en_cause"), ("rx_quality", "rxqual"), ("rx_level", "rxlev"),
        ("neighbors_10sec", "voisinage_10sec"), ("dte_dce_com", "com_dte_dce"), ("timing_offset", "ecart"),
        ("hdlc_t70_retransmissions", "retransmission_trames_hdlc_t70"), ("bts_alarms", "alarmes_bts"),
        ("action", "action"), ("ho_execution", "execution_ho"), ("handled_by", "traite_par"), ("cire", "cire"),
        ("ciers", "ciers"), ("auc_acknowledgment", "acquittement_auc"), ("rbc_bug", "bug_rbc"),
        ("pai_links", "liens_pai"), ("pilot", "pilote"), ("resolution_deadline", "echeance")]),
}
# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

_IDENTITY_TYPES = {"msisdn": "bigint", "imei": "bigint", "nid_engine": "int"}


def identity_branches(silver: Mapping[str, DataFrame]) -> list[DataFrame]:
    """G1: (imsi, msisdn, imei, nid_engine) per source, typed NULL where a source lacks one."""
    out = []
    for table, present in IDENTITY_BRANCHES:
        df = silver[table]
        out.append(df.select(
            F.col("imsi").cast("bigint").alias("imsi"),
            *[(F.col(c) if c in present else F.lit(None)).cast(t).alias(c) for c, t in _IDENTITY_TYPES.items()]))
    return out


def conform_identities(branches: Sequence[DataFrame]) -> DataFrame:
    """G2 + G3: UNION of the non-NULL-imsi branches, MAX of each attribute per imsi.

    The SQL's per-branch DISTINCT and the set UNION are skipped: MAX is
    idempotent, so duplicates cannot change the result, and one hash
    aggregation (partial per map task, then final) replaces three shuffles.
    """
    union = None
    for b in branches:
        b = b.filter(F.col("imsi").isNotNull())
        union = b if union is None else union.unionByName(b)
    return union.groupBy("imsi").agg(F.max("msisdn").alias("msisdn"), F.max("imei").alias("imei"),
                                     F.max("nid_engine").alias("nid_engine"))


def dense_subscriber_key(conformed: DataFrame, matrix: DataFrame) -> tuple[DataFrame, int]:
    """G4 + G5: enrich with the subscriber matrix's last-seen times, then number by imsi.

    The matrix is deduplicated per imsi, so the left join is 1:1; joining
    before numbering lets both sides keep their hash partitioning on imsi and
    the dimension is frozen by one Parquet copy.
    """
    sm = matrix.filter(F.col("imsi").isNotNull()).select(
        F.col("imsi").alias("__sm_imsi"), F.col("last_imsi_time").alias("imsi_last_time"),
        F.col("last_msisdn_time").alias("msisdn_last_time"))
    enriched = conformed.join(sm, conformed["imsi"] == sm["__sm_imsi"], "left").drop("__sm_imsi")
    keyed, rows = global_ordinal_counted(enriched, ["imsi"], out="subscriber_key")
    return keyed.select(*DIM_COLUMNS), rows


def build_dim(silver: Mapping[str, DataFrame]) -> tuple[DataFrame, int]:
    """dim_subscriber from the five supervision-tool tables (not the incident sheet)."""
    return dense_subscriber_key(conform_identities(identity_branches(silver)), silver["exp_subscriber_matrix"])


def build_fact(name: str, silver: Mapping[str, DataFrame], dim: DataFrame) -> DataFrame:
    """Left join of one silver table to the dimension, renamed to the gold names."""
    table, fact_key, dim_key, cols = FACTS[name]
    src = silver[table]
    projected = [(seconds_to_ms(F.col(c)) if out == "handover_duration_ms" else F.col(c)).alias(out)
                 for out, c in cols]
    keep_key = fact_key in [out for out, _ in cols]
    fact = src.select(*projected, *([] if keep_key else [F.col(fact_key).alias(f"__fk_{fact_key}")]))
    key = fact_key if keep_key else f"__fk_{fact_key}"
    joined = left_join_dim(fact, dim, key, dim_key, ["subscriber_key"])
    return joined.select("subscriber_key", *[out for out, _ in cols])


def build_gold(silver: Mapping[str, DataFrame], dim: DataFrame | None = None) -> dict[str, DataFrame]:
    if dim is None:
        dim, _ = build_dim(silver)
    out = {"dim_subscriber": dim}
    for name in FACTS:
        out[name] = build_fact(name, silver, dim)
    return out


def register_views(spark: SparkSession, gold: Mapping[str, DataFrame]) -> None:
    """Expose the gold tables as temp views for SQL users / BI."""
    for name, df in gold.items():
        df.createOrReplaceTempView(name)
