"""Driver queries of whole tables: five facts through ``build_fact``, four silver tables through
``build_silver_table``, on frames derived from the driver tables.

Each block below is written by hand, one line a column, and feeds two things that
know nothing of each other's rules: the input frame of the production function
(its column and type, filled by the expression) and the DuckDB statement of what
must come out. The expressions are plain SQL that both engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackyard.plans.analogues import _DIM_SQL, _dim, _lineage, _lineage_sql, _loaded_at
from trackyard.plans.gold import build_fact
from trackyard.plans.silver import build_silver_table

_SPARK = {"ts": "timestamp_ntz", "text": "string", "rate": "decimal(5,2)"}
_DUCK = {"ts": "TIMESTAMP", "text": "VARCHAR", "rate": "DECIMAL(5,2)"}


def _lines(block: str) -> list[list[str]]:
    return [[p.strip() for p in line.split("|")] for line in block.strip().splitlines()]


def _cast(expr: str, kind: str, types: dict) -> str:
    return f"CAST({expr or 'NULL'} AS {types.get(kind, kind)})"


# gold column | silver column | type | expression over the source (empty: NULL)
FACT_ETCS_CALL = """
imsi | imsi | bigint | CASE WHEN event_id % 7 <> 0 THEN user_id END
start_time | start_time | ts | ts
stop_time | stop_time | ts |
nid_engine | nid_engine | int | user_id % 100
nid_operational | nid_operational | int | event_id % 50
etcs_baseline | etcs_baseline | smallint | 2
system_version | system_version | decimal(3,1) | 1.1
start_nid_c | start_nid_c | int | event_id % 9
start_nid_bg | start_nid_bg | int | event_id % 11
stop_nid_c | stop_nid_c | int | event_id % 13
stop_nid_bg | stop_nid_bg | int | event_id % 17
stop_d_lrbg | stop_d_lrbg | int | event_id % 19
gsmr_connected | gsmr_connected | text | 'yes'
etcs_connected | etcs_connected | text | 'no'
root_failure | root_failure | text | event_type
end_domain | end_domain | text | 'GSM-R'
protocol_layer | protocol_layer | text | 'L3'
end_event | end_event | text | concat('end ', event_type)
end_cause | end_cause | text | props
isdn_port_probe | isdn_port_probe | text |
call_setup_duration_ms | call_setup_duration | int | event_id % 9000
transaction_duration_ms | transaction_duration | int | event_id % 70000
"""
FACT_TRANSACTION = """
imsi | imsi | bigint | CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END
start_time | start_time | ts | o_orderdate
stop_time | stop_time | ts |
nid_engine | nid_engine | int | o_custkey % 100
start_lac | start_lac | int | o_orderkey % 21
start_ci | start_ci | int | o_orderkey % 22
stop_lac | stop_lac | int | o_orderkey % 23
stop_ci | stop_ci | int | o_orderkey % 24
tmsi | tmsi | text | o_orderpriority
reallocated_tmsi | reallocated_tmsi | text |
direction | direction | text | 'MO'
transaction_type | transaction_type | text | o_orderstatus
transaction_subtype | transaction_subtype | text | concat(o_orderstatus, '-sub')
application_type | application_type | text | 'App'
functional_number | functional_number | text | CAST(o_custkey AS STRING)
dest_route_address | dest_route_address | text | 'route'
gsmr_connected | gsmr_connected | text | 'yes'
priority | priority | text | o_orderpriority
gb_ciphering_algo | gb_ciphering_algo | text | 'A5/1'
root_failure | root_failure | text | 'Success'
protocol_layer | protocol_layer | text | 'L2'
end_event | end_event | text | 'End'
end_cause | end_cause | text |
call_setup_duration_ms | call_setup_duration | int | o_orderkey % 3000
establishment_delay_ms | establishment_delay | int | o_orderkey % 2000
transaction_duration_ms | transaction_duration | int | o_orderkey % 90000
"""
FACT_GROUP_CALL = """
imsi | imsi | bigint | CASE WHEN p_partkey % 3 <> 0 THEN p_partkey END
start_time | start_time | ts | TIMESTAMP '2026-05-21 00:00:00'
stop_time | stop_time | ts |
functional_number | functional_number | bigint | p_partkey % 1000
gid | gid | int | p_partkey % 7
area | area | int | p_size
gcr | gcr | bigint | p_partkey * 3
application_type | application_type | text | p_type
transaction_type | transaction_type | text | 'VGCS'
transaction_subtype | transaction_subtype | text | p_brand
priority | priority | text | 'P1'
start_lac | start_lac | int | p_size + 1
start_ci | start_ci | int | p_size + 2
end_user | end_user | text | p_name
sccp_success_numerator | sccp_success_numerator | int | p_size % 3
sccp_success_denominator | sccp_success_denominator | int | 3
sccp_success_rate | sccp_success_rate | rate | p_size % 100
cell_success_numerator | cell_success_numerator | int | p_size % 2
cell_success_denominator | cell_success_denominator | int | 2
cell_success_rate | cell_success_rate | rate | 50.25
dispatcher_success_numerator | dispatcher_success_numerator | int |
dispatcher_success_denominator | dispatcher_success_denominator | int |
dispatcher_success_rate | dispatcher_success_rate | rate |
establishment_delay_ms | establishment_delay | int | p_partkey % 4000
vgcs_duration_ms | vgcs_duration | int | p_partkey % 60000
"""
# the join column is not among the fact's own columns
FACT_FRAME_ERROR = """
start_time | start_time | ts | l_shipdate
stop_time | stop_time | ts |
frame_error_time | frame_error_time | ts | l_shipdate
nid_engine | nid_engine | int | l_suppkey % 100
nid_operational | nid_operational | int | l_linenumber
isdn_port_probe | isdn_port_probe | text | 'probe'
last_nid_c | last_nid_c | int | l_partkey % 800
last_nid_bg | last_nid_bg | int | l_partkey % 6000
multiplexing_level | m_level | text | l_returnflag
multiplexing_mode | m_mode | text | 'Full'
direction | direction | text | l_linestatus
frame_error | frame_error | text | 'CRC'
frame_error_retransmission_count | frame_error_retransmission_count | int | l_linenumber * 2
"""
FACT_ERTMS_DISCONNECT = """
incident_order | nombre_ordre | int | o_orderkey
is_last_7_days | derniere_7_jours | boolean | o_orderstatus = 'O'
disconnect_date | date | ts | o_orderdate
disconnect_time | heure | text | '08:00:00'
rame | rame | int | o_custkey % 40
numero_train | numero_train | int | o_custkey % 9000
motrice_cab | motrice_cab | text | o_orderpriority
mrm | mrm | int | o_custkey % 500
imei | imei | bigint | CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END
direction_sens | sens | text | 'Pair'
km | km | decimal(8,3) | o_custkey % 300
etcs_level | niveau_etcs | text | '2'
event_type | evenement | text | o_orderstatus
intervalle | intervalle | text |
root_cause | cause_racine | text | 'cause'
analysis_smmrgv | analyse_smmrgv | text | 'analysis'
subsystem_at_fault | sous_systeme_mis_en_cause | text | 'radio'
rx_quality | rxqual | text | '0'
rx_level | rxlev | text | '-60'
neighbors_10sec | voisinage_10sec | text |
dte_dce_com | com_dte_dce | text | 'ok'
timing_offset | ecart | text |
hdlc_t70_retransmissions | retransmission_trames_hdlc_t70 | text | '3'
bts_alarms | alarmes_bts | text | 'none'
action | action | text | 'reset'
ho_execution | execution_ho | text | 'HO'
handled_by | traite_par | text | o_orderpriority
cire | cire | text | 'c1'
ciers | ciers | text | 'c2'
auc_acknowledgment | acquittement_auc | text | 'a'
rbc_bug | bug_rbc | text | 'b'
pai_links | liens_pai | text | 'l'
pilot | pilote | text | 'p'
resolution_deadline | echeance | ts | o_orderdate
"""


def _fact(name: str, table: str, source: str, block: str, key: str, dim_key: str, key_expr: str | None = None):
    rows = _lines(block)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cells = [f"{_cast(e, t, _SPARK)} AS {s}" for _, s, t, e in rows]
        if key_expr:
            cells.append(f"{_cast(key_expr, 'bigint', _SPARK)} AS {key}")
        silver = spark.read.parquet(f"{sf_dir}/{source}.parquet").selectExpr(*cells)
        return build_fact(name, {table: silver}, _dim(spark, sf_dir)[0])

    joined = _cast(key_expr, "bigint", _DUCK) if key_expr else next(_cast(e, t, _DUCK) for _, s, t, e in rows if s == key)
    cells = ", ".join(f"{_cast(e, t, _DUCK)} AS {g}" for g, _, t, e in rows)
    sql = (f"WITH d AS ({_DIM_SQL}), f AS (SELECT {joined} AS fact_key, {cells} FROM {source}) "
           f"SELECT d.subscriber_key, {', '.join('f.' + g for g, *_ in rows)} FROM f LEFT JOIN d ON f.fact_key = d.{dim_key}")
    return run, sql


# bronze column | type | expression | what silver holds, if not the same (over the same source)
SILVER_TRANSACTION = """
start_time | ts | o_orderdate |
stop_time | text | CASE WHEN o_orderkey % 7 = 0 THEN 'Call running...' ELSE '2026-05-13 10:01:00.000' END | CASE WHEN o_orderkey % 7 <> 0 THEN TIMESTAMP '2026-05-13 10:01:00' END
call_setup_duration | text | concat(CAST(o_orderkey % 5 AS STRING), 's ', CAST(o_custkey % 900 AS STRING), 'ms') | CAST((o_orderkey % 5) * 1000 + o_custkey % 900 AS INTEGER)
establishment_delay | text | CASE WHEN o_orderkey % 4 <> 0 THEN concat(CAST(o_custkey % 900 AS STRING), 'ms') END | CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey % 900 AS INTEGER) END
transaction_duration | text | concat(CAST(o_custkey % 60 AS STRING), 'min ', CAST(o_orderkey % 60 AS STRING), 's') | CAST((o_custkey % 60) * 60000 + (o_orderkey % 60) * 1000 AS INTEGER)
start_lac | int | o_orderkey % 21 |
start_ci | int | o_orderkey % 22 |
stop_lac | int | |
stop_ci | int | |
nid_engine | int | o_custkey % 100 |
nid_operational | int | |
tmsi | text | o_orderpriority |
reallocated_tmsi | text | |
imsi | bigint | CASE WHEN o_orderkey % 2 = 0 THEN o_custkey % 50 END |
msisdn | bigint | o_custkey |
imei | bigint | |
calling_number | bigint | o_custkey + 1 |
called_number | bigint | |
dest_route_address | text | 'route' |
functional_number | text | CAST(o_custkey AS STRING) |
functional_number_ct | text | |
direction | text | 'MO' |
transaction_type | text | o_orderstatus |
transaction_subtype | text | |
application_type | text | 'App' |
gsmr_connected | text | 'yes' |
priority | text | o_orderpriority |
root_failure | text | 'Success' |
protocol_layer | text | |
end_event | text | 'End' |
end_cause | text | |
gb_ciphering_algo | text | 'A5/1' |
"""
SILVER_HANDOVER = """
start_time | ts | l_shipdate |
stop_time | ts | |
ho_start_time | ts | l_shipdate |
ho_duration | decimal(10,3) | l_partkey % 10000 |
src_lac | int | l_suppkey % 20 |
src_ci | int | l_linenumber |
trg_lac | int | l_partkey % 500 |
trg_ci | int | l_linenumber + 1 |
imsi | bigint | CASE WHEN l_orderkey % 9 <> 0 THEN l_suppkey % 5 END |
msisdn | bigint | l_suppkey |
imei | bigint | l_partkey |
ms_power | text | l_returnflag |
call_type | text | l_linestatus |
ho_type | text | 'Intra' |
ho_end_event | text | 'OK' |
ho_end_cause | text | |
ho_cause | text | 'Better cell' |
"""
SILVER_MATRIX = """
imsi | bigint | user_id |
last_imsi_time | ts | ts |
msisdn | bigint | user_id * 10 |
last_msisdn_time | ts | CASE WHEN event_id % 3 <> 0 THEN ts END |
nid_engine | int | user_id % 100 |
last_nid_engine_time | ts | |
fn_ct3 | bigint | event_id |
last_fn_ct3_time | ts | ts |
fn_ct4 | bigint | |
last_fn_ct4_time | ts | |
"""
SILVER_FRAME_ERRORS = """
start_time | ts | l_shipdate |
stop_time | ts | l_shipdate |
frame_error_time | ts | l_shipdate |
isdn_port_probe | text | 'probe' |
nid_engine | int | l_suppkey % 10 |
nid_operational | int | l_linenumber |
calling_number | bigint | CASE WHEN l_orderkey % 8 <> 0 THEN l_partkey % 40 END |
called_number | int | l_partkey |
last_nid_c | int | l_partkey % 800 |
last_nid_bg | int | |
m_level | text | l_returnflag |
m_mode | text | 'Full' |
direction | text | l_linestatus |
frame_error | text | 'CRC' |
frame_error_retransmission_count | int | l_linenumber |
"""
_LINEAGE_DUCK = {"_batch_id": "VARCHAR", "_source_file": "VARCHAR", "_ingested_at": "TIMESTAMP", "_row_num": "INTEGER",
                 "_file_hash": "VARCHAR"}


def _silver(table: str, source: str, block: str, keys: str, file_expr: str, row_expr: str):
    """``row_expr`` numbers the rows of the source, so the latest row of a key is certain."""
    rows = [(r + [""])[:4] for r in _lines(block)]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = spark.read.parquet(f"{sf_dir}/{source}.parquet")
        lineage = _lineage(F.expr(file_expr), F.expr(row_expr).cast("int"), "export_")
        bronze = src.select(*[F.expr(_cast(e, t, _SPARK)).alias(c) for c, t, e, _ in rows],
                            *[v.alias(k) for k, v in lineage.items()])
        return build_silver_table(bronze, table, _loaded_at())

    lineage = _lineage_sql(file_expr, row_expr, "export_")
    cells = ", ".join([f"{_cast(e, t, _DUCK)} AS {c}" for c, t, e, _ in rows]
                      + [f"{s} AS out_{c}" for c, _, _, s in rows if s]
                      + [f"CAST({lineage[k]} AS {t}) AS {k}" for k, t in _LINEAGE_DUCK.items()])
    out = ", ".join([f"out_{c} AS {c}" if s else c for c, _, _, s in rows] + list(_LINEAGE_DUCK)
                    + ["TIMESTAMP '2026-01-01 00:00:00' AS _silver_loaded_at"])
    sql = (f"SELECT {out} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
           f"ORDER BY _ingested_at DESC, _file_hash DESC, _row_num DESC) AS rn FROM (SELECT {cells} FROM {source})) WHERE rn = 1")
    return run, sql


# (l_orderkey, l_linenumber) repeats; all columns together don't. No order has 32 rows, so the number is unique,
# and the latest row of a key is certain.
LINE_NUMBER = ("l_orderkey * 32 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, "
               "l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)")

TABLE_QUERIES = {
    "fact_etcs_call": _fact("fact_etcs_call", "exp_etcs_call", "events", FACT_ETCS_CALL, "imsi", "imsi"),
    "fact_transaction": _fact("fact_transaction", "exp_transaction_tracing", "orders", FACT_TRANSACTION, "imsi", "imsi"),
    "fact_group_call": _fact("fact_group_call", "exp_vgcs_vbs_rec_tracing", "part", FACT_GROUP_CALL, "imsi", "imsi"),
    "fact_frame_error": _fact("fact_frame_error", "exp_hdlc_frame_errors", "lineitem", FACT_FRAME_ERROR, "calling_number",
                              "msisdn", "CASE WHEN l_orderkey % 3 <> 0 THEN (l_suppkey - l_suppkey % 2) * 5 + 7 END"),
    "fact_ertms_disconnect": _fact("fact_ertms_disconnect", "sp_ertms_disconnects", "orders", FACT_ERTMS_DISCONNECT, "imei",
                                   "imei"),
    "silver_transaction": _silver("exp_transaction_tracing", "orders", SILVER_TRANSACTION, "imsi, start_time",
                                  "o_orderkey % 3", "o_orderkey"),
    "silver_handover": _silver("exp_ho_tracing", "lineitem", SILVER_HANDOVER, "imsi, ho_start_time, src_lac, src_ci",
                               "l_orderkey % 4", LINE_NUMBER),
    "silver_matrix": _silver("exp_subscriber_matrix", "events", SILVER_MATRIX, "imsi", "event_id % 5", "event_id"),
    "silver_frame_errors": _silver("exp_hdlc_frame_errors", "lineitem", SILVER_FRAME_ERRORS,
                                   "nid_engine, frame_error_time, calling_number, direction", "l_orderkey % 4", LINE_NUMBER),
}
