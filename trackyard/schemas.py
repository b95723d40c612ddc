"""Declared schemas and header maps of the seven sources.

Each source is one :class:`SourceSpec`; routing, header mapping, typing, the
dedup key and the table names all come from it, so the ingest, silver and gold
code never lists a source by hand.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the warehouse being reproduced).
# Per source, one line per column in table order:
#   export header (after the header normalisation of the source) | column | bronze type
# Headers of the supervision exports are matched after strip + lower-case; the
# incident sheet headers after strip only (case kept).
# ---------------------------------------------------------------------------

ETCS_CALL = """
start time | start_time | timestamp_ntz
stop time | stop_time | string
call setup duration (ms) | call_setup_duration | string
transaction duration (ms) | transaction_duration | string
etcs baseline | etcs_baseline | smallint
system version | system_version | decimal(3,1)
nid_engine | nid_engine | int
nid_operational | nid_operational | int
imsi | imsi | bigint
msisdn | msisdn | bigint
imei | imei | bigint
calling number | calling_number | bigint
called number | called_number | int
gsm-r connected | gsmr_connected | string
etcs connected | etcs_connected | string
start nid_c | start_nid_c | int
start nid_bg | start_nid_bg | int
stop nid_c | stop_nid_c | int
stop nid_bg | stop_nid_bg | int
stop d_lrbg | stop_d_lrbg | int
root failure | root_failure | string
end domain | end_domain | string
protocol layer | protocol_layer | string
end event | end_event | string
end cause | end_cause | string
isdn port probe | isdn_port_probe | string
"""

HDLC_FRAME_ERRORS = """
start time | start_time | timestamp_ntz
stop time | stop_time | timestamp_ntz
frame error time | frame_error_time | timestamp_ntz
isdn port probe | isdn_port_probe | string
nid_engine | nid_engine | int
nid_operational | nid_operational | int
calling number | calling_number | bigint
called number | called_number | int
last nid_c | last_nid_c | int
last nid_bg | last_nid_bg | int
m level | m_level | string
m_mode | m_mode | string
direction | direction | string
frame error | frame_error | string
frame error retransmission count | frame_error_retransmission_count | int
"""

SUBSCRIBER_MATRIX = """
imsi | imsi | bigint
last imsi time | last_imsi_time | timestamp_ntz
msisdn | msisdn | bigint
last msisdn time | last_msisdn_time | timestamp_ntz
nid_engine | nid_engine | int
last nid_engine time | last_nid_engine_time | timestamp_ntz
fn ct3 | fn_ct3 | bigint
last fn ct3 time | last_fn_ct3_time | timestamp_ntz
fn ct4 | fn_ct4 | bigint
last fn ct4 time | last_fn_ct4_time | timestamp_ntz
"""

HO_TRACING = """
start time | start_time | timestamp_ntz
stop time | stop_time | timestamp_ntz
ho start time | ho_start_time | timestamp_ntz
ho duration | ho_duration | decimal(10,3)
src lac | src_lac | int
src ci | src_ci | int
trg lac | trg_lac | int
trg ci | trg_ci | int
imsi | imsi | bigint
msisdn | msisdn | bigint
imei | imei | bigint
ms power | ms_power | string
call type | call_type | string
ho type | ho_type | string
ho end event | ho_end_event | string
ho end cause | ho_end_cause | string
ho cause | ho_cause | string
"""

VGCS_VBS_REC_TRACING = """
start time | start_time | timestamp_ntz
stop time | stop_time | timestamp_ntz
application type | application_type | string
transaction type | transaction_type | string
transaction subtype | transaction_subtype | string
functional number | functional_number | bigint
imsi | imsi | bigint
tmsi | tmsi | string
msisdn | msisdn | bigint
gid | gid | int
area | area | int
gcr | gcr | bigint
priority | priority | string
start lac | start_lac | int
start ci | start_ci | int
establishment delay (ms) | establishment_delay | string
sccp success rate | sccp_success_rate | string
cell success rate | cell_success_rate | string
dispatcher success rate | dispatcher_success_rate | string
end user | end_user | string
vgcs duration (ms) | vgcs_duration | string
"""

TRANSACTION_TRACING = """
start time | start_time | timestamp_ntz
stop time | stop_time | string
call setup duration (ms) | call_setup_duration | string
establishment delay (ms) | establishment_delay | string
transaction duration (ms) | transaction_duration | string
start lac | start_lac | int
start ci | start_ci | int
stop lac | stop_lac | int
stop ci | stop_ci | int
nid_engine | nid_engine | int
nid_operational | nid_operational | int
tmsi | tmsi | string
reallocated tmsi | reallocated_tmsi | string
imsi | imsi | bigint
msisdn | msisdn | bigint
imei | imei | bigint
calling number | calling_number | bigint
called number | called_number | bigint
dest. route add. | dest_route_address | string
functional number | functional_number | string
functional number ct | functional_number_ct | string
direction | direction | string
transaction type | transaction_type | string
transaction subtype | transaction_subtype | string
application type | application_type | string
gsm-r connected | gsmr_connected | string
priority | priority | string
root failure | root_failure | string
protocol layer | protocol_layer | string
end event | end_event | string
end cause | end_cause | string
gb ciphering algo | gb_ciphering_algo | string
"""

ERTMS_DISCONNECTS = """
N° ordre | nombre_ordre | int
7 derniers jours? | derniere_7_jours | boolean
Date | date | date
Heure | heure | time_text
N° Train | numero_train | int
Rame | rame | int
Motrice / Cab | motrice_cab | string
MRM | mrm | string
IMEI | imei | bigint
Sens | sens | string
Km | km | string
Intervalle | intervalle | string
Niveau ETCS | niveau_etcs | string
Evénement | evenement | string
Cause_racine | cause_racine | string
Analyse SMMRGV | analyse_smmrgv | string
Sous Système mis en cause | sous_systeme_mis_en_cause | string
Action | action | string
Execution HO | execution_ho | string
RxQual | rxqual | string
RxLev | rxlev | string
Voisinage (10sec) | voisinage_10sec | string
Com DTE-DCE | com_dte_dce | string
Ecart | ecart | string
Retransmission trames HDLC/T.70 | retransmission_trames_hdlc_t70 | string
Alarmes BTS | alarmes_bts | string
Traité par | traite_par | string
CIRE | cire | string
CIERS | ciers | string
Acquittement AUC | acquittement_auc | string
BUG RBC | bug_rbc | string
Liens PAI | liens_pai | string
Pilote | pilote | string
Échéance | echeance | date
"""

# Token tests on the lower-cased file name, in precedence order; the first
# source whose tokens are all contained in the name receives the file.
ROUTING = [
    ("exp_etcs_call", ("etcs", "call")),
    ("exp_transaction_tracing", ("transaction",)),
    ("exp_vgcs_vbs_rec_tracing", ("vgcs", "vbs")),
    ("exp_ho_tracing", ("ho",)),
    ("exp_subscriber_matrix", ("subscriber", "matrix")),
    ("exp_hdlc_frame_errors", ("hdlc", "frame")),
]

# Dedup keys of the silver layer (latest _ingested_at wins).
DEDUP_KEYS = {
    "exp_etcs_call": ("imsi", "start_time"),
    "exp_transaction_tracing": ("imsi", "start_time"),
    "exp_vgcs_vbs_rec_tracing": ("start_time", "gid", "functional_number"),
    "exp_ho_tracing": ("imsi", "ho_start_time", "src_lac", "src_ci"),
    "exp_subscriber_matrix": ("imsi",),
    "exp_hdlc_frame_errors": ("nid_engine", "frame_error_time", "calling_number", "direction"),
    "sp_ertms_disconnects": ("date", "heure", "imei"),
}

# Sentinel a running call carries instead of a stop time.
CALL_RUNNING = "Call running..."

# Text tokens pandas' CSV reader turns into NaN by default.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null")

# Source systems of the file log.
SOURCE_EXPORTS = "expandium"
SOURCE_INCIDENTS = "sharepoint"
# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

LINEAGE_FIELDS = [
    T.StructField("_batch_id", T.StringType()),
    T.StructField("_source_file", T.StringType()),
    T.StructField("_ingested_at", T.TimestampNTZType()),
    T.StructField("_row_num", T.IntegerType()),
    T.StructField("_file_hash", T.StringType()),
]
LINEAGE_COLUMNS = [f.name for f in LINEAGE_FIELDS]

_TYPE_NAMES = {
    "string": T.StringType(),
    "time_text": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
}


def spark_type(name: str) -> T.DataType:
    if name.startswith("decimal("):
        p, s = name[len("decimal("):-1].split(",")
        return T.DecimalType(int(p), int(s))
    return _TYPE_NAMES[name]


@dataclass(frozen=True)
class Column:
    header: str
    name: str
    kind: str

    @property
    def dtype(self) -> T.DataType:
        return spark_type(self.kind)


@dataclass(frozen=True)
class SourceSpec:
    table: str
    columns: tuple[Column, ...]
    dedup_keys: tuple[str, ...]
    tokens: tuple[str, ...] = ()
    case_sensitive_headers: bool = False
    source_system: str = SOURCE_EXPORTS
    header_map: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def bronze_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype) for c in self.columns] + LINEAGE_FIELDS)

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)


def _parse_block(block: str) -> tuple[Column, ...]:
    cols = []
    for line in block.strip().splitlines():
        header, name, kind = (part.strip() for part in line.split("|"))
        cols.append(Column(header, name, kind))
    return tuple(cols)


def _spec(table: str, block: str, **kw) -> SourceSpec:
    cols = _parse_block(block)
    tokens = dict(ROUTING).get(table, ())
    return SourceSpec(table=table, columns=cols, dedup_keys=DEDUP_KEYS[table], tokens=tokens,
                      header_map={c.header: c.name for c in cols}, **kw)


SOURCES: dict[str, SourceSpec] = {
    s.table: s for s in (
        _spec("exp_etcs_call", ETCS_CALL),
        _spec("exp_transaction_tracing", TRANSACTION_TRACING),
        _spec("exp_vgcs_vbs_rec_tracing", VGCS_VBS_REC_TRACING),
        _spec("exp_ho_tracing", HO_TRACING),
        _spec("exp_subscriber_matrix", SUBSCRIBER_MATRIX),
        _spec("exp_hdlc_frame_errors", HDLC_FRAME_ERRORS),
        _spec("sp_ertms_disconnects", ERTMS_DISCONNECTS, case_sensitive_headers=True,
              source_system=SOURCE_INCIDENTS),
    )
}

EXPORT_TABLES = [t for t, _ in ROUTING]
INCIDENT_TABLE = "sp_ertms_disconnects"
ALL_TABLES = EXPORT_TABLES + [INCIDENT_TABLE]

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("total_files", T.IntegerType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("error_message", T.StringType()),
])

FILE_LOG_SCHEMA = T.StructType([
    T.StructField("file_id", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("processed_at", T.TimestampNTZType()),
    T.StructField("filename", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
])
