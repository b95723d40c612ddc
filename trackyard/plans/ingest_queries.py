"""Driver queries over the whole ingest path.

Spark writes the line items as handover exports: files of differing header order, byte-order marks,
separator lines, line ends, quoted cells with separators, quotes and line breaks, a copy, and four kinds of
broken files. Production code then lists, hashes, routes, parses, judges, loads, logs, deduplicates and
serves them. The oracles say by hand what must come out.

``l_orderkey % 13`` deals the lines to files: 8 to 11 are broken, 13 is a copy of 12.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackyard.plans import bronze, gold_incremental, orchestrate, silver, tracking
from trackyard.schemas import SOURCES
from trackyard.session import ensure_checkpoint_dir, freeze, short_methods, shuffles_let_go
from trackyard.sources import exports as X
from trackyard.sources.files import delete
from trackyard.streaming import incremental

HO = "exp_ho_tracing"
UNKNOWN, BAD_CELL, SURPLUS, UNCLOSED, COPIED, COPY, SHORT = 8, 9, 10, 11, 12, 13, 4
SEP, HEAD, LINE, LAST = range(4)  # a file's parts in order
DEALT = 13
LATER = 9  # files from this one on are written after the others

# column | the cell's text, in Spark SQL | the value, in DuckDB SQL; k is the file
HANDOVERS = [line.split(" | ") for line in r"""
start_time | date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss.SSS') | l_shipdate
stop_time | '' | CAST(NULL AS TIMESTAMP)
ho_start_time | date_format(date_trunc('year', l_shipdate), 'yyyy-MM-dd HH:mm:ss.SSS') | CAST(date_trunc('year', l_shipdate) AS TIMESTAMP)
ho_duration | concat(l_partkey % 10000, '.250') | CAST(l_partkey % 10000 + 0.25 AS DECIMAL(10,3))
src_lac | if(k = 9, 'x1', concat(l_suppkey % 3, '.0')) | CAST(l_suppkey % 3 AS INTEGER)
src_ci | l_linenumber % 2 | CAST(l_linenumber % 2 AS INTEGER)
trg_lac | if(l_partkey % 7 = 0, 'NA', string(l_partkey % 500)) | CASE WHEN l_partkey % 7 <> 0 THEN CAST(l_partkey % 500 AS INTEGER) END
trg_ci | l_linenumber + 1 | CAST(l_linenumber + 1 AS INTEGER)
imsi | concat('00', l_orderkey) | l_orderkey
msisdn | l_orderkey * 10 | l_orderkey * 10
imei | if(l_partkey % 5 = 0, '', string(l_partkey)) | CASE WHEN l_partkey % 5 <> 0 THEN l_partkey END
ms_power | concat(if(k % 2 = 0, '', 'P'), cast(l_quantity as int), '.0') | CASE WHEN k % 2 = 0 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) ELSE concat('P', CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), '.0') END
call_type | l_returnflag | l_returnflag
ho_type | if(l_linenumber % 3 = 0, concat('"x; ""', l_linestatus, '""\n\n', 'y"'), 'Intra') | CASE WHEN l_linenumber % 3 = 0 THEN concat('x; "', l_linestatus, '"', chr(10), chr(10), 'y') ELSE 'Intra' END
ho_end_event | 'OK' | 'OK'
ho_end_cause | 'N/A' | CAST(NULL AS VARCHAR)
ho_cause | 'Better cell' | CASE WHEN k <> 4 THEN 'Better cell' END
""".strip().splitlines()]
ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
         "l_returnflag", "l_linestatus", "l_shipdate"]


def _scratch(spark: SparkSession, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def _write_files(lines: DataFrame, order: list, path: str, made: dict[str, Column] | None = None) -> str:
    """``lines`` (file, value) as one text file a value of ``file``, in ``order``; columns ``made`` are added once they are sorted."""
    with shuffles_let_go(lines.sparkSession), short_methods(lines.sparkSession):
        placed = lines.repartition("file").sortWithinPartitions("file", *order)
        for name, column in (made or {}).items():
            placed = placed.withColumn(name, column)
        placed.select("file", "value").write.mode("append").partitionBy("file").text(path)
    return path


def _turned(cells: Column, k: Column, n: int) -> Column:
    """The cells in the order of file ``k``, which lacks the last of them if it is the short one."""
    cells = F.when(k == SHORT, F.slice(cells, 1, n - 1)).otherwise(cells)
    by = (k % n).cast("int")
    return F.concat(F.slice(cells, by + 1, F.greatest(F.size(cells) - by, F.lit(0))), F.slice(cells, 1, F.least(by, F.size(cells))))


def handover_files(spark: SparkSession, sf_dir: str, keep: str = "true", duration: str = "0") -> str:
    """Write the exports; ``keep`` chooses files by ``k``, ``duration`` is added to each one's milliseconds.

    The lines' columns are dealt and sorted; their texts, several times as long, are made where they are written. Two writes
    hold fewer shuffle files at once than one.
    """
    n, path = len(HANDOVERS), _scratch(spark, "exports")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rows = li.select((F.col("l_orderkey") % DEALT).cast("int").alias("k"), F.lit(LINE).alias("part"), *ORDER)
    # the separator line, the header, and a last line that is never closed
    more = spark.range(DEALT).select(F.col("id").cast("int").alias("k"), F.explode(F.array(*map(F.lit, (SEP, HEAD, LAST)))).alias("part"))
    more = more.filter(f"part = {HEAD} OR part = {SEP} AND k % 2 = 0 OR part = {LAST} AND k = {UNCLOSED}")
    lines = rows.unionByName(more, allowMissingColumns=True).withColumn("of", F.col("k"))
    lines = lines.unionByName(lines.filter(F.col("k") == COPIED).withColumn("k", F.lit(COPY))).filter(keep)
    lines = lines.withColumnsRenamed({"k": "file", "of": "k"})
    k, part = F.col("k"), F.col("part")
    end = F.when(k % 4 == 1, F.lit("\r")).otherwise("")
    mark = F.when(k % 3 == 0, F.lit("\ufeff")).otherwise("")
    texts = [F.expr(f"cast({text.strip().replace('.250', f'.{250 + int(duration)}')} as string)") for _, text, _ in HANDOVERS]
    extra = F.when(k.isin(UNKNOWN, SURPLUS), F.lit(";x")).otherwise("")
    names = F.array(*[F.lit(c.header.title()) for c in SOURCES[HO].columns])
    head = F.concat(F.when(k % 2 == 0, "").otherwise(mark), F.concat_ws(";", _turned(names, k, n)),
                    F.when(k == UNKNOWN, F.lit(";Surprise")).otherwise(""), end)
    # the cells are a column of their own: within a condition each use would make them anew
    value = F.when(part == LINE, F.concat(F.concat_ws(";", _turned(F.col("cells"), k, n)), extra, end)) \
             .when(part == HEAD, head).when(part == SEP, F.concat(mark, F.lit('"sep=;"'), end)).otherwise('"never closed')
    for some in (F.col("file") < LATER, F.col("file") >= LATER):  # the latter's shuffle begins when the former's is gone
        _write_files(lines.filter(some), ["part", *ORDER], path, {"cells": F.array(*texts), "value": value})
    return path


def _folders(spark: SparkSession, path: str) -> list[str]:
    return [f"{path}/file={k}" for k in range(COPY + 1)]


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    root = _scratch(spark, "bronze")
    path = handover_files(spark, sf_dir)
    batch = bronze.create_batch_id()
    started = tracking.record_run_start(spark, root, batch, "bronze")
    stats = bronze.ingest_folder(spark, _folders(spark, path), root, batch, tables={path: HO}, started=started)
    tracking.record_run_end(spark, root, batch, "bronze", started, tracking.batch_status(spark, root, batch),
                            stats.files_total, stats.rows_loaded)
    delete(spark, path)  # the exports, once they are loaded
    return root


_VALUES = ", ".join(f"{value.strip()} AS {name}" for name, _, value in HANDOVERS)
_NAMES = [name for name, _, _ in HANDOVERS]
_GOOD = f"k NOT IN ({UNKNOWN}, {BAD_CELL}, {SURPLUS}, {UNCLOSED})"
_BRONZE_SQL = f"""
SELECT {_VALUES}, CAST(row_number() OVER (PARTITION BY k ORDER BY {', '.join(ORDER)}) AS INTEGER) AS _row_num
FROM (SELECT *, l_orderkey % {DEALT} AS k FROM lineitem) WHERE {_GOOD}"""


def q_ingest_exports(spark, d):
    """Every value and row number of the bronze table."""
    return bronze.read_bronze(spark, _ingested(spark, d), HO).select(*_NAMES, "_row_num")


def q_ingest_log(spark, d):
    """What became of the files."""
    log = tracking.files(spark, _ingested(spark, d))
    return log.groupBy("status", "error_message").agg(F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("rows_loaded"))


# the copy shares its original's content id: one state, that of the later of the two, which is skipped
SQL_INGEST_LOG = f"""
WITH n AS (SELECT l_orderkey % {DEALT} AS k, count(*) AS n FROM lineitem GROUP BY ALL),
f AS (SELECT CASE WHEN k = {COPIED} THEN 'SKIPPED' WHEN {_GOOD} THEN 'SUCCESS' ELSE 'FAILED' END AS status,
             CASE k WHEN {UNKNOWN} THEN 'column(s) surprise of relation "{HO}" do not exist'
                    WHEN {BAD_CELL} THEN concat('invalid input for column src_lac (int): ', CAST(n AS VARCHAR), ' value(s)')
                    WHEN {SURPLUS} THEN concat('Error tokenizing data: ', CAST(n AS VARCHAR), ' line(s) with more than 17 fields')
                    WHEN {UNCLOSED} THEN 'Error tokenizing data: EOF inside a quoted cell' END AS error_message,
             CASE WHEN {_GOOD} AND k <> {COPIED} THEN n ELSE 0 END AS loaded FROM n)
SELECT status, error_message, count(*) AS files, CAST(sum(loaded) AS BIGINT) AS rows_loaded FROM f GROUP BY ALL
"""


def q_run_log_state(spark, d):
    """A run and its repetition, in the order of their starts."""
    root, path = _scratch(spark, "bronze"), handover_files(spark, d)
    for _ in range(2):
        batch = bronze.create_batch_id()
        started = tracking.record_run_start(spark, root, batch, "bronze")
        stats = bronze.ingest_folder(spark, _folders(spark, path), root, batch, tables={path: HO}, started=started)
        tracking.record_run_end(spark, root, batch, "bronze", started, tracking.batch_status(spark, root, batch),
                                stats.files_total, stats.rows_loaded)
    delete(spark, path)
    states = tracking.latest_runs(tracking.runs(spark, root))
    return states.select("layer", "status", "total_files", "total_rows")


SQL_RUN_LOG_STATE = f"""
SELECT 'bronze' AS layer, 'PARTIAL' AS status, 14 AS total_files, count(*) AS total_rows
FROM (SELECT l_orderkey % {DEALT} AS k FROM lineitem) WHERE {_GOOD}
UNION ALL SELECT 'bronze', 'FAILED', 14, 0
"""


def _silver(spark, d) -> str:
    root, out = _ingested(spark, d), _scratch(spark, "silver")
    _, status, _ = silver.run_silver(spark, root, out)
    if status != "SUCCESS":
        raise RuntimeError(status)
    return out


def q_silver_snapshot(spark, d):
    """L1-L3: the published snapshot's handovers."""
    return silver.read_silver(spark, _silver(spark, d))[HO].select(*_NAMES, "_row_num")


_LATEST = "PARTITION BY imsi, ho_start_time, src_lac, src_ci ORDER BY"
SQL_SILVER_SNAPSHOT = f"SELECT * FROM ({_BRONZE_SQL}) QUALIFY row_number() OVER ({_LATEST} _row_num DESC) = 1"


def q_gold_views(spark, d):
    """The handover fact, left as a view over silver, through its SQL name."""
    out, gold = _silver(spark, d), _scratch(spark, "gold")
    orchestrate.publish_gold(spark, out, gold, silver.current_snapshot(spark, out), materialise_facts=False)
    orchestrate.read_gold(spark, gold, silver_root=out)
    return spark.sql("SELECT * FROM fact_handover")


SQL_GOLD_VIEWS = f"""
SELECT dense_rank() OVER (ORDER BY imsi) AS subscriber_key, imsi, start_time, stop_time, ho_start_time AS handover_start_time,
       src_lac AS source_lac, src_ci AS source_ci, trg_lac AS target_lac, trg_ci AS target_ci, ms_power, call_type,
       ho_type AS handover_type, ho_end_event AS handover_end_event, ho_end_cause AS handover_end_cause,
       ho_cause AS handover_cause, CAST(round(ho_duration * 1000) AS INTEGER) AS handover_duration_ms
FROM ({SQL_SILVER_SNAPSHOT})
"""


def q_incremental_merge(spark, d):
    """Two batches through the silver stream; the second exports some files again, with other durations."""
    root, out, state = (_scratch(spark, x) for x in ("bronze", "silver", "stream"))
    first = handover_files(spark, d, f"k NOT IN ({COPY})")
    again = handover_files(spark, d, "k IN (0, 1, 2)", duration="500")
    for path in (first, again):
        bronze.ingest_folder(spark, _folders(spark, path), root, bronze.create_batch_id(), tables={path: HO})
        delete(spark, path)
        incremental.start_silver_stream(spark, root, out, HO, state).awaitTermination()
    return incremental.current_table(spark, out, HO).select(*_NAMES, "_row_num")


SQL_INCREMENTAL_MERGE = f"""
SELECT * REPLACE (CAST(CASE WHEN imsi % {DEALT} IN (0, 1, 2) THEN ho_duration + 0.5 ELSE ho_duration END AS DECIMAL(10,3)) AS ho_duration)
FROM ({SQL_SILVER_SNAPSHOT})
"""


def q_gold_incremental(spark, d):
    """G1-G13 over U2: the dimension and its handovers after two epochs, the second with new subscribers among the old."""
    root, out, gold = (_scratch(spark, x) for x in ("bronze", "silver", "gold"))
    state = _scratch(spark, "stream")
    path = handover_files(spark, d, f"k NOT IN ({COPY})")
    for files in (range(0, COPY, 2), range(COPY)):
        folders = [f"{path}/file={k}" for k in files]
        bronze.ingest_folder(spark, folders, root, bronze.create_batch_id(), tables={path: HO})
        if len(folders) == COPY:
            delete(spark, path)
        incremental.start_silver_stream(spark, root, out, HO, state).awaitTermination()
        gold_incremental.refresh_dim(spark, out, gold, span=100)
    return gold_incremental.read_gold(spark, out, gold, register=False)["fact_handover"]


# --------------------------------------------------------------------------
# records, content ids and header lines by themselves
# --------------------------------------------------------------------------

def q_export_records(spark, d):
    """Parts as records whose cells hold separators, quotes, blank lines and line breaks; every field and its place."""
    p = spark.read.parquet(f"{d}/part.parquet")
    odd = F.expr('''CASE p_partkey % 5 WHEN 0 THEN concat('"', p_name, ';', p_type, '"')
                    WHEN 1 THEN concat('"say ""', p_name, '"""')
                    WHEN 2 THEN concat('"', p_name, '\\n;\\n\\n', p_type, '"')
                    WHEN 3 THEN concat(p_name, ' 5" ', p_type) ELSE p_name END''')
    lines = p.select((F.col("p_partkey") % 16).alias("file"), "p_partkey",
                     F.concat_ws(";", "p_partkey", odd, "p_brand").alias("value"))
    path = _write_files(lines, ["p_partkey"], _scratch(spark, "records"))
    found = X.numbered_records(spark, [path]).withColumn("cell", X.cells(F.col("value"), 3))
    return found.select(F.col("cell")[0].cast("bigint").alias("p_partkey"), F.col("cell")[1].alias("name_text"),
                        F.col("cell")[2].alias("brand"), X.token_count(F.col("value")).alias("fields"), "line_index")


SQL_EXPORT_RECORDS = """
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN concat(p_name, ';', p_type) WHEN 1 THEN concat('say "', p_name, '"')
                       WHEN 2 THEN concat(p_name, chr(10), ';', chr(10), chr(10), p_type)
                       WHEN 3 THEN concat(p_name, ' 5" ', p_type) ELSE p_name END AS name_text,
       p_brand AS brand, 3 AS fields, row_number() OVER (PARTITION BY p_partkey % 16 ORDER BY p_partkey) - 1 AS line_index
FROM part
"""


def q_content_id(spark, d):
    """Orders dealt to files; 8-15 are copies of 0-7, 16-23 hold their lines the other way round."""
    o = spark.read.parquet(f"{d}/orders.parquet")
    line = F.concat_ws(";", "o_orderkey", "o_custkey", "o_orderpriority")
    k = (F.col("o_orderkey") % 8).cast("int")
    lines = o.select(F.explode(F.array(k, k + 8, k + 16)).alias("file"), "o_orderkey", line.alias("value"))
    lines = lines.withColumn("place", F.when(F.col("file") < 16, F.col("o_orderkey")).otherwise(-F.col("o_orderkey")))
    path = _write_files(lines, ["place"], _scratch(spark, "contents"))
    listing = X.list_files(spark, [f"{path}/file={f}" for f in range(24)])
    splits = X.survey(spark, [r["path"] for r in listing.select("path").collect()])
    files = freeze(X.content_files(splits, listing).select(
        F.regexp_extract("path", r"file=(\d+)/", 1).cast("int").alias("file"), "file_id"))
    first = files.groupBy("file_id").agg(F.min("file").alias("same_as"), F.count(F.lit(1)).alias("files"))
    return files.join(first, "file_id").select("file", "same_as", "files", F.length("file_id").alias("id_length"))


SQL_CONTENT_ID = """
WITH l AS (SELECT unnest([0, 8, 16]) AS base, o_orderkey % 8 AS k, o_orderkey,
                  concat_ws(';', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderpriority) AS line FROM orders),
f AS (SELECT CAST(k + base AS INTEGER) AS file,
             string_agg(line, chr(10) ORDER BY CASE WHEN base < 16 THEN o_orderkey ELSE -o_orderkey END) AS content
      FROM l GROUP BY k, base)
SELECT file, min(file) OVER (PARTITION BY content) AS same_as, count(*) OVER (PARTITION BY content) AS files, 64 AS id_length FROM f
"""


def q_header_layouts(spark, d):
    """A header line a part: the seven tables' headers turned, spaced, in other cases, some with a strange or repeated cell."""
    p = spark.read.parquet(f"{d}/part.parquet")
    tables = spark.createDataFrame([(i, t, [c.header for c in s.columns], not s.case_sensitive_headers)
                                    for i, (t, s) in enumerate(SOURCES.items())],
                                   "n int, table string, names array<string>, any_case boolean")
    x = p.select("p_partkey", (F.col("p_partkey") % 7).cast("int").alias("n"), "p_brand").join(tables, "n")
    by = (F.col("p_partkey") % F.size("names")).cast("int")
    turned = F.concat(F.slice("names", by + 1, F.size("names") - by), F.slice("names", F.lit(1), by))
    cased = F.when(F.col("any_case") & (F.col("p_partkey") % 2 == 0), F.transform(turned, F.upper)).otherwise(turned)
    more = F.when(F.col("p_partkey") % 11 == 0, F.array(F.concat(F.lit("New "), "p_brand"))) \
            .when(F.col("p_partkey") % 11 == 1, F.slice(turned, 1, 1)).otherwise(F.array().cast("array<string>"))
    line = F.concat_ws(";", F.transform(F.concat(cased, more), lambda c: F.concat(F.lit(" "), c, F.lit("\t"))))
    heads = x.select("p_partkey", "table", line.alias("header"), F.size("names").alias("columns"), by.alias("turn"))
    laid = bronze.resolve_layouts(spark, heads.select("table", "header"))
    spots = F.slice("positions", 1, F.col("columns"))
    return heads.join(laid, ["table", "header"]).select(
        "p_partkey", "table", "width", F.array_join(F.transform(spots, lambda s: s.cast("string")), ",").alias("spots"), "unknown")


def _layouts_sql() -> str:
    tables = ", ".join(f"({i}, '{t}', {len(s.columns)}, [{', '.join(repr(c.name) for c in s.columns)}], "
                       f"{not s.case_sensitive_headers})" for i, (t, s) in enumerate(SOURCES.items()))
    return f"""
WITH t(n, "table", columns, names, any_case) AS (VALUES {tables}),
x AS (SELECT p_partkey, p_brand, t.*, p_partkey % columns AS turn FROM part JOIN t ON p_partkey % 7 = n)
SELECT p_partkey, "table", columns + CASE WHEN p_partkey % 11 < 2 THEN 1 ELSE 0 END AS width,
       array_to_string(list_transform(range(columns), lambda i: CAST((i - turn + columns) % columns AS VARCHAR)), ',') AS spots,
       CASE p_partkey % 11 WHEN 0 THEN CASE WHEN any_case THEN lower(concat('New ', p_brand))
                                            ELSE lower(regexp_replace(concat('New ', p_brand), '[^a-zA-Z0-9_]', '_', 'g')) END
                           WHEN 1 THEN concat(names[turn + 1], '.1') ELSE '' END AS unknown
FROM x
"""


INGEST_QUERIES = {
    "export_records": (q_export_records, SQL_EXPORT_RECORDS),
    "content_id": (q_content_id, SQL_CONTENT_ID),
    "header_layouts": (q_header_layouts, _layouts_sql()),
    "ingest_exports": (q_ingest_exports, _BRONZE_SQL),
    "ingest_log": (q_ingest_log, SQL_INGEST_LOG),
    "run_log_state": (q_run_log_state, SQL_RUN_LOG_STATE),
    "silver_snapshot": (q_silver_snapshot, SQL_SILVER_SNAPSHOT),
    "gold_views": (q_gold_views, SQL_GOLD_VIEWS),
    "incremental_merge": (q_incremental_merge, SQL_INCREMENTAL_MERGE),
    "gold_incremental": (q_gold_incremental, SQL_GOLD_VIEWS),
}
