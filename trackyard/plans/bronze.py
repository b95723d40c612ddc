"""Bronze ingest (S3, S5-S14): route, skip seen content, parse, validate, type, append.

One run is a handful of Spark jobs over all files of the folder, not a loop
over files:

1. one look at every file (``exports.survey``): content id, header, whether cells hold line
   breaks; then the files are classified against the file log: already ingested / second copy in
   this batch / routing failure;
2. header lines are resolved to positions once for each distinct line (``resolve_layouts``);
3. per target table, one text scan parses every record and writes it to a staged table: typed
   values, raw texts, and narrow flags (bad cells, surplus fields, whole numbers);
4. the flags alone are read to judge each file; the records of good files go from the staged table to bronze,
   partitioned by batch (a retried batch overwrites its own partition only);
5. one append of the per-file results to the file log.

Files are rows of small tables all the way. The driver gets their paths, because a scan is told
what to read, and single totals; it never gets a file's summary or any data.
"""

from __future__ import annotations

import datetime as _dt
import secrets
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackyard.functions import names as N
from trackyard.functions import parse as P
from trackyard.operators.ordinal import global_ordinal
from trackyard.plans import tracking
from trackyard.schemas import EXPORT_TABLES, INCIDENT_TABLE, SOURCE_EXPORTS, SOURCE_INCIDENTS, SOURCES, SourceSpec
from trackyard.session import ensure_checkpoint_dir, frozen_scope, run_concurrently, same_splits, short_methods, shuffles_let_go
from trackyard.sources import exports as X
from trackyard.sources.files import delete


@dataclass
class Stats:
    files_total: int = 0
    files_success: int = 0
    files_skipped: int = 0
    files_failed: int = 0
    rows_loaded: int = 0

    def __add__(self, other: Stats) -> Stats:
        return Stats(*(a + b for a, b in zip(self.astuple(), other.astuple(), strict=True)))

    def astuple(self):
        return (self.files_total, self.files_success, self.files_skipped, self.files_failed, self.rows_loaded)


def create_batch_id(prefix: str = "run", at: _dt.datetime | None = None) -> str:
    """A run's own id; it names folders, so it holds nothing that a file system refuses."""
    stamp = (at or tracking.now()).strftime("%Y%m%dT%H%M%S%f")
    return "-".join((prefix, stamp, secrets.token_hex(4)))


# --------------------------------------------------------------------------
# S11 skip test
# --------------------------------------------------------------------------

def classify_listed_files(listed: DataFrame, log: DataFrame) -> DataFrame:
    """Add ``decision`` to listed files (path, filename, file_id, table; ``table`` NULL if the name fits none).

    SKIPPED: the content has a SUCCESS in the file log. UNROUTED: no table. COPY: an
    earlier file of this listing, by (lower-cased name, name, path), that has a table
    holds the same content; it is skipped only once that one has succeeded. NEW: the rest.

    The first copy per hash comes from an aggregation (partial per map task), so a
    hash shared by a third of the files costs one row per task in the shuffle; the
    join back is AQE-managed (broadcast when small, skew-split otherwise).
    """
    seen = (log.filter(F.col("status") == "SUCCESS").select("file_id").distinct()
               .withColumn("__seen", F.lit(True)))
    place = F.struct(F.lower("filename").alias("l"), F.col("filename").alias("n"), F.col("path").alias("p"))
    first = listed.filter(F.col("table").isNotNull()).groupBy("file_id").agg(F.min(place).alias("__first"))
    out = listed.join(first, "file_id", "left").join(seen, "file_id", "left")
    decision = (F.when(F.col("__seen"), F.lit("SKIPPED"))
                 .when(F.col("table").isNull(), F.lit("UNROUTED"))
                 .when(place != F.col("__first"), F.lit("COPY"))
                 .otherwise(F.lit("NEW")))
    return out.withColumn("decision", decision).drop("__seen", "__first")


# --------------------------------------------------------------------------
# typing of one raw text cell
# --------------------------------------------------------------------------

# how a spreadsheet exported in a French locale writes dates and booleans
# (English true/false/yes/no/1/0 are understood by the cast itself)
SHEET_DATE_FORMATS = ("dd/MM/yyyy", "dd/MM/yyyy HH:mm", "dd/MM/yyyy HH:mm:ss")
SHEET_TRUE = ("VRAI", "OUI")
SHEET_FALSE = ("FAUX", "NON")


def typed_cell(raw: Column, kind: str, dtype: T.DataType) -> tuple[Column, Column]:
    """(typed value, is-bad flag) of a raw text cell for a declared column kind.

    Bad = present but not convertible; the file carrying it fails, as an insert
    into the typed table would.
    """
    if kind == "string":
        return raw, F.lit(False)
    if kind in ("smallint", "int", "bigint"):
        # digits cast directly (exact for 15-19 digit ids); '13042.0' goes
        # through DECIMAL and must be whole; anything else is a bad cell
        dec = P.try_decimal(raw)
        value = F.coalesce(P.try_integer(raw, dtype), F.when(dec % 1 == 0, dec.try_cast(dtype)))
        return value, raw.isNotNull() & value.isNull()
    if kind == "time_text":
        ts = F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), F.trim(raw)))
        value = F.date_format(ts, "HH:mm:ss")
        return value, raw.isNotNull() & value.isNull()
    if kind == "date":
        t = F.trim(raw)
        value = F.coalesce(t.try_cast("date"), t.try_cast("timestamp_ntz").cast("date"),
                           *[F.try_to_timestamp(t, F.lit(fmt)).cast("date") for fmt in SHEET_DATE_FORMATS])
        return value, raw.isNotNull() & value.isNull()
    if kind == "boolean":
        word = F.upper(F.trim(raw))
        value = (F.when(word.isin(*SHEET_TRUE), F.lit(True)).when(word.isin(*SHEET_FALSE), F.lit(False))
                  .otherwise(F.trim(raw).try_cast("boolean")))
        return value, raw.isNotNull() & value.isNull()
    value = F.trim(raw).try_cast(dtype)
    return value, raw.isNotNull() & value.isNull()


# --------------------------------------------------------------------------
# per-table load
# --------------------------------------------------------------------------

class Staging:
    """Tables of one run in the shared checkpoint folder; all go when the run ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/bronze-{uuid.uuid4().hex}"

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_exc) -> None:
        delete(self.spark, self.path)

    def written(self, df: DataFrame, what: str) -> DataFrame:
        path = f"{self.path}/{what}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def resolve_layouts(spark: SparkSession, headers: DataFrame, sep: str = X.SEP) -> DataFrame:
    """(table, header, width, positions, unknown) of each distinct header line of a table.

    ``headers`` has (table, header). A cell is normalised and looked up in the table's header map; what the map
    doesn't have is a column's own name (sanitised first for the incident sheet) or unknown, and so is a repeated
    name, as ``name.1``. ``positions`` gives, for each column in table order, the cell that holds it, or null.
    Layouts are rows, however many there are; the plan is the same.
    """
    heads = headers.filter(F.col("header").isNotNull()).distinct().withColumn("width", X.token_count(F.col("header"), sep))
    most = heads.agg(F.max("width")).first()[0] or 0
    maps = spark.createDataFrame([(t, h, n) for t, s in SOURCES.items() for h, n in s.header_map.items()],
                                 "table string, key string, mapped string")
    columns = spark.createDataFrame([(t, c.name, i) for t, s in SOURCES.items() for i, c in enumerate(s.columns)],
                                    "table string, name string, ordinal int")
    keep_case = F.col("table").isin([t for t, s in SOURCES.items() if s.case_sensitive_headers])
    cell = heads.withColumn("cell", F.slice(X.cells(F.col("header"), most, sep), 1, F.col("width"))) \
                .select("table", "header", "width", F.posexplode("cell").alias("pos", "text")) \
                .withColumn("key", N.normalise_header(F.coalesce("text", F.lit("")), keep_case))
    named = cell.join(maps, ["table", "key"], "left").withColumn(
        "name", F.coalesce("mapped", F.when(keep_case, N.sanitise_name("key")).otherwise(F.col("key"))))
    known = named.join(columns, ["table", "name"], "left")
    earlier = F.col("pos") > F.min("pos").over(Window.partitionBy("table", "header", "name"))
    judged = known.withColumn("bad", F.when(earlier, F.concat("name", F.lit(".1"))).when(F.col("ordinal").isNull(),
                                                                                         F.col("name")))
    at = F.map_from_entries(F.collect_list(F.when(F.col("bad").isNull(), F.struct("ordinal", "pos"))))
    unknown = F.transform(F.array_sort(F.collect_list(F.when(F.col("bad").isNotNull(), F.struct("pos", "bad")))),
                          lambda x: x["bad"])
    widest = max(len(s.columns) for s in SOURCES.values())
    return judged.groupBy("table", "header", "width").agg(at.alias("at"), unknown.alias("unknown")).select(
        "table", "header", "width",
        F.transform(F.sequence(F.lit(0), F.lit(widest - 1)), lambda i: F.try_element_at("at", i)).alias("positions"),
        F.array_join("unknown", ", ").alias("unknown"))


def _failed(files: DataFrame, error: Column) -> DataFrame:
    return files.select("no", F.lit("FAILED").alias("status"), F.lit(0).cast("bigint").alias("row_count"), error.alias("error"))


def _load_table(spark: SparkSession, spec: SourceSpec, files: DataFrame, bronze_root: str, batch_id: str, sep: str,
                staging: Staging, layouts: DataFrame) -> DataFrame:
    """Parse, judge and append the files routed to one table; returns (no, status, row_count, error) of each.

    ``files`` is a written table of (no, path, filename, file_id, ingested_at, header, header_index, multi), ``layouts``
    one of the run's headers that are lines (``resolve_layouts``); those of files with line breaks in cells are resolved here.
    """
    paths = files.select("path", "multi", "broken").collect()
    multi, plain = [r["path"] for r in paths if r["multi"]], [r["path"] for r in paths if not r["multi"]]
    layouts = layouts.filter(F.col("table") == spec.table)
    if multi:  # a cell may never be closed
        splits, ends = X.multi_line_splits(spark, multi, sep)
        files = files.join(ends.select("path", "file", "unclosed"), "path", "left").withColumn(
            "unclosed", F.coalesce("unclosed", F.lit(False)))
        if any(r["broken"] for r in paths):  # a header's cells may hold line breaks too
            some = splits.join(files.filter("broken").select("file"), "file", "left_semi")
            first = X.whole_records(X.split_records(spark, some, ends, sep, first=2), "file").groupBy("file").agg(
                F.max(F.when(F.col("id") == 0, F.col("value"))).alias("l0"), F.max(F.when(F.col("id") == 1, F.col("value"))).alias("l1"))
            named = F.coalesce(F.col("l0").contains("sep="), F.lit(False))
            heads = first.select("file", F.when(named, F.col("l1")).otherwise(F.col("l0")).alias("__header"),
                                 named.cast("bigint").alias("__at"))
            files = files.join(heads, "file", "left").withColumns(
                {"header": F.when(F.col("broken"), F.col("__header")).otherwise(F.col("header")),
                 "header_index": F.when(F.col("broken"), F.col("__at")).otherwise(F.col("header_index"))}).drop("__header", "__at")
        files = staging.written(files, "files")
        layouts = resolve_layouts(spark, files.select(F.lit(spec.table).alias("table"), "header"), sep)
    else:
        files = files.withColumn("unclosed", F.lit(False))

    laid = staging.written(files.join(layouts.drop("table"), "header", "left").withColumn(
        "problem", F.when(F.col("unclosed"), F.lit("Error tokenizing data: EOF inside a quoted cell"))
        .when(F.col("header").isNull(), F.lit("No columns to parse from file"))
        .when(F.col("unknown") != "", F.concat(F.lit("column(s) "), "unknown",
                                               F.lit(f' of relation "{spec.table}" do not exist')))), "layouts")
    refused = _failed(laid.filter("problem is not null"), F.col("problem"))
    able = laid.filter("problem is null")
    width = able.agg(F.max("width")).first()[0]
    if width is None:
        return staging.written(refused, "results")

    # one text scan: typed values, raw texts, and a flag a column in three numbers a record
    facts, staged = able.select("no", "width", "positions", "path", *(["file"] if multi else [])), []
    if plain:
        staged.append(staging.written(_parsed(X.records(spark, plain).join(facts, "path"), spec, width, sep), "staged"))
    if multi:
        # a record that goes on in another split is staged as it is, part by part, and parsed once it is whole
        rows = X.split_records(spark, splits, ends, sep).join(facts, "file")
        found = staging.written(_parsed(rows, spec, width, sep, F.when(F.col("part"), F.col("value"))), "staged")
        parts = found.filter("__part is not null").select("no", "id", "block", F.col("__part").alias("value"))
        whole = X.whole_records(parts, "no").join(facts, "no")
        staged += [found.filter("__part is null").drop("__part"), staging.written(_parsed(whole, spec, width, sep), "staged")]
    staged = _union(staged)
    others = [i for i, c in enumerate(spec.columns) if c.kind != "string"]

    # the flags alone: records before and in the header line don't count
    offsets = X.split_offsets(staged, "no")
    numbered = X.with_index(staged, "no", offsets=offsets).join(able.select("no", "header_index"), "no") \
                .filter(F.col("line_index") > F.col("header_index"))
    judged = numbered.groupBy("no").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("__surplus").alias("surplus"),
        *[F.count_if(F.col("__bad").bitwiseAND(F.lit(1 << i)) != 0).alias(f"__bad_{i}") for i in others],
        F.bit_and("__whole").bitwiseAND(F.bit_or("__filled")).alias("coerce"))
    amount = lambda c: F.coalesce(F.col(c), F.lit(0))
    problems = [F.when(amount("surplus") > 0, F.concat(F.lit("Error tokenizing data: "), F.col("surplus"), F.lit(
        " line(s) with more than "), F.col("width"), F.lit(" fields")))]
    problems += [F.when(amount(f"__bad_{i}") > 0, F.concat(
        F.lit(f"invalid input for column {spec.columns[i].name} ({spec.columns[i].kind}): "), F.col(f"__bad_{i}"),
        F.lit(" value(s)"))) for i in others]
    verdicts = staging.written(able.join(judged, "no", "left").select(
        "no", "file_id", "filename", "ingested_at", "header_index", amount("rows").cast("bigint").alias("rows"),
        amount("coerce").alias("coerce"), F.concat_ws("; ", *problems).alias("problem")), "verdicts")
    good = verdicts.filter("problem = ''")
    accepted = good.select("no", F.lit("SUCCESS").alias("status"), F.col("rows").alias("row_count"),
                           F.lit(None).cast("string").alias("error"))
    results = staging.written(refused.unionByName(accepted).unionByName(
        _failed(verdicts.filter("problem <> ''"), F.col("problem"))), "results")
    if good.isEmpty():
        return results

    out = []
    for i, c in enumerate(spec.columns):
        value = F.col(c.name)
        if c.kind == "string":
            # numeric-text columns whose values are all whole are written as integers (13042.0 -> 13042)
            value = F.when(F.col("coerce").bitwiseAND(F.lit(1 << i)) != 0, P.whole_number_text(value)).otherwise(value)
        out.append(value.alias(c.name))
    out += [F.lit(batch_id).alias("_batch_id"), F.col("filename").alias("_source_file"), F.col("ingested_at").alias("_ingested_at"),
            (F.col("line_index") - F.col("header_index")).cast("int").alias("_row_num"), F.col("file_id").alias("_file_hash")]
    published = X.with_index(staged, "no", offsets=offsets).join(good.drop("rows", "problem"), "no") \
                 .filter(F.col("line_index") > F.col("header_index")).select(*out)
    write_bronze(published, bronze_root, spec.table, batch_id, good.select(F.col("file_id").alias("_file_hash")))
    return results


def _parsed(rows: DataFrame, spec: SourceSpec, width: int, sep: str, part: Column | None = None) -> DataFrame:
    """Typed values of the records, and flags (bits by column): bad cells, whole numbers, filled cells."""
    cells = X.with_cells(rows, width, sep)
    # a record without a quote has been split at every separator
    fields = F.when(F.col("value").contains(X.QUOTE), X.token_count(F.col("value"), sep)).otherwise(F.size("__cells"))
    raw = {c.name: P.na_to_null(F.get("__cells", F.get("positions", F.lit(i)))) for i, c in enumerate(spec.columns)}
    cells = cells.withColumns({f"__raw_{n}": v for n, v in raw.items()})
    typed = {c.name: typed_cell(F.col(f"__raw_{c.name}"), c.kind, c.dtype) for c in spec.columns}
    texts = [i for i, c in enumerate(spec.columns) if c.kind == "string"]
    others = [i for i, c in enumerate(spec.columns) if c.kind != "string"]
    flag = lambda marks: _bits([F.when(m, F.lit(1 << i)).otherwise(F.lit(0)) for i, m in marks])
    raw_at = lambda i: F.col(f"__raw_{spec.columns[i].name}")
    return cells.select(
        "no", "block", "id", *([] if part is None else [part.alias("__part")]),
        (fields > F.col("width")).alias("__surplus"),
        flag([(i, typed[spec.columns[i].name][1]) for i in others]).alias("__bad"),
        flag([(i, P.is_whole(raw_at(i))) for i in texts]).alias("__whole"),
        flag([(i, raw_at(i).isNotNull()) for i in texts]).alias("__filled"),
        *[typed[c.name][0].cast(c.dtype).alias(c.name) for c in spec.columns])


def _bits(parts: list[Column]) -> Column:
    total = F.lit(0).cast("bigint")
    for part in parts:
        total = total.bitwiseOR(part.cast("bigint"))
    return total


def _load_or_fail(spark: SparkSession, spec: SourceSpec, files: DataFrame, bronze_root: str, batch_id: str,
                  sep: str, staging: Staging, layouts: DataFrame) -> DataFrame:
    """A table whose load throws fails its own files; the others are loaded and logged."""
    try:
        return _load_table(spark, spec, files, bronze_root, batch_id, sep, staging, layouts)
    except Exception as exc:  # noqa: BLE001 - recorded for each of its files
        text = f"{type(exc).__name__}: {exc}".splitlines()[0][:500]
        return staging.written(_failed(files, F.lit(text)), "results")


def write_bronze(df: DataFrame, bronze_root: str, table: str, batch_id: str | None = None,
                 hashes: DataFrame | None = None) -> None:
    """Typed append, one directory per batch; a retried batch replaces only its own directory.

    With ``batch_id`` and the ``hashes`` (``_file_hash``) about to be written, a batch directory that holds
    any other file's rows is left alone and the write refused: another run has used the id.
    """
    if batch_id is not None and hashes is not None:
        held = f"{bronze_root}/{table}/_batch_id={batch_id}"
        if tracking._exists(df.sparkSession, held):
            others = df.sparkSession.read.parquet(held).select("_file_hash").join(hashes, "_file_hash", "left_anti")
            if not others.isEmpty():
                raise ValueError(f"batch {batch_id} of {table} holds rows of other files")
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("_batch_id").parquet(f"{bronze_root}/{table}"))


def read_bronze(spark: SparkSession, bronze_root: str, table: str) -> DataFrame:
    spec = SOURCES[table]
    path = f"{bronze_root}/{table}"
    if not tracking._exists(spark, path):
        return spark.createDataFrame([], spec.bronze_schema)
    return spark.read.schema(spec.bronze_schema).parquet(path)


# --------------------------------------------------------------------------
# S14 run over one folder
# --------------------------------------------------------------------------

def ingest_folder(spark: SparkSession, folder: str | Sequence[str], bronze_root: str, batch_id: str,
                  source_system: str = SOURCE_EXPORTS, tables: Sequence[str] | dict | None = None,
                  sep: str = X.SEP, tracking_root: str | None = None,
                  started: _dt.datetime | None = None, ledger: str | None = None) -> Stats:
    """Ingest every file of ``folder`` (or an explicit list of files); returns the run statistics.

    ``tables`` None routes export files by name (S3); a single table (the
    incident sheet) takes every file; a dict ``{folder: table}`` routes a
    directory-per-source layout. Per-file outcomes go to the file log, and by path to ``ledger`` if there is one.
    """
    tracking_root = tracking_root or bronze_root
    started = started or tracking.now()
    listing = X.list_files(spark, folder)
    # Spark's scans are told their files by the driver; nothing else of a file is there
    paths = [r["path"] for r in listing.select("path").collect()]
    unread = spark.createDataFrame([(n,) for _, n in X.hidden_files(spark, folder)], "filename string").select(
        F.concat(F.lit("unread:"), "filename").alias("file_id"), "filename", F.lit(0).cast("bigint").alias("no"),
        F.lit("FAILED").alias("status"), F.lit(0).cast("bigint").alias("row_count"),
        F.lit("a name beginning with _ or . is not read").alias("error"))
    if not paths and unread.isEmpty():
        return Stats()
    if tables is None:
        route = N.route_source("filename")
    elif isinstance(tables, dict):
        route = None
        for prefix, table in tables.items():
            cond = F.col("path").startswith(X.qualified(spark, prefix))
            route = F.when(cond, F.lit(table)) if route is None else route.when(cond, F.lit(table))
    else:
        route = F.lit(tables[0])

    with Staging(spark) as staging, frozen_scope(spark), short_methods(spark), same_splits(spark), shuffles_let_go(spark):
        splits = staging.written(X.survey(spark, paths, sep), "splits") if paths else None
        files = _decided(spark, X.content_files(splits, listing, sep).withColumn("table", route), tracking_root, started,
                         staging) if paths else None
        results = _load_files(spark, files, bronze_root, batch_id, sep, staging) if paths else []
        outcome = unread
        if paths:
            judged = staging.written(files.join(_union(results), "no").select(
                "file_id", "filename", "no", "status", "row_count", "error", "path"), "judged")
            outcome = outcome.unionByName(judged.drop("path"))
            if ledger:
                tracking.record_paths(judged, ledger, batch_id)
        # processed_at follows processing order, so the current state per hash is the last decision
        processed = F.lit(tracking.now()).cast("timestamp_ntz")
        logged = staging.written(outcome.select(
            "file_id", F.lit(batch_id).alias("batch_id"), F.lit(source_system).alias("source_system"),
            _after_micros(processed, F.col("no")).alias("processed_at"), "filename",
            F.when(F.col("status") == "SUCCESS", F.col("row_count")).otherwise(0).cast("bigint").alias("row_count"),
            "status", F.col("error").alias("error_message")), "log")
        tracking.record_file_results(logged, tracking_root)
        of = lambda status: F.count_if(F.col("status") == status)
        return Stats(*logged.agg(F.count(F.lit(1)), of("SUCCESS"), of("SKIPPED"), of("FAILED"),
                                 F.coalesce(F.sum("row_count"), F.lit(0))).first())


def _after_micros(stamp: Column, n: Column) -> Column:
    return stamp + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (n / F.lit(1_000_000)).cast("decimal(18,6)"))


def _decided(spark: SparkSession, files: DataFrame, tracking_root: str, started: _dt.datetime, staging: Staging) -> DataFrame:
    """The files with their decision, place in processing order (``no``, from 0) and load stamp."""
    files = staging.written(files, "listing")
    # the file log grows with history: only the rows of this listing's contents leave its scan
    log = tracking.read_log(spark, tracking_root, tracking.FILE_LOG).join(
        files.select("file_id").distinct(), "file_id", "left_semi")
    ordered = global_ordinal(classify_listed_files(files, log), [F.lower("filename"), F.col("filename"), F.col("path")], "no")
    # one load stamp per file, in processing order: a later file wins ties in silver
    placed = ordered.withColumn("no", F.col("no") - 1)
    return staging.written(placed.withColumn(
        "ingested_at", _after_micros(F.lit(started).cast("timestamp_ntz"), F.col("no"))), "decided")


def _load_files(spark: SparkSession, files: DataFrame, bronze_root: str, batch_id: str, sep: str,
                staging: Staging) -> list[DataFrame]:
    """Load what is new, table by table; returns the files' results as tables of (no, status, row_count, error)."""
    skipped = lambda df: df.select("no", F.lit("SKIPPED").alias("status"), F.lit(0).cast("bigint").alias("row_count"),
                                   F.lit(None).cast("string").alias("error"))
    results = [skipped(files.filter("decision = 'SKIPPED'")),
               _failed(files.filter("decision = 'UNROUTED'"), F.lit("the name fits no known export"))]
    todo, copies, wave = files.filter("decision = 'NEW'"), files.filter("decision = 'COPY'"), 0
    while True:
        # the tables are independent: their jobs run side by side
        names = [r[0] for r in todo.select("table").distinct().collect()]
        wave_id = f"{batch_id}-{wave}" if wave else batch_id
        layouts = staging.written(resolve_layouts(spark, todo.filter("not multi").select("table", "header"), sep),
                                  "layouts") if names else None
        results += run_concurrently([
            lambda t=t, w=wave_id: _load_or_fail(spark, SOURCES[t], todo.filter(F.col("table") == t), bronze_root, w, sep,
                                                 staging, layouts) for t in names])
        if copies.isEmpty():
            return results
        # a copy is skipped once its content is in; else the next copy has its turn
        done = files.join(_union(results[2:]).filter("status = 'SUCCESS'"), "no", "left_semi").select("file_id").distinct() \
            if len(results) > 2 else files.select("file_id").limit(0)
        results.insert(2, skipped(staging.written(copies.join(done, "file_id", "left_semi"), "copies")))
        left = staging.written(copies.join(done, "file_id", "left_anti"), "copies")
        first = left.groupBy("file_id").agg(F.min("no").alias("no"))
        todo = staging.written(left.join(first, ["file_id", "no"], "left_semi"), "todo")
        copies, wave = left.join(first, ["file_id", "no"], "left_anti"), wave + 1
        if left.isEmpty():
            return results


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def run_ingestion(spark: SparkSession, exports_dir: str | None, incidents_dir: str | None, bronze_root: str,
                  batch_id: str | None = None, incidents_sep: str = X.SEP) -> tuple[str, str, Stats]:
    """Bronze entry: both sources under one batch id, run log start/end, status roll-up."""
    batch_id = batch_id or create_batch_id()
    started = tracking.record_run_start(spark, bronze_root, batch_id, "bronze")
    total, error = Stats(), None
    try:
        if exports_dir:
            total = total + ingest_folder(spark, exports_dir, bronze_root, batch_id, SOURCE_EXPORTS,
                                          started=started)
        if incidents_dir:
            total = total + ingest_folder(spark, incidents_dir, bronze_root, batch_id, SOURCE_INCIDENTS,
                                          tables=[INCIDENT_TABLE], sep=incidents_sep, started=started)
        status = tracking.batch_status(spark, bronze_root, batch_id)
    except Exception as exc:  # noqa: BLE001 - the run row records any failure
        status, error, total = "FAILED", f"{type(exc).__name__}: {exc}", Stats()
    tracking.record_run_end(spark, bronze_root, batch_id, "bronze", started, status, total.files_total,
                            total.rows_loaded, error)
    return batch_id, status, total


__all__ = ["Stats", "classify_listed_files", "ingest_folder", "run_ingestion", "read_bronze", "write_bronze",
           "typed_cell", "create_batch_id", "EXPORT_TABLES"]
