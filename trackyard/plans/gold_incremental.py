"""Gold kept up from what an epoch of incremental silver has changed (G1-G13 over U2).

The dimension is stored in ranges of ``SPAN`` imsi each, with every subscriber's
place within its range. A key is the number of subscribers in all ranges before, which is
one row a range, plus the place. An epoch changes some imsi: those alone are conformed anew, and
only their ranges are written again; the others keep their files, and their keys move
with the ranges' counts. So the result equals the full rebuild's, without sorting the dimension.

Neighbouring ranges share a file, as many as a task writes, so there are as many files as the rows need, however many
ranges there are. The manifest names each range's files, and only those with wanted ranges are opened. A version of
whose rows fewer are current than not is written anew, so that a reader doesn't pass over more and more replaced rows.

Facts are views over silver and the dimension, as the original's are: a shifted key
needs no fact to be rewritten.

A refresh writes its ranges and a manifest (range, version, files, rows, written) under a version
of its own; one row appended last makes it current. A refresh that is lost changes nothing,
and the next one applies its epochs again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackyard.plans import gold as G
from trackyard.plans import silver as S
from trackyard.plans import tracking
from trackyard.schemas import ALL_TABLES, SOURCES
from trackyard.session import freeze, frozen_scope
from trackyard.streaming import incremental as U

SPAN = 1_000_000
ATTRIBUTES = [c for c in G.DIM_COLUMNS if c != "subscriber_key"]
BLOCK = 4096  # ranges whose counts one window adds up
FEW = 100_000  # replaced rows of a version that are left where they are
MANIFEST = "range bigint, version string, files array<string>, rows bigint, written bigint"
DATA = ("imsi bigint, msisdn bigint, imei bigint, nid_engine int, imsi_last_time timestamp_ntz, "
        "msisdn_last_time timestamp_ntz, range bigint, place bigint, version string")
POINTER = "version string, applied array<string>, published_at timestamp_ntz"


def silver_tables(spark: SparkSession, silver_root: str) -> dict[str, DataFrame]:
    """The current incremental silver tables; one without an epoch yet is empty."""
    out = {}
    for table in ALL_TABLES:
        current = U.current_table(spark, silver_root, table)
        if current is None:
            current = S.build_silver_table(spark.createDataFrame([], SOURCES[table].bronze_schema), table, tracking.now())
        out[table] = current
    return out


def _root(gold_root: str) -> str:
    # not the former "incremental", whose ranges are folders: such a dimension is built anew from silver
    return f"{gold_root}/dimension"


def _current(spark: SparkSession, gold_root: str) -> tuple[str, list[str]] | None:
    """(version, applied epochs) of the current manifest."""
    path = f"{_root(gold_root)}/pointer"
    if not tracking._exists(spark, path):
        return None
    row = spark.read.schema(POINTER).parquet(path).orderBy(F.col("published_at").desc(), F.col("version").desc()).first()
    return row["version"], row["applied"]


def _ranges(spark: SparkSession, gold_root: str, version: str) -> DataFrame:
    """(range, version, files, rows, written): where each range's rows are, and all rows that its version has written."""
    return spark.read.schema(MANIFEST).parquet(f"{_root(gold_root)}/manifest/of={version}")


def _stored(spark: SparkSession, gold_root: str, ranges: DataFrame) -> DataFrame:
    """The rows of ``ranges`` with the columns of these; files without any of them are not opened."""
    data = f"{_root(gold_root)}/data"
    held = ranges.select("version", F.explode("files").alias("file")).distinct()
    files = [f"{data}/version={r['version']}/{r['file']}" for r in held.collect()]
    rows = spark.read.schema(DATA).option("basePath", data).parquet(*files) if files else spark.createDataFrame([], DATA)
    return rows.join(ranges.drop("files", "rows", "written"), ["version", "range"])


def _thin(ranges: DataFrame) -> DataFrame:
    """(version): those of whose rows fewer are in ``ranges`` than not, beyond a number that costs little to read."""
    by = ranges.groupBy("version").agg(F.sum("rows").alias("rows"), F.max("written").alias("written"))
    return by.filter(F.col("written") - F.col("rows") > F.greatest(F.col("rows"), F.lit(FEW))).select("version")


def _with_before(ranges: DataFrame) -> DataFrame:
    """Add ``before``, the rows of all ranges before: the blocks' totals in one window, the ranges' in one a block."""
    blocks = ranges.withColumn("block", F.floor(F.col("range") / BLOCK).cast("bigint"))
    earlier = lambda w: F.coalesce(F.sum("rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = blocks.groupBy("block").agg(F.sum("rows").alias("rows")) \
                   .select("block", earlier(Window.orderBy("block")).alias("blocks_before"))
    within = blocks.withColumn("before", earlier(Window.partitionBy("block").orderBy("range")))
    return within.join(totals, "block").withColumn("before", F.col("before") + F.col("blocks_before")).drop("block", "blocks_before")


def read_dim(spark: SparkSession, gold_root: str) -> DataFrame:
    """The dimension, its keys from the ranges' counts (one row a range) and the places within them."""
    current = _current(spark, gold_root)
    if current is None:
        raise FileNotFoundError(f"no published dimension under {gold_root}")
    ranges = _with_before(_ranges(spark, gold_root, current[0]))
    return _stored(spark, gold_root, ranges).withColumn("subscriber_key", F.col("before") + F.col("place")).select(*G.DIM_COLUMNS)


def _conformed(silver: dict[str, DataFrame], changed: DataFrame | None) -> DataFrame:
    """G1-G3, G5 of the changed imsi alone (all, if None)."""
    only = (lambda df: df) if changed is None else (lambda df: df.join(changed, "imsi", "left_semi"))
    conformed = G.conform_identities([only(b) for b in G.identity_branches(silver)])
    matrix = only(silver["exp_subscriber_matrix"].filter(F.col("imsi").isNotNull())).select(
        "imsi", F.col("last_imsi_time").alias("imsi_last_time"), F.col("last_msisdn_time").alias("msisdn_last_time"))
    return conformed.join(matrix, "imsi", "left").select(*ATTRIBUTES)


def refresh_dim(spark: SparkSession, silver_root: str, gold_root: str, span: int = SPAN) -> int:
    """Apply the silver epochs that the dimension doesn't have yet; returns how many there were."""
    current = _current(spark, gold_root)
    applied = set(current[1]) if current else set()
    # one name an epoch and identity table
    epochs = {f"{t}/{v}" for t, _ in G.IDENTITY_BRANCHES for v in U.published_versions(spark, silver_root, t)}
    todo = sorted(epochs - applied)
    if not todo:
        return 0
    with frozen_scope(spark):
        _refresh(spark, silver_root, gold_root, span, current, sorted(epochs), todo)
    return len(todo)


def _refresh(spark: SparkSession, silver_root: str, gold_root: str, span: int, current: tuple | None, epochs: list[str],
             todo: list[str]) -> None:
    silver, version = silver_tables(spark, silver_root), uuid.uuid4().hex
    of = F.floor(F.col("imsi") / span).cast("bigint")
    if current is None:
        rows, kept = _conformed(silver, None), None
    else:
        changed = None
        for name in todo:
            one = U.changed_imsi(spark, silver_root, *name.split("/"))
            changed = one if changed is None else changed.unionByName(one)
        changed = changed.distinct()
        ranges = _ranges(spark, gold_root, current[0])
        touched = changed.select(of.alias("range")).distinct()
        rest = ranges.join(touched, "range", "left_anti")
        touched = freeze(touched.unionByName(rest.join(_thin(rest), "version", "left_semi").select("range")))
        old = _stored(spark, gold_root, ranges.join(touched, "range", "left_semi")).join(changed, "imsi", "left_anti")
        rows, kept = old.select(*ATTRIBUTES).unionByName(_conformed(silver, changed)), ranges.join(touched, "range", "left_anti")
    place = F.row_number().over(Window.partitionBy("range").orderBy("imsi")).cast("bigint")
    root = _root(gold_root)
    # neighbouring ranges in one task, by sampled bounds, and so in one file
    rows.withColumn("range", of).repartitionByRange("range").withColumn("place", place) \
        .write.parquet(f"{root}/data/version={version}")
    written = spark.read.parquet(f"{root}/data/version={version}").select("range", F.col("_metadata.file_name").alias("file")) \
                   .groupBy("range").agg(F.lit(version).alias("version"), F.collect_set("file").alias("files"),
                                         F.count(F.lit(1)).alias("rows"))
    written = written.crossJoin(written.agg(F.sum("rows").alias("written")))
    manifest = written if kept is None else written.unionByName(kept.select(*written.columns))
    manifest.coalesce(1).write.parquet(f"{root}/manifest/of={version}")
    spark.createDataFrame([(version, epochs, tracking.now())], POINTER).coalesce(1) \
         .write.mode("append").parquet(f"{root}/pointer")


def read_gold(spark: SparkSession, silver_root: str, gold_root: str, register: bool = True) -> dict[str, DataFrame]:
    """The dimension, and the facts as views over current silver."""
    tables = G.build_gold(silver_tables(spark, silver_root), read_dim(spark, gold_root))
    if register:
        G.register_views(spark, tables)
    return tables
