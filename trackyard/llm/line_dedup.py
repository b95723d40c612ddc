"""Line deduplication over levelled sorted runs of line hashes.

Documents arrive in batches. A batch's line keys are hashed to 128 bits and
aggregated into one sorted run; a merge anti-join against the runs already
there tells which keys are new. New keys enter their run with an owner (the
document that keeps the line), known keys with a count only. Runs are kept in
levels: when a level holds ``fanout`` runs they are merged into one sorted run
of the next level, so a key is rewritten a logarithmic number of times and a
batch joins a bounded number of runs.

Batches come in descending document order, hence the owner of a key is the
largest document that holds it, and is settled by the first run that has it.

Only DataFrame functions are used. A line that a third of the documents share
costs one row per map task in the runs (partial aggregation); in the final
join of lines with over-frequent keys it is a skewed key on the streamed side,
which AQE splits.

Defined results: a null text is the empty text, with one empty line. Rows
that share a doc_id count as one document holding the lines of all, and all of
them keep a line if that doc_id is its owner. A null doc_id is smaller than any other. An empty
table gives empty runs and no rows. Other columns of the input are ignored by
``line_verdicts`` and carried along by ``dedup_lines``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackyard.llm.common import drop_path, shared_path

SPACE = "\t\n\x0b\x0c\r "
MIN_CHARS = 20
MIN_DOCS = 3
N_BATCHES = 4
FANOUT = 2

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LONG_MIN = -(1 << 63)
_HASH = ["h1", "h2"]
RUN_SCHEMA = "h1 bigint, h2 bigint, n bigint, owner bigint"


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(SPACE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    # lower() equals the A-Z rule on ASCII and is much cheaper than translate()
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def _doc(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LONG_MIN))


def hashed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, tag, pos, h1, h2) of each line whose key is long enough; ``tag`` tells apart texts of one doc_id."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(_doc(id_col).alias("doc"), F.xxhash64(text).alias("tag"), F.split(text, "\n", -1).alias("line"))
    keyed = split.select("doc", "tag", F.posexplode("line").alias("pos", "line")).select(
        "doc", "tag", "pos", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    return keyed.select("doc", "tag", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


class LineRuns:
    """Levelled sorted runs of (h1, h2, n, owner) in the shared folder."""

    def __init__(self, spark: SparkSession, path: str, fanout: int = FANOUT):
        self.spark, self.path, self.fanout = spark, path, fanout
        self.levels: list[list[str]] = []
        self._made = 0

    def _write(self, df: DataFrame, level: int) -> str:
        self._made += 1
        path = f"{self.path}/level={level}/run-{self._made:06d}"
        df.sortWithinPartitions(*_HASH).write.parquet(path)
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        frames = [self.spark.read.schema(RUN_SCHEMA).parquet(p) for p in paths]
        return reduce(DataFrame.unionAll, frames) if frames else self.spark.createDataFrame([], RUN_SCHEMA)

    def runs(self) -> DataFrame:
        return self._read([p for level in self.levels for p in level])

    def _merged(self, df: DataFrame) -> DataFrame:
        return df.groupBy(*_HASH).agg(F.sum("n").alias("n"), F.max("owner").alias("owner"))

    def add_batch(self, keys: DataFrame) -> None:
        """Add a batch's (h1, h2, n, owner); keys of earlier batches contribute their count alone."""
        known = [p for level in self.levels for p in level]
        if known:
            held = self._read(known).filter("owner is not null").select(*_HASH)
            fresh = keys.join(held.hint("merge"), _HASH, "left_anti")
            again = keys.join(held.hint("merge"), _HASH, "left_semi").withColumn("owner", F.lit(None).cast("bigint"))
            keys = fresh.unionAll(again)
        self._push(self._write(keys, 0), 0)

    def _push(self, path: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            old = self.levels[level]
            merged = self._write(self._merged(self._read(old)), level + 1)
            self.levels[level] = []
            for p in old:
                drop_path(self.spark, p)
            self._push(merged, level + 1)

    def totals(self) -> DataFrame:
        """(h1, h2, n, owner) over everything added."""
        return self._merged(self.runs())


def _batch_bounds(docs: DataFrame, id_col: str, n_batches: int) -> list[int]:
    """Upper bounds of all but the last of ``n_batches`` ascending doc_id ranges of about equal row counts."""
    shares = [i / n_batches for i in range(1, n_batches)]
    row = docs.agg(F.percentile_approx(F.col(id_col).cast("bigint"), shares).alias("q")).first()
    return sorted(set(row["q"] or []))


def line_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                  min_docs: int = MIN_DOCS, n_batches: int = N_BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(doc, tag, dropped): positions of the lines that each text loses; texts that lose none are absent."""
    spark = docs.sparkSession
    root = shared_path(spark, "line-runs")
    bounds = _batch_bounds(docs, id_col, n_batches)
    batch = F.lit(0)
    for b in bounds:
        batch = batch + (F.col("doc") > b).cast("int")
    lines_path = f"{root}/lines"
    hashed_lines(docs, id_col, text_col, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(
        lines_path)
    lines = spark.read.schema("doc bigint, tag bigint, pos int, h1 bigint, h2 bigint, batch int").parquet(lines_path)

    store = LineRuns(spark, f"{root}/runs", fanout)
    for b in range(len(bounds), -1, -1):
        once = lines.filter(F.col("batch") == b).groupBy(*_HASH, "doc").agg(F.lit(1).alias("one"))
        keys = once.groupBy(*_HASH).agg(F.count("one").alias("n"), F.max("doc").alias("owner"))
        store.add_batch(keys)

    # written out, so that both sides of the join are plain shuffles and AQE can split a hot line
    frequent_path = f"{root}/frequent"
    store.totals().filter(F.col("n") >= min_docs).select(*_HASH, "owner").write.parquet(frequent_path)
    frequent = spark.read.schema("h1 bigint, h2 bigint, owner bigint").parquet(frequent_path)
    losing = lines.join(frequent, _HASH).filter(F.col("doc") < F.col("owner"))
    return losing.groupBy("doc", "tag").agg(F.collect_set("pos").alias("dropped"))


def _judged(docs: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    """docs with __kept (the text left over), __n_lines and __n_dropped."""
    verdicts = line_verdicts(docs, id_col, text_col, **options).select(
        F.col("doc").alias("__doc"), F.col("tag").alias("__tag"), F.col("dropped").alias("__dropped"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    joined = docs.join(verdicts, (_doc(id_col) == F.col("__doc")) & (F.xxhash64(text) == F.col("__tag")), "left")
    stays = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__dropped"))
    kept = F.array_join(F.transform(stays, lambda i: F.get("__lines", i)), "\n")
    lost = F.col("__dropped").isNotNull()
    return (joined.withColumn("__lines", F.split(text, "\n", -1))
                  .withColumn("__n_lines", F.size("__lines").cast("bigint"))
                  .withColumn("__n_dropped", F.when(lost, F.size("__dropped")).otherwise(0).cast("bigint"))
                  .withColumn("__kept", F.when(lost, kept).otherwise(text)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without their over-frequent lines, same columns; ``n_chars`` follows the text if there.

    A document that loses all its lines stays, with an empty text.
    """
    judged = _judged(docs, id_col, text_col, **options)
    changed = F.col("__n_dropped") > 0
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(F.when(changed, F.col("__kept")).otherwise(F.col(c)).alias(c))
        elif c == "n_chars":
            out.append(F.when(changed, F.char_length("__kept")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return judged.select(*out)


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row."""
    return _judged(docs, id_col, text_col, **options).select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"), F.sha2(F.col("__kept").cast("binary"), 256).alias("kept_sha256"))
