"""Readers for delimited exports (S1, S2, S4, S8, S10) as distributed scans.

An export is UTF-8 text, optionally with a BOM and an Excel ``sep=`` first
line, CRLF endings, ``;`` separated, header on the next line. Quoted cells may
hold separators, quotes and line breaks.

Spark's text source splits big files, strips the BOM and line ends, and tags
every line with its file and split. No file is ever funnelled through one task:

* ``survey`` reads each file once and keeps one row a split: a digest of its lines that
  can be shifted to any place in the file, its first lines, and whether a line leaves a cell open.
* ``content_files`` puts the splits of a file together: content id, header, and
  whether cells hold line breaks. Ids don't depend on how a file was split.
* ``records`` gives one row a record. Only files with a line that leaves a cell open
  need their lines' quote states carried through; the rest are taken line by line.
* ``with_index`` numbers the records of a file from 0, by its splits' counts.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackyard.session import freeze, map_batches
from trackyard.sources.files import exists, hadoop_path

SEP = ";"
QUOTE = '"'
CSV_OPTIONS = {"sep": SEP, "quote": QUOTE, "escape": QUOTE, "mode": "PERMISSIVE"}
LANES = 4  # independent line hashes in a content id, two from each 64-bit hash
_PRIME = (1 << 31) - 1  # they and their sums are taken modulo this
_POSITION = (1 << 33) - 1  # the part of monotonically_increasing_id that counts within a partition


def list_files(spark: SparkSession, folder: str | Sequence[str]) -> DataFrame:
    """(path, length, filename) of the files directly in ``folder`` (not recursive); none if it is missing.

    Listing goes through the binaryFile source; the content column is pruned, so only metadata is read. Spark's
    scans pass over files without a byte, so those come from the folders' status.
    """
    found = [f for f in ([folder] if isinstance(folder, str) else folder) if exists(spark, f)]
    columns = "path string, length bigint, filename string"
    if not found:
        return spark.createDataFrame([], columns)
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "false").load([glob_escape(f) for f in found])
                   .select("path", "length", F.element_at(F.split("path", "/"), -1).alias("filename")))
    empty = [(path, 0, name) for path, name in _statuses(
        spark, found, lambda name, status: status.getLen() == 0 and name[:1] not in ("_", "."))]
    return listed.filter("length > 0").unionByName(spark.createDataFrame(empty, columns)) if empty else listed


def qualified(spark: SparkSession, path: str) -> str:
    """The path as listings report it: with its file system's scheme and authority."""
    p, fs = hadoop_path(spark, path)
    return fs.makeQualified(p).toString()


def hidden_files(spark: SparkSession, folder: str | Sequence[str]) -> list[tuple[str, str]]:
    """(path, name) of the files that Spark's readers pass over: names beginning with ``_`` or ``.``.

    Checksum files (``.name.crc``) are the file system's own and don't count.
    """
    return _statuses(spark, folder, lambda name, _: name[:1] in ("_", ".") and not name.endswith(".crc"))


def _statuses(spark: SparkSession, folder: str | Sequence[str], wanted) -> list[tuple[str, str]]:
    """(path, name) of the files directly in ``folder`` for which ``wanted(name, status)`` holds."""
    out = []
    for one in [folder] if isinstance(folder, str) else folder:
        p, fs = hadoop_path(spark, one)
        if not fs.exists(p):
            continue
        for status in fs.listStatus(p):
            name = status.getPath().getName()
            if status.isFile() and wanted(name, status):
                out.append((status.getPath().toString(), name))
    return sorted(out)


_GLOB_CHARS = "\\[]{}*?"


def glob_escape(path: str) -> str:
    """Paths handed to a reader are glob patterns: escape ``[ ] { } * ?`` so a file
    named ``export[1].csv`` is read as itself."""
    return "".join("\\" + ch if ch in _GLOB_CHARS else ch for ch in path)


def file_path_column():
    """The text source's ``_metadata.file_path`` is a URI (space -> %20, # -> %23, % -> %25);
    decode it to the plain path the binaryFile listing reports. A literal '+' is legal in a
    URI path, so it is protected from the form-decoding rule '+' -> ' '. A URI without '%' is
    its own path: decoding is for every line and costs more than most of what is done with it."""
    encoded = F.col("_metadata.file_path")
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.when(encoded.contains("%"), decoded).otherwise(encoded).alias("path")


def raw_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, block, value, id) of every line; ``block`` is its split's first byte, ``id`` grows within a split."""
    return (spark.read.text([glob_escape(p) for p in paths])
                 .select(file_path_column(), F.col("_metadata.file_block_start").alias("block"), "value")
                 .withColumn("id", F.monotonically_increasing_id()))


def not_blank(value: str | Column = "value") -> Column:
    return F.trim(F.col(value) if isinstance(value, str) else value) != ""


# --------------------------------------------------------------------------
# quoted cells
# --------------------------------------------------------------------------
# A quote opens a cell if it is the cell's first character; inside, two quotes are one, and a single one ends
# the quoted part. Quotes elsewhere are text. The patterns never go back over what they have read.

_QUOTED = '[^"]*+(?:""[^"]*+)*+'  # inside a quoted cell, up to the quote that ends it or the end


def _not_sep(sep: str) -> str:
    return f"[^{re.escape(sep)}]"


def leaves_open(value: Column, begins_open: bool, sep: str = SEP) -> Column:
    """1 if a line that begins inside a quoted cell (or not) ends inside one, else 0."""
    rest, end = _not_sep(sep), re.escape(sep)
    opened = f'(?:(?:"{_QUOTED}"{rest}*+|[^"{end}]{rest}*+)?+{end})*+"{_QUOTED}\\z'
    pattern = f'^{_QUOTED}(?:\\z|"{rest}*+{end}{opened})' if begins_open else f"^{opened}"
    return F.when(value.contains(QUOTE), value.rlike(pattern).cast("int")).otherwise(int(begins_open))


def _states(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add ``if_closed`` and ``if_open``: the state before each row if its group begins closed, or open.

    ``c`` and ``o`` are the states after a row that begins closed, or open. A row either fixes the state,
    turns it round, or leaves it: the state is the last fixed one, turned as often as has happened since.
    """
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turns = F.coalesce(F.sum(((F.col("c") == 1) & (F.col("o") == 0)).cast("int")).over(before), F.lit(0))
    out = df.withColumn("__turns", turns)
    fixed = F.last(F.when(F.col("c") == F.col("o"), F.struct("c", "__turns")), ignorenulls=True).over(before)
    out = out.withColumn("__fixed", fixed)
    since = F.col("__turns") - F.coalesce(F.col("__fixed.__turns"), F.lit(0))
    state = lambda start: (F.coalesce(F.col("__fixed.c"), F.lit(start)) + since) % 2
    return out.withColumns({"if_closed": state(0), "if_open": state(1)}).drop("__turns", "__fixed")


def _after(state: str) -> Column:
    return F.when(F.col(state) == 0, F.col("c")).otherwise(F.col("o"))


def _marked(lines: DataFrame, sep: str) -> DataFrame:
    """Add ``mark``, a bit each: ends open if it begins closed, ends open if it begins open, is not blank."""
    marks = [leaves_open(F.col("value"), False, sep), leaves_open(F.col("value"), True, sep) * 2, not_blank().cast("int") * 4]
    return lines.withColumn("mark", (marks[0] + marks[1] + marks[2]).cast("tinyint"))


def _states_in(mark: np.ndarray, state: int) -> np.ndarray:
    """The state before each line, and that after the last one, if it is ``state`` before the first (see ``_states``)."""
    c, o = mark & 1, (mark >> 1) & 1
    turns = np.concatenate(([0], np.cumsum((c == 1) & (o == 0))))
    fixed = np.maximum.accumulate(np.concatenate(([-1], np.where(c == o, np.arange(len(mark)), -1))))
    at = np.maximum(fixed, 0)
    return np.where(fixed < 0, state + turns, c[at] + turns - turns[at]) % 2


def _by_split(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    """((file, block), from, to) of the batch's neighbouring lines of one split."""
    file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    for i, j in itertools.pairwise([0, *cuts.tolist(), len(file)]):
        if i < j:
            yield (int(file[i]), int(block[i])), i, j


def _split_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a split: the state after it, and how many records begin in it, for either state it may begin in."""
    rows: list[tuple] = []
    for batch in batches:
        marks = batch.column("mark").to_numpy()
        for key, i, j in _by_split(batch):
            if not rows or rows[-1][:2] != key:
                rows.append((*key, 0, 1, 0, 0))
            mark, ends, begun = marks[i:j], [], []
            for state, n in zip(rows[-1][2:4], rows[-1][4:], strict=True):
                states = _states_in(mark, state)
                ends.append(int(states[-1]))
                begun.append(n + int(np.count_nonzero((states[:-1] == 0) & (mark >= 4))))
            rows[-1] = (*key, *ends, *begun)
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ENDS, strict=True)],
                                         schema=_ENDS)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of splits whose state and record number at their first byte are known; at most one is held meanwhile."""
    now, state, number, held = None, 0, 0, []
    cut = False  # whether the record at hand began in an earlier split

    def at_hand(part: bool) -> Iterator[pa.RecordBatch]:
        if held:
            row = (now[0], now[1] if part else -1, number, part, "\n".join(held))
            held.clear()
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _RECORDS, strict=True)], schema=_RECORDS)

    for batch in batches:
        if batch.column("before").null_count:
            raise ValueError("the files' splits are not those of the scan before")
        marks, values = batch.column("mark").to_numpy(), batch.column("value")
        begins, before = batch.column("begins").to_numpy(), batch.column("before").to_numpy()
        for key, i, j in _by_split(batch):
            if now != key:
                yield from at_hand(True)
                now, state, number = key, int(begins[i]), int(before[i]) - 1
                cut = state == 1
            states = _states_in(marks[i:j], state)
            state, states = int(states[-1]), states[:-1]
            kept = np.flatnonzero((states == 1) | (marks[i:j] >= 4))
            lines = values.slice(i, j - i) if len(kept) == j - i else values.take(pa.array(kept + i))
            starts = np.flatnonzero(states[kept] == 0)
            held += lines.slice(0, starts[0] if len(starts) else len(kept)).to_pylist()
            if len(starts):
                yield from at_hand(cut)
                cut, n = False, len(starts) - 1
                if n:
                    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), lines), "\n")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, key[0], np.int64)), pa.array(np.full(n, -1, np.int64)),
                         pa.array(np.arange(number + 1, number + 1 + n)), pa.array(np.zeros(n, bool)), text], schema=_RECORDS)
                number += n + 1
                held += lines.slice(starts[-1]).to_pylist()
            if state == 0:
                yield from at_hand(cut)
                cut = False
    yield from at_hand(True)


_ENDS = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("c", pa.int32()), ("o", pa.int32()), ("n_closed", pa.int64()),
                   ("n_open", pa.int64())])
_RECORDS = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("id", pa.int64()), ("part", pa.bool_()), ("value", pa.string())])


def multi_line_splits(spark: SparkSession, paths: Sequence[str], sep: str = SEP) -> tuple[DataFrame, DataFrame]:
    """How the splits of files whose cells may hold line breaks begin: (file, block, begins, before), and (file, path, unclosed).

    One scan gives a row a split: the state after it for either state it may begin in. From these rows follow the state
    and the number of records before each split's first byte. ``paths`` are a listing's; ``file`` is a number for each,
    a hash by a seed that tells them all apart: it costs a line less than a join by its path.
    """
    known = spark.createDataFrame([(p,) for p in paths], "path string")
    for seed in itertools.count():
        named = known.withColumn("file", F.xxhash64(F.lit(seed), "path")).withColumn("seed", F.lit(seed))
        if named.agg(F.count_distinct("file")).first()[0] == len(paths):
            break
    marks = _marked(raw_lines(spark, paths), sep).select(F.xxhash64(F.lit(seed), "path").alias("file"), "block", "mark")
    ends = freeze(map_batches(marks, _split_ends, "file bigint, block bigint, c int, o int, n_closed bigint, n_open bigint"))
    splits = _states(ends, ["file"], "block").withColumnRenamed("if_closed", "begins").drop("if_open")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("begins") == 0, F.col("n_closed")).otherwise(F.col("n_open"))
    splits = freeze(splits.withColumn("before", F.coalesce(F.sum(own).over(earlier), F.lit(0))))
    unclosed = splits.groupBy("file").agg((F.max_by(_after("begins"), "block") == 1).alias("unclosed"))
    return splits.select("file", "block", F.col("begins").cast("tinyint").alias("begins"), "before"), \
        freeze(named.join(unclosed, "file", "left"))


def split_records(spark: SparkSession, splits: DataFrame, files: DataFrame, sep: str = SEP, first: int | None = None) -> DataFrame:
    """(file, block, value, id, part): the records of ``multi_line_splits``' files, their first ``first`` ones if given.

    Lines are joined as a scan reads them; none is sorted, shuffled or written. ``id`` is the record's number and ``block``
    -1. A record that goes on in another split has a row a split, its ``part``s; ``whole_records`` puts those together. Line
    breaks inside a cell become ``\\n``; blank lines between records are skipped, and so are files that end in a cell.
    """
    # all files, so that they are split as they were before
    found = files.select("path", "seed").collect()
    known = splits.join(files.select("file", "unclosed"), "file")
    if first is not None:
        known = known.filter(F.col("before") - F.col("begins") < first)
    lines = raw_lines(spark, sorted(r["path"] for r in found)).withColumn("file", F.xxhash64(F.lit(found[0]["seed"]), "path"))
    # a line of a split that isn't known must not be passed over
    lines = lines.join(F.broadcast(known), ["file", "block"], "left" if first is None else "inner").filter("unclosed is not true")
    joined = map_batches(_marked(lines, sep).select("file", "block", "mark", "begins", "before", "value"), _joined,
                         "file bigint, block bigint, id bigint, part boolean, value string")
    return joined if first is None else joined.filter(F.col("id") < first)


def whole_records(parts: DataFrame, file: str = "path") -> DataFrame:
    """(``file``, block, value, id) of records of which each row is a part, or the whole; ``block`` is -1."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("block", "value"))), lambda x: x["value"])
    return parts.groupBy(file, "id").agg(F.array_join(lines, "\n").alias("value")).select(
        file, F.lit(-1).cast("bigint").alias("block"), "value", "id")


def multi_line_records(spark: SparkSession, paths: Sequence[str], sep: str = SEP) -> tuple[DataFrame, DataFrame]:
    """Records (path, block, value, id) of files whose cells may hold line breaks, written, and (path, unclosed) of the files."""
    listed = spark.read.format("binaryFile").load([glob_escape(p) for p in paths]).select("path")
    splits, files = multi_line_splits(spark, [r["path"] for r in listed.collect()], sep)
    found = freeze(split_records(spark, splits, files, sep))
    whole = found.filter("not part").drop("part").unionByName(whole_records(found.filter("part"), "file"))
    return whole.join(files, "file").select("path", "block", "value", "id"), files.select("path", "unclosed")


def records(spark: SparkSession, plain: Sequence[str]) -> DataFrame:
    """(path, block, value, id) of each record of files whose records are lines."""
    if not plain:
        return spark.createDataFrame([], "path string, block bigint, value string, id bigint")
    return raw_lines(spark, plain).filter(not_blank()).withColumn("id", F.monotonically_increasing_id())


def split_offsets(rows: DataFrame, file: str = "path") -> DataFrame:
    """One row a split of ``rows`` (``file``, block, id): its first id and the number of its file's records before it.

    It is written, so that Spark knows its size before it would shuffle the records for a join with it.
    """
    splits = rows.groupBy(file, "block").agg(F.min("id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(file).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return freeze(splits.select(file, "block", "__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset")))


def with_index(rows: DataFrame, file: str = "path", out: str = "line_index", offsets: DataFrame | None = None) -> DataFrame:
    """Number the records of each file from 0: (``file``, block, id) to ``out``.

    ``id`` grows by one within a split. The splits' counts, one row a split (``split_offsets``), give each split's
    offset in its file. They are joined by split, so that a large file stays dealt over its splits.
    """
    splits = split_offsets(rows, file) if offsets is None else offsets
    return (rows.join(splits, [file, "block"])
                .withColumn(out, F.col("__offset") + F.col("id") - F.col("__first")).drop("__first", "__offset"))


def numbered_records(spark: SparkSession, paths: Sequence[str], sep: str = SEP) -> DataFrame:
    """(path, value, line_index) of all records of the files, whatever their cells hold."""
    flags = survey(spark, paths, sep).groupBy("path").agg((F.sum("n_open") > 0).alias("multi")).collect()
    multi = [r["path"] for r in flags if r["multi"]]
    plain = [r["path"] for r in flags if not r["multi"]]
    found = records(spark, plain)
    if multi:
        found = found.unionByName(multi_line_records(spark, multi, sep)[0])
    return with_index(found).select("path", "value", "line_index")


# --------------------------------------------------------------------------
# one look at every file
# --------------------------------------------------------------------------

def survey(spark: SparkSession, paths: Sequence[str], sep: str = SEP) -> DataFrame:
    """One row a split: its lines' count, digest, first two lines, and how many leave a cell open.

    With the hash h and the place i of each line, the digest holds the sums of h and of i * h: the latter follows
    from the former if the split's place in the file becomes known. Four hashes of 31 bits are summed, modulo a prime of
    31 bits: no product or sum of up to 2^32 lines leaves 64 bits.
    """
    lines = raw_lines(spark, paths).withColumns({f"h{k}": F.xxhash64(F.lit(k), "value") for k in range(LANES // 2)})
    place = F.col("id").bitwiseAND(F.lit(_POSITION))
    sums = []
    for k in range(LANES):
        bits = F.shiftrightunsigned(f"h{k // 2}", 33) if k % 2 else F.col(f"h{k // 2}").bitwiseAND(F.lit(_PRIME))
        h = bits.cast("bigint")
        sums += [(F.sum(h) % _PRIME).alias(f"s{k}"), (F.sum(h * (place % _PRIME) % _PRIME) % _PRIME).alias(f"t{k}")]
    line = F.struct("id", "value")
    # the first two lines: neighbours differ in parity, and the first that names a separator doesn't count twice
    first = [F.min(F.when(not_blank() & cond, line)) for cond in
             (F.col("id") % 2 == 0, F.col("id") % 2 == 1, ~F.col("value").contains("sep="))]
    # the least of texts alone would have Spark sort all lines by split; with a collected list it aggregates by hash
    start = F.collect_list(F.when((place < 2) & not_blank(), line))
    heads = F.slice(F.array_sort(F.array_distinct(F.concat(F.filter(F.array(*first), lambda x: x.isNotNull()), start))), 1, 2)
    opens = F.when(not_blank(), leaves_open(F.col("value"), False, sep)).otherwise(0)
    return lines.groupBy("path", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("first"), heads.alias("heads"), F.sum(opens).alias("n_open"), *sums)


def content_files(splits: DataFrame, listing: DataFrame, sep: str = SEP) -> DataFrame:
    """(path, filename, file_id, header, header_index, multi, broken) of each listed file, from ``survey``'s splits.

    ``file_id`` is a digest of the file's length and of its lines in order, however the file was split; no part
    of the run holds a whole file. ``header_index`` is 1 after a ``sep=`` line, else 0; a file without lines has no header. ``broken``: one of these
    lines leaves a cell open, so that the header goes on in the next.
    """
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # pmod: a split's first place may exceed the number of lines before it
    shift = F.pmod(F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first"), F.lit(_PRIME).cast("bigint"))
    moved = splits.withColumn("__shift", shift)
    sums = []
    for k in range(LANES):
        sums += [(F.sum(f"s{k}") % _PRIME).alias(f"s{k}"),
                 (F.sum((F.col(f"t{k}") + F.col("__shift") * F.col(f"s{k}")) % _PRIME) % _PRIME).alias(f"t{k}")]
    files = moved.groupBy("path").agg(
        F.sum("n").alias("n"), (F.sum("n_open") > 0).alias("multi"),
        F.slice(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "heads"))), lambda x: x["heads"])), 1, 2)
        .alias("heads"), *sums)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    parts = [zero(c) for c in ["length", "n", *[f"{x}{k}" for k in range(LANES) for x in "st"]]]
    first, second = F.get("heads", F.lit(0)).getField("value"), F.get("heads", F.lit(1)).getField("value")
    named = F.coalesce(first.contains("sep="), F.lit(False))
    return listing.join(files, "path", "left").select(
        "path", "filename", F.sha2(F.concat_ws("|", *parts), 256).alias("file_id"),
        F.when(named, second).otherwise(first).alias("header"), named.cast("bigint").alias("header_index"),
        F.coalesce("multi", F.lit(False)).alias("multi"),
        F.coalesce((leaves_open(first, False, sep) == 1) | named & (leaves_open(second, False, sep) == 1), F.lit(False)).alias("broken"))


def token_count(value_col, sep: str = SEP):
    """Number of fields in a record, ignoring separators inside quoted fields."""
    count = lambda text: F.length(text) - F.length(F.replace(text, F.lit(sep), F.lit(""))) + 1
    # a quote is looked for first, and what stands before it then: other characters cost less so
    plain = F.regexp_replace(value_col, f'"(?<!{_not_sep(sep)}"){_QUOTED}"?', "")
    return F.when(value_col.contains(QUOTE), count(plain)).otherwise(count(value_col))


def parse_fields(value_col, width: int, sep: str = SEP):
    """Struct ``_c0.._c{width-1}`` of string fields; empty fields are NULL."""
    schema = ", ".join(f"_c{i} string" for i in range(max(width, 1)))
    opts = dict(CSV_OPTIONS, sep=sep, multiLine="true")
    return F.from_csv(value_col, schema, opts)


def cells(value_col, width: int, sep: str = SEP):
    """The first ``width`` fields as an array."""
    parsed = parse_fields(value_col, width, sep)
    return F.array(*[parsed.getField(f"_c{i}") for i in range(max(width, 1))])


def with_cells(rows: DataFrame, width: int, sep: str = SEP, out: str = "__cells") -> DataFrame:
    """Add the fields of ``value`` as an array; only records with a quote need the CSV parser.

    The parsed record is a column of its own: within a condition each field would parse the record anew. An
    empty field is NULL after the parser and empty otherwise.
    """
    quoted = F.col("value").contains(QUOTE)
    fields = F.array(*[F.col(f"__parsed._c{i}") for i in range(max(width, 1))])
    return (rows.withColumn("__parsed", parse_fields(F.when(quoted, F.col("value")), width, sep))
                .withColumn(out, F.when(quoted, fields).otherwise(F.split("value", re.escape(sep), -1)))
                .drop("__parsed"))
