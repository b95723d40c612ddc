"""Token-id files: frequency-ranked ids in byte-aligned variable-length code, control bytes apart.

1. Every text is encoded once with the tokenizers library and staged (ids of
   two or four bytes, zstd).
2. The ids of all documents are counted; the most frequent id gets rank 0. The
   counts are as many as the vocabulary has entries, the only thing collected.
3. The staged rows are range-partitioned by doc_id and sorted; each task codes
   runs of documents of about ``FILE_TOKENS`` ids into a file: a control byte
   holds the byte lengths (1 to 4) of four ranks, the data bytes follow apart.
4. A task writes a file under a name of its own attempt and returns it in its
   result rows. Those rows, written by Spark's own commit, are the manifest;
   files of lost or repeated attempts are in no manifest and never read.
5. Reading back, numpy tables turn a control byte into its four lengths, all
   positions come from one running sum, and ranks become ids again.

Encoding with the library costs far more per text than per character, so texts
are cut at ASCII white space and the library encodes each distinct piece once
per worker (what it remembers is bounded). No part of the tokenizer looks
across white space: its pattern drops it, and its special tokens hold none.

Defined results: null is the empty text; every document ends with ``END``. A
null doc_id sorts first and stays null. Rows that share a doc_id are ordered by
their length and a hash of their ids. An empty table gives no files and no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackyard.llm.bpe import byte_letters
from trackyard.llm.common import drop_path, map_batches, shared_path, utf8

END = 1
FILE_TOKENS = 16_000_000
PIECES_KEPT = 800_000
_MAGIC = b"TYTK"
_HEAD = struct.Struct("<4sIQQQ")  # magic, version, documents, ids, control bytes of the ids
_CLOSING, _ALNUM = b".,;:!?", b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
# letters that normalisation leaves as they are but for their case
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_WRITTEN = {b: c for c, b in byte_letters().items()}


# ---- variable-length code ---------------------------------------------------

def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, "<u4")
    extra = (v > 0xFF).astype(np.uint8)
    extra += v > 0xFFFF
    extra += v > 0xFFFFFF
    padded = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    padded[:len(v)] = extra
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4, dtype=np.uint8)[None, :] <= extra[:, None]
    return control.tobytes(), v.view(np.uint8).reshape(-1, 4)[used].tobytes()


_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def unpack(control: bytes | np.ndarray, data: bytes | np.ndarray, count: int) -> np.ndarray:
    """The values again: lengths by table, places by running sum."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    ends = np.cumsum(lengths, dtype=np.int64)
    starts = ends - lengths
    raw = np.frombuffer(data, np.uint8)
    out = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        if not len(longer):
            break
        out[longer] |= raw[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def file_bytes(doc_ids: list[int | None], counts: np.ndarray, ranks: np.ndarray) -> bytes:
    known = np.array([d is not None for d in doc_ids], np.uint8)
    ids = np.array([d or 0 for d in doc_ids], "<i8")
    count_control, count_data = pack(counts)
    control, data = pack(ranks)
    return b"".join((_HEAD.pack(_MAGIC, 1, len(doc_ids), len(ranks), len(control)), ids.tobytes(), known.tobytes(),
                     count_control, struct.pack("<Q", len(count_data)), count_data, control, data))


def parse_file(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc ids, ids of each, all ranks)."""
    magic, version, n_docs, n_ids, n_control = _HEAD.unpack_from(raw)
    if magic != _MAGIC or version != 1:
        raise ValueError("not a token file")
    at = _HEAD.size
    ids = np.frombuffer(raw, "<i8", n_docs, at)
    at += 8 * n_docs
    known = np.frombuffer(raw, np.uint8, n_docs, at)
    at += n_docs
    groups = -(-n_docs // 4)
    (size,) = struct.unpack_from("<Q", raw, at + groups)
    view = memoryview(raw)
    counts = unpack(view[at:at + groups], view[at + groups + 8:at + groups + 8 + size], n_docs)
    at += groups + 8 + size
    ranks = unpack(view[at:at + n_control], view[at + n_control:], n_ids)
    return [i if k else None for i, k in zip(ids.tolist(), known.tolist(), strict=True)], counts, ranks


# ---- encoding with the library ------------------------------------------------

class PieceEncoder(dict):
    """white-space separated piece -> its ids' bytes, each distinct piece encoded once by the library.

    When half of ``PIECES_KEPT`` are held they become the old half; old pieces that are met again move over.
    """

    def __init__(self, spec: str, width: int, keep: int = PIECES_KEPT):
        super().__init__()
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.tokenize, self.code = self.library.model.tokenize, "H" if width == 2 else "I"
        self.keep, self.old = keep, {}

    def _ids(self, core: bytes) -> bytes:
        word = core.decode("utf-8", "replace")
        if _LETTERS.fullmatch(word):  # one word for the model, once lower-cased and written byte by byte
            written = word.lower().encode().decode("latin-1").translate(_WRITTEN)
            return array(self.code, [t.id for t in self.tokenize(written)]).tobytes()
        return array(self.code, self.library.encode(word, add_special_tokens=False).ids).tobytes()

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            # the pattern cuts between a letter or digit and closing punctuation; special tokens go whole
            core = piece.rstrip(_CLOSING)
            if len(core) < len(piece) and core and core[-1] in _ALNUM and b"<|" not in piece:
                ids = self[core] + self[piece[len(core):]]
            else:
                ids = self._ids(piece)
        self[piece] = ids
        return ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self) > self.keep // 2:
            self.old = dict(self)
            self.clear()
        # A-Z lower-cased at once, as the tokenizer does first; its special tokens are told apart by case
        return [b"".join(map(self.__getitem__, (t if b"<|" in t else t.lower()).split())) for t in texts]


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(spec: str, width: int) -> PieceEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PieceEncoder(spec, width)
    return _ENCODERS[key]


# FIXED VALUES: what the quick ways above rely on, as the tokenizer's file states it
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _check_tokenizer(spec: str) -> tuple[int, int]:
    """(bytes of an id, number of ids); refuses a file that cuts or normalises otherwise than ``PieceEncoder`` does."""
    d = json.loads(spec)
    normalizer, cut, model = d["normalizer"] or {}, d["pre_tokenizer"] or {}, d["model"]
    steps = cut.get("pretokenizers", [])
    if (normalizer.get("normalizers") != _NORMALIZERS or [s.get("type") for s in steps] != ["Split", "ByteLevel"]
            or steps[0]["pattern"] != {"Regex": _PATTERN} or steps[0]["behavior"] != "Removed" or not steps[0]["invert"]
            or steps[1]["add_prefix_space"] or model["type"] != "BPE" or model["dropout"]
            or any(t["normalized"] or not t["content"].startswith("<|") or set(t["content"]) & set(" \t\n\r")
                   for t in d["added_tokens"])):
        raise ValueError("a lower-casing byte-level BPE file that drops white space is asked for")
    size = 1 + max([*model["vocab"].values(), *(t["id"] for t in d["added_tokens"])])
    return (2 if size <= 0xFFFF else 4), size


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _stage(docs: DataFrame, spec, width: int, end: int, id_col: str, text_col: str, path: str) -> None:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last = _encoder(spec.value, width), np.array([end], f"<u{width}").tobytes()
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                ids = [i + last for i in encoder.encode([t.as_py() for t in batch.column(1)])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(i) // width for i in ids], pa.int64()),
                     pa.array([squeeze(i) for i in ids], pa.binary())], names=["doc_id", "n", "ids"])

    map_batches(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(text_col).alias("text")), run,
                "doc_id bigint, n bigint, ids binary").write.option("compression", "none").parquet(path)


def _ranks(staged: DataFrame, width: int, size: int) -> np.ndarray:
    """rank -> id, the most frequent id first, ties by id."""
    def count(batches):
        total, open_ = np.zeros(size, np.int64), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                ids = b"".join([open_(x.as_py()) for x in batch.column(0).slice(at, 1024)])
                total += np.bincount(np.frombuffer(ids, f"<u{width}"), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total[at])], names=["id", "n"])

    counts = map_batches(staged.select("ids"), count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    frame = counts.toPandas()  # at most one row for each entry of the vocabulary
    total = np.zeros(size, np.int64)
    total[frame["id"].to_numpy(np.int64)] = frame["n"].to_numpy(np.int64)
    return np.lexsort((np.arange(size), -total)).astype(np.uint32)


MANIFEST = "part int, block int, file string, first bigint, n_docs bigint, n_tokens bigint"


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end: int = END, id_col: str = "doc_id",
                      text_col: str = "text", file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the documents' ids, ``end`` after each, under ``path``: token files, ``manifest`` and ``codebook``.

    Returns the manifest; its rows in order of (part, block) are the files in order of doc_id.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        text = f.read()
    width, size = _check_tokenizer(text)
    size = max(size, end + 1)
    spec = spark.sparkContext.broadcast(text)
    stage = shared_path(spark, "token-stage")
    _stage(docs, spec, width, end, id_col, text_col, stage)
    staged = spark.read.schema("doc_id bigint, n bigint, ids binary").parquet(stage)
    by_rank = _ranks(staged, width, size)
    spark.createDataFrame([(r, int(i)) for r, i in enumerate(by_rank.tolist())], "rank int, id int").coalesce(1) \
        .write.parquet(f"{path}/codebook")
    rank_of = np.zeros(size, np.uint32)
    rank_of[by_rank] = np.arange(size, dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _filesystem(path)
        ranks, open_ = shared.value, zstandard.ZstdDecompressor().decompress
        context = TaskContext.get()
        part, attempt = context.partitionId(), uuid.uuid4().hex[:12]
        fs.create_dir(f"{folder}/files", recursive=True)
        doc_ids, counts, coded, held, block = [], [], [], 0, 0

        def flush():
            name = f"tokens-{part:06d}-{block:06d}-{attempt}.bin"
            with fs.open_output_stream(f"{folder}/files/{name}") as out:
                out.write(file_bytes(doc_ids, np.array(counts), ranks[np.frombuffer(b"".join(coded), f"<u{width}")]))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([name], pa.string()),
                 pa.array([doc_ids[0]], pa.int64()), pa.array([len(doc_ids)], pa.int64()),
                 pa.array([held], pa.int64())], names=["part", "block", "file", "first", "n_docs", "n_tokens"])

        for batch in batches:
            for doc_id, n, ids in zip(*batch.columns, strict=True):
                n = n.as_py()
                if doc_ids and held + n > file_tokens:
                    yield flush()
                    doc_ids, counts, coded, held, block = [], [], [], 0, block + 1
                doc_ids.append(doc_id.as_py())
                counts.append(n)
                coded.append(open_(ids.as_py()))
                held += n
        if doc_ids:
            yield flush()

    # rows of one id, equal ones too, may be many: they are dealt over ranges as well
    order = ["doc_id", "n", "tag", "place"]
    ordered = staged.withColumns({"tag": F.xxhash64("ids"), "place": F.monotonically_increasing_id()}) \
                    .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "n", "ids")
    map_batches(ordered, code, MANIFEST).write.parquet(f"{path}/manifest")
    drop_path(spark, stage)
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files named in the manifest."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    codebook = spark.read.schema("rank int, id int").parquet(f"{path}/codebook").toPandas()
    ids = np.zeros(len(codebook), "<u4")
    ids[codebook["rank"].to_numpy()] = codebook["id"].to_numpy()
    shared = spark.sparkContext.broadcast(ids)
    # one number for each range partition; within it a window over its few files
    before, offsets = 0, []
    for part, total in sorted(manifest.groupBy("part").agg(F.sum("n_tokens")).collect()):
        offsets.append((part, before))
        before += total
    starts = spark.createDataFrame(offsets, "part int, before bigint")
    earlier = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.join(F.broadcast(starts), "part").select(
        "file", (F.col("before") + F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))).alias("start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _filesystem(path)
        by_rank = shared.value
        for batch in batches:
            for name, start in zip(*batch.columns, strict=True):
                with fs.open_input_file(f"{folder}/files/{name.as_py()}") as f:
                    doc_ids, counts, ranks = parse_file(f.read())
                own = memoryview(by_rank[ranks].tobytes())
                ends = np.cumsum(counts, dtype=np.int64)
                begins = ends - counts
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(begins + start.as_py()),
                     pa.array(counts.astype(np.int64)),
                     pa.array([zlib.crc32(own[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)],
                              pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # a task a file: their bytes are bounded, their number isn't
    spread = placed.repartition(max(1, manifest.count()))
    return map_batches(spread, read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
