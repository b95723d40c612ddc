"""The corpus pipeline: raw documents to token ids in five stages.

1. ``quality``: documents that the classifier scores below 0.3 go (op 5).
2. ``lines``: lines found in three documents or more stay in one (op 10);
   a document all of whose lines stay elsewhere is left with an empty text.
3. ``near_duplicates``: one document of each group of near copies stays (op 6).
4. ``decontamination``: passages of benchmark items are cut out of the texts
   (op 2); a document without any other word goes.
5. ``tokens``: what is left is encoded, and checked by decoding (op 8).

Each stage works on the documents its predecessor kept, as it left them, and
writes them to the shared checkpoint folder. All but the last return the
columns of ``documents``. A stage's table is deleted once the next one is written;
the last stage reads the fourth's, which stays for the caller.

Defined results: a null or empty text is scored like any other by ``quality``;
if it stays, it has no lines to lose, copies nothing, holds no passage and has no tokens
(a null stays null up to ``tokens``). Rows that share a doc_id are judged by their own texts
in each stage but ``lines``, where they count as one document. Equal rows
stay or go together up to ``near_duplicates``, which keeps all rows of the
group's smallest id whose texts are in the group. A null doc_id is the smallest. Further columns are carried along,
whatever their names; ``n_chars`` follows the text. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackyard.llm import bpe, decontamination, line_dedup, near_dedup, quality
from trackyard.llm.common import drop_path, read_table, shared_path

QUALITY_THRESHOLD = 0.3
TOKENIZER = "byte_bpe_50k.json"

# a learnt classifier and a tokenizer are beyond SQL: tests/llm hold run() against a brute-force version
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    weights = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_quality(docs, weights, QUALITY_THRESHOLD)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), remove="spans")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.token_lists(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality", keep_quality), ("lines", drop_lines), ("near_duplicates", drop_near_duplicates),
          ("decontamination", cut_benchmark), ("tokens", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is the last stage's."""
    docs, read = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if read:
            drop_path(spark, read)
        read = path
    return STAGES[-1][1](spark, docs, sf_dir)
