"""The driver queries of the training-data operators, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackyard.llm import bpe, decontamination, hard_negatives, imatch, line_dedup, near_dedup, paragraph_dedup, pii, quality, \
    resampling, simhash, token_files, toxicity
from trackyard.llm.common import read_table, shared_path


def op1_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.repeat_report(read_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination_report(read_table(spark, sf_dir, "documents"),
                                                read_table(spark, sf_dir, "benchmark"))


OP2_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
bl AS (SELECT item_id, words, least(10, len(words)) AS size FROM b WHERE len(words) > 0),
bp AS (SELECT item_id, words, size, unnest(range(1, len(words) - size + 2)) AS k FROM bl),
bw AS (SELECT DISTINCT item_id, size, array_to_string(words[k : k + size - 1], ' ') AS gram FROM bp),
sizes AS (SELECT DISTINCT size FROM bl),
dp AS (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS k FROM w, sizes WHERE len(words) >= size),
dw AS (SELECT doc_id, size, k, array_to_string(words[k : k + size - 1], ' ') AS gram FROM dp),
hit AS (SELECT doc_id, item_id, dw.size, k FROM dw JOIN bw ON dw.size = bw.size AND dw.gram = bw.gram),
pos AS (SELECT DISTINCT doc_id, unnest(range(k, k + size)) AS p FROM hit),
nh AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(len(words), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN nh USING (doc_id) LEFT JOIN it USING (doc_id)
"""


SURROGATE_KEY = b"a deployment sets its own secret"


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(read_table(spark, sf_dir, "documents"), SURROGATE_KEY)


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), path)
    return token_files.read_token_files(spark, path)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(read_table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
p AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos FROM s),
l AS (SELECT doc_id, pos, lines[pos] AS line,
             translate(trim(lines[pos], chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM p),
f AS (SELECT key, max(doc_id) AS owner FROM l WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT l.doc_id, pos, line, coalesce(owner > l.doc_id, false) AS gone FROM l LEFT JOIN f ON l.key = f.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_report(read_table(spark, sf_dir, "documents"))


TOXICITY_THRESHOLD = 0.5


def op4_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    field = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, field).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= TOXICITY_THRESHOLD).cast("int").alias("predicted"), "spans")


QUALITY_THRESHOLD = 0.3


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    weights = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, weights).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicate_report(read_table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
p AS (SELECT doc_id, words, least(5, len(words)) AS size, unnest(range(1, len(words) - least(5, len(words)) + 2)) AS k
      FROM w WHERE len(words) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(words[k : k + size - 1], ' ') AS gram FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id
      GROUP BY ALL),
e AS (SELECT a, b FROM i JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * common >= 75 * (na.n + nb.n - common)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS seen FROM w UNION SELECT r.doc_id, x.b FROM r JOIN both_ways x ON x.a = r.seen)
SELECT r.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(seen) AS component_id,
       min(seen) = r.doc_id AS kept
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=label)


OP11_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
             CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
     AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH rule AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM documents),
b AS (SELECT regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
df AS (SELECT row, unnest(words || list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1])) AS f FROM d),
bf AS (SELECT unnest(words || list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1])) AS f FROM b),
df1 AS (SELECT row, f, count(*) AS n FROM df GROUP BY ALL),
bf1 AS (SELECT f, count(*) AS n FROM bf GROUP BY ALL),
h AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM df1 UNION SELECT f FROM bf1)),
y AS (SELECT f, list_transform(range(1, len(x), 2), lambda k: (instr('0123456789ABCDEF', substr(x, k, 1)) - 1) * 16
                                                    + instr('0123456789ABCDEF', substr(x, k + 1, 1)) - 1) AS bytes FROM h),
c AS (SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
             lambda a, x: xor(a >> 8, tab[xor(a & 255, x) + 1]))) % 10000 AS bucket FROM y, rule),
s AS (SELECT bucket, sum(n) AS n FROM df1 JOIN c USING (f) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM bf1 JOIN c USING (f) GROUP BY bucket),
a AS (SELECT CAST((SELECT coalesce(sum(n), 0) FROM s) AS DOUBLE) AS s_all, CAST((SELECT coalesce(sum(n), 0) FROM t) AS DOUBLE) AS t_all),
g AS (SELECT s.bucket, CAST(floor(1000 * ln(((CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * (s_all + 10000))
                                         / ((CAST(s.n AS DOUBLE) + 1) * (t_all + 10000)))) AS BIGINT) AS gain
      FROM s LEFT JOIN t USING (bucket), a),
w AS (SELECT row, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / sum(n)) AS BIGINT) AS weight
      FROM df1 JOIN c USING (f) JOIN g USING (bucket) GROUP BY row),
z AS (SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             list_reduce(list_prepend(0, list_transform(range(1, 9), lambda k:
                 instr('0123456789abcdef', substr(sha256('7:' || CAST(doc_id AS VARCHAR)), k, 1)) - 1)),
                 lambda a, x: a * 16 + x) AS h
      FROM d LEFT JOIN w USING (row)),
r AS (SELECT doc_id, n_words, n_features, weight,
             weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM z),
o AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place FROM r)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= 20 AND place <= (SELECT 25 * count(*) // 100 FROM r WHERE n_words >= 20) THEN place END AS rank
FROM o
"""


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_report(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_paragraph_dedup": (op1_paragraph_dedup, None),
    "op2_decontamination": (op2_decontamination, OP2_SQL),
    "op3_imatch": (op3_imatch, None),
    "op4_toxicity_crf": (op4_toxicity_crf, None),
    "op5_quality_classifier": (op5_quality_classifier, None),
    "op6_minhash_near_dedup": (op6_minhash_near_dedup, OP6_SQL),
    "op7_pii_surrogates": (op7_pii_surrogates, None),
    "op8_bpe_trie": (op8_bpe_trie, None),
    "op9_token_files": (op9_token_files, None),
    "op10_line_dedup": (op10_line_dedup, OP10_SQL),
    "op11_hard_negatives": (op11_hard_negatives, OP11_SQL),
    "op12_importance_resampling": (op12_importance_resampling, OP12_SQL),
    "op13_simhash": (op13_simhash, None),
}
