"""I-Match document fingerprints, in DataFrame functions alone.

A text's terms are its distinct lower-cased runs of letters and digits. The
lexicon keeps the terms whose inverse document frequency lies in a band: found
in at most ``MOST`` of the documents and in at least as many as make the
lexicon no larger than ``LEXICON`` terms. (The document frequencies sum up to S, so
fewer than S / m terms reach m; with m = S / LEXICON the bound holds for any
data, and as a share of the documents m is alike at every size.) That bound is
why the lexicon may be broadcast.

``SUBSETS`` randomised subsets of the lexicon are drawn by a hash of the term,
at sampling rates of 1, 1/2, 1/4, ...: a text uses the rate that leaves it one
or two terms a subset, in the lexicon or not, and the next. For each subset the text's terms in it
are sorted and hashed. The fingerprint lists these hashes with their subsets, those
without a term left out. It has a list for the lexicon terms, if there are ``FEW``
or more, and one for all terms, so short texts and texts of terms outside the band
have fingerprints as well.

Two fingerprints are compared by their lexicon terms if both list them, by all terms
otherwise, at a rate both have: of the subsets where at
least one has a term, the share f whose hashes agree estimates the terms'
Jaccard similarity; the likeness is 2f / (1 + f), the share of common terms.

``edited_report`` pairs each text with its edited text, which needs the next
document in order of ids. Documents are dealt into id ranges, one window for
each; the first document of a range is also put at the end of the range before.
So each text moves once, and no window holds the whole table.

Defined results: null is the empty text; its fingerprint has no terms, and two
such are alike (1). Rows that share a doc_id follow each other by the hash of
their text. A null doc_id sorts first. A table of one row is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackyard.llm.common import stored

LEXICON = 1_000_000
MOST = 0.1
SUBSETS = 64
FEW = 4
_LONG_MIN = -(1 << 63)


def terms_of(text: Column) -> Column:
    """64-bit hashes of the distinct terms."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text_col: str = "text", size: int = LEXICON, most: float = MOST) -> DataFrame:
    """(term): hashes of the terms within the band; fewer than ``size`` + 1 rows."""
    per_doc = docs.select(F.explode(terms_of(F.coalesce(F.col(text_col), F.lit("")))).alias("term"))
    counts = stored(per_doc.groupBy("term").agg(F.count("term").alias("df")), "document-frequencies")
    total = counts.agg(F.sum("df")).first()[0] or 0
    n = docs.count()
    least = max(2, -(-total // size))
    return counts.filter((F.col("df") >= least) & (F.col("df") <= max(2, int(most * n)))).select("term")


def _rate(terms: Column) -> Column:
    """The text's sampling rate is 2 to the power of minus this."""
    return F.floor(F.log2(F.greatest(F.size(terms) / F.lit(float(SUBSETS)), F.lit(1.0)))).cast("int")


def _mask(rate: Column) -> Column:
    return F.pow(F.lit(2.0), rate).cast("bigint") - 1


def sampled(terms: Column, mask: Column) -> Column:
    """The terms drawn at a rate, given by its mask."""
    return F.filter(terms, lambda t: F.shiftrightunsigned(t, 6).bitwiseAND(mask) == 0)


def _entries(terms: Column, subsets: Column, reverse: Column) -> Column:
    """subset * 4096 + 12 bits of the hash of the sorted terms in it, for each subset that has any.

    ``terms`` are sorted by subset, then by value; ``subsets`` are theirs, in the same order and in ``reverse``.
    """
    def one(k: Column) -> Column:
        begin = F.array_position(subsets, k).cast("int")
        end = F.size(subsets) + 1 - F.array_position(reverse, k).cast("int")
        return (k * 4096 + F.xxhash64(F.slice(terms, begin, end - begin + 1)).bitwiseAND(F.lit(0xFFF))).cast("int")
    return F.transform(F.array_distinct(subsets), one)


def _by_subset(terms: Column) -> Column:
    """Terms sorted by subset, then by value."""
    # the subset's six bits are put before the others, so that one native sort does both
    turned = F.transform(terms, lambda t: F.shiftleft(t, 58).bitwiseOR(F.shiftrightunsigned(t, 6)))
    return F.transform(F.sort_array(turned),
                       lambda t: F.shiftleft(t, 6).bitwiseOR(F.shiftrightunsigned(t, 58)))


def _subset(t: Column) -> Column:
    return t.bitwiseAND(F.lit(SUBSETS - 1))


def prints(df: DataFrame, lists: dict[str, tuple[str, str]]) -> DataFrame:
    """For each (column name: term list column, rate column) a struct (rate, at, next) of entry lists.

    Every step is a column of its own, so that nothing is worked out twice.
    """
    for name, (terms, rate) in lists.items():
        df = df.withColumn(f"__t0_{name}", _by_subset(F.col(terms))).withColumn(f"__m_{name}", _mask(F.col(rate) + 1))
    for name in lists:
        df = df.withColumn(f"__t1_{name}", sampled(F.col(f"__t0_{name}"), F.col(f"__m_{name}")))
    for name in lists:
        for k in (0, 1):
            df = df.withColumn(f"__s{k}_{name}", F.transform(F.col(f"__t{k}_{name}"), _subset))
    for name in lists:
        for k in (0, 1):
            df = df.withColumn(f"__r{k}_{name}", F.reverse(f"__s{k}_{name}"))
    for name, (_, rate) in lists.items():
        df = df.withColumn(name, F.struct(
            F.col(rate).alias("rate"),
            *(_entries(F.col(f"__t{k}_{name}"), F.col(f"__s{k}_{name}"), F.col(f"__r{k}_{name}")).alias(part)
              for k, part in ((0, "at"), (1, "next")))))
    return df


def written(p: Column) -> Column:
    """The fingerprint as text: rate and kind (``l`` with lexicon terms, ``a`` of all terms alone), then the entries and
    those of the next rate, of the lexicon and of all terms, apart by colons; five hex digits an entry."""
    digits = lambda e: F.array_join(F.transform(e, lambda x: F.lower(F.lpad(F.hex(x), 5, "0"))), "")
    kind = F.concat(p["rate"].cast("string"), F.when(p["lexical"], "l").otherwise("a"))
    return F.concat_ws(":", kind, *(digits(p[k]) for k in ("at", "next", "all_at", "all_next")))


def likeness(a: Column, b: Column) -> Column:
    """Of two fingerprints: 1 for equal ones, about the share of common terms otherwise."""
    rate = F.greatest(a["rate"], b["rate"])
    both = a["lexical"] & b["lexical"]
    at = lambda p: F.when(p["rate"] == rate, F.when(both, p["at"]).otherwise(p["all_at"])).when(
        p["rate"] == rate - 1, F.when(both, p["next"]).otherwise(p["all_next"]))
    ea, eb = at(a), at(b)
    subset_ids = lambda e: F.transform(e, lambda x: F.shiftright(x, 12))
    either = F.size(F.array_union(subset_ids(ea), subset_ids(eb)))
    f = F.size(F.array_intersect(ea, eb)) / either
    return F.when(a == b, F.lit(1.0)).when(ea.isNull() | eb.isNull() | (either == 0), F.lit(0.0)) \
            .otherwise(2 * f / (1 + f)).cast("double")


def _with_fingerprints(rows: DataFrame, keys: list[str], texts: dict[str, str], words: DataFrame,
                       carried: list[str]) -> DataFrame:
    """rows' keys and carried columns with a fingerprint (by column name) for each text column: a struct of
    rate, lexical (whether there are lexicon terms enough), and the entries of ``prints`` of both term lists.

    ``keys`` name a row; where rows are already dealt by one of them, nothing moves again.
    """
    listed = rows
    for text in texts.values():
        listed = listed.withColumn(f"__all_{text}", terms_of(F.col(text)))
    for text in texts.values():
        listed = listed.withColumn(f"__rate_{text}", _rate(F.col(f"__all_{text}")))
    for text in texts.values():
        listed = listed.withColumn(f"__mask_{text}", _mask(F.col(f"__rate_{text}")))
    rates = [f"__rate_{t}" for t in texts.values()]

    # what a row carries along stands in one element of its list, the terms' rows stay narrow
    rest = F.struct(*carried, *rates)
    kind = listed.select(rest.alias("rest")).schema["rest"].dataType

    def owned(i: int, t: str) -> Column:
        return F.transform(sampled(F.col(f"__all_{t}"), F.col(f"__mask_{t}")),
                           lambda x: F.struct(F.lit(i).alias("of"), x.alias("term"), F.lit(None).cast(kind).alias("rest")))

    head = F.array(F.struct(F.lit(-1).alias("of"), F.lit(None).cast("bigint").alias("term"), rest.alias("rest")))
    spread = listed.select(*keys, F.explode(F.concat(head, *(owned(i, t) for i, t in enumerate(texts.values())))).alias("x")) \
                   .select(*keys, "x.of", "x.term", "x.rest")
    known = spread.join(F.broadcast(words.withColumn("known", F.lit(True))), "term", "left")
    lists = []
    for i, _ in enumerate(texts):
        own = F.when(F.col("of") == i, F.col("term"))
        lists += [F.collect_list(F.when(F.col("known"), own)).alias(f"__in_{i}"), F.collect_list(own).alias(f"__of_{i}")]
    packed = known.groupBy(*keys).agg(F.first("rest", ignorenulls=True).alias("rest"), *lists).select(
        *keys, "rest.*", *(f"__{k}_{i}" for i, _ in enumerate(texts) for k in ("in", "of")))
    for i, _ in enumerate(texts):
        packed = packed.withColumn(f"__lexical_{i}", F.size(f"__in_{i}") >= FEW).withColumn(
            f"__in_{i}", F.when(F.col(f"__lexical_{i}"), F.col(f"__in_{i}")).otherwise(F.array().cast("array<bigint>")))
    made = prints(packed, {f"__{k}_{name}": (f"__{k}_{i}", f"__rate_{t}")
                           for i, (name, t) in enumerate(texts.items()) for k in ("in", "of")})
    for i, name in enumerate(texts):
        within, every = F.col(f"__in_{name}"), F.col(f"__of_{name}")
        made = made.withColumn(name, F.struct(
            every["rate"].alias("rate"), F.col(f"__lexical_{i}").alias("lexical"), within["at"].alias("at"),
            within["next"].alias("next"), every["at"].alias("all_at"), every["next"].alias("all_next")))
    return made.select(*keys, *carried, *texts)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, fingerprint) of each row."""
    words = lexicon(docs, text_col, **options)
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    made = _with_fingerprints(rows, ["__row"], {"fingerprint": "__text"}, words, ["doc_id"])
    return made.select("doc_id", written(F.col("fingerprint")).alias("fingerprint"))


def _ranges(ids: DataFrame, n: int) -> tuple[list[int], dict[int, int], dict[int, int]]:
    """Upper bounds of id ranges, and for each range that has rows the least id and the number of the one before."""
    shares = [i / n for i in range(1, n)]
    bounds = sorted(set((ids.agg(F.percentile_approx("id", shares).alias("q")).first()["q"] or []) if shares else []))
    firsts = {r[0]: r[1] for r in ids.groupBy(_range_of(F.col("id"), bounds).alias("r")).agg(F.min("id")).collect()}
    order = sorted(firsts)
    return bounds, firsts, {r: order[i - 1] for i, r in enumerate(order)}


def _range_of(i: Column, bounds: list[int]) -> Column:
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < i))


def edited_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None,
                  **options) -> DataFrame:
    """Each text's and its edited text's fingerprint and their likeness, and that to the next document's.

    The edited text has its last quarter replaced by as much from the beginning of the next document.
    """
    spark = docs.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LONG_MIN)).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = lexicon(docs, text_col, **options)
    bounds, firsts, before = _ranges(base.select("id"), n)
    if not firsts:
        firsts, before = {0: 0}, {0: 0}
    least = min(firsts)
    # one row for each range
    heads = spark.createDataFrame([(firsts[r], before[r], int(r == least)) for r in sorted(firsts)],
                                  "id bigint, prior int, wrap int")
    placed = base.join(F.broadcast(heads), "id", "left").withColumn("own", _range_of(F.col("id"), bounds))
    own = F.struct(F.col("own").alias("part"), F.lit(0).alias("wrap"), F.lit(False).alias("ghost"))
    ghost = F.struct(F.col("prior").alias("part"), F.col("wrap"), F.lit(True).alias("ghost"))
    dealt = placed.select("id", "text", F.explode(F.filter(F.array(own, ghost), lambda x: x["part"].isNotNull()))
                          .alias("x")).select("id", "text", "x.part", "x.wrap", "x.ghost")
    inside = Window.partitionBy("part").orderBy("wrap", "id", F.xxhash64("text"), "ghost")
    length = F.char_length("text")
    quarter = F.floor(length / 4).cast("int")
    paired = (dealt.repartitionByRange(n, "part")
                   .withColumn("next_text", F.coalesce(F.lead("text").over(inside), F.lit("")))
                   .withColumn("row", F.row_number().over(inside))
                   .withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), length - quarter),
                                                  F.substring(F.col("next_text"), F.lit(1), quarter)))
                   .withColumn("n_chars", length.cast("bigint"))
                   .withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)))
    marked = _with_fingerprints(paired, ["part", "row"], {"fingerprint": "text", "edited_fingerprint": "edited"}, words,
                                ["ghost", "id", "n_chars", "edited_sha256"])
    following = Window.partitionBy("part").orderBy("row")
    compared = marked.withColumn("next", F.lead("fingerprint").over(following)).filter(~F.col("ghost"))
    return compared.select(
        F.when(F.col("id") != _LONG_MIN, F.col("id")).alias("doc_id"), "n_chars", "edited_sha256",
        written(F.col("fingerprint")).alias("fingerprint"),
        written(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next")).alias("near_next"))
