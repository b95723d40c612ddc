"""Repeated passages: paragraph MinHash banding, confirmed, clustered, followed to their ends, cut out.

A passage may be pasted anywhere in a text, so paragraphs are cut by content:
a paragraph begins at each word whose word-pair hash is the least within
``REACH`` words on either side. Two texts that share a passage cut it alike,
but for its first and last few words. Paragraphs have ``2 * REACH + 1`` words on
average and ``REACH + 1`` at least: a passage of 50 words holds several whole ones, and
an edited one still some that no edit has touched.

1. Every paragraph's set of 5-word shingles gives ``BANDS`` universal hash
   minima, each a band of its own: two paragraphs of similarity s collide with
   probability 1 - (1 - s)^3 in one, 0.984 at 0.75 and 0.999 at 0.9. A text's bands are
   hashed once and written as arrays, one row a text.
2. The bands' hashes are counted; paragraphs of whose hashes other texts have ``AT_LEAST``
   go on, the others are done: equal paragraphs always, at similarity 0.9 97 %, and few that
   have only a common phrase in common.
3. Only texts with such paragraphs are read again. Their words around the paragraphs
   (``CONTEXT`` on either side) are written as segments. Paragraphs form classes of
   equal word sequences, and near-equal classes are linked by exact Jaccard
   similarity and put together by components (``near_dedup.class_components``:
   stars, then whole buckets in blocks; no centre or cap costs a link).
4. Each paragraph is compared, word by word, with its component's one in the smallest document,
   from the paragraph outwards and across edits of up to ``EDIT`` words, as far as the
   two sides stay similar (0.75 of their shingles). So a passage is found up to its true ends, edited or not.
5. In a component that spans documents, the smallest keeps its words; elsewhere they are removed, if the run of
   neighbouring repeated words they belong to has ``MIN_WORDS`` words or more.

Paragraphs of fewer than ``SHINGLE`` words, at the ends of texts, are found as what lies around others.
Repeats within one document are left alone.

Defined results: null and empty texts have no paragraphs. Rows that share a
doc_id count as one document; each row is cut by its own text. A null doc_id
is the smallest id. Columns beyond id and text are carried by
``remove_repeats`` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackyard.llm.common import Scratch, arrow_column, map_batches, stored, utf8
from trackyard.llm.near_dedup import SHINGLE, SIMILARITY, _A, _B, _LONG_MIN, _P, _mixed, _tag, class_components, \
    normalised_words

REACH = 4
BANDS = 3
AT_LEAST = 2  # bands of a paragraph that some other text has too
MIN_WORDS = 20
CONTEXT = 64  # words on either side of a paragraph in which its passage is followed; the next paragraph goes on from there
EDIT = 3      # words that an edit may replace, insert or drop
AGREE = 3     # equal words after an edit that make it one


def paragraph_starts(w: np.ndarray, begins: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Word numbers where paragraphs begin; a text's first word, ``begins``, is one. The texts' words follow each other."""
    n = len(w)
    if n == 0:
        return np.zeros(0, np.int64)
    ends = np.append(begins[1:], n)
    after = np.append(w[1:], np.uint64(0))
    after[ends - 1] = 0
    v = _mixed(w * _P + after)
    least = np.ones(n, bool)
    for k in range(1, reach + 1):
        less = v[k:] < v[:-k]
        least[k:] &= less
        least[:-k] &= ~less
    for k in range(reach):  # so words of two texts are never compared in earnest
        least[np.minimum(begins + k, ends - 1)] = False
        least[np.maximum(ends - 1 - k, begins)] = False
    least[begins] = True
    return np.flatnonzero(least)


class Paragraphs:
    """Some whole paragraphs of a run of words: places, sizes, shingle hashes."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """``words``: hashes."""
        self.words, self.starts, self.sizes = words, starts, sizes
        n = len(words)
        shingles = np.zeros(n, np.uint64)
        if n >= SHINGLE:
            acc = words[:n - SHINGLE + 1] * _P
            for j in range(1, SHINGLE - 1):
                acc = (acc + words[j:n - SHINGLE + 1 + j]) * _P
            shingles[:n - SHINGLE + 1] = _mixed(acc + words[SHINGLE - 1:])
        self.amount = sizes - SHINGLE + 1
        # those inside a paragraph, one paragraph after the other
        self.shingles = shingles[_ranges(starts, self.amount)]

    def minima(self) -> np.ndarray:
        """paragraphs x BANDS hashes; the band's number is part of them."""
        if not len(self.starts):
            return np.zeros((0, BANDS), np.int64)
        at = np.cumsum(self.amount) - self.amount
        return np.stack([_mixed((np.minimum.reduceat(_A[band] * self.shingles + _B[band], at) ^ np.uint64(band + 1)) * _P)
                         for band in range(BANDS)], axis=1).view(np.int64)

    def keys(self) -> list[bytes]:
        raw, begins = memoryview(self.words).cast("B"), self.starts * 8
        return [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(begins.tolist(), (begins + self.sizes * 8).tolist(), strict=True)]

    def sets(self) -> tuple[np.ndarray, np.ndarray]:
        """The sorted distinct shingles, one paragraph after the other, and each one's number of them."""
        owner = np.repeat(np.arange(len(self.starts)), self.amount)
        shingles = self.shingles[np.lexsort((self.shingles, owner))]  # the owners are in order already
        new = np.ones(len(shingles), bool)
        new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
        return shingles[new], np.bincount(owner[new], minlength=len(self.starts))


def _hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each range, one range after the other."""
    return np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


_GROUP_BYTES = 256 << 10  # of texts taken together: their arrays fit the processor's cache


def _word_places(raw: bytes) -> np.ndarray:
    """Byte offsets (begin, end) of the white-space separated words."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = (data - np.uint8(9) > 4) & (data != 32)  # \t \n \x0b \x0c \r follow each other
    return np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)


def _groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, last) rows of neighbouring texts of ``_GROUP_BYTES`` together, or one longer text."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        last = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _GROUP_BYTES, "right")))
        yield at, last
        at = last


def _listed(values: pa.Array, amounts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(amounts)).astype(np.int32)), values)


def _binaries(data: np.ndarray, amounts: np.ndarray) -> pa.Array:
    """Binary values of some elements of ``data`` each, one after the other."""
    ends = np.append(0, np.cumsum(amounts) * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(amounts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places (first, last) of a text's whole paragraphs, and ``BANDS`` hashes of each one after the other."""
    for whole in batches:
        for at, last in _groups(whole.column(2)):
            batch = whole.slice(at, last - at)
            words: list[bytes] = []
            counts = np.zeros(batch.num_rows, np.int64)
            for k, text in enumerate(batch.column(2).to_pylist()):
                own = normalised_words(text)
                counts[k] = len(own)
                words += own
            hashes, begins = _hashed(words), np.cumsum(counts) - counts
            starts = paragraph_starts(hashes, begins[counts > 0])
            sizes = np.diff(np.append(starts, len(words)))
            starts, sizes = starts[sizes >= SHINGLE], sizes[sizes >= SHINGLE]
            row = np.searchsorted(begins, starts, "right") - 1
            amounts = np.bincount(row, minlength=batch.num_rows)
            first = starts - begins[row]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 _listed(pa.array(np.stack([first, first + sizes], axis=1).reshape(-1).astype(np.int32)), 2 * amounts),
                 _listed(pa.array(Paragraphs(hashes, starts, sizes).minima().reshape(-1)), BANDS * amounts)],
                names=["doc", "tag", "paras", "bands"])


SEGMENT = ("doc bigint, tag bigint, seg int, begin int, words binary, places binary, "
           "paras array<struct<first: int, last: int, key: binary, set: binary, bands: array<bigint>>>")


def _packed(steps: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Of each segment a byte that tells the numbers' width, the gaps before its words, and the words' lengths."""
    width = 1 if steps.max(initial=0) < 256 else 4
    at = np.arange(len(steps)) + np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.empty(2 * len(steps), np.uint8 if width == 1 else np.uint32)
    out[at], out[at + np.repeat(sizes, sizes)] = steps[:, 0], steps[:, 1]
    raw, ends = memoryview(out).cast("B"), (2 * width * np.cumsum(sizes)).tolist()
    return pa.array([bytes([width]) + raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], pa.binary())


def _unpacked(begin: int, places: bytes) -> np.ndarray:
    """The words' places (begin, end) in the text."""
    steps = np.frombuffer(places, np.uint8 if places[0] == 1 else np.uint32, offset=1)
    return begin + np.cumsum(steps.reshape(2, -1).T, dtype=np.int64).reshape(-1, 2)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of words around the given paragraphs: the byte where they begin, 32-bit word hashes, the words' places
    (``_packed``), and the paragraphs in them."""
    for whole in batches:
        for at, last in _groups(whole.column(2)):
            batch = whole.slice(at, last - at)
            which = batch.column(3).flatten()
            if not len(which):
                continue
            texts = batch.column(2).to_pylist()
            raw = b" ".join(texts)
            place, words = _word_places(raw), normalised_words(raw)
            ends = np.cumsum([len(text) + 1 for text in texts])
            counts = np.diff(np.searchsorted(place[:, 0], ends), prepend=0)
            row = np.repeat(np.arange(len(texts)), pc.list_value_length(batch.column(3)).to_numpy(zero_copy_only=False))
            a, b = (which.field(c).to_numpy().astype(np.int64) for c in ("first", "last"))
            order = np.lexsort((a, row))
            row, a, b = row[order], a[order], b[order]
            size = counts[row]
            new = np.ones(len(a), bool)  # a segment of its own
            new[1:] = (row[1:] != row[:-1]) | (a[1:] - CONTEXT > np.minimum(size, b + CONTEXT)[:-1])
            first = np.flatnonzero(new)
            final = np.append(first[1:], len(a)) - 1
            owner = row[first]
            lo, hi = np.maximum(0, a[first] - CONTEXT), np.minimum(size[first], b[final] + CONTEXT)
            sizes, begin = hi - lo, (np.cumsum(counts) - counts)[owner] + lo
            heads = np.cumsum(sizes) - sizes
            steps = np.diff(place.reshape(-1), prepend=0).reshape(-1, 2)[_ranges(begin, sizes)]
            steps[heads, 0] = 0
            hashes = _hashed([w for x, y in zip(begin.tolist(), (begin + sizes).tolist(), strict=True) for w in words[x:y]])
            p = Paragraphs(hashes, np.repeat(heads - lo, final - first + 1) + a, b - a)
            sets, n_set = p.sets()
            paras = pa.StructArray.from_arrays(
                [pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(p.keys(), pa.binary()),
                 _binaries(sets, n_set), _listed(pa.array(p.minima().reshape(-1)), np.full(len(a), BANDS))],
                names=["first", "last", "key", "set", "bands"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), batch.column(1).take(pa.array(owner)), pa.array(lo.astype(np.int32)),
                 pa.array((place[begin, 0] - np.append(0, ends)[owner]).astype(np.int32)),
                 _binaries(hashes.astype(np.uint32), sizes), _packed(steps, sizes), _listed(paras, final - first + 1)],
                names=["doc", "tag", "seg", "begin", "words", "places", "paras"])


_EDITS = sorted(((d, e) for d in range(EDIT + 1) for e in range(EDIT + 1) if d or e), key=lambda x: (x[0] + x[1], abs(x[0] - x[1])))


def follow(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """Where two word sequences that go on from an equal passage agree: (words of a, words of b, common shingles)
    at the end of each run of equal words, from nothing to as far as edits can be bridged."""
    i = j = common = 0
    run, ends = SHINGLE - 1, [(0, 0, 0)]
    while True:
        n = 0
        for x, y in zip(a[i:], b[j:], strict=False):
            if x != y:
                break
            n += 1
        if n:
            common += max(0, run + n - SHINGLE + 1) - max(0, run - SHINGLE + 1)
            i, j = i + n, j + n
            ends.append((i, j, common))
        for d, e in _EDITS:
            x, y = i + d, j + e
            if x + AGREE <= len(a) and y + AGREE <= len(b) and a[x] == b[y] and a[x:x + AGREE] == b[y:y + AGREE]:
                i, j, run = x, y, 0
                break
        else:
            return ends


def matched(own: list[int], first: int, last: int, its: list[int], its_first: int, its_last: int,
            similarity: int) -> tuple[int, int, int, int]:
    """The longest stretches around two similar paragraphs whose shingles stay so similar: (first, last) of either.

    They begin with the longest run of words that the paragraphs have in common.
    """
    if own[first:last] != its[its_first:its_last]:
        core = SequenceMatcher(None, own[first:last], its[its_first:its_last], False).find_longest_match()
        first, its_first = first + core.a, its_first + core.b
        last, its_last = first + core.size, its_first + core.size
    here = there = last - first
    common = max(0, here - SHINGLE + 1)
    out = [first, last, its_first, its_last]

    def far(ends: list[tuple[int, int, int]]) -> tuple[int, int, int]:
        best = ends[0]
        for i, j, n in ends:
            both = common + n
            if 100 * both >= similarity * (here + i + there + j - 2 * (SHINGLE - 1) - both):
                best = i, j, n
        return best

    for side in (1, 0):
        a, b = (own[last:], its[its_last:]) if side else (own[:first][::-1], its[:its_first][::-1])
        i, j, n = far(follow(a, b))
        here, there, common = here + i, there + j, common + n
        out[side] += i if side else -i
        out[2 + side] += j if side else -j
    return tuple(out)


MARK = "doc bigint, tag bigint, seg int, first int, last int, component bigint"


def _stretch(own: list[int], its: list[int], at: tuple[int, int, int, int], similarity: int) -> tuple[int, int, int, int]:
    """``matched`` within ``CONTEXT`` words of two paragraphs."""
    low, its_low = max(0, at[0] - CONTEXT), max(0, at[2] - CONTEXT)
    a, b, c, d = matched(own[low:at[1] + CONTEXT], at[0] - low, at[1] - low, its[its_low:at[3] + CONTEXT], at[2] - its_low,
                         at[3] - its_low, similarity)
    return a + low, b + low, c + its_low, d + its_low


def _within(at: tuple[int, int, int, int], stretches: list[tuple[int, int, int, int]]) -> bool:
    return any(a <= at[0] and at[1] <= b and c <= at[2] and at[3] <= d for a, b, c, d in stretches)


def _stretches(own: list[int], its: list[int], paras: list[tuple[int, int, int, int]], similarity: int) -> list[tuple[int, ...]]:
    """The stretches around pairs of paragraphs (first and last of either), in order."""
    seen: list[tuple[int, int, int, int]] = []
    inside = None  # the last paragraph within a stretch that is matched already: it may reach further
    for here in paras:
        within = _within(here, seen[-4:])
        if inside and not within:
            seen.append(_stretch(own, its, inside, similarity))
            inside, within = None, _within(here, seen[-4:])
        if within:
            inside = here
        else:
            seen.append(_stretch(own, its, here, similarity))
    if inside:
        seen.append(_stretch(own, its, inside, similarity))
    return seen


def _marked(similarity: int):
    """Marks of each segment's paragraphs, and of the stretches of the smallest documents that they were compared with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            partners = batch.column(4).flatten()
            amounts = pc.list_value_length(batch.column(4)).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), amounts)
            doc, tag, seg = (batch.column(k).to_numpy() for k in range(3))
            at_doc, at_tag, at_seg = (partners.field("at").field(c).to_numpy() for c in ("doc", "tag", "seg"))
            base, paras = partners.field("base").to_numpy(), partners.field("paras")
            n_paras = pc.list_value_length(paras).to_numpy(zero_copy_only=False)
            of, paras = np.repeat(np.arange(len(row)), n_paras), paras.flatten()
            first, last, its_first, its_last = (paras.field(c).to_numpy() for c in ("first", "last", "its_first", "its_last"))
            order = np.lexsort((its_first, first, of))
            # where they are in the words of the two sides
            pairs = [*zip((first - seg[row[of]])[order].tolist(), (last - seg[row[of]])[order].tolist(),
                          (its_first - base[of])[order].tolist(), (its_last - base[of])[order].tolist(), strict=True)]
            stretches: list[tuple[int, ...]] = []
            found, k, held, own = [], 0, -1, []
            for r, n, context in zip(row.tolist(), n_paras.tolist(), partners.field("context").to_pylist(), strict=True):
                if r != held:
                    held, own = r, np.frombuffer(batch.column(3)[r].as_py(), np.uint32).tolist()
                seen = _stretches(own, np.frombuffer(context, np.uint32).tolist(), pairs[k:k + n], similarity)
                stretches += seen
                found.append(len(seen))
                k += n
            of = np.repeat(np.arange(len(row)), np.array(found, np.int64))
            at = np.array(stretches, np.int64).reshape(-1, 4)
            at[:, :2] += seg[row[of], None]
            at[:, 2:] += base[of, None]
            both = ((doc[row], at_doc), (tag[row], at_tag), (seg[row], at_seg))
            cols = [*(np.append(x[of], y[of]) for x, y in both), np.append(at[:, 0], at[:, 2]), np.append(at[:, 1], at[:, 3]),
                    np.append(at_doc[of], at_doc[of])]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(cols, kinds, strict=True)],
                                             names=["doc", "tag", "seg", "first", "last", "component"])
    return run


def _spans(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            every = batch.column(5).flatten()
            every = [*zip(*(every.field(c).to_numpy().tolist() for c in ("first", "last", "component")), strict=True)]
            amounts, at = pc.list_value_length(batch.column(5)), 0
            for doc, tag, seg, begin, places, n in zip(*(c.to_pylist() for c in (*batch.columns[:5], amounts)), strict=True):
                marks, at = every[at:at + n], at + n
                place = _unpacked(begin, places)
                state = np.zeros(len(place), np.int8)  # 1 repeated and kept, 2 removed
                for gone in (False, True):
                    for a, b, component in marks:
                        if (component != doc) == gone:
                            state[a - seg:b - seg] = 1 + gone
                edges = np.flatnonzero(np.diff(np.concatenate(([0], state, [0])))).tolist()
                for a, b in zip(edges, edges[1:], strict=False):
                    if state[a] and b - a >= min_words:
                        mine = [m for m in marks if m[0] - seg < b and m[1] - seg > a and (m[2] != doc) == (state[a] == 2)]
                        out.append((doc, tag, int(place[a, 0]), int(place[b - 1, 1]), b - a, len(mine),
                                    min(m[2] for m in mine), bool(state[a] == 2)))
            cols = list(zip(*out, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in cols[:7]), pa.array(cols[7], pa.bool_())],
                names=["doc", "tag", "begin", "end", "n_words", "n_paragraphs", "component", "removed"])
    return run


def _colliding_segments(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Steps 1 to 3: the written segments around paragraphs that share a band with another text's."""
    with Scratch(rows.sparkSession) as own:
        with Scratch(rows.sparkSession) as hashes:  # their tables and shuffles go before any text moves
            wanted = _colliding(rows, hashes, own)
        again = rows.join(wanted, ["doc", "tag"]).dropDuplicates(["doc", "tag"]).select("doc", "tag", "text", "which")
        return scratch.stored(map_batches(again, _segments, SEGMENT), "segments")


def _colliding(rows: DataFrame, own: Scratch, scratch: Scratch) -> DataFrame:
    """(doc, tag, which) of the texts with paragraphs of whose bands other texts have ``AT_LEAST``: their places."""
    sketch = own.stored(map_batches(rows, _sketched, "doc bigint, tag bigint, paras array<int>, bands array<bigint>")
                        .withColumn("row", F.monotonically_increasing_id()), "sketch")
    once = sketch.select(F.explode(F.array_distinct("bands")).alias("h"))
    with Scratch(rows.sparkSession):  # the count's shuffle goes before the hashes are shuffled again
        shared = own.stored(once.groupBy("h").count().filter("count > 1").select("h"), "colliding")
    # a paragraph's hashes stand side by side; all of a text's meet in one place, where they are counted and then listed
    hits = sketch.select("row", F.posexplode("bands").alias("pos", "h")).withColumn("n", F.floor(F.col("pos") / BANDS).cast("int")) \
                 .join(shared, "h", "left_semi").select("row", "n").repartition("row")
    often = hits.groupBy("row", "n").count().filter(F.col("count") >= AT_LEAST).groupBy("row").agg(F.collect_list("n").alias("n"))
    place = lambda n: F.struct(F.get("paras", 2 * n).alias("first"), F.get("paras", 2 * n + 1).alias("last"))
    return scratch.stored(
        sketch.select("row", "doc", "tag", "paras").join(often, "row").select("doc", "tag", F.transform("n", place).alias("which"))
        .dropDuplicates(["doc", "tag"]), "wanted")


def _clustered(segments: DataFrame, similarity: int, own: Scratch, scratch: Scratch) -> DataFrame:
    """(doc, tag, seg, first, last, at) of the paragraphs in components of several documents, but for those of the
    smallest document; ``at`` is the place (doc, tag, seg, first, last) of the component's first paragraph there."""
    paras = segments.select("doc", "tag", "seg", F.explode("paras").alias("p")).select("doc", "tag", "seg", "p.*")
    spot = F.struct("doc", "tag", "seg", "first", "last")
    with Scratch(segments.sparkSession):  # this shuffle goes before the classes' own
        classes = own.stored(paras.groupBy("key").agg(F.first("set").alias("set"), F.first("bands").alias("bands"),
                                                      F.min(spot).alias("at"), F.max("doc").alias("top"))
                             .select("key", "set", "bands", "at", "top", (F.octet_length("set") / 8).cast("bigint").alias("n"),
                                     F.array().cast("array<smallint>").alias("sig")), "paragraph-classes")
    # all classes are few enough to be written with their sets already
    roots = class_components(classes.select("key", "n", "bands", "sig"), lambda wanted: classes.select("key", "set"),
                             similarity, scratch=own)
    rooted = own.stored(classes.select("key", "at", "top").join(roots.select(F.col("u").alias("key"), F.col("v").alias("root")),
                                                                "key", "left")
                        .withColumn("root", F.coalesce("root", "key")), "rooted")
    clusters = rooted.groupBy("root").agg(F.min("at").alias("at"), F.max("top").alias("top")).filter("at.doc < top").select(
        "root", "at")
    spread = own.stored(rooted.select("key", "root").join(clusters, "root").select("key", "at"), "spread")
    # what the others are compared with says nothing itself: they say how far it reaches
    return scratch.stored(paras.drop("set", "bands").join(spread, "key").filter("doc <> at.doc").drop("key"), "members")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: int = SIMILARITY,
                   min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, tag, begin, end, n_words, n_paragraphs, component, removed): runs of repeated words, in byte offsets.

    A run's words are all removed or all kept; ``component`` is the smallest among its paragraphs. The one
    table left in the shared folder holds the result.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LONG_MIN)).alias("doc"), _tag(text_col).alias("tag"),
                       utf8(text_col).alias("text"))
    place = ["doc", "tag", "seg"]
    with Scratch(docs.sparkSession) as scratch:
        segments = _colliding_segments(rows, scratch)
        with Scratch(docs.sparkSession) as classes:
            members = _clustered(segments, similarity, classes, scratch)
        # each segment's paragraphs by the segment they are compared with, and that one's words around them, once
        pairs = members.groupBy(*place, F.struct("at.doc", "at.tag", "at.seg").alias("at")).agg(
            F.collect_list(F.struct("first", "last", F.col("at.first").alias("its_first"), F.col("at.last").alias("its_last")))
            .alias("paras"), F.min("at.first").alias("low"), F.max("at.last").alias("high"))
        base = F.greatest("at.seg", F.col("low") - CONTEXT)
        its = segments.select(F.struct(*place).alias("at"), F.col("words").alias("its_words"))
        partners = pairs.join(its, "at").withColumn("base", base).select(*place, F.struct(
            "at", "base", F.substring("its_words", (F.col("base") - F.col("at.seg")) * 4 + 1,
                                      (F.col("high") + CONTEXT - F.col("base")) * 4).alias("context"), "paras").alias("partner"))
        compared = segments.select(*place, "words").join(
            partners.groupBy(*place).agg(F.collect_list("partner").alias("partners")), place)
        with Scratch(docs.sparkSession):  # the words' shuffles go before the places'
            marks = scratch.stored(map_batches(compared, _marked(similarity), MARK).distinct(), "marks")
        of = marks.groupBy(*place).agg(F.collect_list(F.struct("first", "last", "component")).alias("marks"))
        found = segments.select(*place, "begin", "places").join(of, place).select(*place, "begin", "places", "marks")
        return stored(map_batches(found, _spans(min_words), "doc bigint, tag bigint, begin bigint, end bigint, n_words bigint, "
                                  "n_paragraphs bigint, component bigint, removed boolean"), "repeated-spans")


def repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, begin, end, n_words, n_paragraphs, component_id, removed) of each repeated passage."""
    null = lambda c: F.when(F.col(c) != _LONG_MIN, F.col(c))
    return repeated_spans(docs, id_col, text_col, **options).select(
        null("doc").alias("doc_id"), "begin", "end", "n_words", "n_paragraphs", null("component").alias("component_id"),
        "removed")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, all columns, without their removed passages; ``n_chars`` follows the text if there."""
    gone = repeated_spans(docs, id_col, text_col, **options).filter("removed").groupBy("doc", "tag").agg(
        F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("__cut")).select(
        F.col("doc").alias("__doc"), F.col("tag").alias("__tag"), "__cut")
    same = (F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LONG_MIN)) == F.col("__doc")) & (_tag(text_col) == F.col("__tag"))

    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.field("text"), batch.field("cut"), strict=True):
                raw, kept, at = text.as_py(), [], 0
                for span in spans.as_py() or []:
                    kept.append(raw[at:span["begin"]])
                    at = span["end"]
                out.append(b"".join([*kept, raw[at:]]).decode() if at else None)
            yield pa.array(out, pa.string())

    # only texts that lose something go to Python
    seen = F.struct(F.when(F.col("__cut").isNotNull(), utf8(text_col)).alias("text"), F.col("__cut").alias("cut"))
    judged = docs.join(gone, same, "left").withColumn("__left", arrow_column(docs.sparkSession, cut, "string")(seen))
    lost, out = F.col("__left").isNotNull(), []
    for c in docs.columns:
        if c == text_col:
            out.append(F.coalesce("__left", F.col(c)).alias(c))
        elif c == "n_chars":
            out.append(F.when(lost, F.char_length("__left")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return judged.select(*out)
