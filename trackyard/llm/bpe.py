"""Byte-level BPE encoding by a depth-first walk over a trie of distinct words.

A text is cut into words by the tokenizer's pattern. In each batch the distinct
words not met before are the leaves of a prefix trie; in sorted order they are
visited depth first, and the path to the current node is a stack. A node holds
one thing: the last token of the encoding of its prefix. A child's state
follows from its ancestors' alone: the last token of a longer prefix is the
one vocabulary entry t ending there for which the state where t begins and t
are an adjacent pair that no merge would break up. So a shared prefix is
worked out once for all words below it, in time linear in the trie. A word's
encoding is read off its leaf backwards: last token, the state where that
token begins, and so on.

A pair stands if no merge crosses it while its halves are built: the right
edge of the first and the left edge of the second are walked up their merge
trees together, and at each moment the merge across must come later than the
next merge on either side (the leftmost of equal merges comes first).

Encoding needs no shuffle; a worker remembers at most ``WORDS_KEPT`` words and
works through slices of a batch, so memory is bounded. Texts with characters
outside ``_SAFE`` are cut by the tokenizers library's own pre-tokenizer, whose
Unicode tables may differ from this file's in rarer blocks.

Defined results: null is the empty text; it has no tokens and decodes to the
empty text. Invalid UTF-8 reads as U+FFFD. Special tokens written in a text are
that token, as in the library's default. Rows are independent of each other.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackyard.llm.common import map_batches, utf8

WORDS_KEPT = 350_000
PAIRS_KEPT = 400_000
_SLICE = 1024
_NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tokens and merges of a byte-level BPE file of the tokenizers library."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, letters = spec["model"], byte_letters()
        if model["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" \
                or spec["pre_tokenizer"]["add_prefix_space"] or model.get("end_of_word_suffix"):
            raise ValueError("a byte-level BPE file without normalizer is asked for")
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of: dict[int, bytes] = {i: bytes(letters[c] for c in t) for t, i in ids.items()
                                           if all(c in letters for c in t)}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        halves: dict[int, tuple[int, int]] = {}
        made_at: dict[int, int] = {}
        for r, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            whole = ids[a + b]
            self.rank[ids[a], ids[b]] = r
            if whole not in made_at:
                halves[whole], made_at[whole] = (ids[a], ids[b]), r
        self.id_of = {bytes([b]): ids[c] for c, b in letters.items()} | {self.bytes_of[i]: i for i in halves}
        # last three bytes -> lengths of the tokens that end so, longest first
        ends: dict[bytes, set[int]] = {}
        for t in self.id_of:
            if len(t) > 2:
                ends.setdefault(t[-3:], set()).add(len(t))
        self.lengths = {k: tuple(sorted(v, reverse=True)) for k, v in ends.items()}
        # edges of the merge trees, innermost byte first: (token, when it becomes part of the next)
        self.right_edge = {i: self._edge(i, 1, halves, made_at) for i in self.id_of.values()}
        self.left_edge = {i: self._edge(i, 0, halves, made_at) for i in self.id_of.values()}

    @staticmethod
    def _edge(token: int, side: int, halves: dict, made_at: dict) -> tuple[tuple[int, int], ...]:
        out = [(token, _NEVER)]
        while out[-1][0] in halves:
            out.append((halves[out[-1][0]][side], made_at[out[-1][0]]))
        return tuple(reversed(out))

    def stands(self, first: int, second: int) -> bool:
        """Whether the two tokens side by side are the encoding of their bytes."""
        left, right = self.right_edge[first], self.left_edge[second]
        i = j = 0
        while True:
            a, a_until = left[i]
            b, b_until = right[j]
            across = self.rank.get((a, b))
            if across is not None and across < a_until and across <= b_until:
                return False
            if a_until == b_until == _NEVER:
                return True
            if a_until <= b_until:
                i += 1
            else:
                j += 1


class TrieEncoder:
    """Encodes words; remembers them."""

    def __init__(self, vocabulary: Vocabulary, keep: int = WORDS_KEPT):
        self.v, self.keep = vocabulary, keep
        self.known: dict[str, bytes] = {}
        self.judged: dict[int, bool] = {}  # first token << 32 | second -> stands

    def learn(self, words: set[str]) -> None:
        """Walk the trie of those of ``words`` that aren't known yet."""
        if len(self.known) > self.keep:
            self.known.clear()
        if len(self.judged) > PAIRS_KEPT:
            self.judged.clear()
        fresh = sorted((w.encode("utf-8", "surrogatepass"), w) for w in words if w not in self.known)
        token_of, lengths, judged, stands = self.v.id_of.get, self.v.lengths.get, self.judged, self.v.stands
        path, before = [(-1, 0)], b""  # state of each prefix of the word before: last token, its length
        for word, text in fresh:
            shared = len(os.path.commonprefix((before, word)))
            del path[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                sizes = lengths(word[end - 3:end], ()) if end > 2 else ()
                for size in (*sizes, 2, 1) if end > 1 else (1,):
                    if size > end:
                        continue
                    token = token_of(word[end - size:end])
                    if token is None:
                        continue
                    if size < end:
                        pair = path[end - size][0] << 32 | token
                        good = judged.get(pair)
                        if good is None:
                            good = judged[pair] = stands(path[end - size][0], token)
                        if not good:
                            continue
                    path.append((token, size))
                    break
            at, out = len(word), []
            while at:
                token, size = path[at]
                out.append(token)
                at -= size
            self.known[text] = array("I", reversed(out)).tobytes()
            before = word

    def encode(self, words: list[str]) -> bytes:
        return b"".join(map(self.known.__getitem__, words))


def _safe_classes() -> tuple[str, str, str]:
    """Character classes, as written in a pattern, over blocks whose categories have long been settled."""
    safe = [*range(0x09, 0x0E), *range(0x20, 0x7F), *range(0xA1, 0x250), *range(0x2010, 0x2028), 0x20AC]
    of = {c: unicodedata.category(chr(c)) for c in safe}
    pick = lambda kind: "".join(re.escape(chr(c)) for c in safe if of[c].startswith(kind))
    return pick("L"), pick("N"), "".join(re.escape(chr(c)) for c in safe)


_LETTERS, _NUMBERS, _SAFE = _safe_classes()
_UNSAFE = re.compile(f"[^{_SAFE}]")
# the byte-level pattern, its alternatives sorted by how often they apply; those that start alike keep their order
_WORDS = re.compile(rf" ?[{_LETTERS}]+| ?[{_NUMBERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[^\s{_LETTERS}{_NUMBERS}]+|\s+(?!\S)|\s+")


class Splitter:
    """Texts to words and special tokens."""

    def __init__(self, spec: str, special: dict[str, int]):
        self.spec, self.special = spec, special
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") \
            if special else None
        self._library = None
        self._letters = byte_letters()

    def _rare(self, text: str) -> list[str]:
        if self._library is None:
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_str(self.spec)
        words = self._library.pre_tokenizer.pre_tokenize_str(text)
        return [bytes(map(self._letters.__getitem__, w)).decode("utf-8", "surrogatepass") for w, _ in words]

    def plain(self, text: str) -> list[str]:
        return _WORDS.findall(text) if not _UNSAFE.search(text) else self._rare(text)

    def parts(self, text: str) -> list[list[str] | int]:
        """Lists of words, and ids of special tokens between them."""
        if self.cut is None or not self.cut.search(text):
            return [self.plain(text)]
        return [self.special[p] if p in self.special else self.plain(p) for p in self.cut.split(text) if p]


def encoder_of(spec: str) -> tuple[Vocabulary, Splitter, TrieEncoder]:
    vocabulary = Vocabulary(spec)
    return vocabulary, Splitter(spec, vocabulary.special), TrieEncoder(vocabulary)


def encode_all(texts: list[str], splitter: Splitter, encoder: TrieEncoder) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers."""
    cut = [splitter.parts(t) for t in texts]
    encoder.learn({w for parts in cut for p in parts if isinstance(p, list) for w in p})
    return [b"".join(encoder.encode(p) if isinstance(p, list) else np.uint32(p).tobytes() for p in parts)
            for parts in cut]


def decode(ids: bytes, vocabulary: Vocabulary) -> str:
    return b"".join(map(vocabulary.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


# one per worker process and tokenizer file: known words serve later tasks too
_ENCODERS: dict[str, tuple] = {}


def _encoder(spec: str) -> tuple[Vocabulary, Splitter, TrieEncoder]:
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = encoder_of(spec)
    return _ENCODERS[key]


def _spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, text): the ids as bytes and the text decoded from them, of every row."""
    spec = docs.sparkSession.sparkContext.broadcast(_spec(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, splitter, encoder = _encoder(spec.value)
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                ids = encode_all([t.as_py().decode("utf-8", "replace") for t in batch.column(1)], splitter, encoder)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(ids, pa.binary()),
                     pa.array([decode(i, vocabulary) for i in ids], pa.string())], names=["doc_id", "ids", "text"])

    return map_batches(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(text_col).alias("text")), run,
                       "doc_id bigint, ids binary, text string")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    return encoded(docs, tokenizer, id_col, text_col).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def token_lists(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids array<int>) of every row, checked by decoding."""
    spec = docs.sparkSession.sparkContext.broadcast(_spec(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, splitter, encoder = _encoder(spec.value)
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                texts = [t.as_py().decode("utf-8", "replace") for t in batch.column(1)]
                ids = encode_all(texts, splitter, encoder)
                for t, i in zip(texts, ids, strict=True):
                    if decode(i, vocabulary) != t:
                        raise ValueError("the ids don't decode to their text")
                flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
                ends = np.cumsum([0] + [len(i) // 4 for i in ids]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.diff(ends).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["doc_id", "n_tokens", "ids"])

    return map_batches(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(text_col).alias("text")), run,
                       "doc_id bigint, n_tokens bigint, ids array<int>")
