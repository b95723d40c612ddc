import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import docs_frame, prose
from trackyard.llm import bpe, token_files

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

PIECES = ["a", "Aa", " ", "  ", "\n", "'s", "'LL", "é", "É", "ß", "日本", "😀", "1", "12", "--", "<|endoftext|>", "<|ENDOFTEXT|>",
          "<|startoftext|>", "\x1c", "\x85", "\xa0", "́", "the", "ing", "İ", "ǅ", "!", "ا", ".", ",", "²", "Ⅷ", "_", "Σ",
          "ﬁ", " ", "\t", "\x0b", "\x00", "ahahaha"]


def odd_texts(n=1500, seed=11):
    r = random.Random(seed)
    return ["".join(r.choice(PIECES) for _ in range(r.randint(0, 30))) for _ in range(n)] + ["", "a" * 3000, prose(1, 900)]


def library(name):
    t = tokenizers.Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


def test_trie_equals_the_library():
    t = library("byte_bpe_50k.json")
    vocabulary, splitter, encoder = bpe.encoder_of(open(public_tokenizers.path("byte_bpe_50k.json")).read())
    texts = odd_texts()
    for text, ids in zip(texts, bpe.encode_all(texts, splitter, encoder), strict=True):
        own = np.frombuffer(ids, "<u4").tolist()
        assert own == t.encode(text, add_special_tokens=False).ids, text
        assert bpe.decode(ids, vocabulary) == t.decode(own, skip_special_tokens=False) == text


def test_character_classes_equal_the_library():
    t = library("byte_bpe_50k.json")
    spec = open(public_tokenizers.path("byte_bpe_50k.json")).read()
    splitter = bpe.Splitter(spec, {})
    letters = bpe.byte_letters()
    for c in range(0x2100):
        if not bpe._UNSAFE.search(chr(c)):
            text = f"a{chr(c)}1 {chr(c)}{chr(c)} b"
            whole = [bytes(letters[x] for x in w).decode() for w, _ in t.pre_tokenizer.pre_tokenize_str(text)]
            assert splitter.plain(text) == whole


def test_bpe_query_columns(spark, awkward):
    t = library("byte_bpe_50k.json")
    got = bpe.round_trip(docs_frame(spark, awkward), public_tokenizers.path("byte_bpe_50k.json")).collect()
    want = []
    for i, text in awkward:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    lists = bpe.token_lists(docs_frame(spark, awkward), public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in lists) == sorted((str(w[0]), w[1]) for w in want)


def test_known_words_are_bounded():
    spec = open(public_tokenizers.path("byte_bpe_50k.json")).read()
    encoder = bpe.TrieEncoder(bpe.Vocabulary(spec), keep=50)
    for k in range(20):
        encoder.learn({f"word{k}x{j}" for j in range(30)})
    assert len(encoder.known) <= 80


def test_pieces_equal_the_library():
    t = library("word_bpe_49k.json")
    texts = odd_texts(seed=12)
    encoder = token_files.PieceEncoder(open(public_tokenizers.path("word_bpe_49k.json")).read(), 2)
    for text, ids in zip(texts, encoder.encode([x.encode() for x in texts]), strict=True):
        assert t.encode(text, add_special_tokens=False).ids == np.frombuffer(ids, "<u2").tolist(), text


@pytest.mark.parametrize("values", [[], [0], [255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1], list(range(300)) * 3])
def test_code_round_trip(values):
    control, data = token_files.pack(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert token_files.unpack(control, data, len(values)).tolist() == values


@pytest.mark.parametrize("file_tokens", [token_files.FILE_TOKENS, 500])
def test_files_round_trip(spark, awkward, tmp_path, file_tokens):
    t = library("word_bpe_49k.json")
    path = str(tmp_path / "tokens")
    manifest = token_files.write_token_files(docs_frame(spark, awkward), public_tokenizers.path("word_bpe_49k.json"), path,
                                             file_tokens=file_tokens)
    assert manifest.count() > 1 or file_tokens > 500
    rows = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    ids = [t.encode(x or "", add_special_tokens=False).ids + [1] for _, x in awkward]
    crc = sorted((str(i), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (i, _), x in zip(awkward, ids, strict=True))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows) == crc
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    order = [float("-inf") if r.doc_id is None else r.doc_id for r in rows]
    assert order == sorted(order)


def test_empty_tables(spark, tmp_path):
    none = docs_frame(spark, [])
    assert bpe.round_trip(none, public_tokenizers.path("byte_bpe_50k.json")).collect() == []
    path = str(tmp_path / "none")
    token_files.write_token_files(none, public_tokenizers.path("word_bpe_49k.json"), path)
    assert token_files.read_token_files(spark, path).collect() == []
