import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from noticelake.llm import bpe, packed  # noqa: E402
from noticelake.llm.queries import op3_packed_ids, op4_bpe  # noqa: E402
from noticelake.llm.words import text_bytes  # noqa: E402

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "", " ", "  a  b\n\n c\t", "it's I'LL we'd", "<|endoftext|>x<|endoftext|><|startoftext|>", "naïve Straße ΣΑΣ ﬁ İx ẖ H̱", "12345 6 7,8.9",
    "日本語のテキスト 🎉🎉", "a\x00b\x1cc\x85d e f", "!!!???***###", "x" * 3000, "aaaaaaaaaaaaaaaab" * 50, "Á ȩ́ '́s", "l'été d'un'l ''s 's", "Kſ K",
]


@pytest.fixture(scope="module")
def byte_lib():
    return tokenizers.Tokenizer.from_file(BYTE)


@pytest.fixture(scope="module")
def word_lib():
    return tokenizers.Tokenizer.from_file(WORD)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_byte_bpe_equals_library(text):
    lib = tokenizers.Tokenizer.from_file(BYTE) if not hasattr(test_byte_bpe_equals_library, "lib") else test_byte_bpe_equals_library.lib
    test_byte_bpe_equals_library.lib = lib
    v = bpe.vocabulary(BYTE)
    ids = np.frombuffer(v.encode(text), "<u4")
    assert ids.tolist() == lib.encode(text, add_special_tokens=False).ids
    assert v.decode(ids).decode() == lib.decode(ids.tolist(), skip_special_tokens=False) == text


def test_byte_bpe_on_hard_texts(byte_lib):
    v = bpe.vocabulary(BYTE)
    for t in HARD:
        assert np.frombuffer(v.encode(t), "<u4").tolist() == byte_lib.encode(t, add_special_tokens=False).ids, t[:40]


def _pieces(texts):
    import pyarrow as pa

    ids, n = packed.encoder(WORD).encode(*text_bytes(pa.array(texts, pa.string())))
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


def test_pieces_equal_library_on_hard_texts(word_lib):
    assert _pieces([*HARD, None]) == [word_lib.encode(t, add_special_tokens=False).ids for t in [*HARD, ""]]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=6))
def test_pieces_equal_library(texts):
    lib = packed.encoder(WORD).tokenizer
    assert _pieces(texts) == [lib.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_bits_round_trip(bits, values):
    ids = np.array([v & ((1 << bits) - 1) for v in values], np.uint32)
    data = packed.pack(ids, bits)
    assert len(data) == (len(ids) + 7) // 8 * bits
    assert packed.unpack(data, bits, len(ids)).tolist() == ids.tolist()


def test_file_random_access(tmp_path):
    ids = np.random.default_rng(0).integers(0, 49408, 3 * packed.BLOCK + 77).astype(np.uint32)
    ends = np.array([0, 5, 5000, len(ids)])
    packed.write_file(f"file://{tmp_path}/a/x.ids", [None, 3, 3, 9], ends, ids, 16)
    f = packed.PackedFile(f"file://{tmp_path}/a/x.ids")
    assert f.doc_ids[f.known].tolist() == [3, 3, 9] and f.known.tolist() == [False, True, True, True]
    for a, b in [(0, 0), (0, 1), (4095, 4097), (5000, len(ids)), (8192, 8192), (len(ids) - 1, len(ids))]:
        assert f.read(a, b).tolist() == ids[a:b].tolist()


def test_packed_edge_rows(spark, docs, word_lib):
    df = docs((5, "Hello, World! 12"), (None, "no id"), (2, None), (7, ""), (5, "Hello, World! 12"), (1, HARD[5]))
    got = sorted(packed.write_and_read(spark, df, WORD, 2).collect(), key=lambda r: r["start"])
    want, at = [], 0
    for i, t in [(None, "no id"), (1, HARD[5]), (2, ""), (5, "Hello, World! 12"), (5, "Hello, World! 12"), (7, "")]:
        ids = [*word_lib.encode(t, add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert [tuple(r) for r in got] == want
    assert packed.write_and_read(spark, df.limit(0), WORD, 2).count() == 0


def test_bpe_edge_rows(spark, docs):
    df = docs((1, None), (None, ""), (3, "abc abc"), (3, "abc abc")).withColumnRenamed("copies", "decoded")
    rows = bpe.decode(bpe.encode(df, BYTE), BYTE).collect()
    assert [r["decoded"] for r in rows] == ["", "", "abc abc", "abc abc"]
    assert bpe.digests(bpe.decode(bpe.encode(df.limit(0), BYTE), BYTE)).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(df, BYTE, ids_col="text")


def test_queries_equal_library(spark, documents, byte_lib, word_lib):
    rows = {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in op4_bpe(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    for i, t in rows.items():
        ids = byte_lib.encode(t, add_special_tokens=False).ids
        decoded = byte_lib.decode(ids, skip_special_tokens=False).encode()
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()
        )
    got = {r["doc_id"]: r for r in op3_packed_ids(spark, "/root/testdata/sf0.001").collect()}
    at = 0
    for i in sorted(rows):
        ids = [*word_lib.encode(rows[i], add_special_tokens=False).ids, 2]
        assert tuple(got[i]) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_a_vocabulary_of_other_rules_is_refused():
    assert packed.matches(WORD) and not packed.matches(BYTE)
    with pytest.raises(ValueError):
        packed.PieceEncoder(BYTE)
