"""Token counts and the token file beside the tokenizers library and plain Python."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from vizquarry.llm import pieces, registry, token_counts, token_file

PATH = registry.tokenizer_path()
SMALL = pieces.PieceEncoder(PATH, memo=3)
HARD = ["a", "Z", "é", "ß", "9", "½", " ", "  ", "\n", "\n\n", "\t", " ", "\x1c", " ", "'s", "'", ".", ",", "..", "<|endoftext|>", "世", "\U0001f600", "$$$", "\r\n"]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.sampled_from(HARD), max_size=14).map("".join) | st.text(max_size=30))
def test_pieces_equal_whole_texts(whole, text):
    want = whole.encode(text, add_special_tokens=False).ids
    assert SMALL.ids(text).tolist() == want
    assert SMALL.count(text) == len(want)


ROWS = [
    (1, "Two words.\nA line, and more", "x"),
    (2, None, "x"),
    (3, "", None),
    (4, "Two words.\nA line, and more", "y"),
    (None, "no id <|endoftext|> here", "y"),
    (5, "long text, " * 30_000, "z"),
    (5, "same id", "z"),
    (6, "  odd   blanks \t\n", "z"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, n_tokens string")


def test_counts_and_the_cache(spark, docs, whole, tmp_path):
    cache = str(tmp_path / "cache")
    for _ in range(2):
        got = sorted(token_counts.count_tokens(docs, PATH, cache).collect(), key=str)
        want = []
        for key, text, _ in ROWS:
            n = len(whole.encode(text or "", add_special_tokens=False).ids)
            want.append((key, len((text or "").encode()), n, n > 1024))
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    version = pieces.tokenizer_version(PATH)
    stored = spark.read.parquet(f"{cache}/version={version}")
    assert stored.count() == 6, "each distinct text is encoded once, also by the second call"


def test_counts_take_what_the_cache_says(spark, docs, tmp_path):
    cache, version = str(tmp_path / "cache"), pieces.tokenizer_version(PATH)
    wrong = spark.createDataFrame([("same id",)], "text string").selectExpr("unhex(sha2(text, 256)) AS digest", "77L AS n_tokens")
    wrong.write.parquet(f"{cache}/version={version}")
    got = token_counts.count_tokens(docs.where("text = 'same id'"), PATH, cache).collect()
    assert [r.n_tokens for r in got] == [77]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=9), max_size=6), st.integers(1, 7))
def test_segments_round_trip(bits, lists, block):
    arrays = [np.array([x % (1 << bits) for x in a], dtype=np.uint32) for a in lists]
    held = token_file.Segment(token_file.pack_segment(list(range(len(arrays))), arrays, bits, block))
    assert held.doc_ids == list(range(len(arrays)))
    flat = np.concatenate(arrays) if arrays else np.zeros(0)
    assert held.ids(0, held.n_ids).tolist() == flat.tolist()
    for k, a in enumerate(arrays):
        assert held.document(k).tolist() == a.tolist()
    assert held.ids(held.n_ids // 3, held.n_ids // 2).tolist() == flat[held.n_ids // 3 : held.n_ids // 2].tolist()


def test_bit_width():
    assert [token_file.bit_width(n) for n in (1, 2, 3, 50257, 65536, 65537)] == [1, 1, 2, 16, 16, 17]


def test_bad_segment():
    with pytest.raises(ValueError):
        token_file.Segment(bytes(64))


def test_token_file(spark, docs, whole, tmp_path):
    path = str(tmp_path / "tokens")
    token_file.write_token_file(docs, PATH, path, segment_ids=50)
    got = {(r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_file.read_token_file(spark, path).collect()}
    rows = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    texts = {k: [t or "" for i, t, _ in rows if i == k] for k in {r[0] for r in rows}}
    assert len(got) == len(ROWS)
    start = 0
    for at, key, n, crc in sorted(got):
        assert at == start
        match = [t for t in texts[key] if zlib.crc32(np.array(whole.encode(t, add_special_tokens=False).ids + [0], "<u4").tobytes()) == crc]
        assert match
        texts[key].remove(match[0])
        start += n
    assert [k for _, k, _, _ in sorted(got)] == [r[0] for r in rows]


def test_empty_tables(spark, docs, tmp_path):
    none = docs.limit(0)
    assert token_counts.count_tokens(none, PATH, str(tmp_path / "c")).count() == 0
    token_file.write_token_file(none, PATH, str(tmp_path / "t"))
    assert token_file.read_token_file(spark, str(tmp_path / "t")).count() == 0
