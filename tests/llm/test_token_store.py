import zlib

import cases
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerstrata.llm.common import new_folder, vocabulary
from ledgerstrata.llm.encoding import WordEncoder
from ledgerstrata.llm import token_store

VOCABULARIES = (("byte_bpe_50k.json", "spaced"), ("word_bpe_49k.json", "dropped"))
PIECES = st.sampled_from(
    ["a", "The", "foo", "'s", "'", "12", ".", ",", "...", ".,", " ", "  ", "\n", "\n\n", "\t", "\r",
     "\xa0", "　", "\x1c", "\x85", "é", "É", "Σ", "ß", "é", "́", "<|endoftext|>", "|",
     "###", "don't", "ÀB", "İ", "中文", "😀", "_", "-", "ŉ", "ª", "ꟊ", "Ǆ"]
)


@pytest.mark.parametrize("name, words", VOCABULARIES)
def test_word_by_word_equals_the_library(name, words):
    encoder = WordEncoder(vocabulary(name), words)

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.lists(PIECES, max_size=14).map("".join), max_size=4))
    def check(texts):
        want = [one.ids for one in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)] == want

    check()


def test_segments_hold_any_ids():
    rng = np.random.default_rng(2)
    for ids in (
        np.array([0]), np.array([255, 256, 65535, 65536, 2**32 - 1, 0]), rng.integers(0, 50_257, 5000),
        rng.integers(0, 256, 513), rng.integers(0, 2**32, 1025),
    ):
        ids = ids.astype("<u4")
        assert (token_store.unpack_segment(token_store.pack_segment(ids)) == ids).all()


def library_ids(text):
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    return one.encode(text or "", add_special_tokens=False).ids + [0]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))


def test_awkward_rows(spark):
    rows = cases.documents(spark)
    got = token_store.token_round_trip(rows, vocabulary("byte_bpe_50k.json")).collect()
    start, want = 0, []
    for doc_id, text, *_ in ordered(cases.ROWS):
        ids = library_ids(text)
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == want
    empty = token_store.token_round_trip(cases.empty(spark), vocabulary("byte_bpe_50k.json"))
    assert empty.collect() == []


def test_random_access_reads_little(spark, monkeypatch):
    monkeypatch.setattr(token_store, "SEGMENT", 1000)
    folder = new_folder(spark, "test-tokens")
    rows = cases.documents(spark, [r for r in cases.ROWS if r[1] and len(r[1]) < 5000], clash=False)
    manifest = token_store.write_tokens(rows.coalesce(1), vocabulary("byte_bpe_50k.json"), folder)
    for row in manifest.collect():
        file = token_store.open_tokens(row.file)
        ids = np.concatenate([np.concatenate(parts) for _, _, parts in file.documents()])
        assert len(ids) == file.tokens == row.tokens
        largest, read = [0], file._read

        def counted(offset, length):
            largest[0] = max(largest[0], length)
            return read(offset, length)

        file._read = counted
        assert [file.token(i) for i in range(len(ids))] == ids.tolist()
        assert largest[0] <= 64
        with pytest.raises(IndexError):
            file.token(len(ids))
