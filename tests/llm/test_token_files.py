import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import token_files as T
from ledgerlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(text):
    """The library's own encoding of the whole text."""
    return [*T._tokenizer(T.tokenizer_path()).encode(text or "", add_special_tokens=False).ids, 1]


def want(rows):
    """(doc_id, start, ids) in file order of (doc_id, text)."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain(text)
        out.append((doc_id, start, ids))
        start += len(ids)
    return out


def test_query_matches_the_library_on_the_whole_corpus(spark, texts):
    got = sorted(tuple(r) for r in QUERIES["op13_flat_token_files"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == [(d, s, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))) for d, s, ids in want(texts.items())]


def test_files_round_trip_and_are_as_described(spark, docs_of, tmp_path):
    rows = [(i, f"some words {i} über alles\tnaïve Σας <|endoftext|>don't 12345") for i in range(60)]
    files = T.write_token_files(docs_of(rows), part_bytes=300, folder=str(tmp_path))
    expected = want(rows)
    assert len(files.parts) > 4 and files.kind == np.dtype("<u2") and (files.docs, files.tokens) == (60, sum(len(x[2]) for x in expected))
    again = T.TokenFiles.open(files.folder)
    for i, (doc_id, start, ids) in enumerate(expected):
        found = again.document(i)
        assert (found[0], found[1], found[2].tolist()) == (doc_id, start, ids)
    with pytest.raises(IndexError):
        again.document(60)
    flat = b"".join((tmp_path / f"{p['name'].decode()}.ids").read_bytes() for p in again.parts)
    assert np.frombuffer(flat, "<u2").tolist() == [t for x in expected for t in x[2]]
    back = sorted((r.doc_id, r.start, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in T.read_token_files(spark, files.folder).collect())
    assert back == [(d, s, i) for d, s, i in expected]


def test_files_of_lost_attempts_are_not_read_and_broken_ones_raise(spark, docs_of, tmp_path):
    files = T.write_token_files(docs_of([(1, "a b"), (2, "c")]), folder=str(tmp_path))
    (tmp_path / "deadbeef.ids").write_bytes(b"junk")
    assert T.read_token_files(spark, files.folder).count() == 2
    name = files.parts["name"][0].decode()
    os.truncate(tmp_path / f"{name}.ids", 1 * 2)
    with pytest.raises(Exception, match="isn't as long|size of available data"):
        T.read_token_files(spark, files.folder).collect()
    (tmp_path / T.INDEX).write_bytes(b"short")
    with pytest.raises(Exception):
        T.TokenFiles.open(files.folder)


def test_nulls_empty_repeats_and_one_hot_id(spark, docs_of, tmp_path):
    rows = [(None, "null id"), (None, None), (3, None), (2, ""), (2, "   \n"), *[(1, f"copy {i % 3}") for i in range(90)]]
    files = T.write_token_files(docs_of(rows).repartition(3), part_bytes=200, folder=str(tmp_path))
    got = T.read_token_files(spark, files.folder).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in got) == sorted((d is not None, d or 0, plain(t)) for d, t in rows)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered[:2]] == [None, None] and [r.doc_id for r in ordered[2:]] == sorted(r.doc_id for r in ordered[2:])
    assert [r.start for r in ordered] == [sum(x.n_tokens for x in ordered[:i]) for i in range(len(ordered))]
    assert max(files.parts["docs"]) <= 45  # the hot id is dealt to several parts
    empty = T.write_token_files(docs_of([]))
    assert (empty.docs, empty.tokens) == (0, 0) and T.read_token_files(spark, empty.folder).collect() == []


def test_words_are_encoded_as_in_the_whole_text(monkeypatch):
    odd = "It's they'll DON'T 'tis abc$$$ x... Straße, ΣΑΣ Σας. ﬁne ŉ e\u0301 a\x0bb\x0cc\x1cd\x1fe\x85f\u2028g\u3000h ! ?! ''s <|endoftext|>, a<|endoftext|> İI ij12 ½ x'S. 中文字 नमस्ते 👍🏽ok Ꟛ"
    text = "It's  the naïve word-break, CAFÉ\u0301 \r\n 12345 don't " * 40 + "x" * 300
    texts = [odd, text, "b", "", text, odd.upper(), odd.replace(" ", "")]
    def encode():
        found = []
        for flat, lengths in T.Encoder(T.tokenizer_path(), np.dtype("<u4")).groups(pa.array(["skipped", *texts])[1:]):
            found += [part.tolist() for part in np.split(flat, np.cumsum(lengths))[:-1]]
        return found

    whole = [plain(t)[:-1] for t in texts]
    assert encode() == whole
    monkeypatch.setattr(T, "GROUP_BYTES", 50)
    monkeypatch.setattr(T, "HELD_WORDS", 3)
    assert "".join(T.pieces(text, 50)) == text and len(list(T.pieces(text))) > 20
    assert encode() == whole


def test_ids_that_need_more_than_two_bytes(docs_of, tmp_path):
    files = T.write_token_files(docs_of([(1, "a b")]), end_id=70000, folder=str(tmp_path))
    assert files.kind == np.dtype("<u4") and files.document(0)[2].tolist() == [*plain("a b")[:-1], 70000]
