import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bpe
from tidemark.llm.queries import RANKS, op1_byte_bpe

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def enc():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_rows_as_the_other_library(spark, docs, odd, enc):
    df = docs(odd)
    out = bpe.decode(bpe.encode(df, RANKS, PATTERN, offsets=True), RANKS, PATTERN)
    assert out.columns.count("ids") == 1 and {"n_words", "starts", "ends", "decoded"} <= set(out.columns)
    rows = out.collect()
    assert len(rows) == len(odd)
    for r in rows:
        text = r["text"] or ""
        assert r["ids"] == enc.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode()
        at = 0
        for token, a, b in zip(r["ids"], r["starts"], r["ends"]):
            piece = enc.decode_single_token_bytes(token)
            whole = text.encode()
            assert len(whole[:at].decode(errors="ignore")) == a  # the character the token begins in
            at += len(piece)
            assert len(text[:b].encode()) >= at > len(text[: b - 1].encode())


PIECES = st.sampled_from([" ", "  ", "\n", "\t", "'s", "Don't", "ab", "é", "\u3000", "12", "!?", "\U0001f600", "\x1c", "\xa0"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PIECES, st.text(max_size=4)), max_size=12).map("".join))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}) if not hasattr(test_any_text, "enc") else test_any_text.enc
    test_any_text.enc = enc
    c = bpe.codec(RANKS, PATTERN)
    ids = np.frombuffer(c.encode([text])[0], "<u4")
    assert ids.tolist() == enc.encode_ordinary(text)
    assert c.decode(ids.tolist()) == text.encode()


def test_full_memory_changes_nothing(monkeypatch, enc):
    monkeypatch.setattr(bpe, "MEMORY", 3)
    c = bpe.Codec(RANKS, PATTERN)
    for text in ("some words here and there", "other words here\nand a line", "x y z x y z"):
        assert np.frombuffer(c.encode([text])[0], "<u4").tolist() == enc.encode_ordinary(text)
    assert len(c.known) <= 3 + 6


def test_decode_of_split_characters_and_nulls(spark):
    c = bpe.codec(RANKS, PATTERN)
    ids = np.frombuffer(c.encode(["日本"])[0], "<u4").tolist()
    df = spark.createDataFrame([(1, ids), (2, ids[1:]), (3, None), (4, [])], "k int, ids array<int>")
    got = {r["k"]: bytes(r["decoded"]) for r in bpe.decode(df, RANKS, PATTERN).collect()}
    assert got[1] == "日本".encode() and got[1].endswith(got[2]) and got[3] == got[4] == b""
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(spark.createDataFrame([([60000],)], "ids array<int>"), RANKS, PATTERN).collect()


def test_empty_table(spark, docs):
    assert bpe.decode(bpe.encode(docs([]), RANKS, PATTERN), RANKS, PATTERN).count() == 0


def test_query(spark, enc):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op1_byte_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for r in rows:
        ids = enc.encode_ordinary(texts[r["doc_id"]] or "")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert r["decoded_sha256"] == sha((texts[r["doc_id"]] or "").encode())
