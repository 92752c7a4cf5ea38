"""SentencePiece ids and texts against the library itself."""

import hashlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import public_tokenizers
import sentencepiece
from sheetloom.llm import pieces
from sheetloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(pieces.MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
OURS = pieces.Pieces(PATH)


def ids_of(text):
    return LIBRARY.encode(text, add_eos=True)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(), st.text("ab ▁\n0é中"), st.text("aelrstino  ▁"), st.lists(st.sampled_from(["the ", "  ", "ing", "Ġ", "<0x0A>", "</s>", "\u0000", "😀"])).map("".join)))
def test_any_text(text):
    found = OURS.encode([text, text + "x"])
    assert found[0].tolist() == ids_of(text) and found[1].tolist() == ids_of(text + "x")
    assert OURS.decode(found[0]) == LIBRARY.decode(ids_of(text))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 270)), max_size=12))
def test_any_ids_decode(ids):
    assert OURS.decode(np.array(ids, np.int32)) == LIBRARY.decode(ids)


@pytest.mark.parametrize("text", ["a" * 70_000, " " * 70_000, "abc" * 30_000, "x  " * 30_000, "".join(chr(97 + i * i % 26) for i in range(90_000)), "".join(chr(65 + i * i % 57) for i in range(90_000))])
def test_very_long_words(text):
    assert OURS.encode([text])[0].tolist() == ids_of(text)


def test_queue_and_rounds_agree():
    words = ["▁" + "".join(chr(97 + (i * k) % 26) for i in range(3 + k % 40)) for k in range(1, 300)]
    for word, ids in zip(words, OURS.encode_words(words)):
        assert OURS.queue(OURS._symbols(pieces._codes(word)).tolist()) == np.frombuffer(ids, np.int32).tolist()


def test_columns_nulls_and_chunks(spark, monkeypatch):
    rows = [(1, None, "n"), (2, "", "e"), (3, "two words", "c"), (3, "two words", "c"), (4, "é" * 500, "l")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(1)
    got = pieces.encode(df, ids="ids").withColumn("back", pieces.decode(F.col("ids"))).collect()
    assert sorted((r["doc_id"], list(r["ids"]), r["back"]) for r in got) == sorted((i, ids_of(t or ""), t or "") for i, t, _ in rows)
    assert pieces.encode(df.limit(0)).count() == 0
    assert pieces.encode(df.select("text")).columns == ["ids"]


def test_query(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op13_pieces"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        ids = ids_of(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
