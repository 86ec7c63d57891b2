from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from stratalake.llm.piece_codec import (
    CodecParams, PieceDecoder, PrefixEncoder, SPACE, Vocabulary, codec_digests, decode_ids, default_model,
    encode_decode, read_vocabulary,
)
from stratalake.llm.queries import QUERIES

PARTS = [
    "the", "é", "日本", "한글", "😀", " ", "  ", "   ", "\n", SPACE, "a", "ing", "\x00", "Ω", "ữ", "ℵ", ".", ",", "1",
    "\t", "\r\n", ";\r", "er", "s", " t", "aa", "ll", "　", "\xa0", " " * 17, "</s>", "<0x41>", "\x1c", " ",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=default_model())


@pytest.fixture(scope="module")
def words():
    return read_vocabulary(default_model())


def test_ids_and_texts_equal_the_library(spark, docs, library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(30))) for _ in range(600)]
    texts += ["", " ", "  ", SPACE, " a", "a ", None, "word " * 30_000, "x" * 40_000, "ab" * 9_999, " " * 5_000]
    rows = encode_decode(docs(list(enumerate(texts))), params=CodecParams(cached_spans=500, cached_pairs=300)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == library.encode(text), repr(text)[:60]
        assert r["decoded"] == library.decode(r["ids"]), repr(text)[:60]


def test_query_on_documents(spark, library):
    rows = QUERIES["op13_piece_codec"](spark, "/root/testdata/sf0.001").collect()
    got = {r["doc_id"]: r for r in rows}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = library.encode(r["text"] or "")
        own = got.pop(r["doc_id"])
        assert own["n_tokens"] == len(ids)
        assert own["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert own["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert not got


def test_any_ids_decode_like_the_library(spark, library):
    rng = random.Random(4)
    some = [0, 1, 2, 29871, 259, 260, *range(3, 259), *(rng.randrange(259, 32_000) for _ in range(300))]
    rows = [(i, [rng.choice(some) for _ in range(rng.randrange(12))]) for i in range(1500)] + [(-1, None)]
    encoded = spark.createDataFrame(rows, "doc_id long, ids array<long>")
    got = {r["doc_id"]: r["decoded"] for r in decode_ids(encoded).collect()}
    assert got == {i: library.decode(ids or []) for i, ids in rows}


def merged(text: str, scores: dict[str, float]) -> list[str]:
    parts = list(text)
    while True:
        best = max(
            ((scores[parts[i] + parts[i + 1]], -i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in scores),
            default=None,
        )
        if best is None:
            return parts
        i = -best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("seed", range(12))
def test_any_vocabulary_by_brute_force(seed):
    """Random scores: ties, merges that undo no order of ranks, pieces that are never reached."""
    rng = random.Random(seed)
    pieces = {"".join(rng.choice("abc") for _ in range(rng.randrange(2, 6))) for _ in range(25)} | {"a", "b"}
    scores = {p: -float(rng.randrange(12)) for p in sorted(pieces)}
    names = ["<unk>", *sorted(pieces)]
    ids = {p: i for i, p in enumerate(names)}
    encoder = PrefixEncoder(Vocabulary(names, scores, {p: ids[p] for p in pieces}, [], 0, frozenset()), 50)
    for _ in range(300):
        text = "".join(rng.choice("abcd") for _ in range(rng.randrange(14)))
        raw = [ids.get(p, 0) for p in merged(text, scores)]
        assert encoder.encode(text) == [x for i, x in enumerate(raw) if x or i == 0 or raw[i - 1]], text


def test_model_is_encoded_by_undoing_merges(words):
    encoder = PrefixEncoder(words)
    assert encoder.ordered and encoder.cuttable
    assert np.all(np.array(encoder.out) > 258)


def test_invalid_bytes_become_single_marks(words):
    def decode(*ids):
        return PieceDecoder(words).decode(np.array(ids), np.array([0, len(ids)]))[0]

    assert decode(3 + 0xE2, 3 + 0x96) == "��" and decode(3 + 0xE2, 3 + 0x96, 3 + 0x81) == SPACE


def test_repeats_nulls_clashing_names_and_empty_table(spark, docs):
    table = docs([(None, "a b"), (1, "a b"), (1, "a b"), (2, None)]).withColumnRenamed("size", "ids")
    got = sorted(codec_digests(table).collect(), key=str)
    assert [r["n_tokens"] for r in got].count(2) == 3 and len(got) == 4
    empty = next(r for r in got if r["doc_id"] == 2)
    assert empty["n_tokens"] == 0
    assert empty["ids_sha256"] == empty["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert codec_digests(docs([])).count() == 0
