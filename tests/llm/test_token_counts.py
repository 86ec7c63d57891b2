from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from stratalake.llm.textscan import chunks
from stratalake.llm.token_counts import (
    SegmentCounts,
    TokenCountParams,
    UnigramCounter,
    count_tokens,
    default_model,
    read_pieces,
)


@pytest.fixture(scope="module")
def reference():
    """The tokenizers library over the same pieces."""
    special = [("<unk>", 0.0)] + [(f"<0x{i:02X}>", 0.0) for i in range(256)]
    out = Tokenizer(models.Unigram([*special, *read_pieces(default_model())], unk_id=0, byte_fallback=True))
    out.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return out


def test_counts_equal_the_library(spark, docs, reference):
    rng = random.Random(2)
    parts = ["the", "é", "日本", "한글", "😀", " ", "  ", "\n", "▁", "a", "ing", "\x00", "Ω", "ữ", "ℵ", ".", ",", "1", "тест"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(400)]
    texts += ["", " ", "  ", "▁", " a", "a ", None, "word " * 30_000, "x" * 3000]
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(docs(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        assert got[i] == len(reference.encode(text or "", add_special_tokens=False).ids), repr(text)[:60]


def test_counts_on_documents(spark, reference):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    params = TokenCountParams(cached_segments=3000)
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(table, params=params).collect()}
    for r in table.collect():
        assert got[r["doc_id"]] == len(reference.encode(r["text"] or "", add_special_tokens=False).ids)


def test_ties_go_to_the_longer_first_piece():
    counter = UnigramCounter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("c", -1.0)])
    assert counter.count("abc") == 2


def test_repeats_nulls_and_empty_table(spark, docs):
    got = count_tokens(docs([(None, "a"), (1, "a"), (1, "a")])).collect()
    assert [r["n_tokens"] for r in got] == [1, 1, 1]
    assert count_tokens(docs([])).count() == 0


RUNS = TokenCountParams(space_runs=True)


@pytest.fixture(scope="module")
def unsplit(reference):
    """The library without a cut before every space."""
    out = Tokenizer.from_str(reference.to_str())
    out.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)
    return out


def test_runs_of_spaces_equal_the_library(spark, docs, unsplit):
    rng = random.Random(4)
    parts = ["the", "é", "日本", "😀", " ", "  ", "        ", "\n", "▁", "▁▁", "a", "ing", "x:", "\t", "тест", "    return y"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(400)]
    texts += ["", " ", "  ", " " * 200, "▁", None, "if x:\n    return y", "a" + " " * 8 + "b", "   a", "a   ", "x" * 3000]
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(docs(list(enumerate(texts))), params=RUNS).collect()}
    for i, text in enumerate(texts):
        assert got[i] == len(unsplit.encode(text or "", add_special_tokens=False).ids), repr(text)[:60]


@pytest.mark.parametrize("params", [RUNS, TokenCountParams()])
def test_long_texts_are_cut_without_a_difference(params):
    rng = random.Random(5)
    counts = SegmentCounts(default_model(), params)
    parts = ["word", "x" * 50, " ", "  ", "      ", "日本", "\n", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    texts += [" " * 300, "x" * 300, "é" * 150 + " a", "ab " * 100]
    for text in texts:
        (chunk,) = chunks(pa.array([text]))
        assert list(counts.of_chunk(chunk, long=16)) == list(counts.of_chunk(chunk)), repr(text)


def test_blocks_give_the_same_count():
    rng = random.Random(6)
    counter = UnigramCounter(read_pieces(default_model()))
    for _ in range(100):
        text = "".join(rng.choice(["ing", "▁", "the", "é", "😀", "ab", "interna"]) for _ in range(40))
        size = rng.randrange(1, 12)
        assert counter.count_blocks(text[i : i + size] for i in range(0, len(text), size)) == counter.count(text)


def test_a_long_text_without_a_space_needs_little_memory():
    counts = SegmentCounts(default_model(), RUNS)
    (chunk,) = chunks(pa.array(["abcdefghij" * 300_000]))
    tracemalloc.start()
    assert counts.of_chunk(chunk)[0] > 0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Beyond the text of 3 MB itself.
    assert peak < 20 << 20


def test_pieces_over_a_cut_are_refused(monkeypatch):
    monkeypatch.setattr("stratalake.llm.token_counts.read_pieces", lambda path: [("a▁b", -1.0)])
    with pytest.raises(ValueError):
        SegmentCounts("any", RUNS)
