from __future__ import annotations

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from stratalake.llm.components import components
from stratalake.llm.queries import QUERIES
from stratalake.sources.staging import Staging

CONTRACT = {
    "op1_source_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op3_ngram_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op4_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op5_warc_round_trip": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op7_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op9_embedding_near_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op10_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op11_turn_repair": [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    ],
    "op12_tokenizer_alignment": [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    ],
    "op13_piece_codec": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
}


def test_queries_return_the_columns_of_their_contract(spark):
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    for name, columns in CONTRACT.items():
        assert QUERIES[name](spark, "/root/testdata/sf0.001").columns[: len(columns)] == columns


def test_stages(spark, docs, tmp_path):
    shared = "this is a line that several documents hold, word by word"
    texts = {
        1: f"first text of all, which is long and has words\n{shared}\nend one", 2: f"second has other words and some more of them\n{shared}",
        3: "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon",
        4: "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau phi",
        5: "1234 5678", 6: None, 7: "", 8: shared, 9: "short",
    }
    table = docs([(i, t, "en", "ab"[i % 2]) for i, t in texts.items()])
    after = {}
    frame = table
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, frame, "unused").write.parquet(out)
        frame = after[name] = spark.read.parquet(out)
        if name != "packing":
            assert frame.columns == table.columns
    ids = {n: Counter(r["doc_id"] for r in f.collect()) for n, f in after.items()}
    assert set(ids["language_id"]) == {1, 2, 3, 4, 8, 9}
    assert set(ids["line_dedup"]) == {1, 2, 3, 4, 9}
    lines = {r["doc_id"]: r["text"] for r in after["line_dedup"].collect()}
    assert lines[2] == texts[2].split("\n")[0] and lines[1] == texts[1]
    assert set(ids["ngram_join"]) == {1, 2, 3, 9}
    assert set(ids["source_mix"]) <= {1, 2, 3, 9} and max(ids["source_mix"].values()) <= 2
    packed = after["packing"].collect()
    assert Counter(r["doc_id"] for r in packed) == ids["source_mix"]
    used = defaultdict(int)
    for r in packed:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048


@pytest.mark.parametrize("lang", [None, "und"])
def test_language_stage_drops_only_texts_without_a_letter(spark, docs, lang):
    texts = {1: "the dog", 2: "é", 3: "123 !!", 4: None, 5: "", None: "a cat"}
    left = corpus_pipeline.language_id(spark, docs([(i, t, lang) for i, t in texts.items()]), "unused")
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {1: "the dog", 2: "é", None: "a cat"}


@pytest.mark.parametrize("kind", ["path", "star", "two", "none"])
def test_components(spark, kind):
    pairs = {
        "path": [(i, i + 1) for i in range(60)], "star": [(99, i) for i in range(60)],
        "two": [(1, 2), (2, 1), (3, 3), (5, 4), (2, 7)], "none": [(3, 3)],
    }[kind]
    expected = {"path": {0: 61}, "star": {0: 61}, "two": {1: 3, 4: 2}, "none": {}}[kind]
    links = spark.createDataFrame(pairs, "a long, b long")
    got = components(links, "a", "b", Staging(spark)).collect()
    assert Counter(r["component"] for r in got) == expected
    assert len({r["node"] for r in got}) == len(got)


def test_empty_corpus(spark, docs):
    frame = docs([])
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, "unused")
        assert frame.count() == 0


def test_columns_with_helper_names_pass_unchanged(spark, docs):
    names = ["_text", "_row", "_kept", "_nth", "_copies", "_row_key", "_language", "_posterior", "carried", "_kept_id", "c0", "a.b"]
    plain = docs([(i, f"words of text number {i}, " * (i + 3), "en", "ab"[i % 2]) for i in range(8)])
    table = plain.selectExpr("*", *[f"concat('{n}', cast(doc_id as string)) as `{n}`" for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, "unused")
        assert out.columns == table.columns, name
        rows = out.collect()
        assert rows, name
        for r in rows:
            assert [r[n] for n in names] == [f"{n}{r['doc_id']}" for n in names], name
            assert (r["n_chars"], r["lang_pred"], r["keep"]) == (1, "x", True), name
