"""Quality rules and the co-trained classifier."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from conftest import WORD
from stratalake.llm.quality_cotraining import CoTrainingParams, fit_logistic, score_documents
from stratalake.llm.quality_rules import QualityParams, estimate, judge_documents, rule_votes, text_counts


def _brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_stop_lines": sum(WORD.findall(x)[-1][-1] in ".!?" for x in lines),
        "n_distinct_words": len(set(words)),
    }


def _texts():
    rng = random.Random(7)
    parts = ["the", "a", "é", "日本", "x.", "|", "%%%", "\n", "\n\n", " ", "\t", "word", "word word word", "\x0b", "#*$", "😀", ".", "\r\n"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(200)]
    return [*texts, None, "", " ", "\n", "a", "a a a a", "a b a b a b", "x y z\nx y z\n x y z", "w " * 60_000, "\n".join(["same line"] * 500)]


def test_counts_equal_brute_force(spark, docs):
    texts = _texts()
    got = {r["doc_id"]: r for r in text_counts(docs(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        for name, value in _brute(text).items():
            assert got[i][name] == value, (name, text and text[:80])


def test_base_rule_and_contract(spark, docs):
    texts = _texts()
    rows = [*enumerate(texts), (None, "a b c"), (3, texts[3])]
    got = judge_documents(docs(rows)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed
        assert not (failed and r["kept"])
    assert judge_documents(docs([])).count() == 0


def test_estimates_find_the_accuracies_behind_the_votes():
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.75
    accuracy, silent = np.array([0.95, 0.9, 0.8, 0.7, 0.6]), 0.3
    right = rng.random((len(good), 5)) < accuracy
    votes = np.where(right == good[:, None], 1, -1)
    votes[rng.random(votes.shape) < silent] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = estimate(patterns, counts.astype(float))
    assert model.prior == pytest.approx(0.75, abs=0.04)
    found = model.votes[:, 1, 2] / (model.votes[:, 1, 2] + model.votes[:, 1, 0])
    assert found == pytest.approx(accuracy, abs=0.05)
    assert set(estimate(np.zeros((0, 5), int), np.zeros(0)).votes.ravel()) == {0.125, 0.375, 0.5}


def test_rules_keep_good_documents_and_catch_bad_ones(spark):
    folder = "/root/testdata/sf0.01"
    judged = judge_documents(spark.read.parquet(f"{folder}/documents.parquet"))
    rows = judged.join(spark.read.parquet(f"{folder}/labels.parquet").withColumnRenamed("quality", "label"), "doc_id").collect()
    good = [r for r in rows if r["label"] == 1 and not r["base_failed"]]
    bad = [r for r in rows if r["label"] == 0]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good)
    assert sum(r["kept"] for r in bad) <= 0.05 * len(bad)
    assert len(rule_votes()) <= 10


def test_threshold_is_a_parameter(spark, docs):
    rows = [(i, "The cat of the house is in a garden and was with me. " * 3 + f"It {i} ended." * 12) for i in range(5)]
    assert not any(r["kept"] for r in judge_documents(docs(rows), QualityParams(threshold=1.1)).collect())


# ---- co-training ----

def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    table = spark.read.parquet(f"{folder}/documents.parquet")
    got = score_documents(table, labels.where("doc_id % 3 <> 0"))
    held = got.join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    good, bad = [r for r in held if r["quality"] == 1], [r for r in held if r["quality"] == 0]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good)
    assert sum(r["kept"] for r in bad) <= 0.05 * len(bad)
    assert got.count() == table.count()


def test_views_and_odd_labels(spark, docs):
    rows = [(i, ("clean words of a text. " * 5) if i % 2 else ("j%% u## n$$ k|| " * 5)) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "clean words"), (3, rows[3][1]), (600, "w " * 50_000)]
    marks = [(i, i % 2) for i in range(60)] + [(1, 1), (1, 1), (7, None), (None, 1), (9999, 0), (5, 0), (5, 1), (5, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    got = score_documents(docs(rows), labels, CoTrainingParams(passed=10)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    assert all(0 <= r[c] <= 1 for r in got for c in ("text_score", "meta_score", "quality_score"))
    assert all(r["kept"] == bool(r["doc_id"] % 2) for r in got if r["doc_id"] is not None and r["doc_id"] < 120)


def test_too_few_labels(spark, docs):
    table = docs([(1, "a"), (2, None)])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["quality_score"] for r in score_documents(table, labels).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert {r["quality_score"] for r in score_documents(table, labels).collect()} == {1.0}
    assert score_documents(docs([]), labels).count() == 0


def test_logistic_fit():
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(size=4000), np.ones(4000)])
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1)))).astype(float)
    assert fit_logistic(x, y, np.ones(4000), 1e-3) == pytest.approx([2, -1], abs=0.2)


def test_one_round_by_brute_force(spark, docs):
    """What each view passes on and learns from it, with everything in one place."""
    from stratalake.llm import quality_cotraining as Q
    from stratalake.sources.staging import Staging

    rng = np.random.default_rng(3)
    rows = [
        (i if i % 3 else None, " ".join(rng.choice(["good", "words", "of", "the", "x%%", "##", "n$", "||"], rng.integers(3, 40))),
         str(rng.choice(["en", "de"])), str(rng.choice(["a", "b", "c"])))
        for i in range(400)
    ]
    # A group of copies, without ids, counts once.
    rows += [(None, "%% || %%", "en", "a")] * 300
    labels = spark.createDataFrame([(i, int("%" not in rows[i][1])) for i in range(0, 120)], "doc_id long, quality int")
    params = Q.CoTrainingParams(passed=50)
    with Staging(spark) as staging:
        features = staging.table(Q._with_buckets(Q.view_features(docs(rows)), params))
        marked = labels.selectExpr("doc_id", "quality as _y")
        free = staging.table(Q.distinct_vectors(features, marked))
        local = [r for r in features.collect() if r["doc_id"] is None or r["doc_id"] >= 120]
        vectors = {(tuple(r["text_view"]), tuple(r["layout"]), r["_source"], r["_lang"]) for r in local}
        assert free.count() == len(vectors) < len(local) - 290
        x = Q._gathered([dict(zip(Q._INPUTS, v)) for v in sorted(vectors)], params)
        views = Q._Views(rng.normal(size=x[0].shape[1]), rng.normal(size=x[1].shape[1]))
        raw = views.raw(x)
        scored = staging.table(Q._raw_scored(free, views, params))
        chosen = [staging.table(t) for t in Q.surest(scored, 0.05)]
        for view, table in enumerate(chosen):
            got = sorted((r[("text_raw", "meta_raw")[view]], r["_label"]) for r in table.collect())
            low, high = np.sort(raw[:, view])[[int(np.ceil(0.05 * len(raw))) - 1, int(np.ceil(0.95 * len(raw))) - 1]]
            want = sorted((v, float(v >= high)) for v in raw[:, view] if v <= low or v >= high)
            assert [g[1] for g in got] == [w[1] for w in want]
            assert [g[0] for g in got] == pytest.approx([w[0] for w in want])
            # The other view's Newton steps, in tasks and in one place.
            other = 1 - view
            mask = (raw[:, view] <= low) | (raw[:, view] >= high)
            y = (raw[mask, view] >= high).astype(float)
            base, label = x[other][:50], (np.arange(50) % 2).astype(float)
            apart = Q.fit_logistic(base, label, np.ones(50), 1.0, Q._elsewhere(table, other, params))
            whole = Q.fit_logistic(
                np.concatenate([base, x[other][mask]]), np.concatenate([label, y]),
                np.concatenate([np.ones(50), np.full(len(y), params.passed_weight)]), 1.0,
            )
            assert apart == pytest.approx(whole, abs=1e-6)


def test_sample_of_labelled_documents(spark, docs):
    """Bounded by a threshold, not by an order; one document with very many rows is one of them."""
    from stratalake.llm import quality_cotraining as Q

    rows = [(i, f"words {i} " * (i % 7 + 1)) for i in range(2000)] + [(5, "the same")] * 900
    marked = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id long, _y int")
    params = Q.CoTrainingParams(max_labelled=300)
    features = Q._with_buckets(Q.view_features(docs(rows)), params)
    sample = Q._sample(features, marked, params)
    assert 230 <= len(sample) <= 330
    assert [r["doc_id"] for r in sample] == [r["doc_id"] for r in Q._sample(features, marked, params)]
    assert len(Q._sample(features, marked, Q.CoTrainingParams())) == 2001
