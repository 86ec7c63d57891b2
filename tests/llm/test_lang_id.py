from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest

from stratalake.llm.lang_id import LangIdParams, identify, identify_documents, train

SMALL = LangIdParams(buckets=512)


def _mix(x):
    m = (1 << 64) - 1
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & m
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & m
    return x ^ x >> 31


def _buckets(text, params):
    codes, last = [], None
    for ch in text:
        low = ch.lower()
        code = (ord(low) if len(low) == 1 else ord(ch)) if ch.isalpha() else 32
        if code != 32 or (last is not None and last != 32):
            codes.append(code)
        last = code
    out = []
    for order in params.orders:
        for i in range(len(codes) - order + 1):
            if order > 1 or codes[i] != 32:
                value = order
                for c in codes[i : i + order]:
                    value = (value * 0x200005 + c) & (1 << 64) - 1
                out.append(_mix(value) % params.buckets)
    return out


def _brute(train_rows, texts, params):
    counts, n = {}, Counter()
    for text, lang in train_rows:
        if lang is not None:
            counts.setdefault(lang, Counter()).update(_buckets(text or "", params))
            n[lang] += 1
    out = []
    for text in texts:
        if not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0))
            continue
        logs = {}
        for lang, own in counts.items():
            total = sum(own.values()) + params.smoothing * params.buckets
            logs[lang] = math.log(n[lang] / sum(n.values())) + sum(
                math.log((own[b] + params.smoothing) / total) for b in _buckets(text, params)
            )
        best = max(sorted(logs), key=lambda k: logs[k])
        out.append((best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())))
    return out


TEXTS = [
    "The cat and the dog", "Der Hund und die Katze", "le chat et le chien", "Äpfel über Öl!", "ÉTÉ à la mer",
    "", None, "123 !!", "a", "\n\n the\tthe", "the " * 5000, "İstanbul ﬁn", "\U0001d4d0 x",
]
TRAIN = [
    (1, "the dog and the cat ran with them", "en"), (2, "der Hund und die Katze liefen", "de"),
    (3, "le chien et le chat dans la mer", "fr"), (4, None, "en"), (5, "nothing", None),
    (6, "the dog and the cat ran with them", "en"),
]


def test_equals_brute_force(spark, docs):
    model = train(docs(TRAIN), "text", "lang", SMALL)
    assert model.languages == ["de", "en", "fr"]
    rows = identify(docs(list(enumerate(TEXTS))), model).orderBy("doc_id").collect()
    expected = _brute([(t, lang) for _, t, lang in TRAIN], TEXTS, SMALL)
    assert [r["lang_pred"] for r in rows] == [e[0] for e in expected]
    assert [r["score"] for r in rows] == pytest.approx([e[1] for e in expected], abs=1e-9)
    assert rows[0]["keep"] is True and rows[0]["size"] == 2


def test_nothing_to_learn_and_empty_tables(spark, docs):
    model = train(docs([(1, "abc", None)]), "text", "lang", SMALL)
    got = identify(docs([(1, "abc"), (2, None)]), model).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    assert identify_documents(docs([]), SMALL).count() == 0


def test_too_many_languages_are_refused(spark, docs):
    rows = [(i, "abc", f"l{i}") for i in range(4)]
    with pytest.raises(ValueError, match="languages"):
        train(docs(rows), "text", "lang", LangIdParams(buckets=512, max_languages=3))


def test_held_out_accuracy_and_folds(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify_documents(table).join(table.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == table.count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"] and r["lang"] is not None]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)


def test_null_ids_are_predicted_but_not_learned_from(spark, docs):
    got = identify_documents(docs([(None, "the dog", "xx"), *TRAIN]), SMALL).collect()
    assert len(got) == len(TRAIN) + 1
    assert "xx" not in {r["lang_pred"] for r in got}
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
