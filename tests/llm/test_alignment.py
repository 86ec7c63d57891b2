from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from stratalake.llm.alignment import (
    AlignParams, Fragment, align_documents, byte_level_letters, compose, default_tokenizer, fragments_of, reduce_tree,
)
from stratalake.llm.piece_codec import default_model
from stratalake.llm.queries import QUERIES
from stratalake.sources.staging import Staging

COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
# Every document is long, every pair is rare.
TINY = AlignParams(part_bytes=40, fragment_bytes=7, fan_in=2, frequent_pairs=0, cached_spans=50, counted_pairs=30)


@pytest.fixture(scope="module")
def expected():
    """The libraries over whole texts, and links by comparing all byte ranges."""
    first = Tokenizer.from_file(default_tokenizer())
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=default_model())
    letters = byte_level_letters()

    def piece(i):
        name = second.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if second.is_byte(i) else name.replace("▁", " ").encode()

    def ranges(raw):
        ends = np.cumsum([0, *map(len, raw)]).tolist()
        return list(zip(ends, ends[1:]))

    def one(text):
        if not text:
            return None
        whole = " " + text
        a, b = first.encode(whole, add_special_tokens=False).ids, second.encode(text)
        raw = [[bytes(letters[c] for c in first.id_to_token(i)) for i in a], [piece(i) for i in b]]
        if any(b"".join(r) != whole.encode() for r in raw):
            return None
        (at_a, at_b), links, i = map(ranges, raw), [], 0
        for s, e in at_a:
            while at_b[i][1] <= s:
                i += 1
            links += [(s, j) for j in range(i, len(at_b)) if at_b[j][0] < e] if len(at_b) < 300 else []
            if len(at_b) >= 300:
                j = i
                while j < len(at_b) and at_b[j][0] < e:
                    links.append((s, j))
                    j += 1
        of_start = {s: x for (s, _), x in zip(at_a, a)}
        pairs = [(of_start[s], b[j]) for s, j in links]
        cuts = sorted({e for _, e in at_a} & {e for _, e in at_b})
        groups, low = [], 0
        ka = kb = 0
        for cut in cuts:
            ja, jb = ka, kb
            while ka < len(a) and at_a[ka][1] <= cut:
                ka += 1
            while kb < len(b) and at_b[kb][1] <= cut:
                kb += 1
            groups.append(",".join(map(str, a[ja:ka])) + "|" + ",".join(map(str, b[jb:kb])))
            low = cut
        assert low == len(whole.encode())
        return len(a), len(b), groups, pairs

    def run(rows):
        found = [(i, one(t)) for i, t in rows]
        count = Counter(p for _, x in found if x for p in x[3])
        most = {}
        for (_, b), n in count.items():
            most[b] = max(most.get(b, 0), n)
        return sorted(
            ((i, 0, 0, 0, 0, 0, 0, "") if x is None else (
                i, x[0], x[1], len(x[2]), len(x[3]), sum(count[p] == most[p[1]] for p in x[3]),
                sum(count[p] for p in x[3]), hashlib.sha256(";".join(x[2]).encode()).hexdigest(),
            ) for i, x in found), key=str,
        )

    return run


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", *COLUMNS).collect()), key=str)


PARTS = [
    "the", "é", "日本", "한글", "😀", " ", "  ", "   ", "\n", "a", "ing", "\x00", "ℵ", ".", "'s", "'", "1", "23", "\t",
    "\r\n", ";\r", "er", " t", "　", "\xa0", " " * 17, "<|endoftext|>", "</s>", "<0x41>", "\x1c", " ", " ", "…", "“x”",
]


@pytest.mark.parametrize("params", [AlignParams(), TINY, AlignParams(frequent_pairs=40, part_bytes=100)])
def test_any_texts_by_brute_force(spark, docs, expected, params):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randrange(40)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, " "), (903, "a ▁ b"), (904, "a ▁ b" * 50), (None, "the cat"), (None, "the cat")]
    rows += [(7, rows[0][1]), (905, "x" * 300), (905, "x" * 300), (906, "word " * 200), (907, "\n" * 120)]
    assert got(align_documents(docs(rows), params=params)) == expected(rows)


def test_query_on_documents(spark, expected):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    assert got(QUERIES["op12_tokenizer_alignment"](spark, "/root/testdata/sf0.001")) == expected(rows)


def test_long_documents_are_one_piece_of_work_with_short_ones(spark, docs, expected):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(PARTS) * rng.randrange(1, 4) for _ in range(3_000))) for i in range(3)]
    params = AlignParams(part_bytes=2_000, fragment_bytes=333, fan_in=3)
    assert got(align_documents(docs(rows), params=params)) == expected(rows)


def same(x: Fragment, y: Fragment) -> bool:
    return all(np.array_equal(getattr(x, c), getattr(y, c)) for c in ("a", "b", "cut_a", "cut_b"))


def test_fragments_are_a_monoid():
    rng = np.random.default_rng(7)
    size = np.arange(1, 9)
    for _ in range(200):
        a = rng.integers(0, 8, rng.integers(1, 30))
        b_size, left = [], int(size[a].sum())
        while left:
            b_size.append(int(min(left, rng.integers(1, 9))))
            left -= b_size[-1]
        b = np.array(b_size) - 1
        whole = fragments_of(a, b, size, size, 10**6)
        parts = fragments_of(a, b, size, size, int(rng.integers(1, 12)))
        assert len(whole) == 1 and same(compose(parts), whole[0])
        left, right = Fragment.empty(), Fragment.empty()
        for f in parts:
            left = left + f
        for f in reversed(parts):
            right = f + right
        assert same(left, right) and same(left, whole[0])
        # Nothing is lost between prefix, closed groups and suffix.
        for f in parts:
            inner = f.closed
            assert f.prefix[0] + [x for g in inner for x in g[0]] + f.suffix[0] == f.a.tolist()
            assert f.prefix[1] + [x for g in inner for x in g[1]] + f.suffix[1] == f.b.tolist()
        assert whole[0].suffix == ([], [])


def test_tree_composes_in_order(spark):
    rows = [
        (k, no, True, *(np.array(v, dtype=d).tobytes() for v, d in (([no % 100], "<u2"), ([k], "<u2"), ([1], "<i4"), ([1], "<i4"))))
        for k in (1, 2) for no in range(0, 70 * k, 7)
    ]
    table = spark.createDataFrame(rows, "key long, no long, valid boolean, a binary, b binary, cut_a binary, cut_b binary")
    with Staging(spark) as staging:
        whole = {r["key"]: r for r in reduce_tree(table, AlignParams(fragment_bytes=7, fan_in=2), staging).collect()}
    for k in (1, 2):
        assert np.frombuffer(whole[k]["a"], "<u2").tolist() == [no % 100 for no in range(0, 70 * k, 7)]
        assert np.frombuffer(whole[k]["cut_b"], "<i4").tolist() == list(range(1, 10 * k + 1))


def test_clashing_names_and_empty_table(spark, docs):
    table = docs([(1, "a b"), (None, None)]).withColumnsRenamed({"size": "row", "score": "copies", "keep": "key"})
    assert [r["n_a"] for r in align_documents(table).orderBy("doc_id").collect()] == [0, 2]
    assert align_documents(docs([])).count() == 0
