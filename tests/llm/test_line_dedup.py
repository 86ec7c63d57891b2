from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import WORD
from stratalake.llm.line_dedup import LineDedupParams, banded_distance, dedup_lines, dedup_report
from stratalake.llm.queries import QUERIES

PARAMS = LineDedupParams()


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _edit(text, k, rng):
    chars = list(text)
    for _ in range(k):
        i = rng.randrange(len(chars) + 1)
        kind = rng.choice("ids")
        if kind == "i":
            chars.insert(i, rng.choice("abcé😀 "))
        elif i < len(chars):
            if kind == "d":
                chars.pop(i)
            else:
                chars[i] = rng.choice("abcé ")
    return "".join(chars)


def _brute(rows):
    """Dropped line numbers of every row: rows with unique ids."""
    place = lambda i: (i is None, i or 0)
    seen = [
        (place(i), k, line) for i, text in rows for k, line in enumerate((text or "").split("\n"))
        if text is not None and len(line) >= PARAMS.min_chars
    ]
    first = {}
    for at in sorted(seen, key=lambda x: x[:2]):
        first.setdefault(at[2], at[:2])
    lines = list(first)
    stays = {
        a for a in lines
        if not any(abs(len(a) - len(b)) <= 2 and first[b] < first[a] and _distance(a, b) <= 2 for b in lines if a != b)
    }
    return {
        i: [
            k for k, line in enumerate((text or "").split("\n"))
            if text is not None and len(line) >= PARAMS.min_chars and not (line in stays and first[line] == (place(i), k))
        ]
        for i, text in rows
    }


def _corpus(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab cdé") for _ in range(rng.randrange(20, 60))) for _ in range(50)]
    rows = []
    for i in range(70):
        lines = [_edit(rng.choice(base), rng.choice([0, 0, 1, 2, 2, 3]), rng) for _ in range(rng.randrange(7))]
        rows.append((i, "\n".join(lines)))
    rows += [(None, rows[3][1]), (900, None), (901, ""), (902, "\n\n"), (-5, rows[4][1]), (2**62, rows[5][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("tau", [1, 2, 3])
def test_banded_distance(spark, tau):
    rng = random.Random(tau)
    rows = [("", ""), ("a", ""), ("ab", ""), ("abcde", "")]
    for _ in range(300):
        a = "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 40)))
        b = _edit(a, rng.randrange(6), rng)
        rows.append((a, b) if len(a) >= len(b) else (b, a))
    table = spark.createDataFrame(rows, "a string, b string")
    got = table.select("a", "b", banded_distance(F.col("a"), F.col("b"), tau).alias("d")).collect()
    assert all(r["d"] == min(_distance(r["a"], r["b"]), tau + 1) for r in got)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_report_equals_brute_force(spark, docs, seed):
    rows = _corpus(seed)
    got = {r["doc_id"]: r for r in dedup_report(docs(rows)).collect()}
    expected = _brute(rows)
    assert {i: list(r["dropped_lines"]) for i, r in got.items()} == expected
    assert sum(map(len, expected.values())) > 20
    for i, text in rows:
        assert got[i]["n_lines"] == (0 if text is None else text.count("\n") + 1)


def test_texts_without_the_dropped_lines(spark, docs):
    rows = _corpus(4)
    table, dropped = docs(rows), _brute(rows)
    got = Counter((r["doc_id"], r["text"]) for r in dedup_lines(table).collect())
    expected = Counter()
    for i, text in rows:
        if not dropped[i]:
            expected[i, text] += 1
        elif WORD.search(left := "\n".join(x for k, x in enumerate(text.split("\n")) if k not in dropped[i])):
            expected[i, left] += 1
    assert got == expected
    assert dedup_lines(table).columns == table.columns


def test_rows_without_an_id_are_documents_of_their_own(spark, docs):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefgh ij") for _ in range(40)) for _ in range(40)]
    rows = [(i if i % 3 else None, "\n".join(rng.choice(base) for _ in range(5))) for i in range(60)]
    rows += [(None, rows[0][1])] * 3 + [(2, base[0]), (2, f"{base[1]}\n{base[0]}")]
    lines = Counter(x for _, text in rows for x in text.split("\n"))
    left = Counter(x for r in dedup_lines(docs(rows)).collect() for x in r["text"].split("\n"))
    assert left == Counter(list(lines))
    report = dedup_report(docs(rows)).collect()
    assert Counter(r["doc_id"] for r in report) == Counter(i for i, _ in rows)
    assert sum(r["n_dropped"] for r in report) == sum(lines.values()) - len(lines)
    only = [(None, "\n".join(base[:3]))] * 5
    assert sorted(r["n_dropped"] for r in dedup_report(docs(only)).collect()) == [0, 3, 3, 3, 3]
    assert [r["text"] for r in dedup_lines(docs(only)).collect()] == [only[0][1]]


def test_short_lines_repeat_in_the_queries(spark, docs, tmp_path):
    rows = [(i, f"Home\n \nMenu\nHome\nown {i}") for i in range(5)] + [(9, "Home\nMenu"), (10, " \n"), (None, "Menu")]
    folder = str(tmp_path / "in")
    docs(rows).write.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: r["dropped_lines"] for r in QUERIES["op8_line_dedup"](spark, folder).collect()}
    assert got == {0: [3], **{i: [0, 2, 3] for i in range(1, 5)}, 9: [0, 1], 10: [], None: [0]}
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs(rows), folder).collect()}
    assert left == {0: "Home\n \nMenu\nown 0", **{i: f" \nown {i}" for i in range(1, 5)}, 10: " \n"}
    assert all(not r["n_dropped"] for r in dedup_report(docs([(1, "Home"), (2, "Home")])).collect())


def test_repeats_long_texts_and_empty_table(spark, docs):
    line = "a line that is long enough to be compared"
    many = "\n".join(f"{k:07d} another line of a very long text {k:07d}" for k in range(0, 3_000_000, 1000))
    rows = [(1, line), (1, line), (2, f"{line}\nshort"), (3, line), (4, many), (5, line * 2000), (6, "x" + line * 2000)]
    got = Counter((r["doc_id"], r["text"]) for r in dedup_lines(docs(rows)).collect())
    assert got[1, line] == 2 and got[2, "short"] == 1 and (3, line) not in got
    assert got[5, line * 2000] == 1 and not any(i == 6 for i, _ in got)
    assert dedup_lines(docs([])).count() == 0 and dedup_report(docs([])).count() == 0


def test_no_python_in_the_plan(spark, docs):
    for table in (dedup_report(docs(_corpus(1)[:5])), dedup_lines(docs(_corpus(1)[:5]))):
        plan = table._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
