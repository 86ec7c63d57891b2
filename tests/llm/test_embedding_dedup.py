from __future__ import annotations

import itertools

import numpy as np
import pytest

from stratalake.llm.embedding_dedup import LatticeParams, link_embeddings, nearest_e8, shortest_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, cid long, kind string, vector string"


def _table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)


def _brute(rows, similarity=0.98):
    ids, n = [r[0] for r in rows], len(rows)
    unit = []
    for _, v, label in rows:
        x = None if v is None or label is None or any(c is None for c in v) or not v else np.array(v, dtype=np.float32).astype(float)
        unit.append(x / np.linalg.norm(x) if x is not None and np.isfinite(x).all() and np.any(x) else None)
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(n), 2):
        if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]):
            if unit[i] @ unit[j] >= similarity:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i in range(n):
        least.setdefault(find(i), []).append(ids[i])
    return {ids[i]: (links[i], min(least[find(i)])) for i in range(n)}


def _near(rng, centre, noise):
    v = centre + noise * rng.normal(size=len(centre)) / np.sqrt(len(centre))
    return v.tolist()


def test_lattice_points():
    around = shortest_vectors()
    assert len({tuple(v) for v in around}) == 240 and ((around**2).sum(axis=1) == 2).all()
    assert (nearest_e8(around * 0.999) == around).all() and (nearest_e8(around * 0.4) == 0).all()
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, size=(200, 8))
    points = np.array([p for p in itertools.product((-1, 0, 1), repeat=8) if sum(p) % 2 == 0], dtype=float)
    halves = np.array([p for p in itertools.product((-1.5, -0.5, 0.5, 1.5), repeat=8) if sum(p) % 2 == 0])
    nearest = [min(((points - v) ** 2).sum(1).min(), ((halves - v) ** 2).sum(1).min()) for v in x]
    assert ((x - nearest_e8(x)) ** 2).sum(1) == pytest.approx(nearest)


@pytest.mark.parametrize("block", [256, 4])
def test_links_against_brute_force(spark, block):
    """Small blocks deal one cell out over many tasks."""
    rng = np.random.default_rng(block)
    rows = []
    for f in range(25):
        centre = rng.normal(size=64)
        for _ in range(int(rng.integers(1, 14))):
            rows.append((len(rows), _near(rng, centre, rng.choice([0, 0.05, 0.1, 0.15])), int(rng.integers(0, 2))))
    got = {r["vec_id"]: r for r in link_embeddings(_table(spark, rows), LatticeParams(block=block)).collect()}
    expected = _brute(rows)
    wanted = sum(n for n, _ in expected.values())
    assert wanted > 300
    assert sum(r["n_links"] for r in got.values()) >= 0.97 * wanted
    assert all(r["n_links"] <= expected[i][0] for i, r in got.items())
    same = [got[i]["component_id"] == c for i, (_, c) in expected.items()]
    assert sum(same) >= 0.97 * len(same)
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_recall_on_borderline_pairs(spark):
    rng = np.random.default_rng(6)
    rows = []
    for _ in range(300):
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b = rng.normal(size=64)
        b -= b @ a * a
        b /= np.linalg.norm(b)
        rows += [(len(rows), a.tolist(), 1), (len(rows) + 1, (0.9805 * a + np.sqrt(1 - 0.9805**2) * b).tolist(), 1)]
    got = sum(r["n_links"] for r in link_embeddings(_table(spark, rows)).collect())
    assert got >= 0.98 * sum(n for n, _ in _brute(rows).values())


def test_odd_rows(spark):
    v, w = [1.0] * 16, [1.0] * 15 + [1.1]
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0] * 16, 1), (4, [None, *v[1:]], 1), (5, [float("nan"), *v[1:]], 1),
        (6, [float("inf"), *v[1:]], 1), (7, v, None), (8, v, 2), (9, v, 1), (10, v, 1), (11, [2e-30] * 16, 1), (12, w, 1),
        (13, v[:8], 1), (14, v[:8], 1), (15, [-x for x in v], 1), (16, [3e37] * 16, 1),
    ]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in link_embeddings(_table(spark, rows)).collect()}
    assert got == _brute(rows)
    assert link_embeddings(_table(spark, [])).count() == 0


def test_many_copies_of_one_vector(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=64)
    copy = centre.tolist()
    rows = [(i, copy, 1) for i in range(300)] + [(300 + i, _near(rng, centre, 0.08), 1) for i in range(100)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in link_embeddings(_table(spark, rows), LatticeParams(block=16)).collect()}
    expected = _brute(rows)
    assert {c for _, c in got.values()} == {0}
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for n, _ in expected.values())
    assert all(n <= expected[i][0] for i, (n, _) in got.items())
