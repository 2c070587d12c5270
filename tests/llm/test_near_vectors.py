"""Near-duplicate embeddings against brute force on small tables."""

from __future__ import annotations

import numpy as np
import pytest

from campusloom.llm import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id string, links long"


def by_hand(rows: list[tuple], threshold: float = 0.98) -> dict:
    known = {}
    for vec_id, v, label in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        known[vec_id] = (label, np.asarray(v, np.float32).astype(float)) if ok and label is not None else None
    links: dict = {i: set() for i in known}
    for a, x in known.items():
        for b, y in known.items():
            if a != b and x and y and x[0] == y[0] and len(x[1]) == len(y[1]) and x[1] @ y[1] / np.sqrt(x[1] @ x[1]) / np.sqrt(y[1] @ y[1]) >= threshold:
                links[a].add(b)
    low = {}
    for start in sorted(links):
        todo = [start] if start not in low else []
        while todo:
            low[(i := todo.pop())] = start
            todo += [x for x in links[i] if x not in low]
    return {i: (len(links[i]), low[i], low[i] == i) for i in links}


def frame(spark, rows: list[tuple]):
    plain = [(i, None if v is None else [None if x is None else float(x) for x in v], label, "clash", 7) for i, v, label in rows]
    return spark.createDataFrame(plain, SCHEMA)


def result(df) -> dict:
    got = df.collect()
    assert len({r.vec_id for r in got}) == len(got)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}


def clustered(seed: int, dim: int, n: int) -> list[tuple]:
    """Centres with copies at all distances around the threshold, a third of all under one label."""
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        centre, label = rng.standard_normal(dim), int(rng.choice([0, 0, 0, 1, 2]))
        for _ in range(int(rng.integers(1, 9))):
            v = centre + rng.standard_normal(dim) * np.linalg.norm(centre) * rng.uniform(0, 0.35) / np.sqrt(dim)
            rows.append((int(rng.integers(10**9)), (v * rng.uniform(0.1, 50)).astype(np.float32), label))
    return rows


@pytest.mark.parametrize(("dim", "block_rows"), [(64, 2048), (64, 23), (8, 64), (2, 50), (1, 64)])
def test_equals_brute_force(spark, dim, block_rows):
    rows = clustered(dim, dim, 400)
    got = result(near_vectors.near_duplicates(frame(spark, rows).repartition(3), block_rows=block_rows))
    assert got == by_hand(rows)
    assert any(n for n, _, _ in got.values())


def test_large_group_of_near_and_exact_copies(spark):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(32)
    rows = [(k, centre if k % 3 else centre + rng.standard_normal(32) * 0.02, 1) for k in range(1200)]
    rows += [(5000 + k, rng.standard_normal(32), 1) for k in range(300)]
    assert result(near_vectors.near_duplicates(frame(spark, rows), block_rows=100)) == by_hand(rows)


def test_nulls_zeros_and_unusable_components(spark):
    a = [1.0, 2.0, 3.0]
    rows = [(1, a, 1), (2, a, 1), (3, a, 2), (4, a, None), (5, a, None), (6, None, 1), (7, [0.0, 0.0, 0.0], 1), (8, [0.0, 0.0, 0.0], 1)]
    rows += [(9, [1.0, None, 3.0], 1), (10, [1.0, float("nan"), 3.0], 1), (11, [1.0, float("inf"), 3.0], 1), (12, [], 1), (13, [1.0, 2.0], 1), (14, [1.0, 2.0], 1), (15, [2.0, 4.0, 6.0], 1), (16, [-1.0, -2.0, -3.0], 1)]
    got = result(near_vectors.near_duplicates(frame(spark, rows)))
    assert got == by_hand(rows) and got[1] == (2, 1, True) and got[15] == (2, 1, False) and got[14] == (1, 13, False)


def test_repeated_and_null_ids(spark):
    rows = [(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, None, 1), (2, [1.0, 0.01], 1), (2, [1.0, 0.01], None)]
    assert result(near_vectors.near_duplicates(frame(spark, rows))) == {1: (1, 1, True), 2: (1, 1, False)}


def test_empty_table(spark):
    assert result(near_vectors.near_duplicates(frame(spark, []))) == {}
    assert result(near_vectors.near_duplicates(frame(spark, [(1, None, None)]))) == {1: (0, 1, True)}


def test_estimates_are_unbiased_and_bounds_hold():
    """Over random pairs at one cosine: the mean estimate is the cosine, and errors stay within the stated deviations."""
    rng = np.random.default_rng(6)
    dim, cosine, n = 48, 0.98, 4000
    x = near_vectors.scaled(rng.standard_normal((n, dim)))
    y = rng.standard_normal((n, dim))
    y = near_vectors.scaled(y - (y * x).sum(1, keepdims=True) * x)
    y = cosine * x + np.sqrt(1 - cosine**2) * y
    _, factor, _ = near_vectors.encoded(x, 3, 4)
    turn = near_vectors.rotation(dim, 0)
    estimate = (np.where(x @ turn.T >= 0, 1, -1) / np.sqrt(dim) * (y @ turn.T)).sum(1) / factor
    deviation = np.sqrt(1 - cosine**2) * np.sqrt(1 - factor**2) / factor / np.sqrt(dim - 1)
    assert abs(estimate.mean() - cosine) < 4 * deviation.mean() / np.sqrt(n)
    assert 0.9 < ((estimate - cosine) / deviation).std() < 1.1
    assert (estimate + 6 * deviation >= cosine).all()


def test_bands_follow_the_number_of_vectors():
    for n in (1, 1000, 10**6, 10**9):
        bits, bands = near_vectors.bands_for(n, 0.98, 1e-7)
        same = (1 - np.arccos(0.98) / np.pi) ** bits
        assert (1 - same) ** bands <= 1e-7 and n / 2**bits <= 256
