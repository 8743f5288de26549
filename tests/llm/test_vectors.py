import numpy as np
import pytest

from quotewell.llm import vectors
from quotewell.llm.graph import local_components


def sample(rng, n, d):
    base = rng.normal(size=(6, d))
    rows = [base[k % 6] + rng.normal(size=d) * (0.05 if k % 2 else 0.4) for k in range(n)]
    return [list(map(float, np.float32(r))) for r in rows]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_like_brute_force(spark, kind):
    rng = np.random.default_rng(4)
    rows = [(k, v) for k, v in enumerate(sample(rng, 300, 8))]
    rows += [(1000 + k, rows[0][1]) for k in range(40)]  # a large group of copies
    rows += [(2000, None), (2001, [0.0] * 8), (2002, [float("nan")] * 8), (2003, [float("inf")] + [1.0] * 7), (2004, [None] + [1.0] * 7)]
    rows += [(2005, []), (2006, [1.0, 0.0]), (2007, [1.0, 0.001]), (2008, [-1.0, 0.0]), (3, rows[3][1]), (None, rows[0][1])]
    rows += [(2009, [9.0, 4.0, 1.0, 1.0, 1.0]), (2010, [1.0, 0.0, 0.0, 0.0, 0.0]), (2011, [5e37, 0.0, 0.0, 0.0, 0.0])]  # 0.9 exactly
    df = spark.createDataFrame([(i, v, 1, 2, 0.5) for i, v in rows], f"vec_id long, embedding array<{kind}>, n int, dim int, lead double")
    out = vectors.near_duplicates(df, chunk=64, ranges=4).collect()
    assert len(out) == len(rows)
    cast = np.float32 if kind == "float" else np.float64
    good = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(v) for _, v in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            if good[a] and good[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], cast).astype(float) for k in (a, b))
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.9:
                    links.append((a, b))
    i, j = np.array(links).T
    count = np.bincount(np.concatenate([i, j]), minlength=len(rows))
    labels = local_components(len(rows), i, j)
    least = {}
    for (v, _), c in zip(rows, labels):
        least[c] = min((x for x in (least.get(c), v) if x is not None), default=None)
    want = sorted((v is None, v or 0, int(n), least[c] or 0, v is not None and v == least[c]) for (v, _), n, c in zip(rows, count, labels))
    got = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in out)
    assert got == want


def test_no_rows_and_no_good_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert vectors.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    (row,) = vectors.near_duplicates(spark.createDataFrame([(7, None)], schema)).collect()
    assert (row["n_links"], row["component_id"], row["kept"]) == (0, 7, True)


def test_few_pairs_outlive_the_first_bound(monkeypatch):
    """What is multiplied pair by pair is a small part of all pairs, where vectors have no structure."""
    x = np.random.default_rng(7).normal(size=(1500, 64))
    x[700:710] = x[:10] + np.random.default_rng(8).normal(size=(10, 64)) * 0.05
    _, axes = np.linalg.eigh(vectors.unit(x).T @ vectors.unit(x))
    met, plain = [], np.einsum
    monkeypatch.setattr(vectors, "product_size", lambda a, b: float("inf"))
    monkeypatch.setattr(vectors.np, "einsum", lambda how, a, b: met.append(len(a)) or plain(how, a, b))
    found = {(int(p), int(q)) for i, j in vectors.linked_pairs(x, x, np.ascontiguousarray(axes[:, ::-1])) for p, q in zip(i, j)}
    u = vectors.unit(x)
    assert found == set(map(tuple, np.argwhere(u @ u.T >= 0.9).tolist()))
    assert sum(met) < 0.01 * len(x) ** 2
