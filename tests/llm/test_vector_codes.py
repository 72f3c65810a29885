import hashlib
import math
import random
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from tallyspark.llm import vector_codes


def brute(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error, sha256) by the definition, in Python's whole numbers."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept or not kept[0][1] or len(kept[0][1]) % parts:
        return []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts
    whole = [[math.floor(Fraction(x) * 4096) for x in v] for _, v, _ in kept]
    cut = [[w[p * width : (p + 1) * width] for p in range(parts)] for w in whole]
    books = [[row[p] for row in cut[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        found = [[near(row[p], books[p])[1] for row in cut] for p in range(parts)]
        for p in range(parts):
            for k in range(len(books[p])):
                own = [row[p] for row, b in zip(cut, found[p]) if b == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], {}
    for (vec_id, _, label), row in zip(kept, cut):
        best = [near(row[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        by_label[label] = by_label.get(label, 0) + error
        out.append((vec_id, "".join(f"{k:02x}" for _, k in best), error, label))
    most = 2**63 - 1
    return [(i, code, min(most, e), min(most, by_label[lab]), sha) for i, code, e, lab in out]


def report(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, code string, error int")
    return sorted((tuple(r) for r in vector_codes.report(df).collect()), key=str)


def some(n=200, width=2, seed=1):
    rng = random.Random(seed)
    return [(k, [rng.gauss(k % 3, 0.3) for _ in range(8 * width)], rng.choice([1, 2, None])) for k in range(n)]


def test_equals_brute_force(spark):
    rows = some()
    rows += [(500, None, 1), (501, [1.0] * 15 + [None], 1), (502, [math.inf] * 16, 1), (503, [math.nan] * 16, 2), (504, [1.0] * 8, 2), (505, [], 2)]
    rows += rows[:3] + [(None, [0.5] * 16, None), (3, [0.25] * 16, 7)]
    assert report(spark, rows) == sorted(brute(rows), key=str)


def test_ties_and_equal_vectors(spark):
    rows = [(k, [float(k % 2)] * 8, 1) for k in range(40)]
    found = report(spark, rows)
    assert found == sorted(brute(rows), key=str)
    assert {r[1] for r in found} == {"00" * 8, "01" * 8}


def test_few_rows_and_no_rows(spark):
    assert report(spark, []) == []
    rows = [(1, [0.1] * 8, None), (2, [-0.3] * 8, None)]
    assert report(spark, rows) == sorted(brute(rows), key=str)
    assert report(spark, [(1, [1.0] * 7, 1)]) == []


def test_large_components_are_exact(spark):
    rng = random.Random(4)
    rows = [(k, [rng.choice([1e30, -1e30, 1e300, 3.5, -2.25, 2.0**40 + 0.75]) * rng.random() for _ in range(8)], k % 2) for k in range(40)]
    assert report(spark, rows) == sorted(brute(rows), key=str)


def test_grid_leaves_out_only_dominated_entries():
    rng = np.random.default_rng(2)
    for spread, width in ((5000, 8), (40, 3), (1, 1)):
        entries = rng.integers(-spread, spread + 1, (16, width))
        points = rng.integers(-2 * spread, 2 * spread + 1, (3000, width))
        grid = vector_codes.Grid(entries)
        apart = ((points[:, None] - entries[None]) ** 2).sum(2)
        best, error = grid.nearest(points)
        assert (best == apart.argmin(1)).all() and (error == apart.min(1)).all()
    far = vector_codes.Grid(np.array([[0, 0], [100_000, 0], [0, 100_000]]))
    assert far.nearest(np.array([[5, 5], [99_000, 10]]))[0].tolist() == [0, 1]
    assert min(mask.sum() for mask in far.seen.values()) == 1


def test_forgotten_cells_change_nothing(monkeypatch):
    rng = np.random.default_rng(5)
    entries, points = rng.integers(-900, 900, (16, 4)), rng.integers(-900, 900, (500, 4))
    want = vector_codes.Grid(entries).nearest(points)
    monkeypatch.setattr(vector_codes, "CELLS", 3)
    grid = vector_codes.Grid(entries)
    for part in np.split(np.arange(500), 10):
        assert (grid.nearest(points[part])[0] == want[0][part]).all()
    assert len(grid.seen) <= 3


@pytest.mark.parametrize("value", [0, 1, -1, 2**31, -(2**31), 2**32, -(2**40) - 5, 10**400, -(10**400)])
def test_limbs(value):
    assert sum(digit << 32 * place for place, digit in vector_codes.limbs(value)) == value


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    ours = sorted(tuple(r) for r in vector_codes.report(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).collect())
    assert ours == sorted(con.execute(vector_codes.ORACLE).fetchall())
