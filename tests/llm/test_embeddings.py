import math

import numpy as np
import pytest

from callops.llm import embeddings
from llm_samples import table  # noqa: F401

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(row):
    v = row[1]
    return row[2] is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)


def expected(rows, cosine):
    n = len(rows)
    units = [None] * n
    for k, row in enumerate(rows):
        if usable(row):
            v = np.array(row[1], np.float32).astype(float)
            units[k] = v / np.linalg.norm(v)
    near = [[j for j in range(n) if j != i and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
             and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine] for i in range(n)]
    out = []
    for i in range(n):
        reach, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in reach if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), least, rows[i][0] == least))
    return sorted(out, key=repr)


def cases(dim=24, seed=0):
    random = np.random.default_rng(seed)
    rows, centres = [], random.normal(size=(30, dim))
    for k in range(400):
        v = centres[k % 30] * (1 + k % 3) + random.normal(size=dim) * 0.12 * (k % 5)
        rows.append((1000 + k, [float(np.float32(x)) for x in v], k % 2))
    rows += [(2000 + k, rows[3][1], rows[3][2]) for k in range(60)]  # copies
    rows += [(1, None, 0), (2, [], 0), (3, [0.0] * dim, 0), (4, [math.nan] + [1.0] * (dim - 1), 0), (5, [math.inf] + [1.0] * (dim - 1), 1),
             (6, [None] + [1.0] * (dim - 1), 1), (7, rows[3][1], None), (8, rows[3][1][:5], rows[3][2]), (9, rows[3][1][:5], rows[3][2]),
             (9, rows[3][1][:5], rows[3][2]), (None, rows[5][1], rows[5][2]), (None, None, None), (10, [1e-30] * dim, 0), (11, [1e30] * dim, 0)]
    return rows


@pytest.mark.parametrize("dim", [3, 24])
def test_links_and_components(table, dim):  # noqa: F811
    rows = cases(dim)
    found = embeddings.near_groups(table(rows, SCHEMA), 0.98)
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows, 0.98)


def test_small_blocks_split_into_many_levels(spark, monkeypatch):
    """Every near pair of blocks is reached, and no pair beyond the reach of the boxes."""
    random = np.random.default_rng(3)
    at = np.sort(random.uniform(0, 5, 90))
    boxes = [("x", 1, int(k * 3), [float(x)] + [0.0] * 7, [float(x) + 0.05] + [0.0] * 7) for k, x in enumerate(at)]
    df = spark.createDataFrame(boxes, "label string, dim int, seq long, low array<double>, high array<double>")
    found = {(r.a, r.b) for r in embeddings.block_pairs(df, 0.2).collect()}
    gap = {(a[2], b[2]): max(0, b[3][0] - a[4][0], a[3][0] - b[4][0]) for a in boxes for b in boxes if a[2] <= b[2]}
    assert {p for p, g in gap.items() if g <= 0.2 - 1e-6} <= found <= {p for p, g in gap.items() if g <= 0.2 + 1e-6}


def test_recursion_inside_blocks():
    random = np.random.default_rng(1)

    def block(n, shift):
        v = random.normal(size=(n, 6)) * 0.05 + np.eye(6)[0] + shift * np.eye(6)[1]
        unit = v / np.linalg.norm(v, axis=1, keepdims=True)
        return {"n": random.integers(1, 4, n), "node": np.arange(n) + int(1000 * shift), "unit": unit, "at": unit}

    for a, b in ((block(700, 0), block(513, 0.1)), (block(300, 0), None)):
        other = b or a
        found_a, found_b, links = embeddings._join_runs(a, other, b is None, 0.995, math.sqrt(0.01))
        hit = a["unit"] @ other["unit"].T >= 0.995
        if b is None:
            np.fill_diagonal(hit, False)
        assert (found_a == hit @ other["n"]).all()
        assert b is None or (found_b == hit.T @ a["n"]).all()
        assert links


def test_empty(table):  # noqa: F811
    assert embeddings.near_groups(table([], SCHEMA), 0.98).collect() == []
    assert len(embeddings.near_groups(table([(1, None, 1)], SCHEMA), 0.98).collect()) == 1
