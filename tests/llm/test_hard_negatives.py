"""Hard negatives against plain scores, with ties, repeated rows, odd vectors, and blocks of anchors."""

import math
import random

import numpy as np
import pytest

from hourvault.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, slot int"


def brute(rows, every=100, n_positives=5, n_negatives=10):
    known = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            known[i, label, tuple(max(-hn.MOST, min(hn.MOST, math.floor(256 * x))) for x in v)] = True
    out = []
    for a, label, v in known:
        if a % every:
            continue
        scores = sorted({(-sum(x * y for x, y in zip(v, w)), i, m == label) for i, m, w in known if i != a})
        for p, i, same in [s for s in scores if s[2]][:n_positives]:
            fit = [s for s in scores if not s[2] and 30 * -p <= 100 * -s[0] <= 90 * -p]
            out += [(a, i, k + 1, j, -p, -n) for k, (n, j, _) in enumerate(fit[:n_negatives])]
    return sorted(out)


def made(n, seed, width=20, labels=4):
    r = random.Random(seed)
    return [(k, [float(np.float32(r.gauss(0.1, 0.3))) for _ in range(width)], r.randrange(labels)) for k in range(n)]


ODD = [(3, None, 1), (4, [1.0, None], 1), (5, [float("nan")] * 20, 1), (6, [float("inf")] * 20, 1), (None, [0.5] * 20, 1), (7, [0.5] * 20, None),
       (1000, [], 1), (1100, [0.25] * 3, 2), (1001, [0.25] * 5, 2), (1002, [0.5] * 30, 0), (1200, [4.0] * 20, 3), (1003, [-4.0] * 20, 3),
       (1300, [0.0] * 20, 2), (1004, [0.5] * 20, 1), (1004, [0.25] * 20, 1)]


@pytest.mark.parametrize("anchor_bytes", [hn.ANCHOR_BYTES, 200])
def test_against_brute_force(spark, anchor_bytes):
    rows = [*made(400, 1), *ODD]
    # Copies of one vector under many ids (ties), and repeated rows.
    rows += [(2000 + k, rows[1][1], 1) for k in range(60)] + rows[:40] + [rows[0]] * 30
    df = spark.createDataFrame([(*r, "x", 9) for r in rows], SCHEMA).repartition(5)
    found = hn.hard_negatives(df, anchor_bytes=anchor_bytes)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == brute(rows) != []


def test_large_components_and_empty_tables(spark):
    rows = [(0, [1e9, -3e4, 0.1], 0), (1, [2e4, -3e4, 0.1], 0), (2, [1e4, -2e4, 0.2], 1), (3, [1e30, 1e30, 0.0], 1), (4, [9e3, -2e3, 0.2], 2)]
    df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    assert sorted(map(tuple, hn.hard_negatives(df).collect())) == brute(rows) != []
    assert hn.hard_negatives(df.limit(0)).collect() == []
    assert hn.hard_negatives(df.filter("vec_id > 0")).collect() == []


def test_tables_give_inner_products():
    r = np.random.default_rng(1)
    for width, least, most in ((64, -256, 255), (13, 0, 1), (8, -5, 0), (1, -(1 << 23), 1 << 23)):
        anchors, others = (r.integers(least, most + 1, (n, width)) for n in (7, 30))
        assert (hn.looked_up(hn.subset_sums(anchors, np.int64), hn.bit_planes(others)) == others @ anchors.T).all()
    assert hn.subset_sums(anchors, np.int64).shape == (1, 256, 7)
