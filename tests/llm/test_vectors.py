"""Vector search and hard negatives, held against brute force."""

import math

import numpy as np
import pytest

from chronolake.llm import hard_negatives, projected_search

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, key string, score string, block int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, n, "k", "s", 1) for i, v, n in rows], SCHEMA).repartition(5)


def odd_rows(seed=3, n=900, width=12, hot=300):
    """Groups, a vector that a third of all rows hold, ties, repeated rows, nulls, zeros, short and non-finite vectors."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    rows = [(i, (centres[i % 12] + 0.4 * rng.normal(size=width)).astype(np.float32).tolist(), int(rng.integers(0, 10))) for i in range(n)]
    rows += [(n + i, rows[0][1], i % 3) for i in range(hot)]
    rows += [rows[20], rows[20], rows[50]]
    at = 10 * n
    rows += [(None, rows[1][1], 1), (at, None, 1), (at + 20, [None, 1.0] * 6, 2), (at + 40, [math.nan] + [1.0] * 11, 2)]
    rows += [(at + 60, [math.inf] + [1.0] * 11, 2), (at + 80, [0.0] * width, 3), (at + 100, [0.5, -0.25], 4), (at + 120, [], 4), (at + 150, rows[4][1], None)]
    return rows


def usable(rows):
    kept = {}
    for i, v, n in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept[(i, tuple(v), n)] = None
    width = max((len(v) for _, v, _ in kept), default=0)
    return [(i, np.array([*v, *[0.0] * (width - len(v))]), n) for i, v, n in kept]


def nearest_truth(rows, k=20):
    used = list({(i, tuple(v)): (i, v) for i, v, _ in usable(rows) if any(v)}.values())
    out = {}
    for q, v in used:
        if q % 20 == 0:
            scored = sorted((-float(sum(a * b for a, b in zip(v.tolist(), x.tolist(), strict=True))), i) for i, x in used if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def recall(found, truth):
    """Share of the true k best scores that are reached, ties either way."""
    hit = total = 0
    for q, best in truth.items():
        got = [s for _, s in found.get(q, [])]
        total += len(best)
        hit += sum(s >= best[-1][1] - 1e-9 for s in got)
    return hit / total


def collected(df):
    found = {}
    for r in df.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    return found


def test_search_of_odd_rows(spark):
    rows = odd_rows()
    truth, found = nearest_truth(rows), collected(projected_search.search(frame(spark, rows)))
    assert found.keys() == truth.keys()
    by_id = {i: v for i, v, _ in usable(rows)}
    for q, got in found.items():
        assert len(got) == 20 and q not in {i for i, _ in got}
        assert got == sorted(got, key=lambda x: (-x[1], x[0]))
        for i, s in got:
            assert s == pytest.approx(float(by_id[q] @ by_id[i]), abs=1e-9)
    assert recall(found, truth) >= 0.95
    # the vector that a third of the rows hold: all its nearest are its copies, by id
    assert [i for i, _ in found[0]] == [i for i, _ in truth[0]]


def test_search_over_many_blocks(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=24).tolist(), 0) for i in range(6000)]
    truth = nearest_truth(rows[:1]) or {}
    x = np.array([np.float32(v) for _, v, _ in rows]).astype(float)
    for q in range(0, 6000, 20):
        s = x @ x[q]
        s[q] = -math.inf
        best = np.argsort(-s, kind="stable")[:20]
        truth[q] = [(int(i), float(s[i])) for i in best]
    assert recall(collected(projected_search.search(frame(spark, rows))), truth) >= 0.95


def test_search_of_given_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert recall(collected(projected_search.search(frame(spark, rows))), nearest_truth(rows)) >= 0.95


def test_search_of_few_rows(spark):
    assert projected_search.search(frame(spark, [])).count() == 0
    assert projected_search.search(frame(spark, [(20, [1.0], 1)])).count() == 0
    found = collected(projected_search.search(frame(spark, [(20, [1.0, 2.0], 1), (7, [1.0, 2.0], None), (9, [-1.0, 0.0], 1)])))
    assert found == {20: [(7, 5.0), (9, -1.0)]}


def test_chi_square_quantile():
    draws = np.random.default_rng(1).chisquare(12, 400_000)
    for chance in (0.5, 0.9, 0.98):
        assert projected_search.quantile(chance, 12) == pytest.approx(np.quantile(draws, chance), rel=0.01)


def negatives_truth(rows):
    used = [(i, np.floor(256 * v), (n + 1) % 10 if i % 7 == 0 else n) for i, v, n in usable([r for r in rows if r[2] is not None])]
    out = []
    for a, x, n in used:
        if a % 50 == 0:
            scored = sorted((-int(x @ y), i, m) for i, y, m in used)
            for s, p, m in [t for t in scored if t[2] == n and t[1] != a][:5]:
                inside = [(-t, i) for t, i, o in scored if o != n and 50 * -s <= 100 * -t <= 95 * -s]
                out += [(a, p, r, i, -s, t) for r, (t, i) in enumerate(inside[:3], start=1)]
    return sorted(out)


@pytest.mark.parametrize("seed,scale", [(3, 1.0), (4, 1000.0)])
def test_hard_negatives_of_odd_rows(spark, seed, scale):
    rows = [(i, v if v is None else [None if x is None else x * scale for x in v], n) for i, v, n in odd_rows(seed)]
    rows = [(i, v if v is None else np.float32([math.nan if x is None else x for x in v]).tolist(), n) for i, v, n in rows]
    got = hard_negatives.mine(frame(spark, rows)).collect()
    want = negatives_truth(rows)
    assert want and sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got) == want


def test_hard_negatives_over_many_blocks(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=16) / 4).astype(np.float32).tolist(), int(rng.integers(0, 10))) for i in range(5000)]
    got = hard_negatives.mine(frame(spark, rows)).collect()
    assert sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got) == negatives_truth(rows)


def test_hard_negatives_of_few_rows(spark):
    assert hard_negatives.mine(frame(spark, [])).count() == 0
    assert hard_negatives.mine(frame(spark, [(50, [1.0, 0.5], 1), (51, [1.0], 1)])).count() == 0


def test_heap_takes_pairs_in_order():
    rng = np.random.default_rng(2)
    one, two = rng.normal(size=7), rng.normal(size=5)
    got = list(hard_negatives.in_order(one, two))
    assert [s for s, _, _ in got] == pytest.approx(sorted((a + b for a in one for b in two), reverse=True))
    assert {(i, j) for _, i, j in got} == {(i, j) for i in range(7) for j in range(5)}


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x = hard_negatives.quantised(rng.normal(size=(500, 10)))
    codes = hard_negatives.Codes(x, 4)
    cell, far = codes.of(x)

    class Row:
        def __init__(self, c):
            own = far[cell == c]
            self.cell, self.n, self.far0, self.far1 = c, len(own), *own.max(axis=0)

    codes.use([Row(c) for c in sorted(set(cell.tolist()))], 100)
    for q in x[:20]:
        for bound, c in codes.cells(q):
            assert (x[cell == c] @ q).max() <= bound
