import numpy as np
import pytest

from fraclake.llm import hard_negatives, whitening
from fraclake.llm.hard_negatives import LEAST, MOST, NEGATIVES, POSITIVES, mined
from fraclake.llm.whitening import jacobi, pivoted_cholesky, rounds, whitened

NAMES = "vec_id bigint, embedding array<float>, label int, x string, cluster int"
BAD = [None, [None] * 6, [float("nan")] * 6, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0], [], [1.0, 2.0]]


def table(spark, vectors, labels, more=()):
    rows = [(i, None if v is None else list(v), y, "extra", 1) for i, (v, y) in enumerate(zip(vectors, labels))]
    return spark.createDataFrame([*rows, *more], NAMES)


def brute_negatives(rows):
    """Rows of the result for (vec_id, vector, label) rows with distinct ids and usable vectors."""
    ids = np.array([r[0] for r in rows])
    x = np.floor(256 * np.array([r[1] for r in rows], np.float32).astype(float)).astype(np.int64)
    y = np.array([(r[2] + 1) % 10 if r[0] % 7 == 0 else r[2] for r in rows])
    out = set()
    for a in np.flatnonzero(ids % 100 == 0):
        scores = x @ x[a]
        order = [i for i in np.lexsort((ids, -scores)) if i != a]
        others = [i for i in order if y[i] != y[a]]
        for p in [i for i in order if y[i] == y[a]][:POSITIVES]:
            fits = [i for i in others if LEAST * scores[p] <= 100 * scores[i] <= MOST * scores[p]]
            out |= {(ids[a], ids[p], k + 1, ids[i], scores[p], scores[i]) for k, i in enumerate(fits[:NEGATIVES])}
    return out


def answer(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_negatives(spark):
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(10, 8))
    labels = rng.integers(0, 10, 900)
    vectors = (0.2 * middles[labels] + 0.1 * rng.normal(size=(900, 8))).astype(np.float32)
    vectors[300:500] = vectors[300]  # a third or so are one vector: ties go by id
    vectors[700] = 0
    rows = [(i, v.tolist(), int(y)) for i, (v, y) in enumerate(zip(vectors, labels))]
    bad = [(1000 + 100 * i, v, 1, "extra", 1) for i, v in enumerate(BAD)] + [(2000, rows[0][1], None, "x", 1), (None, rows[0][1], 1, "x", 1)]
    repeated = [(5, rows[5][1], rows[5][2], "y", 2), (100, rows[100][1], rows[100][2], "y", 2)]
    df = table(spark, vectors.tolist(), labels.tolist(), bad + repeated)
    wanted = brute_negatives(rows)
    assert answer(mined(df)) == wanted and wanted


@pytest.mark.parametrize("block,step,rows,head", [(3, 2, 16, 0.3), (4, 256, 64, 0.01), (8192, 7, 8192, 1.0)])
def test_negatives_in_blocks(spark, monkeypatch, block, step, rows, head):
    """Several blocks of anchors, short steps and lists."""
    for name, value in (("BLOCK", block), ("STEP", step), ("ROWS", rows), ("HEAD", head)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(2)
    vectors, labels = np.round(rng.normal(size=(800, 6)), 1).astype(np.float32), rng.integers(0, 3, 800)
    made = brute_negatives([(i, v.tolist(), int(y)) for i, (v, y) in enumerate(zip(vectors, labels))])
    assert answer(mined(table(spark, vectors.tolist(), labels.tolist()).repartition(5))) == made


def test_bounds_hold():
    rng = np.random.default_rng(3)
    x = rng.integers(-50, 50, (500, 5))
    x[0] = 0
    middle = hard_negatives.centres(x[1:200], 4)
    of = np.argmax(hard_negatives.unit(x) @ middle.T, 1)
    for c in range(4):
        members = x[(of == c) & (x != 0).any(1)]
        angles = np.arccos(np.clip(hard_negatives.unit(members) @ middle[c], -1, 1))
        cluster = hard_negatives.Cluster(middle[c], float(angles.max()), 0.0, *[None] * 6)
        assert (hard_negatives.unit(members) @ x.T <= cluster.bounds(x) + 1e-9).all()


def test_negatives_of_odd_tables(spark):
    empty = table(spark, [], [])
    assert mined(empty).count() == 0
    assert mined(table(spark, [None, [1.0, 2.0]], [1, 1])).count() == 0
    assert mined(table(spark, [[1.0, 2.0]] * 3, [1, 1, 1])).count() == 0  # no other label
    with pytest.raises(Exception, match="too long"):
        mined(table(spark, [[1e9, 2.0]] * 20, [i % 2 for i in range(20)])).count()


def brute_whitening(vectors):
    """{row: (deviation, z up to sign)} and eigenvalues, from the covariance of the distinct rows."""
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = x - sums / n
    f = fit - sums / n
    values, parts = np.linalg.eigh(f.T @ f / n)
    values, parts = values[::-1], parts[:, ::-1]
    return n, ((n * x - sums) ** 2).sum(1), centred @ parts / np.sqrt(np.maximum(values, 1e-300)), values


def test_whitening(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(700, 6)) @ rng.normal(size=(6, 6))).astype(np.float32)
    vectors[400:] = vectors[400]
    more = [(5000 + i, v, 1, "bad", 1) for i, v in enumerate(BAD)] + [(3, vectors[3].tolist(), 2, "again", 1), (None, vectors[4].tolist(), 2, "no id", 1)]
    rows = whitened(table(spark, vectors.tolist(), [None] * 700, more)).collect()
    n, deviation, z, values = brute_whitening(vectors)
    assert len(rows) == 702 * 6
    signs = {}
    for r in rows:
        if r.vec_id is None:
            continue
        assert r.n == n and r.deviation == deviation[r.vec_id] and r.identity_error < 1e-8
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9
        expected = z[r.vec_id, r.component - 1]
        if abs(expected) > 1e-6:
            sign = signs.setdefault(r.component, np.sign(r.whitened * expected))
            assert abs(r.whitened * sign - expected) < 1e-7


def test_whitening_of_odd_tables(spark):
    assert whitened(table(spark, [], [])).count() == 0
    assert whitened(table(spark, [[1.0, 2.0]] * 5, [1] * 5)).count() == 0  # nothing varies
    flat = whitened(table(spark, [[1.0, 2.0 * i, 4.0 * i] for i in range(5)], [1] * 5)).collect()  # one dimension does
    assert len(flat) == 5 and {r.component for r in flat} == {1} and abs(flat[0].explained - 1) < 1e-12


def test_deviation_beyond_words():
    model = whitening.Whitening(10**6, np.array([10**12, 0]), np.ones(2), np.eye(2), 1.0)
    x = np.array([[10**6 + 1500, 3], [10**6, -1]])
    assert model.deviation(x).tolist() == [(1500 * 10**6) ** 2 + (3 * 10**6) ** 2, 10**12]
    with pytest.raises(OverflowError):
        model.deviation(np.array([[10**7, 0]]))


def test_factor_and_rotations():
    rng = np.random.default_rng(5)
    for rank, size in ((5, 5), (3, 7), (1, 4), (0, 3)):
        a = rng.normal(size=(size, rank)) * 10.0 ** -np.arange(rank)
        v = a @ a.T
        factor = pivoted_cholesky(v)
        assert factor.shape == (size, rank) and np.allclose(factor @ factor.T, v, atol=1e-13)
        assert sorted((factor[i] != 0).sum() for i in range(size))[:rank] == list(range(1, rank + 1))  # triangular but for the order of rows
        turned = jacobi(factor)
        gram = turned.T @ turned
        assert np.allclose(turned @ turned.T, v, atol=1e-13)
        assert np.allclose(gram, np.diag(np.diag(gram)), atol=1e-14)
        assert np.allclose(np.diag(gram), np.linalg.eigvalsh(v)[::-1][:rank], rtol=1e-6, atol=1e-14)
    for n in (0, 1, 2, 5, 8):
        pairs = [frozenset(p) for i, j in rounds(n) for p in zip(i.tolist(), j.tolist())]
        assert len(pairs) == len(set(pairs)) == n * (n - 1) // 2
        assert all(len(set(i) | set(j)) == len(i) + len(j) for i, j in rounds(n))
