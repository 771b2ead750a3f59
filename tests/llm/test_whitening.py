"""Whitening: exact cross-products and the whole operator against plain numpy, special rows."""

import numpy as np
import pytest

from clickscope.llm import whitening as W


@pytest.mark.parametrize("largest,rows,dims", [(1, 1, 1), (3, 1, 2), (1, 64, 2), (100, 1000, 5), (127, 65, 3), (2 ** 30, 65, 4), (2 ** 41, 70, 3)])
def test_cross_products_are_exact(largest, rows, dims):
    y = np.random.default_rng(rows).integers(-largest, largest, (rows, dims))
    y[:, 0] = largest
    assert (W.cross_products(y) == y.astype(object).T.dot(y.astype(object))).all()


def _whole(vectors, many=32):
    x = np.floor(np.array(vectors, float) * 64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    v = (x - s / n).T @ (x - s / n) / n
    e, axes = np.linalg.eigh(v)
    return x, n, s, e[::-1][:many], axes[:, ::-1][:, :many], np.trace(v)


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(400, 6)) @ rng.normal(size=(6, 6)) / 3).astype(np.float32)
    vectors[7] = vectors[8]
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(vectors)] + [(8, vectors[8].tolist(), 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(7)
    got = W.whitened_components(table).toPandas()
    x, n, s, e, axes, trace = _whole([r[1] for r in rows])
    assert len(got) == 401 * 6 and set(got["n"]) == {401}
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9
    white = (x - s / n) @ axes / np.sqrt(e)
    for (i, row) in enumerate(rows[:-1]):
        mine = got[got.vec_id == row[0]].sort_values("component")
        one = mine.drop_duplicates("component")
        assert np.allclose(np.abs(one["whitened"]), np.abs(white[i]), atol=1e-9)
        assert set(mine["deviation"]) == {int(((n * x[i].astype(object) - s.astype(object)) ** 2).sum())}
    first = got.drop_duplicates("component").sort_values("component")
    assert np.allclose(first["explained"], e / trace, rtol=1e-10)
    z = got.groupby("component")["whitened"].apply(lambda c: c.to_numpy())
    measured = np.cov(np.stack([got[got.component == c].sort_values(["vec_id", "deviation"])["whitened"].to_numpy() for c in z.index]), bias=True)
    assert np.abs(measured - np.eye(6)).max() < 1e-9


SCHEMA = "vec_id long, embedding array<double>, component int, n string, _in0 int"


def test_rows_without_a_usable_vector_take_no_part(spark):
    good = [[1.0, 2.0], [0.5, -1.0], [3.0, 0.25], [-1.0, 1.0]]
    bad = [None, [], [1.0, None], [float("nan"), 1.0], [1.0, float("inf")], [1.0, 2.0, 3.0], [1e300, 0.0]]
    rows = [(i, v, 9, "x", i) for i, v in enumerate(good)] + [(100 + i, v, 9, "x", 0) for i, v in enumerate(bad)] + [(None, good[0], 9, "x", 0)]
    got = W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["vec_id"] for r in got} == {0, 1, 2, 3, None} and len(got) == 10 and {r["n"] for r in got} == {5}
    assert got[0].asDict().keys() == {"vec_id", "embedding", "_in0", *W.WHITE} and {r["_in0"] for r in got if r["vec_id"]} == {1, 2, 3}
    x, n, s, e, axes, _ = _whole(good + good[:1])
    want = np.abs((x - s / n) @ axes / np.sqrt(e))
    assert np.allclose(sorted(abs(r["whitened"]) for r in got), sorted(want.flatten()))


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [None, []]])
def test_tables_without_spread_give_nothing(spark, vectors):
    table = spark.createDataFrame([(i, v, 0, "", 0) for i, v in enumerate(vectors)], SCHEMA)
    out = W.whiten(table)
    assert out.collect() == [] and dict(out.dtypes)["deviation"] == "bigint" and dict(out.dtypes)["whitened"] == "double"


def test_flat_directions_give_no_component(spark):
    table = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0], 0, "", 0) for i in range(20)], SCHEMA)
    got = W.whiten(table).collect()
    assert {r["component"] for r in got} == {1} and abs(got[0]["explained"] - 1) < 1e-12


def test_deviations_beyond_64_bits(spark):
    rows = [(i, [v], 0, "", 0) for i, v in enumerate([2.0 ** 34, -2.0 ** 34, 0.0, 0.0])]
    got = {r["vec_id"]: r["deviation"] for r in W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: None, 1: None, 2: 0, 3: 0}  # (4 * 2^40)^2 does not fit
