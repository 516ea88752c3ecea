"""The squared-hinge classifier against a plain minimum of its objective."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LinearSVCModel
from pyspark.ml.linalg import Vectors

from termloom.operators import learning, margins


def objective(w, rows, signs, C, constant):
    short = np.maximum(0, 1 - signs * (rows @ w[:-1] + w[-1] * constant))
    return w @ w / 2 + C * (short**2).sum()


def plain_minimum(rows, signs, C, constant):
    """Newton's method on dense rows, each step halved until it goes down."""
    whole = np.c_[rows, np.full(len(rows), constant)]
    w = np.zeros(whole.shape[1])
    for _ in range(200):
        short = np.maximum(0, 1 - signs * (whole @ w))
        slope = w - 2 * C * whole.T @ (short * signs)
        inside = whole[short > 0]
        step, length = np.linalg.solve(np.eye(len(w)) + 2 * C * inside.T @ inside, slope), 1.0
        now = objective(w, rows, signs, C, constant)
        while objective(w - length * step, rows, signs, C, constant) > now and length > 1e-14:
            length /= 2
        w = w - length * step
    return w


def frame(spark, rows, labels, parts=5):
    vectors = [
        Vectors.dense(r) if i % 3 == 0 else Vectors.sparse(len(r), [(j, float(v)) for j, v in enumerate(r) if v])
        for i, r in enumerate(rows)
    ]
    pairs = [(v, float(t)) for v, t in zip(vectors, labels)]
    return spark.createDataFrame(pairs, ["features", "label"]).repartition(parts)


@pytest.fixture(scope="module")
def sample():
    draw = np.random.default_rng(0)
    rows = draw.normal(size=(240, 7)) * (draw.random((240, 7)) < 0.5) * [1, 10, 0.1, 1, 1, 5, 0]
    labels = rows @ draw.normal(size=7) + draw.normal(size=240) > 0.3
    return rows, labels.astype(float)


@pytest.mark.parametrize("C, intercept, scaling", [(1.0, True, 1.0), (0.01, True, 3.0), (20.0, False, 1.0)])
def test_minimum(spark, sample, C, intercept, scaling):
    rows, labels = sample
    constant = scaling if intercept else 0.0
    best = plain_minimum(rows, 2 * labels - 1, C, constant)
    model = learning.train_linear_svc(
        frame(spark, rows, labels), C=C, fit_intercept=intercept, intercept_scaling=scaling, tol=1e-10
    )
    found = np.append(model.coefficients.toArray(), model.intercept / scaling if intercept else 0.0)
    ours, least = (objective(w, rows, 2 * labels - 1, C, constant) for w in (found, best))
    assert ours == pytest.approx(least, rel=1e-12) and np.allclose(found, best, atol=1e-6)


def test_small_blocks_and_one_partition_give_the_same(spark, sample, monkeypatch):
    rows, labels = sample
    whole = learning.train_linear_svc(frame(spark, rows, labels, 1), tol=1e-10)
    monkeypatch.setattr(margins, "BLOCK_CELLS", 1)
    # Partial sums in a tree of tasks, as where they are many or long.
    monkeypatch.setattr(margins, "DIRECT_BYTES", 0)
    cut = learning.train_linear_svc(frame(spark, rows, labels, 9), tol=1e-10)
    assert np.allclose(whole.coefficients.toArray(), cut.coefficients.toArray(), atol=1e-7)


def test_the_model_is_one_of_spark(spark, sample, tmp_path):
    rows, labels = sample
    data = frame(spark, rows, labels)
    model = learning.train_linear_svc(data)
    model.write().save(str(tmp_path / "model"))
    again = LinearSVCModel.load(str(tmp_path / "model"))
    signs = (rows @ model.coefficients.toArray() + model.intercept > 0).astype(float)
    for one in (model, again):
        seen = learning.predict(one, data)
        assert sorted(r["prediction"] for r in seen.collect()) == sorted(signs)
        assert learning.accuracy(seen).first()["accuracy"] > 0.8


def test_what_cannot_be_learned_from(spark, sample):
    rows, labels = sample
    with pytest.raises(Exception, match="neither 0 nor 1"):
        learning.train_linear_svc(frame(spark, rows, labels + 1))
    with pytest.raises(ValueError, match="no rows"):
        learning.train_linear_svc(frame(spark, rows, labels).limit(0))
    with pytest.raises(ValueError, match="positive"):
        learning.train_linear_svc(frame(spark, rows, labels), C=0)
    with pytest.raises(ValueError, match="loss"):
        learning.train_linear_svc(frame(spark, rows, labels), loss="log")


def test_one_class_and_empty_vectors(spark):
    rows = np.zeros((6, 3))
    model = learning.train_linear_svc(frame(spark, rows, np.ones(6)), tol=1e-10)
    # Only the intercept is left: the minimum of b^2 / 2 + 6 * (1 - b)^2.
    assert np.allclose(model.coefficients.toArray(), 0) and model.intercept == pytest.approx(12 / 13)


def test_sparks_own_loss_is_still_there(spark, sample):
    rows, labels = sample
    model = learning.train_linear_svc(frame(spark, rows, labels), loss="hinge", regParam=0.1, maxIter=5)
    assert model.numFeatures == 7


def test_batches_are_packed_in_parts_of_bounded_size():
    n, wide = 5000, 100
    cells = pa.array([list(range(wide))] * n, pa.list_(pa.int32()))
    values = pa.array([[float(i % 7)] * wide for i in range(n)], pa.list_(pa.float64()))
    kinds, sizes = pa.array([0] * n, pa.int8()), pa.array([wide] * n, pa.int32())
    features = pa.StructArray.from_arrays([kinds, sizes, cells, values], ["type", "size", "indices", "values"])
    batch = pa.RecordBatch.from_arrays([features, pa.array([float(i % 2) for i in range(n)])], ["features", "label"])
    blocks = [margins._block([part.column(i)[0].as_py() for i in range(4)]) for part in margins._pack([batch])]
    assert max(len(b.columns) for b in blocks) <= min(margins.BLOCK_CELLS, margins.PACK_ROWS * wide)
    assert np.concatenate([b.times(np.ones(wide)) for b in blocks]).tolist() == [float(i % 7) * wide for i in range(n)]
    assert np.concatenate([b.signs for b in blocks]).tolist() == [2.0 * (i % 2) - 1 for i in range(n)]
