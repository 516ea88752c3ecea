"""From a specification to a linear classifier on Spark ML."""

from __future__ import annotations

from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.ml.feature import ElementwiseProduct, VectorAssembler, VectorSlicer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import FieldMapping
from ..functions.values import cell_value, is_numeric, seeded_digest
from ..plans.cells import Source, dictionary_vectors, known_statistics, pieces
from ..plans.sizing import broadcast_limit, kept_by
from ..plans.spec import FeatureSpec
from .margins import fit_squared_hinge


def with_ml_vector(
    df: DataFrame,
    spec: FeatureSpec,
    mapping: FieldMapping = FieldMapping(),
    corpus: DataFrame | None = None,
    numeric_mode: str = "keep",
    out: str = "features",
) -> DataFrame:
    """Add the document's row as an ML vector, built by JVM transformers only.

    Fields become blocks of an assembled vector; if a field's columns are not side by side in
    the specification, the blocks are put into its order afterwards.
    """
    known, given, parts, cols = df, df.columns, [], []
    for field, (terms, places) in spec.term_columns().items():
        option = spec.option(field)
        source = Source(known if corpus is None else corpus, None, mapping, [])
        # A vector is as wide as its model, so the dictionary has the size of the model's weights;
        # it is sent in pieces that each keep the broadcast limit.
        for piece in pieces(terms, broadcast_limit(df.sparkSession)):
            part = f"__part{len(parts)}"
            df = dictionary_vectors(df, field, piece, mapping, binary=option != "term_freq", out=part)
            if option in ("doc_freq", "ttf"):
                weights = Vectors.dense(known_statistics(source, field, piece, option))
                scaled = ElementwiseProduct(scalingVec=weights, inputCol=part, outputCol=f"{part}s")
                df, part = scaled.transform(df), f"{part}s"
            parts.append(part)
        cols += places
    for field, places in spec.slot_columns().items():
        for slot, place in enumerate(places):
            part = f"__slot{len(parts)}"
            df = df.withColumn(part, _slot(df, field, slot, numeric_mode))
            parts.append(part)
            cols.append(place)
    ordered = cols == sorted(cols)
    assembled = VectorAssembler(inputCols=parts, outputCol=out if ordered else "__all")
    df = assembled.transform(df)
    if not ordered:
        places = sorted(range(len(cols)), key=cols.__getitem__)
        df = VectorSlicer(inputCol="__all", outputCol=out, indices=places).transform(df)
    return df.select(*given, F.col(out).alias(out, metadata=_named(spec)))


def _named(spec: FeatureSpec) -> dict:
    """ML attributes: which column of the vector is which feature."""
    names = [{"idx": i, "name": name} for i, name in enumerate(spec.feature_names())]
    return {"ml_attr": {"attrs": {"numeric": names}, "num_attrs": spec.n_cols}}


def _slot(df: DataFrame, field: str, slot: int, mode: str) -> Column:
    kind, value = df.schema[field].dataType, F.col(field)
    many = isinstance(kind, T.ArrayType)
    inner = kind.elementType if many else kind
    if not is_numeric(inner):
        raise ValueError(f"field {field!r} cannot fill an integer span")
    if many:
        value = F.get(F.array_compact(value), F.lit(slot))
    elif slot:
        return F.lit(0.0)
    return F.coalesce(cell_value(value, inner, mode), F.lit(0.0))


def training_frame(
    df: DataFrame,
    spec: FeatureSpec,
    key: str | list[str] = "doc_id",
    mapping: FieldMapping = FieldMapping(),
    labels: DataFrame | None = None,
    **options,
) -> DataFrame:
    """``(key, features, label)``: the last column of ``spec`` is the target, the others are data.

    ``labels`` holds the target if it is not in ``df``; it meets finished vectors, not text.
    """
    keys = [key] if isinstance(key, str) else list(key)
    label = spec.features[-1]
    if label.slot is None:
        raise ValueError("the last column, the label, must come from a numeric field")
    features, mode = spec.head(spec.n_cols - 1), options.get("numeric_mode", "keep")
    if labels is None:
        df = df.withColumn("label", _slot(df, label.field, label.slot, mode))
        vectors = with_ml_vector(df, features, mapping, **options)
        return vectors.select(*keys, "features", "label")
    target = labels.select(*keys, _slot(labels, label.field, label.slot, mode).alias("label"))
    docs = kept_by(df, target, keys)
    vectors = with_ml_vector(docs, features, mapping, **options).select(*keys, "features")
    return vectors.join(target, keys)


def hash_split(
    df: DataFrame, key: str | list[str] = "doc_id", test_size: float = 0.33, seed: int = 0
) -> DataFrame:
    """Add ``is_test``.  The choice depends on the key alone, so it survives any re-partitioning."""
    edge = f"{int(test_size * 0x10000):04x}"
    digest = seeded_digest(key, seed)
    return df.withColumn("is_test", F.substring(digest, 1, 4) < F.lit(edge))


def train_test_split(
    df: DataFrame, key: str | list[str] = "doc_id", test_size: float = 0.33, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    marked = hash_split(df, key, test_size, seed)
    return (
        marked.where(~F.col("is_test")).drop("is_test"),
        marked.where("is_test").drop("is_test"),
    )


def train_linear_svc(training: DataFrame, loss: str = "squared_hinge", **params) -> LinearSVCModel:
    """A linear support vector machine on ``features`` and a ``label`` of 0 or 1.

    ``squared_hinge`` is regularised, see :func:`.margins.fit_squared_hinge` for its parameters;
    ``hinge`` is Spark's own estimator with its parameters.
    """
    if loss == "hinge":
        return LinearSVC(featuresCol="features", labelCol="label", **params).fit(training)
    if loss != "squared_hinge":
        raise ValueError(f"loss {loss!r} is neither 'squared_hinge' nor 'hinge'")
    return fit_squared_hinge(training, **params)


def save_model(model: LinearSVCModel, spec: FeatureSpec, path: str) -> None:
    """Store a model beside the specification of its columns, on any path that Spark can write."""
    model.write().overwrite().save(f"{path}/model")
    spec.save(f"{path}/spec")


def load_model(path: str) -> tuple[LinearSVCModel, FeatureSpec]:
    return LinearSVCModel.load(f"{path}/model"), FeatureSpec.load(f"{path}/spec")


def predict(model: LinearSVCModel, data: DataFrame) -> DataFrame:
    """Add ``prediction``."""
    return model.transform(data)


def accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction"):
    """One row ``(n_rows, accuracy)``: the share of right labels."""
    right = (F.col(prediction) == F.col(label)).cast("double")
    return predictions.agg(F.count("*").alias("n_rows"), F.avg(right).alias("accuracy"))
