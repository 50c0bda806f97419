"""Text to vectors: a pluggable model and a default made of hashed term weights."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx


class HashedTermEncoder:
    """Hashed term frequencies, weighted by document frequency, at unit length."""

    def __init__(self, dim: int = 384):
        self.dim = dim
        self.model: PipelineModel | None = None

    def fit(self, rows: DataFrame, text: str = "text") -> "HashedTermEncoder":
        steps = [
            HashingTF(inputCol="words", outputCol="tf", numFeatures=self.dim),
            IDF(inputCol="tf", outputCol="weighted"),
            Normalizer(inputCol="weighted", outputCol="unit", p=2.0),
        ]
        self.model = Pipeline(stages=steps).fit(self._words(rows, text))
        return self

    def _words(self, rows: DataFrame, text: str) -> DataFrame:
        return rows.withColumn("words", tx.tokens(text))

    def encode(self, rows: DataFrame, text: str = "text") -> DataFrame:
        if self.model is None:
            raise RuntimeError("fit the encoder first")
        out = self.model.transform(self._words(rows, text))
        return out.withColumn("embedding", vector_to_array("unit", "float32")).drop(
            "words", "tf", "weighted", "unit"
        )


def encode_with_model(
    rows: DataFrame,
    load: Callable[[], object],
    *,
    text: str = "text",
    key: str = "pos",
    batch_size: int = 64,
    normalise: bool = True,
) -> DataFrame:
    """(key, embedding) by a model with encode(list of texts), loaded once per worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for batch in batches:
            texts = batch.column(text).to_pylist()
            for at in range(0, len(texts), batch_size):
                made = np.asarray(model.encode(texts[at : at + batch_size]), dtype=np.float64)
                if normalise:
                    lengths = np.linalg.norm(made, axis=1, keepdims=True)
                    made = made / np.maximum(lengths, fv.NORM_FLOOR)
                made = made.astype(np.float32)
                ids = batch.column(key).slice(at, len(made))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(list(made), pa.list_(pa.float32()))], [key, "embedding"]
                )

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, text).mapInArrow(run, f"{key} {kind}, embedding array<float>")


def encoder_queries(queries: DataFrame, encoder_name: str) -> DataFrame:
    """Query texts as the named encoder expects them."""
    return queries.withColumn("text", tx.encoder_query("text", F.lit(encoder_name)))


def not_yet_encoded(rows: DataFrame, done: DataFrame, key: str = "model_id") -> DataFrame:
    """Rows whose id has no vector yet."""
    return rows.join(done.select(key), key, "left_anti")


def encode_to_table(
    rows: DataFrame,
    encode: Callable[[DataFrame], DataFrame],
    path: str,
    *,
    overwrite: bool = False,
    resume: bool = False,
    dim: int | None = None,
    key: str = "model_id",
) -> DataFrame:
    """Write vectors; `resume` adds the missing ones, `overwrite` starts anew.

    With neither, an existing table is an error; so are both at once, or
    resuming a table of another dimension.
    """
    if overwrite and resume:
        raise ValueError("choose overwrite or resume, not both")
    spark = rows.sparkSession
    done = _existing(spark, path) if resume else None
    if done is not None:
        found = done.agg(F.max(F.size("embedding"))).first()[0]
        if dim is not None and found is not None and found != dim:
            raise ValueError(f"the table at {path} has dimension {found}, not {dim}")
        encode(not_yet_encoded(rows, done, key)).write.mode("append").parquet(path)
    else:
        encode(rows).write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
    return spark.read.parquet(path)


def _existing(spark, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except Exception as problem:
        if "PATH_NOT_FOUND" in str(problem) or "UNABLE_TO_INFER_SCHEMA" in str(problem):
            return None
        raise
