"""Batch embedding of a text or image column into unit vectors.

An encoder is a function from a column to a vector column, looked up by name.
Model encoders are made with :func:`batch_encoder`: the model is loaded once per
task and fed Arrow batches of that one column; the other columns stay in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinshelf.functions.vectors import l2_normalize
from twinshelf.kernels import (
    CHANNEL_MEAN, CHANNEL_STD, hashed_counts, prepared_pixels, vectors_to_arrow,
)
from twinshelf.session import cut
from twinshelf.sources.tables import read_or_none

Encoder = Callable[[Column], Column]

IMAGE_SIZE = 224
IMAGE_BATCH = 128


def batch_encoder(factory: Callable[[], Callable[[pa.Array], np.ndarray]]) -> Encoder:
    """Encoder from a factory whose product maps n non-null values to n vectors."""

    @F.arrow_udf("array<float>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = factory()
        for values in batches:
            valid = values.is_valid().to_numpy(zero_copy_only=False)
            if not valid.any():
                yield pa.nulls(len(values), pa.list_(pa.float32()))
                continue
            encoded = np.asarray(model(values.drop_null()))
            matrix = np.zeros((len(values), encoded.shape[1]))
            matrix[valid] = encoded
            yield vectors_to_arrow(matrix, valid)

    # Declared non-deterministic only so that Spark does not copy the call into
    # filters it derives (for an explode, say) and run the model twice.
    return encode.asNondeterministic()


def word_hash(dim: int = 256, ngram: int = 0, max_words: int | None = None) -> Encoder:
    """Hashed bag of words, or of the ``ngram``s of ``<word>``; needs no model.

    Whole texts are counted unless ``max_words`` cuts them.  Nothing is shuffled.
    """
    made = batch_encoder(lambda: lambda texts: hashed_counts(texts, dim, ngram, max_words))
    made.encoder_key = f"word_hash-{dim}-{ngram}-{max_words}"
    return made


def image_encoder(model: Callable[[np.ndarray], np.ndarray], size: int = IMAGE_SIZE) -> Encoder:
    """Encoder of ``image`` structs from a function of prepared pixel batches."""

    def encode(images: pa.Array) -> np.ndarray:
        return np.concatenate([
            model(prepared_pixels(images.slice(i, IMAGE_BATCH), size))
            for i in range(0, len(images), IMAGE_BATCH)
        ])

    return batch_encoder(lambda: encode)


def histogram(bins: int = 8, size: int = IMAGE_SIZE) -> Encoder:
    """Pixel counts per channel and intensity bin."""
    # bin edges lie between two byte values, so float rounding cannot move a pixel
    edges = (np.arange(1, bins) * 256 / bins - 0.5) / 255.0

    def count(pixels: np.ndarray) -> np.ndarray:
        out = []
        for c in range(3):
            level = np.digitize(pixels[:, c], (edges - CHANNEL_MEAN[c]) / CHANNEL_STD[c])
            row = np.arange(len(pixels))[:, None, None] * bins + level
            out.append(np.bincount(row.ravel(), minlength=len(pixels) * bins).reshape(-1, bins))
        return np.concatenate(out, axis=1).astype(np.float64)

    return image_encoder(count, size)


def grid_mean(grid: int = 8, size: int = IMAGE_SIZE) -> Encoder:
    """Mean standardised colour of each field of a ``grid`` × ``grid`` raster."""

    def means(pixels: np.ndarray) -> np.ndarray:
        n, c, side = len(pixels), 3, size // grid
        fields = pixels[:, :, : side * grid, : side * grid].reshape(n, c, grid, side, grid, side)
        return fields.mean(axis=(3, 5)).reshape(n, -1)

    return image_encoder(means, size)


# Encoders are made when they are used: making one needs a session.
_encoders: dict[str, Callable[[], Encoder]] = {
    "word_hash": word_hash,
    "gram_hash": lambda: word_hash(ngram=3),
    "histogram": histogram,
    "grid_mean": grid_mean,
}


def register_encoder(name: str, make: Callable[[], Encoder]) -> None:
    _encoders[name] = make


def get_encoder(encoder: str | Encoder) -> Encoder:
    if callable(encoder):
        return encoder
    if encoder not in _encoders:
        raise ValueError(f"unknown encoder {encoder!r}; known: {sorted(_encoders)}")
    return _encoders[encoder]()


def embed(df: DataFrame, input_col: str, out_col: str, encoder: str | Encoder) -> DataFrame:
    """Add a unit-vector column; a null or empty input has a null vector."""
    return df.withColumn(out_col, get_encoder(encoder)(F.col(input_col)))


def reduce_dimensions(df: DataFrame, vec: str, k: int, double: bool = False) -> DataFrame:
    """Replace vectors by their first ``k`` principal components, unit length.

    Only a width × width covariance matrix reaches the driver.  ``double`` keeps the
    projection as it is, in double precision.
    """
    rows = df.where(F.col(vec).isNotNull())
    rows = rows.withColumn("_in", array_to_vector(F.col(vec).cast("array<double>")))
    model = PCA(k=k, inputCol="_in", outputCol="_out").fit(rows)
    out = vector_to_array("_out")
    reduced = model.transform(rows).withColumn(vec, out if double else l2_normalize(out))
    return reduced.drop("_in", "_out")


def encoder_key(encoder: str | Encoder) -> str:
    """What tells the vectors of one encoder from those of another in a table."""
    if isinstance(encoder, str):
        return encoder
    if getattr(encoder, "encoder_key", None) is None:
        raise ValueError("give an encoder that is not named an encoder_key")
    return encoder.encoder_key


def embed_once(
    df: DataFrame, table: str, *, key: str, input_col: str, out_col: str, encoder: str | Encoder,
    version: str | None = None,
) -> DataFrame:
    """Vectors for all rows of ``df``, computing only those the table lacks.

    The table is keyed by id, content hash and encoder (its name, or ``version``), so a
    row whose text changed or whose encoder did is embedded again and an interrupted run
    leaves nothing wrong behind.  Repeated rows are embedded once, and a vector that two
    runs have both appended is read once.
    """
    spark = df.sparkSession
    named = F.lit(version or encoder_key(encoder))
    wanted = df.select(key, input_col).withColumns(
        {"content_hash": F.xxhash64(input_col), "encoder": named}
    )
    schema = f"{key} {df.schema[key].dataType.simpleString()}, content_hash bigint, " \
             f"encoder string, {out_col} array<float>"
    on = [key, "content_hash", "encoder"]
    stored = read_or_none(spark, table, schema)
    missing = wanted.dropDuplicates(on)
    if stored is not None:
        missing = missing.join(stored.select(*on), on, "left_anti")
    # computed once: the table read here must not be the table written to
    fresh = cut(embed(missing, input_col, out_col, encoder).select(*on, out_col))
    fresh.write.mode("append").parquet(table)
    vectors = spark.read.schema(schema).parquet(table).where(F.col("encoder") == named)
    vectors = vectors.drop("encoder").dropDuplicates([key, "content_hash"])
    hashed = df.withColumn("content_hash", F.xxhash64(input_col))
    joined = hashed.join(
        vectors.withColumnsRenamed({key: "_key", "content_hash": "_hash"}),
        F.col(key).eqNullSafe(F.col("_key")) & F.col("content_hash").eqNullSafe(F.col("_hash")), "left",
    )
    return joined.drop("content_hash", "_key", "_hash")
