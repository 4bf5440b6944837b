"""Arithmetic on ``array<double>`` columns and repeatable random vectors."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textweft.functions.arrays import let


def doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda total, x: total + x,
    )


def norm(a: Column) -> Column:
    return F.sqrt(
        F.aggregate(a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    )


def l2_normalize(vec: Column) -> Column:
    """The unit vector; null for a zero vector."""
    return let(norm(vec), lambda n: F.when(n > 0, F.transform(vec, lambda x: x.cast("double") / n)))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


MAX_COLUMNS = 128  # vectors up to this width are aggregated as plain columns


def vector_width(df: DataFrame, vec: str = "vec") -> int | None:
    """The length of all vectors in ``df``; None if it has none. Different lengths are an error."""
    size = F.when(F.col(vec).isNotNull(), F.size(vec))
    row = df.agg(F.min(size).alias("low"), F.max(size).alias("high")).first()
    if row["low"] != row["high"]:
        raise ValueError(f"vectors of {row['low']} and of {row['high']} numbers in one table")
    return row["high"]


def mean_vector(vec: Column, weight: Column | None = None, width: int | None = None) -> Column:
    """Aggregate: element-wise (weighted) mean, with map-side partial results.

    With a known ``width`` the elements are averaged as columns, which stays inside a
    compiled hash aggregate; a group of shorter vectors keeps their length. Other vectors
    go through MLlib's summarizer. Vectors of one group have one length.
    """
    if width is not None and width <= MAX_COLUMNS:
        places = [F.get(vec, F.lit(i)).cast("double") for i in range(width)]
        if weight is None:
            means = F.array(*[F.avg(x) for x in places])
        else:
            total = F.sum(weight)
            means = F.array(*[F.sum(x * weight) / total for x in places])
        return F.slice(means, F.lit(1), F.max(F.size(vec)))  # a missing number keeps its place
    value = array_to_vector(doubles(vec))
    mean = Summarizer.mean(value) if weight is None else Summarizer.mean(value, weight)
    return vector_to_array(mean)


def max_vector(vec: Column, width: int | None = None) -> Column:
    """Aggregate: element-wise maximum, with map-side partial results."""
    if width is not None and width <= MAX_COLUMNS:
        largest = F.array(*[F.max(F.get(vec, F.lit(i)).cast("double")) for i in range(width)])
        return F.slice(largest, F.lit(1), F.max(F.size(vec)))
    return vector_to_array(Summarizer.max(array_to_vector(doubles(vec))))


def hash_uniform(*key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone, not on partitioning."""
    return F.xxhash64(*key).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))


def random_vector(key: Column, size: int, seed: int = 1, init_range: float | None = None) -> Column:
    """A starting vector per key: ``(u - 0.5) / size``, or uniform in ±``init_range``."""
    if size == 0:
        return F.array().cast("array<double>")
    spread = 1.0 / size if init_range is None else 2.0 * init_range
    return F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda i: (hash_uniform(F.lit(seed), key, i) - 0.5) * spread,
    )
