"""Column functions over dense vectors held as arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0).cast("double"), lambda a, x: a + x)


def inner_product(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def l2_norm(v: Column) -> Column:
    return F.sqrt(inner_product(v, v))


def l2_normalize(v: Column) -> Column:
    """Unit vector as array<double>; a zero vector stays as it is."""
    return F.zip_with(
        v,
        F.array_repeat(l2_norm(v), F.size(v)),
        lambda x, n: F.when(n == 0, F.lit(0.0)).otherwise(x.cast("double") / n),
    )


def vector_to_text(v: Column) -> Column:
    return F.concat(
        F.lit("["), F.array_join(F.transform(v, lambda x: x.cast("string")), ","), F.lit("]")
    )


def text_to_vector(text: Column) -> Column:
    return F.from_json(text, "array<float>")
