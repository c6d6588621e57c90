"""Vector expressions over ``ARRAY<FLOAT>`` columns, computed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column | str, right: Column | str) -> Column:
    """Sum of products; NULL when the lengths differ."""
    products = F.zip_with(
        left, right, lambda a, b: a.cast("double") * b.cast("double")
    )
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def squared_norm(vector: Column | str) -> Column:
    return F.aggregate(
        vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )


def cosine_similarity(left: Column | str, right: Column | str) -> Column:
    """Dot product over the root of both squared norms; NULL for a zero vector."""
    scale = F.sqrt(squared_norm(left) * squared_norm(right))
    return dot(left, right) / F.nullif(scale, F.lit(0.0))


def with_value(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where a lambda uses it.

    A column that only a lambda refers to would be inlined by the optimizer and
    computed again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def unit_vector(vector: Column | str) -> Column:
    """Entries over the vector's length; NULL entries for a zero vector."""
    return with_value(
        F.nullif(F.sqrt(squared_norm(vector)), F.lit(0.0)),
        lambda norm: F.transform(vector, lambda x: x.cast("double") / norm),
    )


def largest_entry(vector: Column | str) -> Column:
    """Largest absolute entry."""
    return F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double"))))


def mean_of_vectors(vectors: Column | str, mask: Column | str | None = None) -> Column:
    """Mean of an ``ARRAY<ARRAY<FLOAT>>`` of token vectors held in one row.

    Every vector counts, padding included, unless ``mask`` (1 = real token) is given.
    """
    vectors = F.col(vectors) if isinstance(vectors, str) else vectors
    if mask is not None:
        mask = F.col(mask) if isinstance(mask, str) else mask
        vectors = F.transform(
            F.filter(F.arrays_zip(vectors.alias("v"), mask.alias("m")), lambda p: p["m"] == 1),
            lambda p: p["v"],
        )
    zero = F.transform(F.element_at(vectors, 1), lambda x: F.lit(0.0))
    total = F.aggregate(
        vectors,
        zero,
        lambda acc, v: F.zip_with(acc, v, lambda a, b: a + b.cast("double")),
        lambda acc: F.transform(acc, lambda x: x / F.size(vectors)),
    )
    return F.when(F.size(vectors) > 0, total)
