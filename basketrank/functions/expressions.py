"""Column expressions shared by the operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_WIDTH = 10


def after(day: Column | str, as_of: date, days: int) -> Column:
    """Strict trailing window: ``day > as_of - days``."""
    return _col(day) > F.date_sub(F.lit(as_of), days)


def days_until(as_of: date, day: Column | str) -> Column:
    return F.datediff(F.lit(as_of), _col(day))


def age_group(age: Column | str) -> Column:
    """Age bucket; a null age falls through to ``50+``."""
    age = _col(age)
    return (
        F.when(age < 25, "<25")
        .when(age < 35, "25-35")
        .when(age < 50, "35-50")
        .otherwise("50+")
    )


def pad_id(article: Column | str, width: int = ID_WIDTH) -> Column:
    """Left-pad an id with zeros; longer ids stay whole (``lpad`` alone would cut them)."""
    text = _col(article).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def image_path(article: Column | str) -> Column:
    return F.concat(F.lit("images/"), pad_id(article), F.lit(".jpg"))


def discount(rank: Column | str) -> Column:
    """DCG discount of a 1-based rank."""
    return F.lit(1.0) / F.log2(_col(rank) + F.lit(1.0))


def ap_weight(hits_so_far: Column | str, rank: Column | str) -> Column:
    """Precision at a hit: hits up to and including it, over its rank."""
    return _col(hits_so_far).cast("double") / _col(rank)


def dot(left: Column | str, right: Column | str) -> Column:
    """Inner product of two equally long arrays."""
    products = F.zip_with(_col(left), _col(right), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def unit(vector: Column | str) -> Column:
    """The array scaled to length one; null if it has no length."""
    vector = _col(vector)
    # As an entry of a list the length is bound once; in the lambda itself it would be worked out for every element.
    once = F.array(F.sqrt(dot(vector, vector)))
    scaled = F.transform(once, lambda length: F.when(length > 0, F.transform(vector, lambda x: x.cast("double") / length)))
    return F.element_at(scaled, 1)


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
