"""Raw item catalog → clean catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.predicates import all_present, not_empty
from shelfmark.functions.scalars import author_from_brand, price_to_float
from shelfmark.operators.aggregates import first_per_key


def clean_catalog(raw: DataFrame, trim_author: bool = False) -> DataFrame:
    """Items with a named author, a title and a plain price, once per ``asin``.

    Of several rows for one item the smallest by title, author, price is kept.
    """
    named = raw.where(not_empty(F.col("price"))).select(
        "asin",
        author_from_brand(F.col("brand"), trim_author).alias("author"),
        price_to_float(F.col("price")).alias("price"),
        "title",
    )
    complete = named.where(not_empty(F.col("author")) & all_present("asin", "title", "price"))
    return first_per_key(complete, "asin", ["title", "author", "price"])
