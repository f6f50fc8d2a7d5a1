"""The dashboard's pages as parameterised queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.predicates import contains_ignore_case
from shelfmark.operators.joins import join_null_safe
from shelfmark.operators.ranking import top_k
from shelfmark.operators.words import word_weights
from shelfmark.plans.marts import rating_and_sentiment_per_year, ratings_per_author, ratings_per_title

# The range and the start of the two sliders.
MIN_ROWS, MAX_ROWS, DEFAULT_ROWS = 1, 500, 250


def _checked(rows: int) -> int:
    if not MIN_ROWS <= rows <= MAX_ROWS:
        raise ValueError(f"between {MIN_ROWS} and {MAX_ROWS} rows can be shown, not {rows}")
    return rows


def authors_with_most_ratings(enriched: DataFrame, rows: int = DEFAULT_ROWS) -> DataFrame:
    return top_k(ratings_per_author(enriched), "rating_count", "author", _checked(rows))


def books_with_most_ratings(enriched: DataFrame, rows: int = DEFAULT_ROWS) -> DataFrame:
    return top_k(ratings_per_title(enriched), "rating_count", "title", _checked(rows))


def search_yearly(enriched: DataFrame, entity: str, query: str) -> DataFrame:
    """Yearly rating and sentiment of the authors or titles that match.

    One filtered pass over the reviews, however many titles match.
    """
    matching = enriched.where(contains_ignore_case(F.col(entity), query))
    return rating_and_sentiment_per_year(matching, entity)


def search_yearly_tables(ratings: DataFrame, sentiments: DataFrame, entity: str, query: str) -> DataFrame:
    """The same from the two stored yearly tables."""
    wanted = contains_ignore_case(F.col(entity), query)
    return join_null_safe(ratings.where(wanted), sentiments.where(wanted), [entity, "year"])


def matching_titles(ratings: DataFrame, query: str) -> DataFrame:
    return ratings.where(contains_ignore_case(F.col("title"), query)).select("title").distinct()


def word_cloud(counts: DataFrame, entity: str, query: str, top: int | None = None) -> DataFrame:
    """Weighted adjectives of the matching authors or titles.

    ``counts`` is the stored table of ``marts.word_counts``; no text is read.
    """
    return word_weights(counts.where(contains_ignore_case(F.col(entity), query)), top)
