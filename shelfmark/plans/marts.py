"""Derived tables over the enriched reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.aggregates import rating_summary, yearly_averages
from shelfmark.operators.words import Tagger, adjective_counts, adjective_strings

RATING = {"rating": "avg_rating"}
SENTIMENT = {"review_sentiment_score": "avg_sentiment"}


def rating_per_year(enriched: DataFrame, entity: str) -> DataFrame:
    return yearly_averages(enriched, entity, RATING)


def sentiment_per_year(enriched: DataFrame, entity: str) -> DataFrame:
    return yearly_averages(enriched, entity, SENTIMENT)


def rating_and_sentiment_per_year(enriched: DataFrame, entity: str) -> DataFrame:
    """Both averages from one pass over the reviews."""
    return yearly_averages(enriched, entity, RATING | SENTIMENT)


def ratings_per_author(enriched: DataFrame) -> DataFrame:
    return rating_summary(enriched, "author")


def ratings_per_title(enriched: DataFrame) -> DataFrame:
    return rating_summary(enriched, "title")


def _with_year(reviews: DataFrame) -> DataFrame:
    return reviews.withColumn("year", F.year("review_date"))


def word_counts(enriched: DataFrame, tag: Tagger, keys: list[str]) -> DataFrame:
    """Adjective counts per key, the table the word clouds read."""
    return adjective_counts(tag(_with_year(enriched)), keys)


def word_texts(enriched: DataFrame, tag: Tagger, keys: list[str], **sizes) -> DataFrame:
    """Adjectives per key as text."""
    return adjective_strings(tag(_with_year(enriched)), keys, **sizes)
