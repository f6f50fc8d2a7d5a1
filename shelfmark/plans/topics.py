"""Topics of the complete reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfmark.operators.topics import TopicModel, fit_topics
from shelfmark.plans.reviews import complete_reviews


def review_topics(batch: DataFrame, **settings) -> TopicModel:
    return fit_topics(complete_reviews(batch), "review_text", **settings)
