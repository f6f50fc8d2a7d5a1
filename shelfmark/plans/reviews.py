"""Raw reviews → review batches → enriched reviews."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.predicates import all_present, not_empty
from shelfmark.functions.scalars import (
    epoch_to_timestamp,
    iso_text,
    nan_to_null,
    parse_review_date,
    rating_to_int,
    strip_nul,
)
from shelfmark.operators.joins import lookup_join, restrict_to_keys
from shelfmark.operators.sentiment import Scorer
from shelfmark.schemas import REVIEW_BATCH

def normalise_reviews(raw: DataFrame) -> DataFrame:
    """Raw feed records to the four columns of a review batch."""
    return raw.select(
        "asin",
        iso_text(epoch_to_timestamp(F.col("unixReviewTime"))).alias("review_date"),
        rating_to_int(nan_to_null(F.col("overall"))).alias("rating"),
        F.col("reviewText").alias("review_text"),
    )


def complete_reviews(batch: DataFrame) -> DataFrame:
    """Reviews with a text, an item, a date and a rating."""
    return batch.where(
        all_present("review_text", "asin", "review_date", "rating") & not_empty(F.col("review_text"))
    )


Enricher = Callable[[DataFrame], DataFrame]


def review_enricher(catalog: DataFrame | Callable[[], DataFrame], score: Scorer) -> Enricher:
    """A function that enriches a batch: item data joined, sentiment scored.

    Only complete reviews of items in the catalog come out. A date in another
    layout becomes NULL and its review stays. Columns the batch carries besides
    its four, such as a review number, stay in front.

    For a catalog that grows, give a function that reads it: it is called for
    each batch, as the files of a DataFrame are fixed when it is made. Only the
    items of the batch are measured and joined, however large the catalog is.
    """

    def enrich(batch: DataFrame) -> DataFrame:
        extra = [c for c in batch.columns if c not in REVIEW_BATCH.names]
        items = (catalog() if callable(catalog) else catalog).select("asin", "author", "price", "title")
        # the items are chosen and sized from the unfiltered batch, which leaves the text unread
        wanted = restrict_to_keys(items, batch, "asin")
        joined = lookup_join(complete_reviews(batch), wanted, ["asin"], sizes_from=batch)
        return score(joined).select(
            *extra,
            "asin",
            "author",
            "price",
            "title",
            parse_review_date(F.col("review_date")).alias("review_date"),
            "rating",
            strip_nul(F.col("review_text")).alias("review_text"),
            F.col("review_sentiment_score").cast("float").alias("review_sentiment_score"),
        )

    return enrich


def enrich_reviews(batch: DataFrame, catalog: DataFrame, score: Scorer) -> DataFrame:
    return review_enricher(catalog, score)(batch)
