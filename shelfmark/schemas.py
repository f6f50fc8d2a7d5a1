"""Explicit schemas, so that no reader has to infer one from the data."""

from pyspark.sql import types as T

_STRING, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_FLOAT, _DOUBLE, _TIME = T.FloatType(), T.DoubleType(), T.TimestampNTZType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


RAW_REVIEW = _schema(asin=_STRING, overall=_DOUBLE, reviewText=_STRING, unixReviewTime=_LONG)
RAW_CATALOG = _schema(asin=_STRING, brand=_STRING, price=_STRING, title=_STRING)
REVIEW_BATCH = _schema(asin=_STRING, review_date=_STRING, rating=_INT, review_text=_STRING)
BATCH_ENVELOPE = _schema(book_reviews=T.ArrayType(REVIEW_BATCH), is_json_completed=T.BooleanType())
CATALOG = _schema(asin=_STRING, author=_STRING, price=_FLOAT, title=_STRING)
ENRICHED = _schema(
    review_id=_LONG,
    asin=_STRING,
    author=_STRING,
    price=_FLOAT,
    title=_STRING,
    review_date=_TIME,
    rating=_INT,
    review_text=_STRING,
    review_sentiment_score=_FLOAT,
)
ADJECTIVES = _schema(author=_STRING, title=_STRING, year=_INT, part=_INT, adjectives=_STRING)
WORKOUTS = _schema(
    id=_LONG,
    userId=_LONG,
    sport=_STRING,
    gender=_STRING,
    url=_STRING,
    altitude=T.ArrayType(_DOUBLE),
    heart_rate=T.ArrayType(_DOUBLE),
    latitude=T.ArrayType(_DOUBLE),
    longitude=T.ArrayType(_DOUBLE),
    speed=T.ArrayType(_DOUBLE),
    timestamp=T.ArrayType(_LONG),
)

# Length limits of the stored text columns.
MAX_LENGTHS = {"asin": 100, "author": 256, "title": 1000}
