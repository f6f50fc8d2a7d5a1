"""The engine's input tables, bound to the TPC-H-like test tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.scalars import parse_review_date
from shelfmark.functions.text import bare_words
from shelfmark.operators.joins import lookup_join
from shelfmark.operators.sentiment import ContextWords, Scorer, sentiment_scorer
from shelfmark.operators.tagging import sentences
from shelfmark.operators.words import Tagger, adjective_tagger
from shelfmark.plans.catalog import clean_catalog

WORKOUT_BLOCK = 5_000

# The texts are invented, so frequent words stand in for the context words.
CONTEXT = ContextWords(
    stronger=("the", "und"), weaker=("of", "des"), negators=("is", "le"), contrasts=("but", "que")
)


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _spread(self, texts: DataFrame) -> DataFrame:
        """The test files are one row group each, which a single task would read and work on."""
        cores = self.spark.sparkContext.defaultParallelism
        return texts.repartition(cores) if len(texts.inputFiles()) < cores else texts

    def rated_items(self) -> DataFrame:
        """Reviews without text, from the line items."""
        return self.table("lineitem").select(
            F.col("l_partkey").cast("string").alias("asin"),
            F.col("l_shipdate").alias("review_date"),
            (F.col("l_quantity").cast("int") % 5 + 1).alias("rating"),
        )

    def raw_catalog(self) -> DataFrame:
        """Raw item data, from the parts."""
        key, price = F.col("p_partkey"), F.col("p_retailprice").cast("decimal(10,2)").cast("string")
        return self.table("part").select(
            key.cast("string").alias("asin"),
            F.when(key % 10 == 0, F.col("p_brand"))
            .when(key % 10 == 1, F.lit(None))
            .otherwise(F.concat(F.lit("Visit Amazon's "), "p_brand", F.lit(" Page")))
            .alias("brand"),
            F.when(key % 7 == 0, "")
            .when(key % 7 == 1, "1 - $2")
            .when(key % 7 == 2, price)
            .otherwise(F.concat(F.lit("$"), price))
            .alias("price"),
            F.col("p_name").alias("title"),
        )

    def catalog(self) -> DataFrame:
        return clean_catalog(self.raw_catalog())

    def text_reviews(self) -> DataFrame:
        """Reviews with text and an unread date, from the documents.

        The source stands for the author and the language for the title.
        """
        documents = self._spread(self.table("documents").select("doc_id", "source", "lang", "text"))
        key = F.col("doc_id")
        day = F.concat(
            (2010 + key % 8).cast("string"), F.lit("-"),
            F.lpad((1 + key % 12).cast("string"), 2, "0"), F.lit("-"),
            F.lpad((1 + key % 28).cast("string"), 2, "0"), F.lit("T00:00:00"),
        )
        return documents.select(
            key.alias("review_id"),
            (key % 200).cast("string").alias("asin"),
            F.col("source").alias("author"),
            F.col("lang").alias("title"),
            F.when(key % 17 == 0, "n/a").otherwise(day).alias("review_date"),
            (key % 5 + 1).cast("int").alias("rating"),
            F.col("text").alias("review_text"),
        )

    def review_batch(self) -> DataFrame:
        """The same as a batch of the feed, with a review number."""
        return self.text_reviews().drop("author", "title")

    def line_reviews(self) -> DataFrame:
        """A review with text for every line item, its text one of the benchmark's."""
        texts = self.table("benchmark").select("item_id", F.col("text").alias("review_text"))
        number = F.col("l_orderkey") * 8 + F.col("l_linenumber")
        day = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")
        lines = self._spread(
            self.table("lineitem").select(
                number.alias("review_id"),
                F.col("l_partkey").cast("string").alias("asin"),
                day.alias("review_date"),
                (F.col("l_quantity").cast("int") % 5 + 1).alias("rating"),
                (number % texts.count()).alias("item_id"),
            )
        )
        return lookup_join(lines, texts, ["item_id"]).drop("item_id")

    def dated_reviews(self) -> DataFrame:
        """Text reviews with their date read."""
        return self.text_reviews().withColumn("review_date", parse_review_date(F.col("review_date")))

    def scored_reviews(self) -> DataFrame:
        """Text reviews with their date read and their sentiment scored."""
        scored = self.scorer()(self.dated_reviews())
        return scored.withColumn("review_sentiment_score", F.col("review_sentiment_score").cast("float"))

    def dictionary(self) -> DataFrame:
        """The plain words of the benchmark texts, as a dictionary.

        Words of even length are positive and of odd length negative; their
        length also picks the tag.
        """
        words = self.table("benchmark").select(F.explode(bare_words(F.lower("text"))).alias("word"))
        size = F.length("word")
        return (
            words.where(F.col("word").rlike("^[a-z]{3,12}$"))
            .distinct()
            .select(
                "word",
                F.when(size % 2 == 0, 1.5).otherwise(-1.0).alias("valence"),
                F.when(size % 3 == 0, "JJ").when(size % 3 == 1, "JJR").otherwise("NN").alias("tag"),
            )
        )

    def scorer(self, max_words: int | None = None) -> Scorer:
        lexicon = self.dictionary().select("word", "valence")
        return sentiment_scorer(lexicon, context=CONTEXT, max_words=max_words)

    def tagger(self, max_words: int | None = None) -> Tagger:
        return adjective_tagger(self.dictionary().select("word", "tag"), max_words=max_words)

    def tagged_sentences(self) -> DataFrame:
        """The benchmark's sentences with tags by a rule that looks at the word before.

        Words of up to three letters are DT. After one, words of even length are JJ;
        after an adjective, words that end in s are VB; all others are NN.
        """
        texts = self.table("benchmark").select(F.explode(sentences(F.col("text"))).alias("words"))

        def tag(word: Column, i: Column) -> Column:
            before = F.coalesce(F.get("words", i - 1), F.lit(""))
            short = F.length(before).between(1, 3)
            adjective = F.length(F.coalesce(F.get("words", i - 2), F.lit(""))).between(1, 3) & (F.length(before) > 3) & (F.length(before) % 2 == 0)
            return (
                F.when(F.length(word) <= 3, "DT")
                .when(short & (F.length(word) % 2 == 0), "JJ")
                .when(adjective & F.endswith(F.lower(word), F.lit("s")), "VB")
                .otherwise("NN")
            )

        return texts.select(F.transform("words", lambda w, i: F.struct(w.alias("word"), tag(w, i).alias("tag"))).alias("tagged"))

    def workouts(self) -> DataFrame:
        """Workout logs: the events of a user and type within a block of numbers.

        The block bounds the samples of a workout. The altitudes hold some zeros
        and NaNs, and some workouts have no speed.
        """
        event, user = F.col("event_id"), F.col("user_id")
        altitude = F.when(event % 50 == 0, 0.0).when(event % 77 == 0, float("nan")).otherwise(F.col("value"))
        samples = F.collect_list(F.struct(event.alias("at"), "value", altitude.alias("altitude")))
        logs = (
            self.table("events")
            .groupBy("user_id", "event_type", F.floor(event / WORKOUT_BLOCK).alias("block"))
            .agg(F.min("event_id").alias("id"), F.array_sort(samples).alias("samples"))
        )
        return logs.select(
            "id",
            user.alias("userId"),
            F.col("event_type").alias("sport"),
            F.when(user % 3 == 0, "male").when(user % 3 == 1, "female").alias("gender"),
            F.col("samples.at").alias("timestamp"),
            F.col("samples.value").alias("heart_rate"),
            F.col("samples.altitude").alias("altitude"),
            F.when(user % 11 != 0, F.col("samples.value")).alias("speed"),
        )
