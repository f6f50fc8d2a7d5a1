"""A lexicon, context words and tags for the tests; the engine brings none of its own."""

from shelfmark.operators.sentiment import ContextWords

# invented levels: 2 for liked, 3 for loved, and so on
VALENCES = {"good": 2.0, "great": 3.0, "bad": -2.5, "dull": -1.5, "sad": -2.0, "poor": -2.0, ":)": 2.0, ":(": -2.0}
CONTEXT = ContextWords(stronger=("very",), weaker=("slightly",), negators=("not", "never"), contrasts=("but",))


def lexicon(spark):
    return spark.createDataFrame(sorted(VALENCES.items()), "word string, valence double")

# a dictionary of a few words, in the usual tag names
TAGS = {"awful": "JJ", "bad": "JJ", "better": "JJR", "good": "JJ", "great": "JJ", "long": "JJ", "new": "JJ", "old": "JJ", "worst": "JJS"}


def tags(spark):
    return spark.createDataFrame(sorted(TAGS.items()), "word string, tag string")
