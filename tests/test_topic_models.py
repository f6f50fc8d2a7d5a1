"""Topic models that are stored, loaded and updated."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import topics

WORDS = ["ship sea storm captain", "love letter heart kiss", "murder clue police knife"]


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(90):
        words = WORDS[i % 3].split() + (WORDS[(i + 1) % 3].split() if i % 5 == 0 else [])
        rows.append((i, " ".join(rng.choice(words, 12)) + " the rare" + str(i)))
    return spark.createDataFrame([*rows, (90, "unknown only"), (91, ""), (92, None)], "review_id long, review_text string")


@pytest.fixture(scope="module")
def model(texts):
    odd = texts.where((F.col("review_id") % 2 == 1) & (F.col("review_text") != ""))
    return topics.fit_topics(odd, topics=3, iterations=15, min_documents=5)


def mixes(model, df):
    return {r.review_id: r.topic_distribution for r in topics.topic_mix(model, df).collect()}


def test_a_loaded_model_gives_equal_shares(texts, model, tmp_path):
    topics.save_topics(model, str(tmp_path / "m"))
    loaded = topics.load_topics(str(tmp_path / "m"))
    whole = texts.where("review_text is not null")
    assert mixes(loaded, whole) == mixes(model, whole)
    fitted_on = {r.review_id: r.topic_distribution for r in topics.topic_mix(model).collect()}
    assert fitted_on == {i: m for i, m in mixes(loaded, whole).items() if i in fitted_on}
    assert [r.words for r in topics.topic_words(loaded, 4).orderBy("topic").collect()] == [
        r.words for r in topics.topic_words(model, 4).orderBy("topic").collect()
    ]
    topics.save_topics(loaded, str(tmp_path / "m"))


def digamma(x):
    """By numeric differences of the logarithm of the gamma function."""
    from math import lgamma

    h = 1e-5
    return np.vectorize(lambda v: (lgamma(v + h) - lgamma(v - h)) / (2 * h))(x)


def test_digamma():
    x = np.array([0.05, 0.3, 1.0, 2.5, 40.0, 1e4])
    assert np.abs(topics._digamma(x) - digamma(x)).max() < 1e-4
    assert abs(topics._digamma(np.array([1.0]))[0] + 0.5772156649015329) < 1e-11


def test_an_update_is_a_step_of_online_variational_bayes(texts, model):
    batch = texts.where((F.col("review_id") % 2 == 0) & F.col("review_text").isNotNull())
    known = {w: i for i, w in enumerate(model.counter.vocabulary)}
    old = model.lda.topicsMatrix().toArray()
    prior = model.lda.estimatedDocConcentration().toArray().sum()
    beta = np.exp(topics._digamma(old) - topics._digamma(old.sum(axis=0)))
    sums = np.zeros_like(old)
    shares = mixes(model, batch)
    for r in batch.collect():
        found = [known[w] for w in r.review_text.split() if w in known]
        gamma = np.array(shares[r.review_id]) * (len(found) + prior)
        own = np.exp(topics._digamma(gamma) - topics._digamma(np.array(len(found) + prior))) if found else None
        for w in found:
            sums[w] += own * beta[w] / (own * beta[w]).sum()
    rate = (1024 + 3) ** -0.51
    written = batch.where("review_text <> ''").count()
    expected = (1 - rate) * old + rate * (1 / 3 + 92 / written * sums)
    updated = topics.update_topics(model, batch, texts_so_far=92, step=3)
    assert np.abs(updated.lda.topicsMatrix().toArray() - expected).max() < 1e-6
    assert updated.counter.vocabulary == model.counter.vocabulary
    assert all(abs(sum(m) - 1) < 1e-9 for i, m in mixes(updated, batch).items() if i < 90)


def test_repeated_updates_learn_the_new_texts(spark, model):
    """Texts that mix two old topics in a way the fit has not seen."""
    mixed = spark.createDataFrame([(i, "ship ship love love") for i in range(40)], "review_id long, review_text string")
    now = model
    for step in range(1, 12):
        now = topics.update_topics(now, mixed, 40, step, offset=1.0)
    words = now.lda.topicsMatrix().toArray()
    at = [now.counter.vocabulary.index(w) for w in ("ship", "love", "murder")]
    assert words[at[:2]].sum() > 10 * words[at[2]].sum()


def test_a_batch_without_known_words_changes_nothing(texts, model):
    same = topics.update_topics(model, texts.where("review_id >= 90"), 100, 1)
    assert same is model


def test_vectors_are_what_the_counter_gives(texts, model):
    from shelfmark.functions.text import lower_words

    both = topics._counted(model.counter, texts.where("review_text is not null"), "review_text")
    spark_ml = model.counter.transform(both.withColumnRenamed("features", "ours").withColumn("_words", lower_words(F.col("review_text"))))
    assert all(r.ours == r.features for r in spark_ml.collect())


def test_statistics_of_a_text_do_not_explode_its_words(texts, model):
    """Sums are taken per word before anything is shuffled, so a long batch stays small."""
    from checks.compare import plan

    assert "Generate" not in plan(topics.word_statistics(model, texts))
