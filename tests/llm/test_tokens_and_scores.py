import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import class_ngrams, quality, terms, token_counts

TEXTS = [
    (0, "the cat sat on the mat"), (1, "The  DOG sat\ton the mat!"), (2, None), (3, ""), (4, " \n "), (5, "the cat sat on the mat"),
    (5, "the cat sat on the mat"), (None, "zebra 中文 <|endoftext|> the"), (6, "x" * 5_000 + " the " * 3_000),
]


@pytest.fixture(params=[200_000, 3])
def frequent(request, monkeypatch):
    """All terms in the dictionary, or nearly all by the join."""
    monkeypatch.setattr(terms, "MOST_FREQUENT", request.param)
    monkeypatch.setattr(terms.frequent_floor, "__defaults__", (request.param,))


def test_token_counts_are_the_library_s(documents, frequent):
    rows = token_counts.token_counts(documents(TEXTS)).collect()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for doc_id, text in TEXTS:
        n = len(whole.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 512))
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in rows)
    assert token_counts.token_counts(documents([])).collect() == []


@pytest.mark.parametrize("least", [5, 1, 1_000])
def test_base_scores_are_those_of_the_counts(documents, monkeypatch, least):
    """Some words, all words or none are clustered; the others are found by the join."""
    monkeypatch.setattr(class_ngrams, "LEAST_COUNT", least)
    rows = class_ngrams.score_documents(documents(TEXTS)).collect()
    out = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in TEXTS}
    counts = Counter()
    for d, text in TEXTS:
        if not out[d]:
            counts.update([*(text or "").encode().lower().split(), None])
    total, kinds = sum(counts.values()), len(counts)
    expected = []
    for d, text in TEXTS:
        tokens = [*(text or "").encode().lower().split(), None]
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens)
        expected.append((d, out[d], len(tokens), sum(counts[t] > 0 for t in tokens), total, round(base, 6)))
    found = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]
    assert sorted(map(repr, expected)) == sorted(map(repr, found))
    assert all(r.score < 0 for r in rows)
    assert class_ngrams.score_documents(documents([])).collect() == []


def test_class_scores_are_probabilities(spark, documents):
    """The scores of all texts of one word, known or of a shape without known words, sum with the empty text to 1 at most."""
    table = documents([(0, "a b a b a b"), (1, "b a"), (4, "b")])
    counts = class_ngrams.count_terms(table.select("text"), lambda: class_ngrams.words_of)
    model = class_ngrams.train(table.select("text"), counts)
    assert np.allclose((10**model.transitions).sum(axis=1), 1)
    # the words of each class and one unseen one share its whole probability
    own = np.arange(len(model.word_class)) >= class_ngrams.FIRST
    for c in set(model.word_class[own].tolist()):
        seen = sum(10 ** model.logs[own & (model.word_class == c)]) + (10**model.end_log if model.end_class == c else 0)
        assert seen + 1 <= 10 ** model.shares[c] + 1e-9


def test_scores_equal_plain_python_s(documents):
    """The classes are the model's; all counts, shares and transitions are worked out anew, word by word."""
    rng = np.random.default_rng(8)
    frequent = [f"{c}{v}{d}" for c in "bcdfg" for v in "aeiou" for d in ("", "s", "t9", "\u00e9")]
    texts = [(i, " ".join(rng.choice(frequent, int(rng.integers(0, 40)))) + f" rare{i} RARE{i % 9}\tTwice{i // 2}") for i in range(150)]
    texts += [(200, None), (201, ""), (202, " \x0b "), (203, "never seen words here"), (None, "ba ba"), (7, texts[7][1]), (204, "ba " * 9_000), (9, "x" * 70 + " " + "x" * 70)]
    table = documents(texts)
    training = [t or "" for d, t in texts if zlib.crc32(str("" if d is None else d).encode()) % 7 != 2]
    model = class_ngrams.train(
        table.where(~class_ngrams.held_out()).select("text"),
        class_ngrams.count_terms(table.where(~class_ngrams.held_out()).select("text"), lambda: class_ngrams.words_of),
    )
    words = {w for _, t in texts for w in class_ngrams.words_of(t or "")}
    class_of = {w: int(model.word_class[model.vocabulary.code(pa.array([w.decode()])).number[0]]) for w in words} | {"end": model.end_class}
    counts, follow = Counter(), Counter()
    for t in training:
        line = ["end", *class_ngrams.words_of(t), "end"]
        counts.update(line[1:])
        follow.update((class_of[a], class_of[b]) for a, b in zip(line, line[1:]))
    groups = len(model.transitions)
    size = Counter()
    for w, n in counts.items():
        size[class_of[w]] += n + 1
    after = Counter()
    for (a, _), n in follow.items():
        after[a] += n
    vocabulary, total = len(counts), sum(counts.values())
    assert {w for w, n in counts.items() if n >= class_ngrams.LEAST_COUNT} - {"end"} == {
        w for w in words if model.vocabulary.code(pa.array([w.decode()])).number[0] >= class_ngrams.FIRST
    }
    want = []
    for d, t in texts:
        line = ["end", *class_ngrams.words_of(t or ""), "end"]
        base = sum(math.log10((counts[w] + 1) / (total + vocabulary + 1)) for w in line[1:])
        score = sum(
            math.log10((follow[class_of[a], class_of[b]] + 1) / (after[class_of[a]] + groups))
            + math.log10((counts[b] + 1) / (size[class_of[b]] + 1))
            for a, b in zip(line, line[1:])
        )
        want.append((d, len(line) - 1, sum(counts[w] > 0 for w in line[1:]), total, base, score))
    got = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in class_ngrams.score_documents(table).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], -r[4])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)


def test_words_used_alike_share_a_class():
    rng = np.random.default_rng(0)
    # items 0-3 are followed by 4-7 and these by 0-3
    bigrams = np.zeros((8, 8))
    for _ in range(4_000):
        a, b = rng.integers(0, 4), rng.integers(4, 8)
        bigrams[a, b] += 1
        bigrams[b, rng.integers(0, 4)] += 1
    classes = class_ngrams.brown_classes(bigrams, 2)
    assert len(set(classes[:4])) == len(set(classes[4:])) == 1 and classes[0] != classes[4]


def brute_brown(bigrams, classes):
    """The same merging, with the mutual information worked out anew for every pair."""

    def information(groups):
        t = np.array([[bigrams[np.ix_(a, b)].sum() for b in groups] for a in groups]) / bigrams.sum()
        l, r = t.sum(axis=1), t.sum(axis=0)
        return sum(t[i, j] * math.log(t[i, j] / l[i] / r[j]) for i in range(len(t)) for j in range(len(t)) if t[i, j] > 0)

    order = np.argsort(-(bigrams.sum(axis=0) + bigrams.sum(axis=1)), kind="stable")
    groups = []
    for item in order.tolist():
        groups.append([item])
        if len(groups) > classes:
            # ties aside, what is lost among the items seen so far is least
            seen = [i for g in groups for i in g]
            best = max(
                ((a, b) for b in range(len(groups)) for a in range(b)),
                key=lambda p: restricted(bigrams, seen, groups, p),
            )
            groups[best[0]] += groups.pop(best[1])
    out = np.zeros(len(bigrams), int)
    for n, g in enumerate(groups):
        out[g] = n
    return out


def restricted(bigrams, seen, groups, pair):
    merged = [g for i, g in enumerate(groups) if i not in pair] + [groups[pair[0]] + groups[pair[1]]]
    total = bigrams.sum()
    t = np.array([[bigrams[np.ix_(a, b)].sum() for b in merged] for a in merged])
    l, r = t.sum(axis=1), t.sum(axis=0)
    return sum(t[i, j] / total * math.log(t[i, j] * total / l[i] / r[j]) for i in range(len(t)) for j in range(len(t)) if t[i, j] > 0)


def test_brown_merging_equals_brute_force():
    bigrams = np.random.default_rng(3).integers(1, 50, (9, 9)).astype(float)
    assert class_ngrams.brown_classes(bigrams, 3).tolist() == brute_brown(bigrams, 3).tolist()


def test_gains_of_moves_equal_the_likelihoods():
    rng = np.random.default_rng(4)
    bigrams = rng.integers(0, 6, (12, 12)).astype(float)
    classes = rng.integers(0, 4, 12)

    def table(of):
        out = np.zeros((4, 4))
        np.add.at(out, (of[:, None], of[None, :]), bigrams)
        return out

    outside = bigrams - np.diag(np.diag(bigrams))
    right, left = (np.stack([m[:, classes == c].sum(axis=1) for c in range(4)], axis=1) for m in (outside, outside.T))
    gains = class_ngrams.move_gains(right, left, np.diag(bigrams), classes, table(classes))
    for w in range(12):
        for c in range(4):
            moved = classes.copy()
            moved[w] = c
            assert gains[w, c] == pytest.approx(class_ngrams.likelihood(table(moved)) - class_ngrams.likelihood(table(classes)))


def test_words_beyond_the_seeds_are_clustered_by_their_use(spark, documents, monkeypatch):
    """Words of one shape but of two uses end in two classes."""
    monkeypatch.setattr(class_ngrams, "SEEDS", 2)
    rng = np.random.default_rng(1)
    nouns, verbs = ([f"{c}{d}{e}o" for d in "bcdf" for e in "ghjkl"] for c in "nv")
    texts = [(i, " ".join(f"the {rng.choice(nouns)} will {rng.choice(verbs)}" for _ in range(20))) for i in range(60)]
    table = documents(texts).select("text")
    counts = class_ngrams.count_terms(table, lambda: class_ngrams.words_of)
    model = class_ngrams.train(table, counts, 5)

    def classes(words):
        return set(model.word_class[model.vocabulary.code(pa.array(words)).number].tolist())

    assert len(classes(nouns)) == len(classes(verbs)) == 1 and classes(nouns) != classes(verbs)
    assert class_ngrams.shape_of(nouns[0].encode()) == class_ngrams.shape_of(verbs[0].encode())


def test_texts_are_coded_as_word_by_word():
    texts = ["the Cat", None, "", "  \x0b", "Z \u00e9\u00c9 9! " + "long" * 9, "CAT cat\ncat"]
    keys = np.sort(class_ngrams.hash_spans(*class_ngrams.utf8_bytes(pa.array(["cat", "the"])))[0])
    coded = class_ngrams.Vocabulary(keys).code(pa.array(texts))
    words = [(i, w) for i, t in enumerate(texts) for w in class_ngrams.words_of(t or "")]
    assert list(zip(coded.owner.tolist(), coded.words(np.arange(len(words))))) == words
    known = coded.number >= class_ngrams.FIRST
    assert [w for (_, w), k in zip(words, known) if k] == [b"the", b"cat", b"cat", b"cat", b"cat"]
    assert [int(n) for n in coded.number[~known]] == [class_ngrams.shape_of(w) for (_, w), k in zip(words, known) if not k]
    ends = np.flatnonzero(coded.line() == class_ngrams.END)
    assert np.diff(ends).tolist() == [1 + sum(i == j for j, _ in words) for i in range(len(texts))]


@pytest.mark.parametrize("at_once", [500_000, 7])
def test_pairs_and_contexts_equal_counters(spark, documents, monkeypatch, at_once):
    monkeypatch.setattr(class_ngrams, "PAIRS_AT_ONCE", at_once)
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["a", "bb", "cc", "d1", "e"], int(rng.integers(0, 12)))) for _ in range(60)] + ["", None]
    keys = np.sort(class_ngrams.hash_spans(*class_ngrams.utf8_bytes(pa.array(["a", "bb", "cc"])))[0])
    vocabulary = class_ngrams.Vocabulary(keys)
    table = documents(list(enumerate(texts))).repartition(5)
    pairs = class_ngrams.count_pairs(table, vocabulary, 400)
    want = Counter()
    for t in texts:
        line = vocabulary.code(pa.array([t], pa.string())).line().tolist()
        want.update(zip(line, line[1:]))
    rows = pairs.toArrow()
    left, right, n = (class_ngrams._column(rows, c) for c in "abc")
    assert dict(zip(zip(left.tolist(), right.tolist()), n.tolist())) == want and len(left) == len(want) == sum(r["m"] for r in rows.to_pylist())
    near = Counter()
    for (a, b), c in want.items():
        if a >= class_ngrams.FIRST:
            near[a, 2 * b] += c
        if b >= class_ngrams.FIRST:
            near[b, 2 * a + 1] += c
    rows = class_ngrams.word_contexts(pairs).toArrow()
    word, size, other, n = (class_ngrams._column(rows, c) for c in "abcd")
    assert dict(zip(zip(np.repeat(word, size).tolist(), other.tolist()), n.tolist())) == near and len(set(word.tolist())) == len(word)
    group = np.arange(vocabulary.size) % 5
    tables = np.zeros((5, 5))
    for (a, b), c in want.items():
        tables[a % 5, b % 5] += c
    assert (class_ngrams._grouped_bigrams(pairs, group, 5) == tables).all()


def prose(rng, n):
    return " ".join(rng.choice(["the", "cat", "sat", "on", "a", "Mat,", "dog.", "ran", "far"]) for _ in range(n))


def test_quality_tells_shouting_from_prose(spark, documents):
    rng = np.random.default_rng(0)
    good = [(i, prose(rng, int(rng.integers(5, 80)))) for i in range(90)]
    bad = [(100 + i, prose(rng, int(rng.integers(20, 80))).upper().replace(" ", "!! ")) for i in range(90)]
    table = documents([*good, *bad, (500, None), (501, ""), (None, "The cat sat."), (3, good[3][1])])
    labels = spark.createDataFrame([(d, 1, 0) for d, _ in good] + [(d, 0, 0) for d, _ in bad] + [(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality_scores(table, labels).collect()
    assert len(rows) == 184
    wrong = [r for r in rows if r.doc_id is not None and r.doc_id < 200 and r.predicted != (r.doc_id < 100)]
    assert not wrong and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows if r.doc_id is not None)
    kept = quality.keep_good(table, labels)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect() if r.doc_id in range(200)} == set(range(90))


def plain_statistics(text):
    """The fifteen statistics of one text, character by character."""
    data = (text or "").encode()
    kinds = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", None, " \t\x0b\x0c\r", "\n", ",.", "!?", "|<>{}\\"]
    of = lambda b: 3 if b >= 128 else next((i for i, k in enumerate(kinds) if k and chr(b) in k), 9)
    kind = [of(b) for b in data]
    count = [kind.count(k) for k in range(10)]
    words = re.findall(rb"[^ \t\n\x0b\x0c\r]+", data)
    signs = sum(kind[i] in (7, 9) and kind[i - 1] <= 3 and kind[i + 1] not in (4, 5) for i in range(1, len(kind) - 1))
    lines = data.split(b"\n")
    repeated = sum(map(len, lines)) - sum(map(len, set(lines)))
    same = sum(a.lower() == b.lower() for a, b in zip(words, words[1:]))
    share = lambda part, whole, usual, few: math.sqrt(min(1, (part + usual * few) / (whole + few)))
    n, w, letters = len(data), len(words), count[0] + count[1] + count[3]
    return [
        math.log((n - count[4] - count[5] + 120) / (w + 20)),
        share(count[1], letters, 0.04, 100), share(count[2], n, 0.01, 100), share(count[3], n, 0.05, 100),
        share(count[4], n, 0.15, 100), share(count[5], n, 0.01, 100), share(count[6], w, 0.15, 20), share(count[7], w, 0, 20),
        share(count[8], w, 0, 20), share(count[9], w, 0, 20), share(count[9] + count[7], n, 0, 100), share(repeated, n, 0, 100),
        share(sum(65 <= x[0] <= 90 for x in words), w, 0.15, 20), share(signs, w, 0, 20), share(same, w, 0.01, 20),
    ]


def test_scores_equal_a_plain_discriminant(spark, documents):
    """Statistics character by character, covariances by definition, densities by determinants and inverses."""
    rng = np.random.default_rng(3)
    marks = ["#", "!", "a#b", "x!y", "|", "A", "Zz", "9", "é", ".", ",", "\n", "\t", "same", "same", "line\nline\nline"]
    texts = [(i, " ".join(rng.choice([*marks, "the", "Cat", "ran"], int(rng.integers(0, 40))))) for i in range(120)]
    texts += [(200, None), (201, ""), (202, "#"), (203, "!a"), (204, "end!"), (205, "word " * 20_000), (None, "the Cat"), (5, texts[5][1])]
    labels = [(i, i % 2, 0) for i in range(110)] + [(5, 0, 0), (300, 1, 0), (None, 1, 0), (6, None, 0), (7, 5, 0)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    x = {i: np.array(plain_statistics(t)) for i, (_, t) in enumerate(texts)}
    out = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 3 == 1
    learned = [(x[i], q) for i, (d, _) in enumerate(texts) for e, q, _ in labels if d is not None and d == e and q in (0, 1) and not out(d)]
    by_class = [np.array([v for v, q in learned if q == c]) for c in (0, 1)]
    covariances = [np.cov(v.T, bias=True) for v in by_class]
    n = np.array([len(v) for v in by_class])
    within = sum(k * c for k, c in zip(n, covariances)) / n.sum()
    logs = []
    for c in (0, 1):
        own = 0.9 * covariances[c] + 0.1 * np.diag(np.diag(covariances[c]))
        own = 0.9 * own + 0.1 * within + 1e-3 * np.eye(15)
        apart = [v - by_class[c].mean(axis=0) for v in x.values()]
        density = [-0.5 * (d @ np.linalg.inv(own) @ d + np.linalg.slogdet(own)[1]) for d in apart]
        logs.append(np.array(density) + math.log((n[c] + 1) / (n.sum() + 2)))
    want = sorted((repr(d), out(d), round(1 / (1 + math.exp(min(700, max(-700, a - b)))), 8)) for (d, _), a, b in zip(texts, *logs))
    for parts in (1, 7):
        rows = quality.quality_scores(documents(texts).repartition(parts), known).collect()
        assert sorted((repr(r.doc_id), r.held_out, round(r.score, 8)) for r in rows) == want
        assert all(r.predicted == (r.score >= 0.5) for r in rows)


def test_no_labels_or_no_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality.quality_scores(documents([(1, "a b")]), none).collect()] == [0.5]
    assert quality.quality_scores(documents([]), none).collect() == []


def test_held_out_accuracy_on_the_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality.quality_scores(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)
