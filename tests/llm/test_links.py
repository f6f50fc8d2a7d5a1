import random
from collections import defaultdict

import numpy as np
import pytest

from shelfmark.llm import near_duplicates as nd
from shelfmark.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) >= 5:
        return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    return frozenset([tuple(words)] if words else [])


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_force(texts):
    """(doc_id, n_shingles, component_id, kept) of rows with ids."""
    sets = [shingles(t) for _, t in texts]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                links.append((i, j))
    root = roots(range(len(texts)), links)
    least = defaultdict(list)
    for i, r in root.items():
        least[r].append(texts[i][0])
    return [(d, len(sets[i]), min(least[root[i]]), d == min(least[root[i]])) for i, (d, _) in enumerate(texts)]


def family(rng, base, n, changes):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(1000)}"
        out.append(" ".join(words))
    return out


def corpus(seed=0):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3_000)}"
    texts = [" ".join(word() for _ in range(rng.randint(1, 80))) for _ in range(60)]
    for size, changes in ((40, 3), (25, 6), (12, 9)):
        texts += family(rng, [word() for _ in range(120)], size, changes)
    shared = " ".join(word() for _ in range(40))  # a passage of many documents that are no copies
    texts += [shared + " " + " ".join(word() for _ in range(120)) for _ in range(40)]
    chain = [word() for _ in range(100)]  # each near its neighbour, the ends far apart
    for i in range(20):
        texts.append(" ".join(chain))
        chain[i * 4] = word()
    texts += [texts[0]] * 30 + ["", "  \t", "A b", "a B", "one two three four", None, texts[5].upper(), "x " * 20_000]
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [0])
def test_near_duplicates_equal_all_pairs(documents, seed):
    texts = corpus(seed)
    rows = nd.near_duplicates(documents(texts)).collect()
    assert sorted(tuple(r) for r in rows) == sorted(brute_force(texts))


def test_small_batches_cut_buckets(spark, documents):
    """Buckets that many batches hold give the same links."""
    texts = corpus(2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = nd.near_duplicates(documents(texts)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(tuple(r) for r in rows) == sorted(brute_force(texts))


def test_hot_buckets_are_cut_without_loss(documents, monkeypatch):
    """Salted stars, few hubs and blocks of pairs give the same links."""
    monkeypatch.setattr(nd, "BUCKET_ROWS", 4)
    monkeypatch.setattr(nd, "SAMPLED", 2)
    monkeypatch.setattr(nd, "HUBS", 2)
    texts = corpus(4)
    rows = nd.near_duplicates(documents(texts)).collect()
    assert sorted(tuple(r) for r in rows) == sorted(brute_force(texts))


def test_ids_that_are_null_or_repeat(documents):
    same = "a b c d e f g"
    rows = nd.near_duplicates(documents([(None, same), (4, same), (4, same), (None, "q"), (None, "q"), (2, None)])).collect()
    found = sorted(((repr(r.doc_id), r.component_id, r.kept) for r in rows), key=repr)
    assert found == sorted([("None", 4, False), ("4", 4, True), ("4", 4, True), ("None", None, True), ("None", None, True), ("2", 2, True)], key=repr)
    assert nd.near_duplicates(documents([])).collect() == []


def test_one_of_each_group_stays(documents):
    texts = corpus(3)
    table = documents([*texts, texts[0]])
    kept = nd.keep_one_each(table)
    assert kept.columns == table.columns
    expected = sorted(d for d, n, _, k in brute_force(texts) if k)
    got = sorted(r.doc_id for r in kept.collect())
    assert sorted(set(got)) == expected


def test_allowances_cover_every_split_of_errors():
    """Any 19 errors leave some chunk within its allowance, and then a key whose symbols all agree."""
    assert sum(errors + 1 for _, _, errors in nd.CHUNKS) > nd.ALLOWED
    assert sorted(i for first, size, _ in nd.CHUNKS for i in range(first, first + size)) == list(range(nd.SYMBOLS))
    patterns, rng = nd._patterns(), np.random.default_rng(0)
    for _ in range(2_000):
        wrong = set(rng.choice(nd.SYMBOLS, nd.ALLOWED, replace=False).tolist())
        assert any(not wrong & set(kept) for kept in patterns)


def test_signatures_differ_as_the_sets_do():
    rng = np.random.default_rng(0)
    apart = []
    for _ in range(300):
        shared, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (300, 50, 50))
        sets = [np.sort(np.concatenate([shared, x])) for x in (a, b)]
        symbols, bits = nd.signatures(np.concatenate(sets), np.array([0, 350, 700]))
        apart.append(((symbols[0] != symbols[1]).sum(), np.bitwise_count(bits[0] ^ bits[1]).sum()))
    mean, most = np.mean(apart, axis=0), np.max(apart, axis=0)
    assert abs(mean[0] - 32 * 0.25) < 0.6 and most[0] <= nd.ALLOWED
    assert abs(mean[1] - 128 * 0.125) < 0.9 and most[1] <= nd.BITS_APART


def test_components_equal_union_find(spark):
    rng = random.Random(0)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5)]
    links += [(2000, x) for x in range(2001, 2200)]
    rows = components(spark.createDataFrame(links, "x long, y long")).collect()
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.component for r in rows} == roots(nodes, [p for p in links if p[0] != p[1]])
    assert len(rows) == len(nodes)
    assert components(spark.createDataFrame([], "x long, y long")).collect() == []
