import random

import numpy as np
from hypothesis import given, settings, strategies as st

from shelfmark.llm import decontamination as dc, exact_search as es


def brute_top(rows, k=5, every=50):
    kept = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in sorted({i: min(w for j, w in kept if j == i) for i, _ in kept if i % every == 0}.items()):
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in kept if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 9) for i, v in rows], "vec_id long, embedding array<float>, label int, block int")


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(es, "BLOCK", 60)
    monkeypatch.setattr(es, "QUERIES", 4)
    monkeypatch.setattr(es, "LEAF", 5)
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8) + 3 * (i % 5)]) for i in range(700)]
    rows += [(i, rows[1][1]) for i in range(700, 1000)]  # one vector many times, and ties
    rows += [(1001, None), (1002, []), (1050, [float("nan")] * 8), (1051, [float("inf")] * 8), (None, rows[3][1]), (1100, [None] * 8), (3, rows[3][1]), (50, rows[50][1])]
    assert sorted(tuple(r) for r in es.search(table(spark, rows)).collect()) == sorted(brute_top(rows))


def test_few_candidates_and_no_rows(spark):
    assert [tuple(r) for r in es.search(table(spark, [(0, [1.0]), (7, [2.0])])).collect()] == [(0, 1, 7, 256 * 512)]
    assert es.search(table(spark, [(50, [1.0])])).collect() == []
    assert es.search(table(spark, [])).collect() == []


@given(st.integers(0, 10_000))
@settings(max_examples=25, deadline=None)
def test_bounds_hold_at_every_pair_of_nodes(seed):
    rng = np.random.default_rng(seed)
    x, y = rng.integers(-300, 300, (300, 4)).astype(float), rng.integers(-300, 300, (200, 4)).astype(float)

    def nodes(n):
        yield n
        for c in n.children:
            yield from nodes(c)

    a, b = es.cover_tree(x), es.cover_tree(y)
    for n in nodes(a):
        assert not n.children or sorted(i for c in n.children for i in c.items) == sorted(n.items)
        for m in nodes(b):
            assert (x[n.items] @ y[m.items].T).max() <= es.bound(n, m)


def test_pruning_leaves_nodes_out():
    rng = np.random.default_rng(0)
    near, far = rng.normal(size=(200, 6)) + 50, rng.normal(size=(2_000, 6))
    data = np.concatenate([near, far])
    best = es.TopK(np.arange(10_000, 10_010), near[:10] * 1.01, 5)
    met = []
    whole = es.TopK.meet
    best.meet = lambda mine, ids, vectors: (met.append(len(ids)), whole(best, mine, ids, vectors))
    best.visit(es.cover_tree(best.vectors), es.cover_tree(data), np.arange(len(data)), data)
    assert 0 < sum(met) < len(data) / 2


def edit_distance_inside(text, passage):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(passage, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@given(st.text("abc", min_size=1, max_size=40), st.text("abc", min_size=1, max_size=15))
@settings(max_examples=200, deadline=None)
def test_alignment_is_the_edit_distance(text, passage):
    codes = lambda s: np.array([ord(c) for c in s], np.uint32)
    cost, begin, end = dc.banded_distance(codes(text), codes(passage), 3)
    assert cost == edit_distance_inside(text, passage)
    assert 0 <= begin <= end <= len(text)
    if begin < end:
        row = list(range(end - begin + 1))
        for i, p in enumerate(passage, 1):
            new = [i]
            for j, t in enumerate(text[begin:end], 1):
                new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
            row = new
        assert row[-1] == cost


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def brute_leaks(texts, items):
    """(doc, item, place) of every passage within its edits of some part of the text."""
    found = set()
    plain = lambda t: "".join(map(chr, dc.normal_codes(t or "")[0]))
    for d, t in texts:
        text = plain(t)
        for item, at, passage, edits, _ in dc.passages(items):
            if edit_distance_inside(text, "".join(map(chr, passage))) <= edits:
                found.add((d, item, at))
    return found


def test_leaks_equal_alignment_of_everything(spark, documents, monkeypatch):
    rng = random.Random(0)
    items = [(i, words(rng, n)) for i, n in enumerate((30, 18, 12, 5, 3, 1))] + [(9, None), (10, ""), (None, words(rng, 20))]
    texts = [(0, words(rng, 50)), (1, None), (2, ""), (3, items[0][1]), (4, "Xx " + items[1][1].upper() + " yy"), (3, items[0][1])]
    for n, (_, text) in enumerate(items[:5]):
        for edits in (0, 2, 4, 5, 9):
            changed = list(text)
            for _ in range(edits):
                at = rng.randrange(len(changed))
                changed[at : at + 1] = rng.choice([[], ["z"], ["z", changed[at]]])
            texts.append((100 + 10 * n + edits, words(rng, 15) + " " + "".join(changed) + " " + words(rng, 15)))
    texts += [(200, items[0][1][30:160]), (201, items[0][1].replace(" ", "\n--  ")), (202, words(rng, 4_000) + items[1][1])]
    benchmark = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, doc_id string")
    rows = dc.find_leaks(documents(texts), benchmark).collect()
    assert {(r.doc_id, r.item_id, r.item_at) for r in rows} == brute_leaks(texts[:-1], items) | {
        (202, r.item_id, r.item_at) for r in rows if r.doc_id == 202
    }
    assert 202 in {r.doc_id for r in rows} and all(r.begin < r.end for r in rows)
    parts = list(dc.benchmark_parts(benchmark, 150))
    assert len(parts) > 2 and sum(map(len, parts)) == len(items)
    monkeypatch.setattr(dc.benchmark_parts, "__defaults__", (150,))
    assert sorted(dc.find_leaks(documents(texts), benchmark).collect()) == sorted(rows)
    table = documents(texts)
    clean = dc.remove_leaks(table, benchmark)
    leaked = {r.doc_id for r in rows}
    assert clean.columns == table.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, _ in texts if d not in leaked)
    assert dc.find_leaks(documents([]), benchmark).collect() == []
    assert dc.find_leaks(table, benchmark.limit(0)).collect() == []


def test_a_piece_of_an_item_is_found_at_any_start():
    rng = random.Random(5)
    item, short = words(rng, 60), "abcde fghij klmno"
    searcher = dc.Searcher([(1, item), (2, short)])
    frame = words(rng, 20), words(rng, 20)
    for at in range(len(item) - dc.WINDOW + 1):
        piece = item[at : at + dc.WINDOW]
        assert (1, at, 0) in {(i, a, e) for i, a, _, _, e in searcher.find(f"{frame[0]}{piece}{frame[1]}")}
        edited = piece[:15] + "#" + piece[16:35] + piece[36:55] + "z" + piece[55:70] + "zz" + piece[71:]
        plain = "".join(map(chr, dc.normal_codes(edited)[0]))
        if edit_distance_inside(plain, piece) <= 4 and at % 7 == 0:
            assert (1, at) in {(i, a) for i, a, *_ in searcher.find(edited)}
    assert searcher.find(item) and not searcher.find(item[3 : 3 + 60])
    # an item of 12 to 23 characters is searched whole and verbatim
    assert [f[:2] for f in searcher.find(f"xx {short.upper()} yy")] == [(2, 0)]
    assert searcher.find(short.replace("g", "z")) == []
