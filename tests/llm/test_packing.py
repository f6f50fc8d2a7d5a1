import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from shelfmark.llm import packing
from shelfmark.llm.pretokens import PreTokenizer, pretokenizer

HARD = ["a", "B", " ", "\n", "  ", "'s", "'", "é", "É", "İ", "²", "!", "<|endoftext|>", "<|startoftext|>", " ", "\x1c", "Σ", "ς", "中", "é", "’", "…", "9", "_", "ª", "K", "ŉ", " ", "\x00"]


@given(st.lists(st.sampled_from(HARD), max_size=30).map("".join), st.sampled_from(["byte_bpe_50k.json", "word_bpe_49k.json"]))
@settings(max_examples=300, deadline=None)
def test_pretokens_give_the_ids_of_the_library(text, name):
    maker: PreTokenizer = pretokenizer(name)
    ids = [i for x in maker.encode(maker.split(text)) for i in x]
    assert ids == maker.tokenizer.encode(text, add_special_tokens=False).ids


@given(st.lists(st.lists(st.sampled_from([*HARD, "word", "it's", "1a"]), max_size=6).map("".join), max_size=40))
@settings(max_examples=300, deadline=None)
def test_words_encoded_as_lines_have_the_ids_of_each_alone(texts):
    maker = pretokenizer("word_bpe_49k.json")
    words = list(dict.fromkeys(w for t in texts for w in maker.split(t)))
    assert maker.encode_words(words) == [np.array(x, "<u4").tobytes() for x in maker.encode(words)]


@given(st.lists(st.integers(1, 100), min_size=1, max_size=120))
@settings(max_examples=200, deadline=None)
def test_bins_hold_every_item_once_and_no_more_than_best_fit(lengths):
    lengths = np.array(lengths)
    bins = packing.pack_group(lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert max(lengths[b].sum() for b in bins) <= 100
    assert len(bins) <= len(packing._best_fit(lengths, 100))


def test_swaps_empty_a_bin_that_best_fit_leaves():
    lengths = np.random.default_rng(0).integers(1300, 1500, 600)
    assert len(packing.pack_group(lengths)) < len(packing._best_fit(lengths, packing.CAPACITY))


def check_places(rows, capacity=packing.CAPACITY):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pieces_are_the_ids_of_the_library(documents):
    long = "thing " * 9_000
    texts = [(1, "Hello wOrld"), (2, None), (3, ""), (4, long), (5, "Hello wOrld"), (5, "Hello wOrld"), (None, "x <|endoftext|> y")]
    rows = packing.pack_documents(documents(texts)).collect()
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for doc_id, text in texts:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for i in range(0, len(ids), 4096):
            part = ids[i : i + 4096]
            expected.append((doc_id, i // 4096, i, len(part), zlib.crc32(part.tobytes())))
    assert sorted(map(repr, expected)) == sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
    assert check_places(rows) == -(-sum(r.length for r in rows) // 4096)
    assert packing.pack_documents(documents([])).collect() == []


def test_a_task_that_forgets_gives_the_same_ids():
    rng = np.random.default_rng(5)
    texts = [[f"w{i}" for i in rng.zipf(1.3, 40) % 500] for _ in range(60)] + [[]]
    maker = pretokenizer("word_bpe_49k.json")
    want = [np.array([i for w in t for i in maker.encode([w])[0]], "<u4").tobytes() for t in texts]
    for most in (1, 20, 60, 10_000):
        known = packing.KnownIds("word_bpe_49k.json", most)
        got = [ids for at in range(0, len(texts), 3) for ids in known.of(texts[at : at + 3])]
        assert got == want and len(known.ids) <= max(most, 120)
    assert known.of([]) == []


def test_several_groups_lose_little(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(x), "clash") for i, x in enumerate(rng.integers(1, 60, 900))]
    frame = spark.createDataFrame(rows, "row long, length long, sequence string")
    packed = packing.pack(frame, capacity=100, group=50).collect()
    assert sorted(r.row for r in packed) == list(range(900))
    assert check_places(packed, 100) <= -(-sum(r.length for r in packed) // 100) + 4
