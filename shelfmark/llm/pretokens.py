"""Splits texts into the pre-tokens of a public tokenizer file, as its library does.

A pre-token is encoded alone, whatever stands around it. Texts whose characters
all lie in the ranges below are split by a Python pattern equal to the file's
own there; any other text, and any with a special string inside, is split by
the library itself.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata

import numpy as np

# The split patterns of the two files, with {L} letters, {N} numbers and {S} white space.
PATTERNS = {
    "byte_bpe_50k.json": r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+",
    "word_bpe_49k.json": r"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{S}{L}{N}]+",
}
# Characters up to Latin Extended-A, and common marks and currency signs. No normal form or
# lower-casing leads out of them, and their classes are the same in all Unicode versions in use.
PLAIN_LETTERS = range(0x180)
OUTSIDE = re.compile("[^\x00-ſ‐-‧‰-⁞₠-₿]")
SPACES = "\\t-\\r \\x85\\xa0"
# Fixed value: how the vocabulary of the second file marks the last id of a pre-token.
WORD_END = "</w>"
LINES = 512


def _plain(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in PLAIN_LETTERS if unicodedata.category(chr(c))[0] == kind)


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PreTokenizer:
    """The pre-tokens of texts, and their ids, by one tokenizer file."""

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.lowers = self.tokenizer.normalizer is not None
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, specials)) + ")")
        self.opening = sorted({s[0] + s[1] for s in specials})
        pattern = PATTERNS[name].replace("{L}", _plain("L")).replace("{N}", _plain("N")).replace("{S}", SPACES)
        self.find = re.compile(pattern).findall

    def split(self, text: str) -> list[str]:
        """The pre-tokens in order; a special string inside the text is one of its own."""
        if OUTSIDE.search(text) is None and not (any(o in text for o in self.opening) and self.special.search(text)):
            return self.find(text.lower() if self.lowers else text)
        found = []
        for i, part in enumerate(self.special.split(text)):
            if i % 2:
                found.append(part)
                continue
            if self.lowers:
                part = self.tokenizer.normalizer.normalize_str(part)
            places = self.tokenizer.pre_tokenizer.pre_tokenize_str(part)
            found.extend(part[a:b] for _, (a, b) in places)
        return found

    def encode(self, pretokens: list[str]) -> list[list[int]]:
        """The ids of each pre-token alone."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(pretokens, add_special_tokens=False)]

    @functools.cached_property
    def ends_word(self) -> np.ndarray:
        """Whether an id is the last of a pre-token, in a vocabulary that marks these."""
        vocabulary = self.tokenizer.get_vocab()
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        return ends

    def encode_words(self, pretokens: list[str]) -> list[bytes]:
        """The ids of each pre-token alone, as little-endian words, for a file that marks the ends of words.

        Many are encoded as lines of one text and told apart by their last ids. Where
        there are not as many ends as lines, as with special strings, each is
        encoded alone.
        """
        out: list[bytes] = []
        parts = [pretokens[i : i + LINES] for i in range(0, len(pretokens), LINES)]
        for part, found in zip(parts, self.encode(["\n".join(part) for part in parts])):
            ids = np.array(found, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(part) or (len(ends) and ends[-1] != len(ids)):
                out += [np.array(x, "<u4").tobytes() for x in self.encode(part)]
                continue
            data, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
            out += [data[a:b] for a, b in zip(cuts, cuts[1:])]
        return out


@functools.lru_cache(maxsize=2)
def pretokenizer(name: str) -> PreTokenizer:
    """One per worker and file."""
    return PreTokenizer(name)
