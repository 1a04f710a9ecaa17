"""Byte-level BPE ids of many texts at once.

The pre-tokens of a slice of texts are found with numpy over its code points;
each distinct pre-token is encoded once (and kept in a bounded cache), and the
ids are gathered back.  Texts with a special token, or with characters whose
class differs between Unicode versions, go through the tokenizer whole.  The ids
equal those of ``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import base64
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd

#: fixed values: the code points with the White_Space property
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: blocks where recent Unicode versions assign characters
RECENT = [(0x1C80, 0x1C90), (0xA7C0, 0xA800), (0x10500, 0x1E600)]
OTHER, LETTER, NUMBER, SPACE, DOUBT = range(5)
CACHE = 150_000
LONGEST_CACHED = 64


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    table[WHITE_SPACE] = SPACE
    for a, b in RECENT:
        table[a:b] = DOUBT
    return table


def pretoken_starts(cp: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of the byte-level scheme begin: runs of letters,
    numbers or other signs, each with one blank before it, the contractions, and
    what white space is left.  ``first`` marks the first code point of each text."""
    n = len(cp)
    last = np.r_[first[1:], True]  # the last code point of a text
    start = first | np.r_[True, kind[1:] != kind[:-1]]
    space = kind == SPACE
    before_word = space & ~last & np.r_[~space[1:], False]  # last white space of a run, a word follows
    start |= before_word
    blank = before_word & (cp == 32)
    joined = np.r_[False, blank[:-1]]
    start &= ~joined
    # contractions: an apostrophe that begins a pre-token, then s t m d, or re ve ll
    quote = np.flatnonzero((cp == 39) & start & ~last)
    quote = quote[kind[quote + 1] == LETTER]
    if len(quote):
        pad = np.r_[cp, 0, 0]
        a, b = pad[quote + 1], pad[quote + 2]
        two = (quote + 2 < n) & ~np.r_[first, True, True][quote + 2]
        short = np.isin(a, [115, 116, 109, 100])
        long = two & ((((a == 114) | (a == 118)) & (b == 101)) | ((a == 108) & (b == 108)))
        begins = np.r_[start, True, True]
        begins[quote[short | long] + 1] = False
        begins[quote[short] + 2] = True
        begins[quote[long & ~short] + 3 - (quote[long & ~short] + 3 > n)] = True
        start = begins[:n]
    return np.flatnonzero(start)


class Encoder:
    """Ids of texts; ``name``: the vocabulary among the public tokenizers, or
    ``paths``: its two files (tokenizer JSON, ranks)."""

    def __init__(self, name: str = "byte_bpe_50k", paths: tuple[str, str] | None = None):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        whole, ranks = paths or (public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"))
        self.whole = Tokenizer.from_file(whole)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.piece = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                       special_tokens={}).encode_ordinary
        self.cache: dict[str, list[int]] = {}

    def _pretoken(self, s: str) -> list[int]:
        if len(s) > LONGEST_CACHED:
            return self.piece(s)
        ids = self.cache.get(s)
        if ids is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            ids = self.cache[s] = self.piece(s)
        return ids

    def encode(self, bodies: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(bodies)
        table = _classes()
        plain, codes = [], []
        for k, body in enumerate(bodies):
            cp = np.frombuffer(body.encode("utf-32-le"), np.uint32)
            if not len(cp):
                out[k] = np.zeros(0, np.uint32)
            elif any(s in body for s in self.special) or (not body.isascii() and (table[cp] == DOUBT).any()):
                out[k] = np.array(self.whole.encode(body, add_special_tokens=False).ids, np.uint32)
            else:
                plain.append(k)
                codes.append(cp)
        if not plain:
            return out
        cp = np.concatenate(codes)
        begin = np.cumsum([0, *map(len, codes)])
        first = np.zeros(len(cp), bool)
        first[begin[:-1]] = True
        at = pretoken_starts(cp, table[cp], first)
        size = np.diff(np.r_[at, len(cp)])
        place = np.arange(len(cp)) - np.repeat(at, size)
        with np.errstate(over="ignore"):
            power = np.cumprod(np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64))
            mixed = (cp.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
            sums = np.add.reduceat(mixed * power[place], at)
        code, _ = pd.factorize(sums)
        distinct = code.max() + 1
        one = np.zeros(distinct, np.int64)
        one[code[::-1]] = np.arange(len(code))[::-1]  # the first of each
        like = np.repeat(at[one][code], size) + place
        if (size[one][code] != size).any() or (cp[np.minimum(like, len(cp) - 1)] != cp).any():  # two pre-tokens with one sum
            for k in plain:
                out[k] = np.array(self.whole.encode(bodies[k], add_special_tokens=False).ids, np.uint32)
            return out
        line = "".join(bodies[k] for k in plain)
        ids = [self._pretoken(line[a:a + n]) for a, n in zip(at[one].tolist(), size[one].tolist())]
        count = np.fromiter(map(len, ids), np.int64, distinct)
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(count.sum()))
        offset = np.cumsum(count) - count
        many = count[code]
        end = np.cumsum(many)
        all_ids = flat[np.repeat(offset[code] - (end - many), many) + np.arange(int(end[-1]))]
        cut = np.r_[0, end][np.searchsorted(at, begin)]
        for k, a, b in zip(plain, cut[:-1], cut[1:]):
            out[k] = all_ids[a:b]
        return out


@lru_cache(maxsize=2)
def encoder(name: str = "byte_bpe_50k", paths: tuple[str, str] | None = None) -> Encoder:
    return Encoder(name, paths)
