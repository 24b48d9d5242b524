"""Byte-pair merges of many words at once, in numpy.

All words take their best merge in one step; a word that has none left is
done.  The merge of lowest rank in a word comes first, from the left, as the
tokenizers library has it.
"""

from __future__ import annotations

import functools
import json

import numpy as np

from .hashing import U, ragged

NO_RANK = np.int32(2**31 - 1)
SLOTS = 17


def byte_names() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [x for x in range(256) if x not in set(plain)]
    return {x: chr(x) for x in plain} | {x: chr(256 + i) for i, x in enumerate(others)}


class Merges:
    """The merge table of a tokenizer file, as arrays of a few MB; ``kind`` holds every id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        self.kind = np.uint16 if max([*model["vocab"].values(), *(x["id"] for x in file["added_tokens"])]) < 1 << 16 else np.uint32
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        names = byte_names()
        self.usable = max(vocab.values()) < 1 << 16 and all(names[b] in vocab and names[b] + suffix in vocab for b in range(256)) and not model.get("ignore_merges")
        self.first = np.array([vocab.get(names[b], 0) for b in range(256)], np.int32)
        self.last = np.array([vocab.get(names[b] + suffix, 0) for b in range(256)], np.int32)
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.uint64)
        self.keys, self.ranks = np.full(1 << SLOTS, 2**63, U), np.full(1 << SLOTS, NO_RANK, np.int32)
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self.slots(keys).tolist(), strict=True)):
            while self.keys[slot] != 2**63:
                slot = (slot + 1) % (1 << SLOTS)
            self.keys[slot], self.ranks[slot] = key, rank

    @staticmethod
    def slots(keys: np.ndarray) -> np.ndarray:
        return ((keys * U(0x9E3779B97F4A7C15)) >> U(64 - SLOTS)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(U) << U(16) | right.astype(U)
        slots = self.slots(keys)
        there = self.keys[slots]
        out = self.ranks[slots]
        wrong = np.flatnonzero((there != keys) & (there != U(2**63)))
        out[wrong] = NO_RANK
        while len(wrong):
            slots[wrong] = (slots[wrong] + 1) % (1 << SLOTS)
            there = self.keys[slots[wrong]]
            hit = there == keys[wrong]
            out[wrong[hit]] = self.ranks[slots[wrong[hit]]]
            wrong = wrong[~hit & (there != U(2**63))]
        return out

    def run(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words data[start:end], none empty, end to end, and how many each has."""
        lengths = end - start
        at = ragged(start, lengths)
        symbols = self.first[data[at]]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.last[data[at[ends - 1]]]
        word = np.repeat(np.arange(len(start)), lengths)
        done_symbols, done_words = [], []
        while len(symbols):
            rank = np.full(len(symbols), NO_RANK, np.int32)
            inner = word[:-1] == word[1:]
            rank[:-1][inner] = self.rank(symbols[:-1][inner], symbols[1:][inner])
            heads = np.flatnonzero(np.concatenate([[True], ~inner]))
            least = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.append(heads, len(symbols))))
            over = least == NO_RANK
            if over.any():
                done_symbols.append(symbols[over])
                done_words.append(word[over])
                symbols, word, rank, least = symbols[~over], word[~over], rank[~over], least[~over]
                if not len(symbols):
                    break
            chosen = rank == least
            touching = chosen[1:] & chosen[:-1]
            if touching.any():  # of a run of overlapping merges every other one, from its left
                where = np.flatnonzero(chosen)
                fresh = np.concatenate([[True], np.diff(where) > 1])
                begin = where[np.maximum.accumulate(np.where(fresh, np.arange(len(where)), 0))]
                chosen[where[(where - begin) % 2 == 1]] = False
            at = np.flatnonzero(chosen)
            symbols[at] = self.made[rank[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, word = symbols[stay], word[stay]
        words, ids = np.concatenate([*done_words, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*done_symbols, np.zeros(0, np.int32)])
        order = np.argsort(words, kind="stable")
        return ids[order], np.bincount(words, minlength=len(start))


@functools.cache
def merges_of(path: str) -> Merges:
    """The table of a file, read once; the driver sends it to the workers, which then need not read the file's JSON."""
    return Merges(path)
