"""Suffix arrays of one shard: Larsson-Sadakane refinement and Kasai's common prefixes, in numpy.

A shard is about a megabyte of segments of UTF-8 text. Suffixes are compared to
the end of their segment, never beyond; of equal ones the earlier comes first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Keeps the first n of 8 bytes.
FIRST = np.array([0, *(((1 << 64) - 1) ^ ((1 << (64 - 8 * n)) - 1) for n in range(1, 9))], np.uint64)

#: Three ranks of so many bits are a key of 63.
RANK_BITS = 21


@dataclass
class Buffer:
    """Segments one after the other, each followed by a zero; text bytes count from 1, which UTF-8 leaves room for."""

    words: np.ndarray  # the 8 bytes from each position on, zero beyond the segment
    left: np.ndarray  # bytes from each position to the end of its segment
    starts: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, segments: list[bytes]) -> Buffer:
        lengths = np.array([len(s) for s in segments], np.int64)
        starts = np.cumsum(lengths + 1) - lengths - 1
        text = np.frombuffer(b"\0".join(segments) + bytes(9), np.uint8).astype(np.uint64) + np.uint64(1)
        words = text
        for width in (1, 2, 4):
            words = (words[:-width] << np.uint64(8 * width)) | words[width:]
        n = int((lengths + 1).sum())
        left = np.repeat(starts + lengths, lengths + 1) - np.arange(n)
        return cls(words[:n] & FIRST[np.minimum(left, 8)], left, starts, lengths)


def suffix_order(text: Buffer) -> np.ndarray:
    """Positions in the order of their suffixes.

    Suffixes are sorted by their first bytes, those that fit a word beside the
    position. Groups that are not yet single are then sorted by the ranks of the
    suffixes as far along as they already agree, and as far again where three
    ranks fit a key, which triples the compared length each time, and doubles it
    otherwise. Suffixes shorter than the compared length are single from the
    start, so segments never run together, and what stands beyond their end in a
    key decides nothing: the rank before it is of one suffix alone.
    """
    n = len(text.words)
    bits = RANK_BITS if n < 1 << RANK_BITS else 32
    depth = (64 - bits) // 8
    packed = text.words >> np.uint64(64 - 8 * depth) << np.uint64(bits) | np.arange(n, dtype=np.uint64)
    packed.sort()
    order = (packed & np.uint64((1 << bits) - 1)).view(np.int64)
    packed >>= np.uint64(bits)
    short = text.left[order] < depth
    head = np.ones(n + 1, bool)
    head[1:n] = (packed[1:] != packed[:-1]) | short[1:] | short[:-1]
    rank = np.empty(n, np.int64 if bits > 31 else np.int32)
    first = np.maximum.accumulate(np.where(head[:n], np.arange(n), 0))  # slot of each group's first
    rank[order] = first
    slots = np.flatnonzero(~(head[:n] & head[1:]))
    found, first = order[slots], first[slots]
    while len(slots):
        keys = first << bits | rank[found + depth]
        if bits == RANK_BITS:
            keys = keys << bits | rank.take(found + 2 * depth, mode="clip")
        sorting = np.argsort(keys)
        keys, found = keys[sorting], found[sorting]
        order[slots] = found
        head = np.ones(len(slots) + 1, bool)
        head[1:-1] = keys[1:] != keys[:-1]
        first = np.maximum.accumulate(np.where(head[:-1], slots, 0))
        rank[found] = first
        rest = np.flatnonzero(~(head[:-1] & head[1:]))
        slots, found, first = slots[rest], found[rest], first[rest]
        depth *= 3 if bits == RANK_BITS else 2
    return order


def common_prefixes(text: Buffer, order: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix of at least ``least`` bytes: its predecessor, and the bytes they share, up to ``least``.

    Kasai's scan in text order, with all places side by side: where a suffix and
    its predecessor follow equal bytes, the suffixes from there are neighbours
    too, and share one byte more. So only the others are compared, to the first
    byte that differs, and each tells those that follow it.
    """
    n = len(order)
    before = np.empty(n, np.int64)
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    if text.lengths.max(initial=0) < least:
        return before, shared
    byte = (text.words >> np.uint64(56)).astype(np.uint8)  # zero where a segment ends
    follows = byte[:-1] == byte.take(before[1:] - 1, mode="clip")
    follows &= (byte[:-1] != 0) & (before[1:] > 0)
    compared = np.concatenate([[True], ~follows])
    here = np.flatnonzero(compared & (text.left >= least))
    there = before[here]
    here, there = here[there >= 0], there[there >= 0]
    at, todo = here, there
    while len(at):
        differing = text.words[at] ^ text.words[todo]
        whole = differing == 0
        ended = ~whole
        shared[here[ended]] = at[ended] - here[ended] + _equal_bytes(differing[ended])
        here, at, todo = here[whole], at[whole] + 8, todo[whole] + 8
        limit = np.minimum(text.left[at - 8], text.left[todo - 8])
        full = limit > 8
        shared[here[~full]] = at[~full] - 8 + limit[~full] - here[~full]
        here, at, todo = here[full], at[full], todo[full]
    known = np.maximum.accumulate(np.where(compared, np.arange(n), 0))
    shared = np.where(text.left >= least, np.minimum(shared[known] - np.arange(n) + known, least), 0)
    return before, shared


def _equal_bytes(differing: np.ndarray) -> np.ndarray:
    return sum((differing < np.uint64(1 << (64 - 8 * n))).astype(np.int64) for n in range(1, 8))


def repeated(text: Buffer, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a ``least``-byte string starts that also starts elsewhere in the shard, and the first of each such string."""
    order = suffix_order(text)
    before, shared = common_prefixes(text, order, least)
    again = shared >= least
    found = again.copy()
    found[before[again]] = True
    return found, (text.left >= least) & ~again
