"""Hashed text features over Arrow batches, in numpy over whole buffers rather than word by word.

A token is a run of letters, digits and bytes beyond ASCII, or a run of ASCII punctuation; white space
parts tokens. Each counts once as itself, lower-cased and hashed, once as its shape (kind, length, case,
digits), once for each of its first four, five and six bytes, so that words of one stem share features
however they end, and once more where it repeats the token before. A text's features are these counts
divided by DAMP more than its number of tokens, so that a linear score is a mean over tokens, texts of
any length compare, and a few words don't swing a short text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

HASHED = 1 << 16
SHAPES = 2 * 16 * 3 * 3
REPEATS = HASHED + SHAPES
STEMS = REPEATS + 1
STEM_BYTES = (4, 5, 6)
SIZE = STEMS + HASHED
DAMP = 50
#: Bytes of text that are looked at together.
STEP = 1 << 18

_BYTES = np.arange(256)
_SPACE = ((_BYTES >= 9) & (_BYTES <= 13)) | (_BYTES == 32)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_WORD = _DIGIT | _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_KIND = np.where(_SPACE, 0, np.where(_WORD, 2, 1)).astype(np.uint8)
_LOWER = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
#: A number for each byte at each of 64 places, summed to a token's hash; white space adds nothing.
_PLACED = np.random.default_rng(20).integers(0, 1 << 63, (64, 256), dtype=np.uint64)
_PLACED[:, _SPACE] = 0


def _segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (text, start, end) of about STEP bytes; a longer text is cut at white space."""
    group, held = [], 0
    for text in range(len(offsets) - 1):
        a, end = int(offsets[text]), int(offsets[text + 1])
        while a < end:
            b = min(end, a + STEP)
            while b < end and not _SPACE[data[b]]:
                b += 1
            group.append((text, a, b))
            held += b - a
            a = b
            if held >= STEP:
                yield group
                group, held = [], 0
    if group:
        yield group


def _stems(placed: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token, stem) for each beginning of STEM_BYTES that a token is long enough for."""
    tokens, total = np.arange(len(starts)), placed[starts]
    found = []
    for k in range(1, max(STEM_BYTES)):
        longer = size[tokens] > k
        tokens = tokens[longer]
        total = total[longer] + placed[starts[tokens] + k]
        if k + 1 in STEM_BYTES:
            mixed = (total ^ (total >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
            found.append((tokens, STEMS + ((mixed >> np.uint64(32)) % np.uint64(HASHED)).astype(np.int64)))
    return np.concatenate([t for t, _ in found]), np.concatenate([s for _, s in found])


def _tokens(texts: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, hash, place of the text in the group, start, kind, bytes, placed) of the tokens of each group of texts."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    if not len(texts) or offsets[-1] == offsets[0]:
        return
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    for group in _segments(data, offsets):
        part = np.concatenate([data[a:b] for _, a, b in group])
        edges = np.cumsum([0] + [b - a for _, a, b in group])
        kind = _KIND[part]
        first = kind != np.concatenate(([0], kind[:-1]))
        first[edges[:-1]] = True
        starts = np.flatnonzero(first & (kind > 0))
        if not len(starts):
            continue
        lengths = np.diff(np.append(starts, len(part)))
        place = np.arange(len(part), dtype=np.int32) - np.concatenate((np.zeros(starts[0], np.int32), np.repeat(starts, lengths).astype(np.int32)))
        placed = _PLACED[place & 63, _LOWER[part]]
        hashed = np.add.reduceat(placed, starts)
        hashed ^= hashed >> np.uint64(29)
        at = np.searchsorted(edges, starts, "right") - 1
        text = np.array([t for t, _, _ in group], np.int64)[at]
        yield text, hashed, at, starts, kind, part, placed


def hashed_tokens(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, hashed) of each token, as token_features gives them, without what that makes besides."""
    for text, hashed, *_ in _tokens(texts):
        yield text, (hashed % np.uint64(HASHED)).astype(np.int64)


def token_features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, hashed, shape, repeats) of each token: its text's number and its features' numbers; then
    (text, stem) of each stem."""
    for text, hashed, at, starts, kind, part, placed in _tokens(texts):
        size = np.add.reduceat((kind > 0).view(np.uint8), starts, dtype=np.int32)
        upper = np.add.reduceat(_UPPER[part].view(np.uint8), starts, dtype=np.int32)
        digits = np.add.reduceat(_DIGIT[part].view(np.uint8), starts, dtype=np.int32)
        three = lambda n: (n > 0).astype(np.int32) + (n == size)
        shape = ((kind[starts] - 1) * 16 + np.minimum(size, 15)) * 9 + three(upper) * 3 + three(digits)
        again = np.zeros(len(starts), bool)
        again[1:] = (hashed[1:] == hashed[:-1]) & (at[1:] == at[:-1])
        token, stem = _stems(placed, starts, size)
        yield text, (hashed % np.uint64(HASHED)).astype(np.int64), HASHED + shape.astype(np.int64), again, text[token], stem


def vectors(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(feature numbers, values) of each text."""
    keys, counts, tokens = [], [], np.zeros(len(texts))
    for text, hashed, shape, again, stem_text, stem in token_features(texts):
        every = np.concatenate([text * SIZE + hashed, text * SIZE + shape, text[again] * SIZE + REPEATS, stem_text * SIZE + stem])
        k, n = np.unique(every, return_counts=True)
        keys.append(k)
        counts.append(n)
        tokens += np.bincount(text, minlength=len(texts))
    if not keys:
        return [(np.zeros(0, np.int64), np.zeros(0))] * len(texts)
    k, where = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(where, np.concatenate(counts))
    owner = k // SIZE
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [(k[a:b] % SIZE, n[a:b] / (tokens[i] + DAMP)) for i, (a, b) in enumerate(zip(edges, edges[1:]))]


def scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of each text's features times their values, by column; zero for a text without tokens."""
    total, tokens = np.zeros((len(texts), weights.shape[1])), np.zeros(len(texts))
    for text, hashed, shape, again, stem_text, stem in token_features(texts):
        for c in range(weights.shape[1]):
            w = weights[:, c]
            total[:, c] += np.bincount(text, w[hashed] + w[shape] + again * w[REPEATS], len(texts)) + np.bincount(stem_text, w[stem], len(texts))
        tokens += np.bincount(text, minlength=len(texts))
    return total / (tokens + DAMP)[:, None]
