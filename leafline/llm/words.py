"""Token ids by the tokenizers library, each different word encoded once for many texts.

The byte-level tokenizer never joins what stands on both sides of a single space between two signs that
aren't white space: a token takes at most the space before it. So a text is cut before such spaces, and
ids of the parts, put together, are those of the whole. A part's ids are kept for the texts to come, within a
bound: those that no recent text had go first, and are encoded again when they come again.
"""

from __future__ import annotations

import os
import re
from array import array
from codecs import charmap_decode
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np

#: What byte-level vocabularies write for a byte: itself where that shows as a sign of Latin-1, else a sign from 256 on.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SIGNS = {b: b for b in _SHOWN} | {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}
SPACE, LINE = chr(_SIGNS[32]), chr(_SIGNS[10])
_TABLE = "".join(chr(_SIGNS[b]) for b in range(256))
#: A word of Latin letters and the punctuation behind it, and the like on the next line: a piece each for the merges, as is the
#: line's end, in any version of Unicode.
_WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ſ]+)([.,;:!?]*)(?:\n([A-Za-zÀ-ÖØ-öø-ſ]+)([.,;:!?]*))?")
#: Parts and their length that are kept in a worker at most: about 150 MB.
KEPT, KEPT_LENGTH = 1 << 19, 64
#: Parts that are put together again for the tokenizer, since a call of its own costs more than a short part; and words for the merges.
TOGETHER, WORDS = 64, 512
#: Pieces without a space in front whose ids are kept in a worker at most.
BARE = 1 << 14
#: Signs that some version of Unicode counted as white space are never cut at.
_CUT = re.compile(" (?=[^\\s᠎​⁠﻿])(?<=[^\\s᠎​⁠﻿] )")
#: White space that isn't a space or a line's end, and signs that some version took for it.
_UNUSUAL = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")


def cut(text: str) -> list[str]:
    """The parts of a text. Where all its spaces are single ones between other signs, which is soon seen, it is cut at each."""
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or _UNUSUAL.search(text):
        return _CUT.split(text)
    return text.split(" ")


def shown(text: str) -> str:
    """The signs that byte-level vocabularies write for the bytes of a text."""
    return charmap_decode(text.encode(), "strict", _TABLE)[0]


class Encoder:
    """Ids of texts as little-endian 32-bit numbers. A special string in a text is its own id; none are added."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        # Spark runs a worker for each core; threads of its own would only compete.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        #: The merges alone, for pieces between spaces.
        self.merges = Tokenizer(self.whole.model)
        self.merges.pre_tokenizer = CharDelimiterSplit(" ")
        #: Ids of a space and the part behind it, by the part; and those of the texts before, of which what comes again is taken over.
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: Ids of runs of punctuation behind words, and of words that begin a line.
        self.bare: dict[str, bytes] = {}
        self.line = self.merged(LINE)
        vocabulary = self.whole.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[number for token, number in vocabulary.items() if token.startswith(SPACE)]] = True

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 4096):
            out += [array("I", e.ids).tobytes() for e in self.whole.encode_batch(texts[at : at + 4096], add_special_tokens=False)]
        return out

    def together(self, parts: list[str]) -> list[bytes]:
        """Ids of a space and each part. In a text that is put together of parts without spaces, each begins at a token with a space."""
        groups = [parts[at : at + TOGETHER] for at in range(0, len(parts), TOGETHER)]
        return self.apart(self.whole, groups, [f" {' '.join(g)}" for g in groups])

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of a space and each word of letters."""
        groups = [words[at : at + WORDS] for at in range(0, len(words), WORDS)]
        return self.apart(self.merges, groups, [shown(f" {' '.join(g)}").replace(SPACE, f" {SPACE}") for g in groups])

    def apart(self, tokenizer, groups: list[list[str]], texts: list[str]) -> list[bytes]:
        """Ids of the members of each group, whose text is given, where each begins at a token with a space and no other token has one."""
        out: list[bytes] = []
        for group, found in zip(groups, tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            first = (np.flatnonzero(self.opens[ids]) * 4).tolist()
            if len(first) == len(group):
                held = ids.tobytes()
                out += [held[a:b] for a, b in zip(first, [*first[1:], len(held)])]
            else:
                out += self.encode([f" {p}" for p in group])
        return out

    def merged(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.whole.model.tokenize(piece)]).tobytes()

    def piece(self, text: str) -> bytes:
        """Ids of a piece without a space, which most texts have."""
        if (ids := self.bare.get(text)) is None:
            ids = self.merged(shown(text))
            if len(self.bare) < BARE and len(text) <= KEPT_LENGTH:
                self.bare[text] = ids
        return ids

    def parts(self, new: list[str]) -> dict[str, bytes]:
        """Ids of a space and each part. Words and punctuation are pieces that the library's merges take as
        they are; other parts go through all of the tokenizer."""
        known, plain, closed, others, spaced = self.kept, [], [], [], []
        for part in new:
            if part.isascii() and part.isalpha():
                plain.append(part)
            elif not (word := _WORD.fullmatch(part)):
                (spaced if " " in part else others).append(part)
            elif len(word[1]) == len(part):
                plain.append(part)
            else:
                closed.append((part, *word.groups()))
        out = dict(zip(plain, self.words(plain), strict=True))
        bases = list({base for _, base, *_ in closed if base not in known and base not in out})
        more, piece = dict(zip(bases, self.words(bases), strict=True)), self.piece
        for part, base, end, line, closing in closed:
            ids = known.get(base) or out.get(base) or more[base]
            if end:
                ids += piece(end)
            if line:
                ids += self.line + piece(line)
                if closing:
                    ids += piece(closing)
            out[part] = ids
        out.update(zip(others, self.together(others), strict=True))
        out.update(zip(spaced, self.encode([f" {p}" for p in spaced]), strict=True))
        return out

    def over(self, texts: list[str], put: Callable[[bytes, Iterator[bytes]], object]) -> list:
        """put(ids of the first part, those of the others) of each text."""
        heads, rests = zip(*[(head, rest) for head, *rest in map(cut, texts)]) if texts else ((), ())
        new = set(chain.from_iterable(rests)).difference(self.kept)
        if len(self.kept) + len(new) > KEPT // 2:
            self.older, self.kept = self.kept, {}
            new = set(chain.from_iterable(rests))
        older = self.older
        again = {part: older[part] for part in new if part in older}
        self.kept.update(again)
        new = list(new.difference(again))
        self.kept.update(self.parts(new))
        ids = self.kept.__getitem__
        out = [put(head, map(ids, rest)) for head, rest in zip(self.encode(list(heads)), rests, strict=True)]
        for part in (p for p in new if len(p) > KEPT_LENGTH):
            del self.kept[part]
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        return self.over(texts, lambda head, rest: head + b"".join(rest))

    def counts(self, texts: list[str]) -> list[int]:
        """Numbers of ids, which aren't put together for it."""
        return self.over(texts, lambda head, rest: (len(head) + sum(map(len, rest))) // 4)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One to a worker, which keeps it from task to task."""
    return Encoder(path)
