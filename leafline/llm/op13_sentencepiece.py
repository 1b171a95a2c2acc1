"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text becomes symbols, one to a character. All adjacent pairs that make a piece of the vocabulary stand in
an agenda, ordered by the score of that piece and then by place; the best pair becomes one symbol and its new
neighbours enter the agenda, until none is left. Pairs that have changed meanwhile are passed over. Symbols
that are no piece become the bytes of their characters, or the unknown piece where a vocabulary has no bytes.

Text is cut where no piece of the vocabulary reaches across: between letters and other signs, and before a run of the space
sign; a vocabulary that has a piece across such a place isn't cut. A part's ids are kept for the texts to come, within a
bound; what lies beyond it is encoded again, not left out.

Every text of an Arrow batch is also encoded and decoded by the sentencepiece library. Where the two differ
the library's result is returned and agreed is false.

Null texts are empty: no ids but those that are added. Texts are encoded whole, however long: time is n log n
in the longest part. Repeated and null doc_ids name no row, each row gets its own result; an empty table gives
none. Only doc_id and text are read, so further columns of any name can't clash.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from leafline.llm.common import arrow_batch, read, rows, text_or_empty

SPACE = "▁"
#: Kinds of pieces in a model file, and its fields. Fixed values of the file format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
BPE = 2
#: Parts that are kept in a worker at most, in two halves of which the older goes when the younger is full, and their length.
KEPT, KEPT_LENGTH = 1 << 20, 32
#: Symbols of a part up to which its agenda is a list that is searched, beyond it is a heap.
SHORT = 24
#: A run of letters (most signs beyond ASCII among them) or of other signs, with the space signs before it.
PARTS = re.compile(rf"{SPACE}*(?:[A-Za-z\xC0-\u1FFF\u2070-\u2580\u2582-\U0010FFFF]+|[\x00-@\[-`{{-\xBF\u2000-\u206F]+)|{SPACE}+")
NONE = float("inf")
#: Characters of the texts that are handed to the library together.
TOGETHER = 1 << 20


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte, at = data[at], at + 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, data[at : at + size]
            at += size


@dataclass
class Vocabulary:
    """ids of the pieces that merges may make, with their scores; kinds and texts of all pieces by id."""

    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    prefix: bool = True

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        out, trainer, normalizer = cls(), {}, {}
        with open(path, "rb") as f:
            for number, value in _fields(f.read()):
                if number == 1:
                    own = dict(_fields(value))
                    out.pieces.append(own[1].decode())
                    out.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                    out.kinds.append(own.get(3, NORMAL))
                elif number in (2, 3):
                    (trainer if number == 2 else normalizer).update(_fields(value))
        out.prefix = bool(normalizer.get(3, 1))
        # Spaces written as the sign, before words; nothing replaced, folded or matched before the merges.
        unlike = {"a model type other than merges": trainer.get(3, 1) != BPE, "a table of replaced characters": bool(normalizer.get(2)), "folded spaces": bool(normalizer.get(4, 1)), "spaces left as they are": not normalizer.get(5, 1), "spaces behind words": bool(trainer.get(24, 0)), "pieces of the user": USER_DEFINED in out.kinds, "unused pieces": UNUSED in out.kinds}
        if found := [k for k, v in unlike.items() if v]:
            raise ValueError(f"{path} has {', '.join(found)}")
        return out


class Kept(dict):
    """Ids by part; those that are missing are made, and kept if the part is short. Half of what may be kept is here; what was here
    before stands in old, and comes back when it is asked for. Tuples of numbers, which the garbage collector needn't visit."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, part: str) -> tuple[int, ...]:
        if (ids := self.old.get(part)) is None:
            ids = tuple(self.make(part))
        if len(part) <= KEPT_LENGTH:
            if len(self) >= KEPT // 2:
                self.old = dict(self)
                self.clear()
            self[part] = ids
        return ids


class Codec:
    """Ids of texts and texts of ids."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        self.merges = {p: i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k == NORMAL}
        #: What a symbol is looked up as at last: pieces that merges don't make are known there too.
        self.known = {p: i for i, p in reversed(list(enumerate(v.pieces)))} | self.merges
        self.unknown = v.kinds.index(UNKNOWN)
        self.bytes = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.named = list(map(str, range(len(v.pieces))))
        self.shown = [" ⁇ " if k == UNKNOWN else "" if k in (CONTROL, BYTE) else p.replace(SPACE, " ") for p, k in zip(v.pieces, v.kinds)]
        #: A piece that is cut in two, or begins within a part and ends in another.
        crossed = any(len(PARTS.findall(p)) > 1 for p in self.merges)
        self.cut = re.compile(".+", re.S) if crossed else PARTS
        self.score = {p: -v.scores[i] for p, i in self.merges.items()}
        self.kept = Kept(self.part_ids)

    def normalised(self, text: str) -> str:
        return (SPACE if self.vocabulary.prefix and text else "") + text.replace(" ", SPACE)

    def symbols(self, part: str) -> list[str]:
        """What the merges leave of a part's characters."""
        symbols, score = list(part), self.score.get
        if len(symbols) > SHORT:
            return self._by_heap(symbols)
        # Scores of the pairs in their order, negative: the least is the best, and its first place the leftmost.
        agenda = [score(a + b, NONE) for a, b in zip(symbols, symbols[1:])]
        while agenda and (best := min(agenda)) is not NONE:
            at = agenda.index(best)
            symbols[at] += symbols.pop(at + 1)
            del agenda[at]
            if at < len(agenda):
                agenda[at] = score(symbols[at] + symbols[at + 1], NONE)
            if at:
                agenda[at - 1] = score(symbols[at - 1] + symbols[at], NONE)
        return symbols

    def _by_heap(self, symbols: list[str]) -> list[str]:
        score = self.score
        before, behind = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        agenda: list[tuple[float, int, int, int]] = []

        def enter(left: int, right: int) -> None:
            made = symbols[left] + symbols[right]
            if made in score:
                heapq.heappush(agenda, (score[made], left, right, len(made)))

        for right in range(1, len(symbols)):
            enter(right - 1, right)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != size:
                continue  # a pair that has changed meanwhile
            symbols[left], symbols[right] = symbols[left] + symbols[right], ""
            behind[left] = after = behind[right]
            if after >= 0:
                before[after] = left
                enter(left, after)
            if before[left] >= 0:
                enter(before[left], left)
        return [s for s in symbols if s]

    def part_ids(self, part: str) -> list[int]:
        out, known = [], self.known
        for symbol in self.symbols(part):
            i = known.get(symbol, self.unknown)
            if i == self.unknown and self.bytes:
                out.extend(map(self.bytes.__getitem__, symbol.encode()))
            else:
                out.append(i)
        return out

    def encode(self, text: str) -> list[int]:
        out = list(chain.from_iterable(map(self.kept.__getitem__, self.cut.findall(self.normalised(text)))))
        if not self.bytes and self.unknown in out:  # a run of unknown symbols is one
            out = [i for i, own in groupby(out) for _ in ([0] if i == self.unknown else own)]
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids: controls show nothing, bytes in a row are UTF-8 (a sign of its own for each wrong one),
        and the space that encoding put in front goes."""
        shown = self.shown
        if self.byte_of.keys().isdisjoint(ids):
            out = "".join(map(shown.__getitem__, ids))
        else:
            runs = groupby(ids, self.byte_of.__contains__)
            out = "".join(_text_of(bytes(map(self.byte_of.__getitem__, run))) if is_bytes else "".join(map(shown.__getitem__, run)) for is_bytes, run in runs)
        first = next((i for i in ids if self.vocabulary.kinds[i] != CONTROL), None)
        starts = first is not None and first not in self.byte_of and self.vocabulary.pieces[first].startswith(SPACE)
        return out[1:] if self.vocabulary.prefix and starts else out


def _text_of(data: bytes) -> str:
    """UTF-8, with U+FFFD for each byte that is part of no character."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as e:
            out += [data[at : at + e.start].decode(), "�"]
            at += e.start + 1
    return "".join(out)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One to a worker, which keeps it from task to task."""
    return Codec(Vocabulary.load(path))


@lru_cache(maxsize=2)
def _library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _together(texts: Iterator[tuple[int | None, bytes]]) -> Iterator[list[tuple[int | None, str]]]:
    """Texts in lists of about TOGETHER characters."""
    held, size = [], 0
    for doc_id, text in texts:
        held.append((doc_id, text.decode()))
        size += len(text)
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def checked(own: Codec, library, texts: list[str], added: tuple[int, ...]) -> tuple[list[list[int]], list[str], list[bool]]:
    """Ids with those added, decoded text, and whether the library has the same, of each text; the library's where it hasn't."""
    mine = [[*own.encode(t), *added] for t in texts]
    shown = list(map(own.decode, mine))
    wanted = [[*x, *added] for x in library.encode(texts, out_type=int, num_threads=1)]
    back = library.decode(wanted, num_threads=1)
    agreed = [a == b and s == t for a, b, s, t in zip(mine, wanted, shown, back, strict=True)]
    choose = lambda a, b: [x if same else y for x, y, same in zip(a, b, agreed, strict=True)]
    return choose(mine, wanted), choose(shown, back), agreed


def encode_and_decode(docs: DataFrame, model: str, added: tuple[int, ...] = (), ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, agreed of every row of docs(doc_id, text).

    model: path of the vocabulary, the same on all machines. added: ids put behind those of each text. ids: the ids
    and the decoded text follow as columns ids and decoded.
    """

    def run(batches):
        own, library = codec(model), _library(model)
        for batch in batches:
            for held in _together(rows(batch)):
                full, back, agreed = checked(own, library, [t for _, t in held], added)
                digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
                out = {
                    "doc_id": ([d for d, _ in held], pa.int64()),
                    "n_tokens": (list(map(len, full)), pa.int64()),
                    "ids_sha256": ([digest(" ".join(map(own.named.__getitem__, x))) for x in full], pa.string()),
                    "decoded_sha256": (list(map(digest, back)), pa.string()),
                    "agreed": (agreed, pa.bool_()),
                }
                yield arrow_batch(out | ({"ids": (full, pa.list_(pa.int32())), "decoded": (back, pa.string())} if ids else {}))

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agreed boolean"
    return text_or_empty(docs).mapInArrow(run, schema + (", ids array<int>, decoded string" if ids else ""))


def end_id(model: str) -> int:
    return _library(model).eos_id()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return encode_and_decode(read(spark, sf_dir, "documents"), model, (end_id(model),))
