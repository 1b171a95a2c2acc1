"""Packing documents into sequences of bounded length by swap-based local search.

Each text is encoded and closed by an end id; one longer than a sequence is cut into full pieces, the
first of which may be shorter. Pieces are dealt at random to groups of bounded size. A group starts with
pieces of over half a sequence, then the others as they were dealt, each in the bin with least room that takes
it. Then the search takes underfull bins from the emptiest up: documents move out of one, or change places one for
one, two for one or one for two with documents of another that are shorter together, always the exchange
that takes most out. Each raises the sum of squared fills, so the search ends: when a round over all underfull
bins finds no exchange, or the lower bound is met.

Null texts are empty and still give a piece of one id. Repeated rows are packed as often as they come.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm.common import arrow_batch, materialize, read, text_or_empty
from leafline.llm.words import encoder

SIZE = 1024
#: Pieces that one task packs together.
GROUP = 8192
END_ID = 2
END = END_ID.to_bytes(4, "little")
PIECE = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
#: Texts and characters that are encoded together, or a single text where that is longer.
TEXTS, CHARACTERS = 512, 1 << 22


def token_ids(texts: list[str], path: str) -> list[np.ndarray]:
    """The ids of each text without added special tokens; a special string in a text is its own id."""
    return [np.frombuffer(ids, "<u4") for ids in encoder(path)(texts)]


def _portions(texts: list[str]):
    """Bounds of runs of texts."""
    first = held = 0
    for k, text in enumerate(texts):
        if k > first and (k - first == TEXTS or held + len(text) > CHARACTERS):
            yield first, k
            first, held = k, 0
        held += len(text)
    if texts:
        yield first, len(texts)


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids_of, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for a, b in _portions(texts):
                out = []
                for doc_id, ids in zip(ids_of[a:b], token_ids(texts[a:b], tokenizer), strict=True):
                    n = len(ids) + 1
                    first = n % size or size
                    bounds = [0, *range(first, n, size), n]
                    sums = [zlib.crc32(ids[x:y]) for x, y in zip(bounds, bounds[1:])]
                    sums[-1] = zlib.crc32(END, sums[-1])
                    out += [(doc_id, k, x, y - x, crc) for k, (x, y, crc) in enumerate(zip(bounds, bounds[1:], sums))]
                yield arrow_batch({n: (list(v), t) for (n, t), v in zip(PIECE.items(), zip(*out), strict=True)})

    return text_or_empty(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def start_bins(order: list[int], lengths: list[int], size: int) -> list[list[int]]:
    """Bins of item numbers, each item in turn put into the bin with least room that takes it. Open bins are
    listed by room, and a bit string tells which rooms have any."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    some = 0
    for x in order:
        n = lengths[x]
        if fits := some >> n:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                some ^= 1 << room
            bins[b].append(x)
        else:
            room, b = size, len(bins)
            bins.append([x])
        if left := room - n:
            by_room[left].append(b)
            some |= 1 << left
    return bins


class Search:
    """Moves and swaps between underfull bins. Bins that are full stay as they are."""

    def __init__(self, bins: list[list[int]], lengths: list[int], size: int):
        self.bins, self.size = bins, size
        self.fill = np.array([sum(lengths[x] for x in b) for b in bins], np.int64)
        open_ = np.flatnonzero(self.fill < size)
        items = [x for b in open_ for x in bins[b]]
        self.at = {x: k for k, x in enumerate(items)}
        # One entry for each item of an underfull bin, and one of length zero for each such bin: to swap
        # with that is to move.
        self.item = np.array(items + [-1] * len(open_), np.int64)
        self.length = np.array([lengths[x] for x in items] + [0] * len(open_), np.int64)
        self.home = np.array([b for b in open_ for _ in bins[b]] + open_.tolist(), np.int64)
        self.least = -(-int(self.fill.sum()) // size)
        self.full = len(bins) - len(open_)
        #: What held since the last move: entries by their number of items, and bins that had no exchange.
        self.seen: dict[int, tuple] = {}
        self.stuck: set[int] = set()

    def count(self) -> int:
        return int((self.fill > 0).sum())

    def put(self, x: int, b: int) -> None:
        self.seen.clear()
        self.stuck.clear()
        k = self.at[x]
        self.bins[self.home[k]].remove(x)
        self.fill[self.home[k]] -= self.length[k]
        self.home[k] = b
        self.bins[b].append(x)
        self.fill[b] += self.length[k]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of two items of one bin, for all such pairs."""
        order = np.argsort(self.home[: len(self.at)], kind="stable")
        home, one, two = self.home[order], [], []
        for apart in range(1, len(order)):
            near = np.flatnonzero(home[apart:] == home[:-apart])
            if not len(near):
                break
            one.append(order[near])
            two.append(order[near + apart])
        return (np.concatenate(one), np.concatenate(two)) if one else (np.zeros(0, np.int64),) * 2

    def entries(self, items: int) -> tuple[np.ndarray, ...]:
        """What a group can be changed for, of one item (or none) or of two: length, home, the home's fill, the length of a group that takes
        its place at most, and a key by length, that and number; and the numbers of two items."""
        if items not in self.seen:
            first, second = self.pairs() if items == 2 else (None, None)
            length = self.length if items == 1 else self.length[first] + self.length[second]
            home = self.home if items == 1 else self.home[first]
            fill = self.fill[home]
            most = np.minimum(length + self.size - fill, self.size)
            key = (length * (self.size + 1) + most) * len(length) + np.arange(len(length))
            self.seen[items] = length, home, fill, most, key, first, second
        return self.seen[items]

    def improve(self, b: int) -> bool:
        """The exchange that takes most out of bin b for a bin at least as full: a group of one or two goes where it
        then fits, and what comes back is nothing or one, or two for one where there is no such exchange."""
        if b in self.stuck:
            return False
        own = self.bins[b]
        at = np.array([self.at[x] for x in own])
        one, two = np.triu_indices(len(own), 1)
        groups = np.concatenate([self.length[at], self.length[at[one]] + self.length[at[two]]])
        if found := self.best(b, groups, 1):
            g, entry = found
            back = [entry] if entry < len(self.at) else []
        else:
            if not (found := self.best(b, groups[: len(own)], 2)):
                self.stuck.add(b)
                return False
            g, entry = found
            *_, first, second = self.entries(2)
            back = [first[entry], second[entry]]
        to = int(self.home[back[0]] if back else self.home[entry])
        for k in back:
            self.put(int(self.item[k]), b)
        for k in at[[g]] if g < len(at) else at[[one[g - len(at)], two[g - len(at)]]]:
            self.put(int(self.item[k]), to)
        return True

    def best(self, b: int, groups: np.ndarray, items: int) -> tuple[int, int] | None:
        """(group, entry) of the exchange of one of groups, given by their lengths, for an entry of another bin
        that takes most out of b."""
        length, home, fill, most, key, *_ = self.entries(items)
        able = np.flatnonzero((home != b) & (fill >= self.fill[b]) & (most > length))
        if not len(able) or not len(groups):
            return self.overtaking(b, groups, items)
        # By length of a group: least (length back, length that fits, entry) among those that take it.
        least = np.full(self.size + 2, np.iinfo(np.int64).max)
        np.minimum.at(least, most[able], key[able])
        least = np.minimum.accumulate(least[::-1])[::-1]
        back = least[np.minimum(groups, self.size + 1)]
        gain = np.where(back < np.iinfo(np.int64).max, groups - back // len(length) // (self.size + 1), 0)
        g = int(gain.argmax())
        return (g, int(back[g] % len(length))) if gain[g] > 0 else self.overtaking(b, groups, items)

    def overtaking(self, b: int, groups: np.ndarray, items: int) -> tuple[int, int] | None:
        """As best(), for bins less full than b that become fuller than b was."""
        length, home, fill, *_ = self.entries(items)
        able = np.flatnonzero((home != b) & (fill > 0) & (fill < self.fill[b]))
        if not len(able) or not len(groups):
            return None
        gain = groups[:, None] - length[able]
        gain[(gain > self.size - fill[able]) | (gain <= self.fill[b] - fill[able])] = 0
        g, k = divmod(int(gain.argmax()), len(able))
        return (g, int(able[k])) if gain[g, k] > 0 else None

    def run(self) -> list[list[int]]:
        """Rounds over all underfull bins until one finds no exchange, or the bins are as few as can be."""
        found = True
        while found and self.count() > self.least:
            found = False
            for b in np.argsort(self.fill, kind="stable").tolist():
                if 0 < self.fill[b] < self.size:
                    while self.bins[b] and self.improve(b):
                        found = True
                    if not self.bins[b] and self.count() <= self.least:
                        break
        return [b for b in self.bins if b]


def pack_lengths(lengths: list[int], size: int = SIZE) -> list[list[int]]:
    """Item numbers by bin, for lengths of 1 to size in the order in which they were dealt."""
    order = sorted(range(len(lengths)), key=lambda x: 2 * lengths[x] <= size)
    return Search(start_bins(order, lengths, size), lengths, size).run()


def pack(cut: DataFrame, size: int = SIZE, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to pieces. cut: a written table, so that the dealing repeats on a retry."""
    groups = max(1, -(-cut.count() // group))
    dealt = cut.withColumn("_dealt", F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id())).withColumn("_group", F.pmod("_dealt", F.lit(groups)))

    def run(key, pdf):
        # One order whatever the shuffle's, so that a task that is run again packs alike.
        pdf = pdf.sort_values(["_dealt", "doc_id", "piece", "ids_crc32"], kind="stable", ignore_index=True)
        lengths = pdf["length"].tolist()
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for number, members in enumerate(pack_lengths(lengths, size)):
            sequence[members] = (int(key[0]) << 32) | number
            offset[members] = np.cumsum([0] + [lengths[x] for x in members[:-1]])
        return pdf.assign(sequence_id=sequence, offset=offset)[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return dealt.groupBy("_group").applyInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    return pack(materialize(pieces(docs, tokenizer, size), "packing-pieces"), size)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
