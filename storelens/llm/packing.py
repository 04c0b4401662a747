"""Order-preserving packing of token streams into windows by dynamic programming.

Documents keep the order in which the table hands them out. Their tokens form one stream per task;
a window is a stretch of at most ``CAPACITY`` tokens of it. Cuts may stand at the ends of documents and
sentences, and every ``CAPACITY`` tokens inside a sentence that is longer. The cost of a cut sequence is
the padding of its windows plus a penalty for each cut inside a document. With ``pos`` the position of a
cut, ``best(j) = min over i of best(i) + CAPACITY - (pos(j) - pos(i)) + penalty(j)``, so the best earlier
cut is the minimum of ``best(i) + pos(i)`` over the cuts at most ``CAPACITY`` back: a sliding minimum,
kept by a monotone queue in constant time per cut. A window whose length is a power of two needs no
padding; from ``LEAST_POWER`` on these are a few further transitions to exact positions.

A task packs its stream in stretches: the windows before the last one are final, the rest is carried
on, so memory is bounded by the stretch and the longest document. What is left at the end of a task is
cut into powers of two where that costs less than padding it.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.shared import only, tidy
from storelens.llm.words import NOT_BLANK, U64, Words, ranges, slices, text_bytes

CAPACITY = 4096
END_ID = 2
# Costs in tokens of padding: a cut at a sentence's end, one inside a sentence, and each window.
SENTENCE_CUT, HARD_CUT, WINDOW_COST = 0.25, 8.0, 2.0
# The shortest window that goes without padding on purpose, and the least tokens between two sentence cuts.
LEAST_POWER, LEAST_GAP = 128, 4
# Tokens that are cut together before the finished windows are handed on.
STRETCH = 1 << 18
# Words whose ids a worker remembers, and the slots of the table they are found in.
REMEMBERED, SLOT_BITS = 1_200_000, 22
SLOTS = 1 << SLOT_BITS
# Signs that end a sentence, signs that close a word, and the two together.
SENTENCE_ENDS, CLOSING = (b".", b"!", b"?"), b".,;:!?\"')]}*#$%&"
SENTENCE_END = re.compile(rb"[.!?][\"')\]}*#$%&]*$")


class WordIds:
    """Token ids of texts, word by word, for a tokenizer that drops white space and case.

    Such a tokenizer splits at white space first, so a text's ids are those of its blank-separated
    words in turn. Words repeat, so their ids are kept, found by the word's hash in an open-addressed
    table of arrays. A word's closing punctuation is a piece of its own to the tokenizer, so words that
    differ in case or punctuation only share the work. Texts with a control string go the plain way.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.slot_hash = np.zeros(SLOTS, U64)
        self.slot_word = np.zeros(SLOTS, np.int32)
        self.words, self.ids = 0, 0
        self.flat = np.empty(1 << 18, np.uint32)
        self.begin = np.empty(1 << 16, np.int32)
        self.size = np.empty(1 << 16, np.int32)
        self.stops = np.empty(1 << 16, bool)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each known word, -1 for the others."""
        found = np.full(len(hashes), -1, np.int64)
        left = np.arange(len(hashes))
        at = (hashes >> U64(64 - SLOT_BITS)).astype(np.int64)
        while len(left):
            held = self.slot_hash[at]
            same = held == hashes[left]
            found[left[same]] = self.slot_word[at[same]]
            go_on = ~same & (held != 0)
            left, at = left[go_on], (at[go_on] + 1) % SLOTS
        return found

    def _store(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        at = (hashes >> U64(64 - SLOT_BITS)).astype(np.int64)
        while len(hashes):
            free = np.flatnonzero(self.slot_hash[at] == 0)
            _, first = np.unique(at[free], return_index=True)
            taken = free[first]
            self.slot_hash[at[taken]] = hashes[taken]
            self.slot_word[at[taken]] = numbers[taken]
            rest = np.ones(len(hashes), bool)
            rest[taken] = False
            hashes, numbers, at = hashes[rest], numbers[rest], (at[rest] + 1) % SLOTS

    def _append(self, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray, stops: np.ndarray) -> None:
        new, total = self.words + len(sizes), self.ids + len(ids)
        if total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(total, np.uint32)])
        if new > len(self.begin):
            self.begin, self.size, self.stops = (np.concatenate([a, np.empty(new, a.dtype)]) for a in (self.begin, self.size, self.stops))
        self.flat[self.ids:total] = ids
        self.begin[self.words:new] = self.ids + np.cumsum(sizes) - sizes
        self.size[self.words:new] = sizes
        self.stops[self.words:new] = stops
        self._store(hashes, np.arange(self.words, new))
        self.words, self.ids = new, total

    def _tokenize(self, hashes: np.ndarray, words: list[bytes]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        self._append(hashes, sizes, ids, np.array([w[-1:] in SENTENCE_ENDS for w in words], bool))

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Store new words: each by its lower-cased core and its closing punctuation, where it has both."""
        plain, split, parts = [], [], []
        for k, word in enumerate(words):
            core = word.rstrip(CLOSING)
            if core[-1:].isalnum() and b"<|" not in word and (len(core) < len(word) or not word.islower()):
                split.append(k)
                parts += [core.lower(), word[len(core):]]
            else:
                plain.append(k)
        if plain:
            self._tokenize(hashes[plain], [words[k] for k in plain])
        if not split:
            return
        joined = b" ".join(p or b"." for p in parts)
        w = Words(np.frombuffer(joined, np.uint8), np.array([0, len(joined)]), NOT_BLANK, lower=False)
        part_hashes = w.hashes()
        _, first = np.unique(part_hashes, return_index=True)
        fresh = first[self._find(part_hashes[first]) < 0]
        if len(fresh):
            self._tokenize(part_hashes[fresh], [parts[k] or b"." for k in fresh.tolist()])
        numbers = self._find(part_hashes)
        sizes = np.where(np.fromiter(map(bool, parts), bool, len(parts)), self.size[numbers], 0)
        stops = np.array([bool(SENTENCE_END.search(words[k])) for k in split], bool)
        # A core that is itself one of the new words is stored by now.
        known = self._find(hashes[split]) >= 0
        pairs = sizes.reshape(-1, 2)
        ids = self.flat[ranges(self.begin[numbers].reshape(-1, 2)[~known].ravel(), pairs[~known].ravel())]
        self._append(hashes[split][~known], pairs[~known].sum(axis=1), ids, stops[~known])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per text its ids, and the positions after the ids of words that end a sentence."""
        if self.words > REMEMBERED:
            self.forget()
        w = Words(data, offsets, NOT_BLANK, lower=False)
        hashes = w.hashes()
        numbers = self._find(hashes)
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            places = missing[first]
            raw = data.tobytes()
            self._learn(new, [raw[a:b] for a, b in zip(w.starts[places].tolist(), w.ends[places].tolist())])
            numbers[missing] = self._find(hashes[missing])
        sizes = self.size[numbers].astype(np.int64)
        after = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[ranges(self.begin[numbers], sizes)]
        stops = np.flatnonzero(self.stops[numbers])
        ends, edges = after[stops + 1], np.searchsorted(stops, w.first)
        begins = after[w.first]
        for k in range(len(offsets) - 1):
            yield ids[begins[k]:begins[k + 1]], ends[edges[k]:edges[k + 1]] - begins[k]


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def cut_windows(positions: np.ndarray, penalties: np.ndarray, capacity: int = CAPACITY) -> list[int]:
    """Indices of the chosen cuts among ``positions`` (ascending, beginning with 0, no gap over ``capacity``).

    The last position is always cut. Returns the indices after the first one.
    """
    n = len(positions)
    pos, pen = positions.tolist(), penalties.tolist()
    exact: dict[int, list[int]] = {}
    power = min(LEAST_POWER, capacity)
    while power < capacity:
        back = np.searchsorted(positions, positions - power)
        back = np.minimum(back, n - 1)
        for j in np.flatnonzero((positions[back] == positions - power) & (positions >= power)).tolist():
            exact.setdefault(j, []).append(int(back[j]))
        power *= 2
    best, came = [0.0] * n, [0] * n
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, n):
        here = pos[j]
        low = here - capacity
        while pos[queue[0][1]] < low:
            queue.popleft()
        value, i = queue[0]
        cost = value + capacity - here
        for k in exact.get(j, ()):
            if best[k] < cost:
                cost, i = best[k], k
        cost += pen[j] + WINDOW_COST
        best[j], came[j] = cost, i
        value = cost + here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts, j = [], n - 1
    while j:
        cuts.append(j)
        j = came[j]
    return cuts[::-1]


def binary_cuts(length: int) -> list[int]:
    """``length`` as powers of two, largest first."""
    return [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


class _Stream:
    """The tokens not yet packed, and the pieces of the windows packed so far."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.docs: deque[tuple[object, np.ndarray, np.ndarray, int]] = deque()
        self.length = 0
        self.window = 0
        self.out: list[tuple] = []

    def add(self, key, ids: np.ndarray, ends: np.ndarray) -> None:
        """``ends``: positions in ``ids`` where a sentence ends."""
        self.docs.append((key, ids, ends, 0))
        self.length += len(ids)

    def _candidates(self) -> tuple[np.ndarray, np.ndarray]:
        places, costs, at = [np.zeros(1, np.int64)], [np.zeros(1)], 0
        for _, ids, ends, done in self.docs:
            inner = ends[(ends > done) & (ends < len(ids))] - done
            # Of sentence ends within a few tokens the last one counts.
            inner = inner[np.append(inner[1:] // LEAST_GAP != inner[:-1] // LEAST_GAP, True)] + at if len(inner) else inner
            at += len(ids) - done
            places += [inner, np.array([at])]
            costs += [np.full(len(inner), SENTENCE_CUT), np.zeros(1)]
        places, costs = np.concatenate(places), np.concatenate(costs)
        wide = np.flatnonzero(np.diff(places) > self.capacity)
        if len(wide):
            extra = np.concatenate([np.arange(places[k] + self.capacity, places[k + 1], self.capacity) for k in wide])
            places, costs = np.concatenate([places, extra]), np.concatenate([costs, np.full(len(extra), HARD_CUT)])
            order = np.argsort(places, kind="stable")
            places, costs = places[order], costs[order]
        return places, costs

    def pack(self, last: bool) -> None:
        """Pack what is held; all but the last window unless nothing follows."""
        if not self.length:
            return
        places, costs = self._candidates()
        cuts = [int(places[k]) for k in cut_windows(places, costs, self.capacity)]
        if not last:
            cuts = cuts[:-1]
        elif cuts:
            rest = cuts[-1] - (cuts[-2] if len(cuts) > 1 else 0)
            parts = binary_cuts(rest)
            if rest < self.capacity and HARD_CUT * (len(parts) - 1) < self.capacity - rest:
                begin = cuts.pop() - rest
                cuts += np.cumsum([begin + parts[0], *parts[1:]]).tolist()
        begin = 0
        for cut in cuts:
            self._emit(cut - begin)
            begin = cut

    def _emit(self, size: int) -> None:
        offset = 0
        while offset < size:
            key, ids, ends, done = self.docs[0]
            take = min(len(ids) - done, size - offset)
            piece = ids[done:done + take]
            self.out.append((key, done, take, zlib.crc32(piece.astype("<u4").tobytes()), len(ids), self.window, offset))
            offset += take
            if done + take == len(ids):
                self.docs.popleft()
            else:
                self.docs[0] = (key, ids, ends, done + take)
        self.length -= size
        self.window += 1


def _pack(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sequence ids hold the task's partition above 2**32, so tasks agree on nothing to be unique."""
        task = TaskContext.get()
        first = (task.partitionId() if task else 0) << 32
        words, stream = _word_ids(path), _Stream(capacity)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

        def made():
            rows, stream.out = stream.out, []
            columns = list(zip(*rows)) if rows else [()] * 7
            columns[5] = [first + w for w in columns[5]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            keys = batch.column(0).to_pylist()
            for lo, hi in slices(offsets):
                at = offsets[lo:hi + 1]
                for key, (ids, ends) in zip(keys[lo:hi], words.encode(data[at[0]:at[-1]], at - at[0])):
                    stream.add(key, np.append(ids, np.uint32(end_id)), ends)
                    if stream.length >= STRETCH:
                        stream.pack(last=False)
                yield made()
        stream.pack(last=True)
        yield made()

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Each document is its token ids (null text: none) and ``end_id``; a piece is the ids from ``start``
    on that stand in sequence ``sequence_id`` from ``offset`` on. ``tokenizer`` is the path of a
    vocabulary that drops white space, known to every executor. Each partition is packed as it is:
    nothing is shuffled, and a partition costs at most the padding of its last sequences. Documents
    with a null or repeated id are packed as any other; an empty table gives no piece. Other columns
    are ignored.
    """
    texts = only(docs, [id_column, text_column]).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return texts.mapInArrow(
        tidy(_pack(tokenizer, end_id, capacity)),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
