"""Token packing into near-equal windows by Karmarkar-Karp multiway differencing.

A document's ids are cut into whole windows, which are sequences of their own, and a rest in pieces. The pieces of about
``group_windows`` windows are packed together. At first each piece is a partial partition: its length in one window and
nothing in the others. The two partial partitions with the largest differences are merged again and again, large sums
of one onto small sums of the other, so that opposing imbalances cancel. If the fullest window of the last partition
exceeds the capacity, the number of windows is raised by one and the pieces are packed anew.

Rows are packed where they are read: nothing is shuffled, a task holds one batch of texts and one group, and a hot
source or key makes no task larger. The input must be a frame whose partitions keep their rows when a task is run again,
such as a table's scan.
"""

import heapq
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from visitlake.llm.batches import frugal, kept_by_worker, slices
from visitlake.llm.bpe import ChunkedText

CHUNKS_AT_ONCE = 128
CHUNKS_LOOKED_UP = 100_000
CHUNKS_KEPT = 1_000_000


def differencing(sizes: list[int], ways: int) -> list[tuple[int, list[int]]]:
    """Partition numbered sizes into so many sets of nearly equal sums; gives each used set's sum and numbers.

    A partial partition lists its nonempty sets by falling sum. A set is a number or a pair of sets.
    """
    heap = [(-size, number, [(size, number)]) for number, size in enumerate(sizes)]
    heapq.heapify(heap)
    for made in range(len(sizes), 2 * len(sizes) - 1):
        one, other = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        shared = max(0, len(one) + len(other) - ways)
        alone, alone_other = len(one) - shared, len(other) - shared
        merged = one[:alone] + other[:alone_other]
        for large, small in zip(one[alone:], reversed(other[alone_other:])):
            merged.append((large[0] + small[0], (large[1], small[1])))
        merged.sort(key=lambda part: -part[0])
        least = merged[-1][0] if len(merged) == ways else 0
        heapq.heappush(heap, (least - merged[0][0], made, merged))
    return [(total, _numbers(part)) for total, part in heap[0][2]] if heap else []


def _numbers(part) -> list[int]:
    found, open_parts = [], [part]
    while open_parts:
        part = open_parts.pop()
        if isinstance(part, tuple):
            open_parts.extend(part)
        else:
            found.append(part)
    return sorted(found)


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Numbers of the pieces in each window, none fuller than the capacity; every size must fit a window."""
    ways = -(-sum(sizes) // capacity)
    while True:
        parts = differencing(sizes, ways)
        if all(total <= capacity for total, _ in parts):
            return [numbers for _, numbers in parts]
        ways += 1


class ChunkTable:
    """Ids of chunks in flat arrays, found by hash: about 50 bytes a chunk, where a dictionary of strings takes some 160.

    Two chunks are taken for one if their 64-bit and their 32-bit hashes are equal. A full table is forgotten.
    """

    def __init__(self, kept: int):
        self.kept, slots = kept, 1 << (2 * kept - 1).bit_length()
        self.mask = slots - 1
        self.keys, self.checks = np.zeros(slots, np.int64), np.zeros(slots, np.uint32)
        self.entry = np.full(slots, -1, np.int32)
        self.ends, self.ids = np.zeros(kept + 1, np.int64), np.zeros(4 * kept, np.uint32)
        self.count = 0

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Entries of the chunks, -1 for those that are not there."""
        found, slot, left = np.full(len(keys), -1, np.int32), keys & self.mask, np.arange(len(keys))
        while len(left):
            at = slot[left]
            entry = self.entry[at]
            same = (self.keys[at] == keys[left]) & (self.checks[at] == checks[left]) & (entry >= 0)
            found[left[same]] = entry[same]
            left = left[(entry >= 0) & ~same]
            slot[left] = (slot[left] + 1) & self.mask
        return found

    def add(self, keys: np.ndarray, checks: np.ndarray, ids: list[bytes]) -> None:
        """Add chunks that are not there, each once; at most ``kept`` of them."""
        if self.count + len(ids) > self.kept:
            self.entry[:] = -1
            self.count = 0
        first, start = self.count, self.ends[self.count]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        self.count += len(ids)
        self.ends[first + 1:self.count + 1] = start + np.cumsum(lengths)
        end = self.ends[self.count]
        if end > len(self.ids):
            self.ids = np.concatenate([self.ids[:start], np.zeros(max(end - start, len(self.ids) // 2), np.uint32)])
        self.ids[start:end] = np.frombuffer(b"".join(ids), "<u4")
        slot, left = keys & self.mask, np.arange(len(keys))
        while len(left):
            free = left[self.entry[slot[left]] < 0]
            # Of chunks that want the same slot, one gets it.
            taken, one = np.unique(slot[free], return_index=True)
            chosen = free[one]
            self.keys[taken], self.checks[taken], self.entry[taken] = keys[chosen], checks[chosen], first + chosen
            left = np.setdiff1d(left, chosen, assume_unique=True)
            slot[left] = (slot[left] + 1) & self.mask

    def take(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all entries, one after the other, and the number of each."""
        starts = self.ends[entries]
        lengths = self.ends[entries + 1] - starts
        places = np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        return self.ids[places], lengths


class LibraryIds:
    """Ids of whole texts by the tokenizers library, which sees each chunk between white space once while it is kept."""

    def __init__(self, path: str, chunks_kept: int = CHUNKS_KEPT):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.encode_special_tokens = True  # special strings are split off before
        self.tokenizer = tokenizer
        self.text = ChunkedText(spec, lambda chunk: self.batch([chunk])[0], 1)
        self.table = ChunkTable(chunks_kept)
        self.at_once = max(1, min(chunks_kept, CHUNKS_LOOKED_UP))

    def batch(self, chunks: list[str]) -> list[bytes]:
        """Ids of single chunks. They are encoded many at once, with spaces between, and told apart by their places."""
        found = []
        for at in range(0, len(chunks), CHUNKS_AT_ONCE):
            some = chunks[at:at + CHUNKS_AT_ONCE]
            encoded = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            starts = np.cumsum([0, *(len(chunk) + 1 for chunk in some)])
            places = np.array([start for start, _ in encoded.offsets], np.int64)
            cuts = (4 * np.searchsorted(places, starts)).tolist()
            ids = np.array(encoded.ids, "<u4").tobytes()
            found.extend(ids[begin:end] for begin, end in zip(cuts, cuts[1:]))
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        chunked = [self.text.chunks(text) for text in texts]
        chunks = [chunk for own in chunked for chunk in own]
        found = [self._known(chunks[at:at + self.at_once]) for at in range(0, len(chunks), self.at_once)]
        ids, lengths = (np.concatenate(part) for part in zip(*found)) if found else (np.zeros(0, "<u4"), np.zeros(0, np.int64))
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *map(len, chunked)])].tolist()
        return [ids[begin:end].tobytes() for begin, end in zip(ends, ends[1:])]

    def _known(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks and the number of each; what the table lacks is encoded and added."""
        keys = np.fromiter(map(hash, chunks), np.int64, len(chunks))
        checks = np.fromiter(map(zlib.crc32, map(str.encode, chunks)), np.uint32, len(chunks))
        entries = self.table.find(keys, checks)
        lacking = np.flatnonzero(entries < 0)
        if len(lacking):
            places = lacking[np.unique(keys[lacking], return_index=True)[1]]
            if self.table.count + len(places) > self.table.kept:
                places = np.unique(keys, return_index=True)[1]  # the table is about to be forgotten
            unknown = [chunks[place] for place in places.tolist()]
            plain = iter(self.batch([chunk for chunk in unknown if chunk not in self.text.specials]))
            ids = [self.text.specials[chunk] if chunk in self.text.specials else next(plain) for chunk in unknown]
            self.table.add(keys[places], checks[places], ids)
            entries = self.table.find(keys, checks)
        return self.table.take(entries)


@kept_by_worker
def library_ids(path: str) -> LibraryIds:
    """One tokenizer for each Python worker, which stays on its own core."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return LibraryIds(path)


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 1, piece_tokens: int = 512,
         group_windows: int = 128, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pack all documents; one row per piece.

    Columns: the id, ``start`` (ids of its document before the piece), ``length``, ``ids`` (little-endian unsigned 32-bit),
    ``doc_tokens``, ``sequence_id`` and ``offset`` (in the sequence, gapless from 0). Each document ends with ``end_id``;
    a missing or empty text is that id alone. Every row is packed, also rows with equal or missing ids. An empty table
    gives no rows. Other columns are left out.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(
        frugal(lambda batches: _packed(batches, path, capacity, end_id, min(piece_tokens, capacity), group_windows), keeps=True),
        f"`{id_column}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def _packed(batches, path, capacity, end_id, piece_tokens, group_windows):
    encoder = library_ids(path)
    first = TaskContext.get().partitionId() << 36
    sequences, waiting, waiting_tokens, kind = 0, [], 0, pa.int64()
    end = np.array(end_id, "<u4").tobytes()
    for part in slices(batches, 1):
        kind = part.column(0).type
        rows = []
        for key, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist())):
            ids += end
            tokens = len(ids) // 4
            whole = tokens - tokens % capacity
            for start in range(0, whole, capacity):
                rows.append((key, start, capacity, ids[4 * start:4 * (start + capacity)], tokens, first + sequences, 0))
                sequences += 1
            for start in range(whole, tokens, piece_tokens):
                cut = ids[4 * start:4 * min(start + piece_tokens, tokens)]
                waiting.append((key, start, len(cut) // 4, cut, tokens))
                waiting_tokens += len(cut) // 4
            if waiting_tokens >= group_windows * capacity:
                found, sequences = _sequences(waiting, capacity, first, sequences)
                rows, waiting, waiting_tokens = rows + found, [], 0
        if rows:
            yield _batch(rows, kind)
    if waiting:
        yield _batch(_sequences(waiting, capacity, first, sequences)[0], kind)


def _sequences(pieces, capacity, first, sequences):
    rows = []
    for numbers in windows_of([piece[2] for piece in pieces], capacity):
        offset = 0
        for number in numbers:
            rows.append((*pieces[number], first + sequences, offset))
            offset += pieces[number][2]
        sequences += 1
    return rows, sequences


def _batch(rows, kind) -> pa.RecordBatch:
    key, start, length, ids, tokens, sequence, offset = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(key, kind), *(pa.array(values, pa.int64()) for values in (start, length)), pa.array(ids, pa.binary()),
         *(pa.array(values, pa.int64()) for values in (tokens, sequence, offset))],
        names=["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
