"""Benchmark decontamination: item-sized windows of documents compared by SimHash.

For an item of m shingles, every stretch of m consecutive shingles of a document is a
window. Windows and items have 64-bit fingerprints (a bit is set if more than half of the
shingle hashes have it). A multi-index of the items' fingerprints finds all within
``RADIUS`` bits: the bits are cut into four blocks, and two fingerprints that differ in at
most ``4 * (r + 1) - 1`` bits differ in at most r bits in one block, so an item is listed
in each block's table under every value within r bits of its own. Candidates are verified
by the exact similarity of their shingles with their counts: the sum of the smaller counts
over the sum of the larger ones, ``SIMILARITY`` or more.

A similar window shares a shingle with its item, so windows are taken only around shingles
that some item has; that leaves out no match. At similarity 0.8 about 15 per cent of the
bits differ, 10 of 64; the radius of 19 is more than three standard deviations above it.

The items come in blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_SHINGLES`` shingles,
each broadcast and held against all documents in one pass without a shuffle, so what a task
holds is bounded for a benchmark of any size. Items that repeat a text are one query with several names.

Words are split at ASCII white space after lower-casing A-Z. A text of fewer words than a
shingle is one shingle; an item without words matches nothing, and a document shorter than
an item is one window. Null texts have no words. Rows are independent, repeats get equal
results; items or documents without identifier are reported with a null one. Of windows that
tie in similarity the first is reported. A very long text is fingerprinted in stretches, so
memory beside its words and shingles does not follow its length. Empty tables give no rows;
of other columns none is read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from kerbside.sources.workspace import stored

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19
BLOCK_SHINGLES, BLOCK_ITEMS = 200_000, 2_000
STARTS, SPAN = 4096, 1 << 14  # windows fingerprinted at once, and the shingles they start in

_FILTER_BITS = 22
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_KNOWN_WORDS = 500_000


class WordHashes:
    """64-bit hashes of words; those of the commonest kind are remembered."""

    def __init__(self) -> None:
        self._known: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        known = self._known
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > _KNOWN_WORDS:
                known.clear()
            for word in set(words).difference(known):
                known[word] = xxh64_intdigest(word, 7)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, repeats included; fewer words are one run."""
    count = len(words) - size + 1 if len(words) >= size else min(1, len(words))
    size = min(size, len(words))
    out = np.zeros(count, np.uint64)
    for i in range(size):
        out = (out ^ (out >> np.uint64(29))) * _MULTIPLIER + words[i:i + count]
    return out ^ (out >> np.uint64(32))


def window_fingerprints(hashes: np.ndarray, size: int, starts: np.ndarray) -> np.ndarray:
    """Fingerprints of ``hashes[s:s + size]`` for each start, from running sums of bits."""
    low, high = int(starts.min()), int(starts.max()) + size
    bits = np.unpackbits(hashes[low:high].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, 0, dtype=np.int32)])
    counts = sums[starts - low + size] - sums[starts - low]
    return np.packbits(2 * counts > size, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def weighted_similarity(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 0.0


@dataclass
class Items:
    """One block of benchmark items, ready for search."""

    ids: list[list[int | None]]  # names of each distinct text
    hashes: list[np.ndarray]
    radius: int
    counts: list[Counter] = field(init=False)
    by_size: dict[int, np.ndarray] = field(init=False)
    sizes: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.counts = [Counter(h.tolist()) for h in self.hashes]
        self.sizes = sizes = np.array([len(h) for h in self.hashes], np.int64)
        self.by_size = {int(n): np.flatnonzero(sizes == n) for n in np.unique(sizes)}
        every = np.concatenate([np.zeros(0, np.uint64), *self.hashes])
        self.present = np.zeros(1 << _FILTER_BITS, bool)
        self.present[(every >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        owner = np.repeat(np.arange(len(self.hashes)), sizes)
        order = np.argsort(every, kind="stable")
        self.sorted, self.owner = every[order], owner[order]
        self._index: dict[int, MultiIndex] = {}

    def index(self, size: int) -> MultiIndex:
        """The multi-index of the items of ``size`` shingles."""
        if size not in self._index:
            own = self.by_size[size]
            fps = [window_fingerprints(self.hashes[i], len(self.hashes[i]), np.zeros(1, np.int64))[0] for i in own]
            self._index[size] = MultiIndex(np.array(fps, np.uint64), own, self.radius)
        return self._index[size]

    def owners_near(self, hashes: np.ndarray) -> dict[int, np.ndarray]:
        """By number of shingles: the places in ``hashes`` that items of it have."""
        maybe = np.flatnonzero(self.present[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        if not maybe.size:
            return {}
        first = np.searchsorted(self.sorted, hashes[maybe], "left")
        count = np.searchsorted(self.sorted, hashes[maybe], "right") - first
        place = np.repeat(maybe, count)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        sizes = self.sizes[self.owner[at]]
        return {int(n): np.unique(place[sizes == n]) for n in np.unique(sizes)}


class MultiIndex:
    """Fingerprints listed by each 16-bit block under every value within reach."""

    def __init__(self, fps: np.ndarray, owners: np.ndarray, radius: int):
        self._fps, self._owners, self._radius = fps, owners, radius
        reach = radius // 4
        values = np.arange(1 << 16, dtype=np.uint16)
        near = values[np.bitwise_count(values) <= reach]
        self._tables = []
        for block in range(4):
            own = ((fps >> np.uint64(16 * block)) & np.uint64(0xFFFF)).astype(np.uint16)
            listed = (own[:, None] ^ near[None]).reshape(-1)
            item = np.repeat(np.arange(len(fps), dtype=np.int32), len(near))
            order = np.argsort(listed, kind="stable")
            self._tables.append((np.searchsorted(listed[order], np.arange((1 << 16) + 1)), item[order]))

    def search(self, fps: np.ndarray) -> list[tuple[int, int]]:
        """(place in ``fps``, owner) of all pairs within the radius."""
        found = []
        for block, (edges, items) in enumerate(self._tables):
            value = ((fps >> np.uint64(16 * block)) & np.uint64(0xFFFF)).astype(np.int64)
            count = edges[value + 1] - edges[value]
            place = np.repeat(np.arange(len(fps)), count)
            item = items[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(edges[value], count)]
            near = np.bitwise_count(fps[place] ^ self._fps[item]) <= self._radius
            found.append(np.stack([place[near], self._owners[item[near]]], 1))
        return [tuple(p) for p in np.unique(np.concatenate(found), axis=0).tolist()]


def _stretches(starts: np.ndarray) -> Iterator[np.ndarray]:
    """``starts`` cut by number and by how far they reach, since running sums cover the reach."""
    for part in np.split(starts, np.flatnonzero(np.diff(starts // SPAN)) + 1):
        for at in range(0, len(part), STARTS):
            yield part[at:at + STARTS]


def matches(items: Items, words: np.ndarray, shingle: int, similarity: float) -> list[tuple[int, int, int, float]]:
    """(item, start, length in shingles, similarity): each similar item's
    best window of a document."""
    hashes = shingles(words, shingle)
    best: dict[int, tuple[float, int, int]] = {}
    for size, places in items.owners_near(hashes).items():
        width = min(size, len(hashes))
        last = len(hashes) - width
        edges = np.zeros(last + 2, np.int64)  # starts of windows that hold a shared shingle
        np.add.at(edges, np.clip(places - width + 1, 0, last), 1)
        np.add.at(edges, np.minimum(places, last) + 1, -1)
        starts = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
        index = items.index(size)
        for own in _stretches(starts):
            fps = window_fingerprints(hashes, width, own)
            for place, item in index.search(fps):
                start = int(own[place])
                found = weighted_similarity(items.counts[item], Counter(hashes[start:start + width].tolist()))
                if found >= similarity and (item not in best or found > best[item][0]):
                    best[item] = (found, start, width)
    return [(item, start, width, similar) for item, (similar, start, width) in sorted(best.items())]


def _match_batches(batches: Iterable[pa.RecordBatch], items: Items, shingle: int, similarity: float) -> Iterator[pa.RecordBatch]:
    hashed = WordHashes()
    for batch in batches:
        rows: list[tuple] = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            for item, start, width, similar in matches(items, hashed(text.as_py() or ""), shingle, similarity):
                rows += [(doc_id, name, start, width, similar) for name in items.ids[item]]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                         names=["doc_id", "item_id", "start_shingle", "n_shingles", "similarity"])


def item_blocks(benchmark: DataFrame, shingle: int, radius: int, text: str, item_id: str,
                block_shingles: int) -> Iterator[Items]:
    """The items in blocks of at most ``block_shingles`` shingles (one item more at most),
    read from the cluster piece by piece."""
    hashed = WordHashes()
    held: dict[bytes, tuple[list, np.ndarray]] = {}
    size = 0
    rows = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    for row in rows.toLocalIterator():
        own = shingles(hashed(row.text or ""), shingle)
        if not len(own):
            continue
        if own.tobytes() in held:
            held[own.tobytes()][0].append(row.id)
            continue
        held[own.tobytes()] = ([row.id], own)
        size += len(own)
        if size >= block_shingles or len(held) >= BLOCK_ITEMS:
            yield Items([i for i, _ in held.values()], [h for _, h in held.values()], radius)
            held, size = {}, 0
    if held:
        yield Items([i for i, _ in held.values()], [h for _, h in held.values()], radius)


SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "item_id", "start_shingle", "n_shingles")]
                      + [T.StructField("similarity", T.DoubleType())])


def contaminated(documents: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY,
                 radius: int = RADIUS, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
                 block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, item_id, start_shingle and n_shingles of the best window, and similarity: one
    row per document and item it holds."""
    spark = documents.sparkSession
    pairs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = None
    for items in item_blocks(benchmark, shingle, radius, "text", item_id, block_shingles):
        shared = spark.sparkContext.broadcast(items)  # at most block_shingles hashes
        one = pairs.mapInArrow(lambda batches, shared=shared: _match_batches(batches, shared.value, shingle, similarity), SCHEMA)
        found = one if found is None else found.unionByName(one)
    return spark.createDataFrame([], SCHEMA) if found is None else found


def without_contaminated(documents: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``documents`` that hold no benchmark item. All columns stay. Whether a row goes is
    decided by its text alone, so rows without identifier, or that share one, go or stay on
    their own; a null text stays."""
    taken = "_" * (1 + max((len(c) for c in documents.columns), default=0))  # longer than any name, so free
    key = F.xxhash64(F.col(text).cast("string"))
    found = contaminated(documents.select(key.alias("key"), F.col(text).alias("text")), benchmark, doc_id="key", **options)
    found = stored(found.select(F.col("doc_id").alias(taken)).distinct(), "contaminated")
    return documents.join(found, key == F.col(taken), "left_anti").select(*documents.columns)
