"""SimHash near-duplicates, searched by Golay-code fuzzy hashing.

A text's fingerprint has a bit set where more than half of its shingles' hashes have it.
Fingerprints link at ``MAX_BITS`` or fewer differing bits. The 64 bits are cut into three
segments of 22, 21 and 21 bits, each a word of the perfect binary Golay code of length 23
with leading zeros. Every word is within three bits of exactly one codeword, so two words
that differ in at most one bit meet in the nearest codeword of either and one of the
codewords within four bits of the other: one key on one side, one or six on the other.

Three errors leave at least two segments with at most one error, and one of two cases:

* a segment without errors and another with at most one: the key is the exact segment and
  the other's codeword index, for each ordered choice of the two;
* one error in each segment: the key is the codeword indices of the first two and the
  parities of all three, which all flip.

So every linked pair shares a key of at least 27 bits. Pairs that share one are verified by
their differing bits, and the groups are the connected components of the links.

Equal fingerprints are reduced to one before any search, so copies cost nothing; all the
fingerprints near one are at most a ball of 43,745, whatever the number of documents.

A null or empty text has no words and fingerprint zero, which links like any other; fewer
words than a shingle are one shingle. Rows are linked by text alone: rows that repeat an
identifier are in one group only if their fingerprints link; rows without identifier take
part but give no group its name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from kerbside.llm.graph import connected_components
from kerbside.sources.workspace import stored

MAX_BITS = 3
SEED = 42
_LANES = np.uint64(0x0101010101010101)
_BLOCK = 255  # shingles whose counts fit in a byte

# --- fingerprints -----------------------------------------------------------------------


def shingle_hashes(text: str, size: int) -> list[int]:
    """XXH64 of every shingle of ``size`` words, repeats included."""
    words = text.encode().lower().split()  # both change and split at ASCII only
    if len(words) < size:
        return [xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(words) - size + 1].tolist()
    return [xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[size - 1:].tolist(), strict=True)]


def majority_bits(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints of runs of ``hashes``, ``sizes`` long: bits set in over half of a run.
    Eight bits are counted at once, in the bytes of a 64-bit word."""
    out = np.zeros(len(sizes), np.uint64)
    filled = np.flatnonzero(sizes)
    if not filled.size:
        return out
    own = sizes[filled]
    starts = np.concatenate([[0], np.cumsum(own)[:-1]])
    blocks = -(-own // _BLOCK)
    first = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    edges = np.repeat(starts, blocks) + _BLOCK * (np.arange(blocks.sum()) - np.repeat(first, blocks))
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & _LANES, edges).astype("<u8").view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(lanes.astype(np.int64), first, axis=0)
        for lane in range(8):
            out[filled] |= (2 * counts[:, lane] > own).astype(np.uint64) << np.uint64(8 * lane + shift)
    return out


def _fingerprint_batches(batches: Iterable[pa.RecordBatch], size: int, kept: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts, sizes = [], []
        for text in batch.column("text"):  # one text at a time in Python, hashes in arrays
            own = shingle_hashes(text.as_py() or "", size)
            parts.append(np.array(own, np.uint64))
            sizes.append(len(own))
        found = majority_bits(np.concatenate([np.zeros(0, np.uint64), *parts]), np.array(sizes, np.int64))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(found.view(np.int64))], names=[*kept, "fp"])


def fingerprints(documents: DataFrame, size: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp): the 64 bits as a signed long."""
    pairs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return pairs.mapInArrow(lambda batches: _fingerprint_batches(batches, size, ["doc_id"]), "doc_id long, fp long")


# --- the Golay code ---------------------------------------------------------------------

_GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
_SEGMENTS = ((0, 22), (22, 21), (43, 21))


def _remainders(high_bits: int) -> np.ndarray:
    """Remainder of ``n << 11`` by the generator, for n below ``2 ** high_bits``."""
    out = np.zeros(1 << high_bits, np.uint32)
    for bit in range(high_bits):
        value = 1 << (11 + bit)
        for place in range(11 + bit, 10, -1):
            if value >> place & 1:
                value ^= _GENERATOR << (place - 11)
        out[1 << bit:2 << bit] = out[:1 << bit] ^ value
    return out


def _error_patterns() -> tuple[np.ndarray, np.ndarray]:
    """By remainder: the errors of up to four bits that leave it, the fewest bits first,
    padded with the first; and their number."""
    high = _remainders(12)
    by: list[list[int]] = [[] for _ in range(1 << 11)]
    words = np.array([0] + [1 << i for i in range(23)], np.uint32)
    patterns = words
    for _ in range(3):
        patterns = np.unique(patterns[:, None] ^ words[None])
    patterns = patterns[np.argsort(np.bitwise_count(patterns), kind="stable")]
    for pattern, left in zip(patterns.tolist(), (high[patterns >> 11] ^ (patterns & 0x7FF)).tolist(), strict=True):
        by[left].append(pattern)
    width = max(map(len, by))
    return np.array([b + b[:1] * (width - len(b)) for b in by], np.uint32), np.array([len(b) for b in by])


class GolayKeys:
    """Keys of fingerprints: ``single`` gives each one key per case, ``several`` all keys
    under which its neighbours may have their single one."""

    def __init__(self) -> None:
        self._high = _remainders(12)
        self._errors, self._count = _error_patterns()

    def _codewords(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[word, choice] indices of the codewords within four bits, the nearest first, and
        which choices are real."""
        left = self._high[word >> np.uint32(11)] ^ (word & np.uint32(0x7FF))
        index = (word[:, None] ^ self._errors[left]) >> np.uint32(11)
        return index.astype(np.int64), np.arange(self._errors.shape[1])[None] < self._count[left][:, None]

    def keys(self, fp: np.ndarray, several: bool) -> tuple[np.ndarray, np.ndarray]:
        """(place of the fingerprint, key), for all fingerprints and keys."""
        words = [((fp >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.uint32) for at, bits in _SEGMENTS]
        found = [self._codewords(w) for w in words]
        if not several:
            found = [(index[:, :1], real[:, :1]) for index, real in found]
        places, keys = [], []
        case = 0
        for exact in range(3):
            for near in range(3):
                if near == exact:
                    continue
                index, real = found[near]
                key = (np.int64(case) << 60) | (words[exact].astype(np.int64) << 12)[:, None] | index
                places.append(np.nonzero(real)[0])
                keys.append(key[real])
                case += 1
        (first, first_real), (second, second_real) = found[:2]
        flips = sum((np.bitwise_count(w).astype(np.int64) & 1) << i for i, w in enumerate(words)) ^ (7 if several else 0)
        key = (np.int64(case) << 60) | first[:, :, None] << 15 | second[:, None, :] << 3 | flips[:, None, None]
        real = first_real[:, :, None] & second_real[:, None, :]
        places.append(np.nonzero(real)[0])
        keys.append(key[real])
        return np.concatenate(places), np.concatenate(keys)


def _key_batches(batches: Iterable[pa.RecordBatch], several: bool) -> Iterator[pa.RecordBatch]:
    code = GolayKeys()
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        places, keys = code.keys(fp.view(np.uint64), several)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[places])], names=["key", "fp"])


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): pairs of different fingerprints within ``max_bits`` bits, a < b."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys find up to {MAX_BITS} differing bits")
    one = distinct.select("fp").mapInArrow(lambda b: _key_batches(b, False), "key long, fp long").withColumnRenamed("fp", "a")
    many = distinct.select("fp").mapInArrow(lambda b: _key_batches(b, True), "key long, fp long").withColumnRenamed("fp", "b")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    # The planner takes either side for as large as ``distinct``, of which it is many times the
    # rows, so it might broadcast one: a merge join is asked for.
    return one.hint("merge").join(many.withColumnRenamed("key", "other"), (F.col("key") == F.col("other")) & near).select("a", "b").distinct()


def near_duplicates(documents: DataFrame, size: int, max_bits: int = MAX_BITS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``documents``: doc_id, fingerprint (hex), component_id."""
    found = stored(fingerprints(documents, size, text, doc_id), "fingerprints")
    distinct = stored(found.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "distinct-fingerprints")
    components = connected_components(links(distinct, max_bits)).withColumnRenamed("id", "fp")
    # Fingerprints with company: in a component, or shared by several rows.
    tied = distinct.join(components, "fp", "left").filter("n > 1 OR component IS NOT NULL").withColumn("component", F.coalesce("component", "fp"))
    tied = stored(tied, "tied-fingerprints")
    names = tied.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = tied.join(names, "component").select("fp", "component_id")
    return (found.join(named, "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.coalesce("component_id", "doc_id").alias("component_id")))
