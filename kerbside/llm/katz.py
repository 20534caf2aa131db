"""Katz backoff language model: counted, normalised and evaluated on Spark.

Tokens are words and one end per document; a document's first word follows an end. With c a
count in the training documents, the model is the recursion

* ``P(w | h) = d(c(hw)) * c(hw) / c(h)`` where hw was seen, else ``alpha(h) * P(w)``;
* ``P(w) = d'(c(w)) * c(w) / N`` where w was seen, else what is left for unknown words.

The discounts d of the counts 1 to ``LARGEST`` are Good-Turing estimates as Katz gives them,
for each order; larger counts lose one part in N + 1, so that no context is left without
mass. ``alpha(h) = (1 - sum of seen P(w | h)) / (1 - sum of P(w) over the same w)`` makes
every context sum to one exactly; a context that was never seen has weight one.

How it is laid out. The documents of a task are cut into chunks of about ``CHUNK_TOKENS``
tokens, stored with their local vocabulary. A chunk sends each of its distinct words and
word pairs once, as 64-bit hashes in sorted slices of the hash space; a bucket merges the
slices of all chunks, and answers each with the training counts, in the order it came. It
marks every counted n-gram in one of its chunks, its owner. What is stored are these answers
by place, so the model serves the texts it is called with. With them a chunk evaluates its tokens;
it also sums up, for the pairs it owns, what alpha of their contexts needs, and sends the
sums and the documents that need the weight to buckets of contexts. All exchanges are by
hash of distinct items, so the commonest word costs one entry per chunk. Hashes of 64 bits
stand for words and pairs.

A null text has no words. A row without identifier is held out. Repeated rows are documents
of their own. An empty table gives no rows; with no training rows every word is unknown. Only
the named columns are read, whatever others there are. A text longer than a chunk is a chunk.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from kerbside.sources.workspace import stored

LARGEST = 5  # counts above are not discounted by Good-Turing
CHUNK_TOKENS = 1 << 20
BUCKET_ITEMS = 1 << 20  # n-grams that meet in a bucket, about

_END = b"\n"  # no word
_WORD, _PAIR = 1, 2
_MIX = np.uint64(0x9E3779B97F4A7C15)

# --- chunks -----------------------------------------------------------------------------

_CHUNKS = ("chunk long, doc_ids array<long>, lengths binary, learned binary, hashes binary, low binary, high binary, n_tokens long")


def _chunk_batches(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    number = itertools.count((task.partitionId() if task else 0) << 24)

    def start() -> tuple:
        vocabulary: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
        return vocabulary, [], [], [], [vocabulary[_END]]

    vocabulary, doc_ids, learned, parts, sizes = start()
    tokens = 0

    def flush() -> pa.RecordBatch:
        ids = np.concatenate(parts)
        # Frequent words get small numbers, so that the upper bytes are mostly zero.
        order = np.argsort(-np.bincount(ids, minlength=len(vocabulary)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        ids = rank[ids]
        hashes = np.fromiter((xxh64_intdigest(w, 1) for w in vocabulary), np.uint64, len(vocabulary))[order]
        columns = [pa.array([next(number)]), pa.array([doc_ids], pa.list_(pa.int64())), np.array(sizes[1:], "<i4"), np.array(learned, np.uint8),
                   hashes.astype("<u8"), (ids & 0xFFFF).astype("<u2"), (ids >> 16).astype("<u2"), pa.array([len(ids)], pa.int64())]
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array([c.tobytes()], pa.binary()) for c in columns],
                                          names=["chunk", "doc_ids", "lengths", "learned", "hashes", "low", "high", "n_tokens"])

    for batch in batches:
        for doc_id, text, flag in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("learned").to_pylist(), strict=True):
            words = (text.as_py() or "").encode().lower().split()
            words.append(_END)
            parts.append(np.fromiter(map(vocabulary.__getitem__, words), np.uint32, len(words)))
            doc_ids.append(doc_id)
            learned.append(flag)
            sizes.append(len(words))
            tokens += len(words)
            if tokens >= limit:
                yield flush()
                vocabulary, doc_ids, learned, parts, sizes = start()
                tokens = 0
    if parts:
        yield flush()


@dataclass
class Chunk:
    number: int
    doc_ids: list
    lengths: np.ndarray
    learned: np.ndarray  # by document
    hashes: np.ndarray  # by local word
    ids: np.ndarray  # local word of each token

    @classmethod
    def of(cls, row: dict) -> Chunk:
        ids = np.frombuffer(row["low"], "<u2").astype(np.int64) | np.frombuffer(row["high"], "<u2").astype(np.int64) << 16
        return cls(row["chunk"], row["doc_ids"], np.frombuffer(row["lengths"], "<i4").astype(np.int64), np.frombuffer(row["learned"], np.uint8) > 0,
                   np.frombuffer(row["hashes"], "<u8"), ids)

    @property
    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.lengths)), self.lengths)

    @property
    def context(self) -> np.ndarray:
        """The word before each token; the end that opens a document is the first one's."""
        out = np.empty_like(self.ids)
        out[1:] = self.ids[:-1]
        out[0] = self.ids[self.lengths[0] - 1]
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct pair hashes, a token of each, and each token's place among them."""
        left, right = self.hashes[self.context], self.hashes[self.ids]
        mixed = (left ^ (left >> np.uint64(31))) * _MIX + right
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        keys, first, place = np.unique(mixed ^ (mixed >> np.uint64(32)), return_index=True, return_inverse=True)
        return keys, first, place


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """One row at a time: a chunk is large."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


# --- exchanges --------------------------------------------------------------------------


def _slices(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Contiguous ranges of sorted hashes, by bucket; empty ones are left out."""
    owner = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    edges = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(keys) else np.zeros(0, np.int64)
    for at, end in itertools.pairwise([*edges.tolist(), len(keys)]):
        yield int(owner[at]), slice(at, end)


def _planes(keys: np.ndarray) -> bytes:
    """Sorted hashes with bytes of one weight together: their upper bytes compress."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)


_REQUESTS = "kind int, bucket int, chunk long, keys binary, counts binary"


def _request_batches(batches: Iterable[pa.RecordBatch], buckets: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _rows(batch):
            chunk = Chunk.of(row)
            counted = chunk.learned[chunk.document]
            keys, _, place = chunk.pairs()
            order = np.argsort(chunk.hashes)
            words = np.bincount(chunk.ids[counted], minlength=len(order))[order]
            out = []
            for kind, own, counts in ((_WORD, chunk.hashes[order], words), (_PAIR, keys, np.bincount(place[counted], minlength=len(keys)))):
                for bucket, s in _slices(own, buckets[kind - 1]):
                    out.append((kind, bucket, chunk.number, _planes(own[s]), counts[s].astype("<u4").tobytes()))
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                             names=["kind", "bucket", "chunk", "keys", "counts"])


_ANSWERS = "kind int, bucket int, chunk long, n int, answers binary, distinct long, total long, of_count array<long>"


def _narrow(counts: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs: 2, 4 or 8."""
    largest = int(counts.max(initial=0))
    return counts.astype("<u2" if largest < 1 << 16 else "<u4" if largest < 1 << 32 else "<u8").tobytes()


def _widened(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // max(1, count)}").astype(np.int64) if count else np.zeros(0, np.int64)


def _answer(table: pa.Table) -> pa.Table:
    """One bucket: the training count of every n-gram, twice it plus one for its owner."""
    rows = table.to_pylist()
    rows.sort(key=lambda r: r["chunk"])
    own = [_unplanes(r["keys"]) for r in rows]
    counts = np.concatenate([np.frombuffer(r["counts"], "<u4") for r in rows]).astype(np.int64)
    keys, place = np.unique(np.concatenate(own), return_inverse=True)
    total = np.bincount(place, counts, len(keys)).astype(np.int64)
    holders = np.flatnonzero(counts > 0)
    owners = np.zeros(len(counts), bool)
    owners[holders[np.unique(place[holders], return_index=True)[1]]] = True
    answers, at, out = total[place] * 2 + owners, 0, []
    for row, part in zip(rows, own, strict=True):
        s = slice(at, at + len(part))
        seen = answers[s][owners[s]] >> 1
        of_count = np.bincount(np.minimum(seen, LARGEST + 2), minlength=LARGEST + 3)[1:LARGEST + 2]
        out.append((row["kind"], row["bucket"], row["chunk"], len(part), _narrow(answers[s]),
                    len(seen), int(seen.sum()), of_count.tolist()))
        at = s.stop
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                names=["kind", "bucket", "chunk", "n", "answers", "distinct", "total", "of_count"])


# --- probabilities ----------------------------------------------------------------------


def discounts(of_count: list[int], tokens: int) -> np.ndarray:
    """Factor of the counts 0 to ``LARGEST`` + 1 (the last for all larger ones) from the
    numbers of n-grams seen 1, 2, ... times; half a count goes where no estimate fits."""
    n = [0, *of_count]
    out = np.full(LARGEST + 2, tokens / (tokens + 1))
    tail = (LARGEST + 1) * n[LARGEST + 1] / n[1] if n[1] else 1.0
    for r in range(1, LARGEST + 1):
        estimate = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) if n[r] and tail < 1 else 0.0
        out[r] = estimate if 0 < estimate < 1 else 1 - 0.5 / r
    return out


@dataclass(frozen=True)
class Totals:
    """What every chunk needs of the whole: a few numbers."""

    tokens: int
    words: int
    word_discount: np.ndarray
    pair_discount: np.ndarray
    unknown: float  # probability of all unknown words together

    @classmethod
    def of(cls, answers: DataFrame) -> Totals:
        names = [f"n{r}" for r in range(LARGEST + 1)]
        rows = {r.kind: r for r in answers.groupBy("kind").agg(F.sum("distinct").alias("distinct"), F.sum("total").alias("total"), *(
            F.sum(F.col("of_count")[i]).alias(n) for i, n in enumerate(names))).collect()}
        if _WORD not in rows or not rows[_WORD].total:
            return cls(0, 0, np.ones(LARGEST + 2), np.ones(LARGEST + 2), 1.0)
        tokens = int(rows[_WORD].total)
        word, pair = ([int(rows[k][n]) for n in names] for k in (_WORD, _PAIR))
        by_word = discounts(word, tokens)
        small = sum(r * word[r - 1] * by_word[r] for r in range(1, LARGEST + 1))
        large = (tokens - sum(r * word[r - 1] for r in range(1, LARGEST + 1))) * by_word[-1]
        return cls(tokens, int(rows[_WORD].distinct), by_word, discounts(pair, tokens), 1 - (small + large) / tokens)

    def word_probability(self, counts: np.ndarray) -> np.ndarray:
        factor = self.word_discount[np.minimum(counts, LARGEST + 1)]
        return np.where(counts > 0, factor * counts / max(1, self.tokens), self.unknown)


# --- evaluation -------------------------------------------------------------------------

_DOCUMENTS = "doc_id long, learned boolean, n_tokens long, n_known long, base_score double, score double"
_CONTEXTS = "bucket int, chunk long, keys binary, counts binary, mass binary, seen binary, users binary, uses binary"


def _aligned(row: dict, kind: int) -> np.ndarray:
    parts = sorted((a["bucket"], a["answers"], a["n"]) for a in row["given"] if a["kind"] == kind)
    return np.concatenate([_widened(data, n) for _, data, n in parts])


@dataclass
class _Evaluation:
    """A chunk with the answers to its words and pairs."""

    chunk: Chunk
    totals: Totals
    count: np.ndarray  # training count of each local word
    probability: np.ndarray  # of each local word
    pairs: np.ndarray  # answers, by distinct pair
    first: np.ndarray  # a token of each distinct pair
    context: np.ndarray  # of each token
    seen: np.ndarray  # training count of each token's pair

    @classmethod
    def of(cls, row: dict, totals: Totals) -> _Evaluation:
        chunk, pairs = Chunk.of(row), _aligned(row, _PAIR)
        count = np.empty(len(chunk.hashes), np.int64)
        count[np.argsort(chunk.hashes)] = _aligned(row, _WORD) >> 1
        _, first, place = chunk.pairs()
        return cls(chunk, totals, count, totals.word_probability(count), pairs, first, chunk.context, (pairs >> 1)[place])

    def documents(self, weights: list[dict]) -> pa.RecordBatch:
        """Sums by document; ``weights`` holds what buckets of contexts found for some places."""
        chunk, totals = self.chunk, self.totals
        edges = np.concatenate([[0], np.cumsum(chunk.lengths)[:-1]])
        by_document = lambda values: np.add.reduceat(values, edges)
        with np.errstate(divide="ignore"):
            direct = np.log10(totals.pair_discount[np.minimum(self.seen, LARGEST + 1)] * self.seen / np.maximum(self.count[self.context], 1))
        score = by_document(np.where(self.seen > 0, direct, np.log10(self.probability)[chunk.ids]))
        for part in sorted(weights, key=lambda w: w["bucket"]):
            score[np.frombuffer(part["places"], "<i4")] += np.frombuffer(part["weights"], "<f8")
        base = by_document(np.log10((self.count + 1) / (totals.tokens + totals.words + 1))[chunk.ids])
        known = by_document((self.count > 0).astype(np.int64)[chunk.ids])
        columns = [chunk.doc_ids, chunk.learned.tolist(), chunk.lengths.tolist(), known.tolist(),
                   base.tolist(), score.tolist()]
        return _batch(_DOCUMENTS, zip(*columns, strict=True))

    def contexts(self, buckets: int) -> pa.RecordBatch:
        """For each context: how often its own pairs were seen 1, 2, ... times, their words'
        mass, and the documents that back off there."""
        chunk, size = self.chunk, len(self.count)
        owned = np.flatnonzero(self.pairs & 1)
        owner, times, word = self.context[self.first[owned]], self.pairs[owned] >> 1, chunk.ids[self.first[owned]]
        of_count = np.stack([np.bincount(owner[times == r], minlength=size) for r in range(1, LARGEST + 1)], 1)
        mass = np.bincount(owner, self.probability[word], size)
        backs_off = (self.seen == 0) & (self.count[self.context] > 0)
        needed, at = np.unique(np.stack([self.context[backs_off], chunk.document[backs_off]], 1), axis=0, return_inverse=True)
        times_needed = np.bincount(at.reshape(-1), minlength=len(needed))
        uses = np.bincount(needed[:, 0], minlength=size)
        order = np.argsort(chunk.hashes)
        wanted = order[(mass[order] > 0) | (uses[order] > 0)]
        rank = np.full(size, -1)
        rank[wanted] = np.arange(len(wanted))
        by_rank = np.argsort(rank[needed[:, 0]], kind="stable")
        users = np.stack([needed[by_rank, 1], times_needed[by_rank]], 1).astype("<i4")
        ends = np.concatenate([[0], np.cumsum(uses[wanted])])
        rows = []
        for bucket, s in _slices(chunk.hashes[wanted], buckets):
            own = wanted[s]
            rows.append((bucket, chunk.number, _planes(chunk.hashes[own]), _narrow(self.count[own]), mass[own].astype("<f8").tobytes(),
                         _narrow(of_count[own]), users[ends[s.start]:ends[s.stop]].tobytes(), uses[own].astype("<i4").tobytes()))
        return _batch(_CONTEXTS, rows)


_ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}


def _batch(schema: str, rows: Iterable[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _document_batches(batches: Iterable[pa.RecordBatch], totals: Totals) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _rows(batch):
            yield _Evaluation.of(row, totals).documents(row["given_weights"] or [])


def _context_batches(batches: Iterable[pa.RecordBatch], totals: Totals, buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _rows(batch):
            yield _Evaluation.of(row, totals).contexts(buckets)


_WEIGHTED = "chunk long, bucket int, places binary, weights binary"


def backoff_weights(count: np.ndarray, of_count: np.ndarray, mass: np.ndarray, discount: np.ndarray) -> np.ndarray:
    """alpha of contexts: ``of_count`` [context, times - 1] and ``mass`` over all their pairs."""
    small = of_count * np.arange(1, LARGEST + 1)
    kept = (small * discount[1:-1]).sum(1) + (count - small.sum(1)) * discount[-1]
    return (1 - kept / count) / (1 - mass)


def _weigh(table: pa.Table, totals: Totals) -> pa.Table:
    """One bucket of contexts: their weights, summed for each document that needs them; one
    row for each chunk, so that rows do not grow with documents times buckets."""
    rows = table.to_pylist()
    own = [_unplanes(r["keys"]) for r in rows]
    keys, place = np.unique(np.concatenate(own), return_inverse=True)
    count = np.zeros(len(keys), np.int64)
    count[place] = np.concatenate([_widened(r["counts"], len(k)) for r, k in zip(rows, own, strict=True)])
    mass = np.bincount(place, np.concatenate([np.frombuffer(r["mass"], "<f8") for r in rows]), len(keys))
    seen = np.concatenate([_widened(r["seen"], LARGEST * len(k)).reshape(-1, LARGEST) for r, k in zip(rows, own, strict=True)])
    of_count = np.stack([np.bincount(place, seen[:, r], len(keys)) for r in range(LARGEST)], 1)
    weight = np.log10(backoff_weights(count, of_count, mass, totals.pair_discount))
    out, at = [], 0
    for row, part in zip(rows, own, strict=True):
        users = np.frombuffer(row["users"], "<i4").reshape(-1, 2).astype(np.int64)
        of_user = np.repeat(weight[place[at:at + len(part)]], np.frombuffer(row["uses"], "<i4"))
        at += len(part)
        documents, to = np.unique(users[:, 0], return_inverse=True)
        sums = np.bincount(to, of_user * users[:, 1], len(documents))
        out.append((row["chunk"], row["bucket"], documents.astype("<i4").tobytes(), sums.astype("<f8").tobytes()))
    return pa.Table.from_batches([_batch(_WEIGHTED, out)])


def held_out(doc_id: Column) -> Column:
    """The fold the model never sees; a row without identifier belongs to it."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(7)) == 2, F.lit(True))


def score_documents(documents: DataFrame, learned: Column, text: str = "text", doc_id: str = "doc_id",
                    chunk_tokens: int = CHUNK_TOKENS, bucket_items: int = BUCKET_ITEMS) -> DataFrame:
    """One row per row of ``documents``: doc_id, learned, n_tokens, n_known, train_tokens,
    base_score (add-one unigram) and score (Katz), both log10 of the text's probability."""
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), learned.alias("learned"))
    chunks = stored(rows.mapInArrow(lambda b: _chunk_batches(b, chunk_tokens), _CHUNKS), "katz-chunks")
    tokens = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = (1 + tokens // (8 * bucket_items), 1 + tokens // bucket_items)
    requests = chunks.mapInArrow(lambda b: _request_batches(b, buckets), _REQUESTS)
    answers = stored(requests.groupBy("kind", "bucket").applyInArrow(_answer, _ANSWERS), "katz-counts")
    totals = Totals.of(answers)
    given = answers.groupBy("chunk").agg(F.collect_list(F.struct("kind", "bucket", "answers", "n")).alias("given"))
    # Evaluated twice, once for each use: keeping the sums of contexts would cost more disk
    # than the evaluation costs time. Both uses read the same exchanges.
    answered = chunks.join(given, "chunk")
    weights = (answered.mapInArrow(lambda b: _context_batches(b, totals, buckets[1]), _CONTEXTS)
               .groupBy("bucket").applyInArrow(lambda table: _weigh(table, totals), _WEIGHTED)
               .groupBy("chunk").agg(F.collect_list(F.struct("bucket", "places", "weights")).alias("given_weights")))
    found = answered.join(weights, "chunk", "left").mapInArrow(lambda b: _document_batches(b, totals), _DOCUMENTS)
    return found.select("doc_id", "learned", "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score", "score")
