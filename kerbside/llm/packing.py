"""Cost-balanced packing of tokenised documents into training sequences.

A sequence costs ``linear * tokens + quadratic * sum(piece length ** 2)``: projections grow
with the tokens, attention within a document with their square. Documents are taken in
descending length and each goes to the cheapest sequence that still has room for it, so
long pieces spread over the sequences and short ones level the costs. A document that fills
whole sequences is cut there first; one that fits nowhere is cut into the remaining gaps.

Packing happens where the documents are read: a task buffers documents up to
``BUFFER_TOKENS`` tokens (one document more at most), packs the buffer into as few
sequences as its tokens need, and goes on. Nothing is shuffled, no key can be hot, and a
buffer's padding is less than one sequence. A task that runs again gives the same pieces.

A null text is an empty document, of one end token. Rows repeating an identifier are packed
as documents of their own. Special-token strings in a text are encoded as the tokenizer
file says.
"""

from __future__ import annotations

import base64
import itertools
import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUFFER_TOKENS = 1 << 21
END_ID = 1

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_SPECIAL = "<|"  # begins every special token of the vocabularies used here


class Encoder:
    """Ids of a byte-level tokenizer file.

    The same vocabulary as ranks encodes a text several times faster; it is used for texts
    of Latin-1 characters, on whose classes (letter, digit, space) both libraries agree.
    Other texts are cut where the tokenizer's own splitting always has a boundary, before a
    single space between visible characters, and only the stretches with other characters,
    and those that may hold a special token, go to the slower library.
    """

    def __init__(self, path: str, ranks_path: str | None = None, pattern: str = "", remembered: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._remembered, self._limit = {}, remembered
        self._ranked = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self._ranked = tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def _whole(self, text: str) -> bytes:
        found = self._remembered.get(text)
        if found is None:
            found = np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            if len(text) <= 64 and len(self._remembered) < self._limit:
                self._remembered[text] = found
        return found

    def _fast(self, text: str) -> bool:
        return self._ranked is not None and _SPECIAL not in text and _is_latin(text)

    def ids(self, text: str) -> bytes:
        """Little-endian 32-bit ids of ``text``."""
        if not text:
            return b""
        if self._fast(text):
            return self._ranked.encode_to_numpy(text).astype("<u4").tobytes()
        chunks = _SINGLE_SPACE.split(text)
        out = []
        for fast, own in itertools.groupby((c if i == 0 else " " + c for i, c in enumerate(chunks)), self._fast):
            out += [self._ranked.encode_to_numpy("".join(own)).astype("<u4").tobytes()] if fast else map(self._whole, own)
        return b"".join(out)


def _is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def pack(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece; sequences count from 0.

    >>> pack([3, 2, 2], 4, 1.0, 1.0)
    [(0, 0, 3, 0, 0), (1, 0, 2, 1, 0), (2, 0, 2, 1, 2)]
    """
    pieces, rest, sequence = [], [], 0
    for document, length in enumerate(lengths):
        start = 0
        while length - start >= capacity:
            pieces.append((document, start, capacity, sequence, 0))
            start, sequence = start + capacity, sequence + 1
        if start < length:
            rest.append((length - start, document, start))
    if not rest:
        return pieces
    count = -(-sum(r[0] for r in rest) // capacity)
    cost, room = np.zeros(count), np.full(count, capacity, np.int64)

    def place(document: int, start: int, length: int, at: int) -> None:
        pieces.append((document, start, length, sequence + at, capacity - int(room[at])))
        cost[at] += linear * length + quadratic * length * length
        room[at] -= length

    left_over = []
    for length, document, start in sorted(rest, key=lambda r: (-r[0], r[1])):
        fits = np.flatnonzero(room >= length)
        if fits.size:
            place(document, start, length, int(fits[np.argmin(cost[fits])]))
        else:
            left_over.append((length, document, start))
    for length, document, start in left_over:
        while length:
            fits = np.flatnonzero(room > 0)
            at = int(fits[np.argmax(room[fits])])
            taken = min(length, int(room[at]))
            place(document, start, taken, at)
            length, start = length - taken, start + taken
    return pieces


def _pack_batches(batches: Iterable[pa.RecordBatch], files: tuple, capacity: int, linear: float, quadratic: float,
                  buffer_tokens: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(*files)
    end = np.array([END_ID], "<u4").tobytes()
    task = TaskContext.get()
    next_sequence = (task.partitionId() if task else 0) << 33
    held: list[tuple[int | None, bytes]] = []
    tokens = 0

    def flush() -> pa.RecordBatch:
        nonlocal held, tokens, next_sequence
        pieces = pack([len(ids) // 4 for _, ids in held], capacity, linear, quadratic)
        cut = [held[d][1][4 * s:4 * (s + n)] for d, s, n, _, _ in pieces]
        columns = [pa.array([held[p[0]][0] for p in pieces], pa.int64()), [p[1] for p in pieces], [p[2] for p in pieces],
                   [zlib.crc32(c) for c in cut], [len(held[p[0]][1]) // 4 for p in pieces],
                   [next_sequence + p[3] for p in pieces], [p[4] for p in pieces]]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        arrays = [pa.array(c, pa.int64()) if isinstance(c, list) else c for c in columns]
        if with_ids:
            arrays, names = [*arrays, pa.array(cut, pa.binary())], [*names, "ids"]
        next_sequence += 1 + max((p[3] for p in pieces), default=-1)
        held, tokens = [], 0
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            ids = encoder.ids(text.as_py() or "") + end
            held.append((doc_id, ids))
            tokens += len(ids) // 4
            if tokens >= buffer_tokens:
                yield flush()
    if held:
        yield flush()


def packed_pieces(documents: DataFrame, tokenizer_path: str, ranks_path: str | None = None, pattern: str = "", capacity: int = 2048, linear: float = 1.0,
                  quadratic: float = 1.0 / 2048, text: str = "text", doc_id: str = "doc_id",
                  buffer_tokens: int = BUFFER_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece: its document, place, length, sequence and offset, the CRC-32 of
    its ids (little-endian unsigned 32-bit) and, with ``with_ids``, those ids as binary.
    ``ranks_path`` and ``pattern`` give the same vocabulary in its faster form, if any; all
    files must be at the same path on every machine."""
    if capacity < 1:
        raise ValueError("capacity must be positive")
    pairs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = _PIECES + (", ids binary" if with_ids else "")
    return pairs.mapInArrow(lambda batches: _pack_batches(batches, (tokenizer_path, ranks_path, pattern), capacity, linear, quadratic,
                                                          buffer_tokens, with_ids), schema)
