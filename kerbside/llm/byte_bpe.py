"""Byte-level BPE by backtracking over longest matches, and its inverse.

A text is cut by the vocabulary's pattern and every piece is encoded on its own. The bytes
of a piece, read as Latin-1, pass once through an Aho-Corasick automaton of all tokens; the
longest token at every place is noted. A sequence of tokens is what merging gives exactly
when every two neighbours are what merging gives for their own bytes. So the encoder takes
the longest token that is compatible with the one before, falls back to shorter prefixes of
it, and steps back one token where none is left; a place that was left this way is never
entered again, so the work is linear in the piece. Compatibility of two tokens is found once
by merging their bytes and remembered; whole short pieces are remembered too. A piece that is
itself a token is that token, as in the rank form of the vocabulary.

Each row is encoded alone in one map pass, without an exchange; a repeated row, a tie of
ranks (the leftmost merges first) and the order of rows change nothing. A null text counts
as empty and has no ids; null ids decode to no bytes. Long texts are whole: places of a
piece are matched in blocks of ``BLOCK`` bytes, so beside the text and its ids a piece takes
one byte per byte. An empty table gives no rows. Only the named columns are read, whatever
others there are, and results have names of their own.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

BLOCK = 1 << 16
REMEMBERED = 400_000  # pieces of at most ``_SHORT`` characters, and as many pairs of tokens
OUTPUT_BYTES = 1 << 24  # of one Arrow batch, one row more at most

_SHORT = 48


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Splitter:
    """Pieces of a text by ``pattern``, with letters and numbers as the tiktoken library has
    them. Its Unicode version may be another than the one of the ``regex`` module: characters
    on which the two disagree are found by asking both, and taken out of or into the classes
    in texts that hold such a character."""

    _disagree: dict[str, tuple[set[str], set[str]]] | None = None

    def __init__(self, pattern: str):
        self._plain = regex.compile(pattern)
        classes = self._classes()
        self._odd = frozenset().union(*(a | b for a, b in classes.values()))
        exact = pattern
        for name, (more, less) in classes.items():
            # Within a set, a nested set may follow; both forms are one set of version 1.
            exact = exact.replace(name, f"[[{name}{_ranges(more)}]--[{_ranges(less)}]]" if less else f"[{name}{_ranges(more)}]")
        self._exact = regex.compile(exact, regex.V1)

    @classmethod
    def _classes(cls) -> dict[str, tuple[set[str], set[str]]]:
        if cls._disagree is None:
            every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
            single = {bytes([b]): b for b in range(256)}
            found = {}
            for name in (r"\p{L}", r"\p{N}", r"\s"):
                theirs = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
                theirs, ours = set(bytes(theirs).decode()), set(regex.findall(name, every))
                if theirs != ours:
                    found[name] = (theirs - ours, ours - theirs)
            cls._disagree = found
        return cls._disagree

    def pieces(self, text: str) -> Iterable[str]:
        pattern = self._plain if text.isascii() or self._odd.isdisjoint(text) else self._exact
        # A list of all pieces is faster, but takes some thirty times the memory of its text.
        return pattern.findall(text) if len(text) < BLOCK else (m[0] for m in pattern.finditer(text))


def _ranges(characters: set[str]) -> str:
    """Contents of a character class."""
    runs: list[list[int]] = []
    for code in sorted(map(ord, characters)):
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


class Codec:
    """Ids of texts and bytes of ids, for one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._pattern = pattern
        self._pairs: dict[int, bool] = {}
        self._known: dict[str, bytes] = {}
        self._automaton = None

    def _prepare(self) -> None:
        """What only encoding needs; a worker that decodes does without."""
        ranks = self.ranks
        self._splitter = Splitter(self._pattern)
        self._longest_token = max(map(len, ranks), default=1)
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in ranks.items():
            self._automaton.add_word(token.decode("latin-1"), rank)
        self._automaton.make_automaton()
        self._sizes = {rank: len(token) for token, rank in ranks.items()}
        self._base = max(ranks.values(), default=0) + 1
        # The longest token that is a proper prefix of each.
        self._shorter = {rank: next((ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in ranks), None) for t, rank in ranks.items()}

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self._automaton is None:
            self._prepare()
        out, known = bytearray(), self._known
        for piece in self._splitter.pieces(text):
            ids = known.get(piece)
            if ids is None:
                ids = self._encode_piece(piece.encode())
                if len(piece) <= _SHORT:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = ids
            out += ids
        return np.frombuffer(out, "=u4").astype("<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        if len(ids) % 4:
            raise ValueError("ids are 32-bit integers")
        tokens, out = self.tokens, bytearray()
        for start in range(0, len(ids), 4 * BLOCK):
            try:
                out += b"".join([tokens[i] for i in np.frombuffer(ids[start:start + 4 * BLOCK], "<u4").tolist()])
            except KeyError as unknown:
                raise ValueError(f"no token has the id {unknown}") from None
        return bytes(out)

    def _encode_piece(self, piece: bytes) -> bytes:
        whole = self.ranks.get(piece)
        return (array("I", [whole]) if whole is not None else self._backtrack(piece)).tobytes()

    def _backtrack(self, piece: bytes) -> array:
        size, latin, sizes, pairs, shorter, base_id = len(piece), piece.decode("latin-1"), self._sizes, self._pairs, self._shorter, self._base
        out, left, place, last = array("I"), bytearray(size + 1), 0, -1
        base, longest = 0, self._matches(latin, 0)
        token = longest[0]
        while place < size:
            while token is not None:
                end = place + sizes[token]
                if not left[end]:
                    fits = last < 0 or pairs.get(last * base_id + token)
                    if fits is None:
                        fits = self._compatible(last, token)
                    if fits:
                        break
                token = shorter[token]
            if token is None:
                if last < 0:
                    raise ValueError("the vocabulary has no token for some byte")
                left[place] = 1  # from here no way leads to the end
                place -= sizes[last]
                token = shorter[out.pop()]
                last = out[-1] if out else -1
                continue
            out.append(token)
            place, last = end, token
            if place < size:
                at = place - base
                if not 0 <= at < len(longest):
                    # Some places before are noted again, so that small steps back stay inside.
                    base = max(0, place - BLOCK // 4)
                    longest, at = self._matches(latin, base), place - base
                token = longest[at]
        return out

    def _matches(self, latin: str, start: int) -> list[int | None]:
        """The longest token at each of ``BLOCK`` places from ``start``."""
        found: list[int | None] = [None] * min(BLOCK, len(latin) - start)
        stop, sizes = len(found), self._sizes
        # Matches come by their ends, so the last one noted at a place is the longest.
        for end, rank in self._automaton.iter(latin[start:start + stop + self._longest_token - 1] if start or stop < len(latin) else latin):
            at = end + 1 - sizes[rank]
            if at < stop:
                found[at] = rank
        return found

    def _compatible(self, first: int, second: int) -> bool:
        """Whether merging the bytes of both tokens gives just these two."""
        if len(self._pairs) >= REMEMBERED:
            self._pairs.clear()
        a, b = self.tokens[first], self.tokens[second]
        found = self._pairs[first * self._base + second] = merged(a + b, self.ranks) == [a, b]
        return found


def merged(data: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The definition: of all neighbours that join to a token, the pair of least rank is
    joined, the leftmost of equals, until none is left.

    >>> merged(b"aaa", {b"a": 0, b"aa": 1})
    [b'aa', b'a']
    """
    none = sys.maxsize
    parts = [data[i:i + 1] for i in range(len(data))]
    costs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while costs and (least := min(costs)) != none:
        at = costs.index(least)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del costs[at]
        if at < len(costs):
            costs[at] = ranks.get(parts[at] + parts[at + 1], none)
        if at:
            costs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
    return parts


_codecs: dict[tuple[str, str], Codec] = {}


def codec(ranks_path: str, pattern: str) -> Codec:
    """One per Python worker and vocabulary; it starts from the file, so a task that runs
    again elsewhere gives the same."""
    key = (ranks_path, pattern)
    if key not in _codecs:
        _codecs[key] = Codec(read_ranks(ranks_path), pattern)
    return _codecs[key]


def _flushed(rows: Iterable[tuple], kinds: list[pa.DataType], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of rows of a key and binary values, of some ``OUTPUT_BYTES``."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    for row in rows:
        held.append(row)
        size += sum(map(len, row[1:]))
        if size >= OUTPUT_BYTES or len(held) >= 10_000:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _mapped(table: DataFrame, key: str, value: str, kind: str, out: list[str], function: Callable[[object], tuple]) -> DataFrame:
    """``function`` of each row's value, which gives the binary columns ``out``."""
    pairs = table.select(F.col(key).alias("doc_id"), F.col(value).cast(kind).alias("value"))
    schema = StructType([StructField("doc_id", pairs.schema["doc_id"].dataType), *(StructField(name, BinaryType()) for name in out)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values = batch.columns
            rows = ((i.as_py(), *function(v.as_py())) for i, v in zip(ids, values, strict=True))
            yield from _flushed(rows, [ids.type] + [pa.binary()] * len(out), ["doc_id", *out])

    return pairs.mapInArrow(run, schema)


def encoded(documents: DataFrame, ranks_path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, ids) of every row, in its own partition; ``ids`` are little-endian unsigned
    32-bit integers as binary. The rank file must be at the same path on every machine.
    Strings of special tokens are ordinary text."""
    return _mapped(documents, doc_id, text, "string", ["ids"], lambda value: (codec(ranks_path, pattern).encode(value or ""),))


def decoded(table: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, data): the bytes of every row's ``ids``. An id outside the vocabulary, or
    binary that is no whole number of ids, is a ValueError."""
    return _mapped(table, doc_id, ids, "binary", ["data"], lambda value: (codec(ranks_path, pattern).decode(value or b""),))


def round_trip(documents: DataFrame, ranks_path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, ids, data): ``encoded`` and ``decoded`` one after the other on each row, in
    one Python process and not in two that each hold the vocabulary."""
    def both(value: str | None) -> tuple[bytes, bytes]:
        own = codec(ranks_path, pattern)
        ids = own.encode(value or "")
        return ids, own.decode(ids)

    return _mapped(documents, doc_id, text, "string", ["ids", "data"], both)
