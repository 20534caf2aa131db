"""Language identification by prediction by partial matching.

Per language, a context tree of byte contexts up to ``ORDER`` bytes is counted over a
bounded sample of labelled texts and then frozen. The code length of a byte after its
context follows the usual recursion with escapes (method C, without exclusion): at the
longest context the language has seen, a seen byte costs ``-log2(count / (total + kinds))``;
an unseen one costs the escape ``-log2(kinds / (total + kinds))`` and is coded one order
lower; below order 0 all bytes are equally likely. The language with the shortest code of
the whole text is predicted.

For scoring, the recursion is evaluated once for every context and byte any language has
seen, so that a text's code lengths are table look-ups over all its positions at once; a
byte no language has seen after its context escapes to the next lower table. The tables are
bounded by the sample and are broadcast; their size does not grow with the documents.

A null text, and a text without a letter, is ``und``. Without any labelled text every
document is ``und``. Languages that tie in code length go by name. Whole texts are scored,
a piece at a time. Learning is bound by a number of texts per language, not by their bytes.
Rows are independent: nothing is shuffled, repeats get equal results; an empty table gives no
rows. Columns of other names stay out of it or, in ``with_language``, stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER = 3  # bytes of context
SAMPLE_PER_LANGUAGE = 1200  # labelled texts per language, about
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_START = b"\n" * ORDER  # every text is read as if it followed line ends
_SLOTS = 1 << 22
_CHUNK = 1 << 20  # bytes scored at once


def _grams(data: np.ndarray, order: int) -> np.ndarray:
    """The ``order`` bytes before each position and the byte there, as one number; ``data``
    begins with ``ORDER`` bytes that are context only."""
    out = np.zeros(len(data) - ORDER, np.uint64)
    for back in range(order, -1, -1):
        out = (out << np.uint64(8)) | data[ORDER - back:len(data) - back].astype(np.uint64)
    return out


# --- counting ---------------------------------------------------------------------------


def labelled_sample(documents: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """About ``per_language`` labelled texts of each language, chosen by a hash of their
    identifier; whole texts."""
    usable = documents.filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = usable.groupBy("lang").agg(F.count("*").alias("in_language"))
    place = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1_000_000))
    return (usable.join(F.broadcast(counts), "lang")  # one row per language
            .filter(place * F.col("in_language") < 1_000_000 * per_language).select("lang", "text"))


def _count_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_language: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            by_language.setdefault(lang, []).append(text.encode())
        for lang, texts in by_language.items():
            own = np.concatenate([_grams(np.frombuffer(_START + t, np.uint8), ORDER) for t in texts])
            grams, counts = np.unique(own, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(counts)],
                                             names=["lang", "gram", "n"])


def context_counts(sample: DataFrame) -> DataFrame:
    """(lang, gram, n): occurrences of each context of ``ORDER`` bytes with its next byte."""
    return sample.mapInArrow(_count_batches, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# --- the frozen model -------------------------------------------------------------------


@dataclass(frozen=True)
class Table:
    """Numbers in an open hash table, and a row of values for each language."""

    slots: np.ndarray  # place of a number's row, -1 free
    keys: np.ndarray
    values: np.ndarray  # [numbers, languages]

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Rows of ``wanted``, -1 where absent."""
        at = _slot(wanted, len(self.slots))
        rows = self.slots[at]
        open_ = np.flatnonzero((rows >= 0) & (self.keys[rows] != wanted))
        while open_.size:  # other numbers sit in the slot: look at the next
            at[open_] = (at[open_] + 1) % len(self.slots)
            rows[open_] = self.slots[at[open_]]
            open_ = open_[(rows[open_] >= 0) & (self.keys[rows[open_]] != wanted[open_])]
        return rows


def _slot(numbers: np.ndarray, size: int) -> np.ndarray:
    mixed = (numbers ^ (numbers >> np.uint64(15))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def table(keys: np.ndarray, values: np.ndarray) -> Table:
    size = 16
    while size < min(_SLOTS, 4 * len(keys)) or size < 2 * len(keys):
        size *= 2
    slots = np.full(size, -1, np.int32)
    left, at = np.arange(len(keys), dtype=np.int32), _slot(keys, size)
    while left.size:  # the first of those that want a free slot gets it
        free = slots[at] < 0
        slots[at[free][::-1]] = left[free][::-1]
        lost = slots[at] != left
        left, at = left[lost], (at[lost] + 1) % size
    return Table(slots, keys, values)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    codes: list[Table]  # by order: bits of a byte after its context
    escapes: list[Table]  # by order: bits to leave a context for a byte no language saw there


def _bits(share: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return -np.log2(share)


def freeze(languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """The tables of all orders from the counts of the highest. ``lang`` numbers ``languages``."""
    wide = len(languages)
    keys, counts = [], []  # by order: all grams, and [gram, language] counts
    for order in range(ORDER + 1):
        own, at = np.unique(gram & np.uint64((1 << (8 * (order + 1))) - 1), return_inverse=True)
        table_ = np.zeros((len(own), wide))
        np.add.at(table_, (at, lang), n)
        keys.append(own)
        counts.append(table_)
    codes: list[Table] = []
    escapes: list[Table] = []
    below = np.full((1, wide), 8.0)  # order -1: all bytes are equally likely
    for order in range(ORDER + 1):
        own, at = np.unique(keys[order] >> np.uint64(8), return_inverse=True)
        total, kinds = np.zeros((len(own), wide)), np.zeros((len(own), wide))
        np.add.at(total, at, counts[order])
        np.add.at(kinds, at, counts[order] > 0)
        room = np.maximum(total + kinds, 1)
        escape = np.where(total > 0, _bits(kinds / room), 0.0)
        down = np.searchsorted(keys[order - 1], _suffix(keys[order], order)) if order else 0
        code = np.where(counts[order] > 0, _bits(counts[order] / room[at]), escape[at] + below[down])
        codes.append(table(keys[order], code.astype(np.float32)))
        escapes.append(table(own, escape.astype(np.float32)))
        below = code
    return Model(languages, codes, escapes)


def _suffix(number: np.ndarray, size: int) -> np.ndarray:
    """The last ``size`` bytes."""
    return number & np.uint64((1 << (8 * size)) - 1)


def fit(documents: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model of the labelled documents given; the counts that reach the driver are bounded
    by the sample."""
    rows = context_counts(labelled_sample(documents, per_language)).toArrow()
    names = sorted(set(rows.column("lang").to_pylist()))
    number = {name: i for i, name in enumerate(names)}
    lang = np.array([number[x] for x in rows.column("lang").to_pylist()], np.int64)
    return freeze(names, lang, rows.column("gram").to_numpy().astype(np.uint64), rows.column("n").to_numpy())


# --- scoring ----------------------------------------------------------------------------


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """[text, language] bits, in chunks of about ``_CHUNK`` bytes of neighbouring texts."""
    out = np.zeros((len(texts), len(model.languages)))
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (size == 0 or size + len(texts[end]) <= _CHUNK):
            size += len(texts[end])
            end += 1
        for piece, owner in _pieces(texts, at, end):
            out[at:end] += _piece_bits(model, piece, owner, end - at)
        at = end
    return out


def _pieces(texts: list[bytes], at: int, end: int) -> Iterator[tuple[list[bytes], list[int]]]:
    """The texts with their leading context; a text longer than a chunk comes in several."""
    if end - at > 1 or len(texts[at]) <= _CHUNK:
        yield [_START + t for t in texts[at:end]], list(range(end - at))
        return
    whole = _START + texts[at]
    for start in range(0, len(texts[at]), _CHUNK):
        yield [whole[start:start + _CHUNK + ORDER]], [0]


def _piece_bits(model: Model, texts: list[bytes], owner: list[int], count: int) -> np.ndarray:
    out = np.zeros((count, len(model.languages)))
    sizes = np.array([len(t) - ORDER for t in texts])
    if not sizes.sum():
        return out
    data = np.frombuffer(b"".join(texts), np.uint8)
    context_only = np.zeros(len(data), bool)
    begins = np.concatenate([[0], np.cumsum(sizes + ORDER)[:-1]])
    for back in range(ORDER):
        context_only[begins + back] = True
    position = np.flatnonzero(~context_only[ORDER:])
    full = _grams(data, ORDER)[position]
    rows = model.codes[ORDER].find(full)
    bits = model.codes[ORDER].values[np.maximum(rows, 0)]
    missing = np.flatnonzero(rows < 0)
    if missing.size:
        bits[missing] = _lower_bits(model, full[missing], ORDER)
    filled = np.flatnonzero(sizes)
    edges = np.concatenate([[0], np.cumsum(sizes)])[filled]
    np.add.at(out, np.array(owner)[filled], np.add.reduceat(bits, edges, axis=0, dtype=np.float64))
    return out


def _lower_bits(model: Model, gram: np.ndarray, order: int) -> np.ndarray:
    """Bits of grams absent from ``order``: the escape from their context, where it is known,
    and the next lower table."""
    context = model.escapes[order].find(gram >> np.uint64(8))
    bits = np.where((context >= 0)[:, None], model.escapes[order].values[np.maximum(context, 0)], 0).astype(np.float32)
    if order == 0:
        return bits + np.float32(8)
    short = _suffix(gram, order)
    rows = model.codes[order - 1].find(short)
    bits += np.where((rows >= 0)[:, None], model.codes[order - 1].values[np.maximum(rows, 0)], 0)
    missing = np.flatnonzero(rows < 0)
    if missing.size:
        bits[missing] += _lower_bits(model, short[missing], order - 1)
    return bits


def _predict_batches(batches: Iterable[pa.RecordBatch], model: Model, text: str, extra: list[str], names: tuple[str, str] = ("lang_pred", "score")) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column(text).cast(pa.string()).to_pylist()]
        languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        usable = [i for i, t in enumerate(texts) if model.languages and _LETTER.search(t)]
        if usable:
            bits = code_lengths(model, [texts[i].encode() for i in usable])
            best = bits.argmin(1)
            share = 1 / np.exp2(np.maximum(bits.min(1)[:, None] - bits, -1000)).sum(1)
            for i, b, s in zip(usable, best, share, strict=True):
                languages[i], scores[i] = model.languages[b], float(s)
        kept = [batch.column(c) for c in extra]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(languages, pa.string()), pa.array(scores, pa.float64())], names=[*extra, *names])


def predict(documents: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred and score: the probability of the language among all learned ones,
    by code length and equal priors."""
    pairs = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kind = dict(pairs.dtypes)["doc_id"]
    return pairs.mapInArrow(lambda batches: _predict_batches(batches, shared.value, "text", ["doc_id"]),
                            f"doc_id {kind}, lang_pred string, score double")


def with_language(documents: DataFrame, model: Model, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``documents``, all columns as they are, and two more for language and score: ``names``,
    each followed by underscores where a column has that name already."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    columns, free = documents.columns, []
    for name in names:
        while name.lower() in {c.lower() for c in [*columns, *free]}:
            name += "_"
        free.append(name)
    schema = T.StructType([*documents.schema.fields, T.StructField(free[0], T.StringType()), T.StructField(free[1], T.DoubleType())])
    return documents.mapInArrow(lambda batches: _predict_batches(batches, shared.value, text, columns, (free[0], free[1])), schema)


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from; a row without identifier belongs to it."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))
