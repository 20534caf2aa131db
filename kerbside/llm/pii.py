"""Personal data: fixed patterns, and a linear-chain conditional random field that adds spans.

The patterns give the base spans of four kinds. The field sees word shapes only (letters,
digits and punctuation around a token) and finds the forms the patterns miss: telephone
numbers without a plus sign, cards with other separators, addresses written with "[at]" or
"[dot]". It is trained on a small labelled table, built from at most ``MAX_LABELLED``
windows of the documents: each is labelled by the patterns, and rewritten by ``VARIANTS``
into the other forms, whose labels are known by construction. Windows without a base span
are the negative examples.

Decoding is exact Viterbi, in numpy over batches of windows of like length, whose padded size
is bounded; a long window is decoded in stretches that carry the scores on. A window is a run
of tokens around a digit, an at sign or a bracketed "at", up to white space on both sides; no
span of any kind can lie outside one. An added span must keep its kind's own rule (Luhn sum, parts up to 255, number
of digits, a whole address) and may not touch a base span, so clean text stays clean.

Null texts count as empty. Rows are independent of each other: nothing is shuffled, repeated
rows get equal results, and a document's cost is linear in its length. Paths that tie take the
tag that comes first in ``TAGS``. An empty table gives no rows and trains no field: then only
the base spans are found. Of other columns, whatever their names, none is read.
"""

from __future__ import annotations

import bisect
import itertools
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from collections.abc import Sequence as Sequence_
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
MAX_LABELLED = 160  # windows in the labelled table
SAMPLE_DOCUMENTS = 4000  # documents they come from, about
LABELLED_CHARACTERS = 360  # longer windows are not taken into the labelled table
BATCH_TOKENS = 1 << 14  # decoded at once, padding included
REACH = 48  # characters of context on each side

Span = tuple[str, int, int]

# The base patterns.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_TRIGGER = re.compile(r"[0-9@]|[\[({]\x20?(?:at|AT)\x20?[\])}]")
_SPACE = re.compile(r"\s")
_TOKEN = re.compile(r"[A-Za-zÀ-ÿ]+|[0-9]+|[^\sA-Za-zÀ-ÿ0-9]")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _small_parts(address: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in address.split("."))


def _emails(text: str) -> Iterator[Span]:
    """The leftmost matches, in time linear in the text: the part before an at sign is the
    whole run of its characters, and no match can cross another at sign."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = done + len(text[done:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            yield "email", start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and then kind."""
    found = list(_emails(text)) if "@" in text else []
    if re.search("[0-9]", text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if _small_parts(m.group())]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(number := _digits(m.group())) <= 19 and luhn(number):
                found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


# --- windows and features ---------------------------------------------------------------


def windows(text: str, reach: int = REACH) -> list[tuple[int, int]]:
    """Disjoint stretches within ``reach`` characters of a trigger, widened to white space."""
    out: list[tuple[int, int]] = []
    for m in _TRIGGER.finditer(text):
        if out and m.end() + reach <= out[-1][1]:
            continue
        before = out[-1][1] if out else 0
        start, end = max(before, m.start() - reach), min(len(text), m.end() + reach)
        while start > before and not text[start - 1].isspace():
            start -= 1
        space = _SPACE.search(text, end)
        end = space.start() if space else len(text)
        if out and start <= before:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def _shape(token: str) -> str:
    if token[0].isdigit():
        return f"d{len(token)}" if len(token) < 5 else "d5-9" if len(token) < 10 else "d10-13" if len(token) < 14 else "d14+"
    if not token[0].isalpha():
        return token
    if token in ("at", "AT", "dot", "DOT"):
        return token.lower()
    return ("x" if token.islower() else "X" if token.isupper() else "Xx") + ("1" if len(token) == 1 else "")


def token_marks(tokens: list[str], gaps: list[bool]) -> list[str]:
    """The shape of each token and whether white space comes before it, two ends around."""
    marks = [sys.intern(("_" if g else "") + _shape(t)) for t, g in zip(tokens, gaps, strict=True)]
    return ["_<", "_<", *marks, "_>", "_>"]


def token_features(marks: list[str], start: int, end: int) -> list[list[str]]:
    """Names of the features of tokens ``start`` to ``end`` from their neighbours' marks."""
    out = []
    for i in range(start, end):
        a, b, c, d, e = marks[i:i + 5]
        out.append([f"0{c}", f"-{b}", f"+{d}", f"--{a}", f"++{e}", f"-0{b}|{c}", f"0+{c}|{d}", f"-0+{b}|{c}|{d}",
                    f"--0{a}|{b}|{c}", f"0++{c}|{d}|{e}"])
    return out


@dataclass(frozen=True)
class Sequence:
    """A window's tokens with their places in the text."""

    marks: list[str]
    starts: array
    ends: array

    def __len__(self) -> int:
        return len(self.starts)

    def features(self, start: int = 0, end: int | None = None) -> list[list[str]]:
        return token_features(self.marks, start, len(self) if end is None else min(end, len(self)))


def sequence_of(text: str, start: int, end: int) -> Sequence:
    tokens, starts, ends = [], array("q"), array("q")
    for m in _TOKEN.finditer(text, start, end):
        tokens.append(m.group())
        starts.append(m.start())
        ends.append(m.end())
    gaps = [i == 0 or starts[i] > ends[i - 1] for i in range(len(starts))]
    return Sequence(token_marks(tokens, gaps), starts, ends)


# --- the field --------------------------------------------------------------------------

TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
_START, _NEVER = -1e4, -1e4


def _allowed() -> np.ndarray:
    """Inside a kind may only follow the beginning or inside of that kind."""
    allowed = np.zeros((len(TAGS), len(TAGS)))
    for j, tag in enumerate(TAGS):
        if tag[0] == "I":
            for i, before in enumerate(TAGS):
                if before[1:] != tag[1:]:
                    allowed[i, j] = _NEVER
    return allowed


def tags_of(sequence: Sequence, spans: list[Span]) -> list[int]:
    tags = [0] * len(sequence)
    for kind, start, end in spans:
        inside = [i for i, (s, e) in enumerate(zip(sequence.starts, sequence.ends, strict=True)) if s < end and e > start]
        for n, i in enumerate(inside):
            tags[i] = TAGS.index(("I-" if n else "B-") + kind)
    return tags


def _padded(rows: list[list[list[int]]], size: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers as [row, token, feature], at least ``size`` tokens, and each row's
    length; -1 pads."""
    width = max((len(f) for r in rows for f in r), default=1)
    lengths = np.array([len(r) for r in rows])
    out = np.full((len(rows), max(size, int(lengths.max(initial=1))), max(1, width)), -1, np.int64)
    for i, row in enumerate(rows):
        for t, features in enumerate(row):
            out[i, t, :len(features)] = features
    return out, lengths


@dataclass(frozen=True)
class Field:
    """Weights: ``state`` [features + 1, tags] (the last row, of zeros, pads), ``step`` [tags, tags]."""

    names: dict[str, int]
    state: np.ndarray
    step: np.ndarray

    def emitted(self, sequences: list[Sequence], start: int, end: int) -> np.ndarray:
        """[row, token, tag] of tokens ``start`` to ``end`` of each sequence."""
        names = self.names
        numbers, _ = _padded([[[n for f in fs if (n := names.get(f)) is not None] for fs in s.features(start, end)] for s in sequences], end - start)
        return self.state[numbers].sum(2)

    def decode(self, sequences: list[Sequence], budget: int = BATCH_TOKENS) -> list[list[int]]:
        """The most probable tags of each sequence. Sequences of like length go together, as
        many as pad to ``budget`` tokens; a longer one goes alone and in stretches of that
        many, each taking up the scores of the one before, so memory does not follow length."""
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        out: list[list[int]] = [[]] * len(sequences)
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * len(sequences[order[end]]) <= budget:
                end += 1
            own = [sequences[i] for i in order[at:end]]
            size = max(1, len(own[-1]))
            parts = (self.emitted(own, t, min(size, t + budget)) for t in range(0, size, budget))
            for i, tags in zip(order[at:end], viterbi(parts, self.step, [len(s) for s in own]), strict=True):
                out[i] = tags
            at = end
        return out


def viterbi(parts: Iterable[np.ndarray], step: np.ndarray, lengths: Sequence_[int]) -> list[list[int]]:
    """Best paths of a batch: ``parts`` are successive stretches of [row, token, tag], one
    after the other. A sequence can't begin inside."""
    tags, rows = len(step), len(lengths)
    first = np.where([t[0] == "I" for t in TAGS[:tags]], _START, 0.0) if tags == len(TAGS) else 0.0
    last = np.zeros(rows, np.int64)  # best tag of each row's last token
    ending: dict[int, list[int]] = {}
    for r, length in enumerate(lengths):
        ending.setdefault(length - 1, []).append(r)
    score, back, t = None, [], 0
    for emitted in parts:
        own = np.zeros((rows, emitted.shape[1], tags), np.int8)
        for i in range(emitted.shape[1]):
            if score is None:
                score = emitted[:, i] + first
            else:
                paths = score[:, :, None] + step[None]
                own[:, i] = paths.argmax(1)
                score = paths.max(1) + emitted[:, i]
            for r in ending.get(t, ()):
                last[r] = score[r].argmax()
            t += 1
        back.append(own)
    before = np.concatenate(back, 1)
    out = []
    for r, length in enumerate(lengths):
        path = [int(last[r])] if length else []
        for t in range(length - 1, 0, -1):
            path.append(int(before[r, t, path[-1]]))
        out.append(path[::-1])
    return out


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis, keepdims=True)
    return np.log(np.exp(values - top).sum(axis)) + top.squeeze(axis)


def train(examples: list[tuple[Sequence, list[int]]], rounds: int = 40, ridge: float = 1e-3, rate: float = 0.25) -> Field:
    """Weights of the largest penalised likelihood, by Adam over the whole labelled table.
    The gradient is observed minus expected counts, from forward and backward sums."""
    names: dict[str, int] = {}
    for sequence, _ in examples:
        for features in sequence.features():
            for f in features:
                names.setdefault(f, len(names))
    tags, count = len(TAGS), len(names)
    numbers, lengths = _padded([[[names[f] for f in fs] for fs in s.features()] for s, _ in examples])
    rows, size, _ = numbers.shape
    inside = np.arange(size)[None] < lengths[:, None]
    gold = np.zeros((rows, size), np.int64)
    for r, (_, own) in enumerate(examples):
        gold[r, :len(own)] = own
    used_token, slot = np.nonzero(numbers.reshape(rows * size, -1) >= 0)
    used_feature = numbers.reshape(rows * size, -1)[used_token, slot]
    truth = np.eye(tags)[gold] * inside[:, :, None]
    pairs = np.zeros((tags, tags))
    both = inside[:, 1:]
    np.add.at(pairs, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    allowed, starts = _allowed(), np.where([t[0] == "I" for t in TAGS], _START, 0.0)
    state, step = np.zeros((count + 1, tags)), np.zeros((tags, tags))
    moments = [np.zeros_like(state), np.zeros_like(state), np.zeros_like(step), np.zeros_like(step)]
    for turn in range(1, rounds + 1):
        emitted, moves = state[numbers].sum(2), step + allowed
        ahead = np.zeros((rows, size, tags))
        ahead[:, 0] = emitted[:, 0] + starts
        for t in range(1, size):
            moved = _log_sum(ahead[:, t - 1, :, None] + moves[None], 1) + emitted[:, t]
            ahead[:, t] = np.where(inside[:, t, None], moved, ahead[:, t - 1])
        total = _log_sum(ahead[:, -1], 1)
        behind = np.zeros((rows, size, tags))
        expected_pairs = np.zeros((tags, tags))
        for t in range(size - 2, -1, -1):
            after = moves[None] + (emitted[:, t + 1] + behind[:, t + 1])[:, None]
            on = inside[:, t + 1]
            behind[:, t] = np.where(on[:, None], _log_sum(after, 2), 0)
            expected_pairs += np.exp(ahead[:, t, :, None] + after - total[:, None, None])[on].sum(0)
        expected = np.exp(ahead + behind - total[:, None, None]) * inside[:, :, None]
        residual = truth - expected
        gradient = np.zeros_like(state)
        for tag in range(tags):
            share = residual[:, :, tag].reshape(-1)[used_token]
            gradient[:count, tag] = np.bincount(used_feature, share, count)
        for weights, change, first, second in ((state, gradient, *moments[:2]), (step, pairs - expected_pairs, *moments[2:])):
            change = change / max(1, rows) - ridge * weights
            first += 0.1 * (change - first)
            second += 0.01 * (change * change - second)
            weights += rate * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
        state[count] = 0
    return Field(names, state, step + allowed)


# --- the labelled table -----------------------------------------------------------------


def _spread(number: str, mark: str) -> str:
    """Digits in groups of four."""
    return mark.join(number[i:i + 4] for i in range(0, len(number), 4))


VARIANTS: dict[str, tuple[Callable[[str], str], ...]] = {
    "email": (lambda s: s.replace("@", " [at] "), lambda s: s.replace("@", "(at)").replace(".", "(dot)"),
              lambda s: s.replace("@", " [at] ").replace(".", " [dot] "), lambda s: s.replace("@", " (at) ")),
    "ip": (lambda s: s.replace(".", "[.]"), lambda s: s.replace(".", "(.)"), lambda s: "[.]".join(s.rsplit(".", 1))),
    "card": (lambda s: _spread(_digits(s), " "), lambda s: _spread(_digits(s), "-"), lambda s: _spread(_digits(s), "."), lambda s: _spread(_digits(s), "/")),
    "phone": (lambda s: s[1:], lambda s: s[s.find("("):] if "(" in s else s[1:], lambda s: re.sub(r"[() ]+", "-", s[1:]).strip("-"),
              lambda s: re.sub(r"[() -]+", ".", s[1:]).strip("."), lambda s: "00" + s[1:]),
}


def labelled(text: str, start: int, end: int, number: int) -> list[tuple[str, list[Span]]]:
    """A window as it is, with the pattern's spans, and rewritten in its kinds' other forms."""
    own = text[start:end]
    spans = base_spans(own)
    apart = [s for i, s in enumerate(spans) if all(s[2] <= o[1] or o[2] <= s[1] for o in spans[:i] + spans[i + 1:])]
    if len(apart) < len(spans):
        return []
    out = [(own, spans)]
    for turn in range(3 if spans else 0):
        pieces, places, at = [], [], 0
        length = 0
        for kind, s, e in spans:
            rewrite = VARIANTS[kind][(number + turn) % len(VARIANTS[kind])]
            pieces += [own[at:s], new := rewrite(own[s:e])]
            length += s - at
            places.append((kind, length, length + len(new)))
            length, at = length + len(new), e
        out.append(("".join([*pieces, own[at:]]), places))
    return out


def labelled_table(documents: DataFrame, limit: int = MAX_LABELLED, sample: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """(number, window): windows of about ``sample`` documents chosen by a hash of their
    identifier, at most ``limit``, half of them with a base span where there are enough."""
    count = documents.count()
    share = min(1.0, sample / max(1, count))
    chosen = documents.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * share)).select("doc_id", "text")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, positive = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for start, end in windows(text or ""):
                    if end - start <= LABELLED_CHARACTERS:
                        ids.append(doc_id)
                        texts.append(text[start:end])
                        positive.append(bool(base_spans(text[start:end])))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(positive, pa.bool_())],
                                             names=["doc_id", "window", "positive"])

    found = chosen.mapInArrow(cut, "doc_id long, window string, positive boolean").withColumn("rank", F.xxhash64("window", "doc_id"))
    halves = [found.filter(F.col("positive") == flag).orderBy("rank", "window").limit(limit // 2) for flag in (True, False)]
    return halves[0].unionByName(halves[1]).select(F.col("rank").alias("number"), "window")


def fit(documents: DataFrame, limit: int = MAX_LABELLED, sample: int = SAMPLE_DOCUMENTS) -> Field | None:
    """The field trained on the labelled table; None if the documents give no window."""
    rows = labelled_table(documents, limit, sample).collect()  # at most `limit` short windows
    examples = []
    for row in sorted(rows, key=lambda r: (r.number, r.window)):
        for text, spans in labelled(row.window, 0, len(row.window), row.number):
            sequence = sequence_of(text, 0, len(text))
            if len(sequence):
                examples.append((sequence, tags_of(sequence, spans)))
    return train(examples) if examples else None


# --- decoding whole texts ---------------------------------------------------------------

_AT_MARK = re.compile(r"\s*[\[({]\s*at\s*[\])}]\s*", re.IGNORECASE)
_DOT_MARK = re.compile(r"\s*[\[({]\s*(?:dot|\.)\s*[\])}]\s*", re.IGNORECASE)
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def keeps_rule(kind: str, found: str) -> bool:
    """Whether an added span is what its kind says, once its disguise is undone."""
    if kind == "email":
        return bool(_ADDRESS.fullmatch(_DOT_MARK.sub(".", _AT_MARK.sub("@", found))))
    if kind == "ip":
        plain = _DOT_MARK.sub(".", found)
        return bool(re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", plain)) and _small_parts(plain)
    number = _digits(found)
    if kind == "card":
        return bool(re.fullmatch(r"[0-9](?:[ ./-]?[0-9])+", found)) and 14 <= len(number) <= 19 and luhn(number)
    return bool(re.fullmatch(r"[+(]?[0-9](?:[ ().-]{0,2}[0-9])+", found)) and 10 <= len(number) <= 15 and not found.isdigit()


def tagged_spans(sequence: Sequence, tags: list[int]) -> list[Span]:
    out: list[list] = []
    for i, tag in enumerate(tags):
        if tag and TAGS[tag][0] == "B":
            out.append([TAGS[tag][2:], sequence.starts[i], sequence.ends[i]])
        elif tag and out:
            out[-1][2] = sequence.ends[i]
    return [tuple(s) for s in out]


def added_spans(texts: list[str], base: list[list[Span]], model: Field) -> list[list[Span]]:
    """Spans of the field in each text that touch no base span. Windows are decoded as they
    are found, so what is held is some ``BATCH_TOKENS`` of tokens, or one window."""
    out: list[list[Span]] = [[] for _ in texts]
    begins = [[s for _, s, _ in own] for own in base]
    reached = [list(itertools.accumulate((e for _, _, e in own), max)) for own in base]  # the furthest end so far

    def apart(n: int, start: int, end: int) -> bool:
        at = bisect.bisect_left(begins[n], end)
        return not at or reached[n][at - 1] <= start

    def decode(held: list[tuple[int, Sequence]]) -> None:
        for (n, sequence), tags in zip(held, model.decode([s for _, s in held]), strict=True):
            for kind, start, end in tagged_spans(sequence, tags):
                while kind == "email" and start > 0 and texts[n][start - 1] in _LOCAL:
                    start -= 1
                if keeps_rule(kind, texts[n][start:end]) and apart(n, start, end):
                    out[n].append((kind, start, end))

    held, size = [], 0
    for n, text in enumerate(texts):
        for start, end in windows(text):
            held.append((n, sequence_of(text, start, end)))
            size += len(held[-1][1])
            if size >= 4 * BATCH_TOKENS:
                decode(held)
                held, size = [], 0
    decode(held)
    return out


def _find_batches(batches: Iterable[pa.RecordBatch], model: Field | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        base = [base_spans(t) for t in texts]
        added = added_spans(texts, base, model) if model else [[] for _ in texts]
        every = [sorted(b + a, key=lambda s: (s[1], KINDS.index(s[0]))) for b, a in zip(base, added, strict=True)]
        counts = [pa.array([sum(s[0] == kind for s in own) for own in base], pa.int64()) for kind in KINDS]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *counts, pa.array([written(b) for b in base]), pa.array([written(e) for e in every])],
            names=["doc_id", *(f"n_{k}" for k in KINDS), "base_spans", "spans"])


def find_pii(documents: DataFrame, model: Field | None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans of each kind), base_spans and
    spans (all), as ``kind:start:end`` joined by commas; code points, end exclusive."""
    pairs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # a few thousand weights
    return pairs.mapInArrow(lambda batches: _find_batches(batches, shared.value),
                            "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string")


def base_digest(df: DataFrame) -> DataFrame:
    return df.withColumn("base_sha256", F.sha2("base_spans", 256)).drop("base_spans")
