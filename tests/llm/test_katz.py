"""Scores against the model written out over dictionaries, and its sums."""

import math
import random
import re
import zlib
from collections import Counter

import pytest

from kerbside.llm import katz

END = None


def tokens_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), END]


class Plain:
    def __init__(self, texts):
        self.words, self.pairs = Counter(), Counter()
        for t in texts:
            own = tokens_of(t)
            self.words.update(own)
            self.pairs.update(zip([END, *own], own))
        self.n = sum(self.words.values())
        discount = lambda counts: katz.discounts([sum(c == r for c in counts.values()) for r in range(1, katz.LARGEST + 2)], self.n)
        self.dw, self.dp = discount(self.words), discount(self.pairs)
        self.unknown = 1 - sum(self.starred(c, self.dw) for c in self.words.values()) / self.n

    @staticmethod
    def starred(c, d):
        return c * d[min(c, katz.LARGEST + 1)]

    def word(self, w):
        return self.starred(self.words[w], self.dw) / self.n if w in self.words else self.unknown

    def alpha(self, h):
        own = [(w, c) for (g, w), c in self.pairs.items() if g == h]
        return (1 - sum(self.starred(c, self.dp) for _, c in own) / self.words[h]) / (1 - sum(self.word(w) for w, _ in own))

    def prob(self, w, h):
        if (h, w) in self.pairs:
            return self.starred(self.pairs[h, w], self.dp) / self.words[h]
        return self.alpha(h) * self.word(w) if h in self.words else self.word(w)

    def score(self, text):
        own = tokens_of(text)
        return sum(math.log10(self.prob(w, h)) for h, w in zip([END, *own], own))

    def base(self, text):
        return sum(math.log10((self.words[w] + 1) / (self.n + len(self.words) + 1)) for w in tokens_of(text))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = [f"w{int(rng.paretovariate(0.8))}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "É W1\x1cx  w1\tw2 "), (203, "w1 " * 3000), (5, rows[5][1]), (None, "w1 w2 new")]
    return rows


def in_fold(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


def test_every_context_sums_to_one(rows):
    model = Plain([t for i, t in rows if not in_fold(i)])
    for h in [*list(model.words)[:25], END, "never seen"]:
        assert sum(model.prob(w, h) for w in [*model.words, "unknown word"]) == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize(("chunk", "bucket"), [(1 << 20, 1 << 20), (300, 64)])
def test_scores_equal_the_plain_model(spark, rows, chunk, bucket):
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, chunk int").repartition(3)
    got = katz.score_documents(docs, ~katz.held_out(docs.doc_id), chunk_tokens=chunk, bucket_items=bucket).collect()
    model = Plain([t for i, t in rows if not in_fold(i)])
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append((not in_fold(i), len(tokens_of(t)), sum(w in model.words for w in tokens_of(t)), model.n,
                                       pytest.approx(model.base(t), abs=1e-6), pytest.approx(model.score(t), abs=1e-6)))
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == want[r.doc_id][0]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = katz.score_documents(docs, katz.F.lit(False)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got) == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]
    assert all(r.score == 0 for r in got)
    assert katz.score_documents(docs.filter("false"), katz.F.lit(True)).collect() == []
