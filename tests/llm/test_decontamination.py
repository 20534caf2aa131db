"""Matches against every window of every document."""

import random
from collections import Counter

import numpy as np
import pytest

from test_pii import limited

from kerbside.llm import decontamination as dc

RNG = random.Random(11)
WORDS = [f"w{i}" for i in range(500)]
ITEMS = [(i, " ".join(RNG.choices(WORDS, k=k))) for i, k in enumerate([40, 40, 25, 60, 12, 5, 3, 8])]
ITEMS += [(20, ITEMS[0][1].upper()), (21, None), (22, " \n"), (None, ITEMS[4][1])]


def text_with(item, edits, before=30, after=30):
    words = item.split()
    for at in RNG.sample(range(len(words)), edits):
        words[at] = RNG.choice(WORDS)
    return " ".join([*RNG.choices(WORDS, k=before), *words, *RNG.choices(WORDS, k=after)])


def corpus():
    rows = [(i, " ".join(RNG.choices(WORDS, k=200))) for i in range(20)]
    for i, (item, edits) in enumerate([(0, 0), (1, 1), (3, 1), (3, 2), (2, 0), (2, 1), (4, 0), (4, 1), (5, 0), (7, 0), (0, 6)]):
        rows.append((100 + i, text_with(ITEMS[item][1], edits)))
    rows += [(200, ITEMS[3][1][:-5]), (201, ITEMS[0][1].replace(" ", "\n\t")), (202, ITEMS[6][1]), (203, None), (204, ""), (205, "w1 w2"),
             (206, " ".join(RNG.choices(WORDS, k=30_000)) + " " + ITEMS[1][1]), (None, ITEMS[0][1]), (100, rows[20][1])]
    rows.append((207, " ".join([" ".join(ITEMS[2][1].split()[:6])] * 50)))
    return rows


def fingerprint(hashes):
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, items):
    hashed, out = dc.WordHashes(), []
    for doc_id, text in rows:
        own = dc.shingles(hashed(text or ""), dc.SHINGLE).tolist()
        for item_id, item in items:
            want = dc.shingles(hashed(item or ""), dc.SHINGLE).tolist()
            if not want or not own:
                continue
            width, best = min(len(want), len(own)), None
            for start in range(len(own) - width + 1):
                window = own[start:start + width]
                if not set(window) & set(want):
                    continue
                if (fingerprint(window) ^ fingerprint(want)).bit_count() > dc.RADIUS:
                    continue
                a, b = Counter(window), Counter(want)
                similar = sum((a & b).values()) / sum((a | b).values())
                if similar >= dc.SIMILARITY and (best is None or similar > best[0]):
                    best = (similar, start, width)
            if best:
                out.append((doc_id, item_id, best[1], best[2], pytest.approx(best[0])))
    return out


def test_matches_equal_all_windows(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, item_id int").repartition(3)
    bench = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, doc_id string")
    want = brute(rows, ITEMS)
    got = list(map(tuple, dc.contaminated(docs, bench).collect()))
    key = lambda r: repr(r[:4])
    assert sorted(got, key=key) == sorted(want, key=key)
    named = {r[0] for r in got}
    assert {100, 102, 104, 106, 108, 109, 200, 201, 202, 206, None} <= named and not named & {*range(20), 110, 203, 204, 205}
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 2)
    assert sorted(map(tuple, dc.contaminated(docs, bench).collect()), key=key) == sorted(want, key=key)
    kept = dc.without_contaminated(docs, bench)
    bad = {r[1] for r in rows for d in [r[0]] if d in named and (d is not None or dc.contaminated(docs.filter(docs.doc_id.isNull() & (docs.text == r[1])), bench).count())}
    assert kept.columns == docs.columns and sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(r[0]) for r in rows if r[1] not in bad)


def test_rows_are_decided_by_their_text(spark):
    item = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, item, 1), (1, "clean text", 2), (None, "a " + item, 3), (None, "clean", 4), (2, None, 5), (2, "", 6)], "doc_id long, text string, key int")
    kept = dc.without_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(r.key for r in kept.collect()) == [2, 4, 5, 6]


def test_stretches_of_starts_change_nothing(monkeypatch):
    rng = np.random.default_rng(2)
    words = dc.WordHashes()
    passage = [f"p{i}" for i in range(30)]
    text = " ".join(" ".join(map(str, rng.integers(0, 50, 400))) + " " + " ".join(passage) for _ in range(6))
    items = dc.Items([[1]], [dc.shingles(words(" ".join(passage)), 5)], dc.RADIUS)
    whole = dc.matches(items, words(text), 5, 0.8)
    monkeypatch.setattr(dc, "STARTS", 3)
    monkeypatch.setattr(dc, "SPAN", 7)
    assert whole and dc.matches(items, words(text), 5, 0.8) == whole


def test_a_text_of_fifty_megabytes_needs_little_more_than_its_words():
    limited("""
import numpy as np
from kerbside.llm import decontamination as dc
words = dc.WordHashes()
passage = " ".join(f"passage{i}" for i in range(60))
filler = " ".join(f"filler{i % 5000}" for i in range(62_000))
text = (filler + " " + passage + " ") * 75
items = dc.Items([[1]], [dc.shingles(words(passage), 5)], dc.RADIUS)
hashes = words(text)
assert len(text) > 50_000_000 and dc.matches(items, hashes, 5, 0.8)[0][3] == 1.0
""")


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), spark.createDataFrame([(1, None)], "item_id long, text string")
    assert dc.contaminated(docs, bench).collect() == []
    assert dc.contaminated(docs.filter("false"), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).collect() == []


def test_the_multi_index_finds_everything_within_the_radius():
    rng = np.random.default_rng(0)
    fps = rng.integers(0, 2**63, 300, dtype=np.uint64)
    probes = fps[:200].copy()
    for i in range(200):
        for bit in rng.choice(63, i % 24, replace=False):
            probes[i] ^= np.uint64(1 << int(bit))
    index = dc.MultiIndex(fps, np.arange(300), dc.RADIUS)
    want = sorted((i, j) for i in range(200) for j in range(300) if int(probes[i] ^ fps[j]).bit_count() <= dc.RADIUS)
    assert index.search(probes) == want
