"""Fingerprints, keys and components against brute force."""

import re

import numpy as np
import pytest
from xxhash import xxh64

from kerbside.llm import graph, simhash_golay as sg


def brute_fp(text, size=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hs = [xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps):
    left, out = set(range(len(ids))), {}
    while left:
        todo, group = [left.pop()], []
        while todo:
            i = todo.pop()
            group.append(i)
            near = {j for j in left if (fps[i] ^ fps[j]).bit_count() <= 3}
            left -= near
            todo += near
        for i in group:
            out[i] = min(ids[j] for j in group)
    return [out[i] for i in range(len(ids))]


def test_every_pair_within_three_bits_shares_a_key():
    rng = np.random.default_rng(3)
    code = sg.GolayKeys()
    a = rng.integers(0, 2**63, 4000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 4000, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, i % 4, replace=False):
            b[i] ^= np.uint64(1 << int(bit))
    place, key = code.keys(a, False)
    other, several = code.keys(b, True)
    one, many = set(zip(place.tolist(), key.tolist(), strict=True)), set(zip(other.tolist(), several.tolist(), strict=True))
    assert {p for p, _ in one & many} == set(range(len(a)))
    assert len(one) == 7 * len(a)


def test_each_word_is_within_three_bits_of_one_codeword():
    errors, count = sg._error_patterns()
    assert (np.bitwise_count(errors[:, 0]) <= 3).all() and set(count.tolist()) == {1, 6}


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(-40, 40, (30, 2))] + [(100 + i, 101 + i) for i in range(40)] + [(500, 500 + i) for i in range(60)]
    got = {r.id: r.component for r in graph.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {n: n for p in pairs for n in p if p[0] != p[1]}
    for _ in range(200):
        for a, b in pairs:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want
    assert graph.connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


def test_keys_are_never_broadcast(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(int(fp),) for fp in rng.integers(-2**63, 2**63, 50)]
    spark.createDataFrame(rows + [(rows[0][0] ^ 5,)], "fp long").write.parquet(f"{tmp_path}/fp")
    found = sg.links(spark.read.parquet(f"{tmp_path}/fp"))  # far below any limit of the planner
    assert [{r.a, r.b} for r in found.collect()] == [{rows[0][0], rows[0][0] ^ 5}]
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_rows(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(words, 120)) for _ in range(12)]
    rows = [(None, "", 1), (901, None, 1), (902, " \n ", 1), (903, "one two", 1), (904, "ONE  two", 1), (905, "É Word x\x1cy z", 1), (906, "a b c " * 30_000, 1)]
    for i in range(150):
        own = base[i % 12].split()
        for at in rng.choice(120, i % 5, replace=False):
            own[at] = f"new{i}"
        rows.append((10 + (i * 37) % 150, "  ".join(own), 1))
    rows += [(950 + i, base[0].upper(), 1) for i in range(40)] + [(903, "one two", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int").repartition(4)
    got = sg.near_duplicates(docs, 3).collect()
    ids, texts = [r[0] for r in rows], [r[1] for r in rows]
    fps = [brute_fp(t) for t in texts]
    want = brute_components([i if i is not None else 10**9 for i in ids], fps)
    assert sorted((tuple(r) for r in got), key=repr) == sorted(((i, f"{f:016x}", c) for i, f, c in zip(ids, fps, want, strict=True)), key=repr)
    assert len(set(want)) < len(want) - 60
    assert sg.near_duplicates(docs.filter("false"), 3).collect() == []
    with pytest.raises(ValueError):
        sg.links(docs, 4)
