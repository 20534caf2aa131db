"""Groups against brute force."""

import hashlib

import pytest

from kerbside.llm import exact_dedup


def brute(rows, keep):
    low = [bytes(t or "", "utf-8").lower() for _, t in rows]
    out = []
    for (i, _), t in zip(rows, low, strict=True):
        own = [j for (j, _), u in zip(rows, low, strict=True) if u == t]
        ids = [j for j in own if j is not None]
        best = (min if keep == "smallest" else max)(ids) if ids else None
        out.append((i, best, len(own), i == best, hashlib.sha256(t).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize(("partitions", "fanout"), [(1, 2), (5, 2), (9, 3)])
def test_groups(spark, keep, partitions, fanout):
    texts = ["A b", "a B", "É", "é", "", None, "x" * 100_000, "X" * 100_000, "a  b", "same", "Same"]
    rows = [(i, texts[(i * i) % len(texts)]) for i in range(60)] + [(100 + i, "hot") for i in range(40)] + [(7, "same"), (7, "same")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, n long").repartition(6)
    got = exact_dedup.exact_dedup(docs, keep=keep, fanout=fanout, partitions=partitions)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, keep)


def test_empty_and_null_identifiers(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "A"), (3, "a"), (None, "b")], "doc_id long, text string")
    got = exact_dedup.exact_dedup(docs, partitions=4)
    assert sorted((r.keep_id, r.group_size, r.kept) for r in got.filter("keep_id is not null").collect()) == [(3, 3, False), (3, 3, False), (3, 3, True)]
    assert [(r.group_size, r.kept) for r in got.filter("keep_id is null").collect()] == [(1, True)]
    assert exact_dedup.exact_dedup(docs.filter("false")).collect() == []
    with pytest.raises(ValueError):
        exact_dedup.exact_dedup(docs, keep="first")


def test_colliding_short_digests_stay_apart(spark):
    entries = spark.createDataFrame([(p, 5, bytes([k]), 3, 10 * p + k, 1) for p in range(4) for k in range(2)],
                                    "part int, digest long, sha binary, n_bytes long, best long, n long")
    got = exact_dedup.merge_runs(entries, 4, 2)
    assert sorted((bytes(r.sha), r.best, r.n) for r in got.collect()) == [(b"\0", 0, 4), (b"\1", 1, 4)]
