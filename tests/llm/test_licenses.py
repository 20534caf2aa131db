"""Statements and inheritance against a scan of every line and directory."""

import math
import random
import re

import pytest

from kerbside.llm import licenses as lic


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower())]


def brute(rows):
    counts = lic.template_counts(lic.TEMPLATES)
    vocabulary = {w for own in counts.values() for w in own}
    having = {w: sum(w in set(words(t)) for _, _, t in rows if t is not None) for w in vocabulary}
    idf, vectors = lic.weights(lic.TEMPLATES, len(rows), having)
    stated = {}
    for f, _, t in rows:
        best = None
        for line in (t or "").split("\n"):
            own = [w for w in words(line) if w in vocabulary]
            length = math.sqrt(sum((own.count(w) * idf[w]) ** 2 for w in set(own)))
            for name, vector in vectors.items():
                dot = sum(own.count(w) * idf[w] * vector.get(w, 0) for w in set(own))
                if own and dot / length >= lic.THRESHOLD and (best is None or (-dot / length, name) < best):
                    best = (round(-dot / length, 9), name)
        if best:
            stated[f] = best
    of_dir = {}
    for f, p, _ in rows:
        if p is not None and f in stated and re.sub(r"\.(txt|md)$", "", p.split("/")[-1]) in lic.LICENCE_FILES:
            d = p.rpartition("/")[0]
            of_dir[d] = min(of_dir.get(d, ((9, "z"), "z")), (stated[f], p))
    out = []
    for f, p, _ in rows:
        if f in stated:
            out.append((f, p, stated[f][1], "header", pytest.approx(-stated[f][0]), None))
            continue
        d = p.rpartition("/")[0] if p is not None else None
        while d and d not in of_dir:
            d = d.rpartition("/")[0]
        if d is not None and d in of_dir:
            out.append((f, p, of_dir[d][0][1], "inherited", pytest.approx(-of_dir[d][0][0]), d))
        else:
            out.append((f, p, None, None, None, None))
    return out


def corpus():
    rng = random.Random(9)
    prose = lambda: " ".join(rng.choices(["the", "mit", "under", "version", "of", "public", "code", "lorem", "ipsum", "dolor"], k=40))
    texts = list(lic.TEMPLATES.values())
    rows = []
    for i in range(120):
        dirs = "/".join(rng.choices(["a", "b", "c"], k=rng.randint(0, 4)))
        name = rng.choice(["LICENSE", "COPYING.md", "f.txt", "g.py", "h"])
        body = [prose() for _ in range(3)]
        if rng.random() < (0.8 if name[0] in "LC" else 0.1):
            body.insert(rng.randint(0, 3), f"# {rng.choice(texts)}.".replace(" ", "  ") + rng.choice(["", " foo bar"]))
        rows.append((i, f"{dirs}/{name}".lstrip("/"), "\n".join(body)))
    return [*rows, (500, "a/b/x", None), (501, None, texts[0]), (502, None, "none"), (503, "a/b/c/y", ""), (504, "/abs/z", "x" * 50_000),
            (505, "a", "word"), (506, "a/LICENSE", texts[6] + " " + prose() * 200)]


def test_scan_equals_brute_force(spark):
    rows = corpus()
    files = spark.createDataFrame([(*r, "x") for r in rows], "file long, path string, text string, licence string").repartition(3)
    key = lambda r: r[0]
    got = sorted(map(tuple, lic.scan(files).collect()), key=key)
    assert got == sorted(brute(rows), key=key)
    assert {r[3] for r in got} == {"header", "inherited", None} and len({r[2] for r in got}) > 4
    assert lic.scan(files.filter("false")).collect() == []
    assert {r.origin for r in lic.scan(files, templates={}).collect()} == {None}


def test_a_line_that_matches_has_an_anchor():
    idf, vectors = lic.weights(lic.TEMPLATES, 1000, {"the": 900, "under": 500, "of": 900, "mit": 300})
    needed = set(lic.anchors(vectors, lic.THRESHOLD))
    for own in vectors.values():
        assert math.sqrt(sum(x * x for w, x in own.items() if w not in needed)) < lic.THRESHOLD
    assert "the" not in needed


def test_document_path(spark):
    df = spark.createDataFrame([(123457, "src1"), (40, None)], "doc_id long, source string")
    assert [r.p for r in df.select(lic.document_path(df.doc_id, df.source).alias("p")).collect()] == ["src1/d12/d123/d1234/f123457.txt", "none/d0/d0/d0/LICENSE"]
