"""Patterns against plain regular expressions; the field against enumeration and planted cases."""

import hashlib
import os
import random
import subprocess
import sys
from pathlib import Path
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbside.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(PLAIN).index(s[0])))


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from([*"ab@@@..-+ ()019", "é", "4111111111111111", "1.2.3.4", "255", "256", "x@y.zz", "+1 (017) 555-7713", "\n"]), max_size=30).map("".join))
def test_base_spans_equal_plain_matching(text):
    assert pii.base_spans(text) == plain_spans(text)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(0, 10**6))
def test_viterbi_equals_enumeration(size, seed):
    rng = np.random.default_rng(seed)
    emitted, step = rng.normal(size=(2, size, 3)), rng.normal(size=(3, 3))
    for row, path in zip(emitted, pii.viterbi(np.split(emitted, [size // 2], 1), step, [size, max(1, size - 1)]), strict=True):
        n = len(path)
        score = lambda p: sum(row[t, p[t]] for t in range(n)) + sum(step[a, b] for a, b in itertools.pairwise(p))
        assert score(path) == pytest.approx(max(score(p) for p in itertools.product(range(3), repeat=n)))


CONTEXT = "the thand erly {} onthe reand tion"
BASE = ["thad.{n}@mail{n}.example.com", "203.0.113.{n}", "4111111111111111", "+1 (017) 555-77{n}"]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, CONTEXT.format(BASE[i % 4].format(n=10 + i % 80))) for i in range(120)]
    rows += [(200 + i, f"thand version {i}.{i % 7}. erly the {i * 977} onthe token = \"{hashlib.md5(bytes([i])).hexdigest()}\"") for i in range(40)]
    rows += [(300, None), (301, ""), (302, "x" * 50_000 + " call (017) 555-7713 soon " + "y. " * 20_000), (303, "no data here"), (303, "no data here")]
    return spark.createDataFrame([(*r, "spans") for r in rows], "doc_id long, text string, spans string").repartition(3)


@pytest.fixture(scope="module")
def model(documents):
    return pii.fit(documents)


def test_other_forms_are_added_and_clean_text_is_left_alone(model):
    hits = {"call (017) 555-7713 now": ("phone", "(017) 555-7713"), "the 4111.1111.1111.1111 erly": ("card", "4111.1111.1111.1111"),
            "erly thad.34 [at] mail7.example.com onthe": ("email", "thad.34 [at] mail7.example.com")}
    for text, (kind, value) in hits.items():
        (found,) = pii.added_spans([text], [pii.base_spans(text)], model)
        assert [(k, text[s:e]) for k, s, e in found] == [(kind, value)]
    clean = ["version 3.0. of 2024", "the 1234567890123456 erly", "at the thand. at 5", "token = \"ab12cd34ef567890ab12cd34ef567890\""]
    assert pii.added_spans(clean, [pii.base_spans(t) for t in clean], model) == [[], [], [], []]


def test_query_rows(spark, documents, model):
    got = pii.base_digest(pii.find_pii(documents, model)).collect()
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in documents.select("doc_id").collect())
    for r in got:
        base = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(b[0] == k for b in base) for k in PLAIN)
        assert {f"{k}:{s}:{e}" for k, s, e in base} <= set(r.spans.split(",")) | {""}
    assert "phone:" in next(r.spans for r in got if r.doc_id == 302)
    empty = documents.filter("false")
    assert pii.fit(empty) is None and pii.find_pii(empty, None).collect() == []


def test_stretches_give_what_one_batch_gives(model):
    rng = random.Random(7)
    texts = [",".join(rng.choice(["12", "017-555-7713", "4111.1111.1111.1111", "a", "10[.]0[.]0[.]1", "x@y"]) for _ in range(n)) for n in (1, 3, 40, 400)]
    sequences = [pii.sequence_of(t, s, e) for t in texts for s, e in pii.windows(t)]
    whole = model.decode(sequences, 1 << 20)
    assert whole == model.decode(sequences, 7) and any(any(tags) for tags in whole)


def test_windows_end_at_white_space_however_far():
    text = "a " + "x" * 1000 + "5" + "y" * 1000 + " b " + "z" * 300 + " 7"
    assert [text[s:e] for s, e in pii.windows(text)] == ["x" * 1000 + "5" + "y" * 1000 + " b " + "z" * 300 + " 7"] or len(pii.windows(text)) == 2
    assert all(e == len(text) or text[e].isspace() for _, e in pii.windows(text))


_LIMITED = """
import resource, sys
sys.path[:0] = [{root!r}]
resource.setrlimit(resource.RLIMIT_AS, (1 << 30, 1 << 30))
{body}
print("done")
"""


def limited(body):
    """Run a program within 1 GB of address space."""
    root = str(Path(pii.__file__).parents[2])
    env = {**os.environ, "OPENBLAS_NUM_THREADS": "1", "OMP_NUM_THREADS": "1"}
    run = subprocess.run([sys.executable, "-c", _LIMITED.format(root=root, body=body)], capture_output=True, text=True, env=env, timeout=600)
    assert run.stdout.strip() == "done", run.stderr[-2000:]


def test_a_numeric_text_of_two_megabytes_needs_less_than_a_gigabyte():
    limited("""
import random
from kerbside.llm import pii
rng = random.Random(1)
field = pii.train([(q := pii.sequence_of("call 017-555-7713 now", 0, 21), pii.tags_of(q, [("phone", 5, 17)]))], rounds=3)
table = ",".join(str(rng.randrange(10**6)) for _ in range(300_000))
texts = [table, *["call 017-555-7713 now"] * 200]
found = pii.added_spans(texts, [pii.base_spans(t) for t in texts], field)
assert len(found) == 201
""")
