"""Maximal conversations and renderings against brute force and DuckDB."""

import random

import duckdb
import pytest

from kerbside.llm import chat


def brute(rows, block):
    by = {}
    for c, t, r, x in set(rows):
        by.setdefault(c, []).append(((t is not None, t or 0, r or "", x or ""), (r or "", x or "")))
    whole = {c: tuple(p for _, p in sorted(set(own))) for c, own in by.items()}
    out = []
    for c, own in whole.items():
        same = [d for d, o in whole.items() if o == own]
        if c != min(same, key=lambda d: (d is None, d or 0)) or any(len(o) > len(own) and o[:len(own)] == own for o in whole.values()):
            continue
        for part in range(-(-len(own) // block)):
            text = "".join(f"<|{r}|>\n{x}<|end|>\n" for r, x in own[part * block:(part + 1) * block])
            out.append((c, part, len(own), len(same), text))
    return sorted(out, key=repr)


def logs():
    rng, rows = random.Random(6), []
    base = [[("user" if i % 2 == 0 else "assistant", f"text {b} {i} {rng.random()}") for i in range(12)] for b in range(6)]
    for c in range(80):
        own, size = base[c % 6], rng.randint(1, 12)
        rows += [(c, 3 * i + 7, r, x) for i, (r, x) in enumerate(own[:size])]
        if c % 9 == 0:
            rows.append((c, 100, "user", f"other end {c}"))
    rows += [(200, i, "user", f"long {i}") for i in range(900)] + [(201, i, "user", f"long {i}") for i in range(400)]
    rows += [(300, None, None, None), (301, None, "", ""), (302, 5, "user", "x"), (302, 5, "user", "x"), (302, 5, "user", "w"), (None, 1, "user", "no id")]
    rows += [(400, 1, "user", "y" * 100_000)]
    return rows


@pytest.mark.parametrize("block", [256, 4])
def test_rendered(spark, block):
    rows = logs()
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, position int").repartition(4)
    assert sorted(map(tuple, chat.rendered(df, block).collect()), key=repr) == brute(rows, block)


def test_oracle_and_empty(spark):
    rows = [r for r in logs() if r[0] is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(con.execute(chat.ORACLE).fetchall(), key=repr) == brute(rows, 256)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.rendered(empty).collect() == []
