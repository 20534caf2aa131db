import hashlib
import zlib

import duckdb
import pytest
from conftest import rows
from pyspark.sql import functions as F

from kerbside.llm import merkle
from kerbside.llm.catalog import ORACLE, QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def canonical(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(row, arity):
    levels = [row]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([sha("".join(row[i:i + arity])) for i in range(0, len(row), arity)])
    return levels


def path_of(levels, at, arity):
    path = []
    for row in levels[:-1]:
        start = at - at % arity
        path.append(("".join(row[start:at]), "".join(row[at + 1:start + arity])))
        at //= arity
    return path


def brute(records, arity):
    """(doc_id, leaf, path, subroot, root) of (tree, doc_id, digest), by whole levels in memory."""
    trees = {}
    for tree, doc_id, digest in sorted(records, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2])):
        trees.setdefault(tree, []).append((doc_id, digest))
    low = {t: levels_of([d for _, d in leaves], arity) for t, leaves in trees.items()}
    names = sorted(low, key=str.encode)
    high = levels_of([low[t][-1][0] for t in names], arity)
    return [(doc_id, digest, path_of(low[t], i, arity) + path_of(high, names.index(t), arity), low[t][-1][0], high[-1][0])
            for t, leaves in trees.items() for i, (doc_id, digest) in enumerate(leaves)]


def found(spark, records, **shape):
    leaves = spark.createDataFrame(records, "tree string, doc_id long, digest string")
    out, trees, whole = merkle.manifest(leaves, ["doc_id"], **shape)
    got = [(r.doc_id, r.digest, [(s.left, s.right) for s in r.path], r.subroot, r.root) for r in out.collect()]
    return got, trees, whole


@pytest.mark.parametrize(("arity", "band"), [(2, 2), (3, 1), (2, 10)])
def test_every_path_equals_brute_force(spark, arity, band):
    sizes = {"": 1, "=": 2, "=a": 9, "=b": 37, "=ä": 4, "=z": 5, "=zz": 8}
    records = [(t, i, sha(f"{t}{i}")) for t, n in sizes.items() for i in range(n)]
    records += [("=b", None, sha("no id")), ("=b", 3, sha("=b3")), ("=b", 3, sha("other"))]  # no identifier, a repeated row, a tie
    got, trees, whole = found(spark, records, arity=arity, band=band)
    assert sorted(got, key=repr) == sorted(brute(records, arity), key=repr)
    stored = trees.records().unionByName(whole.records()).collect()
    assert all(r.digest == sha("".join(r.children)) for r in stored)  # content-addressed


def test_one_leaf_and_no_leaf(spark):
    got, _, _ = found(spark, [("=a", 1, sha("x"))])
    assert got == [(1, sha("x"), [], sha("x"), sha("x"))]
    assert found(spark, [])[0] == []


def test_proofs_verify_and_tampering_shows(spark):
    records = [(f"={i % 3}", i, sha(str(i))) for i in range(50)]
    out, _, _ = merkle.manifest(spark.createDataFrame(records, "tree string, doc_id long, digest string"), ["doc_id"], band=3)
    assert out.filter(merkle.folded("digest") != F.col("root")).count() == 0
    assert out.withColumn("digest", F.sha2(F.col("digest"), 256)).filter(merkle.folded("digest") == F.col("root")).count() == 0


def test_names_of_the_operator_are_refused(spark):
    with pytest.raises(ValueError, match="rank"):
        merkle.manifest(spark.createDataFrame([("=a", 1, "x", 1)], "tree string, doc_id long, digest string, rank int"), ["doc_id"])


def test_leaves_of_a_table_with_clashing_names(spark):
    table = spark.createDataFrame([(1, "é", None, 9, "t", 0.5), (None, None, "", 0, None, 0.5)], "page long, tree string, rank string, n long, digest string, path double")
    out = merkle.documents_leaves(table, ["page", "tree", "rank", "n", "digest"], "rank", "page")
    assert rows(out) == sorted([("", 1, sha("1:1" + "2:é" + "-" + "1:9" + "1:t")), ("=", None, sha("--0:1:0-"))], key=repr)


def test_query_equals_sql_with_nulls_ties_and_long_texts(spark, tmp_path):
    texts = [None, "", "x" * 3_000_000, "ä\n", "same", "same"]
    table = [(i if i % 13 else None, texts[i % 6], [None, "en", "de", "", "fr"][i % 5], ["s", None][i % 2], None if i % 11 == 0 else i) for i in range(60)]
    table += [table[4], (4, "tie", "fr", None, 1)]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op12_merkle"](spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    result = duck.execute(ORACLE["op12_merkle"])
    assert [c[0] for c in result.description] == out.columns
    want = sorted(result.fetchall(), key=repr)
    assert rows(out) == want
    assert {r[-1] for r in want} == {True, False}


def test_crc_of_the_statement(spark):
    tampered = {i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 0}
    assert tampered == {r.id for r in spark.range(200).filter(F.crc32(F.col("id").cast("string")) % 7 == 0).collect()}
