"""Exact dedup as a tree merge of sorted digest runs.

Each partition reduces its rows to a run: one entry per distinct text (digest, best
identifier, count), sorted by digest. The partitions then exchange runs in binomial rounds.
In round ``r`` the partitions that agree in all but digit ``r`` of their number (base
``FANOUT``) form a group; each sends every other member the part of its run whose digest
has that member's digit, and merges the parts it receives. Equal digests meet at the latest
in the last round, when every partition owns one slice of the digest space. A text that
fills a third of the table is one entry per run from the start, so no round grows with the
size of a group, and after each round there is at most one entry per text and partition.

An entry's key is a 64-bit digest, the order of the runs; entries are merged only if their
SHA-256 and length agree as well, at every level. Texts whose short digests collide stay
apart.

A null text counts as empty. Rows without an identifier count in their group but are not
chosen while another row has one. Rows that repeat an identifier are counted each and get
equal results, so a document's repeated row is kept with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.sources.workspace import stored

FANOUT = 8

_DIGESTS = "doc_id long, digest long, sha binary, n_bytes long"
_RUN = "part int, digest long, sha binary, n_bytes long, best long, n long"


def _digest_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shas, sizes = [], []
        for text in batch.column("text"):
            data = text.as_buffer().to_pybytes().lower() if text.is_valid else b""
            shas.append(hashlib.sha256(data).digest())
            sizes.append(len(data))
        digests = [int.from_bytes(s[:8], "big", signed=True) for s in shas]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(digests, pa.int64()), pa.array(shas, pa.binary()), pa.array(sizes, pa.int64())],
            names=["doc_id", "digest", "sha", "n_bytes"])


def digests(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, digest, sha, n_bytes) of every text after lower-casing A-Z. ``bytes.lower``
    changes just these letters. One row per row, duplicates included."""
    pairs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return pairs.mapInArrow(_digest_batches, _DIGESTS)


def _merge_sorted(batches: Iterable[pa.RecordBatch], largest: bool) -> Iterator[pa.RecordBatch]:
    """Merge neighbours with one key of rows sorted by (part, digest, sha, n_bytes). Only the
    entry being merged is held between batches."""
    held: list | None = None
    better = max if largest else min
    for batch in batches:
        out: list[list] = []
        for part, digest, sha, size, best, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held is not None and held[1] == digest and held[0] == part and held[2] == sha and held[3] == size:
                held[4] = best if held[4] is None else held[4] if best is None else better(held[4], best)
                held[5] += n
                continue
            if held is not None:
                out.append(held)
            held = [part, digest, sha, size, best, n]
        yield _run_batch(out)
    if held is not None:
        yield _run_batch([held])


def _run_batch(entries: list[list]) -> pa.RecordBatch:
    columns = list(zip(*entries, strict=True)) or [[]] * 6
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      names=["part", "digest", "sha", "n_bytes", "best", "n"])


def _digit(number: Column, place: int, fanout: int) -> Column:
    return F.floor(number / fanout**place).cast("int") % fanout


def merge_runs(entries: DataFrame, partitions: int, fanout: int = FANOUT, keep: str = "smallest") -> DataFrame:
    """Runs (part, digest, sha, n_bytes, best, n) to one entry per text.

    ``partitions`` is rounded up to a power of ``fanout``, so that each round replaces one
    digit; a slice of the digest space is chosen by the digest's digits in the same places.
    """
    rounds = 1
    while fanout**rounds < partitions:
        rounds += 1
    size = fanout**rounds
    slice_of = F.pmod(F.shiftright("digest", 8), F.lit(size))  # not the bits that order Parquet or hash joins
    runs = entries
    for place in range(rounds):
        own, goal = _digit(F.col("part"), place, fanout), _digit(slice_of, place, fanout)
        moved = runs.withColumn("part", (F.col("part") + (goal - own) * fanout**place).cast("int"))
        runs = _merged(moved.repartition(min(size, partitions), "part"), keep)
    return runs


def _merged(entries: DataFrame, keep: str) -> DataFrame:
    """Every partition's entries sorted and merged where they are."""
    largest = keep == "largest"
    return (entries.sortWithinPartitions("part", "digest", "sha", "n_bytes")
            .mapInArrow(lambda batches: _merge_sorted(batches, largest), _RUN))


def exact_groups(found: DataFrame, partitions: int, fanout: int = FANOUT, keep: str = "smallest") -> DataFrame:
    """(sha, n_bytes, keep_id, group_size): one row per distinct text of ``digests``."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    size = fanout
    while size < partitions:
        size *= fanout
    first = found.select(F.pmod(F.spark_partition_id(), F.lit(size)).alias("part"), "digest", "sha", "n_bytes",
                         F.col("doc_id").alias("best"), F.lit(1).cast("long").alias("n"))
    return (merge_runs(_merged(first, keep), partitions, fanout, keep)
            .select("sha", "n_bytes", F.col("best").alias("keep_id"), F.col("n").alias("group_size")))


def exact_dedup(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "smallest",
                fanout: int = FANOUT, partitions: int | None = None) -> DataFrame:
    """One row per row of ``documents``: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` names the identifier that stays in each group. Only texts that occur more than
    once come back by a join; its left side may hold one text in a third of all rows, which
    adaptive execution splits.
    """
    spark = documents.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = stored(digests(documents, text, doc_id), "digests")
    groups = stored(exact_groups(found, partitions, fanout, keep), "digest-groups").filter("group_size > 1")
    return (found.join(groups, ["sha", "n_bytes"], "left")
            .select("doc_id", F.coalesce("keep_id", "doc_id").alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    F.coalesce(F.col("doc_id") == F.coalesce("keep_id", "doc_id"), F.col("keep_id").isNull()).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))
