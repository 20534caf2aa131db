"""Chat formatting of cumulative conversation logs, with DataFrame functions only.

A logger that writes a conversation after every turn leaves many snapshots, each the
beginning of the next. A rolling hash identifies the turns up to each position; a
conversation whose whole hash is the hash of a beginning of a longer one is dropped by an
anti-join, and of equal conversations the smallest ``conv_id`` stays. What is left is
rendered with a template.

The rolling hash of the first k turns is the exclusive or of the hashes of (position, role,
text), in two independent 64-bit parts. It is summed in two steps, within blocks of turns
and over the blocks of a conversation, so that a conversation of any length is never
gathered by one task; for the same reason a rendered conversation comes in parts of at most
``BLOCK`` turns.

Turns are ordered by number, then role and text; a missing number comes first. Null roles
and texts count as empty. Rows repeated in all four columns count once. Rows without
``conv_id`` are one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.sources.workspace import stored

BLOCK = 256
_OPEN, _BODY, _CLOSE = "<|", "|>\n", "<|end|>\n"


def _same(*names: str) -> Column:
    """Equality of the columns ``l.x`` and ``r.x``, nulls being equal."""
    out = F.lit(True)
    for n in names:
        out = out & F.col(f"l.{n}").eqNullSafe(F.col(f"r.{n}"))
    return out


def _with_totals_before(rows: DataFrame, totals: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` with its block's columns ``names`` of ``totals``."""
    return rows.alias("l").join(totals.alias("r"), _same("conv_id", "block")).select("l.*", *(F.col(f"r.{n}") for n in names))


def turn_prefixes(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, position from 1, role, text, p1, p2): each turn with the hash of all turns
    up to it."""
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    turns = turns.withColumn("block", F.coalesce(F.floor(F.col("turn") / block), F.lit(-(1 << 62))))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = turns.withColumn("in_block", F.row_number().over(inside))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("conv_id", "block").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    placed = _with_totals_before(placed, counts, ["before"]).withColumn("position", F.col("before") + F.col("in_block"))
    hashed = placed.select("conv_id", "block", "position", "role", "text", F.xxhash64("position", "role", "text").alias("h1"),
                           F.xxhash64(F.lit(1), "text", "role", "position").alias("h2"))
    hashed = stored(hashed, "turns")
    sums = hashed.groupBy("conv_id", "block").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
    for i in "12":
        sums = sums.withColumn(f"e{i}", F.coalesce(F.bit_xor(f"b{i}").over(earlier), F.lit(0)))
    so_far = Window.partitionBy("conv_id", "block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    rolled = _with_totals_before(hashed, sums, ["e1", "e2"])
    return rolled.select("conv_id", "position", "role", "text", *(
        F.bit_xor(f"h{i}").over(so_far).bitwiseXOR(F.col(f"e{i}")).alias(f"p{i}") for i in "12"))


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies): conversations that begin no longer one, once each, with
    the number of equal ones."""
    lengths = prefixes.groupBy("conv_id").agg(F.max_by(F.struct("position", "p1", "p2"), "position").alias("whole"))
    whole = (lengths.select("conv_id", "whole.*").groupBy("position", "p1", "p2")
             .agg(F.min(F.struct(F.col("conv_id").isNull().alias("last"), "conv_id")).alias("first"), F.count("*").alias("copies")))
    # The beginning at position k + 1 continues the one at k: whoever has a turn after k
    # offers its hash at k as that of a proper beginning.
    longer = (prefixes.alias("l").join(lengths.select("conv_id", F.col("whole.position").alias("size")).alias("r"), _same("conv_id"))
              .filter("l.position < r.size").select("l.position", "l.p1", "l.p2").distinct())
    return whole.join(longer, ["position", "p1", "p2"], "left_anti").select("first.conv_id", F.col("position").alias("n_turns"), "copies")


def rendered(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, part (from 0), n_turns (of the conversation), copies, and text: the turns of
    the part in order, each as ``<|role|>``, line end, text, ``<|end|>``, line end."""
    prefixes = stored(turn_prefixes(conversations, block), "turn-prefixes")
    kept = stored(maximal_conversations(prefixes), "maximal-conversations")
    piece = F.concat(F.lit(_OPEN), "role", F.lit(_BODY), "text", F.lit(_CLOSE))
    turns = (prefixes.alias("l").join(kept.alias("r"), _same("conv_id"))
             .select("l.conv_id", F.floor((F.col("position") - 1) / block).alias("part"), "n_turns", "copies", "position", piece.alias("piece")))
    parts = turns.groupBy("conv_id", "part", "n_turns", "copies").agg(F.sort_array(F.collect_list(F.struct("position", "piece"))).alias("pieces"))
    return parts.select("conv_id", "part", "n_turns", "copies", F.array_join(F.col("pieces.piece"), "").alias("text"))


ORACLE = """
    WITH turns AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS position FROM turns),
    whole AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY position) AS own, count(*) AS n_turns FROM placed GROUP BY conv_id),
    once AS (SELECT min(conv_id) AS conv_id, own, n_turns, count(*) AS copies FROM whole GROUP BY own, n_turns),
    kept AS (SELECT * FROM once AS a WHERE NOT EXISTS (
        SELECT 1 FROM whole AS b WHERE b.n_turns > a.n_turns AND b.own[1] = a.own[1] AND b.own[1:a.n_turns] = a.own))
    SELECT conv_id, (position - 1) // 256 AS part, n_turns, copies,
           string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY position) AS text
    FROM placed JOIN kept USING (conv_id) GROUP BY conv_id, (position - 1) // 256, n_turns, copies"""
