"""Preference formatting: the longest common turn prefix of a chosen and a rejected conversation is rendered once as the
prompt; what follows on either side becomes a completion, with a mask of the assistant's parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, table

#: Shared openings (a 32-byte hash and an id) that a broadcast may hold.
MAX_BROADCAST_HEADS = 100_000
#: Parts to which the conversations of one opening are dealt beyond it.
SALT = 32
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(MIDDLE), turn["text"], F.lit(CLOSE))


def _join(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _mask(turns: Column) -> Column:
    """start:end, comma-joined, of the assistant's texts with their closing marks, in code points of the completion."""
    step = lambda acc, t: F.struct((acc["at"] + F.length(_rendered(t))).alias("at"), F.when(t["role"] == "assistant", F.concat(acc["spans"], F.when(acc["spans"] == "", "").otherwise(","), (acc["at"] + F.lit(len(OPEN) + len(MIDDLE)) + F.length(t["role"])).cast("string"), F.lit(":"), (acc["at"] + F.length(_rendered(t))).cast("string"))).otherwise(acc["spans"]).alias("spans"))
    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), F.lit("").alias("spans")), step)["spans"]


def _members(opening: DataFrame, heads: DataFrame) -> DataFrame:
    """opening with its head, where it has one. An opening of any share of the rows stays in the tasks it is in (few
    heads: broadcast) or goes to SALT of them."""
    if heads.count() <= MAX_BROADCAST_HEADS:
        return opening.join(F.broadcast(heads), "opening")
    dealt = opening.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALT)).cast("int"))
    return dealt.join(heads.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALT))))), ["opening", "salt"]).drop("salt")


def pairs_from(conversations: DataFrame) -> DataFrame:
    """Turns of preference pairs out of plain conversations: pair_id, side, turn, role, text.

    `swap-<id>`: a conversation is chosen over itself with its last assistant turn replaced by its first one (by an
    empty text where they are the same turn); conversations without an assistant turn give none. `same-<id>`: among
    conversations that open with the same turn the smallest conv_id is chosen over each other one. A group of any size
    is paired with its first member only, so rows grow with the turns; its turns are joined by conv_id, never as pairs
    of the group. Null roles and texts are empty; turns repeated as they are stay; rows without a conv_id go; other
    columns aren't read; an empty table gives no rows.
    """
    t = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).where("conv_id is not null")
    own = W.partitionBy("conv_id")
    said = F.when(F.col("role") == "assistant", F.struct("turn", "text"))
    s = t.withColumn("first", F.min(said).over(own)).withColumn("last", F.max(said).over(own)).where("last is not null")
    other = F.when((F.col("turn") == F.col("last.turn")) & (F.col("role") == "assistant"), F.when(F.col("first.turn") == F.col("last.turn"), F.lit("")).otherwise(F.col("first.text"))).otherwise(F.col("text"))
    swap = s.select(F.concat(F.lit("swap-"), F.col("conv_id").cast("string")).alias("pair_id"), F.explode(F.array(F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text")), F.struct(F.lit("rejected").alias("side"), other.alias("text")))).alias("x"), "turn", "role").select("pair_id", "x.side", "turn", "role", "x.text")
    opening = cut(t.groupBy("conv_id").agg(F.min(F.struct("turn", "role", "text")).alias("o")).select("conv_id", F.unhex(F.sha2(F.concat_ws("\n", "o.role", "o.text"), 256)).alias("opening")))
    heads = cut(opening.groupBy("opening").agg(F.min("conv_id").alias("head"), F.count("*").alias("size")).where("size > 1").drop("size"))
    member = _members(opening, heads).where("conv_id <> head").select("conv_id", "head", F.concat(F.lit("same-"), F.col("conv_id").cast("string")).alias("pair_id"))
    rejected = member.join(t, "conv_id").select("pair_id", F.lit("rejected").alias("side"), "turn", "role", "text")
    chosen = member.select("head", "pair_id").join(t, F.col("head") == F.col("conv_id")).select("pair_id", F.lit("chosen").alias("side"), "turn", "role", "text")
    return swap.union(rejected).union(chosen)


def format_pairs(turns: DataFrame) -> DataFrame:
    """pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask of turns (pair_id, side, turn, role, text).

    Turns are ordered by turn, then role and text; two are equal if role and text are. Equal sides leave both
    completions empty; a side without turns is empty; other sides than chosen and rejected are ignored.
    """
    t = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    side = lambda name: F.transform(F.sort_array(F.collect_list(F.when(F.col("side") == name, t))), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias(name)
    both = turns.where(F.col("side").isin("chosen", "rejected")).groupBy("pair_id").agg(side("chosen"), side("rejected"))
    at = F.array_position(F.zip_with("chosen", "rejected", lambda a, b: a.eqNullSafe(b)), False).cast("int")
    cut = both.withColumn("n_common", F.when(at == 0, F.size("chosen")).otherwise(at - 1))
    rest = lambda name: F.slice(name, F.col("n_common") + 1, F.greatest(F.size(name) - F.col("n_common"), F.lit(0)))
    cut = cut.withColumn("c", rest("chosen")).withColumn("r", rest("rejected"))
    return cut.select("pair_id", "n_common", _join(F.slice("chosen", F.lit(1), F.col("n_common"))).alias("prompt"), _join(F.col("c")).alias("chosen"), _join(F.col("r")).alias("rejected"), _mask(F.col("c")).alias("chosen_mask"), _mask(F.col("r")).alias("rejected_mask"))


def op5_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_pairs(pairs_from(table(spark, sf_dir, "conversations")))


SQL = rf"""
WITH t AS (SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
a AS (SELECT conv_id, min(turn) AS f, max(turn) AS l, arg_min(text, turn) AS ft FROM t WHERE role = 'assistant' GROUP BY conv_id),
o AS (SELECT conv_id, arg_min(role, turn) || chr(10) || arg_min(text, turn) AS opening FROM t GROUP BY conv_id),
h AS (SELECT conv_id, min(conv_id) OVER (PARTITION BY opening) AS head FROM o),
p AS (
  SELECT 'swap-' || conv_id AS pair_id, 'chosen' AS side, turn, role, text FROM t JOIN a USING (conv_id)
  UNION ALL SELECT 'swap-' || conv_id, 'rejected', turn, role, CASE WHEN turn = l AND role = 'assistant' THEN CASE WHEN f = l THEN '' ELSE ft END ELSE text END FROM t JOIN a USING (conv_id)
  UNION ALL SELECT 'same-' || h.conv_id, 'rejected', turn, role, text FROM h JOIN t USING (conv_id) WHERE h.conv_id <> head
  UNION ALL SELECT 'same-' || h.conv_id, 'chosen', turn, role, text FROM h JOIN t ON t.conv_id = head WHERE h.conv_id <> head),
n AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn, role, text) AS pos FROM p),
e AS (SELECT pair_id, pos, count(*) = 2 AND count(DISTINCT struct_pack(role, text)) = 1 AS equal FROM n GROUP BY pair_id, pos),
c AS (SELECT pair_id, coalesce(min(pos) FILTER (NOT equal) - 1, max(pos)) AS n_common FROM e GROUP BY pair_id),
r AS (SELECT pair_id, side, pos, role, n_common, '{OPEN}' || role || chr(10) || text || '<|im_end|>' || chr(10) AS body FROM n JOIN c USING (pair_id)),
s AS (SELECT *, coalesce(sum(length(body)) OVER (PARTITION BY pair_id, side ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM r WHERE pos > n_common),
d AS (SELECT pair_id, side, string_agg(body, '' ORDER BY pos) AS body, coalesce(string_agg((off + {len(OPEN) + 1} + length(role))::BIGINT || ':' || (off + length(body))::BIGINT, ',' ORDER BY pos) FILTER (role = 'assistant'), '') AS mask FROM s GROUP BY pair_id, side)
SELECT c.pair_id, c.n_common::INT AS n_common, coalesce((SELECT string_agg(body, '' ORDER BY pos) FROM r WHERE r.pair_id = c.pair_id AND side = 'chosen' AND pos <= r.n_common), '') AS prompt,
  coalesce(x.body, '') AS chosen, coalesce(y.body, '') AS rejected, coalesce(x.mask, '') AS chosen_mask, coalesce(y.mask, '') AS rejected_mask
FROM c LEFT JOIN d x ON x.pair_id = c.pair_id AND x.side = 'chosen' LEFT JOIN d y ON y.pair_id = c.pair_id AND y.side = 'rejected'
"""
