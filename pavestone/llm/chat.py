"""Operator 8, chat formatting: multi-party perspective rotation.

For every participant of a conversation, the dialogue is rendered with that
speaker as the assistant and all others as named users; only the assistant's
own words and end mark are to be learned (mask 1).  Turns of a narrator (the role `system`) keep
their role and speak from no perspective.

One row per perspective and turn, with its place in the rendered dialogue, so that a dialogue of
any length never has to fit one row: `text` of all rows in order of `segment`
is the dialogue, and [mask_start, mask_end) are the characters to learn.

Places are sums over blocks of turns and then within a block, so that one
conversation may hold any share of the rows.

Defined results: turns are in order of turn, role and text (nulls first); repeated
turns each stay; a null text is empty, a null role speaks as `unknown`; a null
conv_id is one conversation; a conversation of narrators alone has no
perspective and gives no rows; a text of any length is one row; an empty table gives none; other columns are ignored, also
those whose names differ in case only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import only

NARRATOR = "system"
#: Turn numbers per block.
BLOCK = 64


def rotate_perspectives(turns: DataFrame, narrator: str = NARRATOR) -> DataFrame:
    """Per perspective and turn: conv_id, perspective, segment, turn, role, name, text, n_chars, text_start, mask, mask_start, mask_end."""
    rows = only(turns, "conv_id", "turn", "role", "text").select("conv_id", F.col("turn").cast("long"), F.coalesce("role", F.lit("unknown")).alias("speaker"), F.coalesce("text", F.lit("")).alias("said"))
    parts = rows.where(F.col("speaker") != narrator).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    l, r = rows.alias("l"), parts.alias("r")
    each = l.join(r, F.col("l.conv_id").eqNullSafe(F.col("r.conv_id"))).select("l.*", "perspective")
    own = F.col("speaker") == F.col("perspective")
    role = F.when(own, "assistant").when(F.col("speaker") == narrator, "system").otherwise("user")
    name = F.when((role == "user"), F.col("speaker"))
    head = F.concat(F.lit("<|im_start|>"), role, F.coalesce(F.concat(F.lit(" name="), name), F.lit("")), F.lit("\n"))
    body = F.concat("said", F.lit("<|im_end|>"))
    each = each.select(
        "conv_id", "perspective", "turn", "speaker", "said", role.alias("role"), name.alias("name"), F.concat(head, body, F.lit("\n")).alias("text"),
        F.length(head).cast("long").alias("n_head"), F.length(body).cast("long").alias("n_body"), F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK).alias("block"),
    ).withColumn("n_chars", F.col("n_head") + F.col("n_body") + 1)
    keys = ["conv_id", "perspective"]
    sums = each.groupBy(*keys, "block").agg(F.count(F.lit(1)).alias("b_rows"), F.sum("n_chars").alias("b_chars"))
    up = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "block", F.coalesce(F.sum("b_rows").over(up), F.lit(0)).alias("rows0"), F.coalesce(F.sum("b_chars").over(up), F.lit(0)).alias("chars0"))
    inside = Window.partitionBy(*keys, "block").orderBy(F.col("turn").asc_nulls_first(), "speaker", "said").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("i", F.row_number().over(Window.partitionBy(*keys, "block").orderBy(F.col("turn").asc_nulls_first(), "speaker", "said"))).withColumn("c", F.sum("n_chars").over(inside))
    a, b = each.alias("a"), sums.alias("b")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.perspective") == F.col("b.perspective")) & (F.col("a.block") == F.col("b.block"))
    at = a.join(b, same).select("a.*", "rows0", "chars0")
    start = F.col("chars0") + F.col("c") - F.col("n_chars")
    mine = F.col("role") == "assistant"
    return at.select(
        "conv_id", "perspective", (F.col("rows0") + F.col("i") - 1).cast("long").alias("segment"), "turn", "role", "name", "text", "n_chars", start.alias("text_start"), mine.cast("int").alias("mask"),
        F.when(mine, start + F.col("n_head")).alias("mask_start"), F.when(mine, start + F.col("n_head") + F.col("n_body")).alias("mask_end"),
    )


def op8_perspectives(spark, sf_dir: str) -> DataFrame:
    return rotate_perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE_OP8 = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS said FROM conversations
), p AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'
), e AS (
  SELECT t.*, perspective,
    CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS role
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), r AS (
  SELECT *, '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || speaker ELSE '' END || chr(10) AS head, said || '<|im_end|>' AS body FROM e
), s AS (
  SELECT *, length(head) + length(body) + 1 AS n_chars,
    row_number() OVER w - 1 AS segment, sum(length(head) + length(body) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - (length(head) + length(body) + 1) AS text_start
  FROM r WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, said)
)
SELECT conv_id, perspective, segment, turn, role, CASE WHEN role = 'user' THEN speaker END AS name, head || body || chr(10) AS text,
  CAST(n_chars AS BIGINT) AS n_chars, CAST(text_start AS BIGINT) AS text_start, CAST(role = 'assistant' AS INTEGER) AS mask,
  CAST(CASE WHEN role = 'assistant' THEN text_start + length(head) END AS BIGINT) AS mask_start,
  CAST(CASE WHEN role = 'assistant' THEN text_start + length(head) + length(body) END AS BIGINT) AS mask_end
FROM s
"""
