"""Chat formatting: multi-party perspective rotation, in DataFrame operations only.

One row for each turn and perspective, in dialogue order, so a dialogue of any length is never
gathered into one row: rendered text, its name, the loss mask and character offsets.
Defined results: turns with a null conv_id are left out; a null role speaks as "unknown"; null text
is empty; system turns are shown to all and are no participant; repeated turns stay, side by side; a
null turn counts as turn -1; "<|" in a text or a role is written "< |", so that neither can open or end
a turn; other columns are left out, whatever their names. Turns of one number, speaker and text are alike.
"""
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Turn numbers in a stretch.
STRETCH = 64


def safe(x):
    """Without the mark that opens a turn."""
    return F.replace(x, F.lit("<|"), F.lit("< |"))


def rotate_perspectives(turns: DataFrame) -> DataFrame:
    t = turns.filter("conv_id is not null").select(
        "conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"), safe(F.coalesce("role", F.lit("unknown"))).alias("speaker"), safe(F.coalesce("text", F.lit(""))).alias("text"))
    who = t.filter("speaker <> 'system'").select("conv_id", F.col("speaker").alias("perspective")).distinct()
    own = F.col("speaker") == F.col("perspective")
    role = F.when(own, "assistant").when(F.col("speaker") == "system", "system").otherwise("user")
    name = F.when(role == "user", F.col("speaker"))
    head = F.concat(F.lit("<|"), role, F.coalesce(F.concat(F.lit(" name="), name), F.lit("")), F.lit("|>\n"))
    tail = "<|end|>\n"
    # Stretches of a dialogue keep a long one from landing in one task: what comes before a stretch is
    # summed from counts and lengths alone, so texts are dealt once, by dialogue and stretch.
    t = t.withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    size = t.groupBy("conv_id", "stretch", "speaker").agg(F.count("*").alias("rows"), F.sum(F.length("text")).alias("chars"))
    size = size.join(who, "conv_id").withColumn("chars", F.col("chars") + F.col("rows") * (F.length(head) + len(tail)))
    size = size.groupBy("conv_id", "perspective", "stretch").agg(F.sum("rows").alias("rows"), F.sum("chars").alias("chars"))
    before = W.partitionBy("conv_id", "perspective").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    views = size.select("conv_id", "stretch", "perspective", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("rows", "chars")])
    x = t.join(views, ["conv_id", "stretch"])
    x = x.withColumns({"chat_role": role, "name": name, "head": head, "rendered": F.concat(head, "text", F.lit(tail))})
    order = W.partitionBy("conv_id", "stretch", "perspective").orderBy("turn", "speaker", "text")
    end = F.sum(F.length("rendered")).over(order.rowsBetween(W.unboundedPreceding, 0)) + F.col("chars_before")
    x = x.withColumn("position", (F.row_number().over(order) + F.col("rows_before")).cast("int")).withColumn("char_end", end)
    start = F.col("char_end") - F.length("rendered")
    mask = F.col("chat_role") == "assistant"
    return x.select("conv_id", "perspective", "position", "turn", "speaker", "chat_role", "name", "rendered", start.cast("long").alias("char_start"), F.col("char_end").cast("long"),
                    F.when(mask, start + F.length("head")).cast("long").alias("loss_start"), F.when(mask, F.col("char_end")).cast("long").alias("loss_end"))


CHAT_SQL = """
WITH t AS (SELECT conv_id, coalesce(CAST(turn AS BIGINT), -1) AS turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
who AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
x AS (SELECT conv_id, perspective, turn, speaker, text,
        CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS chat_role
      FROM t JOIN who USING (conv_id)),
y AS (SELECT *, CASE WHEN chat_role = 'user' THEN speaker END AS name FROM x),
z AS (SELECT *, '<|' || chat_role || coalesce(' name=' || name, '') || '|>' || chr(10) AS head FROM y),
r AS (SELECT *, head || text || '<|end|>' || chr(10) AS rendered FROM z),
o AS (SELECT *, row_number() OVER w AS position,
        CAST(sum(length(rendered)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS char_end
      FROM r WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn, speaker, text))
SELECT conv_id, perspective, CAST(position AS INTEGER) AS position, turn, speaker, chat_role, name, rendered,
       CAST(char_end - length(rendered) AS BIGINT) AS char_start, char_end,
       CAST(CASE WHEN chat_role = 'assistant' THEN char_end - length(rendered) + length(head) END AS BIGINT) AS loss_start,
       CASE WHEN chat_role = 'assistant' THEN char_end END AS loss_end
FROM o"""
