"""Chat formatting: multi-party perspective rotation, in DataFrame functions only.

For every participant of a conversation (every role but ``system``) the dialogue is rendered with that speaker
as ``assistant`` and the others as users that carry their names; the mask holds the spans a model would learn
from, which are the assistant's contents with their end marks.

A dialogue is rendered in parts of ``PART`` messages, in the order of (turn, role, text), each with its start within
the whole dialogue. Messages are numbered by one sort of the whole table and the counts of each dialogue in its
ranges, so no task holds a dialogue, or the messages of one turn, of unbounded length; up to PART messages a dialogue
is one part. The parts of one (conversation, perspective), in order, are the whole rendering.

Defined results: a null text is empty, a null role is the participant ``unknown``, a null turn comes last;
rows equal in conversation, turn, role and text are one message; messages of one turn are ordered by role,
then text; rows without conv_id belong to no dialogue; ``<|`` inside a text becomes ``< |`` so that no text
can forge a mark; a conversation of system messages only has no perspective; an empty table gives an empty result;
other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.llm.common import cut, table

PART = 64
#: Parts whose lengths are summed in one window; the sums of these are summed in a second one.
SPAN = 1024
LAST_TURN = 9223372036854775807
#: Shares that the speakers of a long dialogue are copied for, at most.
SALTS = 32


def _numbered(messages: DataFrame) -> DataFrame:
    """``messages`` with ``k``, their place in their dialogue, from 0, and ``n``, the messages of the dialogue.

    One range sort deals the table out; a range adds its own count of a dialogue to those of earlier ranges."""
    order = ["conv_id", "turn", "role", "text"]
    placed = messages.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    placed = cut(placed)
    # as many rows as a dialogue has ranges
    counts = placed.groupBy("conv_id", "range").agg(F.count("*").alias("here"), F.min("at").alias("first"))
    by = Window.partitionBy("conv_id")
    counts = counts.withColumn("before", F.sum("here").over(by.orderBy("range")) - F.col("here")).withColumn("n", F.sum("here").over(by))
    return placed.join(counts, ["conv_id", "range"]).withColumn("k", F.col("at") - F.col("first") + F.col("before")).select(*order, "k", "n")


def rotate(turns: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, perspective, part, part_start, n_messages, n_chars, n_loss_chars, text, mask from (conv_id, turn, role, text).

    ``mask`` lists ``start:end`` of the part's text in code points, end exclusive, comma-joined."""
    clean = turns.where("conv_id is not null").select(
        "conv_id",
        F.coalesce(F.col("turn").cast("long"), F.lit(LAST_TURN)).alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"),
    )
    messages = _numbered(clean.distinct())
    parts = messages.groupBy("conv_id", F.expr(f"k div {part}").alias("part"), "n").agg(F.array_sort(F.collect_list(F.struct("k", "turn", "role", "text"))).alias("m"))
    parts = parts.withColumn("salt", (F.col("part") % SALTS).cast("int"))
    # a dialogue of several parts has its speakers once for each share of them
    speakers = messages.where("role <> 'system'").groupBy("conv_id", F.col("role").alias("perspective")).agg(F.first("n").alias("n"))
    shares = F.least(F.lit(SALTS).cast("long"), F.expr(f"(n - 1) div {part} + 1")).cast("int")
    speakers = speakers.select("conv_id", "perspective", F.explode(F.sequence(F.lit(0), shares - 1)).alias("salt"))
    both = parts.join(speakers, ["conv_id", "salt"])

    def head(m):
        who = F.when(m["role"] == "system", "system").when(m["role"] == F.col("perspective"), "assistant").otherwise(F.concat(F.lit("user name="), m["role"]))
        return F.concat(F.lit("<|im_start|>"), who, F.lit("\n"))

    shown = both.withColumn("s", F.transform("m", lambda m: F.struct(head(m).alias("head"), F.concat(m["text"], F.lit("<|im_end|>")).alias("body"), (m["role"] == F.col("perspective")).alias("own"))))
    walk = F.aggregate(
        "s",
        F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("loss"), F.array().cast("array<string>").alias("spans")),
        lambda a, s: F.struct(
            (a["at"] + F.length(s["head"]) + F.length(s["body"]) + 1).alias("at"),
            (a["loss"] + F.when(s["own"], F.length(s["body"])).otherwise(0)).alias("loss"),
            F.when(
                s["own"],
                F.array_append(a["spans"], F.concat_ws(":", (a["at"] + F.length(s["head"])).cast("string"), (a["at"] + F.length(s["head"]) + F.length(s["body"])).cast("string"))),
            ).otherwise(a["spans"]).alias("spans"),
        ),
    )
    out = shown.withColumn("w", walk).select(
        "conv_id", "perspective", "part", F.size("s").cast("long").alias("n_messages"), F.col("w.at").alias("n_chars"), F.col("w.loss").alias("n_loss_chars"),
        F.array_join(F.transform("s", lambda s: F.concat(s["head"], s["body"], F.lit("\n"))), "").alias("text"), F.array_join("w.spans", ",").alias("mask"),
    )
    return _with_starts(out)


def _with_starts(parts: DataFrame) -> DataFrame:
    """part_start from the lengths of earlier parts, over two levels of bounded windows.

    Of the lengths, only those of dialogues with several parts are gone through again."""
    sizes = parts.select("conv_id", "perspective", "part", "n_chars", F.expr(f"part div {SPAN}").alias("span"))
    later = sizes.where("part > 0").select("conv_id", "perspective").distinct()
    sizes = sizes.join(later, ["conv_id", "perspective"], "left_semi")
    inner = Window.partitionBy("conv_id", "perspective", "span").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("conv_id", "perspective").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = sizes.groupBy("conv_id", "perspective", "span").agg(F.sum("n_chars").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(outer), F.lit(0)))
    starts = sizes.withColumn("inside", F.coalesce(F.sum("n_chars").over(inner), F.lit(0))).join(spans, ["conv_id", "perspective", "span"])
    starts = starts.select("conv_id", "perspective", "part", (F.col("before") + F.col("inside")).alias("part_start"))
    return parts.join(starts, ["conv_id", "perspective", "part"], "left").withColumn("part_start", F.coalesce("part_start", F.lit(0).cast("long")))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue of ``conversations`` from each participant's perspective."""
    return rotate(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


SQL = f"""
WITH clean AS (
  SELECT DISTINCT conv_id, coalesce(turn, {LAST_TURN}) AS turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1) // {PART} AS part FROM clean),
speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM clean WHERE role <> 'system'),
shown AS (
  SELECT c.conv_id, s.perspective, c.part, c.turn, c.role, c.text, c.role = s.perspective AS own,
    '<|im_start|>' || CASE WHEN c.role = 'system' THEN 'system' WHEN c.role = s.perspective THEN 'assistant' ELSE 'user name=' || c.role END || chr(10) AS head,
    c.text || '<|im_end|>' AS body
  FROM numbered c JOIN speakers s USING (conv_id)),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, part ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM shown),
parts AS (
  SELECT conv_id, perspective, part, count(*) AS n_messages, CAST(sum(length(head) + length(body) + 1) AS BIGINT) AS n_chars,
    CAST(sum(CASE WHEN own THEN length(body) ELSE 0 END) AS BIGINT) AS n_loss_chars,
    string_agg(head || body || chr(10), '' ORDER BY turn, role, text) AS text,
    coalesce(string_agg(CAST(CAST(pos + length(head) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(pos + length(head) + length(body) AS BIGINT) AS VARCHAR), ',' ORDER BY turn, role, text) FILTER (WHERE own), '') AS mask
  FROM placed GROUP BY ALL)
SELECT conv_id, perspective, part, n_messages, n_chars, n_loss_chars, text, mask,
  CAST(coalesce(sum(n_chars) OVER (PARTITION BY conv_id, perspective ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS part_start
FROM parts
"""
