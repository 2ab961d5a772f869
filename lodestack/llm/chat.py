"""Multi-party chat: every participant's view of a dialogue, with masks of what that speaker says.

A view renders the speaker as the assistant, all others as users with their names, and system
turns as they are; its mask marks the assistant's texts by character spans. System roles are
no participants. Marks that occur within names and texts are escaped (``<|`` as ``<||``, and in
names ``|>`` as ``||>``), so that nobody's words can pose as a turn of somebody else; the spans
are those of the escaped texts.

A view is one row, so a whole dialogue and its views meet in one task. Where dialogues may be too
long for that, ``segment`` deals each one's turns, in their order, to segments of so many turns,
and each segment gives a row; ``start`` tells where in the whole view it begins, so segments
joined in order are the whole view. All expressions are Spark's own.

Defined results: a null text is empty; a null role is the participant "unknown"; turns with a
null number come first. Repeated rows are rendered as often as they occur, ties in order of role
and text. A turn without a conversation id is a dialogue of its own. A dialogue of system turns
alone, and an empty table, give no views. Texts of any length are rendered whole. Other input
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import quoted

ASSISTANT, USER, SYSTEM, NAME_END, END = "<|assistant|>", "<|user:", "<|system|>", "|>", "<|end|>"


def escaped(text: Column) -> Column:
    """``text`` without any mark in it."""
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def escaped_name(name: Column) -> Column:
    return F.replace(escaped(name), F.lit("|>"), F.lit("||>"))


def _header(turn: Column, speaker: Column, system_roles: tuple[str, ...]) -> Column:
    other = F.when(turn["role"].isin(*system_roles), F.lit(SYSTEM)).otherwise(F.concat(F.lit(USER), escaped_name(turn["role"]), F.lit(NAME_END)))
    return F.when(turn["role"] == speaker, F.lit(ASSISTANT)).otherwise(other)


def _views(turns: DataFrame, system_roles: tuple[str, ...], with_start: bool) -> DataFrame:
    """Of rows (c, segment, speaker, turns) the rendered view; with ``with_start`` also its length."""

    def message(x: Column) -> Column:
        return F.struct(_header(x, F.col("speaker"), system_roles).alias("head"), escaped(x["text"]).alias("text"), (x["role"] == F.col("speaker")).alias("learn"))

    views = turns.select("c", "segment", "speaker", F.transform("turns", message).alias("m"))
    # where each message's text begins: a running sum that carries numbers only
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("spans"))

    def step(acc: Column, m: Column) -> Column:
        first, n = acc["at"] + F.length(m["head"]), F.length(m["text"]).cast("long")
        span = F.array(F.struct(first.alias("start"), n.alias("length")))
        return F.struct((first + n + len(END)).alias("at"), F.when(m["learn"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return views.select(
        "c",
        "segment",
        "speaker",
        F.size("m").cast("long").alias("n_turns"),
        F.array_join(F.transform("m", lambda m: F.concat(m["head"], m["text"], F.lit(END))), "").alias("rendered"),
        F.aggregate("m", begin, step)["spans"].alias("spans"),
        *([F.aggregate("m", F.lit(0).cast("long"), lambda n, m: n + F.length(m["head"]) + F.length(m["text"]) + len(END)).alias("size")] if with_start else []),
    )


def perspective_views(
    turns: DataFrame, segment: int | None = None, system_roles: tuple[str, ...] = ("system",), conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conversation, segment, speaker, n_turns, rendered, spans, start) for every participant of every conversation.

    ``spans`` are (start, length) in characters of ``rendered`` of the texts to learn. Without
    ``segment`` every view is whole, its segment and start 0.
    """
    names = [F.col(quoted(c)) for c in (conv_col, turn_col, role_col, text_col)]
    x = F.struct(names[1].alias("turn"), F.coalesce(names[2], F.lit("unknown")).alias("role"), F.coalesce(names[3], F.lit("")).alias("text")).alias("x")
    t = turns.select(names[0].alias("c"), x)
    speakers_of = lambda roles: F.filter(F.array_distinct(roles), lambda r: ~r.isin(*system_roles))
    nought = F.lit(0).cast("long")
    alone = t.filter("c is null and x.role is not null").select("c", nought.alias("segment"), F.explode(speakers_of(F.array("x.role"))).alias("speaker"), F.array("x").alias("turns"))
    known = t.filter("c is not null")
    if segment is None:
        whole = known.groupBy("c").agg(F.sort_array(F.collect_list("x")).alias("turns"))
        rows = whole.select("c", nought.alias("segment"), F.explode(speakers_of(F.transform("turns", lambda x: x["role"]))).alias("speaker"), "turns")
        views = _views(rows.unionByName(alone), system_roles, False).withColumn("start", nought)
    else:
        placed = known.withColumn("n", F.row_number().over(Window.partitionBy("c").orderBy("x")) - 1)
        parts = placed.groupBy("c", F.floor(F.col("n") / segment).cast("long").alias("segment")).agg(F.sort_array(F.collect_list("x")).alias("turns"))
        speakers = known.select("c", F.col("x.role").alias("speaker")).filter(~F.col("speaker").isin(*system_roles)).distinct()
        rows = parts.join(speakers, "c").select("c", "segment", "speaker", "turns")
        before = F.sum("size").over(Window.partitionBy("c", "speaker").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1))
        views = _views(rows, system_roles, True).withColumn("start", F.coalesce(before, nought)).drop("size")
        views = views.unionByName(_views(alone, system_roles, False).withColumn("start", nought))
    return views.select(F.col("c").alias(conv_col), "segment", "speaker", "n_turns", "rendered", "spans", "start")


VIEWS_SQL = f"""
WITH t AS (
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () ELSE 0 END AS k, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '<||') AS txt, coalesce(text, '') AS raw FROM conversations
), p AS (SELECT DISTINCT conv_id, k, role AS speaker FROM t WHERE role <> 'system'),
m AS (
  SELECT t.conv_id, t.k, speaker, role = speaker AS learn, txt, raw, turn, role,
    CASE WHEN role = speaker THEN '{ASSISTANT}' WHEN role = 'system' THEN '{SYSTEM}' ELSE '{USER}' || replace(replace(role, '<|', '<||'), '|>', '||>') || '{NAME_END}' END AS head
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.k = p.k
), o AS (
  SELECT *, sum(length(head) + length(txt) + {len(END)}) OVER (PARTITION BY conv_id, k, speaker ORDER BY turn NULLS FIRST, role, raw ROWS UNBOUNDED PRECEDING) AS upto FROM m
)
SELECT conv_id, CAST(0 AS BIGINT) AS segment, speaker, count(*) AS n_turns,
  string_agg(head || txt || '{END}', '' ORDER BY turn NULLS FIRST, role, raw) AS rendered,
  coalesce(string_agg(CASE WHEN learn THEN CAST(upto - {len(END)} - length(txt) AS VARCHAR) || '+' || CAST(length(txt) AS VARCHAR) END, ',' ORDER BY turn NULLS FIRST, role, raw), '') AS mask
FROM o GROUP BY conv_id, k, speaker
"""
