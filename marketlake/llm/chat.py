"""Chat formatting with typed content parts.  DataFrame functions only.

A turn is rendered as ``<|turn|>role<|body|>body</s>``.  A visitor flattens
the turn's parts in order: a text part becomes its escaped text, an image,
audio or document part becomes a placeholder ``<|kind:turn.part|>`` and an
attachment record with its expanded token count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import query, table, text_or_empty

# The template's own marks and the control strings of common
# chat formats.  None begins with the end of another, so a mark after a text
# can never complete one.
TURN, BODY, END = "<|turn|>", "<|body|>", "</s>"
CONTROLS = ("</s>", "<s>", "[INST]", "[/INST]", "<|")
ESCAPE = "\\"

PARTS = ("array<struct<type:string,text:string,ref:string,width:int,height:int,"
         "seconds:double,pages:int>>")
# Tokens that stand for an attachment: an image takes one per patch, audio a
# fixed rate, a document a fixed number per page.
PATCH, AUDIO_PER_SECOND, DOCUMENT_PER_PAGE = 14, 25.0, 256


def escape(text: Column) -> Column:
    """Double the escape character, then put one after the first character of
    every control string; no control string is left."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(c[0] + ESCAPE + c[1:])), CONTROLS,
                  F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2)))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_parts(text: Column) -> Column:
    """A turn of one text part."""
    null = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), null.cast("string").alias("ref"),
                            null.cast("int").alias("width"), null.cast("int").alias("height"),
                            null.cast("double").alias("seconds"), null.cast("int").alias("pages"))).cast(PARTS)


def expanded_tokens(p: Column) -> Column:
    side = lambda c: F.greatest(F.ceil(F.coalesce(c, F.lit(0)) / PATCH), F.lit(1))
    return (F.when(p["type"] == "image", side(p["width"]) * side(p["height"]))
            .when(p["type"] == "audio", F.greatest(F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * AUDIO_PER_SECOND), F.lit(1)))
            .when(p["type"] == "document", F.greatest(F.coalesce(p["pages"], F.lit(1)), F.lit(1)) * DOCUMENT_PER_PAGE)
            .otherwise(F.lit(0))).cast("long")


def visit_parts(parts: Column, position: Column) -> tuple[Column, Column]:
    """(body, attachments) of a turn.  A part of unknown or null type is read
    as text; a null part list is an empty turn."""
    kinds = ("image", "audio", "document")
    some = F.coalesce(parts, F.array().cast(PARTS))

    def is_file(p):
        return F.coalesce(p["type"].isin(*kinds), F.lit(False))

    def mark(p, i):
        return F.concat(F.lit("<|"), p["type"], F.lit(":"), position.cast("string"), F.lit("."),
                        i.cast("string"), F.lit("|>"))
    body = F.array_join(F.transform(some, lambda p, i: F.when(is_file(p), mark(p, i)).otherwise(
        escape(F.coalesce(p["text"], F.lit(""))))), "")
    files = F.filter(F.transform(some, lambda p, i: F.when(is_file(p), F.struct(
        position.cast("long").alias("turn"), i.alias("part"), p["type"].alias("type"), p["ref"].alias("ref"),
        mark(p, i).alias("placeholder"), expanded_tokens(p).alias("tokens")))), lambda a: a.isNotNull())
    return body, files


def format_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                parts: str = "parts", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``conv, n_turns, formatted, loss_spans
    (array<struct<start,end>>, code points of ``formatted``), attachments,
    attachment_tokens``.

    Turns stand by ``turn`` (null first), then role, then body; repeated rows
    are turns of their own.  A null role is the empty role; a null
    conversation id is a conversation; an empty table has no rows; a very long
    conversation is one long row.  Other columns are ignored, whatever their names.  Offsets
    are running sums in the window that orders the turns, so a conversation is
    shuffled once; its rendered text is one row by nature of the output.
    """
    by = Window.partitionBy("conv")
    base = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"), F.col(parts).alias("parts"))
    order = by.orderBy("turn", "role", F.to_json(F.struct("parts")))
    placed = base.withColumn("position", F.row_number().over(order) - 1)
    body, files = visit_parts(F.col("parts"), F.col("position"))
    shown = placed.select("conv", "position", "role", body.alias("body"), files.alias("files"))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY))
    piece = shown.select("conv", "position", "role", "files", F.length(head).alias("head_chars"),
                         F.length("body").alias("body_chars"),
                         F.concat(head, F.col("body"), F.lit(END)).alias("piece"))
    before = F.coalesce(F.sum(F.length("piece").cast("long")).over(
        by.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = before + F.col("head_chars")
    located = piece.select(
        "conv", "position", "piece", "files",
        F.when(F.col("role").isin(*loss_roles),
               F.struct(start.alias("start"), (start + F.col("body_chars")).alias("end"))).alias("span"))
    rows = located.groupBy("conv").agg(
        F.count("*").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("position", "piece", "span", "files"))).alias("t"))
    attachments = F.flatten(F.transform("t", lambda x: x["files"]))
    return rows.select(
        F.col("conv").alias(conv), "n_turns", F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
        F.filter(F.transform("t", lambda x: x["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("attachment_tokens"))


def read_turns(formatted: Column) -> Column:
    """Inverse of the template for text turns: array<struct<role,text>>."""
    pieces = F.split(formatted, END, -1)
    whole = F.slice(pieces, 1, F.size(pieces) - 1)

    def parse(p):
        at = F.instr(p, BODY)
        return F.struct(unescape(F.substr(p, F.lit(len(TURN) + 1), at - len(TURN) - 1)).alias("role"),
                        unescape(F.substr(p, at + len(BODY), F.length(p))).alias("text"))
    return F.transform(whole, parse)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


_ESCAPED = "replace({0}, '\\', '\\\\')"
for _c in CONTROLS:
    _ESCAPED = f"replace({_ESCAPED}, '{_c}', '{_c[0]}\\{_c[1:]}')"

SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum({len(TURN + BODY + END)} + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""


@query(SQL)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(probe).alias("text"))
    turns = rows.unionByName(extra).select("conv_id", "turn", "role", text_parts(text_or_empty("text")).alias("parts"))
    out = format_chat(turns).withColumn("turns", read_turns(F.col("formatted"))) \
        .withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans")))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(digest, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))
