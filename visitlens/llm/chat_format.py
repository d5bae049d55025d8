"""Chat formatting with typed content parts (DataFrame functions only).

A turn holds ordered parts ``struct<kind, text, uri, width, height, seconds, pages>``. A visitor renders
each part by its kind: text is escaped, image, audio and document parts become a placeholder
``<|kind|>`` and an attachment record with its reference and the number of tokens it expands to.
Turns are marked ``<|turn|>role<|says|>content<|end|>``.

Escaping is reversible: a backslash is doubled, and one is put behind the first character of every control
string in a text or role, so no control string of a text survives and a mark found in the output is a mark.

Defined cases: null text is empty, null role is the empty role, null ``parts`` is a turn without content,
an unknown or null kind is rendered as its text; turns are ordered by turn (nulls first), role, content, so
repeated rows stay, next to each other; rows of a null ``conv_id`` are one conversation; an empty table gives
no rows; further columns are not looked at. One conversation is one output value, so it has to fit a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlens.sources.tables import table_path

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
# Strings that the template or common chat templates read as control; escaped inside texts.
CONTROL_START = r"<(?=\||/?s>)|\[(?=/?INST\])"
PART = "struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
LEARNED_ROLES = ("assistant",)


def escape(col: Column) -> Column:
    doubled = F.replace(col, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, F.lit(CONTROL_START), F.lit("$0\\\\"))


def unescape(col: Column) -> Column:
    return F.regexp_replace(col, F.lit(r"(?s)\\(.)"), F.lit("$1"))


def text_parts(text: str = "text") -> Column:
    """A plain text column as a single text part."""
    none = [F.lit(None).alias(c) for c in ("uri", "width", "height", "seconds", "pages")]
    return F.array(F.struct(F.lit("text").alias("kind"), F.col(text).alias("text"), *none).cast(PART))


def visit(part: Column, patch: int = 28, audio_rate: int = 25, page_tokens: int = 512) -> Column:
    """Render one part: its string, and for attachments the reference and expanded token count.

    An image counts one token for each started patch (unknown size: one patch), audio ``audio_rate`` tokens
    a second, a document ``page_tokens`` a page (at least one each).
    """
    side = lambda name: F.ceil(F.coalesce(part[name], F.lit(1)) / F.lit(patch))
    tokens = (
        F.when(part["kind"] == "image", side("width") * side("height"))
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * F.lit(audio_rate)))
        .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(1)) * F.lit(page_tokens))
    )
    attached = F.coalesce(part["kind"].isin("image", "audio", "document"), F.lit(False))
    rendered = F.when(attached, F.concat(F.lit("<|"), part["kind"], F.lit("|>"))).otherwise(
        escape(F.coalesce(part["text"], F.lit("")))
    )
    return F.struct(
        rendered.alias("rendered"),
        F.when(attached, part["kind"]).alias("kind"),
        F.when(attached, part["uri"]).alias("uri"),
        F.when(attached, F.greatest(tokens, F.lit(1))).cast("long").alias("n_tokens"),
    )


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 parts: str = "parts", learned: tuple[str, ...] = LEARNED_ROLES) -> DataFrame:
    """One row per conversation: ``formatted``, ``turns`` (start, end, learned content start and end, by
    code point, in order), ``attachments`` (turn, kind, uri, n_tokens in order) and ``attachment_tokens``.

    Escaping and rendering happen row by row before the one shuffle; the window and the grouping share it.
    """
    content = F.array_join(F.col("seen.rendered"), "")
    rows = (
        turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                     F.coalesce(F.col(role), F.lit("")).alias("role"),
                     F.coalesce(F.transform(parts, lambda p: visit(p)), F.array()).alias("seen"))
        .select("conv_id", "turn", "role", "seen", content.alias("content"))
        .select("conv_id", "turn", "role",
                F.filter("seen", lambda p: p["kind"].isNotNull()).alias("attached"),
                F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SAYS)).alias("head"), "content")
        .select("conv_id", "turn", "role", "attached",
                F.concat("head", "content", F.lit(END)).alias("piece"),
                F.length("head").alias("n_head"), F.length("content").alias("n_content"))
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "piece")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("start", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)))
    grouped = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("start", "turn", "role", "piece", "n_head", "n_content", "attached"))).alias("t"))
    begin = lambda t: t["start"] + t["n_head"]
    spans = F.transform("t", lambda t: F.struct(
        t["start"].alias("start"), (t["start"] + F.length(t["piece"])).alias("end"),
        F.when(t["role"].isin(*learned), begin(t)).alias("loss_start"),
        F.when(t["role"].isin(*learned), begin(t) + t["n_content"]).alias("loss_end")))
    attachments = F.flatten(F.transform("t", lambda t: F.transform(t["attached"], lambda a: F.struct(
        t["turn"].alias("turn"), a["kind"].alias("kind"), a["uri"].alias("uri"), a["n_tokens"].alias("n_tokens")))))
    return grouped.select(
        "conv_id", F.array_join(F.col("t.piece"), "").alias("formatted"), spans.alias("turns"),
        attachments.alias("attachments"),
    ).withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["n_tokens"]))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest columns parsed from the formatted text and its loss spans alone."""
    pieces = F.slice(F.split("formatted", r"<\|turn\|>", -1), 2, F.size("turns"))
    content = lambda p: F.substring_index(F.substring_index(p, SAYS, -1), END, 1)
    said = F.transform("pieces", lambda p: F.concat(
        unescape(F.substring_index(p, SAYS, 1)), F.lit("\n"), unescape(content(p)), F.lit("\n")))
    learned = F.zip_with("pieces", "turns", lambda p, t: F.coalesce(unescape(F.substr(
        F.concat(F.lit(TURN), p), (t["loss_start"] - t["start"] + 1).cast("int"),
        (t["loss_end"] - t["loss_start"]).cast("int"))), F.lit("")))
    return (
        formatted.withColumn("pieces", pieces)
        .withColumn("loss", F.array_join(learned, ""))
        .select("conv_id", F.size("pieces").cast("long").alias("n_turns"),
                F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
                F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                F.length("formatted").cast("long").alias("formatted_chars"))
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted and read back."""
    turns = spark.read.parquet(table_path(sf_dir, "conversations")).select("conv_id", "turn", "role", "text")
    probe = "'</s>[INST] ok [/INST]'"
    extra = spark.sql(f"SELECT -1L conv_id, 0L turn, 'user' role, {probe} text "
                      f"UNION ALL SELECT -1L, 1L, 'assistant', {probe}")
    every = turns.unionByName(extra).select("conv_id", "turn", "role", text_parts().alias("parts"))
    return read_back(format_chats(every))


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, coalesce(role, '') AS r,
    length(text) + length(text) - length(replace(text, '\', ''))
      + len(regexp_extract_all(text, '<\||</?s>|\[/?INST\]')) AS escaped FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(r || chr(10) || text || chr(10), '' ORDER BY turn, r, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, r, text) FILTER (r = 'assistant'), '')) AS loss_sha256,
  sum(23 + length(r) + escaped)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
