"""Chat formatting with the perspective rotated (operator 8).

A dialogue of several parties is rendered once for every participant:
that speaker's messages are the assistant's and are trained on, everyone
else speaks as a named user, system messages stay system messages.

All of it is DataFrame functions, so Catalyst plans it.  Messages are
numbered within their dialogue by a dense index over a range
partitioning.  A rendering is kept in pieces of ``MESSAGES`` messages,
each a row that knows where it begins; a dialogue is its pieces put
together, whatever its length, and spans are counted from the dialogue's
start.  A dialogue with a third of all messages is thus many groups and
no large one, and nulls or ties among the turn numbers change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linefeed.llm.common import named
from linefeed.operators.index import with_dense_index

#: Messages per piece of a rendering.
MESSAGES = 64
#: The role that belongs to no participant.
SYSTEM = "system"
#: The marks around a message, what opens a mark, and what it becomes inside a message or a name.
ASSISTANT_OPEN, SYSTEM_OPEN, CLOSE = "<|assistant|>\n", "<|system|>\n", "<|end|>\n"
MARK, ESCAPED, MARK_END, ESCAPED_END = "<|", "<||", "|>", "||>"


def escaped(text: Column) -> Column:
    """A message in which nothing reads as a mark: ``<|`` becomes ``<||``; the reverse gives the message back."""
    return F.replace(text, F.lit(MARK), F.lit(ESCAPED))


def rotate(messages: DataFrame, size: int = MESSAGES, conv_col: str = "conv_id", turn_col: str = "turn",
           speaker_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per dialogue, participant and piece: ``conv_id, perspective, piece, offset, n_messages, n_trained, rendered, trained``.

    ``rendered`` is the piece's text and ``offset`` the characters of the
    dialogue before it, so pieces in order, end to end, are the dialogue.
    ``trained`` lists the character spans (start, end) of the dialogue that
    count for the loss: the perspective's messages with their end marks.
    Messages are ordered by turn (null first), then speaker, then text, so
    ties and repeated rows have a fixed place and all are rendered.  A null
    speaker is called ``unknown``, a null text is empty, null dialogue ids
    are one dialogue.  A mark inside a message or a name is escaped.  A
    dialogue of system messages alone has no participants and no rows;
    columns not named are not read.
    """
    rows = messages.select(
        F.struct(named(conv_col).cast("long").alias("conv_id")).alias("conv"),  # a struct is never null: null ids join
        named(turn_col).cast("long").alias("turn"),
        F.coalesce(named(speaker_col).cast("string"), F.lit("unknown")).alias("speaker"),
        F.coalesce(named(text_col), F.lit("")).alias("text"))
    placed = with_dense_index(rows, ["conv", "turn", "speaker", "text"], name="place")
    first = placed.groupBy("conv").agg(F.min("place").alias("first"))
    people = placed.where(F.col("speaker") != SYSTEM).select("conv", F.col("speaker").alias("perspective")).distinct()
    own = F.col("speaker") == F.col("perspective")
    name = F.replace(escaped(F.col("speaker")), F.lit(MARK_END), F.lit(ESCAPED_END))
    opened = (F.when(own, ASSISTANT_OPEN).when(F.col("speaker") == SYSTEM, SYSTEM_OPEN)
              .otherwise(F.concat(F.lit("<|user name="), name, F.lit("|>\n"))))
    seen = (placed.join(first, "conv").withColumn("body", F.concat(escaped(F.col("text")), F.lit(CLOSE)))
            .select("conv", (F.col("place") - F.col("first")).alias("at"), "speaker", "body",
                    F.length("body").cast("long").alias("body_chars"))
            .join(people, "conv").withColumn("opened", opened)
            .withColumn("chars", F.length("opened") + F.col("body_chars"))
            .withColumn("piece", F.floor(F.col("at") / size)))
    place = ["conv", "perspective", "piece"]
    upto = Window.partitionBy(*place).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    message = F.struct("at", F.concat("opened", "body").alias("shown"), own.alias("own"),
                       (F.col("end") - F.col("body_chars")).alias("start"), "end")
    pieces = seen.withColumn("end", F.sum("chars").over(upto)).groupBy(*place).agg(
        F.sort_array(F.collect_list(message)).alias("m"))
    # what stands before a piece: a row per piece, without its text
    earlier = Window.partitionBy("conv", "perspective").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = seen.groupBy(*place).agg(F.sum("chars").alias("chars")).select(
        *place, F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("offset"))
    trained = F.filter("m", lambda x: x["own"])
    return pieces.join(before, place).select(
        F.col("conv.conv_id").alias("conv_id"), "perspective", "piece", "offset",
        F.size("m").cast("long").alias("n_messages"), F.size(trained).cast("long").alias("n_trained"),
        F.array_join(F.transform("m", lambda x: x["shown"]), "").alias("rendered"),
        F.transform(trained, lambda x: F.struct((F.col("offset") + x["start"]).alias("start"),
                                                (F.col("offset") + x["end"]).alias("end"))).alias("trained"))


def whole(pieces: DataFrame) -> DataFrame:
    """Per dialogue and participant, what ``rotate`` gives with the pieces put together.

    A dialogue is one row here, so this is for dialogues that fit one.
    """
    ordered = F.array_sort(F.collect_list(F.struct("piece", "rendered", "trained")))
    return pieces.groupBy("conv_id", "perspective").agg(
        F.sum("n_messages").alias("n_messages"), F.sum("n_trained").alias("n_trained"), ordered.alias("p")).select(
        "conv_id", "perspective", "n_messages", "n_trained",
        F.array_join(F.transform("p", lambda x: x["rendered"]), "").alias("rendered"),
        F.flatten(F.transform("p", lambda x: x["trained"])).alias("trained"))


def rotation_digest(messages: DataFrame) -> DataFrame:
    """``rotate`` with the text as its length and SHA-256 and the spans as text."""
    spans = F.transform("trained", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string")))
    return rotate(messages).select(
        "conv_id", "perspective", "piece", "offset", "n_messages", "n_trained",
        F.length("rendered").cast("long").alias("n_chars"), F.sha2("rendered", 256).alias("rendered_sha256"),
        F.array_join(spans, ",").alias("trained_spans"))


#: The same in DuckDB: whole dialogues are laid out first, then cut into the pieces.
ORACLE = f"""
WITH rows AS (
  SELECT conv_id, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '{MARK}', '{ESCAPED}') AS text,
         row_number() OVER (PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS k
  FROM conversations
), people AS (
  SELECT DISTINCT conv_id AS of_conv, speaker AS perspective FROM rows WHERE speaker <> '{SYSTEM}'
), seen AS (
  SELECT conv_id, perspective, k // {MESSAGES} AS piece, k, speaker = perspective AS own,
         CASE WHEN speaker = perspective THEN '<|assistant|>' WHEN speaker = '{SYSTEM}' THEN '<|system|>'
              ELSE '<|user name=' || replace(replace(speaker, '{MARK}', '{ESCAPED}'), '{MARK_END}', '{ESCAPED_END}')
                   || '|>' END || chr(10) AS opened,
         text || '<|end|>' || chr(10) AS body
  FROM rows JOIN people ON conv_id IS NOT DISTINCT FROM of_conv
), placed AS (
  SELECT *, sum(length(opened) + length(body)) OVER (PARTITION BY conv_id, perspective ORDER BY k) AS e FROM seen
)
SELECT conv_id, perspective, piece, CAST(min(e - length(opened) - length(body)) AS BIGINT) AS "offset",
       count(*) AS n_messages, count(*) FILTER (WHERE own) AS n_trained,
       CAST(sum(length(opened) + length(body)) AS BIGINT) AS n_chars,
       sha256(string_agg(opened || body, '' ORDER BY k)) AS rendered_sha256,
       coalesce(string_agg(CAST(e - length(body) AS VARCHAR) || ':' || CAST(e AS VARCHAR), ',' ORDER BY k)
                FILTER (WHERE own), '') AS trained_spans
FROM placed GROUP BY conv_id, perspective, piece
"""
