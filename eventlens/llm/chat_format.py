"""Chat formatting from an event log.

A conversation is a log of events: ``message`` opens a message, ``delta``
appends to one, ``edit`` sets its text, ``regenerate`` starts it anew and drops
what was said after it.  The log is folded into the final messages, which are
rendered into one text with a mask of what a model is to be trained on.

Every step that needs the order of a conversation works on chunks of ``CHUNK``
sequence numbers, with one summary row per chunk carried along the
conversation, so a conversation of any length is spread over many tasks until
its finished text becomes one row.

Template: ``<s>``, the role, a line feed, the text, ``</s>``, for each turn.  In
texts and roles ``\\`` is written ``\\s``, the ``<`` of a control string ``\\l``;
in roles a line feed is written ``\\k``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 256
OPEN, CLOSE = "<s>", "</s>"
TRAINED_ROLE = "assistant"
FIRST_SEQ = -(2**63)


def escape(text: Column, one_line: bool = False) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\s"))
    for control in (OPEN, CLOSE):
        text = F.replace(text, F.lit(control), F.lit("\\l" + control[1:]))
    return F.replace(text, F.lit("\n"), F.lit("\\k")) if one_line else text


def unescape(text: Column) -> Column:
    for code, plain in (("\\l", "<"), ("\\k", "\n"), ("\\s", "\\")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _chunk(seq: Column) -> Column:
    return F.floor(seq / F.lit(CHUNK)).cast("long")


def fold_events(events: DataFrame) -> DataFrame:
    """The final messages of each conversation: conv_id, seq, tie, role, text.

    ``events`` has conv_id, seq, role, text, and may have kind (NULL or missing:
    message) and target (the seq of the message an event applies to; NULL: the
    message opened last).  Events run by seq, then role, text and kind; NULL
    comes first.  The first event of a conversation always opens a message.  An
    event for a message that nobody opened makes one at that place.  Repeated
    rows are events of their own.  NULL text counts as empty, NULL role is the
    first role given for the message, or empty.
    """
    kind = F.lower(F.col("kind")) if "kind" in events.columns else F.lit(None).cast("string")
    target = F.col("target").cast("long") if "target" in events.columns else F.lit(None).cast("long")
    log = events.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("seq").cast("long"), F.lit(FIRST_SEQ)).alias("seq"),
        F.coalesce(kind, F.lit("message")).alias("kind"),
        target.alias("target"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("chunk", _chunk(F.col("seq")))

    in_chunk = Window.partitionBy("conv_id", "chunk").orderBy("seq", "role", "text", "kind")
    log = log.withColumn("nth", F.row_number().over(in_chunk))
    same_seq = Window.partitionBy("conv_id", "chunk", "seq")
    log = log.withColumn("tie", (F.col("nth") - F.min("nth").over(same_seq)).cast("int"))
    place = F.struct("seq", "tie")
    given = F.when(F.col("target").isNotNull(), F.struct(F.col("target").alias("seq"), F.lit(0).alias("tie")))
    opens = F.when(F.col("kind") == "message", place).when(F.col("kind") == "regenerate", given)
    log = log.withColumns({"place": place, "given": given, "opens": opens})
    drops_after = F.when(F.col("kind") == "regenerate", F.coalesce("given", "open"))

    # What each chunk passes on: the message opened last before it, and whether it is the first.
    chunks = log.groupBy("conv_id", "chunk").agg(
        F.max_by("opens", F.when(F.col("opens").isNotNull(), F.col("nth"))).alias("last"), F.min("place").alias("first")
    )
    along = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(
        F.col("conv_id").alias("_conv"),
        F.col("chunk").alias("_chunk"),
        F.last("last", ignorenulls=True).over(along).alias("before"),
        F.min("first").over(Window.partitionBy("conv_id")).alias("first"),
    )
    log = log.join(chunks, log["conv_id"].eqNullSafe(chunks["_conv"]) & (log["chunk"] == chunks["_chunk"]))
    log = log.withColumn("opens", F.coalesce("opens", F.when(F.col("place") == F.col("first"), F.col("place"))))
    so_far = in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    log = log.withColumn(
        "open", F.coalesce(F.last("opens", ignorenulls=True).over(so_far), F.col("before"), F.col("first"))
    )
    log = log.withColumn(
        "message",
        F.when(F.col("kind") == "message", F.col("place")).otherwise(F.coalesce("given", "open")),
    ).withColumn("drops_after", drops_after)

    # A message goes if a later regeneration points to an earlier one.
    cuts = (
        log.where(F.col("drops_after").isNotNull())
        .select(F.col("conv_id").alias("_conv"), F.col("drops_after").alias("after"), F.col("place").alias("until"))
        .groupBy("_conv", "after")
        .agg(F.max("until").alias("until"))
    )
    messages = log.groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_list(F.struct("place", "nth", "kind", "role", "text"))).alias("events"),
    )
    cut = (
        messages.join(
            cuts,
            messages["conv_id"].eqNullSafe(cuts["_conv"])
            & (F.col("message") > F.col("after"))
            & (F.col("message") < F.col("until")),
            "left_anti",
        )
    )
    resets = F.transform("events", lambda e, i: F.when(e["kind"] != "delta", i))
    start = F.coalesce(F.array_max(resets), F.lit(0)) + 1
    said = F.slice("events", start, F.size("events") - start + 1)
    roles = F.array_compact(F.transform("events", lambda e: e["role"]))
    return cut.select(
        "conv_id",
        F.col("message.seq").alias("seq"),
        F.col("message.tie").alias("tie"),
        F.coalesce(F.try_element_at(roles, F.lit(1)), F.lit("")).alias("role"),
        F.array_join(F.transform(said, lambda e: e["text"]), "").alias("text"),
    )


def _running(pieces: str, size: str) -> str:
    """Offsets of the elements of an array of structs, by the field ``size``."""
    return (
        f"aggregate({pieces}, named_struct('at', 0L, 'offsets', cast(array() as array<bigint>)), "
        f"(s, p) -> named_struct('at', s.at + p.{size}, 'offsets', concat(s.offsets, array(s.at))), s -> s.offsets)"
    )


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, ``formatted``, and ``loss_spans`` of (start, length).

    Spans count UTF-8 bytes and cover the escaped text of each assistant turn,
    without its marks.
    """
    role, text = escape(F.col("role"), one_line=True), escape(F.col("text"))
    turns = messages.select(
        "conv_id",
        _chunk(F.col("seq")).alias("chunk"),
        "seq",
        "tie",
        F.concat(F.lit(OPEN), role, F.lit("\n")).alias("head"),
        text.alias("body"),
        (F.col("role") == TRAINED_ROLE).alias("trained"),
    )
    turns = turns.withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
    turn = F.struct(
        "seq",
        "tie",
        "piece",
        F.octet_length("piece").cast("long").alias("bytes"),
        F.octet_length("head").cast("long").alias("skip"),
        F.octet_length("body").cast("long").alias("length"),
        "trained",
    )
    chunks = turns.groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    chunks = chunks.withColumn("offsets", F.expr(_running("turns", "bytes")))
    chunks = chunks.select(
        "conv_id",
        F.struct(
            "chunk",
            F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("text"),
            F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["bytes"]).alias("bytes"),
            F.expr(
                "filter(transform(turns, (t, i) -> named_struct('start', offsets[i] + t.skip, 'length', t.length, "
                "'trained', t.trained)), t -> t.trained)"
            ).alias("spans"),
        ).alias("part"),
    )
    whole = chunks.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    whole = whole.withColumn("offsets", F.expr(_running("parts", "bytes")))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("formatted"),
        F.expr(
            "flatten(transform(parts, (p, i) -> transform(p.spans, s -> "
            "named_struct('start', s.start + offsets[i], 'length', s.length))))"
        ).alias("loss_spans"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """The turns and the trained texts of a rendered conversation, unescaped, from its text and mask alone."""
    pieces = F.split(F.col("formatted"), CLOSE, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        end = F.locate("\n", piece)
        return F.struct(
            unescape(F.substring(piece, len(OPEN) + 1, end - len(OPEN) - 1)).alias("role"),
            unescape(F.substring(piece, end + 1, F.length(piece))).alias("text"),
        )

    data = F.col("formatted").cast("binary")
    trained = F.transform(
        "loss_spans",
        lambda s: unescape(F.substring(data, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string")),
    )
    return rendered.select("conv_id", "formatted", F.transform(pieces, turn).alias("turns"), trained.alias("trained"))


def digest(rendered: DataFrame) -> DataFrame:
    """Counts and hashes of what is read back from a rendered conversation."""
    back = read_back(rendered).withColumn("loss", F.array_join("trained", ""))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
