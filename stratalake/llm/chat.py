"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs, sorted, merged where neighbours have the same role, and
concatenated. Every control string starts with ``<``, and no text keeps a ``<`` of its own::

    <|user|>Hello<|+|>Are you there?<|end|><|assistant|>Yes.<|end|>

``\\`` becomes ``\\0`` and ``<`` becomes ``\\1`` in texts, and also ``|`` becomes ``\\2`` in roles, so the turns can be read
back exactly. ``<|+|>`` joins the texts of merged turns.

A conversation becomes one string, so it has to fit in one row, as any formatted conversation must.
"""

from pyspark.sql import Column, DataFrame, functions as F

END, JOINT = "<|end|>", "<|+|>"
_BLOCK = 256


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\0")), F.lit("<"), F.lit("\\1"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\1"), F.lit("<")), F.lit("\\0"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("|"), F.lit("\\2"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\2"), F.lit("|")))


def format_chats(
    turns: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    learn_from: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``loss_spans``.

    ``loss_spans`` holds start (from 0) and length, in code points of ``formatted``, of each text whose role is in
    ``learn_from``; markers lie outside. Turns are sorted by turn number (null last), then role, then text, so ties
    have a fixed order and repeated rows are turns of their own. A null role or text is empty; rows without a
    conversation id form one conversation; no rows give no conversations. Other columns are ignored.
    """
    rows = turns.select(
        F.col(id_column).alias("conv_id"),
        F.struct(
            F.col(turn_column).isNull().alias("no_turn"),
            F.col(turn_column).alias("turn"),
            F.coalesce(F.col(role_column), F.lit("")).alias("role"),
            F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        ).alias("turn"),
    )
    collected = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    n = F.size("turns")

    def piece(turn: Column, i: Column) -> Column:
        """What goes before the text and after it: role marker or joint, and the end marker of the last of a role."""
        joined = (i > 0) & (F.get("turns", i - 1)["role"] == turn["role"])
        last = (i == n - 1) | (F.get("turns", i + 1)["role"] != turn["role"])
        return F.struct(
            F.when(joined, F.lit(JOINT)).otherwise(F.concat(F.lit("<|"), _escape_role(turn["role"]), F.lit("|>"))).alias("head"),
            escape(turn["text"]).alias("text"),
            F.when(last, F.lit(END)).otherwise(F.lit("")).alias("tail"),
            turn["role"].isin(*learn_from).alias("learn"),
        )

    def length(p: Column) -> Column:
        return F.length(p["head"]) + F.length(p["text"]) + F.length(p["tail"])

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def measure(state: Column, p: Column) -> Column:
        span = F.struct((state["at"] + F.length(p["head"])).alias("start"), F.length(p["text"]).alias("length"))
        spans = F.when(p["learn"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + length(p)).alias("at"), spans.alias("spans"))

    pieces = collected.select("conv_id", F.transform("turns", piece).alias("pieces"))
    # An array grows by copying, so spans are gathered in blocks, each from its own start, and then moved to the starts of the blocks.
    starts = F.sequence(F.lit(1), F.size("pieces"), F.lit(_BLOCK))
    blocks = F.transform(starts, lambda i: F.aggregate(F.slice("pieces", i, F.lit(_BLOCK)), start, measure))
    offsets = F.aggregate(
        F.transform("blocks", lambda b: b["at"]),
        F.array(F.lit(0)),
        lambda state, n: F.concat(state, F.array(F.element_at(state, -1) + n)),
    )

    def moved(block: Column, i: Column) -> Column:
        at = F.get("offsets", i)
        return F.transform(block["spans"], lambda s: F.struct((s["start"] + at).alias("start"), s["length"].alias("length")))

    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["text"], p["tail"])), "")
    measured = pieces.select("conv_id", formatted.alias("formatted"), blocks.alias("blocks"))
    placed = measured.select("conv_id", "formatted", "blocks", offsets.alias("offsets"))
    return placed.select("conv_id", "formatted", F.flatten(F.transform("blocks", moved)).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns, as an array of structs of role and text, from a formatted conversation."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>"), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = _unescape_role(F.regexp_extract(block, r"^<\|([^|]*)\|>", 1))
        body = F.regexp_replace(block, r"^<\|[^|]*\|>", "")
        return F.transform(F.split(body, r"<\|\+\|>"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss_texts(formatted: Column, loss_spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(loss_spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))
