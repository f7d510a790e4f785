"""Chat formatting with typed content parts.

A turn's content is an array of typed parts. A visitor, one expression per type, flattens the parts in order: text is
escaped, an image, audio clip or document becomes a placeholder with a running number, and for each of these an
attachment record keeps the reference and the number of tokens the placeholder expands to.

A conversation is written as one string in which ``<|start|>`` opens a turn, a line end parts the role from the content
and ``<|end|>`` closes it. Control strings in texts and roles, the template's own and those of other common templates,
are escaped by the rules in ``escaped``, which ``unescaped`` takes back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, LINE = "<|start|>", "<|end|>", "\n"
#: What opens a control string somewhere; the rest of the string is looked for behind it.
CONTROL = r"<(?=\||/?s>|/?<SYS>>|</SYS>>)", r"\[(?=/?INST\])"
PATCH = 14
AUDIO_TOKENS_PER_SECOND = 25.0
PAGE_TOKENS = 512
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
LEARNED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """Every & becomes &amp;, then the first character of each control string becomes a reference."""
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    out = F.regexp_replace(out, CONTROL[0], "&lt;")
    return F.regexp_replace(out, CONTROL[1], "&#91;")


def unescaped(text: Column) -> Column:
    out = F.replace(text, F.lit("&#91;"), F.lit("["))
    out = F.replace(out, F.lit("&lt;"), F.lit("<"))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def escaped_role(role: Column) -> Column:
    """As a text; its line ends are references too, so that the first line end is the one behind the role."""
    return F.replace(escaped(role), F.lit(LINE), F.lit("&#10;"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("&#10;"), F.lit(LINE)))


def text_parts(text: Column) -> Column:
    """A content of one text part; null is the empty text."""
    values = {"type": F.lit("text"), "text": F.coalesce(text, F.lit(""))}
    fields = [f.split(":") for f in PART[len("struct<") : -1].split(",")]
    return F.array(F.struct(*(values.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in fields)))


def _attached(part: Column) -> Column:
    return ~F.coalesce(part["type"], F.lit("text")).isin("text")


def expanded_tokens(part: Column) -> Column:
    """Tokens a placeholder stands for: image patches, a rate per second of audio, a number per page; at least one."""
    def patches(side: str) -> Column:
        return F.ceil(F.coalesce(part[side], F.lit(PATCH)) / PATCH)

    count = (
        F.when(part["type"] == "image", patches("width") * patches("height"))
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_TOKENS_PER_SECOND))
        .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(1)) * PAGE_TOKENS)
        .otherwise(1)
    )
    return F.greatest(count.cast("long"), F.lit(1).cast("long"))


def visited(part: Column, number: Column) -> Column:
    """The part as it stands in the formatted string; ``number`` counts the conversation's attachments from 1.

    Unknown types are placeholders under their own name, so nothing vanishes. A null part is an empty text.
    """
    kind = F.regexp_replace(F.coalesce(part["type"], F.lit("text")), "[^A-Za-z0-9_]", "_")
    placeholder = F.concat(F.lit("<|"), kind, F.lit(":"), number.cast("string"), F.lit("|>"))
    return F.when(_attached(part), placeholder).otherwise(escaped(F.coalesce(part["text"], F.lit(""))))


def _offsets(counts: Column) -> Column:
    """Running sums before each element."""
    sums = F.aggregate(
        counts, F.array(F.lit(0).cast("long")),
        lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    return F.slice(sums, 1, F.size(counts))


def format_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
    learned: str = LEARNED_ROLE,
) -> DataFrame:
    """One row per conversation: its id, n_turns, segments, formatted, attachments and expanded_tokens.

    ``parts`` is an array of PART structs. Turns are ordered by number (nulls first), repeated numbers by role and
    content; identical rows are turns of their own. A null role is the empty one, null or empty parts are an empty
    content, and rows with a null id form one conversation. Other columns are ignored; an empty table gives an empty
    result. A conversation, which is one string in the end, has to fit in memory, but conversations share no task.

    ``segments`` (text, loss) are ``formatted`` cut where the loss mask changes: loss is true exactly for the contents
    of the learned role, so that no template text is learned. ``attachments`` has number, turn (from 0), part (from 0),
    type, ref and tokens in order; ``expanded_tokens`` is their sum.
    """
    row = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.filter(F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull()).alias("parts"))
    talks = turns.select(F.col(conv).alias("conv"), row.alias("row")).groupBy("conv").agg(
        F.sort_array(F.collect_list("row")).alias("rows"))
    talks = talks.withColumn(
        "before", _offsets(F.transform("rows", lambda r: F.size(F.filter(r["parts"], _attached)).cast("long"))))

    def content(r: Column, k: Column) -> Column:
        attached = F.filter(r["parts"], _attached)

        def number(p: Column, i: Column) -> Column:
            return F.element_at(F.col("before"), k + 1) + F.size(
                F.filter(F.slice(r["parts"], F.lit(1), i + 1), _attached))

        plain = F.transform(r["parts"], lambda p: visited(p, F.lit(0)))
        numbered = F.transform(r["parts"], lambda p, i: visited(p, number(p, i)))
        return F.array_join(F.when(F.size(attached) > 0, numbered).otherwise(plain), "")

    def record(r: Column, k: Column) -> Column:
        found = F.filter(
            F.transform(r["parts"], lambda p, i: F.struct(p.alias("p"), i.alias("i"))), lambda x: _attached(x["p"]))
        return F.transform(found, lambda x, j: F.struct(
            (F.element_at(F.col("before"), k + 1) + j + 1).alias("number"), k.alias("turn"), x["i"].alias("part"),
            x["p"]["type"].alias("type"), x["p"]["ref"].alias("ref"), expanded_tokens(x["p"]).alias("tokens")))

    def segments(r: Column, k: Column) -> Column:
        opening = F.concat(F.lit(START), escaped_role(r["role"]), F.lit(LINE))
        return F.array(
            F.struct(opening.alias("text"), F.lit(False).alias("loss")),
            F.struct(content(r, k).alias("text"), (r["role"] == learned).alias("loss")),
            F.struct(F.lit(END + LINE).alias("text"), F.lit(False).alias("loss")))

    return (
        talks.select(
            F.col("conv").alias(conv), F.size("rows").cast("long").alias("n_turns"),
            F.flatten(F.transform("rows", segments)).alias("segments"),
            F.flatten(F.transform("rows", record)).alias("attachments"))
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
        .withColumn("expanded_tokens", F.aggregate(
            "attachments", F.lit(0).cast("long"), lambda total, a: total + a["tokens"]))
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted string of text parts."""
    pieces = F.slice(F.split(formatted, r"<\|start\|>"), 2, F.greatest(F.size(F.split(formatted, r"<\|start\|>")), F.lit(1)))

    def turn(piece: Column) -> Column:
        at = F.instr(piece, LINE)
        body = F.substr(piece, at + 1)
        return F.struct(
            unescaped_role(F.substr(piece, F.lit(1), at - 1)).alias("role"),
            unescaped(F.substr(body, F.lit(1), F.length(body) - len(END + LINE))).alias("text"))

    return F.transform(pieces, turn)


def digests(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Digests of what the formatted strings and their loss masks hold, read back from them."""
    learned = F.array_join(F.transform(
        F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
    told = F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit(LINE), t["text"], F.lit(LINE))), "")
    return (
        formatted.withColumn("turns", read_back(F.col("formatted"))).withColumn("learned", learned)
        .select(
            conv, F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
            F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"))
    )
