"""Chat records with typed content parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assetloom.llm.text import whole

# The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"

#: Attachment types, their placeholders and the tokens one unit stands for when the model
#: reads it: an image tile, a second of sound, a page.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 512}
PLACEHOLDER = {kind: f"<|{kind}|>" for kind in UNIT_TOKENS}
_ANY_PLACEHOLDER = r"<\|(?:" + "|".join(UNIT_TOKENS) + r")\|>"

PART = "struct<type:string,text:string,ref:string,units:int>"
#: Turns of one conversation that a first aggregation puts together.
BLOCK_TURNS = 64

_MARKUP = r"!\[[^\]\n]*\]\([^()\s]+\)"
_AUDIO = r"(?i)\.(mp3|wav|flac|ogg|m4a)\)$"
_DOCUMENT = r"(?i)\.(pdf|docx?|odt|epub)\)$"


def escaped(text: Column) -> Column:
    """No ``<|`` is left: a backslash goes between the signs, one more where some are."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escaped_role(role: Column) -> Column:
    once = F.regexp_replace(F.regexp_replace(role, r"\\", r"\\\\"), "\n", r"\\n")
    return escaped(once)


def _unescaped_role(role: Column) -> Column:
    lines = F.regexp_replace(unescaped(role), r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.regexp_replace(lines, r"\\\\", r"\\")


def parts_of(text: Column) -> Column:
    """Typed parts of a text: pictures, sounds and documents named in its markup, and the
    text between them, in order."""
    refs = F.regexp_extract_all(text, F.lit(_MARKUP), F.lit(0))
    kind = lambda m: F.when(m.rlike(_AUDIO), "audio").when(m.rlike(_DOCUMENT), "document").otherwise("image")
    make = lambda t, x, r, u: F.struct(t.alias("type"), x.alias("text"), r.alias("ref"), u.alias("units"))
    nothing, one = F.lit(None).cast("string"), F.lit(1)
    mixed = F.flatten(F.transform(
        F.arrays_zip(F.split(text, _MARKUP, -1).alias("piece"), refs.alias("ref")),
        lambda p: F.filter(F.array(
            make(F.lit("text"), p["piece"], nothing, one), make(kind(p["ref"]), nothing, p["ref"], one)),
            lambda x: F.coalesce(x["text"], x["ref"]).isNotNull())))
    return F.when(text.rlike(_MARKUP), mixed).otherwise(
        F.array(make(F.lit("text"), text, nothing, one))).cast(f"array<{PART}>")


def flattened(parts: Column) -> tuple[Column, Column]:
    """Visit the parts in order: the text with placeholders, and the attachments.

    An attachment has ``type``, ``ref`` and ``tokens``, the tokens its placeholder
    expands to (``units`` times the type's rate; null units count as one). Parts of an
    unknown type are kept as text, null parts and null texts are empty.
    """
    rate = F.create_map(*(F.lit(x) for kv in UNIT_TOKENS.items() for x in kv))
    known = lambda p: F.coalesce(p["type"].isin(*UNIT_TOKENS), F.lit(False))
    sign = lambda p: F.concat(F.lit("<|"), p["type"], F.lit("|>"))
    flat = F.array_join(F.transform(
        parts, lambda p: F.when(known(p), sign(p)).otherwise(escaped(F.coalesce(p["text"], F.lit(""))))), "")
    attached = F.transform(F.filter(parts, known), lambda p: F.struct(
        p["type"].alias("type"), p["ref"].alias("ref"),
        (F.try_element_at(rate, p["type"]) * F.coalesce(p["units"], F.lit(1))).cast("bigint").alias("tokens")))
    return F.coalesce(flat, F.lit("")), F.coalesce(attached, F.array().cast(
        "array<struct<type:string,ref:string,tokens:bigint>>"))


def plain_text(parts: Column) -> Column:
    """The parts as they came, references for attachments; ties are ordered by it."""
    return F.coalesce(F.array_join(F.transform(parts, lambda p: F.coalesce(
        F.when(p["type"].isin(*UNIT_TOKENS), p["ref"]).otherwise(p["text"]), F.lit(""))), ""), F.lit(""))


def format_chats(turns: DataFrame, parts: str = "parts") -> DataFrame:
    """One row per conversation and block of ``BLOCK_TURNS`` turns; the blocks of a
    conversation joined in order are its record.

    ``turns`` has conv_id, turn, role and typed ``parts``. Columns: conv_id, block, n_turns,
    ``formatted``, ``loss`` (spans of the assistant texts in ``formatted``: start, length),
    ``attachments`` (type, ref, tokens, in order of their placeholders).

    Turns stand in order of turn, ties by role and text; null turns come first, null roles
    and texts are empty, repeated rows are repeated turns, no rows give no record. A
    conversation is one training record; ordering is done block by block, so only its
    blocks, not its turns, meet in one task.
    """
    body, attached = flattened(F.col(parts))
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit(START), _escaped_role(role), F.lit("\n"))
    plain = plain_text(F.col(parts))
    told = turns.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), head.alias("head"),
        body.alias("body"), attached.alias("attached"), F.when(plain != body, plain).alias("plain"))
    one = F.struct("turn", "role", "body", "head", "attached", "plain")
    place = lambda t: F.struct(t["turn"], t["role"], F.coalesce(t["plain"], t["body"]))
    by_place = lambda s, t: F.when(place(s) < place(t), -1).when(place(s) > place(t), 1).otherwise(0)
    block = F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62)))
    blocks = (told.groupBy("conv_id", block.alias("block"))
                  .agg(F.array_sort(F.collect_list(one), by_place).alias("turns")))
    tail = F.lit(END + "\n")
    pieces = F.transform("turns", lambda t: F.concat(t["head"], t["body"], tail))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("out"))

    def step(so_far: Column, t: Column) -> Column:
        begin = so_far["at"] + F.length(t["head"])
        size = F.length(t["body"])
        span = F.array(F.struct(begin.alias("start"), size.alias("length")))
        return F.struct((begin + size + len(END) + 1).alias("at"),
                        F.when(t["role"] == "assistant", F.concat(so_far["out"], span))
                         .otherwise(so_far["out"]).alias("out"))

    return blocks.select(
        "conv_id", "block", F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(pieces, "").alias("formatted"),
        F.aggregate("turns", start, step, lambda s: s["out"]).alias("loss"),
        F.flatten(F.transform("turns", lambda t: t["attached"])).alias("attachments"))


def _restored(flat: Column, attachments: Column) -> Column:
    """A formatted text with its placeholders turned back into the parts' references."""
    pieces = F.split(flat, _ANY_PLACEHOLDER, -1)
    filled = F.array_join(F.transform(
        F.arrays_zip(pieces.alias("piece"), F.transform(attachments, lambda a: a["ref"]).alias("ref")),
        lambda p: F.concat(unescaped(p["piece"]), F.coalesce(p["ref"], F.lit("")))), "")
    return F.when(F.size(attachments) > 0, filled).otherwise(unescaped(flat))


def read_back(records: DataFrame) -> DataFrame:
    """Per block of ``format_chats``: ``turns_text`` (role, newline, text, newline per turn), ``loss_text``
    (texts under the mask), read from the formatted text alone (and the attachment list)."""
    count = lambda s: F.size(F.regexp_extract_all(s, F.lit(_ANY_PLACEHOLDER), F.lit(0)))
    some = F.size("attachments") > 0
    # one piece per turn; what stands before the first start mark is empty
    turns = F.slice(F.split("formatted", r"<\|im_start\|>", -1), 2, 1 << 30)
    shown = F.transform(turns, lambda t: F.struct(
        _unescaped_role(F.substring_index(t, "\n", 1)).alias("role"),
        F.regexp_extract(t, r"(?s)^[^\n]*\n(.*)<\|im_end\|>\n$", 1).alias("body")))
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("text"))

    def walk(so_far: Column, t: Column) -> Column:
        n = count(t["body"])
        own = F.slice("attachments", so_far["at"], n)
        return F.struct((so_far["at"] + n).alias("at"), F.concat(
            so_far["text"], t["role"], F.lit("\n"), _restored(t["body"], own), F.lit("\n")).alias("text"))

    plain = F.array_join(F.transform(shown, lambda t: F.concat(
        t["role"], F.lit("\n"), unescaped(t["body"]), F.lit("\n"))), "")
    masked = F.transform("loss", lambda s: F.substring(F.col("formatted"), s["start"] + 1, s["length"]))
    before = lambda s: count(F.substring(F.col("formatted"), F.lit(1), s["start"]))
    masked_some = F.transform("loss", lambda s: _restored(
        F.substring(F.col("formatted"), s["start"] + 1, s["length"]),
        F.slice("attachments", before(s) + 1,
                count(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))))
    return records.select(
        "conv_id", "block", F.size(turns).cast("bigint").alias("n_turns"),
        F.when(some, F.aggregate(shown, start, walk, lambda s: s["text"])).otherwise(plain).alias("turns_text"),
        F.when(some, F.array_join(masked_some, ""))
         .otherwise(F.array_join(F.transform(masked, unescaped), "")).alias("loss_text"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("media_tokens"))


def chat_digests(conversations: DataFrame) -> DataFrame:
    """Format conversations of plain texts and digest what can be read back."""
    typed = conversations.select("conv_id", "turn", "role", parts_of(whole("text")).alias("parts"))
    back = read_back(format_chats(typed))
    joined = (back.groupBy("conv_id")
                  .agg(F.sum("n_turns").alias("n_turns"), F.sum("formatted_chars").alias("formatted_chars"),
                       F.sum("media_tokens").alias("media_tokens"),
                       F.array_sort(F.collect_list(F.struct("block", "turns_text", "loss_text"))).alias("blocks")))
    text = lambda name: F.array_join(F.transform("blocks", lambda b: b[name]), "")
    digest = lambda name: F.sha2(text(name).cast("binary"), 256)
    return joined.select(
        "conv_id", "n_turns", digest("turns_text").alias("turns_sha256"),
        F.length(text("loss_text")).cast("bigint").alias("loss_chars"),
        digest("loss_text").alias("loss_sha256"), "formatted_chars", "media_tokens")
