"""Chat formatting with typed content parts.

A turn is a list of parts: text, image, audio or document. Visiting a
conversation in order writes texts, with control strings escaped, between turn
marks, and a numbered placeholder for every other part, whose reference and
expanded token count are recorded. The loss mask is the lengths of the runs of
the output that it covers and leaves out, so a reader needs no positions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import col

#: Tokens that stand for one unit of a part: a tile of an image, a second of sound, a page.
TOKENS = {"image": 256, "audio": 25, "document": 512}
PART = "struct<kind string, text string, ref string, units long>"
#: What may not occur in texts, and what stands for it. The order of escaping; unescaping goes backwards.
ESCAPES = (("\\", "\\s"), ("<", "\\l"), (">", "\\g"))
_OPEN, _CLOSE, _MARK = "<turn:", "</turn>", "<[^<>]*>"


def escape(text: Column) -> Column:
    """The text without ``<`` and ``>``, reversibly; NULL is empty."""
    text = F.coalesce(text, F.lit(""))
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    """A turn that is one text."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("units")))


def _is_text(part: Column) -> Column:
    """A part without a kind is none."""
    return F.coalesce(part["kind"] == "text", F.lit(False))


def _visit(part: Column, place: Column) -> Column:
    """What a part becomes: its escaped text, or a placeholder with its number in the turn and its kind.

    All placeholders begin with a mark of their own, so no kind can write a turn's end.
    """
    placeholder = F.concat(F.lit("<part:"), (place + 1).cast("string"), F.lit(":"), escape(part["kind"]), F.lit(">"))
    return F.when(_is_text(part), escape(part["text"])).otherwise(placeholder)


def format_chats(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
                 trained: str = "assistant", tokens: Mapping[str, int] = TOKENS) -> DataFrame:
    """One row for each conversation: ``formatted``, ``runs``, ``attachments``, ``placeholder_tokens``.

    ``runs`` has for each turn the (chars, loss) that ``formatted`` is made of, in
    code points: the texts of the turns of ``trained`` have loss. ``attachments`` are (turn, number,
    kind, ref, tokens) in the order of their placeholders, ``number`` being the
    part's place in its turn, which its placeholder names; a kind that ``tokens``
    doesn't have, NULL among them, or a part without units, counts one token. Turns are ordered
    by ``turn``; equal ones by role and content, NULLs first. A NULL role or text
    is empty, a turn without parts too. Repeated rows are turns of their own.
    NULL conversations are one. An empty table gives no rows.
    """
    body = F.coalesce(col(parts), F.expr(f"cast(array() as array<{PART}>)"))
    units = F.create_map(*[F.lit(x) for kv in tokens.items() for x in kv])

    def attachment(numbered: Column) -> Column:
        part = numbered["part"]
        size = F.coalesce(part["units"] * F.element_at(units, F.coalesce(part["kind"], F.lit(""))), F.lit(1)).cast("long")
        return F.struct(numbered["number"].alias("number"), part["kind"].alias("kind"), part["ref"].alias("ref"), size.alias("tokens"))

    written = turns.select(
        col(conversation).alias("conv_id"), col(turn).alias("turn"),
        F.concat(F.lit(_OPEN), escape(col(role)), F.lit(">")).alias("head"),
        F.coalesce(col(role) == trained, F.lit(False)).alias("loss"),
        F.transform(body, lambda p, i: F.struct(_visit(p, i).alias("out"), _is_text(p).alias("is_text"))).alias("outs"),
        F.transform(F.filter(F.transform(body, lambda p, i: F.struct(p.alias("part"), (i + 1).alias("number"))), lambda n: ~_is_text(n["part"])), attachment).alias("files"),
    )
    gathered = written.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "head", "outs", "loss", "files"))).alias("turns"))
    runs = F.transform("turns", lambda t: F.concat(
        F.array(_run(F.length(t["head"]), F.lit(False))),
        F.transform(t["outs"], lambda o: _run(F.length(o["out"]), t["loss"] & o["is_text"])),
        F.array(_run(F.lit(len(_CLOSE)), F.lit(False))),
    ))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], F.array_join(F.transform(t["outs"], lambda o: o["out"]), ""), F.lit(_CLOSE))), "")
    files = F.flatten(F.transform("turns", lambda t: F.transform(t["files"], lambda f: F.struct(t["turn"].alias("turn"), f["number"].alias("number"), f["kind"].alias("kind"), f["ref"].alias("ref"), f["tokens"].alias("tokens")))))
    out = gathered.select("conv_id", formatted.alias("formatted"), runs.alias("runs"), files.alias("attachments"))
    total = F.aggregate("attachments", F.lit(0).cast("long"), lambda n, f: n + f["tokens"])
    return out.withColumn("placeholder_tokens", total)


def _run(chars: Column, loss: Column) -> Column:
    return F.struct(chars.cast("int").alias("chars"), loss.alias("loss"))


def read_back(chats: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted_chars) from ``formatted`` and ``runs`` alone.

    ``turns`` are (role, text), texts unescaped and placeholders left out;
    ``loss_text`` is all that the mask covers, unescaped.
    """
    pieces = F.split("formatted", _CLOSE)
    rows = chats.select("conv_id", F.length("formatted").alias("formatted_chars"), F.slice(pieces, 1, F.size(pieces) - 1).alias("pieces"), "runs")
    turns = F.transform("pieces", lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(len(_OPEN) + 1)), ">", 1)).alias("role"),
        unescape(F.regexp_replace(F.substr(p, F.instr(p, ">") + 1), _MARK, "")).alias("text"),
    ))

    def covered(piece: Column, runs: Column) -> Column:
        start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
        return F.aggregate(runs, start, lambda a, r: F.struct(
            (a["at"] + r["chars"]).alias("at"),
            F.when(r["loss"], F.concat(a["out"], F.substr(piece, a["at"], r["chars"]))).otherwise(a["out"]).alias("out"),
        ), lambda a: a["out"])

    loss = unescape(F.array_join(F.zip_with("pieces", "runs", covered), ""))
    return rows.select("conv_id", turns.alias("turns"), loss.alias("loss_text"), "formatted_chars")
