"""Chat rendering (FN-11..13) as Column expressions with marker parameters.

A turn renders as ``<start>role\\ncontent<end>\\n``. Rendering is per row: a multi-turn
conversation is emitted as one segment per turn (concatenate in turn order at the sink), so a
long conversation never has to be gathered into one task; turns that already are an array of
one row render to one text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelgraph import constants as K
from labelgraph.functions.text import col_


def turn(role: str, content: Column | str, start: str = K.TURN_START, end: str = K.TURN_END, newline_after: bool = True) -> Column:
    """One rendered turn with a literal role name."""
    parts = [F.lit(start), F.lit(role), F.lit("\n"), col_(content), F.lit(end)]
    if newline_after:
        parts.append(F.lit("\n"))
    return F.concat(*parts)


def two_turn_text(instruction: Column | str, output: Column | str, start: str = K.TURN_START, end: str = K.TURN_END) -> Column:
    """Stage-1 text: user then assistant, no system turn, no trailing newline."""
    return F.concat(turn("user", instruction, start, end), turn("assistant", output, start, end, newline_after=False))


def generation_prompt(start: str = K.TURN_START) -> Column:
    return F.lit(f"{start}assistant\n")


def training_layout(system_prompt: Column, answer: Column | str, image: str = K.IMAGE_PLACEHOLDER) -> Column:
    """Stage-2 training text: system = prompt, user = image placeholder, assistant = answer."""
    return F.concat(turn("system", system_prompt), turn("user", F.lit(image)), turn("assistant", answer))


def inference_layout(prompt: Column | str, image: str = K.IMAGE_PLACEHOLDER, system: str = K.DEFAULT_SYSTEM) -> Column:
    """Inference text: generic system line, user = image + prompt, open assistant turn."""
    user = F.concat(F.lit(image), col_(prompt))
    return F.concat(turn("system", F.lit(system)), turn("user", user), generation_prompt())


def render_turns(turns: Column | str) -> Column:
    """All turns of one row's ``array<struct<from, value>>`` as one text, roles in model names.

    The array is the row's own data, so nothing is gathered.
    """

    def one(t: Column) -> Column:
        role = F.when(t["from"] == F.lit(K.HUMAN_ROLE), "user").when(t["from"] == F.lit(K.ASSISTANT_ROLE), "assistant").otherwise(t["from"])
        return F.concat(F.lit(K.TURN_START), role, F.lit("\n"), t["value"], F.lit(K.TURN_END), F.lit("\n"))

    return F.array_join(F.transform(col_(turns), one), "")


def turn_segment(role_col: str, content_col: str) -> Column:
    """One rendered turn from role/content columns (N-turn rendering, one row per turn)."""
    return F.concat(F.lit(K.TURN_START), F.col(role_col), F.lit("\n"), F.col(content_col), F.lit(K.TURN_END), F.lit("\n"))
