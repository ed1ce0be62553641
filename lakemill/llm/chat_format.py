"""Chat formatting by incremental rendering of a black-box template.

A template is any function from turns to text. Successive prefixes of a
conversation are rendered and consecutive outputs compared: what is new is the
turn's own piece. Where the text lies inside the piece is found by rendering
the prefix again with one-letter texts: up to the first difference it is the
turn's head, what follows the letter is its tail. An output that does not begin
with the one before it comes from a template that rewrites history; such a
conversation is flagged and its pieces carry no loss spans.

Rows stream through a task sorted by conversation. A template may look at any
earlier turn, so prefixes are whole: a conversation of n turns costs n renders of
up to n turns. A template whose pieces depend on the last w turns only says so by
its attribute ``window`` = w; its prefixes start there, and time is in proportion.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lakemill.llm.common import column

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

#: What a model reads as structure; in a text it must not stand as it is.
CONTROLS = ("<|begin|>", "<|turn|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]")
BEGIN, TURN, END = CONTROLS[:3]


def _pattern(backslashes: str) -> re.Pattern:
    """A control string, with backslashes after its first character."""
    firsts = "".join(sorted({re.escape(c[0]) for c in CONTROLS}))
    return re.compile(f"([{firsts}]){backslashes}(?={'|'.join(re.escape(c[1:]) for c in CONTROLS)})")


ESCAPE, UNESCAPE = _pattern(r"(\\*)"), _pattern(r"\\(\\*)")


def escape(text: str) -> str:
    """One backslash more after the first character of what would be, or looks like an escaped, control string."""
    return ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1\2", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def turn_template(turns: list[Turn]) -> str:
    """The standard template: a begin mark, then role and text between a turn mark and an end mark."""
    return BEGIN + "".join(f"{TURN}{escape_role(role)}\n{escape(text)}{END}\n" for role, text in turns)


#: A piece holds its own turn and nothing of others; one turn before it tells it from the first.
turn_template.window = 1


PIECE = re.compile(re.escape(TURN) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)


def parse(formatted: str) -> list[Turn]:
    """The turns of a text by the standard template."""
    return [(unescape_role(role), unescape(text)) for role, text in PIECE.findall(formatted)]


def common_prefix(a: str, b: str) -> int:
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return i
    return min(len(a), len(b))


def step(template: Template, context: list[Turn], turn: Turn, before: str) -> tuple[str, int, int, bool, str]:
    """(piece, start and end of the text in it, rewrites, the whole output) of ``turn`` after ``context``, rendered ``before``."""
    role, _ = turn
    whole = template([*context, turn])
    if not whole.startswith(before):
        return whole, 0, 0, True, whole
    probes = [template([*context, (role, letter)]) for letter in "xy"]
    head = common_prefix(*probes)
    tail = len(probes[0]) - head - 1
    fits = (
        head >= len(before)
        and len(whole) >= head + tail
        and whole[:head] == probes[0][:head]
        and probes[0][head + 1 :] == probes[1][head + 1 :]
        and whole[len(whole) - tail :] == probes[0][head + 1 :]
    )
    if not fits:
        return whole[len(before) :], 0, 0, True, whole
    return whole[len(before) :], head - len(before), len(whole) - tail - len(before), False, whole


def format_chats(
    turns: DataFrame, template: Template = turn_template, trained: tuple[str, ...] = ("assistant",), context: int | None = None,
    conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per turn, in order within its conversation and partition.

    conv, position, piece (the conversation's text is its pieces joined), start
    (code points before the piece), loss_start and loss_end (within the piece;
    equal if nothing is learned) and rewrites. conv is the conversation as text.

    Every turn is rendered after all turns before it, or after the last
    ``context`` ones if that, or the template's ``window``, says that no piece
    depends on more. Where no turn rewrites, the pieces joined are the template's
    output for all turns.

    Order is by turn, then role and text, so ties and repeated rows have a
    defined place and all are formatted; a null turn comes first. Null role and
    text are empty. Null conversations are one conversation. Other columns are
    left out; an empty table has no rows.
    """
    lean = turns.select(
        column(conv_col).cast("string").alias("conv"),
        column(turn_col).alias("turn"),
        F.coalesce(column(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"),
    )
    placed = lean.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    columns = ["conv", "position", "piece", "start", "loss_start", "loss_end", "rewrites"]
    # Read on the driver: a function's attributes need not travel with it.
    context = getattr(template, "window", None) if context is None else context

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, seen, position, size, before = None, [], 0, 0, ""
        started = False
        for batch in batches:
            out = []
            for conv, role, text in zip(batch["conv"], batch["role"], batch["text"]):
                if not started or conv != now:
                    started, now, seen, position, size, before = True, conv, [], 0, 0, ""
                if context is not None and position:
                    seen = seen[max(0, len(seen) - context) :]
                    before = template(seen)
                piece, a, b, rewrites, before = step(template, seen, (role, text), before)
                if role not in trained:
                    b = a
                out.append((conv, position, piece, size, a, b, rewrites))
                seen.append((role, text))
                position, size = position + 1, size + len(piece)
            yield pd.DataFrame(out, columns=columns)

    return placed.select("conv", "role", "text").mapInPandas(
        run,
        "conv string, position long, piece string, start long, loss_start long, loss_end long, rewrites boolean",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id (as text), n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, rewrites of each conversation.

    All is parsed from the formatted text, piece after piece as ``format_chats``
    leaves them, with running digests. ``rewrites``: some turn was.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None

        def closed(s: dict) -> tuple:
            return (s["conv"], s["n"], s["turns"].hexdigest(), s["loss_n"], s["loss"].hexdigest(), s["chars"], s["rewrites"])

        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.position == 0:
                    if state:
                        out.append(closed(state))
                    state = {"conv": row.conv, "n": 0, "turns": hashlib.sha256(), "loss_n": 0, "loss": hashlib.sha256(), "chars": 0, "rewrites": False}
                for role, text in parse(row.piece):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{text}\n".encode())
                learned = unescape(row.piece[row.loss_start : row.loss_end])
                state["loss_n"] += len(learned)
                state["loss"].update(learned.encode())
                state["chars"] += len(row.piece)
                state["rewrites"] |= bool(row.rewrites)
            yield pd.DataFrame(out, columns=columns)
        if state:
            yield pd.DataFrame([closed(state)], columns=columns)

    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"]
    return formatted.mapInPandas(
        run,
        "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, rewrites boolean",
    )
