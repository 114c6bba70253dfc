"""Chat formatting by rendering successive prefixes of a conversation with a template taken as a black box."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import column

Turns = list[tuple[str, str]]
Template = Callable[[Turns], str]

# The control strings of the template.
CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|/?TURN\]|TURN )")
ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\]|/?TURN\]|TURN )")

#: Turns that stay in the window when it is cut, and how many it may have before.
CONTEXT_TURNS = 4
WINDOW_TURNS = 16
_PROBE = "\ue000"


def escape(text: str) -> str:
    """Put a backslash into every control string; one that has backslashes there already gets one more."""
    return CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def turn_template(turns: Turns) -> str:
    """User turns as ``<s>[INST] … [/INST]``, assistant turns as ``<s> … </s>``, any other role named in ``[TURN role]``."""
    out = []
    for role, text in turns:
        if role == "user":
            out.append(f"<s>[INST] {escape(text)} [/INST]")
        elif role == "assistant":
            out.append(f"<s> {escape(text)}</s>")
        else:
            out.append(f"[TURN {_quoted(role)}]{escape(text)}[/TURN]")
    return "".join(out)


def _quoted(role: str) -> str:
    return role.replace("%", "%25").replace("]", "%5D")


def read_turn(segment: str) -> tuple[str, str]:
    """Role and text of one turn as :func:`turn_template` wrote it."""
    if segment.startswith("<s>[INST] ") and segment.endswith(" [/INST]"):
        return "user", unescape(segment[10:-8])
    if segment.startswith("<s> ") and segment.endswith("</s>"):
        return "assistant", unescape(segment[4:-4])
    if segment.startswith("[TURN ") and segment.endswith("[/TURN]"):
        role, text = segment[6:-7].split("]", 1)
        return role.replace("%5D", "]").replace("%25", "%"), unescape(text)
    raise ValueError("not a turn of this template")


class Spans:
    """Where each turn of one conversation lies in what the template makes of all.

    The template is called with growing prefixes; what a prefix adds to the one before is the turn's span. Rendering the same prefix with a
    probe as the last text shows where in the span the text stands. So that long conversations take linear time,
    only the last turns of a ``turn_local`` template are rendered: the window is cut when it is long, and only if the turn at
    hand comes out alike with and without the turns cut off. A template for which it does not, or that once rewrote
    earlier turns, keeps its whole prefix from then on; one that is not ``turn_local`` always does.
    """

    def __init__(self, template: Template, turn_local: bool = True):
        self.template, self.turns, self.before, self.length, self.frozen = template, [], None, 0, not turn_local

    def add(self, role: str, text: str) -> tuple[str, int, int, int, bool]:
        """The span's text, its start, where the turn's text begins and ends in it, and whether the template changed earlier turns."""
        if self.before is None:
            self.before = self.template([])
            self.length = len(self.before)
        now = self.template([*self.turns, (role, text)])
        rewrites = not now.startswith(self.before)
        same = _common(self.before, now) if rewrites else len(self.before)
        start = self.length - (len(self.before) - same)
        span = now[same:]
        probe = self.template([*self.turns, (role, _PROBE)])[same:]
        at = probe.find(_PROBE)
        begin, tail = (at, len(probe) - at - len(_PROBE)) if at >= 0 else (0, len(span))
        self.turns.append((role, text))
        self.length = start + len(span)
        self.frozen = self.frozen or rewrites
        if len(self.turns) > WINDOW_TURNS and not self.frozen:
            short = self.turns[-CONTEXT_TURNS:]
            base, full = self.template(short[:-1]), self.template(short)
            if full.startswith(base) and full[len(base) :] == span:
                self.turns, now = short, full
            else:
                self.frozen = True
        self.before = now
        return span, start, begin, max(begin, len(span) - tail), rewrites


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


def format_turns(turns: DataFrame, template: Template = turn_template, turn_local: bool | None = None) -> DataFrame:
    """One row per turn: conv_id, number (from 0), role, span, start, text_begin, text_end, loss, rewrites.

    The spans of a conversation on end are the formatted text; ``start`` is the span's place in it, ``text_begin`` and ``text_end`` the place of the escaped text
    in the span, in code points. ``loss``: an assistant's text, which a model learns. ``rewrites``: the template changed what it had
    written for earlier turns; ``start`` then lies where the change begins.

    ``turn_local``: the caller declares that what the template makes of a turn depends on no turn more than ``CONTEXT_TURNS - 1`` before it and that no
    later turn changes it. Undeclared, only :func:`turn_template` counts as such. Any other template gets the whole prefix of every turn,
    which takes quadratic time and holds one conversation in memory.

    The rows are dealt by conversation and sorted; for a turn-local template tasks walk through them with one window of turns in hand, so a
    conversation of any length needs bounded memory and goes to disk where sorting needs it. Order within a conversation: turn (NULL first), role, text. NULL role and
    NULL text: empty. NULL conv_id: a conversation of its own. Repeated rows: turns of their own. Empty table: no rows. Other columns are not read.
    """
    narrow = turns.select(
        column(turns, "conv_id").alias("conv_id"),
        column(turns, "turn").alias("turn"),
        F.coalesce(column(turns, "role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(column(turns, "text").cast("string"), F.lit("")).alias("text"),
    )
    kind = narrow.schema["conv_id"].dataType.simpleString()
    local = template is turn_template if turn_local is None else turn_local
    dealt = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    dealt = dealt.withColumn("conv_null", F.col("conv_id").isNull()).withColumn("conv_text", F.col("conv_id").cast("string"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, spans, number = None, None, 0
        for batch in batches:
            out = []
            for role, text, null, name in zip(batch["role"], batch["text"], batch["conv_null"], batch["conv_text"], strict=True):
                key = None if null else name
                if spans is None or key != current:
                    current, spans, number = key, Spans(template, local), 0
                span, start, begin, end, rewrites = spans.add(role, text)
                out.append((number, role, span, start, begin, end, role == "assistant", rewrites))
                number += 1
            made = pd.DataFrame(out, columns=["number", "role", "span", "start", "text_begin", "text_end", "loss", "rewrites"])
            made.insert(0, "conv_id", batch["conv_text"].to_numpy())
            yield made

    made = dealt.mapInPandas(run, "conv_id string, number bigint, role string, span string, start bigint, text_begin bigint, text_end bigint, loss boolean, rewrites boolean")
    return made.withColumn("conv_id", F.col("conv_id").cast(kind))


def digest(formatted: DataFrame) -> DataFrame:
    """Read the turns back from :func:`format_turns`: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A hash over a whole conversation has to see its turns in order: the rows, already dealt by
    conversation and in order, go through one hash state per conversation without another shuffle.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_rewrites"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: list | None = None

        def closed(state: list) -> tuple:
            name, n, turns, loss, loss_chars, chars, rewrites = state
            return name, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, rewrites

        for batch in batches:
            out = []
            for name, number, span, start, begin, end, learn, rewrites in zip(*(batch[c] for c in ("conv_text", "number", "span", "start", "text_begin", "text_end", "loss", "rewrites")), strict=True):
                if number == 0:
                    if state is not None:
                        out.append(closed(state))
                    state = [name, 0, hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                role, text = read_turn(span)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                if learn:
                    learned = unescape(span[begin:end])
                    state[3].update(learned.encode())
                    state[4] += len(learned)
                state[5] = start + len(span)
                state[6] += bool(rewrites)
            yield pd.DataFrame(out, columns=columns)
        if state is not None:
            yield pd.DataFrame([closed(state)], columns=columns)

    named = formatted.withColumn("conv_text", F.col("conv_id").cast("string"))
    made = named.mapInPandas(run, "conv_id string, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_rewrites bigint")
    return made.withColumn("conv_id", F.col("conv_id").cast(kind))
