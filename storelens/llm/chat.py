r"""Chat formatting as a relational job, in Spark expressions only.

The turns of a conversation are gathered as structs, sorted, adjacent turns of one role are merged by an
array aggregation, and the blocks are joined into one text:

    ### user
    first text<|part|>second text<|end|>
    ### assistant
    answer<|end|>

Control strings inside roles and texts are broken up by a backslash after their first character, and a
backslash is doubled, so the formatted text has each control string only where the template puts it
and can be read back exactly. ``loss`` lists the stretches of the formatted text that assistant texts
fill (start and length in code points, as escaped): the loss mask.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.shared import only

HEAD, PART, END = "### ", "<|part|>", "<|end|>"
ASSISTANT = "assistant"
# Strings that may not occur inside a text, escaped after their first character.
CONTROLS = (HEAD, PART, END)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _escape(value: str) -> str:
    made = f"replace({value}, {_literal(chr(92))}, {_literal(chr(92) * 2)})"
    for control in CONTROLS:
        made = f"replace({made}, {_literal(control)}, {_literal(control[0] + chr(92) + control[1:])})"
    return made


def _unescape(value: str) -> str:
    r"""Each backslash gives way to the character after it, from left to right."""
    return f"regexp_replace({value}, {_literal(r'(?s)\\(.)')}, '$1')"


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss`` for each conversation of ``turns(conv_id, turn, role, text)``.

    Turns are ordered by ``turn``, ties by role and text; a null turn comes first, null roles and texts
    are empty, rows without a conversation id form one conversation. Repeated rows are turns of their
    own. A conversation is one row, so its length is bounded by what one text can hold. Other columns
    are ignored; an empty table gives no conversation.
    """
    rows = only(turns, ["conv_id", "turn", "role", "text"]).select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t")
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # A turn with the role of the one before continues its block; any other closes it and opens the next.
    head = f"concat({_literal(HEAD)}, replace({_escape('t.role')}, '\\n', {_literal(chr(92) + chr(10))}), '\\n')"
    before = f"""case when i = 0 then {head} when get(turns, i - 1).role = t.role then {_literal(PART)}
        else concat({_literal(END)}, '\\n', {head}) end"""
    parts = f"transform(turns, (t, i) -> named_struct('before', {before}, 'text', {_escape('t.text')}, 'on', t.role = {_literal(ASSISTANT)}))"
    # The stretches under the mask, by a running offset.
    spans = """aggregate(parts, named_struct('at', 0, 'spans', cast(array() as array<struct<start: int, length: int>>)), (acc, p) -> named_struct(
        'at', acc.at + length(p.before) + length(p.text), 'spans', case when p.on then
        concat(acc.spans, array(named_struct('start', acc.at + length(p.before), 'length', length(p.text)))) else acc.spans end), acc -> acc.spans)"""
    return sorted_turns.select("conv_id", F.expr(parts).alias("parts")).select(
        "conv_id", F.expr(f"concat(array_join(transform(parts, p -> concat(p.before, p.text)), ''), {_literal(END)})").alias("formatted"),
        F.expr(spans).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, formatted, turns, loss_texts`` out of ``format_conversations``: the turns as they were
    given, in order, and the texts under the loss mask."""
    # The last piece loses its end mark first, so that every mark left stands between two blocks.
    pieces = f"split(substring(formatted, 1, length(formatted) - {len(END)}), {_literal('<[|]end[|]>' + chr(92) + 'n')})"
    # The first line break that is not escaped ends the head.
    role = _unescape(f"substring(regexp_extract(p, {_literal(r'(?s)\A### (?:[^\\\n]++|\\.)*+')}, 0), {len(HEAD) + 1})")
    rest = f"substring(p, length(regexp_extract(p, {_literal(r'(?s)\A### (?:[^\\\n]++|\\.)*+')}, 0)) + 2)"
    texts = f"transform(split({rest}, {_literal('<[|]part[|]>')}), x -> named_struct('role', {role}, 'text', {_unescape('x')}))"
    return formatted.select(
        "conv_id", "formatted", F.expr(f"flatten(transform({pieces}, p -> {texts}))").alias("turns"),
        F.expr(f"transform(loss, s -> {_unescape('substring(formatted, s.start + 1, s.length)')})").alias("loss_texts"),
    )
