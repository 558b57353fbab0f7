"""Operator 4: chat formatting by incremental black-box rendering.

A template is any function from a list of turns to text. It is rendered for
every prefix of a conversation; where a render extends the one before, the
added text is that turn's span. A render that does not start with the one
before shows a template that rewrites history. Nothing about the template's
inside is used, so spans and loss masks hold for any template.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: control strings of the built-in template and of common others
TURN, BODY, STOP = "<|turn|>", "<|text|>", "<|stop|>"
CONTROLS = [TURN, BODY, STOP, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
            "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
# --------------------------------------------------------------------------------
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    r"""Break control strings reversibly: \ becomes \\, and a single \ goes behind
    the first character of each control string."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def tagged(turns: list[tuple[str, str]]) -> str:
    """The built-in template: one marked, escaped block per turn."""
    return "".join(f"{TURN}{escape(role)}{BODY}{escape(text)}{STOP}\n" for role, text in turns)


@dataclass
class Rendered:
    text: str
    spans: list[tuple[int, int]]          # of each turn in ``text``
    rewrites: bool                        # some render did not extend the one before


def render(template: Callable[[list[tuple[str, str]]], str],
           turns: list[tuple[str, str]]) -> Rendered:
    """Render successive prefixes and compare each with the one before.

    Where history is rewritten, a turn's span starts at the end of the longest
    common prefix of the two renders, and earlier spans are cut back to it.
    """
    before, spans, rewrites = template([]), [], False
    for n in range(1, len(turns) + 1):
        now = template(turns[:n])
        at = len(before)
        if not now.startswith(before):
            rewrites = True
            low, high = 0, min(len(before), len(now))
            while low < high:             # longest common prefix, by halving
                mid = (low + high + 1) // 2
                low, high = (mid, high) if now.startswith(before[:mid]) else (low, mid - 1)
            at = low
            spans = [(min(a, at), min(b, at)) for a, b in spans]
        spans.append((at, len(now)))
        before = now
    return Rendered(before, spans, rewrites)


def read_back(text: str, span: tuple[int, int]) -> tuple[str, str, int, int]:
    """Role, text and the text's place of one span of the built-in template."""
    block = text[span[0]:span[1]]
    body = block.index(BODY) + len(BODY)
    stop = block.index(STOP, body)
    role = unescape(block[len(TURN):body - len(BODY)])
    return role, unescape(block[body:stop]), span[0] + body, span[0] + stop


def format_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Format every conversation of (conv_id, turn, role, text).

    Returns conv_id, ``formatted`` text, ``loss_spans`` (code point ranges of
    the trained role's texts in it), ``n_turns``, ``turns_sha256`` over role,
    newline, text, newline of each turn read back from the output,
    ``loss_chars`` and ``loss_sha256`` of the unescaped text under the loss
    mask, ``formatted_chars`` and ``rewrites_history``.

    Turns are ordered by turn (nulls first), then role, then text; ties and
    repeated rows are all kept. A null role or text counts as empty; rows with
    a null conv_id form one conversation. One conversation is one output row
    and so must fit a task; prefixes are rendered one at a time. An empty
    table gives an empty result; other columns are not read.
    """
    empty = F.lit("")
    grouped = (turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("turn").alias("at"), F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text")))).alias("turns")))

    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("formatted", "loss_spans", "n_turns", "turns_sha256",
                                   "loss_chars", "loss_sha256", "formatted_chars",
                                   "rewrites_history")}
            for listed in batch.column(1).to_pylist():
                made = render(tagged, [(t["role"], t["text"]) for t in listed])
                whole, loss, chars, spans = hashlib.sha256(), hashlib.sha256(), 0, []
                for span in made.spans:
                    role, text, a, b = read_back(made.text, span)
                    whole.update(f"{role}\n{text}\n".encode())
                    if role == trained_role:
                        loss.update(text.encode())
                        chars += len(text)
                        spans.append([a, b])
                for k, v in zip(out, (made.text, spans, len(made.spans), whole.hexdigest(), chars,
                                      loss.hexdigest(), len(made.text), made.rewrites)):
                    out[k].append(v)
            kinds = [pa.string(), pa.list_(pa.list_(pa.int64())), pa.int64(), pa.string(),
                     pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(v, t) for v, t in zip(out.values(), kinds)],
                names=["conv_id", *out])

    kind = turns.schema["conv_id"].dataType.simpleString()
    return grouped.mapInArrow(run, f"""conv_id {kind}, formatted string,
        loss_spans array<array<bigint>>, n_turns bigint, turns_sha256 string, loss_chars bigint,
        loss_sha256 string, formatted_chars bigint, rewrites_history boolean""")


def oracle(extra: list[tuple[int, int, str, str]]) -> str:
    """DuckDB SQL for the digests over ``conversations`` and some extra rows."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    pattern = quote("|".join([r"\\", *map(re.escape, CONTROLS)]))
    rows = ", ".join(f"({c}, {t}, {quote(r)}, {quote(x)})" for c, t, r, x in extra)
    marks = len(TURN) + len(BODY) + len(STOP) + 1
    size = lambda c: f"length({c}) + len(regexp_extract_all({c}, {pattern}))"
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {rows}) extra(conv_id, turn, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
    AS loss_sha256,
  sum({marks} + {size('role')} + {size('text')})::BIGINT AS formatted_chars,
  false AS rewrites_history
FROM t GROUP BY conv_id
"""
