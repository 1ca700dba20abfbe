"""Chat formatting with typed content parts.

A turn is a role and a list of parts (text, image, audio, document).  A
visitor flattens the parts in order: text is escaped, an attachment becomes
a numbered placeholder, and its reference and the tokens it stands for are
recorded.  A formatted conversation is the concatenation of its turns:

    <turn role="assistant">
    escaped content
    </turn>

``<`` and the backslash are escaped in texts and roles (in roles also the
quote and the line feed), so no text can hold a control string, and
``read_back`` gets every text again.  The loss mask is the content of
assistant turns.

Turns are dealt out by conversation, sorted, and streamed: a task holds one
batch of turns and, for the conversation at hand, a few numbers, so a
conversation may have any number of turns.

Cases: null text, role and parts count as empty; null conversation ids form
one conversation; turns with equal numbers stand in order of role, then
text; repeated rows are repeated turns; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

ESCAPES = {"\\": "\\\\", "<": "\\l", '"': "\\q", "\n": "\\n"}
BACK = {v[1]: k for k, v in ESCAPES.items()}
TURN = re.compile(r'<turn role="([^"]*)">\n(.*)\n</turn>\n', re.DOTALL)
LOSS_ROLE = "assistant"
PARTS = "array<struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>>"
ATTACHMENTS = "array<struct<number:int,type:string,uri:string,tokens:long>>"
FORMATTED = f"position long, role string, rendered string, loss_start long, loss_end long, tokens long, attachments {ATTACHMENTS}"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l")


def escape_role(role: str) -> str:
    return escape(role).replace('"', "\\q").replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: BACK[m[1]], text)


class Flatten:
    """Visits the parts of a conversation's turns in order."""

    def __init__(self, patch: int = 28, audio_rate: float = 25.0, page_tokens: int = 512):
        self.patch, self.audio_rate, self.page_tokens = patch, audio_rate, page_tokens
        self.number = 0

    def turn(self, parts: list[dict]) -> tuple[str, list[dict]]:
        """Content string and attachments of a turn."""
        self.found: list[dict] = []
        return "".join(getattr(self, f"visit_{p.get('type') or 'text'}", self.visit_other)(p) for p in parts), self.found

    def visit_text(self, part: dict) -> str:
        return escape(part.get("text") or "")

    def visit_image(self, part: dict) -> str:
        side = lambda n: math.ceil((n or 0) / self.patch)
        return self._attach(part, side(part.get("width")) * side(part.get("height")))

    def visit_audio(self, part: dict) -> str:
        return self._attach(part, math.ceil((part.get("seconds") or 0) * self.audio_rate))

    def visit_document(self, part: dict) -> str:
        return self._attach(part, (part.get("pages") or 0) * self.page_tokens)

    def visit_other(self, part: dict) -> str:
        raise ValueError(f"unknown part type {part['type']!r}")

    def _attach(self, part: dict, tokens: int) -> str:
        self.number += 1
        self.found.append({"number": self.number, "type": part["type"], "uri": part.get("uri"), "tokens": tokens})
        return f"<{part['type']} {self.number}/>"


def _render(role: str, content: str) -> tuple[str, int | None, int | None]:
    head = f'<turn role="{escape_role(role)}">\n'
    loss = (len(head), len(head) + len(content)) if role == LOSS_ROLE else (None, None)
    return f"{head}{content}\n</turn>\n", *loss


def _ordered(df: DataFrame, id_col: str, by: list[str]) -> DataFrame:
    return df.repartition(F.col(id_col)).sortWithinPartitions(id_col, *by)


def format_turns(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    parts_col: str | None = None,
    **visitor,
) -> DataFrame:
    """One row per turn in order: conv_id, position, role, rendered, loss_start, loss_end, tokens, attachments.

    ``parts_col`` names a column of type ``PARTS``; without it each turn is
    one text part.  The loss span counts code points of ``rendered``;
    ``tokens`` is what the turn's attachments expand to.
    """
    parts = F.col(parts_col) if parts_col else F.lit(None).cast(PARTS)
    rows = turns.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"), parts.alias("parts")
    )
    kind = rows.schema["conv_id"].dataType.simpleString()
    ship(turns.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, flat, n = object(), None, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if flat is None or row["conv_id"] != at:
                    at, flat, n = row["conv_id"], Flatten(**visitor), 0
                listed = row["parts"] if row["parts"] is not None else [{"type": "text", "text": row["text"]}]
                content, found = flat.turn(listed)
                role = row["role"] or ""
                text, start, end = _render(role, content)
                out.append(
                    {"conv_id": at, "position": n, "role": role, "rendered": text, "loss_start": start, "loss_end": end, "tokens": sum(a["tokens"] for a in found), "attachments": found}
                )
                n += 1
            yield pa.RecordBatch.from_pylist(out, schema=_formatted_schema(batch.schema.field("conv_id").type))

    return _ordered(rows, "conv_id", ["turn", "role", "text"]).mapInArrow(run, f"conv_id {kind}, {FORMATTED}")


def _formatted_schema(id_type: pa.DataType) -> pa.Schema:
    found = pa.struct([("number", pa.int32()), ("type", pa.string()), ("uri", pa.string()), ("tokens", pa.int64())])
    longs = {c: pa.int64() for c in ("loss_start", "loss_end", "tokens")}
    return pa.schema(
        [("conv_id", id_type), ("position", pa.int64()), ("role", pa.string()), ("rendered", pa.string()), *longs.items(), ("attachments", pa.list_(found))]
    )


class _Digest:
    """What is read back from a formatted conversation, turn by turn."""

    def __init__(self, conv_id):
        self.conv_id, self.n, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str, start: int | None, end: int | None) -> None:
        found = TURN.fullmatch(rendered)
        if not found:
            raise ValueError(f"not a formatted turn in conversation {self.conv_id}")
        self.n += 1
        self.chars += len(rendered)
        self.turns.update(f"{unescape(found[1])}\n{unescape(found[2])}\n".encode())
        if start is not None:
            text = unescape(rendered[start:end])
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id,
            "n_turns": self.n,
            "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
        }


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, parsed from the ``rendered`` strings and loss spans alone."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    ship(formatted.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, out, id_type = None, [], pa.int64()

        def flush() -> pa.RecordBatch:
            longs = {c: pa.int64() for c in ("n_turns", "loss_chars", "formatted_chars")}
            names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
            schema = pa.schema([(c, id_type if c == "conv_id" else longs.get(c, pa.string())) for c in names])
            return pa.RecordBatch.from_pylist(out, schema=schema)

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if at is None or row["conv_id"] != at.conv_id:
                    if at:
                        out.append(at.row())
                    at = _Digest(row["conv_id"])
                at.add(row["rendered"], row["loss_start"], row["loss_end"])
            yield flush()
            out = []
        if at:
            out.append(at.row())
            yield flush()

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    rows = formatted.select("conv_id", "position", "rendered", "loss_start", "loss_end")
    return _ordered(rows, "conv_id", ["position"]).mapInArrow(run, schema)


#: With conversation -7, whose texts hold control strings.
ORACLE_SQL = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e as (
  select *, length(regexp_replace(text, '[\\<]', 'xx', 'g')) + length(regexp_replace(role, '[\\<"\n]', 'xx', 'g')) + 24 as chars from t
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(chars)::bigint as formatted_chars
from e group by conv_id
"""
