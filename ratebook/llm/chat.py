"""Chat formatting with typed content parts.

A visitor flattens the parts of each turn in order: text is escaped and written, every image,
audio or document part becomes one placeholder, its reference and the tokens it expands to being
recorded. A text never contains a live control string: in each one a backslash is put behind the
first character, and one more where such backslashes stand already, so reading takes one away.
"""

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import arrow_schema, map_batches, partitions, record_batch, ship_package

START, ROLE_END, TURN_END = "<|start|>", "<|role|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
# Also those of other common templates, so no text can pass for a turn of theirs.
CONTROL = (START, ROLE_END, TURN_END, *PLACEHOLDERS.values(), "<s>", "</s>", "[INST]", "[/INST]")
_heads = {c: re.escape(c[0]) for c in CONTROL}
_LIVE = re.compile("|".join(f"(?<={_heads[c]})(?=\\\\*{re.escape(c[1:])})" for c in CONTROL))
_DEAD = re.compile("|".join(f"(?<={_heads[c]})\\\\(?=\\\\*{re.escape(c[1:])})" for c in CONTROL))
_TURN = re.compile(
    f"{re.escape(START)}(.*?){re.escape(ROLE_END)}(.*?){re.escape(TURN_END)}", re.DOTALL
)
_PLACEHOLDER = re.compile("|".join(map(re.escape, PLACEHOLDERS.values())))


def escape(text: str) -> str:
    return _LIVE.sub("\\\\", text)


def unescape(text: str) -> str:
    return _DEAD.sub("", text)


@dataclass
class FlattenVisitor:
    """Writes a conversation turn by turn."""

    loss_roles: frozenset[str] = frozenset({"assistant"})
    written: list[str] = field(default_factory=list)
    length: int = 0
    turns: int = 0
    loss: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[tuple[str, str, int]] = field(default_factory=list)

    def _write(self, text: str) -> None:
        self.written.append(text)
        self.length += len(text)

    def visit_turn(self, role: str | None, parts: list[dict]) -> None:
        self.turns += 1
        self._write(START + escape(role or "") + ROLE_END)
        for part in parts:
            kind = part.get("type") or "text"
            if kind == "text":
                self.visit_text(part.get("text") or "", (role or "") in self.loss_roles)
            elif kind in PLACEHOLDERS:
                self.visit_attachment(kind, part.get("reference") or "", part.get("tokens") or 0)
            else:
                raise ValueError(f"no such part type: {kind!r}")
        self._write(TURN_END)

    def visit_text(self, text: str, in_loss: bool) -> None:
        begin = self.length
        self._write(escape(text))
        if in_loss and self.length > begin:
            self.loss.append((begin, self.length))

    def visit_attachment(self, kind: str, reference: str, tokens: int) -> None:
        self._write(PLACEHOLDERS[kind])
        self.attachments.append((kind, reference, tokens))


def read_back(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a formatted conversation; placeholders are left out."""
    for role, content in _TURN.findall(formatted):
        yield unescape(role), "".join(map(unescape, _PLACEHOLDER.split(content)))


_PART = "array<struct<type:string,text:string,reference:string,tokens:bigint>>"
_SCHEMA = (
    "conv_id long, formatted string, n_turns long, loss array<struct<begin:bigint,end:bigint>>, "
    "attachments array<struct<kind:string,reference:string,tokens:bigint>>, expanded_tokens long"
)
_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("formatted", pa.string()),
        ("n_turns", pa.int64()),
        ("loss", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
        (
            "attachments",
            pa.list_(
                pa.struct([("kind", pa.string()), ("reference", pa.string()), ("tokens", pa.int64())])
            ),
        ),
        ("expanded_tokens", pa.int64()),
    ]
)
# Characters of finished conversations held before they are handed on.
_HELD = 4_000_000


def text_parts(text: Column) -> Column:
    """The parts of a turn that is text alone."""
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            F.coalesce(text, F.lit("")).alias("text"),
            F.lit(None).cast("string").alias("reference"),
            F.lit(None).cast("bigint").alias("tokens"),
        )
    ).cast(_PART)


def format_conversations(
    turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """One row per conv_id: formatted text, loss spans, attachments in order, expanded tokens.

    `turns`: conv_id, turn, role and `parts` (type, text, reference, tokens) or `text`. Spans are
    code points of the formatted text. Turns go by number, equal numbers by role and content, null
    numbers first; repeated rows are turns of their own; null roles and texts are empty; rows with
    a null conv_id make one conversation. A conversation is streamed through one task in order,
    without holding another one; its own formatted text is one value and must fit there. Other
    columns are left out; an empty table gives none.
    """
    content = F.col("parts").cast(_PART) if "parts" in turns.columns else text_parts(F.col("text"))
    rows = turns.select(F.col("conv_id").cast("bigint"), "turn", "role", content.alias("parts"))
    ordered = rows.repartition(partitions(turns.sparkSession), "conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "parts"
    )
    roles = frozenset(loss_roles)
    ship_package(turns.sparkSession)

    def result(done: list[tuple]) -> pa.RecordBatch:
        columns = [
            [c for c, _ in done],
            ["".join(v.written) for _, v in done],
            [v.turns for _, v in done],
            [[{"begin": a, "end": b} for a, b in v.loss] for _, v in done],
            [
                [{"kind": k, "reference": r, "tokens": t} for k, r, t in v.attachments]
                for _, v in done
            ],
            [sum(t for _, _, t in v.attachments) for _, v in done],
        ]
        return record_batch(dict(zip(_ARROW.names, columns, strict=True)), _ARROW)

    def run(batches):
        done, held, now, visitor = [], 0, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if visitor is None or row["conv_id"] != now:
                    if visitor is not None:
                        done.append((now, visitor))
                        held += visitor.length
                    if held > _HELD:
                        yield result(done)
                        done, held = [], 0
                    now, visitor = row["conv_id"], FlattenVisitor(roles)
                visitor.visit_turn(row["role"], row["parts"] or [])
        if visitor is not None:
            yield result([*done, (now, visitor)])

    return ordered.mapInArrow(run, _SCHEMA)


def digests(formatted: DataFrame) -> DataFrame:
    """What reading the formatted conversations gives, as counts and hashes."""

    def job(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                text, turns, n = row["formatted"], hashlib.sha256(), 0
                for role, content in read_back(text):
                    turns.update(f"{role}\n{content}\n".encode())
                    n += 1
                loss = "".join(unescape(text[s["begin"] : s["end"]]) for s in row["loss"])
                digest = hashlib.sha256(loss.encode()).hexdigest()
                rows.append((row["conv_id"], n, turns.hexdigest(), len(loss), digest, len(text)))
            if rows:
                yield dict(zip(names, zip(*rows, strict=True), strict=True))

    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long"
    )
    names = arrow_schema(schema).names
    return map_batches(formatted.select("conv_id", "formatted", "loss"), job, schema)
