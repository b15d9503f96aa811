"""Chat formatting by a finite-state machine over roles and a declarative template (operator 5).

Conversations are sorted by turn within partitions and streamed: the machine's state and one row are all that is held,
however long a conversation is. Each turn gives three segments (mark, text, mark), each with a loss flag; only the texts
of roles that the template trains on carry it. A control string in a text gets a backslash after its first character,
one more than it has, so that no text can pass for a mark and reading back is exact.

Cases: a null text is empty; an unknown or null role is marked with its name and is out of order; turns are taken as they
stand even if out of order, which `valid` tells; equal turns go by role, then text; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_batches, tidied


@dataclass(frozen=True)
class Template:
    """Marks around the turns of each role, which roles are trained on, and which may follow which."""

    marks: dict[str, tuple[str, str]] = field(default_factory=lambda: {"system": ("<<SYS>>", "<</SYS>>"), "user": ("<s>[INST] ", " [/INST]"), "assistant": ("[ANSWER] ", "</s>")})
    other: tuple[str, str, str] = ("[ROLE:", "] ", " [/ROLE]")
    loss: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, frozenset[str]] = field(default_factory=lambda: {"": frozenset({"system", "user"}), "system": frozenset({"user"}), "user": frozenset({"assistant"}), "assistant": frozenset({"user"})})

    def __post_init__(self) -> None:
        if not all(mark for pair in [*self.marks.values(), self.other] for mark in pair):
            raise ValueError("an empty mark cannot be read back")

    def controls(self) -> list[str]:
        found = {"<s>", "[INST]", "[/INST]", "[ANSWER]", self.other[0].strip(), self.other[2].strip()} | {m.strip() for pair in self.marks.values() for m in pair}
        return sorted((c for c in found if len(c) > 1), key=lambda c: (-len(c), c))

    def patterns(self) -> tuple[re.Pattern, re.Pattern]:
        """A control string with any backslashes after its first character, and with one at least."""
        rest = [(re.escape(c[0]), re.escape(c[1:])) for c in self.controls()]
        return re.compile("|".join(rf"{a}(?=\\*{b})" for a, b in rest)), re.compile("|".join(rf"(?<={a})\\(?=\\*{b})" for a, b in rest))

    def open_close(self, role: str) -> tuple[str, str]:
        return self.marks.get(role) or (self.other[0] + quote(role, safe="") + self.other[1], self.other[2])

    def read(self, text: str, since: int = 0) -> tuple[str, str, int] | None:
        """Role and text, still escaped, of the turn at the start of `text`, and where it ends; None if its end isn't there yet.

        Marks are all that is looked for: no text holds one, as control strings in it are escaped. since: how far `text`
        is known to hold no end.
        """
        for role, (begin, end) in self.marks.items():
            if text.startswith(begin):
                start = len(begin)
                break
        else:
            head, _, rest = text.partition(self.other[1])
            if not head.startswith(self.other[0]) or not rest:
                return None
            role, start, end = unquote(head[len(self.other[0]) :]), len(head) + len(self.other[1]), self.other[2]
        at = text.find(end, max(start, since - len(end)))
        return None if at < 0 else (role, text[start:at], at + len(end))


TEMPLATE = Template()


def segments(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, nth (turn, from 0), part (0 to 2), text, loss, valid (all turns so far in order), in order within partitions."""
    arrow_batches(conversations.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escape = template.patterns()[0]
        now, nth, state, valid = object(), 0, "", True
        for b in batches:
            out = []
            for conv, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != now:
                    now, nth, state, valid = conv, 0, "", True
                valid = valid and role in template.follows.get(state, ())
                state = role
                begin, end = template.open_close(role)
                parts = ((begin, False), (escape.sub(r"\g<0>\\", text), role in template.loss), (end, False))
                out += [{"conv_id": conv, "nth": nth, "part": i, "text": t, "loss": loss, "valid": valid} for i, (t, loss) in enumerate(parts)]
                nth += 1
            yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("conv_id", pa.int64()), ("nth", pa.int64()), ("part", pa.int32()), ("text", pa.string()), ("loss", pa.bool_()), ("valid", pa.bool_())])
    rows = conversations.select(F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return rows.mapInArrow(tidied(run), "conv_id long, nth long, part int, text string, loss boolean, valid boolean")


def formatted(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, nth, text: each formatted turn; a conversation is its turns one after another."""
    found = segments(conversations, template)
    return found.groupBy("conv_id", "nth").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda s: s["text"]), "").alias("text"))


def read_back(found: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, unread_chars, valid from segments() as they stand.

    Turns are parsed from the running text of the conversation by its marks alone; where a segment begins or ends is not
    looked at, but for the loss mask, which is the flag. What is read is let go, so that one turn is held at a time.
    unread_chars: what no mark ends, 0 for a text that segments() made.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("unread_chars", pa.int64()), ("valid", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unescape = template.patterns()[1]
        sha, now, held, running = hashlib.sha256, None, None, ""

        def row() -> dict:
            n, turns, chars, loss, size, valid = held
            return {"conv_id": now, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars, "loss_sha256": loss.hexdigest(), "formatted_chars": size, "unread_chars": len(running), "valid": valid}

        for b in batches:
            out = []
            for conv, text, loss, valid in zip(*(b.column(c).to_pylist() for c in ("conv_id", "text", "loss", "valid"))):
                if held is None or conv != now:
                    if held is not None:
                        out.append(row())
                    now, held, running = conv, [0, sha(), 0, sha(), 0, True], ""
                held[4] += len(text)
                held[5] = valid
                if loss:
                    plain = unescape.sub("", text)
                    held[2] += len(plain)
                    held[3].update(plain.encode("utf-8"))
                since, running = len(running), running + text
                while turn := template.read(running, since):
                    role, content, end = turn
                    held[0] += 1
                    held[1].update(f"{role}\n{unescape.sub('', content)}\n".encode())
                    since, running = 0, running[end:]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([row()], schema)

    return found.mapInArrow(tidied(run), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, unread_chars long, valid boolean")
