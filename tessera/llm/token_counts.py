"""Token counts by batch encoding in Arrow functions that return lengths only (operator 4).

Texts go to the encoder in batches of about `BATCH_BYTES`; a text above `LONG_TEXT` characters is cut where a single
space stands between two other characters. No piece of the vocabulary holds the space mark after another character, so
no merge crosses such a place, and the mark that the encoder puts before each part stands for the space that was cut.

Cases: a null or empty text has no tokens; control strings inside a text are plain text; repeated rows each count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tessera.llm.common import arrow_batches, texts, tidied

BATCH_BYTES = 1 << 20
LONG_TEXT = 1 << 15
SAFE = re.compile("(?<=[^ ▁]) (?=[^ ▁])")

_loaded: dict[str, sentencepiece.SentencePieceProcessor] = {}


def safe_parts(text: str, longest: int = LONG_TEXT) -> list[str]:
    """`text` cut at the first safe place after every `longest` characters; the space at a cut is left out."""
    parts, at = [], 0
    while len(text) - at > longest and (m := SAFE.search(text, at + longest)):
        parts.append(text[at : m.start()])
        at = m.end()
    return [*parts, text[at:]]


def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    if path not in _loaded:
        _loaded[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _loaded[path]


def lengths(model: sentencepiece.SentencePieceProcessor, some: list[str]) -> list[int]:
    """Tokens of each text, encoded in batches balanced by bytes."""
    counts = [0] * len(some)
    batch: list[str] = []
    owners: list[int] = []
    held = 0

    def flush() -> None:
        for owner, ids in zip(owners, model.encode(batch, num_threads=1)):
            counts[owner] += len(ids)
        batch.clear(), owners.clear()

    for i, text in enumerate(some):
        for part in safe_parts(text) if len(text) > LONG_TEXT else [text]:
            batch.append(part)
            owners.append(i)
            held += len(part) if part.isascii() else len(part.encode("utf-8"))
            if held >= BATCH_BYTES:
                flush()
                held = 0
    flush()
    return counts


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every whole text of `docs`."""
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = processor(path)
        for b in batches:
            some = b.column("text").to_pylist()
            n = lengths(model, some)
            yield pa.record_batch(
                [b.column("doc_id"), pa.array([len(t.encode("utf-8")) for t in some], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    found = texts(docs)
    return found.mapInArrow(tidied(run), f"doc_id {found.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
