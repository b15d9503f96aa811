"""BPE encoding and decoding with a contiguous rank array per word (operator 1).

A word starts as its byte symbols, the last one carrying the end-of-word mark. Beside the parts stands an array with the
rank of each adjacent pair; the smallest rank is found by a scan (leftmost of equals), its boundary deleted, and the two
neighbouring ranks looked up anew. Words beyond `LONG_WORD` parts use a heap over the same ranks and positions, which
merges in the same order without the quadratic scans. Words are memoised up to a fixed number of entries.

Cases: a null text counts as empty and gives no ids; special strings inside a text become their special ids, as the
tokenizers library does by default; a text of only white space gives no ids. Repeated rows each give their own row.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tessera.llm.common import arrow_batches, texts, tidied

NO_RANK = 1 << 60
LONG_WORD = 128
#: Beyond these scripts Unicode versions differ; such texts are split by the library's own tables.
LATER = regex.compile("[^\0-\u052f]").search
CACHED_WORDS = 150_000
CACHED_LENGTH = 48


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = [""] * 256
    for b in shown:
        out[b] = chr(b)
    for extra, b in enumerate(b for b in range(256) if not out[b]):
        out[b] = chr(256 + extra)
    return out


class WordBPE:
    """Encoder and decoder for a word-level tokenizer file (byte symbols, `</w>` at word ends, text in lower case)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max(max(vocab.values()), *self.special.values()))
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + end] for s in symbols]
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.merges.setdefault(vocab[a] << 20 | vocab[b], (rank, vocab[a + b]))
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split).findall
        self.marks = regex.compile("|".join(map(regex.escape, self.special)))
        self.cache: dict[str, bytes] = {}
        self.path, self.library = path, None
        self.byte_of = {s: b for b, s in enumerate(symbols)}

    def merge_short(self, parts: list[int]) -> list[int]:
        """The rank array: scan, delete a boundary, refresh both neighbours."""
        find = self.merges.get
        none = (NO_RANK, 0)
        pairs = [find(a << 20 | b, none) for a, b in zip(parts, parts[1:])]
        ranks = [p[0] for p in pairs]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            i = ranks.index(least)
            parts[i] = pairs[i][1]
            del parts[i + 1], ranks[i], pairs[i]
            if i:
                pairs[i - 1] = p = find(parts[i - 1] << 20 | parts[i], none)
                ranks[i - 1] = p[0]
            if i < len(ranks):
                pairs[i] = p = find(parts[i] << 20 | parts[i + 1], none)
                ranks[i] = p[0]
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges for a long word: a heap by rank, then position, over a doubly linked list."""
        find, n = self.merges.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def push(i: int) -> None:
            if i >= 0 and after[i] < n and (p := find(parts[i] << 20 | parts[after[i]])):
                heapq.heappush(heap, (p[0], i, parts[i], parts[after[i]], p[1]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i] if parts[i] == a else n
            if j >= n or parts[j] != b:
                continue  # what this entry spoke of has been merged
            parts[i], parts[j] = made, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            push(before[i])
            push(i)
        return [p for p in parts if p >= 0]

    def word(self, word: str) -> bytes:
        """The ids of one word as little-endian 32-bit integers."""
        raw = word.encode("utf-8")
        parts = [self.inner[b] for b in raw]
        parts[-1] = self.last[raw[-1]]
        ids = np.array(self.merge_short(parts) if len(parts) <= LONG_WORD else self.merge_long(parts), "<u4").tobytes()
        if len(raw) <= CACHED_LENGTH:
            if len(self.cache) >= CACHED_WORDS:
                self.cache.clear()
            self.cache[word] = ids
        return ids

    def plain(self, text: str) -> bytes:
        """The ids of a text without special strings. Lower case goes by code point, so no final sigma."""
        if text.isascii():
            words = self.words(text.lower())
        elif LATER(text):
            self.library = self.library or Tokenizer.from_file(self.path)
            split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            words = [bytes(map(self.byte_of.__getitem__, w)).decode("utf-8") for w, _ in split]
        else:
            words = self.words(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        get, word = self.cache.get, self.word
        return b"".join([get(w) or word(w) for w in words])

    def encode(self, text: str) -> bytes:
        if "<|" not in text:
            return self.plain(text)
        out, at = [], 0
        for m in self.marks.finditer(text):
            out += [self.plain(text[at : m.start()]), self.special[m[0]].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, self.plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids with a space between them: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[str, WordBPE] = {}


def codec(path: str) -> WordBPE:
    if path not in _loaded:
        _loaded[path] = WordBPE(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit integers) of every whole text of `docs`."""
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for b in batches:
            ids = [bpe.encode(t.as_py()) for t in b.column("text")]
            yield pa.record_batch([b.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    found = texts(docs)
    return found.mapInArrow(tidied(run), f"doc_id {found.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of every row of `encoded` (doc_id, ids); null ids decode to an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for b in batches:
            back = [bpe.decode(i.as_py() or b"") for i in b.column("ids")]
            yield pa.record_batch([b.column("doc_id"), pa.array(back, pa.string())], ["doc_id", "text"])

    found = encoded.select("doc_id", "ids")
    return found.mapInArrow(tidied(run), f"doc_id {found.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip_digests(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids): encode, decode and digest in one pass, so that no decoded text is sent on."""
    arrow_batches(docs.sparkSession)
    sha = hashlib.sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for b in batches:
            ids = [bpe.encode(t.as_py()) for t in b.column("text")]
            columns = {
                "doc_id": b.column("doc_id"),
                "n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()),
                "ids_sha256": pa.array([sha(i).hexdigest() for i in ids], pa.string()),
                "decoded_sha256": pa.array([sha(bpe.decode(i).encode("utf-8")).hexdigest() for i in ids], pa.string()),
            }
            yield pa.RecordBatch.from_pydict(columns | ({"ids": pa.array(ids, pa.binary())} if with_ids else {}))

    found = texts(docs)
    return found.mapInArrow(tidied(run), f"doc_id {found.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids)
