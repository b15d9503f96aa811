"""Language identification: the family first, then pairwise linear support vector machines within it (operator 6).

Features are the shares of hashed character n-grams (1 to 3, with word ends) in a whole text. Machines are linear in
them, so a word's part in every score is worked out once and a text adds up its words. Machines are fitted by dual
coordinate descent on at most `TRAIN_ROWS` labelled rows, spread evenly over languages and picked by a hash of doc_id
among those whose crc32(doc_id) mod 3 is not 1. A family's machine sets it against the others; within the family each
pair of languages has one. The score multiplies the family's and the language's share of the calibrated margins.

Cases: a null text and one without letters is `und` with score 0; where no labelled row exists every text is `und`; rows
without a language are predicted, never learned from; languages in no listed family are families of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import arrow_batches, texts, tidied

#: Labelled rows to fit on, in all languages together.
TRAIN_ROWS = 3000
DIM = 8192
CACHED_WORDS = 150_000
UNKNOWN = "und"
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "uralic": ("et", "fi", "hu"),
}

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the letters of some words, and each one's word. Anything but a letter ends a word."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), "<u4").copy()
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths + 1)
    owner = np.append(0, owner)
    real = letters()[code]
    code[~real] = 32
    # the space before a word belongs to it
    owner[:-1] = np.where(real[:-1], owner[:-1], owner[1:])
    wide = code.astype(np.uint64)
    hashed, owners = [], []
    for n in (1, 2, 3):
        m = len(code) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        for j in range(n):
            h = (h ^ wide[j : m + j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        some = real[:m] if n == 1 else (real[:m] | real[1 : m + 1]) if n == 2 else real[1 : m + 1]
        hashed.append((h[some] >> np.uint64(7)) % np.uint64(DIM))
        owners.append(owner[:m][some])
    return np.concatenate(hashed).astype(np.int64), np.concatenate(owners)


def counted(text: str) -> bytes:
    """The hashed n-grams of a text (two bytes each), and how often each comes (four bytes each)."""
    at, n = np.unique(grams(text.lower().split())[0], return_counts=True)
    return at.astype("<u2").tobytes() + n.astype("<u4").tobytes()


def features(counts: bytes) -> np.ndarray:
    """The share of each hashed n-gram."""
    some, out = len(counts) // 6, np.zeros(DIM, np.float32)
    n = np.frombuffer(counts, "<u4", offset=2 * some)
    out[np.frombuffer(counts, "<u2", some)] = n / max(1, n.sum())
    return out


def machine(x: np.ndarray, rows: np.ndarray, y: np.ndarray, c: float = 4.0, rounds: int = 12) -> tuple[np.ndarray, float, float]:
    """Weights, bias and slope of a linear support vector machine (hinge loss, dual coordinate descent) for some rows.

    The last column of `x` is 1; `y` is 1 or -1 for every row of it. `x` is never copied.
    """
    rnd = np.random.default_rng(17)
    w, alpha, square = np.zeros(x.shape[1], np.float32), np.zeros(len(x)), np.einsum("ij,ij->i", x, x)
    yes, no = (y[rows] > 0).sum(), (y[rows] < 0).sum()
    cost = np.where(y > 0, len(rows) / max(1, 2 * yes), len(rows) / max(1, 2 * no)) * c
    for _ in range(rounds):
        for i in rnd.permutation(rows):
            step = np.clip(alpha[i] - (y[i] * (x[i] @ w) - 1) / square[i], 0, cost[i]) - alpha[i]
            if step:
                alpha[i] += step
                w += np.float32(step * y[i]) * x[i]
    margin, slope = (y * (x @ w))[rows], 1.0
    for _ in range(30):  # the slope of a logistic curve through the margins
        p = 1 / (1 + np.exp(-np.clip(slope * margin, -30, 30)))
        slope = float(np.clip(slope + ((1 - p) @ margin - 0.01 * slope) / max(1e-6, (p * (1 - p)) @ margin**2 + 0.01), 0.1, 8))
    return w[:-1], float(w[-1]), slope


@dataclass
class LanguageModel:
    """Languages by family, and for each machine its weights (a column), bias and slope."""

    families: list[list[str]]
    weights: np.ndarray
    bias: np.ndarray
    slope: np.ndarray

    def predict(self, total: np.ndarray, n: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and scores of texts from the sums of their weights and the numbers of their n-grams."""
        logits = (total / np.maximum(1, n)[:, None] + self.bias) * self.slope
        sure = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
        first = sure[:, : len(self.families)] if len(self.families) > 1 else np.ones((len(total), 1))
        family, at = np.argmax(first, axis=1), len(self.families) * (len(self.families) > 1)
        share = first.max(axis=1) / first.sum(axis=1)
        names = np.full(len(total), UNKNOWN, object)
        for f, langs in enumerate(self.families):
            won = np.zeros((len(total), len(langs)))
            for i in range(len(langs)):
                for j in range(i + 1, len(langs)):
                    won[:, i] += sure[:, at]
                    won[:, j] += 1 - sure[:, at]
                    at += 1
            mine = family == f
            if len(langs) > 1:
                share[mine] *= won[mine].max(axis=1) / (len(langs) - 1)
            names[mine] = np.array(langs, object)[np.argmax(won, axis=1)[mine]]
        none = n == 0
        names[none] = UNKNOWN
        return names.tolist(), np.where(none, 0.0, share)


def fit(some: list[tuple[bytes, str]], families: dict[str, tuple[str, ...]] = FAMILIES) -> LanguageModel:
    """A model of rows (counts of a text's n-grams, language)."""
    langs = sorted({lang for _, lang in some})
    of = {lang: family for family, members in families.items() for lang in members}
    groups: dict[str, list[str]] = {}
    for lang in langs:
        groups.setdefault(of.get(lang, lang), []).append(lang)
    found = [groups[g] for g in sorted(groups)]
    if not found:
        return LanguageModel([[UNKNOWN]], np.zeros((DIM, 1), np.float32), np.zeros(1), np.ones(1))
    x = np.ones((len(some), DIM + 1), np.float32)
    for i, (counts, _) in enumerate(some):
        x[i, :DIM] = features(counts)
    y = np.array([lang for _, lang in some], object)
    scale = 1 / np.sqrt(x[:, :DIM].mean(axis=0) + 1e-6)
    x[:, :DIM] *= scale
    made = []
    if len(found) > 1:
        made += [machine(x, np.arange(len(x)), np.where(np.isin(y, members), 1, -1)) for members in found]
    for members in found:
        for i, a in enumerate(members):
            for b in members[i + 1 :]:
                made.append(machine(x, np.flatnonzero(np.isin(y, [a, b])), np.where(y == a, 1, -1)))
    if not made:
        return LanguageModel(found, np.zeros((DIM, 1), np.float32), np.zeros(1), np.ones(1))
    weights = np.stack([w * scale for w, _, _ in made], axis=1).astype(np.float32)
    return LanguageModel(found, weights, np.array([b for _, b, _ in made]), np.array([s for _, _, s in made]))


class Scorer:
    """Sums of weights of whole texts, word by word."""

    def __init__(self, model: LanguageModel):
        self.model, self.known = model, {}
        self.table = np.zeros((1024, model.weights.shape[1] + 1), np.float32)

    def learn(self, words: list[str]) -> None:
        h, owner = grams(words)
        parts = [np.bincount(owner, self.model.weights[h, m], len(words)) for m in range(self.model.weights.shape[1])]
        new = np.stack([*parts, np.bincount(owner, minlength=len(words))], axis=1)
        at = len(self.known)
        if at + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((max(len(self.table), len(words)), self.table.shape[1]), np.float32)])
        self.table[at : at + len(words)] = new
        self.known.update(zip(words, range(at, at + len(words))))

    def __call__(self, some: list[str]) -> tuple[list[str], np.ndarray]:
        sums = np.zeros((len(some), self.table.shape[1]))
        for i, text in enumerate(some):
            words = text.lower().split()
            if not words:
                continue
            if len(self.known) > CACHED_WORDS:
                self.known.clear()
            at = list(map(self.known.get, words))
            if None in at:
                self.learn(list(dict.fromkeys(w for w, x in zip(words, at) if x is None)))
                at = list(map(self.known.get, words))
            sums[i] = self.table[at].sum(axis=0, dtype=np.float64)
        return self.model.predict(sums[:, :-1], sums[:, -1])


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def labelled(docs: DataFrame, rows: int = TRAIN_ROWS) -> list[tuple[bytes, str]]:
    """At most `rows` rows (counts, language), as many of each language as there are, up to an even share.

    What reaches the driver of a text are its counted n-grams: `DIM` numbers at most, however long it is.
    """
    arrow_batches(docs.sparkSession)
    docs = docs.select("doc_id", "lang", "text")
    open_ = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "lang", F.xxhash64("doc_id").alias("spot"))
    counts = open_.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(rows)
    langs = counts.count()
    if not langs:
        return []
    each = max(1, rows // langs)
    # of a language with many rows only the spots that hold about three times as many as are wanted are ranked
    near = open_.join(F.broadcast(counts), "lang").where(F.pmod("spot", F.lit(1 << 20)) * F.col("n") <= F.lit((1 << 20) * (3 * each + 30)))
    order = Window.partitionBy("lang").orderBy(F.pmod("spot", F.lit(1 << 20)), "spot", "doc_id")
    picked = near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= each).select(F.col("doc_id").alias("picked")).distinct()
    found = docs.join(F.broadcast(picked), F.col("doc_id") == F.col("picked"), "left_semi").where("lang is not null and text is not null").select("text", "lang", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([pa.array([counted(t.as_py()) for t in b.column("text")], pa.binary()), b.column("lang"), b.column("doc_id")], ["counts", "lang", "doc_id"])

    kind = found.schema["doc_id"].dataType.simpleString()
    held = found.mapInArrow(tidied(run), f"counts binary, lang string, doc_id {kind}").collect()
    return [(bytes(r.counts), r.lang) for r in sorted(held, key=lambda r: (r.doc_id, r.lang, bytes(r.counts)))]


def train(docs: DataFrame, rows: int = TRAIN_ROWS, families: dict[str, tuple[str, ...]] = FAMILIES) -> LanguageModel:
    return fit(labelled(docs, rows), families)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text of `docs`."""
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            names, scores = scorer(b.column("text").to_pylist())
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = texts(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(tidied(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of `docs`, with all their columns, that have a language; of a model without any, those with letters."""
    arrow_batches(docs.sparkSession)
    if model.families == [[UNKNOWN]]:  # nothing was labelled: a text with letters has a language, if not one of ours
        model = replace(model, families=[["any"]])

    @F.pandas_udf("string")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for b in batches:
            yield pd.Series(scorer(b.fillna("").tolist())[0])

    return docs.where(predicted("text") != UNKNOWN)
