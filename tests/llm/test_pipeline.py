"""The pipeline's stages on a small table, each against a plain version of what it has to keep."""

from collections import Counter

import corpus_pipeline
import pytest
from tessera.llm import bpe, mixing

from .test_near_dedup import brute, corpus


@pytest.fixture
def folder(spark, tmp_path):
    rows = [(i, t, "en" if i % 4 else None, f"s{i % 3}" if i % 7 else None, 5) for i, t in corpus(9)]
    rows += [(1000 + i, t, "en", "s0", 5) for i, (_, t, _, _, _) in enumerate(rows[:40])]
    rows += [(2000, " 12 -- ", "en", "s1", 5), rows[3]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    return rows, str(tmp_path)


def test_stages(spark, folder):
    rows, sf_dir = folder
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    languages, exact, near, mix, encode = (f for _, f in corpus_pipeline.STAGES)

    docs = languages(spark, docs, sf_dir).cache()
    assert docs.columns == columns
    assert ids(docs) == sorted(r[0] for r in rows if any(c.isalpha() for c in r[1] or ""))

    kept = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    docs = exact(spark, docs, sf_dir).cache()
    assert docs.columns == columns
    first = {}
    for r in sorted(kept, key=lambda r: r[0]):
        first.setdefault(r[1], r)
    assert ids(docs) == sorted(r[0] for r in first.values())

    docs = near(spark, docs, sf_dir).cache()
    assert docs.columns == columns
    assert ids(docs) == sorted(i for i, (_, c) in brute([(r[0], r[1]) for r in first.values()], 5, 80).items() if i == c)

    mixed = mix(spark, docs, sf_dir).cache()
    assert mixed.columns == columns
    assert Counter(ids(mixed)) == Counter({r.doc_id: r.copies for r in mixing.mix(docs).collect()})

    done = encode(spark, mixed, sf_dir).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.doc_id for r in done) == ids(mixed)
    assert all(bytes(r.ids) == bpe.codec(corpus_pipeline.WORD_BPE).encode(texts[r.doc_id]) for r in done)


def test_run(spark, folder):
    _, sf_dir = folder
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and got.count() > 0


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
