"""BPE and token counts against the libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tessera.llm import bpe, token_counts
from tokenizers import Tokenizer

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
rnd = random.Random(7)
TEXTS = [None, "", " ", "\n\t", "Hello<|endoftext|> World don't", "ΣΑΣ Σ İx é é", "日本語のテキスト １２ ½", "a" * 5000, "x" * 130 + " ▁▁ y  z"]
TEXTS += ["".join(rnd.choice("ab'sΣςİ<|endoftext|>  \n\x1cé日½!?▁") for _ in range(rnd.randint(1, 300))) for _ in range(300)]
TEXTS += [" ".join("".join(rnd.choice("thesandion") for _ in range(rnd.randint(1, 12))) for _ in range(30_000)), "ab " * 60_000, "no-space" * 20_000]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string").repartition(4)


def test_bpe(docs):
    library = Tokenizer.from_file(WORDS)
    got = {r.doc_id: r for r in bpe.round_trip_digests(docs, WORDS).collect()}
    encoded = bpe.encode(docs, WORDS)
    ids = {r.doc_id: bytes(r.ids) for r in encoded.collect()}
    back = {r.doc_id: r.text for r in bpe.decode(encoded, WORDS).collect()}
    assert len(got) == len(ids) == len(back) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        want = library.encode(text or "", add_special_tokens=False).ids
        raw = np.array(want, "<u4").tobytes()
        shown = library.decode(want, skip_special_tokens=False)
        assert (ids[i], back[i]) == (raw, shown), text[:80]
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(want), hashlib.sha256(raw).hexdigest(), hashlib.sha256(shown.encode()).hexdigest())
    assert bpe.encode(docs.limit(0), WORDS).count() == 0


def test_both_merges_agree():
    codec = bpe.codec(WORDS)
    for _ in range(300):
        raw = "".join(rnd.choice("thesandionab") for _ in range(rnd.randint(1, 200))).encode()
        parts = [codec.inner[b] for b in raw[:-1]] + [codec.last[raw[-1]]]
        assert codec.merge_short(parts[:]) == codec.merge_long(parts[:])


def test_counts(docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, PIECES).collect()}
    for i, text in enumerate(TEXTS):
        n = len(model.encode(text or ""))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((text or "").encode()), n > 4096)
        assert sum(len(model.encode(p)) for p in token_counts.safe_parts(text or "", 7)) == n
    assert token_counts.count_tokens(docs.limit(0), PIECES).count() == 0
