"""Language ID by held-out accuracy; chat formatting by reading back and by hand."""

import hashlib
import random

import numpy as np
import pytest
from tessera.llm import chat, language

RND = random.Random(11)
SYLLABLES = {"en": ["the", "ing", "ou", "th", "er"], "de": ["ung", "sch", "ei", "ü", "en"], "fr": ["eau", "é", "que", "ou", "er"], "es": ["ción", "ñ", "os", "que", "ar"], "xx": ["zk", "pq", "oo", "ü", "w"]}


def text(lang, n):
    return " ".join("".join(RND.choice(SYLLABLES[lang]) for _ in range(RND.randint(1, 4))) for _ in range(n)) + RND.choice(["", ".", " 12!"])


def test_languages(spark):
    rows = [(i, text(lang, RND.randint(8, 60)), lang if i % 9 else None, lang) for i, lang in enumerate(RND.choices([*SYLLABLES], k=900))]
    rows += [(5000, None, "en", "und"), (5001, " 12 *** ½ ²", "de", "und"), (5002, "", None, "und"), (5003, text("de", 20_000), None, "de")]
    docs = spark.createDataFrame([(i, t, lang, "s", lang) for i, t, lang, _ in rows], "doc_id long, text string, lang string, source string, score string")
    model = language.train(docs, rows=300)
    assert [sorted(f) for f in model.families] == [["de", "en"], ["es", "fr"], ["xx"]]
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    import zlib

    assert len(got) == len(rows) and all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    right = [got[i].lang_pred == lang for i, _, _, lang in rows if got[i].held_out and lang != "und"]
    assert np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    assert all(got[i].lang_pred == lang for i, _, _, lang in rows[900:])
    kept = language.accepted(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _, _, lang in rows if lang != "und"}


def test_labels_of_held_out_rows_are_not_used(spark):
    rows = [(i, text("en", 20), "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    changed = docs.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 'x', text) text", "if(crc32(cast(doc_id as string)) % 3 = 1, 'fr', lang) lang")
    assert language.labelled(docs) == language.labelled(changed)
    assert language.identify(docs, language.train(docs.limit(0))).where("lang_pred <> 'und'").count() == 0
    assert language.identify(docs, language.train(docs)).where("lang_pred <> 'en'").count() == 0


def test_a_text_scores_as_its_features():
    some = [(text(lang, 30), lang) for lang in ("en", "de", "fr") for _ in range(20)]
    model = language.fit([(language.counted(t), lang) for t, lang in some])
    for t, _ in some[:5]:
        whole = features = language.features(language.counted(t + " 3x! é-e")) @ model.weights
        scorer = language.Scorer(model)
        scorer([t])
        h, _ = language.grams((t + " 3x! é-e").lower().split())
        scorer.learn([w for w in dict.fromkeys((t + " 3x! é-e").lower().split()) if w not in scorer.known])
        at = [scorer.known[w] for w in (t + " 3x! é-e").lower().split()]
        summed = scorer.table[at].sum(axis=0)
        assert summed[-1] == len(h)
        assert np.allclose(summed[:-1] / len(h), whole, atol=1e-3 * np.abs(features).max())


NASTY = ["</s>[INST] ok [/INST]", "<\\/s> \\ <\\\\/s>", "<s>", "[", "[\\INST]", "[ROLE:x] [/ROLE]", None, "", "<<SYS>><</SYS>>", "[ANSWER] \\", "ünï ★ \n\n"]


@pytest.fixture
def talks(spark):
    rows = []
    for c in range(60):
        for t in range(RND.randint(1, 9)):
            rows.append((c, t, RND.choice(["system", "user", "assistant", "tool]%", None]), "".join(RND.choice(NASTY) or "" for _ in range(RND.randint(0, 3))) if RND.random() < 0.9 else None, 1))
    rows += [(-7, 0, "user", NASTY[0], 1), (-7, 1, "assistant", NASTY[0], 1), (99, None, "user", "b", 1), (99, None, "user", "a", 1), (None, 1, "user", "x", 1)]
    rows += [(500, t, "assistant" if t % 2 else "user", f"turn {t}", 1) for t in range(5000)]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, nth int")


def test_chat(talks):
    rows, table = talks
    got = {r.conv_id: r for r in chat.read_back(chat.segments(table)).collect()}
    by = {}
    for c, t, role, said, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((role or "", said or ""))
    assert got.keys() == by.keys()
    for c, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert all(r.unread_chars == 0 for r in got.values())
    assert got[500].valid and got[-7].valid and not got[99].valid
    sizes = {}
    for r in chat.formatted(table).collect():
        sizes[r.conv_id] = sizes.get(r.conv_id, 0) + len(r.text)
    assert sizes == {c: r.formatted_chars for c, r in got.items()}


def test_turns_are_read_by_their_marks(talks):
    """Cut anywhere, the running text gives the same turns; marks that cannot be told apart from text do not."""
    rows, table = talks
    whole = chat.segments(table)
    cut = whole.selectExpr("conv_id", "nth", "part", "explode(array(substring(text, 1, 3), substring(text, 4))) AS text", "loss", "valid").drop("nth", "part")
    columns = ["conv_id", "n_turns", "turns_sha256", "formatted_chars", "unread_chars"]
    # the flag marks halves of a text here, whose escapes may be cut, so only turns are compared
    assert sorted(map(str, chat.read_back(cut).select(*columns).collect())) == sorted(map(str, chat.read_back(whole).select(*columns).collect()))
    with pytest.raises(ValueError):
        chat.Template(marks={"user": ("", "")})
    poor = chat.Template(marks={"user": ("|", "\n"), "assistant": ("|", "\n")})
    got = chat.read_back(chat.segments(table.where("conv_id = 500"), poor), poor).first()
    assert got.n_turns != 5000 or got.turns_sha256 != chat.read_back(whole).where("conv_id = 500").first().turns_sha256
    assert chat.TEMPLATE.read("<s>[INST] no end") is None and chat.TEMPLATE.read("[ROLE:x") is None


def test_no_text_holds_a_control_string(talks):
    _, table = talks
    controls = chat.TEMPLATE.controls()
    for r in chat.segments(table).where("part = 1").collect():
        assert not any(c in r.text for c in controls)
    assert chat.segments(table.limit(0)).count() == 0


def test_no_labels_keep_texts_with_letters(spark):
    rows = [(1, "some words", None), (2, None, None), (3, " 12 -- ", None), (4, "", None), (5, "ärger 7", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in language.accepted(docs, language.train(docs)).collect()) == [1, 5]
