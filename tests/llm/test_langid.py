import random

import pytest

from millrace.llm import langid

SYLLABLES = {"aa": ["ba", "lo", "ti", "ren"], "bb": ["sch", "wu", "zer", "ing"], "cc": ["ñe", "ció", "qua", "llo"]}


def text(lang, draw, words=60):
    return " ".join("".join(draw.choice(SYLLABLES[lang]) for _ in range(draw.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def known(documents):
    draw = random.Random(1)
    return langid.learn(documents([(i, text(lang, draw), lang) for i in range(60) for lang in SYLLABLES] + [(900, None, "aa"), (901, "x", None)]))


def test_held_out_accuracy(spark, sf):
    from millrace.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op4_language_id"](spark, sf).join(docs, "doc_id").filter("held_out")
    assert got.filter("lang = lang_pred").count() >= 0.95 * got.count() > 0


def test_predictions(documents, known):
    draw = random.Random(2)
    rows = [(i, text(lang, draw, 20), lang) for i, lang in enumerate(list(SYLLABLES) * 20)]
    got = {r["doc_id"]: r for r in langid.predict(documents(rows), known).collect()}
    assert all(got[i]["lang_pred"] == lang and 0.5 < got[i]["score"] <= 1 for i, _, lang in rows)


def test_odd_rows(documents, odd_rows, known):
    got = langid.predict(documents(odd_rows), known).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in [*SYLLABLES, "und"]
    assert {(r["lang_pred"], r["score"]) for r in got if r["doc_id"] in (1, 2, 3)} == {("und", 0.0)}
    assert langid.predict(documents([]), known).count() == 0


def test_nothing_learned(documents):
    nothing = langid.learn(documents([]))
    assert {r["lang_pred"] for r in langid.predict(documents([(1, "some text")]), nothing).collect()} == {"und"}


def test_a_text_alone_or_among_others(documents, known):
    draw = random.Random(4)
    rows = [(i, text(lang, draw, 3), lang) for i, lang in enumerate(list(SYLLABLES) * 10)]
    together = {r["doc_id"]: r["score"] for r in langid.predict(documents(rows), known).collect()}
    for row in rows[:3]:
        alone = langid.predict(documents([row]), known).collect()[0]["score"]
        assert alone == pytest.approx(together[row[0]], abs=1e-12)


def test_more_than_64_languages(documents):
    rows = [(i, f"{chr(0x4E00 + 9 * i)}{chr(0x4E01 + 9 * i)}{chr(0x4E02 + 9 * i)} " * 5, f"l{i:03d}") for i in range(70)]
    known = langid.learn(documents(rows))
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(documents(rows), known).collect()}
    assert got == {i: lang for i, _, lang in rows}
