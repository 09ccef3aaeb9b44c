"""Held-out accuracy, the filter against plain sets, and the defined cases."""

import zlib

import numpy as np

from tapewire.llm import langid as li
from tapewire.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op7_language_id"](spark, MEDIUM).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) >= 0.97


def test_filter_returns_all_languages_of_a_gram():
    letters = li._letters()
    sets = {lang: {int(g) for t in texts for part in li.grams(t, letters) for g in part.view(np.int64)} for lang, texts in {"aa": ["one two three"], "bb": ["two three four"], "cc": ["quince"]}.items()}
    model = li.LanguageFilter.build([(lang, g) for lang, gs in sets.items() for g in gs])
    assert model.languages == ["aa", "bb", "cc"]
    text = "two quince seven"
    codes = [int(g) for part in li.grams(text, letters) for g in part.view(np.int64)]
    want = [np.mean([c in sets[lang] for c in codes]) for lang in model.languages]
    assert np.allclose(model.shares(text, letters), want, atol=0.02)
    assert model.shares("12 ... \n", letters) is None and model.shares(None, letters) is None


def test_slices_make_no_difference(monkeypatch):
    letters, text = li._letters(), "Ein langer Satz, 12 Wörter 😀 ßä " * 30
    whole = np.concatenate(list(li.grams(text, letters)))
    monkeypatch.setattr(li, "SLICE", 37)
    assert np.array_equal(np.concatenate(list(li.grams(text, letters))), whole)
    assert len(list(li.grams("a", letters))[0]) == 1


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, score string"
    rows = [(1, "the cat sat on the mat " * 9, "en", "c"), (3, "der hund lief in den wald " * 9, "de", "c"), (4, None, "en", "c"), (5, "", None, None), (None, "123 ...", "de", "c"), (1, "the cat sat on the mat " * 9, "en", "c")]
    df = spark.createDataFrame(rows, schema)
    model = li.fit_languages(df)
    got = li.predict_languages(df, model, ["doc_id", "lang", "score"]).collect()
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in got) == [(0, "und"), (1, "en"), (1, "en"), (3, "de"), (4, "und"), (5, "und")]
    none = li.fit_languages(df.limit(0))
    assert {r["lang_pred"] for r in li.predict_languages(df, none, ["doc_id"]).collect()} == {"und"}
    assert li.predict_languages(df.limit(0), model, ["doc_id"]).count() == 0
