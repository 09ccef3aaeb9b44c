"""Licence rules: base phrases against plain Python, gating and suppression against all rules tried on all texts."""

import re

from hypothesis import given, settings, strategies as st

from conftest import SMALL
from tapewire.llm import licenses as lic
from tapewire.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
A_TO_Z = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return WORD.findall((text or "").translate(A_TO_Z))


def plain_detections(words):
    """All rules on the whole text; each pair of detections compared."""
    text, found = " ".join(words), []
    for r, pattern in enumerate(lic.book().patterns):
        for m in pattern.finditer(text):
            first = text[: m.start()].count(" ")
            found.append((first, first + m.group().count(" ") + 1, r))
    priority = [rule.priority for rule in lic.book().rules]

    def stronger(a, b):
        return (priority[a[2]], a[1] - a[0], -a[2]) > (priority[b[2]], b[1] - b[0], -b[2])

    return sorted(s for s in found if not any(o[0] <= s[0] and s[1] <= o[1] and stronger(o, s) for o in found))


def expected(doc_id, text):
    words = words_of(text)
    base = [(i, label) for phrase, label in lic.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    kept = plain_detections(words)
    labels = {label for _, label in base} | {lic.book().rules[r].label for _, _, r in kept}
    rest = 1.0
    for _, _, r in kept:
        rest *= 1.0 - lic.CERTAINTY[lic.book().rules[r].priority]
    firsts = [i for i, _ in base]
    return (doc_id, len(words), len(base), min(firsts, default=None), max(firsts, default=None),
            ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)), round(1 - rest, 9))


def rounded(rows):
    return sorted((*tuple(r)[:-1], round(r["score"], 9)) for r in rows)


def test_rules_are_many_and_hold_their_keywords():
    assert len(lic.book().rules) > 300 and all(0 <= r.priority < len(lic.CERTAINTY) for r in lic.book().rules)
    samples = ["released under the terms of the gnu gpl v 3 0", "spdx license identifier cc by sa 4 0", "gplv 2 gplv3 gpl v2 lgpl2 1", "do what the f you want to public license", "mit x11 licence"]
    for text in samples:
        for r, pattern in enumerate(lic.book().patterns):
            for m in pattern.finditer(text):
                assert set(m.group().split()) & set(lic.book().rules[r].keyword.split("|")), (text, lic.book().rules[r])


def labels_of(text):
    return [lic.book().rules[r].label for _, _, r in lic.detect(text, list(range(len(lic.book().rules))))]


def test_suppression():
    assert labels_of("gnu general public license as published by the free software foundation either version 2 of the license or any later version") == ["gpl-2.0-or-later"]
    assert labels_of("licensed under the apache license version 2 0 all rights reserved") == ["apache-2.0", "reserved"]
    assert labels_of("cc by nc sa 4 0") == ["cc-by-nc-sa"]
    assert labels_of("all rights reserved here") == [] and labels_of("smit license") == []


PARTS = ["cc by", "nc", "sa", "4 0", "gnu", "general public license", "version 2", "licensed under the", "mit license", "all rights reserved", "x", "É", "gpl v3", "public domain", "creative commons attribution", "spdx license identifier", "apache 2 0"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14))
def test_any_order_of_parts(parts):
    words = words_of(" ".join(parts))
    assert lic.detect(" ".join(words), list(range(len(lic.book().rules)))) == plain_detections(words)


def test_query(spark, duck):
    rows = QUERIES["op11_license_scan"](spark, SMALL)
    assert rows.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    want = [expected(*r) for r in duck.execute("SELECT doc_id, text FROM documents").fetchall()]
    assert rounded(rows.collect()) == sorted(want) and any(w[2] for w in want)


def test_odd_rows(spark, tmp_path):
    texts = [None, "", "\n--\t!", "CC-BY cc\x00by CC BY", "cc", "by", "General  Public\nLICENSE, all rights reserved", "é cc by É", "word " * 40_000 + "cc by", "cc by " * 3000]
    rows = [(i, t, "x", 1.0) for i, t in enumerate(texts)] + [(6, texts[6], "y", 2.0)] * 2
    spark.createDataFrame(rows, "doc_id long, text string, base string, score double").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_license_scan"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    small = [r for r in rows if len(r[1] or "") < 1000]
    assert rounded(r for r in got if r["doc_id"] < 8) == sorted(expected(*r[:2]) for r in small)
    far = {r["doc_id"]: r for r in got}
    assert (far[8]["first_word"], far[8]["n_base"], far[8]["labels"]) == (40_000, 1, "cc-by")
    assert (far[9]["n_base"], far[9]["last_word"]) == (3000, 5998)
    assert lic.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0
