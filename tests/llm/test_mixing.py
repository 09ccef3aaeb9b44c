"""Targets, highest quotients and the mix against direct computation."""

import heapq
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tapewire.llm.mixing import apply_mix, apportion, mix_plan, source_targets

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12), st.integers(0, 400))
def test_apportion_equals_dealing_one_by_one(weights, seats):
    held = [0] * len(weights)
    if sum(weights):
        heap = [(-w, i) for i, w in enumerate(weights) if w]
        heapq.heapify(heap)
        for _ in range(seats):
            _, i = heapq.heappop(heap)
            held[i] += 1
            heapq.heappush(heap, (-weights[i] / (2 * held[i] + 1), i))
    assert apportion(weights, seats).tolist() == held


def test_targets():
    got = source_targets([100, 10, 1000], [5, 2, 1], 1665, 2)
    assert got == pytest.approx([200, 20, 1445])
    assert source_targets([], [], 0, 2).tolist() == []
    assert source_targets([10, 0], [5, 2], 15, 2) == pytest.approx([15, 0])


def corpus():
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 300))), "en", "abc"[min(int(rng.integers(0, 6)), 2)], 0) for i in range(400)]
    rows += [(1000, None, None, None, None), (1001, "x y z " * 5000, "en", None, 3), (1001, "x y z " * 5000, "en", None, 3), (None, "p q", "en", "b", 3), (1002, "", "en", "é", 0)]
    return rows


def test_plan(spark):
    docs = spark.createDataFrame(corpus(), DOCS)
    rows = mix_plan(docs).collect()
    assert len(rows) == len(corpus())
    total = sum(r["size"] for r in rows)
    names = ["a", "b", "c", "é", None]
    sizes = [sum(r["size"] for r in rows if r["source"] == n) for n in names]
    targets = source_targets(sizes, [5, 2, 1, 5, 2], 1.5 * total, 2)
    for name, size, target in zip(names, sizes, targets, strict=True):
        own = [r for r in rows if r["source"] == name]
        assert {(r["source_size"], round(r["target"], 6)) for r in own} == {(size, round(target, 6))}
        assert abs(sum(r["taken"] for r in own) - target) <= 0.01 * target + 20
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    again = mix_plan(docs.repartition(5)).collect()
    key = lambda r: (r["doc_id"] or -1, r["copy"])
    assert sorted((key(r), r["taken"]) for r in rows) == sorted((key(r), r["taken"]) for r in again)


def test_apply_gives_the_words_of_the_plan(spark):
    docs = spark.createDataFrame(corpus(), DOCS)
    plan = mix_plan(docs)
    mixed = apply_mix(docs, plan)
    assert mixed.columns == docs.columns
    words = {}
    for r in mixed.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
        assert r["n_chars"] == len(r["text"])
    want = {}
    for r in plan.collect():
        if r["taken"]:
            want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["taken"]
    assert words == want


def test_empty_table(spark):
    assert mix_plan(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("blocks", [3, 50, 1 << 20])
def test_no_source_is_lost_to_long_blocks(spark, blocks):
    """Sources far below a block, and more (source, shard) cells than blocks."""
    rows = [(i, "w " * 400, "en", "big", 0) for i in range(60)]
    rows += [(1000 + i, "w " * (i % 7 + 1), "en", f"tiny{i // 3:02d}", 0) for i in range(60)]
    got = mix_plan(spark.createDataFrame(rows, DOCS), blocks=blocks).collect()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    for name in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == name]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1
    assert sum(r["taken"] for r in got) == round(1.5 * sum(r["size"] for r in got))
