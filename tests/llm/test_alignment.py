"""Alignment of two tokenizers against plain loops over whole texts."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from conftest import SMALL
from tapewire.llm import alignment as al
from tapewire.llm.queries import QUERIES
from tapewire.llm.tokens import byte_alphabet

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WHOLE = Tokenizer.from_file(A)
WHOLE.encode_special_tokens = True
MODEL = sentencepiece.SentencePieceProcessor(model_file=B)
ALPHABET = byte_alphabet()


def piece_bytes(i):
    piece = MODEL.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if MODEL.is_byte(i) else piece.replace("▁", " ").encode()


def groups_of(text):
    """Groups of one text as (ids, ids), or none."""
    if not text:
        return []
    a = WHOLE.encode(" " + text, add_special_tokens=False).ids
    b = MODEL.encode(text)
    sides = [(a, [bytes(ALPHABET[c] for c in WHOLE.id_to_token(i)) for i in a]), (b, [piece_bytes(i) for i in b])]
    if any(b"".join(parts) != (" " + text).encode() for _, parts in sides):
        return []
    ends = []
    for ids, parts in sides:
        at, places = 0, {}
        for k, part in enumerate(parts):
            at += len(part)
            places[at] = k + 1
        ends.append(places)
    out, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        p, q = ends[0][end], ends[1][end]
        out.append((a[i:p], b[j:q]))
        i, j = p, q
    return out


def expected(rows):
    all_groups = [groups_of(text) for _, text in rows]
    held = Counter()
    for groups in all_groups:
        held.update({(x, y) for xs, ys in groups for x in xs for y in ys})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, _), groups in zip(rows, all_groups):
        links = [(x, y) for xs, ys in groups for x in xs for y in ys]
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        out.append((doc_id, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
                    sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


@pytest.fixture(scope="module")
def pair():
    return al.encoders(A, B)


PIECES = st.lists(st.sampled_from([" ", "  ", "\n", ".", "'s", "a", "É", "7", "\t", "́", "word", " the", "ing", "!", "日本", "▁", "\x00", "<s>", "<0x41>", "<|endoftext|>", "zzqx", "😀"]), max_size=12).map("".join)


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(PIECES, min_size=1, max_size=6))
def test_any_text(pair, texts):
    column = pa.array(texts, pa.string())
    ids, counts = pair.b.encode(pa.array([" " + t for t in texts]))
    assert ids.tolist() == [i for t in texts for i in (MODEL.encode(t) if t else pair.b.encode(pa.array([" "]))[0].tolist())]
    figures, digests, *_ = al.align_chunk(column, pair)
    want = [groups_of(t) for t in texts]
    assert figures[2].tolist() == [len(w) for w in want] and figures[3].tolist() == [sum(len(x) * len(y) for x, y in w) for w in want]
    texts_of = [";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in w) for w in want]
    assert digests == [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts_of]


def test_query(spark, duck):
    rows = QUERIES["op13_token_alignment"](spark, SMALL)
    assert rows.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = expected(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    assert sorted(map(tuple, rows.collect())) == sorted(want)


def test_odd_rows_and_many_slices(spark, monkeypatch):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (4, "▁ marks"), (5, "the " * 30_000), (6, "x" * 5000), (7, "ünïcödé 日本 \n\n the"), (8, "\x00 the"), (None, "the"), (9, " "), (10, "ends \n ")]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, pairs string, n_a int").repartition(3)
    monkeypatch.setattr(al, "SLICE_PAIRS", 20)
    monkeypatch.setattr(al, "PARTIAL_PAIRS", 8)
    got = al.align_tokenizers(df, A, B).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected(rows)))
    assert al.align_tokenizers(df.limit(0), A, B).count() == 0
