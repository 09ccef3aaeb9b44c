"""Piecewise encoding against whole texts, coding round trips, and packing against the plain stream."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from conftest import SMALL
from tapewire.llm import packing, token_files as tf
from tapewire.llm.queries import QUERIES
from tapewire.llm.tokens import ENCODED_BYTES, PieceEncoder, piece_starts, piece_texts, text_chunks

VOCABULARIES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
SAMPLES = [
    "", " ", "a  b", "a \n b\n\n c", "it's o'clock. Its,too.\nNew line.\n\nTwo\r\n", "x  y 　z", "é.É, ×. ÷.ß\nà.b", "tab\t.x\n .y",
    "<|endoftext|> and <|startoftext|>", "é.e ́x\ń", "ends \n ", " starts", "\n", "\n\n", "12.5,6.\n7", "...\n...", "日本 語.x", "a" * 70_000,
]
PIECES = st.lists(st.sampled_from([" ", "\n", ".", ",", "'s", "a", "É", "×", "7", "\t", " ", "́", "ß", "word", "!", "日"]), max_size=14).map("".join)


@pytest.fixture(scope="module", params=VOCABULARIES)
def both(request):
    path = public_tokenizers.path(request.param)
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    return PieceEncoder(path, most=3000), whole


def check(both, texts):
    mine, whole = both
    ids, counts = mine.encode(pa.array(texts, pa.string()))
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_samples(both, duck):
    check(both, [*SAMPLES, None, SAMPLES[4], None])
    check(both, [])
    check(both, [r[0] for r in duck.execute("SELECT text FROM documents").fetchall()])


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(PIECES, max_size=6))
def test_any_text(both, texts):
    check(both, texts)


def test_chunks_cover_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 50, 0, 7, 7, 7, 100)] + [None], "k": range(8)})
    parts = list(text_chunks(batch, "text", 20))
    assert [x for p in parts for x in p["k"].to_pylist()] == list(range(8)) and len(parts) == 6


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 70_000), st.integers(0, 2**64 - 1)), max_size=3000))
def test_words_round_trip(values):
    values = np.array(values, np.uint64)
    words, lanes, escapes = tf.pack_words(values)
    assert tf.unpack_words(words, escapes).tolist() == values.tolist() and lanes.sum() == len(words)
    start = 0
    for i, n in enumerate(lanes.tolist()):  # every lane decodes by itself
        assert tf.unpack_words(words[start : start + n], escapes).tolist() == values[i * tf.LANE : (i + 1) * tf.LANE].tolist()
        start += n


def test_words_are_short():
    assert len(tf.pack_words(np.zeros(6000, np.uint64))[0]) <= 110
    assert len(tf.pack_words(np.full(4096, 32_000, np.uint64))[0]) == 1024


def test_broken_block_is_refused():
    data = tf.block_bytes(np.array([1]), np.array([True]), np.array([3]), np.array([1, 2, 3]))
    assert tf.read_block(data)[3].tolist() == [1, 2, 3]
    with pytest.raises(ValueError):
        tf.read_block(data[:-1] + b"\x07")


DOCS = "doc_id long, text string, start long, ids string"
ROWS = [(5, "five words are in here", 1, ""), (2, None, 2, ""), (9, "", 3, None), (2, "again two", 4, ""), (None, "no id", 5, ""), (2, "again two", 4, ""), (7, "long " * 9000, 6, "")]


def test_files_hold_the_stream(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    df = spark.createDataFrame(ROWS, DOCS).repartition(3)
    rows = tf.read_ids(tf.write_ids(df, path, 2)).collect()
    want = sorted((r[0] is not None, r[0] or 0, whole.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in ROWS)
    rows = sorted(rows, key=lambda r: r["start"])
    got = [(r["doc_id"] is not None, r["doc_id"] or 0, np.frombuffer(r["ids"], "<u4").tolist()) for r in rows]
    assert sorted(got) == want and [g[:2] for g in got] == sorted(g[:2] for g in got)
    assert [r["start"] for r in rows] == np.cumsum([0] + [len(g[2]) for g in got])[:-1].tolist()
    assert [r["n_tokens"] for r in rows] == [len(g[2]) for g in got]
    assert tf.read_ids(tf.write_ids(df.limit(0), path, 2)).count() == 0


def test_hilbert_key_is_a_curve():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = packing.hilbert_key(cells, 3)
    assert sorted(key.tolist()) == list(range(512))
    steps = np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def check_pieces(rows, want, length):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, ids in want.items():
        at = 0
        for r in sorted(by_doc.pop(doc), key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    fills = []
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        fills.append(at)
    assert max(fills) <= length and sum(f < length for f in fills) <= 1


def test_packing(spark, duck):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: whole.encode(t or "", add_special_tokens=False).ids + [0] for i, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()}
    check_pieces(QUERIES["op3_curve_packing"](spark, SMALL).collect(), want, 1024)


def test_packing_of_odd_rows(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame(ROWS, DOCS)
    rows = packing.pack_documents(df, path, 0, 64).collect()
    whole = Tokenizer.from_file(path)
    want = sorted(whole.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in ROWS)
    assert sum(r["length"] for r in rows) == sum(map(len, want)) and sorted({r["doc_tokens"] for r in rows}) == sorted({len(w) for w in want})
    assert packing.pack_documents(df.limit(0), path).count() == 0


def test_files_are_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(tf, "READ_BYTES", 2000)
    monkeypatch.setattr(tf, "BLOCK_IDS", 100)
    blocks = tf.write_ids(spark.createDataFrame(ROWS * 20, DOCS).repartition(4), public_tokenizers.path("word_bpe_49k.json"), 2)
    rows = tf.read_ids(blocks)
    assert rows.rdd.getNumPartitions() > 4 and rows.count() == 20 * len(ROWS)


def test_repeated_pieces_of_an_encoded_chunk_are_looked_up_once(both):
    """Texts of 1.7 MB are encoded together, so a piece that all of them hold is one key."""
    encoder, _ = both
    seen = []
    batch = pa.RecordBatch.from_pydict({"text": [f"a line {i % 9} of words." * 40 for i in range(2400)]})
    for chunk in text_chunks(batch, "text", ENCODED_BYTES):
        piece_texts(chunk["text"], piece_starts, lambda keys: seen.extend(keys) or encoder.cache(keys))
    assert batch["text"].nbytes > 1.4e6 and len(seen) == len(set(seen))
