import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from calltide.llm import token_binary, token_counts
from calltide.llm.queries import vocabulary
from calltide.llm.token_binary import EliasFano
from calltide.llm.tokens import word_encoder
from calltide.sources.scratch import shared_dir


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcXYZéÉßñÿ ,.!'0129́\n\t\x1c\x00\x7f ΣσİıþÞ×÷<|>endoftext", max_size=30))
def test_cached_words_encode_like_the_whole_text(text):
    encoder = word_encoder(vocabulary())
    assert encoder.encode(text) == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300))
def test_elias_fano_gives_back_its_values(steps):
    values = np.cumsum(np.array(steps, np.int64))
    coded = EliasFano.encode(values)
    assert coded.values().tolist() == values.tolist()
    assert [coded.select(i) for i in range(len(values))] == values.tolist()
    bits = 8 * (len(coded.low) + len(coded.high))
    top = int(values[-1]) if len(values) else 0
    assert bits <= len(values) * (3 + max(0, np.log2(max(top, 1) / max(len(values), 1)))) + 16


def test_elias_fano_refuses_falling_values():
    with pytest.raises(ValueError):
        EliasFano.encode(np.array([3, 2]))


@pytest.mark.parametrize("shard_ids", [50, 1 << 20])
def test_token_files_round_trip(spark, frame, edge_rows, tokenizer, shard_ids):
    path = shared_dir(spark, "files")
    token_binary.write_token_files(frame(edge_rows), path, vocabulary(), shard_ids=shard_ids, partitions=3)
    got = token_binary.document_index(token_binary.read_token_files(spark, path)).collect()
    got = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in edge_rows), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
    want = []
    for doc, text in ((r[0], r[1]) for r in edge_rows):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((str(doc), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(want)


def test_no_documents_give_no_token_files(spark, frame):
    path = shared_dir(spark, "files")
    token_binary.write_token_files(frame([]), path, vocabulary())
    assert token_binary.document_index(token_binary.read_token_files(spark, path)).count() == 0


@pytest.mark.parametrize("block_ids", [3, 1000, 1 << 18])
def test_scan_counts_tokens_across_blocks(spark, frame, edge_rows, tokenizer, block_ids):
    path, end = shared_dir(spark, "flat"), 49_408
    token_counts.write_flat(frame(edge_rows[:10] if block_ids == 3 else edge_rows), path, vocabulary(), end, block_ids=block_ids)
    got = token_counts.scan(spark.read.schema(token_counts.BLOCK_SCHEMA).parquet(path), end).collect()
    rows = edge_rows[:10] if block_ids == 3 else edge_rows
    want = [(str(r[0]), len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows]
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted(want)
    assert all(r.closed for r in got)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 9))
def test_scan_of_plain_files(spark, tmp_path_factory, ids, block_ids):
    folder = tmp_path_factory.mktemp("raw")
    np.array(ids, "<u2").tofile(folder / "a.bin")
    got = token_counts.scan(token_counts.raw_blocks(spark, str(folder), 2, block_ids), 0).orderBy("document").collect()
    want, start = [], 0
    for i, x in enumerate(ids):
        if x == 0:
            want.append((start, i - start, True))
            start = i + 1
    if start < len(ids):
        want.append((start, len(ids) - start, False))
    assert [(r.start, r.n_tokens, r.closed) for r in got] == want
    assert [r.document for r in got] == list(range(len(want)))


def test_scan_of_nothing(spark, frame):
    path = shared_dir(spark, "flat")
    token_counts.write_flat(frame([]), path, vocabulary(), 49_408)
    assert token_counts.scan(spark.read.schema(token_counts.BLOCK_SCHEMA).parquet(path), 49_408).count() == 0


def test_ids_far_apart_make_shards_of_their_own(spark, tmp_path):
    ids = [None, None, -(1 << 63), -5, 0, 0, 3, (1 << 62) - 1, 1 << 62, (1 << 63) - 1]
    docs = spark.createDataFrame([(i, f"text {n}") for n, i in enumerate(ids)], "doc_id long, text string")
    token_binary.write_token_files(docs, str(tmp_path / "far"), vocabulary(), partitions=1)
    shards = token_binary.read_token_files(spark, str(tmp_path / "far"))
    got = token_binary.document_index(shards).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(ids, key=lambda i: (i is not None, i or 0)) and shards.count() >= 3
