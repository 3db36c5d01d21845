from __future__ import annotations

import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewell.llm import scratch, tokens
from tidewell.llm.queries import tokenizer_path


@given(st.lists(st.integers(0, 2**32 - 1), max_size=1500))
@settings(max_examples=60, deadline=None)
def test_levels_round_trip_and_give_any_token(ids):
    levels = tokens.Levels(memoryview(tokens.encode_levels(np.array(ids, np.uint32))))
    assert levels.all().tolist() == ids
    for i in range(0, len(ids), 97):
        assert levels[i] == ids[i]


@given(st.text(alphabet="abXY éßΣςİ\u212a.,!?'-|\n\t\r\x0b\x1c\x85\xa0日ก½🙂e\u0301", max_size=50))
@settings(max_examples=150, deadline=None)
def test_word_wise_ids_are_those_of_the_whole_text(text):
    encoder = tokens.word_encoder(tokenizer_path())
    assert np.frombuffer(encoder([text])[0], "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_files_hold_every_document_in_order(spark, docs, rows):
    found = tokens.token_digest(docs, tokenizer_path()).collect()
    encoder = tokens.word_encoder(tokenizer_path()).tokenizer
    assert len(found) == len(rows)
    by_id = {}
    for r in rows:
        ids = np.array([*encoder.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        by_id.setdefault(r[0], []).append((len(ids), zlib.crc32(ids.tobytes())))
    start = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == start and (r.n_tokens, r.ids_crc32) in by_id[r.doc_id]
        start += r.n_tokens
    order = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))


def test_empty_table(spark, no_docs):
    assert tokens.token_digest(no_docs, tokenizer_path()).count() == 0


def test_single_tokens_are_read_from_the_files(spark, docs):
    path = scratch.new_path(spark, "tokens")
    tokens.write_tokens(docs.limit(5), path, tokenizer_path(), segment_tokens=50)
    for content in spark.read.format("binaryFile").load(path).select("content").collect():
        for segment in tokens.segments(bytes(content.content)):
            assert [segment.tokens[i] for i in range(len(segment.tokens))] == segment.tokens.all().tolist()
