"""Ids equal to the library's, whatever is cut and shared; exact round trips."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wagelens.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, text string, ids string, row string, hash int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], SCHEMA)


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


PIECES = ["a", "b", " ", "  ", "\n", "\t", "'s", "'", "1", "é", " ", "　", "中", " ", "!", "don't", "\r\n", "\x85", "​", "x y", "\x1c", "᠎", "\U0001f600"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), st.data())
def test_joined_chunks_equal_the_whole(text, data):
    places = sorted(data.draw(st.lists(st.integers(0, len(text)), max_size=4)))
    codec = bpe.codec(PATH)
    chunks = [codec.chunk(text[i:j]) for i, j in zip([0, *places], [*places, len(text)])]
    assert bpe.join_chunks(chunks, codec).tolist() == ids_of(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_any_text_round_trips(text):
    codec = bpe.codec(PATH)
    ids = codec.encode_whole(text)
    assert ids.tolist() == ids_of(text) and codec.decode(ids) == text == LIBRARY.decode(ids.tolist(), skip_special_tokens=False)


@pytest.mark.parametrize("text", ["ab cd " * 30_000, "a" * 150_000, " " * 150_000, "é" * 100_000, "a <|endoftext|> b" * 3, "word " * 20_000 + "<|endoftext|>"])
def test_long_and_special_texts(text):
    codec = bpe.codec(PATH)
    assert codec.encode_whole(text).tolist() == ids_of(text) and codec.decode(codec.encode_whole(text)) == text


def test_cuts_follow_content():
    draw = random.Random(4)
    passage = " ".join("".join(draw.choices("abcdeéñ", k=5)) for _ in range(4000)).encode()
    one, two = bpe._pieces(b"before " + passage), bpe._pieces("völlig anders ".encode() * 40 + passage)
    assert b"".join(one) == b"before " + passage
    assert len(set(one) & set(two)) > 0.8 * len(one)
    for data in (b"", b"x", b"\x80" * 50_000, b"a" * 100_000, "é".encode() * 50_000, passage):
        pieces = bpe._pieces(data)
        assert b"".join(pieces) == data and all(pieces) and max(map(len, pieces), default=0) <= bpe.MOST
        if data.startswith("é".encode()):
            assert all(p.decode() for p in pieces)


def test_documents(spark):
    draw = random.Random(8)

    def prose(n):
        return " ".join("".join(draw.choices("etaoinshrdlu", k=draw.randint(1, 9))) + draw.choice(["", "", ",", ".\n", "'s"]) for _ in range(n))

    shared = [prose(900) for _ in range(4)]
    rows = [(i, prose(draw.randint(0, 300)) + draw.choice(["", *shared]) + prose(draw.randint(0, 300)) + draw.choice(["", *shared])) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n "), (103, "x<|endoftext|>" + shared[0]), (104, "a" * 120_000), (104, "a" * 120_000), (None, shared[1]), (105, shared[1] + shared[1]), (106, "é" * 40_000), rows[0]]
    got = bpe.encode_documents(frame(spark, rows), PATH, keep_ids=True).collect()
    assert len(got) == len(rows)

    def digest(doc_id, text):
        ids = np.array(ids_of(text or ""), "<u4").tobytes()
        return str(doc_id), len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(), ids

    want = sorted(digest(*r) for r in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256, bytes(r.ids)) for r in got) == want
    table = bpe.shared_chunks(frame(spark, rows))
    assert table.count() > 5
    assert bpe.encode_documents(frame(spark, []), PATH).count() == 0


def test_false_alarms_of_the_filter_change_nothing(spark, monkeypatch):
    rows = [(i, f"text number {i} " + "lorem ipsum dolor " * i) for i in range(60)]
    want = sorted(map(tuple, bpe.encode_documents(frame(spark, rows), PATH).collect()))
    monkeypatch.setattr(bpe, "chunk_filter", lambda shared: np.full(16, 2**64 - 1, np.uint64))
    assert sorted(map(tuple, bpe.encode_documents(frame(spark, rows), PATH).collect())) == want


@pytest.mark.parametrize("change", [
    {"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": None}, {"decoder": None},
    {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "use_regex": True}},
    {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}},
    {"post_processor": {"type": "TemplateProcessing"}}, "dropout", "unordered", "too few merges", "alphabet",
])
def test_other_kinds_of_files_are_refused(spark, tmp_path, change):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    merges = spec["model"]["merges"]
    if isinstance(change, dict):
        spec.update(change)
    elif change == "dropout":
        spec["model"]["dropout"] = 0.1
    elif change == "unordered":
        merges[5], merges[900] = merges[900], merges[5]
    elif change == "too few merges":
        merges.pop()
    else:
        spec["model"]["vocab"]["☃"] = spec["model"]["vocab"].pop("!")
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError):
        bpe.encode_documents(frame(spark, [(1, "a text")]), str(path))
