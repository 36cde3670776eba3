"""Byte-level BPE with reuse of content-defined chunks.

Texts are cut where a rolling hash of the last bytes hits a pattern, so the same
passage is cut alike in every document.  A chunk that occurs more than once in the
corpus is encoded once; its ids are joined to all its occurrences.  Chunk joins are
then repaired: the text around a join is encoded again, in a window that widens to
both sides until it begins and ends where encoding cannot depend on what lies beyond.

Such a place is a blank or line feed after a character that is no white space: the
split pattern of this family never matches across it, and matches from there on
depend on later text only.  So ids up to the place before a join, ids of the window,
and ids from the place after it are together exactly the ids of the whole text.

Only hashes of chunks are shuffled for all documents.  Which chunks may be shared is
told to the tasks by a Bloom filter of bounded size: a false alarm costs work, never
a result.  Documents without shared chunks are finished where they are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wagelens.llm.staging import stage
from wagelens.session import ship_package

#: bytes of the rolling hash and bytes of a chunk: least, usual beyond that (both powers of two), most
WINDOW, LEAST, USUAL, MOST = 16, 256, 1024, 16384
#: bits of the filter: at most 16 MB, about 10 a shared chunk until then; hashes a chunk
FILTER_BITS, FILTER_HASHES, BITS_A_CHUNK = 1 << 27, 4, 10
#: bytes of a batch of rows
BATCH_BYTES = 16 << 20
#: longer pieces go to the library itself, whose merging is not quadratic in a piece
LONG_PIECE = 1 << 16

_FACTOR = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_FACTOR, k, 1 << 64) for k in range(WINDOW)], dtype=np.uint64)
_TABLE = np.array([xxhash.xxh64_intdigest(bytes([b])) for b in range(256)], dtype=np.uint64)
#: a blank or line feed after a character that is surely no white space
_SAFE = re.compile(
    "(?<=[!-~¡-ᙿᚁ-᠍᠏-῿‰-⁞⁰-⿿、-﻾＀-\U0010ffff])[ \n]"
)


#: how this family splits texts before merging (fixed value of the file format)
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in files of this family."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def check_spec(spec: dict) -> None:
    """Refuse a tokenizer file for which the faster encoder or the safe places could differ from the library."""
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model.get("merges", ())]
    ranks = [model.get("vocab", {}).get("".join(m), -1) for m in merges]
    single = {c for c in model.get("vocab", {}) if len(c) == 1}
    wrong = {
        "model": model.get("type", "BPE") != "BPE" or any(model.get(k) for k in (
            "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")),
        "normalizer": spec["normalizer"] is not None,
        "pre_tokenizer": split.get("type") != "ByteLevel" or split.get("add_prefix_space", True) or not split.get("use_regex", True),
        "post_processor": (spec.get("post_processor") or {}).get("type", "ByteLevel") != "ByteLevel",
        "decoder": (spec.get("decoder") or {}).get("type") != "ByteLevel",
        "merges": ranks != sorted(set(ranks)) or -1 in ranks or len(ranks) + len(single) != len(model["vocab"]),
        "alphabet": single != set(_byte_letters()),
    }
    if any(wrong.values()):
        raise ValueError(f"not a plain byte-level BPE file, see {', '.join(k for k, v in wrong.items() if v)}")


class Codec:
    """A byte-level BPE tokenizer file: its library, a faster equal encoder, and its bytes by id.

    Files with a normaliser, another way of splitting, or merges out of the order of their ids are refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        check_spec(spec)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        byte = _byte_letters()
        vocab = {bytes(byte[c] for c in piece): i for piece, i in spec["model"]["vocab"].items()}
        self.fast = tiktoken.Encoding("codec", pat_str=SPLIT, mergeable_ranks=vocab, special_tokens={})
        self.added = [t["content"] for t in spec["added_tokens"]]
        pieces = {i: p for p, i in vocab.items()} | {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.pieces = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.kind = "<u2" if len(self.pieces) <= 1 << 16 else "<u4"  # of ids on their way between tasks

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text without added tokens."""
        if len(text) > LONG_PIECE:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(self.fast.encode_ordinary(text), dtype="<u4")

    def encode_whole(self, text: str) -> np.ndarray:
        """Ids of any text; added tokens in it become their ids, as the library has it."""
        if any(t in text for t in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")
        if len(text) <= LONG_PIECE:
            return self.encode(text)
        return join_chunks([self.chunk(text[i : i + LONG_PIECE]) for i in range(0, len(text), LONG_PIECE)], self)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")

    def chunk(self, text: str) -> Chunk:
        """Encode what lies between the first and the last safe place; keep the text outside."""
        start = _SAFE.search(text)
        if start is None:
            return Chunk(text, None, "")
        span, last = 128, None
        while last is None:  # the last safe place, searched for from the end
            at = max(start.start(), len(text) - span)
            last = max((m.start() for m in _SAFE.finditer(text, at)), default=None)
            span *= 4
        return Chunk(text[: start.start()], self.encode(text[start.start() : last]), text[last:])


class Chunk(NamedTuple):
    """Ids from the first to the last safe place, and the text before and after; without a safe place all is head."""

    head: str
    ids: np.ndarray | None
    tail: str


def join_chunks(chunks: list[Chunk], codec: Codec) -> np.ndarray:
    """Ids of the joined text: each join is encoded anew from safe place to safe place."""
    parts: list[np.ndarray] = []
    window = ""
    for c in chunks:
        if c.ids is None:
            window += c.head  # no safe place: widen
            continue
        # the head itself may begin with a safe place once its left neighbour is known; encoding covers that
        parts.append(codec.encode(window + c.head))
        parts.append(c.ids)
        window = c.tail
    parts.append(codec.encode(window))
    return np.concatenate(parts)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per Python worker."""
    return Codec(path)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of a text in UTF-8, by its content; never inside a character."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    raw = np.frombuffer(data, np.uint8)
    values = _TABLE[raw]
    rolling, width = values, 1
    while width < WINDOW:  # the hash of 2w bytes from two hashes of w
        rolling = np.concatenate((rolling[:width], rolling[width:] + rolling[:-width] * _POWERS[width]))
        width *= 2
    hits = np.flatnonzero((rolling >> np.uint64(32)) & np.uint64(USUAL - 1) == 0) + 1
    out, start = [], 0
    for hit in [*hits.tolist(), n]:
        while hit - start > MOST:  # no pattern in sight
            cut = start + MOST
            while cut > start + LEAST and raw[cut] & 0xC0 == 0x80:
                cut -= 1
            out.append(cut)
            start = cut
        if hit == n or (hit - start >= LEAST and raw[hit] & 0xC0 != 0x80):
            out.append(hit)
            start = hit
    return out


def _pieces(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[i:j] for i, j in zip([0, *ends], ends)]


def _hash(piece: bytes) -> bytes:
    return xxhash.xxh3_128_digest(piece)


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Filter bits of 16-byte hashes, FILTER_HASHES each."""
    a, b = hashes[:, :1], hashes[:, 1:] | np.uint64(1)
    return (a + b * np.arange(FILTER_HASHES, dtype=np.uint64)) % np.uint64(bits)


def _as_words(hashes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(hashes), "<u8").reshape(-1, 2)


def _bytes_of(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def shared_chunks(docs: DataFrame) -> DataFrame:
    """(hash): chunks that occur more than once, in one text or several; equal texts of a batch are one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [_hash(p) for t in dict.fromkeys(batch.column(0).to_pylist()) for p in _pieces(t)]
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.binary())], ["hash"])

    ship_package(docs.sparkSession)
    found = _bytes_of(docs).select("text").mapInArrow(run, "hash binary")
    return found.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")


def chunk_filter(shared: DataFrame) -> np.ndarray:
    """A Bloom filter of the hashes, as bytes; at most FILTER_BITS bits reach the driver."""
    n = shared.count()
    bits = min(FILTER_BITS, max(1 << 10, 1 << (BITS_A_CHUNK * n).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = np.unique(_slots(_as_words(batch.column(0).to_pylist()), bits)) if batch.num_rows else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array((slots >> np.uint64(6)).astype(np.int64)), pa.array((slots & np.uint64(63)).astype(np.int32))], ["word", "bit"])

    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    words = shared.mapInArrow(run, "word long, bit int").groupBy("word").agg(F.bit_or(mask).alias("mask")).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[words["word"].to_numpy()] = words["mask"].to_numpy().view(np.uint64)
    return table


def _maybe_shared(hashes: list[bytes], table: np.ndarray) -> np.ndarray:
    slots = _slots(_as_words(hashes), len(table) * 64)
    return ((table[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1)).all(axis=1)


RESULT = [("doc_id", "long"), ("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string"), ("ids", "binary")]
RESULT_TYPE = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("ids", pa.binary())])


def _result(ids: np.ndarray, c: Codec, keep_ids: bool) -> dict:
    raw = ids.astype("<u4").tobytes()
    text = c.decode(ids)
    return {
        "n_tokens": len(ids), "ids_sha256": hashlib.sha256(raw).hexdigest(),
        "decoded_sha256": hashlib.sha256(text.encode("utf-8", "replace")).hexdigest(), "ids": raw if keep_ids else None,
    }


PART_TYPE = pa.schema([
    *RESULT_TYPE, ("row", pa.int64()), ("docs", pa.list_(pa.int64())), ("pos", pa.int32()), ("hash", pa.binary()), ("chunk", pa.binary()),
    ("head", pa.string()), ("core", pa.binary()), ("tail", pa.string()),
])
PART = ", ".join(f"{n} {t}" for n, t in [*RESULT, ("row", "long"), ("docs", "array<long>"), ("pos", "int"), ("hash", "binary"), ("chunk", "binary"), ("head", "string"), ("core", "binary"), ("tail", "string")])


CHUNK_TYPE = pa.schema([("of", pa.binary()), ("head", pa.string()), ("core", pa.binary()), ("tail", pa.string())])


def _in_batches(rows: Iterator[dict], kind: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size, however often a long text occurs."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row.values() if isinstance(v, (bytes, str)))
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, kind)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, kind)


def _packed(chunk: Chunk, c: Codec) -> dict:
    return {"head": chunk.head, "core": None if chunk.ids is None else chunk.ids.astype(c.kind).tobytes(), "tail": chunk.tail}


def _unpacked(head: str, core: bytes | None, tail: str, c: Codec) -> Chunk:
    return Chunk(head, None if core is None else np.frombuffer(core, c.kind).astype("<u4"), tail)


def encode_documents(docs: DataFrame, tokenizer: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids), one row per row of ``docs``.

    ``tokenizer`` names a byte-level BPE file that every executor has.  Ids are those
    of its library without special tokens added and without truncation or padding;
    ``ids`` holds them as little-endian 32-bit numbers if ``keep_ids``, else null.

    Null text is the empty text: no ids, and the hash of nothing.  Text of any length
    is encoded whole; the string of an added token becomes its id.  A file that is no plain
    byte-level BPE file is refused.  Repeated rows give
    repeated results, null ids stay null, an empty table gives no rows, and only
    doc_id and text are read.
    """
    spark = docs.sparkSession
    codec(tokenizer)  # refuses other kinds of files before any work
    shared = stage(shared_chunks(docs), "shared")
    table = spark.sparkContext.broadcast(chunk_filter(shared))  # at most FILTER_BITS

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(parts_of(batches), PART_TYPE)

    def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        c, part, row = codec(tokenizer), TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            texts: dict[bytes, list] = {}  # equal texts of a batch are one
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(data, []).append(doc_id)
            for data, doc_ids in texts.items():
                text = data.decode("utf-8", "replace")
                pieces = _pieces(data) if not any(t in text for t in c.added) else []
                hashes = [_hash(p) for p in pieces]
                maybe = _maybe_shared(hashes, table.value) if hashes else np.zeros(0, bool)
                if not maybe.any():
                    result = _result(c.encode_whole(text), c, keep_ids)
                    yield from ({"doc_id": d} | result for d in doc_ids)
                    continue
                row += 1
                start = 0
                while start < len(pieces):
                    end = start + 1
                    if not maybe[start]:  # chunks that are not shared, up to the next that is, are one
                        while end < len(pieces) and not maybe[end]:
                            end += 1
                    more = {"row": part + row, "pos": start, "docs": None if start else doc_ids}
                    if maybe[start]:
                        yield more | {"hash": hashes[start], "chunk": pieces[start]}
                    else:
                        yield more | _packed(c.chunk(b"".join(pieces[start:end]).decode("utf-8", "replace")), c)
                    start = end

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        rows = (
            {"of": h} | _packed(c.chunk(p.decode("utf-8", "replace")), c)
            for batch in batches for h, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        )
        return _in_batches(rows, CHUNK_TYPE)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(joined(batches), RESULT_TYPE)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        c = codec(tokenizer)
        parts = (p for batch in batches for p in zip(*(x.to_pylist() for x in batch.columns)))
        for _, own in groupby(parts, itemgetter(0)):
            first = next(own)
            chunks = [_unpacked(*p[2:], c) for p in chain((first,), own)]
            result = _result(join_chunks(chunks, c), c, keep_ids)
            yield from ({"doc_id": d} | result for d in first[1])

    parts = stage(_bytes_of(docs).mapInArrow(split, PART), "parts")
    result = ", ".join(f"{n} {t}" for n, t in RESULT)
    names = [n for n, _ in RESULT]
    chunks = parts.where("hash is not null")
    once = chunks.groupBy("hash").agg(F.any_value("chunk").alias("chunk")).mapInArrow(
        encode, "of binary, head string, core binary, tail string"
    )
    filled = chunks.select("row", "docs", "pos", "hash").join(once, F.col("hash") == F.col("of"))
    own = parts.where("row is not null and hash is null")
    columns = ["row", "pos", "docs", "head", "core", "tail"]
    rows = own.select(columns).unionByName(filled.select(columns))
    ordered = rows.repartition("row").sortWithinPartitions("row", "pos").select("row", "docs", "head", "core", "tail")
    return parts.where("row is null").select(names).unionByName(ordered.mapInArrow(join, result))
