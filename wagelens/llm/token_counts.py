"""Token counts of a SentencePiece BPE model with a shortcut for whole tokens.

Merging two symbols needs a piece that holds them side by side, so a text may be cut
wherever no piece of the vocabulary has those two characters as neighbours: merges on
either side never meet.  From the vocabulary alone follow classes of characters that
pieces join; a pre-token is a run of blanks with a run of one class after it, and the
tokens of a text are those of its pre-tokens.

Offline, once a job, the library encodes every vocabulary string that is a pre-token by
itself.  Those that come back as one token are proven and cost a table lookup in the
texts.  All other pre-tokens are merged by the library, the frequent ones once a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.session import ship_package

SPACE = "▁"
#: code points of a text split at once; pre-tokens split at once in longer texts
PIECE, PRE_TOKENS = 1 << 20, 1 << 16
#: counts of merged pre-tokens a task keeps, and the longest pre-token kept
KEPT, KEPT_LENGTH = 1 << 19, 64
#: up to so many are encoded one by one: the library starts a thread for a list
FEW = 64
#: fields of the model file and their values, as its public format numbers them
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MODEL_TYPE, BPE, SUFFIX_SPACES = 3, 2, 24
CHARSMAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES, RULES = 2, 3, 4, 5, 6


class Shortcut(NamedTuple):
    """What is proven of a model: how texts split into pre-tokens, and which pre-tokens are one token."""

    pattern: str
    whole: frozenset[str]
    apart: str  # a character that no piece joins to another
    prefix: bool  # the library puts a blank before a text


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        shift, at = shift + 7, at + 1
        if data[at - 1] < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field, value) of a message in the protocol-buffer wire format."""
    at = 0
    while at < len(data):
        key, at = _number(data, at)
        if key & 7 == 0:
            value, at = _number(data, at)
        else:
            size, at = _number(data, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


def _settings(path: str) -> tuple[list[str], bool]:
    """Vocabulary strings that merging may give and whether a blank is put first; raises where the cuts are not proven."""
    with open(path, "rb") as f:
        model = list(_fields(f.read()))
    trainer = {k: v for field, part in model if field == TRAINER for k, v in _fields(part)}
    normalizer = {k: v for field, part in model if field == NORMALIZER for k, v in _fields(part)}
    plain = not normalizer.get(CHARSMAP) and not normalizer.get(RULES) and not normalizer.get(REMOVE_SPACES, 1)
    if not plain or not normalizer.get(ESCAPE_SPACES, 1) or trainer.get(MODEL_TYPE) != BPE or trainer.get(SUFFIX_SPACES):
        raise ValueError(f"{path}: not a BPE model that leaves texts as they are")
    found = []
    for piece in (dict(_fields(part)) for field, part in model if field == PIECES):
        if piece.get(3, NORMAL) not in (NORMAL, UNKNOWN, CONTROL, BYTE):
            raise ValueError(f"{path}: piece of a kind that is matched before merging")
        if piece.get(3, NORMAL) == NORMAL:
            found.append(piece[1].decode())
    return found, bool(normalizer.get(DUMMY_PREFIX, 1))


def classes(pieces: list[str]) -> list[set[str]]:
    """Classes of characters, blanks left out, that stand side by side in some piece, largest first."""
    root: dict[str, str] = {}

    def find(c: str) -> str:
        while root.setdefault(c, c) != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    for piece in pieces:
        for a, b in zip(piece, piece[1:]):
            if b == SPACE and a != SPACE:
                raise ValueError(f"piece {piece!r} joins a blank to what stands before it")
            if a != SPACE:
                root[find(a)] = find(b)
    found: dict[str, set[str]] = {}
    for c in list(root):
        found.setdefault(find(c), set()).add(c)
    return sorted(found.values(), key=lambda x: (-len(x), min(x)))


def prove(path: str) -> Shortcut:
    """Find the pre-tokens of a model and those vocabulary strings that encode alone as one token."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, prefix = _settings(path)
    joined = classes(pieces)
    arms = ["[" + "".join(map(re.escape, sorted(c))) + "]+" for c in joined]
    pattern = f"{SPACE}*(?:{'|'.join([*arms, f'[^{SPACE}]'])})|{SPACE}+"
    in_class = set().union(*joined)
    apart = next(c for c in "\n\0\x01" if c not in in_class and SPACE + c not in pieces)
    shortcut = Shortcut(pattern, frozenset(), apart, prefix)
    alone = [p for p in pieces if re.fullmatch(pattern, p)]
    return shortcut._replace(whole=frozenset(p for p, n in zip(alone, merged(model, shortcut, alone)) if n == 1))


def merged(model: sentencepiece.SentencePieceProcessor, shortcut: Shortcut, pre_tokens: list[str]) -> list[int]:
    """Number of tokens of each pre-token by the library's own merging.

    The library may put a blank before a text.  A pre-token that begins with a blank
    takes that one for its own; any other is set behind a character that joins nothing.
    """
    own = [shortcut.prefix and t[0] == SPACE and len(t) > 1 for t in pre_tokens]
    texts = [t[1:] if begins else shortcut.apart + t for t, begins in zip(pre_tokens, own)]
    before = len(model.encode(shortcut.apart))
    found = model.encode(texts, num_threads=1) if len(texts) > FEW else map(model.encode, texts)
    return [len(ids) - (0 if begins else before) for ids, begins in zip(found, own)]


class Counter:
    """Counts tokens of texts; one a task."""

    def __init__(self, path: str, shortcut: Shortcut):
        self.model, self.shortcut = _model(path), shortcut
        self.split = re.compile(shortcut.pattern)
        self.known = dict.fromkeys(shortcut.whole, 1)

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = SPACE * self.shortcut.prefix + text.replace(" ", SPACE)
        if len(text) <= PIECE:
            return self.add(self.split.findall(text))
        found = (m.group() for m in self.split.finditer(text))
        total = 0
        while some := list(islice(found, PRE_TOKENS)):
            total += self.add(some)
        return total

    def add(self, pre_tokens: list[str]) -> int:
        try:
            return sum(map(self.known.__getitem__, pre_tokens))
        except KeyError:
            new = list(set(pre_tokens).difference(self.known))
            self.known.update(zip(new, merged(self.model, self.shortcut, new)))
        total = sum(map(self.known.__getitem__, pre_tokens))
        for t in new:
            if len(t) > KEPT_LENGTH:
                del self.known[t]
        if len(self.known) > KEPT + len(self.shortcut.whole):
            self.known = dict.fromkeys(self.shortcut.whole, 1)
        return total


@lru_cache(maxsize=2)
def _model(path: str) -> sentencepiece.SentencePieceProcessor:
    """One model per Python worker."""
    return sentencepiece.SentencePieceProcessor(model_file=path)


def count_tokens(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``.

    ``model`` names a SentencePiece BPE file that every executor has; one whose cuts are
    not proven by its vocabulary and settings is refused.  Counts are those of the library
    without begin, end or added tokens, special strings being ordinary text.  ``n_bytes``
    is the length in UTF-8; ``over_limit`` says that n_tokens is above ``limit``.

    Null and empty texts have 0 of both; texts of any length are counted whole; a null
    doc_id stays null; repeated rows give repeated results, no rows none; other columns
    are not read.  Rows stay in the tasks that read them: nothing is shuffled.
    """
    spark = docs.sparkSession
    proven = spark.sparkContext.broadcast(prove(model))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(model, proven.value)
        for batch in batches:
            n = pa.array([counter.count(t.as_py() or "") for t in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], ["doc_id", "n_bytes", "n_tokens"])

    ship_package(spark)
    text = F.col("text").cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("n_bytes"), text.alias("text"))
    found = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
