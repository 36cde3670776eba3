"""Language identification of whole texts, mixed ones too.

The script of a word narrows its candidate languages; letter n-grams and the word
itself score them; Viterbi with a switching penalty labels spans of words, and the
language with most letters is the text's.  The model is learned from labelled
documents: per language at most ``DOCS_PER_LANGUAGE``, those of least hash, so its
size and cost are bounded however many there are.  Counting them and everything
else covers all rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.llm.viterbi import best_path
from wagelens.session import ship_package

UNKNOWN = "und"
DOCS_PER_LANGUAGE, MOST_LANGUAGES = 4000, 256
FEATURES = 1 << 16
#: least share of a language's training words for a script to be one of its scripts
SCRIPT_SHARE = 0.01
SWITCH_PENALTY = 10.0
#: no word counts for more than this many nats against a candidate, or against a language without its script
WORD_LIMIT, OTHER_SCRIPT = 6.0, 12.0
#: words labelled together with up to four languages, and words whose scores a task keeps
WORDS_AT_ONCE, WORDS_KEPT = 200_000, 300_000
SPAN = "array<struct<start:int,end:int,lang:string>>"

WORD = re.compile(r"[^\W\d_]+")

#: First code points of script ranges; others, between them, are script 0
SCRIPTS = (
    (0x0041, 0x024F), (0x1E00, 0x1EFF), (0x0370, 0x03FF), (0x0400, 0x052F), (0x0530, 0x058F), (0x0590, 0x05FF),
    (0x0600, 0x06FF), (0x0900, 0x097F), (0x0980, 0x09FF), (0x0B80, 0x0BFF), (0x0E00, 0x0E7F), (0x10A0, 0x10FF),
    (0x1100, 0x11FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xAC00, 0xD7AF),
)
#: ranges of the same script: Latin, Hangul
SAME_SCRIPT = {(0x1E00, 0x1EFF): (0x0041, 0x024F), (0xAC00, 0xD7AF): (0x1100, 0x11FF)}
_ORDER = sorted(SCRIPTS)
_FIRST, _LAST = (np.array([r[i] for r in _ORDER]) for i in (0, 1))
_NUMBER = np.array([_ORDER.index(SAME_SCRIPT.get(r, r)) + 1 for r in _ORDER])


def scripts_of(points: np.ndarray) -> np.ndarray:
    """Number of the script range that holds each code point, 0 if none does."""
    at = np.searchsorted(_FIRST, points, "right") - 1
    return np.where((at >= 0) & (points <= _LAST[at]), _NUMBER[at], 0)


def _slot(x: np.ndarray) -> np.ndarray:
    return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(FEATURES)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of many words: (feature, where each word's begin, each word's script).

    Hashed pairs and triples of letters, with marks at the ends, and the whole word,
    all in lower case.  Triples that would leave the word are FEATURES, which weighs nothing.
    """
    lower = [w.lower() for w in words]
    sizes = np.fromiter(map(len, lower), np.int64, len(lower)) + 2
    points = np.frombuffer(("<" + "><".join(lower) + ">").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    ends = np.repeat(starts + sizes, sizes)
    at = np.arange(len(points))
    one, two = (np.concatenate((points[k:], np.zeros(k, np.uint64))) for k in (1, 2))
    pair = points * np.uint64(1 << 21) + one
    triple = (pair * np.uint64(1 << 21) + two) ^ np.uint64(0x5BD1E995)
    power = (np.uint64(0x100000001B3) ** (at - np.repeat(starts, sizes)).astype(np.uint64)) * points
    whole = np.add.reduceat(power, starts)
    # one row per place: its pair, its triple; the place of the last mark has the whole word instead of a pair
    first = _slot(pair)
    first[starts + sizes - 1] = _slot(whole)
    second = np.where(at + 2 < ends, _slot(triple), np.uint64(FEATURES))
    found = np.stack((first, second), axis=1).reshape(-1).astype(np.int64)
    return found, 2 * starts, scripts_of(points[starts + 1].astype(np.int64))


class Model(NamedTuple):
    """Languages by training share, log-likelihood by feature and language, and which scripts each writes."""

    languages: tuple[str, ...]
    weights: np.ndarray
    writes: np.ndarray


def in_training(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def learn(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, most_languages: int = MOST_LANGUAGES) -> Model | None:
    """Fit on documents that are not held out and have text and lang; None if there are none.

    The ``most_languages`` with most documents are learned, which bounds the model; others are
    never predicted.  A null doc_id is not held out (its remainder is null): it is left out of training all the same.
    """
    ship_package(docs.sparkSession)
    given = docs.select("doc_id", "text", "lang").where(in_training(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    frequent = given.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages)
    counts = {r["lang"]: r["count"] for r in frequent.collect()}
    if not counts:
        return None
    languages = tuple(sorted(counts, key=lambda x: (-counts[x], x)))
    top = 1 << 52
    least = {x: min(1.0, docs_per_language / n) * top for x, n in counts.items()}
    draw = F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(top))
    bound = F.create_map(*(v for x in languages for v in (F.lit(x), F.lit(float(least[x])))))
    sample = given.where(draw < bound[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words.setdefault(lang, Counter()).update(WORD.findall(text))
            for lang, counted in words.items():
                if not counted:
                    continue
                found, starts, script = features(list(counted))
                n = np.fromiter(counted.values(), np.float64, len(counted))
                sums = np.bincount(found, np.repeat(n, np.diff(np.append(starts, len(found)))), FEATURES + 1)[:FEATURES]
                sums = np.append(sums, np.bincount(script, n, len(SCRIPTS) + 1))
                at = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(sums[at])], ["lang", "feature", "n"]
                )

    # languages x features numbers, whatever the corpus
    sums = sample.mapInArrow(count, "lang string, feature int, n double").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((FEATURES + len(SCRIPTS) + 1, len(languages)))
    number = {x: i for i, x in enumerate(languages)}
    table[sums["feature"].to_numpy(), [number[x] for x in sums["lang"].to_pylist()]] = sums["n"].to_numpy()
    scripts, table = table[FEATURES:], table[:FEATURES]
    weights = np.log(table + 0.5) - np.log(table.sum(axis=0) + 0.5 * FEATURES)
    weights = np.append(weights, np.zeros((1, len(languages))), axis=0)
    writes = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return Model(languages, weights.astype(np.float32), writes)


class _Scorer:
    """Scores of words seen by this task, kept up to a limit."""

    def __init__(self, model: Model):
        self.model = model
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1024, len(model.languages) + 1), np.float32)

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores by word and language; whether any language writes the word's script."""
        if len(self.rows) > WORDS_KEPT:
            self.rows = {}
        rows = self.rows
        new = list(set(words).difference(rows))
        if new:
            at = len(rows)
            rows.update(zip(new, range(at, at + len(new))))
            if len(rows) > len(self.table):
                self.table = np.concatenate((self.table, np.zeros((2 * len(rows), self.table.shape[1]), np.float32)))
            self.table[at : at + len(new)] = self.score(new)
        found = self.table[np.fromiter(map(rows.__getitem__, words), np.int64, len(words))]
        return found[:, :-1], found[:, -1] > 0

    def score(self, words: list[str]) -> np.ndarray:
        found, starts, script = features(words)
        total = np.add.reduceat(self.model.weights[found], starts, axis=0)
        able = self.model.writes[script]
        known = able.any(axis=1)
        best = np.where(able, total, -np.inf).max(axis=1, initial=-np.inf)
        total = np.maximum(total - np.where(known, best, 0)[:, None], -WORD_LIMIT)
        total = np.where(able, total, -OTHER_SCRIPT)
        return np.column_stack((np.where(known[:, None], total, 0), known))


def _spans(text: str, words: list[str], path: np.ndarray, languages: tuple[str, ...]) -> list[dict]:
    """Runs of one label as code points from the first word's start to the last one's end."""
    if (path == path[0]).all():
        return [{"start": text.index(words[0]), "end": text.rindex(words[-1]) + len(words[-1]), "lang": languages[path[0]]}]
    places = [m.span() for m in WORD.finditer(text) if any(map(str.isalpha, m[0]))]
    cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
    return [
        {"start": places[i][0], "end": places[j - 1][1], "lang": languages[path[i]]} for i, j in zip(cuts, cuts[1:])
    ]


def label(texts: list[str | None], scorer: _Scorer) -> list[tuple[str, float, list[dict]]]:
    """(language, score, spans) of each text."""
    languages = scorer.model.languages
    # a path's memory grows with the square of the languages
    at_once = max(1024, WORDS_AT_ONCE * 16 // max(16, len(languages) ** 2))
    out: list[tuple[str, float, list[dict]]] = []
    at = 0
    while at < len(texts):
        words: list[list[str]] = []
        total = 0
        while at + len(words) < len(texts) and (not words or total < at_once):
            found = WORD.findall(texts[at + len(words)] or "")
            if not all(map(str.isalpha, found)):
                found = [w for w in found if any(map(str.isalpha, w))]
            words.append(found)
            total += len(found)
        flat = [w for ws in words for w in ws]
        sizes = np.fromiter(map(len, flat), np.int64, len(flat))
        ends = np.cumsum([len(ws) for ws in words])
        first = np.zeros(len(flat), bool)
        first[[int(e) - len(ws) for ws, e in zip(words, ends) if ws]] = True
        scores, known = scorer.of(flat)
        path = best_path(scores, first, SWITCH_PENALTY)
        for text, ws, end in zip(texts[at : at + len(words)], words, ends.tolist()):
            if not ws:
                out.append((UNKNOWN, 0.0, []))
                continue
            own = slice(end - len(ws), end)
            letters = np.bincount(path[own], weights=sizes[own], minlength=len(languages))
            most = int(letters.argmax())
            sure = sizes[own][known[own] & (path[own] == most)].sum()
            out.append((languages[most], float(sure / sizes[own].sum()), _spans(text, ws, path[own], languages)))
        at += len(words)
    return out


def _labeller(docs: DataFrame, model: Model):
    """For tasks: a function that gives a scorer's columns of languages, scores and spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES x languages floats

    def start():
        scorer = _Scorer(shared.value)
        return lambda texts: zip(*label(texts, scorer)) if texts else ((), (), ())

    return start


def identify(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, spans): one row per row of ``docs``.

    ``spans`` are code points [start, end) with a language each; ``score`` is the
    share of letters in words of a learned script that are labelled ``lang_pred``.

    Null text and text without a letter are ``und`` with score 0 and no spans.  Words
    in a script that no learned language writes take the label of their surroundings
    and add nothing to the score (with ties, the language with most labelled documents).
    If nothing is labelled, every text is ``und``.  ``held_out`` of a null doc_id is
    false.  Repeated rows are labelled alike; an empty table gives no rows; only
    doc_id, text and lang are read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = learn(rows, docs_per_language)
    held_out = F.coalesce(~in_training(F.col("doc_id")), F.lit(False))
    if model is None:
        return rows.select("doc_id", held_out.alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.array().cast(SPAN).alias("spans"))
    label_texts = _labeller(docs, model)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labelled = label_texts()
        for batch in batches:
            lang, score, spans = labelled(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(spans, span)],
                ["doc_id", "held_out", "lang_pred", "score", "spans"],
            )

    return rows.select("doc_id", "text", held_out.alias("held_out")).mapInArrow(
        run, f"doc_id long, held_out boolean, lang_pred string, score double, spans {SPAN}"
    )


def keep_identified(docs: DataFrame, least: float, docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """The rows whose text has a language with a score of ``least`` or more, with the columns of ``docs``.

    Decided where the row is read: no join, no shuffle of texts.  Without any
    labelled document nothing can be told, and only texts without a letter go.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = learn(rows, docs_per_language)
    label_texts = _labeller(docs, model) if model is not None else None
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labelled = label_texts() if label_texts else None
        for batch in batches:
            texts = batch.column(at).to_pylist()
            if labelled:
                lang, score, _ = labelled(texts)
                keep = [x != UNKNOWN and s >= least for x, s in zip(lang, score)]
            else:
                keep = [t is not None and any(map(str.isalpha, t)) for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
