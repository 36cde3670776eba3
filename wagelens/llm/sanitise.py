"""Information-theoretic sanitisation of personal data.

Direct identifiers are found by pattern.  Terms near them can disclose them as well:
over the corpus, the pointwise mutual information of an entity and a term, as a share
of the entity's own information, tells how much of the entity the term gives away
(1: the term occurs only with it).  Terms are sought near an entity and counted in
whole documents; in all documents with the entity, those above one threshold are
generalised and above a higher one removed, wherever they stand.

Document frequencies are counted over all documents, summed in each task before the
shuffle.  Only documents with identifiers have contexts, a bounded number of words
around each, and places of their words.  By default a pair counts as evidence only from different contexts in
different documents, so copies of a document disclose nothing by being many; with
``least_contexts=1`` the thresholds apply to every pair.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.llm.columns import free_names
from wagelens.llm.personal_data import CARD, EMAIL, KINDS, PHONE, base_spans
from wagelens.llm.staging import stage
from wagelens.session import ship_package

TERM = "term"
#: words on either side of an entity; least letters or digits of a term; least number of different contexts of a pair
WINDOW, LEAST_LETTERS, LEAST_CONTEXTS = 8, 3, 1
#: words beyond Latin say more in less: their least letters, and the last Latin code point
LEAST_OTHER, LATIN = 2, 0x24F
GENERALISE, REMOVE = 0.75, 0.9
TERMS_HELD = 400_000

_WORD = re.compile(r"[^\W_]+")

_TYPE = pa.schema([
    ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("row", pa.int64()),
    *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()),
    ("base", pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))),
    ("near", pa.list_(pa.struct([("entity", pa.int64()), ("context", pa.int64()), ("term", pa.string())]))),
    ("entities", pa.list_(pa.int64())),
    ("words", pa.list_(pa.struct([("term", pa.string()), ("at", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]))),
    ("term", pa.string()), ("docs", pa.int64()),
])
_DDL = (
    "doc_id long, text_hash long, row long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, "
    "base array<struct<start:int,kind:int,end:int>>, "
    "near array<struct<entity:long,context:long,term:string>>, entities array<long>, "
    "words array<struct<term:string,at:array<struct<start:int,end:int>>>>, term string, docs long"
)


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(parts)) - (1 << 63)


def _entity(text: str, kind: str) -> int:
    """The same number for the same entity however it is written."""
    if kind == EMAIL:
        text = text.lower()
    elif kind in (CARD, PHONE):
        text = "".join(filter(str.isdigit, text))
    return _hash(kind, text)


def _eligible(word: str) -> bool:
    return len(word) >= LEAST_LETTERS or len(word) >= LEAST_OTHER and max(word) > chr(LATIN)


class Words:
    """The words of a text outside its identifiers, which cut them; ``ordinal`` counts words and identifiers."""

    def __init__(self, text: str, spans: list[tuple[int, int, int]]):
        self.text = text
        self.starts, self.ends, self.ordinal = array("q"), array("q"), array("q")
        self.of_span = []
        at = n = 0
        for start, _, end in [*spans, (len(text), 0, len(text))]:
            for m in _WORD.finditer(text, at, max(at, start)):
                self.starts.append(m.start())
                self.ends.append(m.end())
                self.ordinal.append(n)
                n += 1
            n += start >= at  # an identifier inside the one before is no step
            self.of_span.append(n - 1)
            at = max(at, end)

    def __getitem__(self, i: int) -> str:
        """A word as terms are written, the same way wherever it stands."""
        return self.text[self.starts[i] : self.ends[i]].lower()

    def eligible(self, i: int) -> bool:
        return _eligible(self.text[self.starts[i] : self.ends[i]])

    def around(self, span: int) -> range:
        """Words at most WINDOW words or identifiers away from an identifier."""
        n = self.of_span[span]
        return range(bisect_left(self.ordinal, n - WINDOW), bisect_right(self.ordinal, n + WINDOW))


def contexts(text: str, spans: list[tuple[int, int, int]], words: Words | None = None) -> list[dict]:
    """Terms in the window around each identifier, outside all of them."""
    words = words or Words(text, spans)
    out = []
    for i, (start, kind, end) in enumerate(spans):
        around = [(words[k], words.eligible(k)) for k in words.around(i)]
        entity = _entity(text[start:end], KINDS[kind])
        context = _hash(*(w for w, _ in around))
        out += [{"entity": entity, "context": context, "term": w} for w, eligible in around if eligible]
    return out


def words_outside(text: str, spans: list[tuple[int, int, int]], words: Words | None = None) -> list[dict]:
    """Each term of a text with all its places outside the identifiers."""
    words = words or Words(text, spans)
    places: dict[str, list[dict]] = {}
    for i in range(len(words.starts)):
        if words.eligible(i):
            places.setdefault(words[i], []).append({"start": words.starts[i], "end": words.ends[i]})
    return [{"term": t, "at": at} for t, at in places.items()]


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _found(docs: DataFrame) -> DataFrame:
    """One row per document with its identifiers and contexts, and rows (term, docs) that count terms."""
    width = len(_TYPE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, counts = TaskContext.get().partitionId() << 33, 0, Counter()

        def counted() -> pa.RecordBatch:
            columns = [pa.nulls(len(counts), f.type) for f in _TYPE]
            columns[width - 2:] = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, schema=_TYPE)

        for batch in batches:
            out = []
            for doc_id, text_hash, text in zip(*(c.to_pylist() for c in batch.columns)):
                row += 1
                spans = base_spans(text)
                kinds = [k for _, k, _ in spans]
                words = Words(text, spans) if spans else None
                outside = words_outside(text, spans, words) if spans else []
                out.append({
                    "doc_id": doc_id, "text_hash": text_hash, "row": part + row,
                    **{f"n_{name}": kinds.count(i) for i, name in enumerate(KINDS)},
                    "base_sha256": hashlib.sha256(_listed(spans).encode()).hexdigest(),
                    "base": [{"start": s, "kind": k, "end": e} for s, k, e in spans],
                    "near": contexts(text, spans, words) if spans else [],
                    "entities": sorted({_entity(text[s:e], KINDS[k]) for s, k, e in spans}),
                    "words": outside,
                })
                counts.update([w["term"] for w in outside] if spans else {w.lower() for w in set(_WORD.findall(text)) if _eligible(w)})
                if len(counts) > TERMS_HELD:
                    yield counted()
                    counts.clear()
            yield pa.RecordBatch.from_pylist(out, _TYPE)
        if counts:
            yield counted()

    ship_package(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(run, _DDL)


def _together(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """(row, entity, term): once for each document with both parts of one of ``pairs``, wherever they stand.

    For each identifier of a document the shorter list is gone through: the terms paired
    with it, or the document's words.  So a long list of rare identifiers costs what is
    paired with them, and a frequent identifier the words of its documents, never each
    word with each identifier.
    """
    sizes = pairs.groupBy("entity").agg(F.count(F.lit(1)).alias("paired"))
    rows = found.where("size(entities) > 0")
    held = rows.select("row", F.size("words").alias("n_words"), F.explode("entities").alias("entity")).join(sizes.hint("merge"), "entity")
    words = rows.select("row", F.explode("words.term").alias("term"))
    few = held.where("paired <= n_words").select("row", "entity").join(pairs.select("entity", "term").hint("merge"), "entity")
    few = few.join(words.hint("merge"), ["row", "term"], "left_semi")
    many = held.where("paired > n_words").select("row", "entity").join(words.hint("merge"), "row")
    many = many.join(pairs.select("entity", "term").hint("merge"), ["entity", "term"], "left_semi")
    return few.select("row", "entity", "term").unionByName(many.select("row", "entity", "term"))


def disclosing_terms(found: DataFrame, generalise: float, remove: float, least_contexts: int = LEAST_CONTEXTS) -> DataFrame:
    """(entity, term, disclosure, action) for pairs above the threshold.

    A pair needs ``least_contexts`` documents and as many different contexts; with 1, every pair is judged.
    """
    total = found.where("row is not null").count()
    near = found.where("size(near) > 0").select(F.explode("near").alias("n")).select("n.entity", "n.context", "n.term")
    # pairs are found near an identifier and counted in whole documents
    contexts_of = near.distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("contexts"))
    candidates = stage(contexts_of.where(F.col("contexts") >= least_contexts), "candidates")
    together = _together(found, candidates).groupBy("entity", "term").agg(F.count(F.lit(1)).alias("together"))
    evidence = stage(together.where(F.col("together") >= least_contexts), "evidence")
    entities = found.where("size(entities) > 0").select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("entity_docs"))
    terms = found.where("term is not null").select("term", "docs")
    terms = terms.join(evidence.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("docs").alias("term_docs"))
    known = evidence.join(entities, "entity").join(terms, "term")
    # PMI / information of the entity = 1 + log(together / term docs) / log(all / entity docs)
    own = F.log(F.lit(float(max(total, 1))) / F.col("entity_docs"))
    told = F.when(own > 0, 1 + F.log(F.least(F.col("together"), F.col("term_docs")) / F.col("term_docs")) / own).otherwise(0.0)
    known = known.select("entity", "term", told.alias("disclosure")).where(F.col("disclosure") >= generalise)
    return known.withColumn("action", F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise"))


def _span(kind: Column, start: Column, end: Column, action: Column) -> Column:
    return F.struct(start.alias("start"), kind.alias("kind"), end.alias("end"), action.alias("action"))


def find_spans(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, least_contexts: int = LEAST_CONTEXTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_email, n_ip, n_card, n_phone, base_sha256, found.

    ``found`` has (start, kind, end, action) by start, then kind; kinds 0 to 3 are the
    identifiers, which are always masked, 4 is a disclosing term, wherever it stands in
    a document with its entity.  ``base_sha256`` is
    of the identifiers alone.

    Null text is empty; text without identifiers has no spans.  Every row counts as a
    document, repeated ones too, but a pair is judged only with ``least_contexts``
    documents and different contexts; 1 judges every pair.  Null ids stay null; an empty table gives no rows; only doc_id and text are read.
    """
    found = stage(_found(docs), "found")
    terms = stage(disclosing_terms(found, generalise, remove, least_contexts), "terms")
    actions = _together(found, terms).join(terms, ["entity", "term"]).groupBy("row", "term").agg(F.max("action").alias("action"))
    words = found.where("size(words) > 0").select("row", F.explode("words").alias("w")).select("row", "w.term", "w.at")
    spans = words.join(actions, ["row", "term"]).select("row", F.explode("at").alias("at"), "action").select("row", "at.*", "action")
    added = spans.groupBy("row").agg(
        F.collect_list(_span(F.lit(len(KINDS)), F.col("start"), F.col("end"), F.col("action"))).alias("added")
    )
    base = F.transform("base", lambda x: _span(x["kind"], x["start"], x["end"], F.lit("mask")))
    rows = found.where("row is not null").join(added, "row", "left")
    every = F.array_sort(F.concat(base, F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int,action:string>>"))))
    return rows.select("doc_id", "text_hash", *(f"n_{k}" for k in KINDS), "base_sha256", every.alias("found"))


def listed(found: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*(F.lit(k) for k in (*KINDS, TERM)))
    return F.array_join(
        F.transform(found, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def masked(text: str, spans: list) -> str:
    """Identifiers become [kind], removed terms nothing, generalised terms their first letter and a star."""
    out, at = [], 0
    for start, kind, end, action in spans:
        if end <= at:
            continue  # inside a longer one
        out.append(text[at : max(at, start)])
        if kind < len(KINDS):
            out.append(f"[{KINDS[kind]}]")
        elif action == "generalise":
            out.append(text[start] + "*")
        at = end
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with its columns and the text masked; rows without spans, null ones too, stay as they are.

    Further columns keep their names and values, whatever they are called.
    """
    id_, hash_, found_ = free_names(docs, "id", "hash", "found")
    spans = find_spans(docs, **options).where("size(found) > 0").select(
        F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), F.col("found").alias(found_)
    ).dropDuplicates([id_, hash_])
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64(docs["text"]) == F.col(hash_))

    @F.pandas_udf("string")
    def mask(text: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([
            None if f is None else masked(t, [(x["start"], x["kind"], x["end"], x["action"]) for x in f]) for t, f in zip(text, found)
        ])

    joined = docs.join(spans.hint("merge"), same, "left")
    touched = F.when(F.col(found_).isNotNull(), docs["text"])  # other texts stay out of Python
    new = F.coalesce(mask(touched, F.col(found_)), docs["text"])
    return joined.select(*(new.alias(c) if c == "text" else docs[c] for c in docs.columns))
