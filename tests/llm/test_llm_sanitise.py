"""Identifiers against their patterns, disclosure against counting by hand."""

import hashlib
import math
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from wagelens.llm import sanitise
from wagelens.llm.personal_data import KINDS, base_spans, luhn

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The patterns as written, slow but short."""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[ -]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(re.findall("[0-9]", m[0])) <= 15]
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab@.-+%_ 0129()é\n", max_size=60))
def test_spans_equal_the_patterns(text):
    assert base_spans(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a@b.c", "x.y@", "1.2.3.4", "256.1.1.1", "4404 1894 9746 0879 5", "+1 (386) 555-3733", "12345678901234", ".", " ", "-", "@", "9"]), max_size=12).map("".join))
def test_spans_of_joined_pieces(text):
    assert base_spans(text) == plain(text)


def test_luhn():
    assert luhn("4539578763621486") and not luhn("4539578763621487")


def test_long_hostile_texts_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 300_000, "a@" * 150_000, "+1" * 150_000, "+1" + "(" * 300_000, "1" * 150_000 + ".1.1"):
        assert isinstance(base_spans(text), list)


CLASH = "doc_id long, text string, row int, term string, kind string, found string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash", "clash", "clash") for r in rows], CLASH)


def test_rows_of_every_kind(spark):
    rows = [(1, None), (2, ""), (3, "mail a.b@c.de now"), (3, "mail a.b@c.de now"), (None, "é 10.0.0.1, +1 (386) 555-3733"), (5, "x" * 100_000)]
    got = sanitise.find_spans(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id == 3:
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 0, 0, 0)
            assert r.base_sha256 == hashlib.sha256(b"email:5:13").hexdigest()
        elif r.doc_id is None:
            assert r.base_sha256 == hashlib.sha256(b"ip:2:10,phone:12:29").hexdigest()
        else:
            assert r.base_sha256 == hashlib.sha256(b"").hexdigest() and r.found == []
    assert sanitise.find_spans(frame(spark, [])).count() == 0


def corpus():
    rows = [(i, f"the quick fox {i % 7} jumps over lazy dogs every day number") for i in range(60)]
    rows += [(100 + i, f"well the zanzibar office wrote {w} to boss@corp.example about zanzibar today") for i, w in enumerate(["once", "twice", "thrice"])]
    rows += [(200 + i, "copy says krakatoa to lone@corp.example again") for i in range(5)]
    rows += [(300, "one text says vesuvius to twice@corp.example and vesuvius again to twice@corp.example at once")]
    return rows


def test_disclosure_against_counting(spark):
    rows = corpus()
    docs = frame(spark, rows)
    found = sanitise._found(docs).persist()
    got = {(r.entity, r.term): (r.disclosure, r.action) for r in sanitise.disclosing_terms(found, 0.3, 0.9, least_contexts=2).collect()}
    terms, entities, pairs, contexts = Counter(), Counter(), Counter(), {}
    for _, text in rows:
        least = {}
        terms.update(set(re.findall(r"[^\W\d_]+", text.lower())))
        near = sanitise.contexts(text, base_spans(text))
        entities.update({x["entity"] for x in near})
        pairs.update({(x["entity"], x["term"]) for x in near})
        for x in near:
            key = x["entity"], x["term"]
            least[key] = min(least.get(key, x["context"]), x["context"])
        for key, context in least.items():
            contexts.setdefault(key, set()).add(context)
    want = {}
    for (e, t), n in pairs.items():
        value = 1 + math.log(n / terms[t]) / math.log(len(rows) / entities[e])
        if len(contexts[e, t]) >= 2 and value >= 0.3:
            want[e, t] = value
    assert want and got.keys() == want.keys()
    assert all(abs(got[k][0] - v) < 1e-9 and got[k][1] == ("remove" if v >= 0.9 else "generalise") for k, v in want.items())
    found.unpersist()


def test_texts_are_masked(spark):
    out = {r.doc_id: r for r in sanitise.sanitise(frame(spark, corpus()), least_contexts=2).collect()}
    assert out[100].text.count("zanzibar") == 0 and "[email]" in out[100].text
    assert "krakatoa" in out[200].text and "lone@corp.example" not in out[200].text  # copies are no evidence
    assert "vesuvius" in out[300].text  # nor is one document
    assert out[0].text == corpus()[0][1] and out[0].found == "clash"


def test_listed(spark):
    spans = sanitise.find_spans(frame(spark, corpus())).where("doc_id = 101").select(sanitise.listed(F.col("found")).alias("s")).first().s
    kinds = [x.split(":")[0] for x in spans.split(",")]
    assert kinds.count("email") == 1 and kinds.count("term") >= 2 and set(kinds) <= {*KINDS, "term"}


def test_every_pair_is_judged(spark):
    out = {r.doc_id: r.text for r in sanitise.sanitise(frame(spark, corpus())).collect()}
    assert "krakatoa" not in out[200] and "vesuvius" not in out[300] and "zanzibar" not in out[100]


def test_all_contexts_of_a_document_count(spark):
    shared = "copied words about kilimanjaro to him@corp.example in full"
    rows = [(i, f"the quick fox {i} jumps over lazy dogs") for i in range(40)]
    rows += [(100 + i, f"{shared} {'filler ' * 20}{own} saw kilimanjaro with him@corp.example") for i, own in enumerate(["alpha", "delta"])]
    docs = frame(spark, rows)
    near = [sanitise.contexts(t, base_spans(t)) for _, t in rows[40:]]
    least = [min(x["context"] for x in n if x["term"] == "kilimanjaro") for n in near]
    every = {x["context"] for n in near for x in n if x["term"] == "kilimanjaro"}
    assert len(set(least)) == 1 and len(every) >= 2  # the copied context is the least of both
    out = {r.doc_id: r.text for r in sanitise.sanitise(docs, least_contexts=2).collect()}
    assert "kilimanjaro" not in out[100] + out[101]


def test_terms_are_masked_in_the_whole_document(spark):
    rows = [(i, f"the quick fox {i} jumps over lazy dogs") for i in range(40)]
    far = "filler " * 60
    rows += [(100 + i, f"{w} knows zanzibar and k7x9 and 金田 via boss@corp.example {far} Zanzibar, 金田 or K7X9 {w}") for i, w in enumerate(["once", "twice"])]
    rows += [(102, f"zanzibar {far} boss@corp.example")]  # together, though not near
    out = {r.doc_id: r.text.lower() for r in sanitise.sanitise(frame(spark, rows)).collect()}
    assert all(x not in out[d] for d in (100, 101) for x in ("zanzibar", "k7x9", "金田"))
    assert "zanzibar" not in out[102] and "[email]" in out[102]


def test_words_outside_identifiers():
    text = "bob@x.example Bob +1 (386) 555-3733 bob ab 金田"
    got = sanitise.words_outside(text, base_spans(text))
    assert [(w["term"], [text[p["start"]:p["end"]] for p in w["at"]]) for w in got] == [("bob", ["Bob", "bob"]), ("金田", ["金田"])]


def plain_spans(rows, least=0.75):
    """Spans of (doc_id, text) rows by counting every pair in every document, without any index."""
    word = re.compile(r"[^\W_]+")
    parsed = []
    for _, text in rows:
        spans, items, at = base_spans(text), [], 0
        for start, kind, end in [*spans, (len(text), None, len(text))]:
            items += [(m.start(), m.end(), None) for m in word.finditer(text, at, max(at, start))]
            if kind is not None and start >= at:
                items.append((start, end, sanitise._entity(text[start:end], KINDS[kind])))
            at = max(at, end)
        parsed.append((text, spans, items))
    terms, entities, near, both, places = Counter(), Counter(), set(), Counter(), []
    for text, _, items in parsed:
        own = {}
        for s, e, x in items:
            t = text[s:e]
            if x is None and (len(t) >= 3 or len(t) >= 2 and max(t) > "ɏ"):
                own.setdefault(t.lower(), []).append((s, e))
        found = {x for *_, x in items if x is not None}
        terms.update(own.keys())
        entities.update(found)
        both.update((x, t) for x in found for t in own)
        for i, (*_, x) in enumerate(items):
            if x is not None:
                around = [text[s:e].lower() for s, e, y in items[max(0, i - 8) : i + 9] if y is None]
                near.update((x, t) for t in around if t in own)
        places.append((found, own))
    out = []
    for (text, spans, _), (found, own) in zip(parsed, places):
        all_spans = [(s, k, e) for s, k, e in spans]
        for t, at in own.items():
            told = [1 + math.log(both[x, t] / terms[t]) / math.log(len(rows) / entities[x]) for x in found if (x, t) in near and len(rows) > entities[x]]
            if told and max(told) >= least:
                all_spans += [(s, len(KINDS), e) for s, e in at]
        out.append(sorted(all_spans))
    return out


def test_all_spans_against_counting_every_pair(spark):
    long = "漢" * 300
    rows = [(i, f"the quick fox {i % 5} jumps over lazy dogs number w{i}") for i in range(50)]
    rows += [
        (100, f"{long} boss@corp.example {long} and Zquxo İstanbulx {long}"), (101, "boss@corp.example knows İSTANBULX and zquxo"),
        (102, "联系foo@corp.example联系 or 10.0.0.1/10.0.0.2 by vesuvius"), (103, "mail x.y@corp.example,a@corp.example;b@corp.example c@corp.example d@corp.example e@corp.example f@corp.example g@corp.example h@corp.example i@corp.example krakatoa"),
        (104, ""), (105, "boss@corp.example the quick fox jumps over lazy dogs"), (106, "+1 (386) 555-3733.1.2 pico"),
    ]
    rows += [(200 + i, f"boss@corp.example sent word{i} and word{i + 1} via 10.0.0.{i}") for i in range(30)]
    got = {r.doc_id: [(x["start"], x["kind"], x["end"]) for x in r.found] for r in sanitise.find_spans(frame(spark, rows)).collect()}
    want = dict(zip((d for d, _ in rows), plain_spans(rows)))
    assert got == want
    text = dict(rows)[100]
    assert {text[s:e] for s, k, e in got[100] if k == len(KINDS)} >= {"Zquxo", "İstanbulx", long}


def test_a_long_list_of_identifiers(spark):
    rows = [(i, f"the quick fox {i} jumps over lazy dogs") for i in range(20)]
    rows += [(100, " ".join(f"name{i} <user{i}@corp.example>" for i in range(20_000)))]
    got = sanitise.find_spans(frame(spark, rows)).where("doc_id = 100").first()
    assert got.n_email == 20_000 and len(got.found) == 40_000


def test_columns_of_any_name_stay(spark):
    names = ["id", "hash", "found", "_id", "_hash", "_found", "row", "term", "ID_"]
    rows = [(i, t, *range(len(names))) for i, t in corpus()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    out = sanitise.sanitise(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == len(rows) and all(tuple(r)[2:] == tuple(range(len(names))) for r in got)
    assert "zanzibar" not in next(r.text for r in got if r.doc_id == 100)
