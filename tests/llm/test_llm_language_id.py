"""Viterbi against plain dynamic programming, accuracy on held-out documents, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wagelens.llm import language_id
from wagelens.llm.viterbi import CHUNK, best_path

SCHEMA = "doc_id long, text string, lang string, lang_pred string, score string, held_out string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)


def value(scores, first, penalty, path):
    total = scores[np.arange(len(path)), path].sum()
    return total - penalty * sum(a != b and not f for a, b, f in zip(path, path[1:], first[1:]))


def plain_best(scores, first, penalty):
    best = scores[0].copy()
    for s, f in zip(scores[1:], first[1:]):
        best = np.maximum(best, best.max() - (0 if f else penalty)) + s
    return best.max()


@pytest.mark.parametrize("n", [1, 2, CHUNK, CHUNK + 1, 500])
def test_best_path(n):
    draw = np.random.default_rng(n)
    scores, first = draw.normal(size=(n, 4)), draw.random(n) < 0.05
    first[0] = True
    for penalty in (0.0, 1.0, 20.0):
        path = best_path(scores, first, penalty)
        assert value(scores, first, penalty, path) == pytest.approx(plain_best(scores, first, penalty))


def scripts(chars):
    return language_id.scripts_of(np.array([ord(c) for c in chars])).tolist()


def test_script_ranges():
    assert len(set(scripts("aéḀ"))) == 1 and scripts("a") > [0]
    assert len(set(scripts("aαжאعक中かก한"))) == 10
    assert scripts("1\U0001f600") == [0, 0]


def test_features_do_not_depend_on_neighbours():
    words = ["the", "THE", "a", "ñandú", "the", "ж"]
    found, starts, script = language_id.features(words)
    parts = [x.tolist() for x in np.split(found, starts[1:])]
    assert parts[0] == parts[1] == parts[4] and script[0] == script[3] != script[5]
    for word, part in zip(words, parts):
        alone, _, _ = language_id.features([word])
        assert alone.tolist() == part and len(part) == 2 * (len(word) + 2) and part.count(language_id.FEATURES) == 2


@pytest.fixture(scope="module")
def documents(spark, small):
    return spark.read.parquet(f"{small.replace('sf0.001', 'sf0.01')}/documents.parquet").select("doc_id", "text", "lang")


def test_held_out_accuracy(spark, documents):
    rows = language_id.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(rows) == documents.count() and len(held) > 200
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_documents_and_ids_are_not_read(spark, documents):
    other = documents.withColumn("lang", F.when(language_id.in_training(F.col("doc_id")), F.col("lang")).otherwise("xx"))
    one, two = ({r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(d).collect()} for d in (documents, other))
    assert one == two and "xx" not in {x for x, _ in two.values()}


def trained(more):
    english, greek = "the cat and the dog were in the house with the other", "το σπίτι και ο σκύλος με την γάτα στον κήπο"
    german = "der hund und die katze sind in dem haus mit den anderen"
    return [(i, t, x) for i in range(30) for t, x in ((english, "en"), (german, "de"), (greek, "el"))] + more


def test_spans_of_mixed_text_and_scripts(spark):
    mixed = "12 the dog and the cat were in the house with the other dog, η γάτα και ο σκύλος. der hund und die katze sind in dem haus!"
    got = {r.doc_id: r for r in language_id.identify(frame(spark, trained([(900, mixed, None), (901, "жук и кот", None)]))).collect()}
    spans = [(x.lang, mixed[x.start : x.end]) for x in got[900].spans]
    assert [x for x, _ in spans] == ["en", "el", "de"]
    assert spans[0][1].startswith("the dog") and spans[2][1].startswith("der") and spans[2][1].endswith("haus")
    assert got[901].lang_pred in ("en", "de", "el") and got[901].score == 0


def test_odd_rows(spark):
    odd = [(800, None, "en"), (801, "", "en"), (802, "12 ½ ² _ !", None), (None, "the dog", "en"), (803, "the cat " * 60_000, None), (804, "x", None), (804, "x", None)]
    got = language_id.identify(frame(spark, trained(odd))).collect()
    assert len(got) == 90 + len(odd)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (800, 801, 802)] == ["und"] * 3 and by[802].spans == []
    assert by[803].lang_pred == "en" and by[None].held_out is False
    none = language_id.identify(frame(spark, [(1, "some text", None), (2, None, "en")])).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert language_id.identify(frame(spark, [])).count() == 0


def test_kept_rows(spark):
    docs = frame(spark, trained([(800, None, "en"), (801, "123", "en"), (802, "жук и кот", "en"), (803, "the dog", None)]))
    kept = language_id.keep_identified(docs, 0.25)
    assert kept.schema == docs.schema
    ids = {r.doc_id for r in kept.collect()}
    assert 803 in ids and not ids & {800, 801, 802} and kept.count() == 91
    assert language_id.keep_identified(frame(spark, [(1, "abc", None), (2, "1", None), (3, None, None)]), 0.25).count() == 1


def test_many_label_values_are_bounded(spark):
    rows = [(i, f"word{i % 600} common", f"l{i % 600:03}") for i in range(1800)] + [(i, "the most frequent", "zz") for i in range(1800, 1900)]
    model = language_id.learn(frame(spark, rows), most_languages=20)
    assert len(model.languages) == 20 and model.languages[0] == "zz"
