"""Registered queries against their SQL, and the pipeline stage by stage."""

import hashlib
import os
import random
import subprocess
import sys

import __spark_entry__
import corpus_pipeline
import numpy as np
import pytest
from compare import connect, mismatch
from pyspark.sql import functions as F
from test_llm_bpe import ids_of
from test_llm_line_dedup import plain as plain_lines
from test_llm_mixing import targets
from test_llm_simhash import groups
from test_llm_simhash import plain as plain_print

from wagelens.llm import language_id, queries
from wagelens.llm.staging import stage

ORACLES = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, small, name):
    assert mismatch(queries.queries()[name](spark, small), connect(small), ORACLES[name]) is None


def test_every_operator_is_registered():
    names = list(__spark_entry__.queries())
    assert [sum(x.startswith(f"op{n}_") for x in names) for n in range(1, 14)] == [1] * 13 and "pipeline" in names


def test_stages_keep_columns_and_are_what_run_does(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, sizes = docs.columns, []
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, small), name)
        sizes.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert sizes[-1] == sizes[-2] and all(sizes)
    again = corpus_pipeline.run(spark, small)
    key = ["doc_id", "ids_sha256"]
    assert sorted(map(tuple, again.select(key).collect())) == sorted(map(tuple, docs.select(key).collect()))


def test_pipeline_of_nothing_and_of_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    good = [(i, f"the house and garden number {i} stand by the river where people meet every day", "en", "a", 5) for i in range(30)]
    odd = [(100, None, None, None, None), (None, "the house", "en", None, 3), (101, "", "en", "b", 0), (0, good[0][1], "en", "a", 5)]
    for name, rows in (("none", []), ("odd", good + odd)):
        path = str(tmp_path / name)
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
        assert (corpus_pipeline.run(spark, path).count() > 0) == bool(rows)


def test_stages_keep_columns_of_any_name(spark, small):
    """Further columns with the names that operators use themselves, values compared."""
    names = "id hash runs found kept at n i s z d c copy size _id _hash _runs _found _kept _at _n _i _s _z _d _c part same fp".split()
    docs = spark.read.parquet(f"{small}/documents.parquet")
    docs = docs.withColumns({n: F.xxhash64("doc_id", F.lit(n)) for n in names})

    def changed(rows):
        return rows.where(" OR ".join(f"NOT `{n}` <=> xxhash64(doc_id, '{n}')" for n in names)).count()

    taken = corpus_pipeline.mixing.repeat_documents(docs, alike=True)
    assert taken.columns == docs.columns and taken.count() and not changed(taken)
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = stage(step(spark, docs, small), name)
        assert out.columns == docs.columns and out.count()
        assert not changed(out)
        docs = out


def test_each_stage_against_plain_python(spark, tmp_path):
    draw = random.Random(4)
    words = {"en": "the of and house river people many street".split(), "de": "der die und haus wasser leute straße viele".split()}
    passage = [" ".join(draw.choices(words["en"], k=30)) for _ in range(3)]
    rows = []
    for i in range(150):
        lang = draw.choice(["en", "de"])
        lines = [" ".join(draw.choices(words[lang], k=draw.randint(3, 30))) for _ in range(draw.randint(1, 6))]
        rows.append((i, "\n".join(lines + draw.choice([[], passage])), lang, draw.choice(["a", "b", None]), 1))
    rows += [(200 + i, rows[i][1], "en", "c", 1) for i in range(20)] + [(300, "12 34", "en", "a", 1), (301, None, "de", "a", 1)]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    docs = spark.read.parquet(path)
    tables = []
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, str(tmp_path)), name)
        tables.append(docs)
    texts = [{r.doc_id: r.text for r in t.collect()} for t in tables[:4]]

    scores = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(spark.read.parquet(path)).collect()}
    assert set(texts[0]) == {i for i, (x, s) in scores.items() if x != "und" and s >= corpus_pipeline.LEAST_LANGUAGE_SHARE}
    assert not {300, 301} & set(texts[0]) and len(texts[0]) > 160

    before = list(texts[0].items())
    hashes = [r.h for r in spark.createDataFrame([(i, *x) for i, x in enumerate(before)], "i int, d long, t string").orderBy("i").select(F.xxhash64("t").alias("h")).collect()]
    want = plain_lines(before, hashes, 50)
    assert texts[1] == {d: want[(True, d, h)][1] for (d, _), h in zip(before, hashes)}
    assert sum(a != b for a, b in zip(texts[0].values(), map(texts[1].get, texts[0]))) > 20

    ids = sorted(texts[1])
    prints = [plain_print(texts[1][i], 4) for i in ids]
    name = groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    assert sorted(texts[2]) == sorted({ids[r] for r in name.values()})

    source = {r[0]: r[3] for r in rows}
    size = {i: len(t.split()) for i, t in texts[2].items()}
    sizes = {s: sum(n for i, n in size.items() if source[i] == s) for s in {source[i] for i in size}}
    goal, copies = targets(sizes), {i: 0 for i in size}
    for r in tables[3].collect():
        copies[r.doc_id] += 1
    assert max(copies.values()) <= 2 and all(texts[3][i] == texts[2][i] for i in texts[3])
    for s in sizes:
        assert abs(sum(copies[i] * size[i] for i in size if source[i] == s) - goal[s]) <= max(size.values())

    digests = [hashlib.sha256(np.array(ids_of(t), "<u4").tobytes()).hexdigest() for i, t in texts[3].items() for _ in range(copies[i])]
    assert sorted(r.ids_sha256 for r in tables[4].collect()) == sorted(digests)


def test_workers_need_no_installed_package(tmp_path):
    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from wagelens.llm import simhash
from wagelens.session import local_session
spark = local_session("2", 2)
print("rows", simhash.fingerprints(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), 4).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "rows 2" in done.stdout, done.stderr[-2000:]
