"""Invariants of splits, fits and scores."""

import pytest
from pyspark.sql import functions as F

from wagelens.checks import base
from wagelens.operators import models, regress, skills, stats

TINY = models.Settings(forest_trees=5, boost_rounds=5, selection_trees=5, forest_depth=4, folds=2)


@pytest.fixture(scope="module")
def rows(spark, small):
    return models.training_rows(base.skilled(spark, small), "url", TINY).persist()


@pytest.fixture(scope="module")
def skill_list(spark, small):
    return skills.observed_list(base.skilled(spark, small))


def test_copies_share_a_side_and_partitions_do_not_matter(spark, small):
    df = regress.with_split(base.skilled(spark, small), "url").select("posting_id", "url", "split")
    assert df.groupBy("url").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    one, many = df.repartition(1), df.repartition(17)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0
    share = df.where("split = 'test'").count() / df.count()
    assert 0.15 < share < 0.25


def test_only_observed_salaries_are_scored(spark, small):
    df = base.skilled(spark, small)
    marked = df.withColumn("salary_origin", F.when(F.col("posting_id") % 2 == 0, "synthetic").otherwise(F.col("salary_origin")))
    marked = marked.withColumn("annual_salary", F.coalesce("annual_salary", F.lit(1.0)))
    kept = models.training_rows(marked, "posting_id", TINY)
    assert kept.where(F.col("model_key") % 2 == 0).count() == 0
    assert kept.where("y = 1.0").count() == 0


def test_forest_importances(rows, skill_list):
    fitted = models.fit_forest(rows.where("split = 'train'"), skill_list, TINY)
    assert sum(fitted.importances) == pytest.approx(1.0) and min(fitted.importances) >= 0
    assert len(fitted.names) == len(fitted.importances) == len(set(fitted.names))
    predicted = fitted.predict(rows)
    assert predicted.count() == rows.count() and predicted.where("yhat IS NULL").count() == 0


def test_names_follow_the_features(spark):
    # y depends on one skill only; its name must come out first, wherever its column stands
    data = [(f"k{i}", "train", 0, ["go"] if i % 3 == 0 else ["sql"] if i % 2 else [], float(50 + 100 * (i % 3 == 0)), "t", "p") for i in range(60)]
    df = spark.createDataFrame(data, "model_key string, split string, fold int, skills array<string>, y double, standardized_title string, standardized_location string")
    plain = models.Settings(forest_trees=5, boost_rounds=5, forest_depth=3, select_features=False)
    for order in (["go", "sql"], ["sql", "go"]):
        for fitted in models.fit_both(df, order, plain):
            best = models.importance_table(spark, fitted).where("rank = 1").first()
            assert (best["feature"], best["skill"]) == ("num_has_go", "go")


def test_merged_rows_boost_alike(spark, rows, skill_list):
    train = rows.where("split = 'train'")
    cats = models.categories_of(TINY)
    merged = models.merge_equal_rows(train, cats)
    total = merged.agg(F.sum("weight")).first()[0]
    assert total == train.count()
    assert merged.agg(F.sum(F.col("weight") * F.col("y"))).first()[0] == pytest.approx(train.agg(F.sum("y")).first()[0])
    fitted = models.fit_boosting(train, skill_list, TINY)
    from pyspark.ml.regression import GBTRegressor

    wide = skills.with_indicators(train, skill_list)
    steps = models.fit_features(wide, cats, [skills.indicator_name(s) for s in skill_list])
    raw = GBTRegressor(
        featuresCol="features", labelCol="y", maxIter=TINY.boost_rounds, stepSize=TINY.boost_rate,
        maxDepth=TINY.boost_depth, seed=TINY.seed, featureSubsetStrategy="all",
    ).fit(steps.transform(wide))
    one = {(r["model_key"], r["y"]): r["yhat"] for r in fitted.predict(rows).collect()}
    raw_out = raw.transform(steps.transform(skills.with_indicators(rows, skill_list)))
    close = [abs(one[(r["model_key"], r["y"])] - r["prediction"]) < 1.0 for r in raw_out.collect()]
    assert sum(close) / len(close) > 0.9  # equal up to ties between equally good splits


def test_unseen_category_is_all_zero(spark, rows):
    steps = models.fit_features(rows.where("split = 'train'"), [models.TITLE], [])
    new = rows.limit(1).withColumn(models.TITLE, F.lit("never seen"))
    assert steps.transform(new).first()["features"].numNonzeros() == 0


def test_many_categories_are_hashed(spark, rows, monkeypatch):
    monkeypatch.setattr(models, "MAX_CATEGORIES", 3)
    steps = models.fit_features(rows, [models.TITLE], [])
    assert len(steps.transform(rows).first()["features"]) == models.HASH_SLOTS


def test_folds_and_choice(rows, skill_list):
    held = models.fold_scores(rows, skill_list, TINY)
    train = rows.where("split = 'train'").count()
    assert {r["model"]: r["count"] for r in held.groupBy("model").count().collect()} == {
        "random_forest": train, "gradient_boosting": train
    }
    assert models.better_model(regress.regression_metrics(held), "held_out") in ("random_forest", "gradient_boosting")


def test_few_rows_get_a_status_and_no_numbers(spark, small):
    df = base.skilled(spark, small)
    first = stats.roles_by_appearance(df, models.TITLE, "seq", 1).first()[models.TITLE]
    keep = (F.col(models.TITLE) != first) | (F.col("seq") < 40)
    rows = models.skill_importance_by_role(df.where(keep), "url", "seq", TINY).where(F.col("role") == first).collect()
    known = df.where(keep).where(F.col(models.TITLE) == first).where("salary_origin = 'observed'").count()
    assert known < 10
    assert [(r["skill"], r["importance"], r["status"]) for r in rows] == [(None, None, "insufficient_data")]


def test_roles_of_one_fit_are_apart(spark):
    # in each role another skill decides the salary
    data = []
    for role, skill, other in (("data scientist", "go", "sql"), ("devops engineer", "sql", "go")):
        for i in range(80):
            named = ([skill] if i % 2 else []) + ([other] if i % 3 else [])
            data.append((f"{role}{i}", i, role, "p", "c", named, "matched", "observed", 50.0 + 100 * (i % 2)))
    df = spark.createDataFrame(data, "url string, seq int, standardized_title string, standardized_location string, company string, "
                               "skills array<string>, skill_origin string, salary_origin string, annual_salary double")
    got = {(r["role"], r["skill"]): (r["importance"], r["rank"]) for r in models.skill_importance_by_role(df, "url", "seq", TINY).collect()}
    assert got == {("data scientist", "go"): (pytest.approx(1.0), 1), ("data scientist", "sql"): (0.0, 2),
                   ("devops engineer", "sql"): (pytest.approx(1.0), 1), ("devops engineer", "go"): (0.0, 2)}


def test_deep_forest_scores_all_rows_and_learns_what_decides(spark):
    data = [(f"k{i}", "train" if i % 5 else "test", ["go"] if i % 3 == 0 else ["sql"] if i % 2 else [], float(50 + 100 * (i % 3 == 0)), "t", f"p{i % 2}") for i in range(120)]
    df = spark.createDataFrame(data, "model_key string, split string, skills array<string>, y double, standardized_title string, standardized_location string")
    rows, importances = models.fit_deep_forest(df, TINY)
    assert rows.columns == [*df.columns, "yhat"]
    got = rows.collect()
    assert len(got) == 120 and all(r["yhat"] == pytest.approx(r["y"]) for r in got)
    best = models.item_importance_table(importances).where("rank = 1").first()
    assert (best["feature"], best["skill"]) == ("skill=go", "go")


def test_r2_is_not_the_squared_correlation(spark):
    df = spark.createDataFrame([("m", "s", float(y), float(y + 1)) for y in range(4)], "model string, split string, y double, yhat double")
    got = {r["metric"]: r["value"] for r in regress.regression_metrics(df).collect()}
    assert got["r2"] == pytest.approx(0.2) and got["rmse"] == pytest.approx(1.0) and got["mae"] == pytest.approx(1.0)


def test_bootstrap_of_feature_sets_is_one_of_rows(spark):
    data = [(i, "t" if i % 2 else "u", None if i % 4 == 3 else f"p{i % 4}", ["go"] if i % 3 else [], float(i % 7)) for i in range(4_000)]
    df = spark.createDataFrame(data, "model_key long, standardized_title string, standardized_location string, skills array<string>, y double")
    cats = models.categories_of(TINY)
    sets = models.bootstrap_sets(df.repartition(7), cats, TINY, 40).collect()
    counts = {(r[cats[0]], r[cats[1]], tuple(r["skills"])): r["count"] for r in df.groupBy(*cats, "skills").count().collect()}
    assert {(r[cats[0]], r[cats[1]], tuple(r["skills"])) for r in sets} == set(counts) and len(sets) == len(counts)
    for r in sets:
        n = counts[r[cats[0]], r[cats[1]], tuple(r["skills"])]
        assert [d["tree"] for d in r["drawn"]] == list(range(40))
        w = [d["w"] for d in r["drawn"]]
        mean = sum(w) / 40
        assert mean == pytest.approx(n, abs=5 * (n / 40) ** 0.5)  # as many rows as there are, and
        assert 0.3 * n < sum((x - mean) ** 2 for x in w) / 39 < 2.2 * n  # drawn one by one: a set drawn whole spreads by n * n
        assert all(0 <= d["y"] <= 6 for d in r["drawn"])


def test_forest_trees_grow_on_sets_not_rows(spark, rows, skill_list, monkeypatch):
    seen = []
    fit = models.fit_trees
    monkeypatch.setattr(models, "fit_trees", lambda sets, *a: seen.append(sets.count()) or fit(sets, *a))
    train = rows.where("split = 'train'")
    again = train.unionByName(train).unionByName(train)
    fitted = models.fit_forest(again, skill_list, TINY)
    n_sets = train.select(*models.categories_of(TINY), "skills").distinct().count()
    assert set(seen) == {n_sets} and n_sets < again.count()
    forest = fitted.steps.stages[-1]
    assert forest.getNumTrees == len(forest.trees) == TINY.forest_trees
    assert max(t.depth for t in forest.trees) <= TINY.forest_depth
    out = fitted.steps.transform(skills.with_indicators(train.limit(20), skill_list)).select("picked", "prediction").collect()
    for r in out:
        assert r["prediction"] == pytest.approx(sum(t.predict(r["picked"]) for t in forest.trees) / TINY.forest_trees)
    assert fitted.predict(train).agg(F.avg("yhat")).first()[0] == pytest.approx(train.agg(F.avg("y")).first()[0], rel=0.1)
