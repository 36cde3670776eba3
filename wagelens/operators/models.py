"""Salary models with Spark ML: features, forests, boosting, importances."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    FeatureHasher, OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler, VectorSlicer,
)
from pyspark.ml.regression import (
    DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressor, RandomForestRegressionModel,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagelens import rules
from wagelens.functions.keys import fold_of
from wagelens.operators import regress, skills, stats, trees
from wagelens.operators.clean import drop_null_target
from wagelens.operators.lookup import small_enough
from wagelens.session import ensure_checkpoint_dir, scratch_path, ship_package

TITLE, PLACE, COMPANY = "standardized_title", "standardized_location", "company"
TARGET = "annual_salary"
MAX_CATEGORIES = 10_000
HASH_SLOTS = 1 << 14
#: trees of a forest that are fitted at the same time
TREES_AT_ONCE = 8
#: feature sets a task of such a fit reads at least
SETS_PER_TASK = 20_000
#: models of folds that are fitted at the same time
FITS_AT_ONCE = 6


@dataclass(frozen=True)
class Settings:
    """Sizes of the models.  ``forest_depth`` bounds the forests of Spark ML, whose trees are
    held by the driver; ``fit_deep_forest`` and the importances by role grow to purity."""

    forest_trees: int = 200
    boost_rounds: int = 200
    boost_rate: float = 0.1
    boost_depth: int = 3
    forest_depth: int = 10
    selection_trees: int = 100
    select_features: bool = True
    with_company: bool = False
    folds: int = 3
    seed: int = 42


MARKET = Settings(forest_trees=100, boost_rounds=100, select_features=False, with_company=True)
US_MARKET = Settings()


# ---- features ------------------------------------------------------------

def categories_of(settings: Settings) -> list[str]:
    return [TITLE, PLACE] + ([COMPANY] if settings.with_company else [])


def _moments(train: DataFrame, numeric: list[str]) -> list[tuple[float | None, float | None]]:
    """Mean and population spread of each column."""
    aggs = []
    for i, c in enumerate(numeric):
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    fitted = train.agg(*aggs).first()
    return [(fitted[f"m{i}"], fitted[f"s{i}"]) for i in range(len(numeric))]


def _weighted_moments(sets: DataFrame, numeric: list[str], weight: str) -> list[tuple[float | None, float | None]]:
    """``_moments`` of the rows that the weighted sets stand for."""

    def mean_of(value: Column, c: str) -> Column:
        return F.try_divide(F.sum(F.col(weight) * value), F.sum(F.when(F.col(c).isNotNull(), F.col(weight))))

    means = sets.agg(*[mean_of(F.col(c), c).alias(f"m{i}") for i, c in enumerate(numeric)]).first()
    squares = [mean_of((F.col(c) - F.lit(means[f"m{i}"])) ** 2, c) for i, c in enumerate(numeric)]
    spreads = [F.when(F.min(c) == F.max(c), 0.0).otherwise(F.sqrt(sq)).alias(f"s{i}") for i, (c, sq) in enumerate(zip(numeric, squares))]
    fitted = sets.agg(*spreads).first()
    return [(means[f"m{i}"], fitted[f"s{i}"]) for i in range(len(numeric))]


def _scaling(train: DataFrame, numeric: list[str], weight: str | None = None) -> SQLTransformer:
    """Standardisation with the population spread of the train rows."""
    moments = _moments(train, numeric) if weight is None else _weighted_moments(train, numeric, weight)
    items = []
    for c, (mean, spread) in zip(numeric, moments):
        mean, spread = mean or 0.0, spread or 0.0
        scaled = f"(`{c}` - {mean!r}D) / {spread!r}D" if spread else "0.0D"
        items.append(f"{scaled} AS `num_{c}`")
    return SQLTransformer(statement="SELECT *, " + ", ".join(items) + " FROM __THIS__")


def _weighted_indexer(sets: DataFrame, column: str, weight: str) -> StringIndexerModel:
    """What ``StringIndexer`` learns from the rows that the weighted sets stand for: labels by falling frequency, then by name."""
    counts = sets.groupBy(column).agg(F.sum(weight).alias("n")).where(F.col(column).isNotNull()).collect()  # at most MAX_CATEGORIES or so
    labels = [r[column] for r in sorted(counts, key=lambda r: (-r["n"], r[column].encode("utf-16-be")))]
    return StringIndexerModel.from_labels(labels, column, f"ix_{column}", "keep")


def fit_features(train: DataFrame, categorical: list[str], numeric: list[str], weight: str | None = None) -> PipelineModel:
    """One-hot categories and standardised numbers in one ``features`` vector.

    A category unseen in training is all zeros.  A column with more than
    10,000 categories is hashed instead, since its labels would otherwise be
    gathered on the driver.  With ``weight``, a row of ``train`` stands for so many.
    """
    train = train.na.fill(rules.FILL_CATEGORY, subset=categorical)
    sizes = train.agg(*[F.approx_count_distinct(c).alias(c) for c in categorical]).first()
    listed = [c for c in categorical if sizes[c] <= MAX_CATEGORIES]
    hashed = [c for c in categorical if c not in listed]
    stages, parts = [], []
    if listed:
        if weight is None:
            stages.append(StringIndexer(inputCols=listed, outputCols=[f"ix_{c}" for c in listed], handleInvalid="keep"))
        else:  # one model per column: PySpark pads label lists of unlike lengths with nulls
            stages += [_weighted_indexer(train, c, weight) for c in listed]
        stages.append(OneHotEncoder(inputCols=[f"ix_{c}" for c in listed], outputCols=[f"cat_{c}" for c in listed], dropLast=True))
        parts += [f"cat_{c}" for c in listed]
    for c in hashed:
        stages.append(FeatureHasher(inputCols=[c], outputCol=f"hash_{c}", numFeatures=HASH_SLOTS))
        parts.append(f"hash_{c}")
    if numeric:
        stages.append(_scaling(train, numeric, weight))
        parts += [f"num_{c}" for c in numeric]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return Pipeline(stages=stages).fit(train)


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names by position, from the attribute metadata of the vector column."""
    meta = df.schema[column].metadata["ml_attr"]
    names = [f"slot_{i}" for i in range(meta["num_attrs"])]
    for group in meta.get("attrs", {}).values():
        for attr in group:
            names[attr["idx"]] = attr.get("name", names[attr["idx"]])
    return names


# ---- training rows -------------------------------------------------------

def training_rows(df: DataFrame, key: str, settings: Settings = US_MARKET) -> DataFrame:
    """Rows with an observed salary, their split and fold."""
    rows = drop_null_target(regress.observed_only(df))
    cats = categories_of(settings)
    return (
        regress.with_split(rows, key)
        .withColumn("fold", fold_of(F.col(key), settings.folds))
        .select(F.col(key).alias("model_key"), "split", "fold", "skills", F.col(TARGET).alias("y"), *cats)
        .na.fill(rules.FILL_CATEGORY, subset=cats)
    )


def merge_equal_rows(train: DataFrame, categories: list[str]) -> DataFrame:
    """One weighted row per distinct feature set, with the mean target.

    Splits that minimise squared error see only weighted sums of the target,
    so boosting grows the same trees from these rows, of which there are as
    many as distinct feature sets, not postings.
    """
    return combined(sums_of_equal_rows(train, [*categories, "skills"]), categories)


def sums_of_equal_rows(train: DataFrame, by: list[str]) -> DataFrame:
    """(by, total, n, weight) of the rows equal in ``by``; ``n`` are those with a target."""
    total = F.sum(F.col("y").cast(stats.MONEY)).alias("total")
    return train.groupBy(*by).agg(total, F.count("y").alias("n"), F.count(F.lit(1)).cast("double").alias("weight"))


def combined(sums: DataFrame, categories: list[str]) -> DataFrame:
    """Merged rows from sums of any finer grouping."""
    mean = F.try_divide(F.sum("total").cast("double"), F.sum("n"))
    return sums.groupBy(*categories, "skills").agg(mean.alias("y"), F.sum("weight").alias("weight"))


@dataclass
class Fitted:
    """A fitted model with the steps before it and its feature names."""

    name: str
    steps: PipelineModel
    skills: list[str]
    names: list[str]
    importances: list[float]

    def predict(self, rows: DataFrame) -> DataFrame:
        """Add ``yhat``; the rows need the category and skills columns.

        Rows with equal features get one prediction, made once.
        """
        inputs = sorted({c for c in rows.columns if c in (TITLE, PLACE, COMPANY, "skills")})
        return with_predictions(rows, _written(self.predict_sets(rows.select(*inputs).distinct()), "predicted"), inputs)

    def predict_sets(self, sets: DataFrame) -> DataFrame:
        """Distinct feature sets with their ``yhat``."""
        wide = skills.with_indicators(sets, self.skills)
        return self.steps.transform(wide).select(*sets.columns, F.col("prediction").alias("yhat"))


def with_predictions(rows: DataFrame, predicted: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with the other columns of the predictions of their feature set."""
    side = F.broadcast(predicted) if small_enough(predicted) else predicted
    side = side.withColumnsRenamed({c: f"_{c}" for c in on})
    same = [rows[c].eqNullSafe(F.col(f"_{c}")) for c in on]
    return rows.join(side, same).select(*[rows[c] for c in rows.columns], *[c for c in predicted.columns if c not in on])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_few_tasks(sets: DataFrame) -> DataFrame:
    """Feature sets as a written table in as many tasks as they are worth, since a fit goes over them many times."""
    written = _written(sets, "feature_sets")
    return written.coalesce(written.count() // SETS_PER_TASK + 1)


def bootstrap_sets(train: DataFrame, categories: list[str], settings: Settings, wanted: int) -> DataFrame:
    """One row per distinct feature set with ``drawn``, the (tree, w, y) of the bootstraps of all trees in order.

    A bootstrap takes each row a Poisson number of times with mean 1; w is how often it takes rows
    of the set and y their mean target, which is all that splits minimising squared error see.
    """
    return drawn_sets(bootstrap_sums(train, [*categories, "skills"], settings, wanted), categories)


def bootstrap_sums(train: DataFrame, by: list[str], settings: Settings, wanted: int) -> DataFrame:
    """(by, tree, w, s): draws and sum of targets of the rows equal in ``by``, for every tree."""
    ship_package(train.sparkSession)
    rows = train.select(*by, F.monotonically_increasing_id().alias("key"), F.col("y").alias("z"), F.lit(True).alias("train"))
    return trees.tree_sums(rows, by, wanted, True, settings.seed).select(*by, "tree", "w", "s")


def drawn_sets(sums: DataFrame, categories: list[str]) -> DataFrame:
    """``bootstrap_sets`` from sums of any grouping as fine or finer."""
    by = [*categories, "skills"]
    per_tree = sums.groupBy(*by, "tree").agg(F.sum("w").alias("w"), F.sum("s").alias("s"))
    drawn = F.struct("tree", "w", F.try_divide("s", "w").alias("y"))
    return per_tree.groupBy(*by).agg(F.sort_array(F.collect_list(drawn)).alias("drawn"))


def fit_trees(sets: DataFrame, settings: Settings, wanted: int, features: str = "features") -> RandomForestRegressionModel:
    """A forest of Spark ML from rows (drawn, features), several of its trees fitted at a time.

    A bootstrap that takes no row gives no tree.
    """
    spark = sets.sparkSession
    learner = DecisionTreeRegressor(
        featuresCol=features, labelCol="y", weightCol="w", maxDepth=settings.forest_depth, seed=settings.seed
    )

    def fit(tree: int) -> DecisionTreeRegressionModel:
        one = F.get("drawn", F.lit(tree))
        return learner.fit(sets.select(features, one["w"].alias("w"), one["y"].alias("y")).where("w > 0"))

    totals = sets.select(F.inline("drawn")).where(F.col("tree") < wanted).groupBy("tree").agg(F.sum("w").alias("w"))
    with_rows = sorted(r["tree"] for r in totals.where("w > 0").collect())
    with ThreadPool(TREES_AT_ONCE) as pool:
        fitted = pool.map(inheritable_thread_target(spark)(fit), with_rows, chunksize=1)
    context = spark.sparkContext
    ml = context._jvm.org.apache.spark.ml.regression
    parts = context._gateway.new_array(ml.DecisionTreeRegressionModel, len(fitted))
    for i, tree in enumerate(fitted):
        parts[i] = tree._java_obj
    uid = RandomForestRegressionModel().uid
    forest = RandomForestRegressionModel(ml.RandomForestRegressionModel(uid, parts, fitted[0].numFeatures))
    forest._set(featuresCol=features, numTrees=len(fitted))  # predictions are sums over trees divided by numTrees
    forest._transfer_params_to_java()
    return forest


def select_features(sets: DataFrame, settings: Settings) -> VectorSlicer:
    """Keep the features at least as important as the average one."""
    scout = fit_trees(sets, settings, settings.selection_trees)
    weights = scout.featureImportances.toArray()
    kept = [i for i, w in enumerate(weights) if w >= weights.mean()]
    return VectorSlicer(inputCol="features", outputCol="picked", indices=kept)


def _prepared(merged: DataFrame, skill_list: list[str], settings: Settings) -> PipelineModel:
    """The feature steps, learnt from merged rows, which tell of all rows by their weights."""
    numeric = [skills.indicator_name(s) for s in skill_list]
    return fit_features(skills.with_indicators(merged, skill_list), categories_of(settings), numeric, "weight")


def trees_wanted(settings: Settings) -> int:
    return max(settings.forest_trees, settings.selection_trees if settings.select_features else 0)


def fit_forest(train: DataFrame, skill_list: list[str], settings: Settings, name: str = "random_forest") -> Fitted:
    """Random forest, after feature selection where the settings ask for it.

    Its trees grow on distinct feature sets, weighted by their bootstrap of the rows.
    """
    cats = categories_of(settings)
    drawn = bootstrap_sets(train, cats, settings, trees_wanted(settings))
    return forest_on_sets(in_few_tasks(drawn), in_few_tasks(merge_equal_rows(train, cats)), skill_list, settings, name)


def forest_on_sets(drawn: DataFrame, merged: DataFrame, skill_list: list[str], settings: Settings, name: str = "random_forest") -> Fitted:
    """``fit_forest`` on the bootstrap sets and the merged rows of its train rows."""
    ensure_checkpoint_dir(drawn.sparkSession)
    prepared = _prepared(merged, skill_list, settings)
    sets = prepared.transform(skills.with_indicators(drawn, skill_list)).select("drawn", "features").persist()
    try:
        names = feature_names(sets)
        stages = list(prepared.stages)
        if settings.select_features:
            picker = select_features(sets, settings)
            names = [names[i] for i in picker.getIndices()]
            stages.append(picker)
            fitted = fit_trees(picker.transform(sets), settings, settings.forest_trees, "picked")
        else:
            fitted = fit_trees(sets, settings, settings.forest_trees)
    finally:
        sets.unpersist()
    steps = PipelineModel(stages=[*stages, fitted])
    return Fitted(name, steps, skill_list, names, fitted.featureImportances.toArray().tolist())


def fit_boosting(train: DataFrame, skill_list: list[str], settings: Settings, name: str = "gradient_boosting") -> Fitted:
    """Gradient-boosted trees on the merged rows."""
    merged = in_few_tasks(merge_equal_rows(train, categories_of(settings)))
    return boosting_on_sets(merged, skill_list, settings, name)


def boosting_on_sets(merged: DataFrame, skill_list: list[str], settings: Settings, name: str = "gradient_boosting") -> Fitted:
    ensure_checkpoint_dir(merged.sparkSession)
    prepared = _prepared(merged, skill_list, settings)
    data = prepared.transform(skills.with_indicators(merged, skill_list)).select("y", "weight", "features").persist()
    try:
        names = feature_names(data)
        model = GBTRegressor(
            featuresCol="features", labelCol="y", weightCol="weight", maxIter=settings.boost_rounds,
            stepSize=settings.boost_rate, maxDepth=settings.boost_depth, seed=settings.seed,
            featureSubsetStrategy="all", checkpointInterval=10,
        ).fit(data)
    finally:
        data.unpersist()
    steps = PipelineModel(stages=[*prepared.stages, model])
    return Fitted(name, steps, skill_list, names, model.featureImportances.toArray().tolist())


# ---- scores and choice ---------------------------------------------------

def scored(fitted: Fitted, rows: DataFrame) -> DataFrame:
    """(model, split, model_key, title, y, yhat)."""
    return fitted.predict(rows).select(
        F.lit(fitted.name).alias("model"), "split", "model_key", TITLE, "y", "yhat"
    )


def baseline_scores(rows: DataFrame) -> DataFrame:
    """The train mean by title in the same form, the score to beat."""
    predicted = regress.group_mean_predictor(rows, target="y", by=TITLE)
    return predicted.select(
        F.lit("group_mean").alias("model"), "split", "model_key", TITLE, "y", "yhat"
    )


def fit_both(train: DataFrame, skill_list: list[str], settings: Settings) -> list[Fitted]:
    return [fit_forest(train, skill_list, settings), fit_boosting(train, skill_list, settings)]


def fold_scores(rows: DataFrame, skill_list: list[str], settings: Settings) -> DataFrame:
    """Predictions for every train row by models that did not see its fold.

    The rows are drawn and summed once, by feature set and fold; the models of a fold are fitted
    on the sums of the others.
    """
    train = rows.where(F.col("split") == "train")
    cats = categories_of(settings)
    by = [*cats, "skills"]
    sums = _written(sums_of_equal_rows(train, [*by, "fold"]), "fold_sums")
    draws = _written(bootstrap_sums(train, [*by, "fold"], settings, trees_wanted(settings)), "fold_draws")

    def predicted(job: tuple[int, str]) -> DataFrame:
        fold, kind = job
        seen = F.col("fold") != fold
        merged = in_few_tasks(combined(sums.where(seen), cats))
        if kind == "forest":
            fitted = forest_on_sets(in_few_tasks(drawn_sets(draws.where(seen), cats)), merged, skill_list, settings)
        else:
            fitted = boosting_on_sets(merged, skill_list, settings)
        held = sums.where(~seen).select(*by, "fold").distinct()
        return _written(fitted.predict_sets(held).withColumn("model", F.lit(fitted.name)), "predicted")

    jobs = [(fold, kind) for fold in range(settings.folds) for kind in ("boosting", "forest")]
    with ThreadPool(FITS_AT_ONCE) as pool:
        parts = pool.map(inheritable_thread_target(train.sparkSession)(predicted), jobs, chunksize=1)
    held = with_predictions(train, reduce(DataFrame.unionByName, parts), [*by, "fold"])
    return held.select("model", F.lit("held_out").alias("split"), "model_key", TITLE, "y", "yhat")


def better_model(metrics: DataFrame, split: str) -> str:
    """The forest if its R2 is strictly higher, else boosting.

    ``metrics`` holds a dozen rows by construction.
    """
    rows = metrics.where((F.col("split") == split) & (F.col("metric") == "r2")).collect()
    r2 = {r["model"]: r["value"] for r in rows}
    return "random_forest" if r2["random_forest"] > r2["gradient_boosting"] else "gradient_boosting"


# ---- importances ---------------------------------------------------------

def importance_table(spark: SparkSession, fitted: Fitted) -> DataFrame:
    """(feature, skill, importance, rank); as many rows as the model has features."""
    by_column = {f"num_{skills.indicator_name(s)}": s for s in fitted.skills}
    ranked = sorted(zip(fitted.names, fitted.importances), key=lambda x: (-x[1], x[0]))
    rows = [(n, by_column.get(n), float(w), i) for i, (n, w) in enumerate(ranked, 1)]
    return spark.createDataFrame(rows, "feature string, skill string, importance double, rank int")


def item_rows(rows: DataFrame, categories: list[str], group: Column | None = None) -> DataFrame:
    """Training rows as ``trees.fit_forest`` takes them, with their other columns."""
    items = trees.feature_items(categories, {"skill": "skills"})
    train = F.col("split") == "train"
    return rows.select(
        "*", (F.lit("all") if group is None else group).alias("grp"), items.alias("items"), F.col("model_key").alias("key"), train.alias("train")
    )


def fit_deep_forest(rows: DataFrame, settings: Settings, seed: int = rules.SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """A forest without a bound on depth: (rows with ``yhat``, importances).

    Grown on the train rows; all others are scored.  Where the settings ask for it, features less important
    than the average in a first forest are left out.
    """
    prepared = item_rows(rows, categories_of(settings))
    drawn = trees.draw_sets(prepared, trees_wanted(settings), seed=seed)
    if settings.select_features:
        scout = trees.forest_on(drawn, settings.selection_trees)
        drawn, left = trees.without_unimportant(drawn, scout.importances)
    forest = trees.forest_on(drawn, settings.forest_trees)
    if settings.select_features:  # predictions by what a row shows, not by what is left of it
        whole = left.join(forest.predictions, ["grp", "items"]).select("grp", F.col("whole").alias("items"), "yhat")
        forest = replace(forest, predictions=whole)
    return trees.score_rows(prepared, forest).select(*rows.columns, "yhat"), forest.importances


def item_importance_table(importances: DataFrame) -> DataFrame:
    """(feature, skill, importance, rank) of a forest of one group."""
    skill = F.when(F.col("feature").startswith("skill="), F.substring("feature", len("skill=") + 1, 1 << 20))
    return trees.ranked(importances).select("feature", skill.alias("skill"), "importance", "rank")


def skill_importance_by_role(df: DataFrame, key: str, seq: str, settings: Settings = MARKET) -> DataFrame:
    """(role, skill, importance, rank, status) for the first roles to appear.

    One fit for all roles, each with its own forest of unbounded depth on place, company and skills.
    A role with too few observed salaries, or whose skills were assumed from its title,
    gets a status and no numbers.
    """
    spark = df.sparkSession
    roles = [r[TITLE] for r in stats.roles_by_appearance(df, TITLE, seq, rules.ROLES_EXPLAINED).collect()]
    known = drop_null_target(regress.observed_only(df)).where(F.col(TITLE).isin(roles))
    counts = known.groupBy(TITLE).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("skill_origin") == "title_default").alias("assumed"),
    )
    found = {r[TITLE]: r for r in counts.collect()}  # one row per role
    states = {}
    for role in roles:
        if role not in found or found[role]["n"] < rules.MIN_ROLE_ROWS:
            states[role] = "insufficient_data"
        elif found[role]["assumed"] == found[role]["n"]:
            states[role] = "skills_assumed_from_title"
    schema = "role string, skill string, importance double, rank int, status string"
    out = spark.createDataFrame([(r, None, None, None, s) for r, s in states.items()], schema)
    fitted = [r for r in roles if r not in states]
    if not fitted:
        return out
    role_settings = replace(settings, with_company=True, select_features=False)
    rows = training_rows(known.where(F.col(TITLE).isin(fitted)), key, role_settings).where("split = 'train'")
    forest = trees.fit_forest(item_rows(rows, [PLACE, COMPANY], F.col(TITLE)), settings.forest_trees, seed=settings.seed)
    listed = F.array(*[F.lit(s) for s in skills.observed_list(known)]).cast("array<string>")
    wanted = spark.createDataFrame([(r,) for r in fitted], "grp string").select("grp", F.explode(listed).alias("skill"))
    wanted = wanted.withColumn("feature", F.concat(F.lit("skill="), "skill"))
    weights = wanted.join(forest.importances, ["grp", "feature"], "left").withColumn("importance", F.coalesce("importance", F.lit(0.0)))
    return out.unionByName(trees.ranked(weights).select(
        F.col("grp").alias("role"), "skill", "importance", "rank", F.lit("fitted").alias("status")
    ))
