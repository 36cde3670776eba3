"""Split, baseline and regression metrics, all as plain aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens import rules
from wagelens.functions.keys import split_side
from wagelens.operators.stats import exact_mean


def with_split(df: DataFrame, key: str, seed: int = rules.SPLIT_SEED) -> DataFrame:
    """Mark every row train or test by its key; stable under re-partitioning."""
    return df.withColumn("split", split_side(F.col(key), seed))


def standardise(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population spread; 0 for a constant column, NULL stays NULL."""
    source = df if fit_on is None else fit_on
    moments = [
        F.struct(exact_mean(F.col(c)).alias("mean"), F.stddev_pop(c).alias("sd")).alias(c) for c in columns
    ]
    fitted = source.agg(*moments).select(F.struct(*columns)).scalar()
    scaled = {
        c: F.when(
            F.col(c).isNotNull(),
            F.coalesce(F.try_divide(F.col(c) - fitted[c]["mean"], fitted[c]["sd"]), F.lit(0.0)),
        )
        for c in columns
    }
    return df.withColumns(scaled)


def group_mean_predictor(
    df: DataFrame, target: str = "annual_salary", by: str = "standardized_title", bounded_groups: bool = True
) -> DataFrame:
    """Predict the train mean of the group, or the overall train mean.

    Title classes are a fixed set of 22 values, so their means are broadcast;
    with ``bounded_groups=False`` the optimizer chooses by measured size.
    """
    train = df.where((F.col("split") == "train") & F.col(target).isNotNull())
    means = train.groupBy(F.col(by).alias("_group")).agg(exact_mean(F.col(target)).alias("_mean"))
    overall = train.agg(exact_mean(F.col(target)).alias("m")).scalar()
    side = F.broadcast(means) if bounded_groups else means
    joined = df.join(side, F.col(by) == F.col("_group"), "left")
    return joined.withColumn("yhat", F.coalesce("_mean", overall)).drop("_group", "_mean")


def observed_only(df: DataFrame) -> DataFrame:
    """Rows whose salary was read from the posting, the only ones ever scored."""
    return df.where(F.col("salary_origin") == "observed")


def regression_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", by: tuple[str, ...] = ("model", "split")) -> DataFrame:
    """RMSE, R2 and MAE per group in long form.

    R2 is 1 - SSE/SST, which goes negative for a poor model; it is not the
    squared correlation.
    """
    err = F.col(y) - F.col(yhat)
    n = F.count(F.lit(1))
    sse = F.sum(err * err)
    known = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    wide = known.groupBy(*by).agg(
        F.sqrt(sse / n).alias("rmse"),
        (F.lit(1.0) - F.try_divide(sse, F.var_pop(y) * n)).alias("r2"),
        F.avg(F.abs(err)).alias("mae"),
    )
    items = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("rmse", "r2", "mae")]
    return wide.select(*by, F.inline(F.array(*items)))


def residuals(df: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    return df.withColumn("residual", F.col(y) - F.col(yhat))
