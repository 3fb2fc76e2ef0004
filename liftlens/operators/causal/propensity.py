"""Propensity scores on confounder cells (C4) and their diagnostics (C11).

* ``saturated`` – P(t=1 | cell) = n1 / n, pure column arithmetic.
* ``logit`` – L2-regularised logistic regression with a free intercept on
  the one-hot confounders (scikit-learn's default: C=1, intercept not
  penalised), weighted by cell counts.  One model, or one per key (bootstrap
  replicates, placebo simulations, run dates): the cells of a key, at most
  prod(levels) of them, are gathered in one row and fitted there by at most ``STEPS``
  Newton steps in column expressions, one shuffle for all keys together.
* ``spark_ml`` – the single model by ``pyspark.ml``, for encodings with very many levels;
  agrees with ``logit`` to 1e-6 or better (tested).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftlens.operators.causal.encode import CONFOUNDERS

MODELS = ("saturated", "logit", "spark_ml")
#: Newton steps of a logit fit, the longest move of a coefficient in one step, digits of a score
STEPS, MAX_MOVE, DIGITS = 24, 5.0, 12
#: a model whose coefficients move less is left as it is
SETTLED = 1e-13


def saturated_scores(cells: DataFrame) -> DataFrame:
    return cells.withColumn("ps", F.col("n1") / F.col("n"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _field(name: str) -> Callable[[Column], Column]:
    return lambda c: c[name]


def _is(value: Column) -> Callable[[Column], Column]:
    return lambda level: F.coalesce(level == value, F.lit(False)).cast("double")


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def _sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _solve(rows: Column) -> Column:
    """Solution of a positive definite system given as the rows of (matrix | right side), by elimination."""
    def eliminate(m: Column, j: Column) -> Column:
        def against(pivot: Column) -> Column:
            return F.transform(m, lambda row, i: F.when(i == j, row).otherwise(_let(
                F.get(row, j) / F.get(pivot, j), lambda f: F.zip_with(row, pivot, lambda a, b: a - b * f))))
        return _let(F.get(m, j), against)
    done = F.aggregate(F.sequence(F.lit(0), F.size(rows) - 1), rows, eliminate)
    return F.transform(done, lambda row, i: F.element_at(row, -1) / F.get(row, i))


def _newton_step(beta: Column, cells: Column, members: Column, C: float) -> Column:
    """(beta, move) one step on; ``cells`` are (x, n, n1), ``members`` lists the cells of every design column."""
    def moved(weights: Column) -> Column:
        def row(at: Column, j: Column) -> Column:
            hessian = F.aggregate(at, F.transform(beta, lambda b: F.lit(0.0)), lambda acc, i: _let(
                F.get(weights, i)["w"] * F.get(F.get(cells, i)["x"], j),
                lambda w: F.zip_with(acc, F.get(cells, i)["x"], lambda h, x: h + w * x)))
            slope = F.aggregate(at, F.lit(0.0), lambda acc, i: acc + F.get(weights, i)["r"] * F.get(F.get(cells, i)["x"], j))
            ridge = F.when(j > 0, F.lit(1.0 / C)).otherwise(0.0)
            return F.concat(F.transform(hessian, lambda h, i: h + F.when(i == j, ridge).otherwise(0.0)),
                            F.array(slope - ridge * F.get(beta, j)))
        return _let(_solve(F.transform(members, row)), lambda step: _let(
            F.array_max(F.transform(step, lambda d: F.abs(d))), lambda most: _let(
                F.least(F.lit(1.0), MAX_MOVE / F.greatest(most, F.lit(1e-300))), lambda scale: F.struct(
                    F.zip_with(beta, step, lambda b, d: b + d * scale).alias("beta"), most.alias("move")))))
    weights = F.transform(cells, lambda c: _let(_sigmoid(_dot(c["x"], beta)), lambda p: F.struct(
        (c["n"] * p * (1 - p)).alias("w"), (c["n1"] - c["n"] * p).alias("r"))))
    return _let(weights, moved)


def logit_scores(cells: DataFrame, confounders: Sequence[str] = CONFOUNDERS,
                 keys: Sequence[str] = (), C: float = 1.0, steps: int = STEPS) -> DataFrame:
    """Logistic propensity ``ps`` of every cell, one model per key.

    Minimises  sum [n1 log(1+e^-z) + n0 log(1+e^z)] + |beta without intercept|^2 / 2C  by ``steps``
    Newton steps at most from the model that has the intercept only, all keys at once.  Strings are
    one-hot (all levels of the key, NULL is none of them), other confounders numbers.  Scores
    are rounded to ``DIGITS`` digits, so that equal ones tie whatever the order of summation.
    """
    cats = [c for c in confounders if isinstance(cells.schema[c].dataType, T.StringType)]
    nums = [c for c in confounders if c not in cats]
    others = [c for c in cells.columns if c not in (*confounders, *keys)]
    held = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*confounders, *others))).alias("__cells"))
    held = held.withColumns({f"__l{i}": F.array_sort(F.array_distinct(F.filter(
        F.transform("__cells", _field(name)), lambda v: v.isNotNull()))) for i, name in enumerate(cats)})

    def design(c: Column) -> Column:
        plain = F.array(F.lit(1.0), *[c[name].cast("double") for name in nums])
        levels = [F.transform(f"__l{i}", _is(c[name])) for i, name in enumerate(cats)]
        return F.struct(F.concat(plain, *levels).alias("x"), c["n"].cast("double").alias("n"), c["n1"].cast("double").alias("n1"))
    held = held.withColumn("__x", F.transform("__cells", design))
    columns = F.sequence(F.lit(0), F.size(F.get(F.col("__x"), 0)["x"]) - 1)
    n, n1 = (F.aggregate(F.transform("__x", _field(k)), F.lit(0.0), lambda acc, v: acc + v) for k in ("n", "n1"))
    held = held.where(F.size("__cells") > 0).withColumns({
        "__members": F.transform(columns, lambda j: F.filter(F.sequence(F.lit(0), F.size("__x") - 1),
                                                            lambda i: F.get(F.get(F.col("__x"), i)["x"], j) != 0)),
        "__start": F.transform(columns, lambda j: F.when(j == 0, F.log((n1 + 0.5) / (n - n1 + 0.5))).otherwise(0.0))})
    start = F.struct(F.col("__start").alias("beta"), F.lit(1.0).alias("move"))
    fit = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, lambda s, _: F.when(s["move"] < SETTLED, s).otherwise(
        _newton_step(s["beta"], F.col("__x"), F.col("__members"), C)))
    fitted = held.select(*keys, "__cells", "__x", fit["beta"].alias("__beta"))
    scored = F.zip_with("__cells", "__x", lambda c, x: c.withField(
        "ps", F.round(_sigmoid(_dot(x["x"], F.col("__beta"))), DIGITS)))
    return fitted.select(*keys, F.inline(scored)).select(*cells.columns, "ps")


def spark_ml_scores(cells: DataFrame, confounders: Sequence[str] = CONFOUNDERS,
                    C: float = 1.0) -> DataFrame:
    """The logit model fitted with ``pyspark.ml`` on weighted (cell, label) rows.

    Spark's objective is mean weighted loss + regParam/2 |beta|^2, so
    regParam = 1 / (C * total weight) gives the same optimum.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    cats = [c for c in confounders if isinstance(cells.schema[c].dataType, T.StringType)]
    nums = [c for c in confounders if c not in cats]
    total = cells.agg(F.sum("n")).first()[0]
    rows = cells.withColumn("_lw", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("n1").cast("double").alias("w")),
        F.struct(F.lit(0.0).alias("label"), (F.col("n") - F.col("n1")).cast("double").alias("w")))))
    rows = rows.select("*", "_lw.label", "_lw.w").drop("_lw").where(F.col("w") > 0)
    stages = [StringIndexer(inputCol=c, outputCol=f"_{c}_ix", stringOrderType="alphabetAsc") for c in cats]
    stages += [OneHotEncoder(inputCols=[f"_{c}_ix" for c in cats],
                             outputCols=[f"_{c}_oh" for c in cats], dropLast=False)]
    stages += [VectorAssembler(inputCols=nums + [f"_{c}_oh" for c in cats], outputCol="_features")]
    stages += [LogisticRegression(featuresCol="_features", labelCol="label", weightCol="w",
                                  regParam=1.0 / (C * total), elasticNetParam=0.0,
                                  standardization=False, fitIntercept=True,
                                  tol=1e-12, maxIter=1000)]
    model = Pipeline(stages=stages).fit(rows)
    scored = model.transform(cells.withColumn("label", F.lit(0.0)).withColumn("w", F.lit(1.0)))
    return scored.select(*cells.columns, vector_to_array("probability")[1].alias("ps"))


def score_cells(cells: DataFrame, model: str = "saturated", confounders: Sequence[str] = CONFOUNDERS,
                keys: Sequence[str] = (), C: float = 1.0) -> DataFrame:
    if model == "saturated":
        return saturated_scores(cells)
    if model == "logit":
        return logit_scores(cells, confounders, keys, C)
    if model == "spark_ml":
        if keys:
            raise ValueError("spark_ml fits one model; use 'logit' for keyed fits")
        return spark_ml_scores(cells, confounders, C)
    raise ValueError(f"propensity model must be one of {MODELS}")


def propensity_summary(scored: DataFrame, keys: Sequence[str] = (), clip_floor: float = 0.05) -> DataFrame:
    """C11: score range, distinct scores, share of sessions under a clip floor, treated share."""
    n = F.col("n")
    return scored.groupBy(*keys).agg(
        F.min("ps").alias("ps_min"),
        F.max("ps").alias("ps_max"),
        F.count_distinct("ps").alias("n_distinct_scores"),
        F.count(F.lit(1)).alias("n_cells"),
        (F.sum(F.when(F.col("ps") < clip_floor, n).otherwise(0)) / F.sum(n)).alias("share_below_floor"),
        (F.sum("n1") / F.sum(n)).alias("treated_share"),
        F.count_if(F.col("n1") == 0).alias("cells_without_treated"),
    )
