"""Model scoring, fitting and tuning on Spark ML.

* ``linear_score``  the logistic score 1 / (1 + exp(-(b0 + sum b_j x_j))) as a Column, so a
                    fitted (or fixed) coefficient vector scores any table inside codegen.
* fitting          ``Pipeline(VectorAssembler, StandardScaler, LogisticRegression)`` for
                    logit / ridge / lasso / elastic net; ``RandomForestClassifier`` for the
                    forest.  Every fit is a distributed job (tree aggregates over the rows).
* tuning           ``cross_validate`` runs candidates x folds on a bounded thread pool, with
                    per-fold preprocessing (and optional resampling of the training part) and a
                    ledger of finished fits.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def linear_predictor(coefs: Mapping[str, float], intercept: float = 0.0) -> Column:
    z = F.lit(float(intercept))
    for name, b in coefs.items():
        z = z + F.lit(float(b)) * F.col(name).cast("double")
    return z


def linear_score(coefs: Mapping[str, float], intercept: float = 0.0) -> Column:
    """Logistic probability of the positive class for fixed coefficients."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-linear_predictor(coefs, intercept)))


def linear_score_sql(coefs: Mapping[str, float], intercept: float = 0.0) -> str:
    """The same score as SQL text (used by the oracle and for scoring inside SQL)."""
    z = f"CAST({float(intercept)!r} AS DOUBLE)"
    for name, b in coefs.items():
        z = f"({z} + CAST({float(b)!r} AS DOUBLE) * CAST({name} AS DOUBLE))"
    return f"(1.0 / (1.0 + exp(-({z}))))"


# --------------------------------------------------------------------------- preparation
import math  # noqa: E402
import threading  # noqa: E402
from collections.abc import Callable, Sequence  # noqa: E402

from pyspark.ml import Pipeline, PipelineModel  # noqa: E402
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier  # noqa: E402
from pyspark.ml.feature import StandardScaler, VectorAssembler  # noqa: E402
from pyspark.ml.functions import vector_to_array  # noqa: E402
from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql.types import DoubleType  # noqa: E402

INTERCEPT = "(Intercept)"


def complete_cases(df: DataFrame, cols: Sequence[str], missing: str) -> DataFrame:
    """Explicit missing-value policies beside ``impute``: ``drop`` (listwise deletion), ``zero`` (fill
    with 0) or ``error`` (fail on the first NULL, like a formula interface with na.fail)."""
    if missing == "drop":
        return df.dropna(how="any", subset=list(cols))
    if missing == "zero":
        return df.fillna(0, subset=list(cols))
    if missing == "error":
        n = df.where(" OR ".join(f"`{c}` IS NULL" for c in cols)).limit(1).count()
        if n:
            raise ValueError("model input has missing values")
        return df
    raise ValueError(f"unknown missing policy {missing!r}")


def median_values(train: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact medians of the training rows (NULLs ignored): one number per column."""
    from hhlens.operators.ordered import exact_quantiles

    got = exact_quantiles(train, cols, [0.5]).collect()
    return {r["variable"]: r["q"] for r in got}


def impute(df: DataFrame, values: Mapping[str, float], indicators: bool = False) -> DataFrame:
    """Missing-value policy that loses no row: NULLs take the value learned on the training
    rows (a column without any known training value takes 0), on training and test rows alike;
    ``indicators`` adds ``<column>_missing`` (0/1) for every imputed column."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(float(v if v is not None else 0.0)))
              for c, v in values.items()}
    flags = {f"{c}_missing": F.col(c).isNull().cast("int") for c in values} if indicators else {}
    return df.withColumns(flags).withColumns(filled) if flags else df.withColumns(filled)


def logistic_pipeline(features: Sequence[str], label: str, reg: float = 0.0, alpha: float = 0.0,
                      weight: str | None = None, max_iter: int = 500, tol: float = 1e-10) -> Pipeline:
    """Assemble -> centre and scale (sample sd, fitted on the training rows) -> logistic
    regression with penalty reg * ((1 - alpha) / 2 * |b|^2 + alpha * |b|_1) on the scaled
    predictors (``standardization=False`` so the penalty means what the grid says)."""
    asm = VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="error")
    sc = StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=float(reg),
                            elasticNetParam=float(alpha), standardization=False,
                            maxIter=max_iter, tol=tol, family="binomial")
    if weight:
        lr.setWeightCol(weight)
    return Pipeline(stages=[asm, sc, lr])


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, reg: float = 0.0,
                 alpha: float = 0.0, weight: str | None = None, **kw) -> PipelineModel:
    data = df.withColumn(label, F.col(label).cast("double"))
    return logistic_pipeline(features, label, reg, alpha, weight, **kw).fit(data)


def scaler_stats(model: PipelineModel) -> tuple[list[float], list[float]]:
    sc = model.stages[1]
    return list(sc.mean.toArray()), list(sc.std.toArray())


def coefficient_table(model: PipelineModel, features: Sequence[str]) -> list[tuple]:
    """(term, estimate on scaled predictors, estimate on the original units)."""
    lr = model.stages[-1]
    beta = list(lr.coefficients.toArray())
    mean, std = scaler_stats(model)
    raw = [b / s if s else 0.0 for b, s in zip(beta, std)]
    b0_raw = lr.intercept - sum(r * m for r, m in zip(raw, mean))
    rows = [(INTERCEPT, float(lr.intercept), float(b0_raw))]
    rows += [(f, float(b), float(r)) for f, b, r in zip(features, beta, raw)]
    return rows


def coefficients(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    return spark.createDataFrame(coefficient_table(model, features),
                                 "term string, estimate double, estimate_unscaled double")


def scaled_columns(features: Sequence[str], mean: Sequence[float], std: Sequence[float]) -> list[Column]:
    return [((F.col(f).cast("double") - F.lit(m)) / F.lit(s if s else 1.0)).alias(f)
            for f, m, s in zip(features, mean, std)]


def kkt_check(df: DataFrame, model: PipelineModel, features: Sequence[str], label: str,
              reg: float, alpha: float, tol: float = 1e-6) -> DataFrame:
    """Optimality conditions of the fitted penalised logistic regression, one row per term.

    With g_j = mean(x_j (p - y)) on the scaled predictors the optimum satisfies
    g_0 = 0 for the intercept, g_j + reg (1 - alpha) b_j + reg alpha sign(b_j) = 0 where
    b_j != 0, and |g_j + reg (1 - alpha) b_j| <= reg alpha where b_j = 0.  All gradients
    come from ONE aggregate over the rows; ``ok`` says the condition holds within ``tol``."""
    lr = model.stages[-1]
    beta = list(lr.coefficients.toArray())
    mean, std = scaler_stats(model)
    xs = scaled_columns(features, mean, std)
    z = F.lit(float(lr.intercept))
    for b, c in zip(beta, features):
        z = z + F.lit(float(b)) * F.col(c)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    r = df.select(*xs, F.col(label).cast("double").alias("_y")).withColumn("_res", p - F.col("_y"))
    g = r.agg(F.avg("_res").alias(INTERCEPT),
              *[F.avg(F.col(c) * F.col("_res")).alias(c) for c in features]).first()
    rows = [(INTERCEPT, float(lr.intercept), float(g[INTERCEPT]), abs(g[INTERCEPT]) <= tol)]
    l1, l2 = reg * alpha, reg * (1 - alpha)
    for c, b in zip(features, beta):
        gj = float(g[c]) + l2 * b
        if b != 0.0:
            ok = abs(gj + l1 * math.copysign(1.0, b)) <= tol
        else:
            ok = abs(gj) <= l1 + tol
        rows.append((c, float(b), float(g[c]), bool(ok)))
    return df.sparkSession.createDataFrame(
        rows, "term string, estimate double, gradient double, ok boolean")


def null_gradients(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """|mean(x_j (y - mean y))| on centred/scaled predictors = |cov_pop(x_j, y)| / sd_j,
    one aggregate: the gradient of the log-loss at the intercept-only model."""
    y = F.col(label).cast("double")
    aggs = []
    for c in features:
        x = F.col(c).cast("double")
        aggs.append(F.try_divide(F.abs(F.covar_pop(x, y)), F.stddev_samp(x)).alias(c))
    wide = df.agg(*aggs)
    return wide.unpivot([], list(features), "term", "gradient")


def lambda_max(df: DataFrame, features: Sequence[str], label: str,
               alphas: Sequence[float]) -> DataFrame:
    """Smallest penalty giving the intercept-only model for each alpha > 0:
    lambda_max(alpha) = max_j |mean(x_j (y - mean y))| / alpha (scaled predictors).
    Every grid point at or above it shares the null model, so it needs no fit."""
    gmax = null_gradients(df, features, label).agg(F.max("gradient").alias("g")).first()["g"]
    rows = [(float(a), float(gmax) / float(a)) for a in alphas if a > 0]
    return df.sparkSession.createDataFrame(rows, "alpha double, lambda_max double")


def prob_of_positive(pred: DataFrame, out: str = "prob") -> DataFrame:
    """Class-1 probability from Spark ML's probability vector (``predict(type="prob")[,2]``)."""
    return pred.withColumn(out, vector_to_array("probability")[1])


# --------------------------------------------------------------------------- forest
def forest_pipeline(features: Sequence[str], label: str, mtry: int, min_node_size: int,
                    num_trees: int = 300, max_depth: int = 20, seed: int = 123,
                    max_bins: int = 32) -> Pipeline:
    """Random forest of probability trees (gini).  ``mtry`` -> featureSubsetStrategy,
    ``min_node_size`` -> minInstancesPerNode (a child-size minimum, close to a minimum
    node size), depth capped at ``max_depth`` (Spark allows at most 30).  Rows remember their
    node (``cacheNodeIds``), so no pass walks the trees from their roots; the forest is the same."""
    if not 1 <= mtry <= len(features):
        raise ValueError(f"mtry={mtry} outside 1..{len(features)}")
    if max_depth > 30:
        raise ValueError("a depth over 30 cannot be grown")
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=num_trees,
                                featureSubsetStrategy=str(mtry), minInstancesPerNode=min_node_size,
                                impurity="gini", maxDepth=max_depth, seed=seed,
                                maxBins=max_bins, cacheNodeIds=True)
    return Pipeline(stages=[asm, rf])


def fit_forest(df: DataFrame, features: Sequence[str], label: str, prepared=None, **kw):
    """The fitted forest.  Labels of 0 and 1 are grown by ``forest.grow_forest`` (``prepared``:
    these rows' bins where they are made already), any others by Spark ML."""
    from hhlens.operators import forest

    pipeline = forest_pipeline(features, label, **kw)           # checks the parameters
    max_bins = kw.pop("max_bins", 32)
    data = prepared or forest.prepare(df, features, label, kw.get("seed", 123), max_bins)
    if data is None:
        return pipeline.fit(df.withColumn(label, F.col(label).cast("double")))
    return forest.grow_forest(data, kw.pop("mtry"), kw.pop("min_node_size"), **kw)


def importance_table(model: PipelineModel, features: Sequence[str], spark, top: int | None = None
                     ) -> DataFrame:
    """Impurity importances (summing to 1) and the same scaled to 0..100 by min-max, as a
    ranked (variable, importance, scaled) table, optionally the ``top`` rows."""
    imp = list(model.stages[-1].featureImportances.toArray())
    lo, hi = min(imp), max(imp)
    rows = [(f, float(v), float((v - lo) / (hi - lo) * 100.0) if hi > lo else 100.0)
            for f, v in zip(features, imp)]
    rows.sort(key=lambda r: (-r[1], r[0]))
    if top:
        rows = rows[:top]
    return spark.createDataFrame(rows, "variable string, importance double, scaled double")


# --------------------------------------------------------------------------- tuning
def expand_grid(**axes) -> list[dict]:
    """``expand.grid``: every combination, first axis varying slowest."""
    combos = [{}]
    for name, values in axes.items():
        combos = [dict(c, **{name: v}) for c in combos for v in values]
    return combos


class CVResult:
    """Out-of-fold predictions of a tuning run.

    ``oof``      (candidate, fold, key, label, prob, pred) for every FITTED candidate;
                 candidate -1 is the intercept-only model of a fold.
    ``alias``    (fold, candidate, rep): candidate's predictions in that fold are those of
                 ``rep`` (itself when fitted, -1 when pruned as an intercept-only model).
    ``base``     the stored model input; ``release()`` frees it.
    ``rates``    (fold, rep) -> confusion cells and AUC where the run counted them."""

    rates: dict | None = None

    def __init__(self, oof, alias, base, n_fits):
        self.oof, self.alias, self.base, self.n_fits = oof, alias, base, n_fits

    def release(self):
        from hhlens.session import drop_cut

        drop_cut(self.base)


def model_score_column(model: PipelineModel) -> Column | None:
    """Class-1 probability of a fitted assembler -> scaler -> logistic pipeline as ONE
    Column over the raw predictor columns (so many candidates score in one projection);
    None for other pipelines."""
    from pyspark.ml.classification import LogisticRegressionModel

    st = model.stages
    if not (len(st) == 3 and isinstance(st[-1], LogisticRegressionModel)):
        return None
    feats = st[0].getInputCols()
    mean, std = scaler_stats(model)
    lr = st[-1]
    z = F.lit(float(lr.intercept))
    for f, m, sd, b in zip(feats, mean, std, lr.coefficients.toArray()):
        if b != 0.0:
            z = z + F.lit(float(b)) * ((F.col(f).cast("double") - F.lit(m)) / F.lit(sd if sd else 1.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def cross_validate(df: DataFrame, features: Sequence[str], label: str, fold_col: str,
                   candidates: Sequence[dict], fit: Callable[..., PipelineModel],
                   key: str = "id", threshold: float = 0.5,
                   resample: Callable[[DataFrame, int], DataFrame] | None = None,
                   pruned: Callable[[DataFrame, dict], bool] | None = None,
                   parallelism: int = 4, ledger: str | None = None, run: object = None,
                   whole: bool = False) -> CVResult:
    """k-fold tuning: every candidate is fitted on each fold's training part and scored on
    the held-out part.

    The work is kept in a ``FitLedger``: the model input and each fold's (optionally
    resampled, e.g. SMOTE on the training rows only, never on the held-out rows) training part
    are stored once, every finished fit writes its held-out scores.  With ``ledger`` (a folder
    that outlives the session) a run that was stopped goes on where it ended; ``run`` then
    names what else the fits depend on (input, trees, seed), so that no other run's folder is
    taken.  ``whole`` makes the resampled table of all rows (ledger table ``train/all``, for a
    refit) beside the folds' parts.  ``pruned(train, cand)`` marks candidates known to give the
    intercept-only model (penalty >= lambda_max); they share one constant prediction per fold
    instead of a fit.  A ``resample`` with a ``prepare(base, fold_col, folds)`` gets the whole input
    first, for what the folds' parts share."""
    from hhlens.operators.ledger import FitLedger
    from hhlens.session import scratch_path

    spark = df.sparkSession
    book = FitLedger(spark, ledger or scratch_path(spark, "cv"), {
        "features": list(features), "label": label, "candidates": list(candidates), "resampled": resample is not None, "run": run})
    base = book.table("base", lambda: df.select(key, F.col(label).cast("int").alias(label), fold_col, *features))
    folds = sorted(r[0] for r in base.select(fold_col).distinct().collect())
    own = {f: base.where(F.col(fold_col) != f) for f in folds}
    train, alias = own, []
    if resample is not None:
        wanted = {f: (f"train/fold={f}", lambda f=f: resample(own[f], f)) for f in folds}
        if whole:
            wanted["all"] = ("train/all", lambda: resample(base, "all"))
        if hasattr(resample, "prepare") and not all(book.has(name) for name, _ in wanted.values()):
            resample.prepare(base, fold_col, folds)
        train = book.tables(wanted, parallelism)
    for f in folds:
        for i, cand in enumerate(candidates):
            alias.append((int(f), i, -1 if pruned is not None and pruned(train[f], cand) else i))

    def make(f, rep):
        valid = base.where(F.col(fold_col) == f)
        if rep == -1:
            p = F.lit(float(train[f].agg(F.avg(F.col(label).cast("double"))).first()[0]))
        else:
            m = fit(train[f], **candidates[rep])
            p = model_score_column(m)
            if p is None:        # not a linear pipeline: score with the model itself
                valid, p = prob_of_positive(m.transform(valid.withColumn(label, F.col(label).cast("double")))), F.col("prob")
        return valid.select(key, F.col(label).cast("int").alias(label), p.alias("prob"))

    jobs = sorted({(f, r) for f, _, r in alias})
    book.run(jobs, make, parallelism)
    oof = book.scores().select("candidate", "fold", key, label, "prob",
                               (F.col("prob") > F.lit(threshold)).cast("int").alias("pred"))
    alias_df = spark.createDataFrame(alias, "fold int, candidate int, rep int")
    cv = CVResult(oof, alias_df, base, sum(r != -1 for _, r in jobs))
    cv.ledger, cv.whole = book, train.get("all")
    return cv


def smote_part(features: Sequence[str], label: str, key: str = "id", k: int = 5, seed=123):
    """``resample`` callback for ``cross_validate``: the rows with SMOTE rows that balance them.
    Its ``prepare`` searches the neighbours for all training parts at once."""
    from hhlens.operators.neighbors import knn_folds
    from hhlens.operators.sampling import smote

    near: dict = {}

    def resample(part: DataFrame, fold) -> DataFrame:
        own = part.select(key, label, *features)
        return own.unionByName(smote(own, label, features, key, 1, k=k, seed=f"{seed}|{fold}", neighbours=near.get(fold)))

    def prepare(base: DataFrame, fold_col: str, folds: Sequence) -> None:
        got = knn_folds(base.where(F.col(label) == 1), key, features, fold_col, folds, k) or {}
        near.update({"all" if f is None else f: d for f, d in got.items()})

    resample.prepare = prepare
    return resample


def tune_forest(train: DataFrame, features: Sequence[str], label: str, grid: Mapping[str, Sequence], trees: int,
                fold_col: str = "fold", key: str = "id", k: int = 5, seed=123, parallelism: int = 4,
                ledger: str | None = None, run: object = None):
    """Random forest tuned by k-fold accuracy with SMOTE in the training folds, then refitted
    on all training rows with their own SMOTE rows: (CV result, results table, best candidate,
    model).  Ties go to the smaller ``mtry``, then the smaller node size."""
    from hhlens.operators import forest

    cands = expand_grid(mtry=grid["mtry"], min_node_size=grid["min_node_size"])
    resample = smote_part(features, label, key, k, seed)

    bins, lock = {}, threading.Lock()

    def fit(part, mtry, min_node_size):
        with lock:                              # a fold's candidates share the bins of its rows
            own = bins.setdefault(id(part), (part, threading.Lock(), []))
        with own[1]:
            if not own[2]:
                own[2].append(forest.prepare(part, features, label, seed))
        return fit_forest(part, features, label, own[2][0], mtry=int(mtry), min_node_size=int(min_node_size),
                          num_trees=trees, seed=seed)

    cv = cross_validate(train, features, label, fold_col, cands, fit, key, resample=resample, parallelism=parallelism,
                        ledger=ledger, run={"run": run, "trees": trees, "seed": seed, "k": k, "grower": "units"}, whole=True)
    results = tuning_results(cv, cands, label)
    best = best_candidate(results, tie_break=(("mtry", True), ("min_node_size", True)))
    return cv, results, best, fit(cv.whole, best["mtry"], best["min_node_size"])


def lambda_max_pruner(features: Sequence[str], label: str):
    """``pruned`` callback for ``cross_validate``: lambda >= lambda_max(alpha) of the fold's
    training rows (alpha > 0).  One aggregate per fold, remembered across candidates."""
    memo: dict = {}

    def pruned(train: DataFrame, cand: dict) -> bool:
        a, lam = float(cand.get("alpha", 0.0)), float(cand.get("reg", 0.0))
        if a <= 0 or lam <= 0:
            return False
        if memo.get("train") is not train:      # the frame itself is held, so its id is not reused
            memo.update(train=train, gmax=null_gradients(train, features, label).agg(F.max("gradient")).first()[0])
        return lam >= memo["gmax"] / a

    return pruned


def tuning_results(cv: CVResult, candidates: Sequence[dict], label: str = "Pobre",
                   positive: int = 1) -> DataFrame:
    """``$results``: per candidate the mean and sd over folds of ROC, Sens, Spec, Accuracy,
    Kappa, next to the candidate's parameters.  Fold metrics are computed once per fitted
    model (distributed aggregates) and shared with the candidates aliased to it."""
    from hhlens.operators.evaluate import five_stats, metric_columns

    if cv.rates is not None:            # counted in the scoring pass: one row per fold and model
        rows = [(f, c, *[int(r[k]) for k in ("tp", "fp", "fn", "tn")], r["auc"]) for (f, c), r in sorted(cv.rates.items())]
        t = cv.base.sparkSession.createDataFrame(rows, "fold int, rep int, tp long, fp long, fn long, tn long, ROC double")
        m = metric_columns(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])
        per_fold = t.select("fold", "rep", "ROC", m["Sensitivity"].alias("Sens"), m["Specificity"].alias("Spec"),
                            m["Accuracy"].alias("Accuracy"), m["Kappa"].alias("Kappa"))
    else:
        per_fold = five_stats(cv.oof, "prob", "pred", label, positive, groups=["candidate", "fold"])
        per_fold = per_fold.withColumnRenamed("candidate", "rep")
    stats = ["ROC", "Sens", "Spec", "Accuracy", "Kappa"]
    expanded = cv.alias.join(per_fold, on=["rep", "fold"], how="left")
    agg = expanded.groupBy("candidate").agg(
        *[F.avg(s).alias(s) for s in stats], *[F.stddev_samp(s).alias(f"{s}SD") for s in stats])
    spark = cv.oof.sparkSession
    keys = sorted({k for c in candidates for k in c})
    rows = [(i, *[float(c[k]) if c.get(k) is not None else None for k in keys])
            for i, c in enumerate(candidates)]
    params = spark.createDataFrame(rows, "candidate int" + "".join(f", {k} double" for k in keys))
    return params.join(agg, on="candidate", how="left")


def best_candidate(results: DataFrame, metric: str = "Accuracy",
                   tie_break: Sequence[tuple[str, bool]] = (("reg", False), ("alpha", True))) -> dict:
    """``bestTune``: highest mean metric; ties go to the larger penalty, then smaller alpha."""
    order = [F.col(metric).desc_nulls_last()]
    for col, asc in tie_break:
        if col in results.columns:
            order.append(F.col(col).asc() if asc else F.col(col).desc())
    return results.orderBy(*order).limit(1).first().asDict()


def glm_summary(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``summary(glm(..., family = binomial))`` on centred/scaled predictors: estimate,
    standard error, z and p per term, with the model's AIC, deviance and null deviance."""
    from pyspark.ml.regression import GeneralizedLinearRegression

    data = df.withColumn(label, F.col(label).cast("double"))
    asm = VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="error")
    sc = StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)
    glr = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="features",
                                      labelCol=label, maxIter=100, tol=1e-10)
    m = Pipeline(stages=[asm, sc, glr]).fit(data)
    g = m.stages[-1]
    s = g.summary
    est = [float(g.intercept)] + [float(v) for v in g.coefficients.toArray()]
    # The summary lists the coefficients first and the intercept last.
    se = list(s.coefficientStandardErrors)
    zv = list(s.tValues)
    pv = list(s.pValues)
    se, zv, pv = [se[-1]] + se[:-1], [zv[-1]] + zv[:-1], [pv[-1]] + pv[:-1]
    terms = [INTERCEPT] + list(features)
    rows = [(t, e, float(a), float(b), float(c), float(s.aic), float(s.deviance), float(s.nullDeviance))
            for t, e, a, b, c in zip(terms, est, se, zv, pv)]
    return df.sparkSession.createDataFrame(
        rows, "term string, estimate double, std_error double, z_value double, p_value double, "
              "aic double, deviance double, null_deviance double")
