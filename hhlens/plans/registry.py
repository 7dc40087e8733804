"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole
test tables (through the adapter views).  Their SQL twins live in ``oracle/``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hhlens.functions.recode import add_dummies, dummy_levels, threshold
from hhlens.operators import describe, evaluate, heavy, linear_tuning, models, ordered, profile, rollup, sampling
from hhlens.plans import households as hh
from hhlens.plans import specs
from hhlens.plans.common import rounded
from hhlens.session import shuffle_partitions
from hhlens.sources import fixtures as fx
from hhlens.sources import io


def build_hogares_full(spark: SparkSession, sf: str, side: str = "train") -> DataFrame:
    return hh.household_table(fx.personas(spark, sf), fx.hogares(spark, sf, side),
                              member_order=fx.HEAD_ORDER)


_STORE: dict = {}
INPUT_BYTES = 8 << 20                   # of compressed input per shuffle partition of a stored table


def _inputs(spark: SparkSession, sf: str) -> tuple:
    """Names, sizes and times of the input files (asked of their folders, no Spark job): a
    stored table is reused only for these."""
    files = {f for t in ("orders", "customer", "lineitem") for f in fx.table(spark, sf, t).inputFiles()}
    path, conf, out = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration(), []
    names = {path(f).toString() for f in files}
    for folder in {f.rsplit("/", 1)[0] for f in files}:
        there = path(folder)
        for st in there.getFileSystem(conf).listStatus(there):
            if st.getPath().toString() in names or path(folder, st.getPath().getName()).toString() in names:
                out.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return tuple(sorted(out)) or tuple(sorted(names))


def _stored(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """A table built once per application and input, written as Parquet under the shared
    checkpoint folder (the survey scripts likewise store tables and reload them).  Its shuffles
    have a partition per ``INPUT_BYTES`` of input at least: with a fixed number the sorts and
    aggregates of one task would grow with the input."""
    inputs = _inputs(spark, sf)
    memo_key = (spark.sparkContext.applicationId, sf, name, inputs)
    if memo_key not in _STORE:
        size = sum(f[1] for f in inputs if isinstance(f, tuple))
        with shuffle_partitions(spark, -(-size // INPUT_BYTES)):
            _STORE[memo_key] = io.write_store(build(), io.scratch(spark, name))
    return io.read_store(spark, _STORE[memo_key])


def hogares_full(spark: SparkSession, sf: str, side: str = "train") -> DataFrame:
    """The household table as later analysis steps read it."""
    return _stored(spark, sf, f"hogares_full_{side}", lambda: build_hogares_full(spark, sf, side))


# ---------------------------------------------------------------- T1 rollup
def household_rollup_train(spark, sf):
    return rounded(build_hogares_full(spark, sf, "train"))


def household_rollup_bucketed(spark, sf):
    """The rollup over persons and households stored in buckets of their household: no exchange
    (``io.write_bucketed``); the stores are made once per application and input."""
    sources = {"personas": fx.personas(spark, sf), "hogares": fx.hogares(spark, sf, "train")}
    n = io.bucket_count(spark, *sources.values())
    tables = {}
    for name, df in sources.items():
        memo_key = (spark.sparkContext.applicationId, sf, f"bucketed_{name}", n, _inputs(spark, sf))
        if memo_key not in _STORE:
            path = io.scratch(spark, f"bucketed_{name}")
            _STORE[memo_key] = path, io.write_bucketed(df, path, "id", n)
        path, bucketed = _STORE[memo_key]
        tables[name] = io.read_bucketed(spark, path, "id", n) if bucketed else io.read_store(spark, path)
    return rounded(hh.household_table(tables["personas"], tables["hogares"], member_order=fx.HEAD_ORDER))


def household_rollup_test(spark, sf):
    return rounded(build_hogares_full(spark, sf, "test"))


def head_features(spark, sf):
    names = [f.name for f in specs.features() if f.scope == "member"]
    return rounded(hh.person_features(fx.personas(spark, sf), names, member_order=fx.HEAD_ORDER))


def member_features(spark, sf):
    names = [f.name for f in specs.features() if f.scope == "all"]
    return rounded(hh.person_features(fx.personas(spark, sf), names, member_order=fx.HEAD_ORDER))


# ---------------------------------------------------------------- T4 description
def poverty_by_department(spark, sf):
    full = hogares_full(spark, sf, "train")
    nation = fx.table(spark, sf, "nation")
    out = describe.ordered_group_shares(full, "Depto", "Pobre", 1, lookup=nation,
                                        lookup_key="n_nationkey", name_col="n_name")
    return rounded(out.withColumnRenamed("n_name", "Nombre_Depto"))


def class_share(spark, sf):
    full = hogares_full(spark, sf, "train")
    return rounded(describe.class_share(full, "Pobre", specs.POBRE_LABELS))


def share_by_head_sex(spark, sf):
    full = hogares_full(spark, sf, "train")
    out = describe.fill_shares(full, "Pobre", "JH_Mujer")
    return rounded(out.withColumn("sex_label", describe.decode("JH_Mujer", {0.0: "Hombre", 1.0: "Mujer"}))
                   .withColumn("class_label", describe.decode("Pobre", specs.POBRE_LABELS)))


def share_by_children(spark, sf):
    return rounded(describe.fill_shares(hogares_full(spark, sf, "train"), "Hijos", "Pobre", (0, 10)))


def share_by_size(spark, sf):
    return rounded(describe.fill_shares(hogares_full(spark, sf, "train"), "Nper", "Pobre", (0, 10)))


# ---------------------------------------------------------------- profiling
def null_counts(spark, sf):
    return profile.null_counts(hogares_full(spark, sf, "train"))


# Columns of person lines with real outliers beside those that have none.
LINE_EXTRAS = {"unit_price": "l_extendedprice / l_quantity", "discount_amount": "l_extendedprice * l_discount",
               "price_per_line": "l_extendedprice / l_linenumber", "tax_amount": "l_extendedprice * l_tax"}


def iqr_outliers(spark, sf):
    """Outliers of the person codes and of what a person's line earns."""
    p = fx.personas(spark, sf).withColumn("income_code", F.expr("l_extendedprice / P6040"))
    return profile.iqr_outliers(p, [*fx.PERSON_CODES, "income_code"])


def iqr_outliers_lineitem(spark, sf):
    li = fx.table(spark, sf, "lineitem").withColumns({n: F.expr(e) for n, e in LINE_EXTRAS.items()})
    return profile.iqr_outliers(li, [*fx.LINEITEM_NUMERIC, *LINE_EXTRAS])


def iqr_outliers_households(spark, sf):
    full = hogares_full(spark, sf, "train")
    return profile.iqr_outliers(full, profile.numeric_columns(full, exclude=["id"]))


def column_profile(spark, sf):
    return rounded(profile.column_profile(fx.personas(spark, sf), list(fx.PERSON_CODES)))


def factor_profile(spark, sf):
    return rounded(profile.factor_profile(fx.personas(spark, sf), specs.FACTOR_COLUMNS))


def factor_top_levels(spark, sf):
    """The five most frequent levels of factors with few and with very many levels."""
    return heavy.top_levels(fx.personas(spark, sf), [*specs.FACTOR_COLUMNS, "P6800", "l_suppkey", "l_partkey", "id"], 5)


def poverty_by_lookup(spark, sf):
    """Poverty share by department with the names of the inline department table."""
    look = io.lookup_table(spark, specs.DEPARTAMENTOS, "code int, Nombre_Depto string")
    out = describe.ordered_group_shares(hogares_full(spark, sf, "train"), "Depto", "Pobre", 1, lookup=look,
                                        lookup_key="code", name_col="Nombre_Depto")
    return rounded(out)


def correlation_pairs(spark, sf):
    full = hogares_full(spark, sf, "train")
    return rounded(profile.correlation_pairs(full, profile.numeric_columns(full, exclude=["id"])))


def quartiles_lineitem(spark, sf):
    return rounded(ordered.exact_quantiles(fx.table(spark, sf, "lineitem"),
                                           list(fx.LINEITEM_NUMERIC), [0.25, 0.5, 0.75]))


def fill_missing(spark, sf):
    return rounded(hogares_full(spark, sf, "train").select("id", *specs.FILL_ZERO))


# ---------------------------------------------------------------- evaluation (fixed scorers)
# Two coefficient vectors used to check scoring and evaluation against SQL.
SCORER_A = ({"Nper": 0.6, "P5130": 0.001}, -4.0)
SCORER_B = ({"Nper": 0.5, "Lp": -0.0001}, -2.5)


def _scored(spark, sf, scorer=SCORER_A, side="train"):
    full = hogares_full(spark, sf, side)
    coefs, b0 = scorer
    s = full.select("id", "Pobre", models.linear_score(coefs, b0).alias("score"))
    return s.withColumn("pred", threshold("score", specs.THRESHOLD))


def linear_score(spark, sf):
    return rounded(_scored(spark, sf).select("id", "Pobre", "score"))


def threshold_predictions(spark, sf):
    return rounded(_scored(spark, sf))


def confusion(spark, sf):
    return evaluate.confusion(_scored(spark, sf), "pred", "Pobre", 1)


def binary_metrics(spark, sf):
    return rounded(evaluate.binary_metrics(_scored(spark, sf), "pred", "Pobre", 1))


def roc_curve(spark, sf):
    return rounded(evaluate.roc_curve(_scored(spark, sf), "score", "Pobre", 1))


def auc(spark, sf):
    return rounded(evaluate.auc(_scored(spark, sf), "score", "Pobre", 1))


def metrics_by_fold(spark, sf):
    s = sampling.kfold(_scored(spark, sf), "Pobre", specs.FOREST_FOLDS, specs.SEED)
    return rounded(evaluate.five_stats(s, "score", "pred", "Pobre", 1, groups=["fold"]))


def model_comparison(spark, sf):
    a = evaluate.binary_metrics(_scored(spark, sf, SCORER_A), "pred", "Pobre", 1)
    b = evaluate.binary_metrics(_scored(spark, sf, SCORER_B), "pred", "Pobre", 1)
    extra = {("reported", "Kaggle"): specs.EXTERNAL_SCORE}
    return rounded(evaluate.comparison_table({"scorer_a": a, "scorer_b": b}, extra))


# ---------------------------------------------------------------- sampling
def stratified_split(spark, sf):
    h = fx.hogares(spark, sf, "train").select("id", "Pobre")
    return sampling.partition_split(h, "Pobre", specs.TRAIN_SHARE, specs.SEED)


def random_split(spark, sf):
    h = fx.hogares(spark, sf, "train").select("id", "Pobre")
    return sampling.partition_split(h, "Pobre", specs.TRAIN_SHARE, specs.SEED, stratify=False)


def kfold(spark, sf):
    h = fx.hogares(spark, sf, "train").select("id", "Pobre")
    return sampling.kfold(h, "Pobre", specs.LINEAR_FOLDS, specs.SEED)


def class_weights(spark, sf):
    h = fx.hogares(spark, sf, "train").select("id", "Pobre")
    return rounded(sampling.class_weights(h, "Pobre", fixed={1: 0.79, 0: 0.21}))


# ---------------------------------------------------------------- recodes and densities
def dummies(spark, sf):
    p = fx.personas(spark, sf).select("id", *specs.FACTOR_COLUMNS)
    levels = dummy_levels(p, specs.FACTOR_COLUMNS)
    return add_dummies(p, levels)


def _density(df, x, groups=(), log10=False):
    out = describe.kde(df, x, groups, 512, log10)
    return rounded(out, skip=["density"]).withColumn("density", F.round("density", 12))


def income_density(spark, sf):
    h = fx.hogares(spark, sf, "train").where(F.col("Pobre") == 0)
    return _density(h, "Ingpcug")


def income_density_total_poor(spark, sf):
    h = fx.hogares(spark, sf, "train").where(F.col("Pobre") == 1)
    return _density(h, "Ingtotug")


def income_density_log10(spark, sf):
    h = fx.hogares(spark, sf, "train").where(F.col("Pobre") == 0)
    return _density(h, "Ingpcug", log10=True)


def income_density_log10_by_class(spark, sf):
    h = fx.hogares(spark, sf, "train").where(F.col("Pobre").isin(0, 1))
    return _density(h, "Ingpcug", ["Pobre"], log10=True)


# ---------------------------------------------------------------- models
# Penalties at which the fitted linear models are checked (KKT).
KKT_FITS = {"logit_kkt": (0.0, 0.0), "ridge_kkt": (0.01, 0.0), "lasso_kkt": (0.01, 1.0),
            "elastic_net_kkt": (0.01, 0.5)}


def model_input(spark, sf, side="train"):
    """The whole household table; missing predictors take the median of the training rows."""
    cols = sorted({*specs.LINEAR_PREDICTORS, *specs.FOREST_TRIAL_PREDICTORS, *specs.FOREST_FINAL_PREDICTORS})

    def build():
        values = models.median_values(hogares_full(spark, sf, "train"), cols)
        return models.impute(hogares_full(spark, sf, side), {c: values.get(c) for c in cols})

    return _stored(spark, sf, f"model_input_{side}", build)


def _kkt(name):
    def q(spark, sf):
        reg, alpha = KKT_FITS[name]
        X = specs.LINEAR_PREDICTORS
        d = model_input(spark, sf)
        m = models.fit_logistic(d, X, specs.LABEL, reg, alpha)
        return models.kkt_check(d, m, X, specs.LABEL, reg, alpha).select(
            "term", "ok", F.lit(d.count()).alias("n_rows"))
    q.__name__ = name
    return q


logit_kkt = _kkt("logit_kkt")
ridge_kkt = _kkt("ridge_kkt")
lasso_kkt = _kkt("lasso_kkt")
elastic_net_kkt = _kkt("elastic_net_kkt")


def lambda_max(spark, sf):
    d = model_input(spark, sf)
    alphas = [a for a in specs.ENET_ALPHAS if a > 0]
    return rounded(models.lambda_max(d, specs.LINEAR_PREDICTORS, specs.LABEL, alphas))


def null_gradients(spark, sf):
    return rounded(models.null_gradients(model_input(spark, sf), specs.LINEAR_PREDICTORS, specs.LABEL))


def scaled_features(spark, sf):
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    X = specs.LINEAR_PREDICTORS
    d = model_input(spark, sf)
    v = VectorAssembler(inputCols=X, outputCol="_raw").transform(d)
    sc = StandardScaler(inputCol="_raw", outputCol="_z", withMean=True, withStd=True).fit(v)
    z = sc.transform(v).withColumn("_a", vector_to_array("_z"))
    return rounded(z.select("id", *[F.col("_a")[i].alias(c) for i, c in enumerate(X)]))


def pruned_grid(spark, sf):
    """Elastic-net grid with the candidates that need no fit (lambda >= lambda_max)."""
    d = model_input(spark, sf)
    lm = models.lambda_max(d, specs.LINEAR_PREDICTORS, specs.LABEL,
                           [a for a in specs.ENET_ALPHAS if a > 0])
    grid = spark.createDataFrame([(float(a), float(l)) for a in specs.ENET_ALPHAS
                                  for l in specs.ENET_LAMBDAS], "alpha double, reg double")
    g = grid.join(F.broadcast(lm), on="alpha", how="left")
    return rounded(g.withColumn("null_model", F.coalesce(F.col("reg") >= F.col("lambda_max"), F.lit(False)))
                   .select("alpha", "reg", "null_model"))


def output_name(spark, sf):
    """File name of a prediction file from a parameter row (``.`` -> ``_``, 4 decimals)."""
    lm = models.lambda_max(model_input(spark, sf), specs.LINEAR_PREDICTORS, specs.LABEL,
                           [a for a in specs.ENET_ALPHAS if a > 0])
    return lm.select("alpha", io.output_name("Ridge", F.col("lambda_max"), F.col("alpha")).alias("name"))


def coefficients(spark, sf):
    """Ridge coefficients: per term whether the fit is optimal and both forms (scaled and
    original units) give every row the same linear predictor."""
    X, d = specs.LINEAR_PREDICTORS, model_input(spark, sf)
    m = models.fit_logistic(d, X, specs.LABEL, 0.01, 0.0)
    table = models.coefficient_table(m, X)
    mean, std = models.scaler_stats(m)
    raw = models.linear_predictor({t: r for t, _, r in table[1:]}, table[0][2])
    z = F.lit(table[0][1])
    for (_, b, _), c in zip(table[1:], models.scaled_columns(X, mean, std)):
        z = z + F.lit(b) * c
    gap, n = d.agg(F.max(F.abs(z - raw)), F.count("*")).first()
    kkt = models.kkt_check(d, m, X, specs.LABEL, 0.01, 0.0)
    return kkt.select("term", (F.col("ok") & F.lit(gap < 1e-8)).alias("ok"), F.lit(n).alias("n_rows"))


def glm_summary(spark, sf):
    """Per term of the unpenalised fit: the score equation is zero, the standard error is that
    of the Fisher information, z is their ratio, and AIC is deviance + 2 p."""
    import numpy as np

    X, d = specs.LINEAR_PREDICTORS, model_input(spark, sf)
    rows = models.glm_summary(d, X, specs.LABEL).collect()
    stats = d.agg(*[f(F.col(c).cast("double")) for c in X for f in (F.avg, F.stddev_samp)]).first()
    zs = [F.lit(1.0)] + [(F.col(c).cast("double") - F.lit(stats[2 * i])) / F.lit(stats[2 * i + 1] or 1.0)
                         for i, c in enumerate(X)]
    eta = F.lit(0.0)
    for r, c in zip(rows, zs):
        eta = eta + F.lit(r.estimate) * c
    w = F.col("p") * (F.lit(1.0) - F.col("p"))
    k = len(zs)
    v = d.select(F.array(*zs).alias("z"), (F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))).alias("p"),
                 F.col(specs.LABEL).cast("double").alias("y"))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = v.agg(F.count("*"), F.sum(F.lit(-2.0) * F.log(F.when(F.col("y") == 1, F.col("p")).otherwise(F.lit(1.0) - F.col("p")))),
                 *[F.avg(F.col("z")[i] * (F.col("p") - F.col("y"))) for i in range(k)],
                 *[F.sum(w * F.col("z")[i] * F.col("z")[j]) for i, j in pairs]).first()
    info = np.zeros((k, k))
    for (i, j), x in zip(pairs, sums[2 + k:]):
        info[i, j] = info[j, i] = x
    se = np.sqrt(np.diag(np.linalg.inv(info)))
    out = []
    for i, r in enumerate(rows):
        ok = (abs(sums[2 + i]) < 1e-6 and abs(r.std_error - se[i]) < 1e-4 * se[i]
              and abs(r.z_value - r.estimate / r.std_error) < 1e-6 * max(1.0, abs(r.z_value))
              and abs(r.deviance - sums[1]) < 1e-6 * sums[1] and abs(r.aic - r.deviance - 2 * k) < 1e-6
              and 0 <= r.p_value <= 1 and r.deviance <= r.null_deviance)
        out.append((r.term, bool(ok), sums[0]))
    return spark.createDataFrame(out, "term string, ok boolean, n_rows long")


# ---------------------------------------------------------------- tuning over the full grids
def _grid(name):
    return {"ridge": lambda: models.expand_grid(alpha=[0.0], reg=specs.RIDGE_LAMBDAS),
            "lasso": lambda: models.expand_grid(alpha=[1.0], reg=specs.LASSO_LAMBDAS),
            "elastic_net": lambda: models.expand_grid(alpha=specs.ENET_ALPHAS, reg=specs.ENET_LAMBDAS)}[name]()


def _folded(spark, sf):
    """The linear models' input with its folds, dealt once for all of their grids."""
    X = specs.LINEAR_PREDICTORS
    return _stored(spark, sf, "linear_folds", lambda: sampling.kfold(
        model_input(spark, sf).select("id", specs.LABEL, *X), specs.LABEL, specs.LINEAR_FOLDS, specs.SEED))


def _tuned(spark, sf, name):
    d = _folded(spark, sf)
    cands = _grid(name)
    return linear_tuning.cross_validate_linear(d, specs.LINEAR_PREDICTORS, specs.LABEL, "fold", cands), cands


def _tuning(name):
    def q(spark, sf):
        """Every candidate of the grid: folds, folds in which it equals the intercept-only
        model, and whether its fits are optimal and its fold means are proper rates."""
        cv, cands = _tuned(spark, sf, name)
        bad = {c for (_, c), gap in linear_tuning.recheck(cv, cands).items() if not gap < 1e-6}
        res = models.tuning_results(cv, cands)
        per = cv.alias.groupBy("candidate").agg(
            F.count("*").alias("n_folds"), F.count_if(F.col("rep") == -1).alias("n_null"))
        proper = F.lit(True)
        for c in ("ROC", "Sens", "Spec", "Accuracy"):
            proper = proper & F.coalesce(F.col(c).between(0, 1), F.lit(False))
        return rounded(res.join(per, "candidate").select(
            "alpha", "reg", "n_folds", "n_null",
            (proper & ~F.col("candidate").isin(sorted(bad)) if bad else proper).alias("ok")))
    q.__name__ = f"{name}_tuning"
    return q


ridge_tuning = _tuning("ridge")
tuning_curve = _tuning("lasso")
elastic_net_tuning = _tuning("elastic_net")


def best_candidate(spark, sf):
    """Per method: grid size and whether the chosen candidate is the one with the highest mean
    accuracy (ties: larger penalty, then smaller alpha), the means taken again from the
    confusion cells of every fold."""
    out = []
    for name in ("ridge", "lasso", "elastic_net"):
        cv, cands = _tuned(spark, sf, name)
        best = models.best_candidate(models.tuning_results(cv, cands))
        acc = {m: (r["tp"] + r["tn"]) / (r["tp"] + r["fp"] + r["fn"] + r["tn"]) for m, r in cv.rates.items()}
        mean: dict = {}
        for f, i, rep in cv.alias.collect():
            mean.setdefault(i, []).append(acc[f, rep])
        mean = {i: sum(v) / len(v) for i, v in mean.items()}
        top = max(mean.values())
        rank = max((cands[i]["reg"], -cands[i]["alpha"]) for i, v in mean.items() if v > top - 1e-12)
        out.append((name, len(cands), abs(best["Accuracy"] - top) < 1e-9 and (best["reg"], -best["alpha"]) == rank))
    return spark.createDataFrame(out, "model string, n_candidates long, ok boolean")


def oof_metrics(spark, sf):
    """Per fold of the lasso run: rows scored, models that scored them, and whether every
    model scored every row once; the held-out rows of the best candidate are made and must
    have the counted rates."""
    cv, cands = _tuned(spark, sf, "lasso")
    best = models.best_candidate(models.tuning_results(cv, cands))["candidate"]
    rep = {f: r for f, i, r in cv.alias.where(F.col("candidate") == best).collect()}
    own = {r.fold: r for r in evaluate.five_stats(cv.held_out(best), "prob", "pred", specs.LABEL, 1, ["fold"])
           .join(cv.held_out(best).groupBy("fold").agg(
               F.count("*").alias("n"), F.count_distinct("id").alias("ids"),
               F.count_if(F.col("prob").between(0, 1)).alias("fine")), "fold").collect()}
    out = []
    for f in sorted(own):
        sizes = {sum(r[k] for k in ("tp", "fp", "fn", "tn")) for (g, _), r in cv.rates.items() if g == f}
        r, o = cv.rates[f, rep[f]], own[f]
        same = abs(r["auc"] - o.ROC) < 1e-9 and abs((r["tp"] + r["tn"]) / o.n - o.Accuracy) < 1e-12
        out.append((f, max(sizes), sum(g == f for g, _ in cv.rates), len(sizes) == 1 and o.n == o.ids == o.fine and same))
    return spark.createDataFrame(out, "fold int, n_rows long, n_models long, ok boolean")


def _fitted(spark, sf):
    """The four linear models, tuned over their full grids and refitted on all training
    households (once per application and input): name -> (best candidate, model)."""
    memo = (spark.sparkContext.applicationId, sf, "linear", _inputs(spark, sf))
    if memo not in _TUNED:
        X, d, out = specs.LINEAR_PREDICTORS, model_input(spark, sf), {}
        for name in ("logit", "ridge", "lasso", "elastic_net"):
            best = {"reg": 0.0, "alpha": 0.0}
            if name != "logit":
                cv, cands = _tuned(spark, sf, name)
                best = models.best_candidate(models.tuning_results(cv, cands))
            out[name] = best, models.fit_logistic(d, X, specs.LABEL, best["reg"], best["alpha"])
        _TUNED[memo] = out
    return _TUNED[memo]


def _fitted_scores(spark, sf, name, side="train"):
    _, m = _fitted(spark, sf)[name]
    d = model_input(spark, sf, side)
    keep = [specs.LABEL] if side == "train" else []
    scored = d.select("id", *keep, models.model_score_column(m).alias("prob"))
    return scored.withColumn("pred", threshold("prob", specs.THRESHOLD))


def fitted_models(spark, sf):
    """Per fitted linear model: confusion cells add up to the households, rates follow from the
    cells, and the fit separates the classes no worse than chance."""
    out = []
    for name in _fitted(spark, sf):
        scored = _fitted_scores(spark, sf, name)
        r = evaluate.binary_metrics(scored, "pred", specs.LABEL, 1).first()
        a = evaluate.auc(scored, "prob", specs.LABEL, 1).first()["auc"]
        n = r.tp + r.fp + r.fn + r.tn
        ok = abs(r.Accuracy - (r.tp + r.tn) / n) < 1e-12 and a >= 0.5 - 1e-9
        out.append((name, n, r.tp + r.fn, bool(ok)))
    return spark.createDataFrame(out, "model string, n_rows long, n_pos long, ok boolean")


def fitted_model_metrics(spark, sf):
    """The comparison table of the fitted linear models as values (model, metric, value), with
    their AUC, chosen penalties and the reported score."""
    frames, more = {}, {("reported", "Kaggle"): specs.EXTERNAL_SCORE}
    for name, (best, _) in _fitted(spark, sf).items():
        scored = _fitted_scores(spark, sf, name)
        frames[name] = evaluate.binary_metrics(scored, "pred", specs.LABEL, 1)
        more |= {(name, "AUC"): evaluate.auc(scored, "prob", specs.LABEL, 1).first()["auc"],
                 (name, "lambda"): best["reg"], (name, "alpha"): best["alpha"]}
    return evaluate.comparison_table(frames, more)


def fitted_predictions(spark, sf):
    """Test predictions of the fitted ridge model, written under the survey's file name and read
    back (id, pobre)."""
    best, _ = _fitted(spark, sf)["ridge"]
    name = spark.range(1).select(io.output_name("Ridge", F.lit(best["reg"]), F.lit(best["alpha"]))).first()[0]
    pred = _fitted_scores(spark, sf, "ridge", "test").select("id", F.col("pred").alias("pobre"))
    return io.read_predictions(spark, io.write_predictions(pred, f"{io.scratch(spark, 'ridge')}/{name}"))


def _forest_split(spark, sf):
    return sampling.partition_split(model_input(spark, sf), specs.LABEL, specs.TRAIN_SHARE, specs.SEED)


_TUNED: dict = {}


def _trial_forest(spark, sf):
    """The trial forest, tuned over its whole grid with SMOTE in the training folds and refitted
    with the best candidate (once per application and input): CV result, best, model, hold-out."""
    memo = (spark.sparkContext.applicationId, sf, _inputs(spark, sf))
    if memo not in _TUNED:
        d, X, y = _forest_split(spark, sf), specs.FOREST_TRIAL_PREDICTORS, specs.LABEL
        train = sampling.kfold(d.where("is_train = 1"), y, specs.FOREST_FOLDS, specs.SEED)
        cv, _, best, model = models.tune_forest(train, X, y, specs.FOREST_TRIAL_GRID, specs.FOREST_TRIAL_TREES, seed=specs.SEED)
        hold = io.read_store(spark, io.write_store(d.where("is_train = 0"), io.scratch(spark, "holdout")))
        _TUNED[memo] = cv, best, model, hold
    return _TUNED[memo]


def forest_importance(spark, sf):
    """Per predictor of the tuned trial forest whether its importance is a share of 1, its
    scaled form follows, and the table is ranked."""
    _, _, m, _ = _trial_forest(spark, sf)
    rows = models.importance_table(m, specs.FOREST_TRIAL_PREDICTORS, spark).collect()
    imp = [r.importance for r in rows]
    whole = abs(sum(imp) - 1) < 1e-9 and imp == sorted(imp, reverse=True)
    return spark.createDataFrame([(r.variable, bool(whole and r.importance >= 0 and 0 <= r.scaled <= 100))
                                  for r in rows], "variable string, ok boolean")


def forest_top_predictors(spark, sf):
    """The 20 most important predictors of the tuned trial forest: per rank whether its
    predictor is one of the model's, named once, and no other one is more important."""
    _, _, m, _ = _trial_forest(spark, sf)
    X = specs.FOREST_TRIAL_PREDICTORS
    imp = dict(zip(X, m.stages[-1].featureImportances.toArray()))
    rows = models.importance_table(m, X, spark, top=20).collect()
    names = [r.variable for r in rows]
    out = [(i + 1, r.variable in imp and names.count(r.variable) == 1 and abs(imp[r.variable] - r.importance) < 1e-12
            and all(imp[o] <= r.importance for o in X if o not in names[:i + 1])) for i, r in enumerate(rows)]
    return spark.createDataFrame([(i, bool(ok)) for i, ok in out], "rank long, ok boolean")


def forest_holdout_metrics(spark, sf):
    """Hold-out households and poor among them as the tuned trial forest's confusion cells count
    them, and whether its ROC beats chance and ends in its corners."""
    _, _, m, hold = _trial_forest(spark, sf)
    p = models.prob_of_positive(m.transform(hold.withColumn(specs.LABEL, F.col(specs.LABEL).cast("double"))))
    p = p.withColumn("pred", F.col("prediction").cast("int")).withColumn(specs.LABEL, F.col(specs.LABEL).cast("int"))
    met = evaluate.binary_metrics(p, "pred", specs.LABEL, 1).first()
    a = evaluate.auc(p, "prob", specs.LABEL, 1).first()["auc"]
    roc = evaluate.roc_curve(p, "prob", specs.LABEL, 1).orderBy("fpr", "tpr").collect()
    area = sum((y.fpr - x.fpr) * (x.tpr + y.tpr) / 2 for x, y in zip(roc, roc[1:]))
    ok = a > 0.5 and (roc[0].fpr, roc[0].tpr, roc[-1].fpr, roc[-1].tpr) == (0, 0, 1, 1) and abs(area - a) < 1e-9
    return spark.createDataFrame([(met.tp + met.fp + met.fn + met.tn, met.tp + met.fn, bool(ok))],
                                 "n_rows long, n_pos long, ok boolean")


def forest_predictions(spark, sf):
    """Test households as the tuned trial forest predicts them, written as a prediction file and
    read back: every household once, with the class that has the larger probability."""
    _, _, m, _ = _trial_forest(spark, sf)
    p = models.prob_of_positive(m.transform(model_input(spark, sf, "test")))
    path = io.write_predictions(p.select("id", F.col("prediction").cast("int").alias("pobre")), io.scratch(spark, "predicciones_test"))
    back = io.read_predictions(spark, path)
    return back.join(p.select("id", "prob"), "id").select(
        "id", (F.col("pobre") == (F.col("prob") > 0.5).cast("int")).alias("ok"))


def forest_trial_tuning(spark, sf):
    """The trial forest's whole grid over its folds, SMOTE in the training folds: held-out rows
    per candidate, all of them real households (none synthetic) that are scored once, and the
    rows that a candidate's fits saw (both classes as large as the larger one)."""
    cv, best, _, _ = _trial_forest(spark, sf)
    n_train = 0
    for f in range(specs.FOREST_FOLDS):
        n_train += cv.ledger.table(f"train/fold={f}", None).count()
    cands = models.expand_grid(**specs.FOREST_TRIAL_GRID)
    per = cv.oof.groupBy("candidate").agg(
        F.count("*").alias("n_rows"), F.count_distinct("fold").alias("n_folds"), F.count_distinct("id").alias("_ids"),
        F.min("id").alias("_low"), F.count_if(F.col("prob").between(0, 1)).alias("_fine"))
    grid = spark.createDataFrame([(i, c["mtry"], c["min_node_size"]) for i, c in enumerate(cands)],
                                 "candidate int, mtry int, min_node_size int")
    return per.join(grid, "candidate").select(
        "mtry", "min_node_size", "n_rows", "n_folds", F.lit(n_train).cast("long").alias("n_train"),
        ((F.col("n_rows") == F.col("_ids")) & (F.col("n_rows") == F.col("_fine")) & (F.col("_low") >= 0)).alias("ok"))


# ---------------------------------------------------------------- sources and sinks
def prediction_sink(spark, sf):
    """Score the test households, write ``id,pobre`` CSV to shared storage, read it back."""
    coefs, b0 = SCORER_A
    test = hogares_full(spark, sf, "test")
    pred = test.select("id", threshold(models.linear_score(coefs, b0), specs.THRESHOLD).alias("pobre"))
    path = io.write_predictions(pred, io.scratch(spark, "predictions"))
    return io.read_predictions(spark, path)


def sink_confirmation(spark, sf):
    """Predictions written and confirmed from what is read back: rows written, poor among them,
    whether the sink is confirmed, and whether it is refused against a table with a row more."""
    coefs, b0 = SCORER_A
    pred = hogares_full(spark, sf, "test").select(
        "id", threshold(models.linear_score(coefs, b0), specs.THRESHOLD).alias("pobre"))
    path = io.write_predictions(pred, io.scratch(spark, "confirmed"))
    more = pred.unionByName(spark.range(1).select((-F.col("id") - 1).alias("id"), F.lit(1).alias("pobre")))
    ok, refused = io.confirm_sink(spark, path, pred), not io.confirm_sink(spark, path, more)
    return io.read_predictions(spark, path).agg(
        F.count("id").alias("n_rows"), F.sum("pobre").cast("long").alias("n_poor")).select(
        "*", F.lit(ok).alias("confirmed"), F.lit(refused).alias("refused"))


def column_search(spark, sf):
    """Person columns whose name a pattern finds (the survey's search for P6100 and P6920, and
    the codes of block 75), with their known values, levels and total; one wide pass."""
    p = fx.personas(spark, sf)
    found = [(pattern, c) for pattern in ("P6100|P6920", "^P75\\d\\d") for c in profile.columns_matching(p, pattern)]
    cols = sorted({c for _, c in found})
    sums = p.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in
                   (("k", F.count), ("d", F.count_distinct), ("s", lambda x: F.sum(F.col(x).cast("long"))))])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(pattern).alias("pattern"), F.lit(c).alias("variable"), F.col(f"k_{c}").alias("n_known"),
                 F.col(f"d_{c}").alias("n_levels"), F.col(f"s_{c}").alias("total")) for pattern, c in found])))


def reduce_joins(spark, sf):
    """Test households left-joined with a list of per-household person tables, one by one
    (``Reduce`` over ``merge(all.x = TRUE)``), every table checked to have one row per key."""
    p = fx.personas(spark, sf)
    tables = [p.groupBy("id").agg(F.count(F.lit(1)).alias("n_persons")),
              p.where("P6920 = 1").groupBy("id").agg(F.count(F.lit(1)).alias("n_pension")),
              p.where("P6040 < 18").groupBy("id").agg(F.max("P6040").alias("oldest_minor")),
              p.where("P6100 IS NULL").groupBy("id").agg(F.min("P6040").alias("youngest_uncovered"))]
    return rollup.left_join_all(hogares_full(spark, sf, "test").select("id", "Nper"), tables, "id")


def csv_scan(spark, sf):
    """CSV round trip of the test households with an explicit schema."""
    h = fx.hogares(spark, sf, "test")
    path = io.scratch(spark, "hogares_csv")
    h.write.option("header", True).csv(path)
    schema = ", ".join(f"{n} {t}" for n, t in h.dtypes)
    return rounded(io.read_csv(spark, path, schema))


def store_roundtrip(spark, sf):
    """Parquet store of the training household table (``saveRDS``/``readRDS``)."""
    path = io.write_store(build_hogares_full(spark, sf, "train"), io.scratch(spark, "hogares_full"))
    return rounded(io.read_store(spark, path))


def preview_predictions(spark, sf):
    coefs, b0 = SCORER_A
    test = hogares_full(spark, sf, "test")
    pred = test.select("id", threshold(models.linear_score(coefs, b0), specs.THRESHOLD).alias("pobre"))
    return io.preview(pred)


# ---------------------------------------------------------------- oversampling
def smote_exact(spark, sf):
    """SMOTE rows that balance the training households (final forest predictors)."""
    X = specs.FOREST_FINAL_PREDICTORS
    d = model_input(spark, sf).select("id", specs.LABEL, *X)
    return rounded(sampling.smote(d, specs.LABEL, X, "id", 1, k=5, seed=specs.SEED))


def knn_minority(spark, sf):
    """Exact 5 nearest minority neighbours of every minority household."""
    from hhlens.operators.neighbors import knn_exact

    X = specs.FOREST_FINAL_PREDICTORS
    d = model_input(spark, sf).where(F.col(specs.LABEL) == 1).select("id", *X)
    return knn_exact(d, "id", X, 5).select("id", "nn_key", "nn_rank")


def knn_minority_lsh(spark, sf):
    """Approximate 5 nearest minority neighbours (tables derived for a recall of 0.9)."""
    from hhlens.operators.neighbors_lsh import knn_lsh

    X = specs.FOREST_FINAL_PREDICTORS
    d = model_input(spark, sf).where(F.col(specs.LABEL) == 1).select("id", *X)
    return knn_lsh(d, "id", X, 5, recall=0.9, seed=specs.SEED).select("id", "nn_key", "nn_rank")
