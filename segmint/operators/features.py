"""Leak-free feature pipeline as a Spark ML Estimator / Model pair.

``SegmentFeatures.fit(train)`` learns the two high-value thresholds (exact
q75), the one-hot vocabulary of every categorical column and the scaler moments
(mean, population std) of the numerical columns. Moments are one aggregate;
the first pass of the exact quantiles is the same job. The vocabulary is
fetched up to a bound, and beyond it is an error (``operators/sparse.py`` encodes
any number of categories).

``SegmentFeaturesModel.transform(df)`` is one ``select``: impute, engineer,
one-hot from the FITTED vocabulary (so a one-row frame gets the same columns
and values as a batch), binary encoding, scaling and alignment to the fitted
feature order. Catalyst collapses it into a single whole-stage-codegen
projection; nothing shuffles.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmint.operators.quantiles import quantile_row, quantile_values
from segmint.spec import DEFAULT_SPEC, SegmentSpec

#: Of saved estimators and models.
FORMAT_VERSION = 1

ENGINEERED = ["avg_monthly_spend", "tenure_group", "service_diversity", "contract_commitment", "auto_payment",
              "high_value_flag", "family_status"]


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _col(c: str) -> Column:
    return F.col(_q(c))


# ---------------------------------------------------------------------------
# Row-level columns (no fitted state)
# ---------------------------------------------------------------------------

def imputed_total(spec: SegmentSpec = DEFAULT_SPEC) -> Column:
    """Missing total or zero tenure -> the monthly charge."""
    t = _col(spec.total).cast("double")
    miss = t.isNull() | F.isnan(t) | (_col(spec.tenure) == 0)
    return F.when(miss, _col(spec.monthly).cast("double")).otherwise(t)


def impute_total_charges(df: DataFrame, spec: SegmentSpec = DEFAULT_SPEC) -> DataFrame:
    return df.withColumn(spec.total, imputed_total(spec))


def avg_monthly_spend(total: Column, tenure: Column) -> Column:
    return total / (tenure + F.lit(1))


def tenure_group(tenure: Column, edges=(0, 12, 48, 72)) -> Column:
    """[e0, e1] -> 0, (e1, e2] -> 1, (e2, e3] -> 2, ...; outside -> null.
    (``Bucketizer`` is left-closed, so it is not used.)"""
    out = None
    for i in range(len(edges) - 1):
        cond = (tenure >= edges[0]) & (tenure <= edges[1]) if i == 0 else (tenure > edges[i]) & (tenure <= edges[i + 1])
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    return out


def service_diversity(services, positive: str = "Yes") -> Column:
    return sum((F.when(_col(c) == positive, 1).otherwise(0) for c in services), F.lit(0))


def contract_commitment(contract: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(contract == k, F.lit(v)) if out is None else out.when(contract == k, F.lit(v))
    return out


def auto_payment(payment: Column, methods) -> Column:
    return F.when(payment.isin(*methods), 1).otherwise(0)


def high_value_flag(monthly: Column, tenure: Column, t_monthly: float, t_tenure: float) -> Column:
    """Strict on both thresholds; a null comparison falls to 0."""
    return F.when((monthly > F.lit(t_monthly)) & (tenure > F.lit(t_tenure)), 1).otherwise(0)


def family_status(partner: Column, dependents: Column, positive: str = "Yes") -> Column:
    return (F.when(partner == positive, 1).otherwise(0) + 2 * F.when(dependents == positive, 1).otherwise(0))


def encode_yes_no(c: Column) -> Column:
    """Yes -> 1, No -> 0, anything else -> null."""
    return F.when(c == "Yes", 1).when(c == "No", 0)


def engineer_features(df: DataFrame, t_monthly: float, t_tenure: float,
                      spec: SegmentSpec = DEFAULT_SPEC) -> DataFrame:
    """Impute, then the seven engineered columns (Contract is replaced by its
    ordinal)."""
    total = imputed_total(spec)
    ten = _col(spec.tenure)
    return df.withColumn(spec.total, total).select(
        *[_col(c) for c in df.columns if c != spec.contract],
        avg_monthly_spend(_col(spec.total), ten).alias("avg_monthly_spend"),
        tenure_group(ten, spec.tenure_edges).alias("tenure_group"),
        service_diversity(spec.services).alias("service_diversity"),
        contract_commitment(_col(spec.contract), spec.contract_ordinal).alias("contract_commitment"),
        auto_payment(_col(spec.payment), spec.auto_payment_methods).alias("auto_payment"),
        high_value_flag(_col(spec.monthly), ten, t_monthly, t_tenure).alias("high_value_flag"),
        family_status(_col(spec.partner), _col(spec.dependents)).alias("family_status"),
    )


def one_hot_columns(vocab: dict[str, list[str]]) -> list[tuple[str, str, str]]:
    """(source column, value, dummy name) for every value but the first of
    each sorted vocabulary, named ``<column>_<value>``."""
    out = []
    for c, values in vocab.items():
        for v in values[1:]:
            out.append((c, v, f"{c}_{v}"))
    return out


def one_hot_drop_first(df: DataFrame, vocab: dict[str, list[str]]) -> DataFrame:
    """Dummies from a fitted vocabulary; unseen values and nulls give all
    zeros. The source columns are dropped."""
    dummies = [F.when(_col(c) == F.lit(v), 1).otherwise(0).alias(name) for c, v, name in one_hot_columns(vocab)]
    return df.select(*[_col(c) for c in df.columns if c not in vocab], *dummies)


def encode_binary(df: DataFrame, cols) -> DataFrame:
    return df.select(*[encode_yes_no(_col(c)).alias(c) if c in cols else _col(c) for c in df.columns])


def apply_scaler(df: DataFrame, moments: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / std with fitted literals; std 0 divides by 1."""
    out = []
    for c in df.columns:
        if c in moments:
            m, s = moments[c]
            s = s if s else 1.0
            out.append(((_col(c).cast("double") - F.lit(m)) / F.lit(s)).alias(c))
        else:
            out.append(_col(c))
    return df.select(*out)


def align_columns(df: DataFrame, feature_names: list[str], keep=("customerID", "Churn")) -> DataFrame:
    """Fitted feature order; absent features are 0, extra columns dropped,
    id and target kept at the end when present."""
    have = set(df.columns)
    cols = [_col(c) if c in have else F.lit(0).alias(c) for c in feature_names]
    cols += [_col(c) for c in keep if c in have]
    return df.select(*cols)


# ---------------------------------------------------------------------------
# Fit steps (each is also usable on its own)
# ---------------------------------------------------------------------------

def _quantiles(df: DataFrame, columns: dict[str, Column], qs: list[float], approx: bool, accuracy: int) -> DataFrame:
    """One row of arrays, exact or (``approx``) by ``percentile_approx``."""
    if approx:
        return df.agg(*[F.percentile_approx(c.cast("double"), F.array(*map(F.lit, qs)), accuracy).alias(n) for n, c in columns.items()])
    return quantile_row(df, columns, qs)


def fit_high_value_thresholds(df: DataFrame, spec: SegmentSpec = DEFAULT_SPEC, q: float = 0.75,
                              approx: bool = False, accuracy: int = 100000) -> DataFrame:
    """One row (monthly_threshold, tenure_threshold): linear-interpolated
    quantiles, nulls skipped."""
    row = _quantiles(df, {"monthly_threshold": _col(spec.monthly), "tenure_threshold": _col(spec.tenure)}, [q], approx, accuracy)
    return row.select(*[F.col(c)[0].alias(c) for c in row.columns])


def vocabulary_rows(df: DataFrame, cols) -> DataFrame:
    """(column, value): the distinct non-null values, one row each."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _col(c).cast("string").alias("value")) for c in cols]))
    return df.select(pairs.alias("p")).select("p.*").where("value is not null").distinct()


def fit_onehot_vocab(df: DataFrame, cols) -> DataFrame:
    """(column, values): sorted distinct non-null values per column. The
    values are made distinct by rows; only the result's arrays hold them."""
    rows = vocabulary_rows(df, cols).groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("values"))
    names = F.explode(F.array(*[F.lit(c) for c in cols])).alias("column")
    all_cols = df.sparkSession.range(1).select(names)
    return all_cols.join(rows, "column", "left").select("column", F.coalesce("values", F.array().cast("array<string>")).alias("values"))


def numeric_frame(df: DataFrame, spec: SegmentSpec = DEFAULT_SPEC) -> DataFrame:
    """The five numerical columns as they are before scaling."""
    total = imputed_total(spec)
    return df.select(_col(spec.tenure).cast("double").alias(spec.tenure),
                     _col(spec.monthly).cast("double").alias(spec.monthly),
                     total.alias(spec.total),
                     avg_monthly_spend(total, _col(spec.tenure)).alias("avg_monthly_spend"),
                     service_diversity(spec.services).cast("double").alias("service_diversity"))


def fit_scaler(df: DataFrame, cols) -> DataFrame:
    """(column, mean, std) with POPULATION std, nulls skipped."""
    one = df.agg(*[F.avg(_col(c).cast("double")).alias(f"m__{c}") for c in cols],
                 *[F.stddev_pop(_col(c).cast("double")).alias(f"s__{c}") for c in cols])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _col(f"m__{c}").alias("mean"),
                                                   _col(f"s__{c}").alias("std")) for c in cols])).alias("r")
                      ).select("r.*")


def iqr_outliers(df: DataFrame, cols, whis: float = 1.5, approx: bool = False, accuracy: int = 100000) -> DataFrame:
    """(column, n_outliers, pct_outliers, lower_bound, upper_bound,
    min_outlier, max_outlier): strict < lower / > upper, percent of ALL rows."""
    quart = _quantiles(df, {f"q_{i}": _col(c) for i, c in enumerate(cols)}, [0.25, 0.75], approx, accuracy)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        x = _col(c).cast("double")
        q1, q3 = F.col(f"q_{i}")[0], F.col(f"q_{i}")[1]
        lo, hi = q1 - whis * (q3 - q1), q3 + whis * (q3 - q1)
        out = (x < lo) | (x > hi)
        aggs += [F.sum(F.when(out, 1).otherwise(0)).cast("long").alias(f"n_{i}"),
                 F.min(F.when(out, x)).alias(f"mn_{i}"), F.max(F.when(out, x)).alias(f"mx_{i}"),
                 F.first(lo).alias(f"lo_{i}"), F.first(hi).alias(f"hi_{i}")]
    one = df.select(*[_col(c) for c in cols]).crossJoin(F.broadcast(quart)).agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n_{i}").alias("n_outliers"),
                     (F.col(f"n_{i}") * 100.0 / F.col("_n")).alias("pct_outliers"),
                     F.col(f"lo_{i}").alias("lower_bound"), F.col(f"hi_{i}").alias("upper_bound"),
                     F.col(f"mn_{i}").alias("min_outlier"), F.col(f"mx_{i}").alias("max_outlier"))
            for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# ---------------------------------------------------------------------------
# Estimator / Model
# ---------------------------------------------------------------------------

class _StateWriter(MLWriter):
    """Spark ML metadata (class, params, uid, ``format_version``) and the state
    as one JSON row beside it."""

    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        one = self.instance
        sc = self.sparkSession.sparkContext
        DefaultParamsWriter.saveMetadata(one, path, sc, {"format_version": FORMAT_VERSION})
        state = {"spec": asdict(one.spec), "state": getattr(one, "state", None), "ignore": list(getattr(one, "ignore", ()))}
        self.sparkSession.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.text(f"{path}/state")


class _StateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        sc = self.sparkSession.sparkContext
        metadata = DefaultParamsReader.loadMetadata(path, sc)
        if metadata["class"].rsplit(".", 1)[-1] != self.cls.__name__:
            raise ValueError(f"{path} holds a {metadata['class']}")
        if metadata.get("format_version") != FORMAT_VERSION:
            raise ValueError(f"{path} has format {metadata.get('format_version')}, not {FORMAT_VERSION}")
        saved = json.loads(self.sparkSession.read.text(f"{path}/state").first()[0])
        one = self.cls._from_saved(saved)
        one._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(one, metadata)
        return one


class _Saved(MLWritable, MLReadable):
    """Saves and loads alone or as a stage of a Pipeline."""

    def write(self) -> MLWriter:
        return _StateWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StateReader(cls)


class _FeatureParams(Params):
    quantile = Param(Params._dummy(), "quantile", "quantile of the high-value thresholds", TypeConverters.toFloat)
    approxQuantiles = Param(Params._dummy(), "approxQuantiles", "thresholds by percentile_approx", TypeConverters.toBoolean)
    maxCategories = Param(Params._dummy(), "maxCategories", "most values of a categorical column", TypeConverters.toInt)


class SegmentFeaturesModel(Model, _FeatureParams, _Saved):
    """Fitted feature pipeline. ``state`` holds thresholds, vocabulary,
    scaler moments and the feature order."""

    def __init__(self, state: dict | None = None, spec: SegmentSpec = DEFAULT_SPEC):
        super().__init__()
        self.state = state
        self.spec = spec

    @classmethod
    def _from_saved(cls, saved: dict) -> "SegmentFeaturesModel":
        return cls(saved["state"], SegmentSpec(**saved["spec"]))

    @property
    def feature_names(self) -> list[str]:
        self._check()
        return list(self.state["feature_names"])

    def _check(self):
        if not self.state:
            raise ValueError("no fitted state: call fit() or load() first")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.transform_with(dataset, keep=(self.spec.id, self.spec.target))

    def transform_with(self, dataset: DataFrame, keep=()) -> DataFrame:
        """Transform and keep the listed pass-through columns at the end."""
        self._check()
        st, spec = self.state, self.spec
        df = engineer_features(dataset, st["monthly_threshold"], st["tenure_threshold"], spec)
        df = one_hot_drop_first(df, {c: v for c, v in st["vocab"].items() if c in df.columns})
        df = encode_binary(df, spec.binary_yes_no)
        df = apply_scaler(df, {c: tuple(m) for c, m in st["moments"].items()})
        return align_columns(df, st["feature_names"], keep=keep)

    def assemble(self, df: DataFrame, out: str = "features", keep=None) -> DataFrame:
        """Transformed frame -> (id, [target,] features vector)."""
        return assemble_features(df, self.feature_names, out, keep or (self.spec.id, self.spec.target))

    def save(self, path: str) -> None:
        """Replaces what is at ``path``."""
        self._check()
        self.write().overwrite().save(path)


class SegmentFeatures(Estimator, _FeatureParams, _Saved):
    """Fits the feature pipeline on training rows."""

    def __init__(self, spec: SegmentSpec = DEFAULT_SPEC, quantile: float = 0.75, approx_quantiles: bool = False,
                 max_categories: int = 10_000, ignore=("split", "cluster_id")):
        super().__init__()
        self.ignore = tuple(ignore)
        self.spec = spec
        self._setDefault(quantile=0.75, approxQuantiles=False, maxCategories=10_000)
        self._set(quantile=quantile, approxQuantiles=approx_quantiles, maxCategories=max_categories)

    @classmethod
    def _from_saved(cls, saved: dict) -> "SegmentFeatures":
        return cls(SegmentSpec(**saved["spec"]), ignore=saved["ignore"])

    def _fit(self, dataset: DataFrame) -> SegmentFeaturesModel:
        spec, q = self.spec, self.getOrDefault("quantile")
        cats = [c for c in spec.categorical if c in dataset.columns]
        num = numeric_frame(dataset, spec).columns
        total = imputed_total(spec)
        numcols = {spec.tenure: _col(spec.tenure).cast("double"), spec.monthly: _col(spec.monthly).cast("double"), spec.total: total,
                   "avg_monthly_spend": avg_monthly_spend(total, _col(spec.tenure)),
                   "service_diversity": service_diversity(spec.services).cast("double")}
        aggs = [F.avg(numcols[c]).alias(f"m__{c}") for c in num] + [F.stddev_pop(numcols[c]).alias(f"s__{c}") for c in num]
        limits = {"monthly_threshold": _col(spec.monthly), "tenure_threshold": _col(spec.tenure)}
        if self.getOrDefault("approxQuantiles"):
            row = dataset.agg(*aggs, *[F.percentile_approx(c.cast("double"), q, 100_000).alias(n) for n, c in limits.items()]).first()
            found = {n: [row[n]] for n in limits}
        else:
            found, row = quantile_values(dataset, limits, [q], also=aggs)
        vocab = fetch_vocabulary(dataset, cats, self.getOrDefault("maxCategories"))
        state = {
            "monthly_threshold": found["monthly_threshold"][0], "tenure_threshold": found["tenure_threshold"][0],
            "vocab": vocab, "moments": {c: [row[f"m__{c}"], row[f"s__{c}"] or 0.0] for c in num},
        }
        state["feature_names"] = fitted_feature_names([c for c in dataset.columns if c not in self.ignore],
                                                      vocab, spec)
        return self._copyValues(SegmentFeaturesModel(state, spec))


def fetch_vocabulary(df: DataFrame, cols: list[str], most: int) -> dict[str, list[str]]:
    """Each column's sorted values; an error if a column has more than
    ``most``, so that at most ``most`` + 1 of each are fetched."""
    nth = F.row_number().over(Window.partitionBy("column").orderBy("value"))  # Spark limits the groups before it shuffles them
    vocab: dict[str, list[str]] = {c: [] for c in cols}
    for r in vocabulary_rows(df, cols).withColumn("nth", nth).where(F.col("nth") <= most + 1).collect():
        vocab[r["column"]].append(r["value"])
    large = [c for c, v in vocab.items() if len(v) > most]
    if large:
        raise ValueError(f"more than max_categories={most} values in {large}; operators/sparse.py encodes them")
    return {c: sorted(v) for c, v in vocab.items()}


def fitted_feature_names(columns: list[str], vocab: dict[str, list[str]], spec: SegmentSpec = DEFAULT_SPEC):
    """Feature order: remaining raw columns in input order, engineered
    columns, then dummies by categorical column; id and target excluded."""
    base = [c for c in columns if c not in (spec.id, spec.target, spec.contract) and c not in vocab]
    return base + ENGINEERED + [name for _, _, name in one_hot_columns(vocab)]


def assemble_features(df: DataFrame, names: list[str], out: str = "features", keep=("customerID", "Churn")
                      ) -> DataFrame:
    """Feature columns -> one vector column (nulls kept as NaN)."""
    va = VectorAssembler(inputCols=list(names), outputCol=out, handleInvalid="keep")
    kept = [c for c in keep if c in df.columns]
    return va.transform(df.select(*kept, *[_col(c) for c in names])).select(*kept, out)


def transform_splits(model: SegmentFeaturesModel, df: DataFrame, split_col: str = "split") -> DataFrame:
    """One transform over the frame with a split column (kept)."""
    return model.transform_with(df, keep=(model.spec.id, model.spec.target, split_col))
