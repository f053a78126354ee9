"""Feature matrix, gradient-boosted trees, scoring and the run log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.scalars import present
from ledgerlens.operators.boosting import Boosted, BoostSettings, boost
from ledgerlens.operators.evaluate import class_weight, stratified_folds
from ledgerlens.operators.impute import filled_statement, overall_medians
from ledgerlens.schemas import CATEGORICAL_FEATURES, MISSING_LABEL, NUMERIC_FEATURES, TARGET
from ledgerlens.session import bucketed, checkpoint_dir, staged

TreeSettings = BoostSettings


def fill_missing_labels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING_LABEL)) for c in cols if c in df.columns})


def encode_categoricals(
    df: DataFrame, cols: Sequence[str], encoder: StringIndexerModel | None = None
) -> tuple[DataFrame, StringIndexerModel]:
    """Replace labels by their position in sorted order; missing is a label of its own.

    With a saved encoder, a label it has not seen raises.
    """
    cols = [c for c in cols if c in df.columns]
    filled = fill_missing_labels(df, cols)
    coded = [f"{c}_code" for c in cols]
    if encoder is None:
        encoder = StringIndexer(
            inputCols=cols, outputCols=coded, stringOrderType="alphabetAsc", handleInvalid="error"
        ).fit(filled)
    out = encoder.transform(filled)
    return out.drop(*cols).withColumnsRenamed(dict(zip(coded, cols))).withColumns(
        {c: F.col(c).cast("int") for c in cols}
    ), encoder


def feature_matrix(df: DataFrame) -> tuple[DataFrame, list[str], StringIndexerModel]:
    """The configured inputs that exist, categoricals encoded, with the target; and the input names."""
    numeric, categorical = present(df, NUMERIC_FEATURES), present(df, CATEGORICAL_FEATURES)
    encoded, encoder = encode_categoricals(df.select(*numeric, *categorical, TARGET), categorical)
    names = numeric + categorical
    return encoded.select(*names, TARGET), names, encoder


def with_null_flags(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns(
        {c: F.col(c).cast("double") for c in names} | {f"{c}_is_null": F.col(c).isNull().cast("double") for c in names}
    )


def label_codes(df: DataFrame) -> StringIndexerModel | None:
    """Codes for the labels of all rows that a model is to know; a label beyond them raises when rows are scored."""
    categorical = present(df, CATEGORICAL_FEATURES)
    if not categorical:
        return None
    indexer = StringIndexer(
        inputCols=categorical, outputCols=[f"{c}_code" for c in categorical], stringOrderType="alphabetAsc",
        handleInvalid="error",
    )
    return indexer.fit(fill_missing_labels(df, categorical))


def fit_trees(
    train: DataFrame, id_col: str, settings: TreeSettings = TreeSettings(), early_stop: bool = True,
    codes: StringIndexerModel | None = None, resume: PipelineModel | None = None,
) -> PipelineModel:
    """Fit on the given rows: medians, then boosting. A tenth of them is held back to watch the loss, never rows scored later.

    Trees have no missing-value branch here, so inputs are imputed and flagged first. ``codes`` names the labels the model is
    to know; by default those of the given rows. ``resume`` is a fitted model whose inputs are taken as they are and whose
    trees are gone on from.
    """
    checkpoint_dir(train.sparkSession)
    weight = class_weight(train).first()["positive_weight"]
    stages = list(resume.stages[:-1]) if resume else _input_stages(train, codes)
    numeric, categorical = _inputs(stages)
    # A hash of the id picks the watched rows: no rank, no shuffle. Inputs are computed once and stored.
    row = F.xxhash64(F.col(id_col).cast("string"), F.lit(settings.seed))
    watched = F.pmod(row, F.lit(10)) == 0
    rows = staged(
        PipelineModel(stages).transform(prepare_inputs(train, numeric, categorical)).select(
            "features", F.col(TARGET).alias("label"), F.when(F.col(TARGET) == 1, F.lit(weight)).otherwise(F.lit(1.0)).alias("weight"),
            (watched & F.lit(early_stop)).alias("watched"), row.alias("row"),
        ),
        "training",
    )
    most_labels = max((len(labels) + 1 for stage in stages if isinstance(stage, StringIndexerModel) for labels in stage.labelsArray), default=0)
    start = Boosted(resume.stages[-1].trees, settings.step) if resume else None
    boosted = boost(rows, replace(settings, bins=max(settings.bins, most_labels)), start)
    return PipelineModel([*stages, boosted.model()])


def _input_stages(train: DataFrame, codes: StringIndexerModel | None) -> list:
    """Exact medians, label codes and the feature vector, as fitted stages. A column without any value is left out."""
    values = overall_medians(train, present(train, NUMERIC_FEATURES))
    numeric = present(train, [c for c in NUMERIC_FEATURES if c in values])
    codes = codes or label_codes(train)
    filler = SQLTransformer(statement=filled_statement({c: values[c] for c in numeric}))
    coded = list(codes.getOutputCols()) if codes else []
    inputs = [*[f"{c}_filled" for c in numeric], *[f"{c}_is_null" for c in numeric], *coded]
    return [filler, *([codes] if codes else []), VectorAssembler(inputCols=inputs, outputCol="features")]


def _inputs(stages: list) -> tuple[list[str], list[str]]:
    """The numeric and the categorical inputs that the stages read."""
    assembler = next(s for s in stages if isinstance(s, VectorAssembler))
    numeric = [c.removesuffix("_filled") for c in assembler.getInputCols() if c.endswith("_filled")]
    return numeric, next((s.getInputCols() for s in stages if isinstance(s, StringIndexerModel)), [])


def prepare_inputs(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    return fill_missing_labels(with_null_flags(df, numeric), categorical)


def score(model: PipelineModel, df: DataFrame, column: str = "score") -> DataFrame:
    """Add the probability of default."""
    numeric, categorical = _inputs(model.stages)
    scored = model.transform(prepare_inputs(df, numeric, categorical))
    return scored.select(
        *[F.col(c).cast(df.schema[c].dataType) for c in df.columns],
        vector_to_array("probability")[1].alias(column),
    )


def importance(model: PipelineModel) -> DataFrame:
    """Split importance per input; a numeric input and its null flag are one feature."""
    trees: GBTClassificationModel = model.stages[-1]
    inputs = model.stages[-2].getInputCols()
    gains = trees.featureImportances.toArray().tolist() if any(tree.depth for tree in trees.trees) else []
    gains += [0.0] * (len(inputs) - len(gains))  # the last inputs may be in no tree
    base = lambda c: c.removesuffix("_filled").removesuffix("_is_null").removesuffix("_code")
    spark = SparkSession.getActiveSession()
    rows = [(base(c), float(v)) for c, v in zip(inputs, gains, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").groupBy("feature").agg(
        F.sum("importance").alias("importance")
    )


def cross_validate(
    df: DataFrame, id_col: str, folds: int = 5, settings: TreeSettings = TreeSettings(), digits: int = 3
) -> DataFrame:
    """Score every row by a model that has not seen its fold. Returns id, target, fold and score.

    The rows are stored by id once; every fold joins them with its ids, a narrow table, without moving them.
    """
    rows = bucketed(df, "rows", id_col)
    fold_of = staged(stratified_folds(rows.select(id_col, TARGET), id_col, folds=folds, seed=settings.seed, digits=digits), "folds")
    dealt = rows.join(fold_of.select(id_col, "fold"), id_col)
    codes = label_codes(dealt)
    scored = []
    for k in range(folds):
        model = fit_trees(dealt.filter(F.col("fold") != k).drop("fold"), id_col, settings, codes=codes)
        out = score(model, dealt.filter(F.col("fold") == k))
        scored.append(out.select(id_col, TARGET, "fold", "score"))
    rows = scored[0]
    for frame in scored[1:]:
        rows = rows.unionByName(frame)
    return rows


def log_run(
    spark: SparkSession, path: str, run_id: str, params: Mapping[str, object], metrics: Mapping[str, float]
) -> None:
    """Append a run's parameters and metrics as (run_id, kind, name, value) rows."""
    rows = [(run_id, "param", k, str(v)) for k, v in params.items()]
    rows += [(run_id, "metric", k, str(round(v, 4))) for k, v in metrics.items()]
    spark.createDataFrame(rows, "run_id string, kind string, name string, value string").coalesce(1).write.mode(
        "append"
    ).parquet(path)
