"""Feature vectors with Spark ML, and the split they are fitted on one side of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight import schema as S
from wardlight.operators.checks import validate_feature_columns

FEATURES = "features"
ASSEMBLED = "assembled_features"


def string_indexer(columns: Sequence[str]) -> StringIndexer:
    """Index by falling frequency, ties by name; unseen and NULL share one more index.

    One stage for all columns, so their counts come from one pass.
    """
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_indexed" for c in columns],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def one_hot_encoder(columns: Sequence[str], drop_last: bool = False) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[f"{c}_indexed" for c in columns],
        outputCols=[f"{c}_vec" for c in columns],
        handleInvalid="keep",
        dropLast=drop_last,
    )


def vector_assembler(columns: Sequence[str], to: str = ASSEMBLED) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=to, handleInvalid="keep")


def standard_scaler(
    source: str = ASSEMBLED, to: str = FEATURES, with_mean: bool = False, with_std: bool = True
) -> StandardScaler:
    """Divide by the sample deviation; not centred, so sparse vectors stay sparse."""
    return StandardScaler(inputCol=source, outputCol=to, withMean=with_mean, withStd=with_std)


def numeric_fill(columns: Sequence[str]) -> SQLTransformer:
    """0 for unknown numbers: one NULL would turn a whole scaled column into NaN.

    A stage of the fitted pipeline, so scoring fills what training filled.
    """
    filled = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0D) AS {c}" for c in columns)
    return SQLTransformer(
        statement=f"SELECT * EXCEPT ({', '.join(columns)}), {filled} FROM __THIS__"
    )


def fill_numerics(df: DataFrame, columns: Sequence[str] = tuple(S.NUMERICAL_FEATURES)) -> DataFrame:
    return numeric_fill(columns).transform(df)


def build_feature_pipeline(
    categorical: Sequence[str] = tuple(S.CATEGORICAL_FEATURES),
    numerical: Sequence[str] = tuple(S.NUMERICAL_FEATURES),
    with_mean: bool = False,
    with_std: bool = True,
    drop_last: bool = False,
) -> Pipeline:
    """Fill, index, one-hot, assemble (categories first) and scale."""
    return Pipeline(
        stages=[
            numeric_fill(numerical),
            string_indexer(categorical),
            one_hot_encoder(categorical, drop_last),
            vector_assembler([*[f"{c}_vec" for c in categorical], *numerical]),
            standard_scaler(with_mean=with_mean, with_std=with_std),
        ]
    )


def fit_features(
    df: DataFrame,
    pipeline: Pipeline | None = None,
    require_target: bool = True,
) -> PipelineModel:
    """Fit on the rows given. Give the training side only, or test rows shape the
    indexes and scales they are later judged with.

    The pipeline's indexer holds its labels in the driver and in every task. Columns of very
    many values are indexed by ``categories.index_categories`` instead, whose labels stay a table.
    """
    validate_feature_columns(df, require_target)
    return (pipeline or build_feature_pipeline()).fit(df)


def transform_features(
    df: DataFrame,
    model: PipelineModel,
    features: str = FEATURES,
    target: str = S.TARGET_COLUMN,
    include_identifiers: bool = True,
) -> DataFrame:
    """Identifiers, vector and target, whichever exist; everything if none does."""
    transformed = model.transform(df)
    wanted = (["encounter_id", "patient_nbr"] if include_identifiers else []) + [features, target]
    kept = [c for c in wanted if c in transformed.columns]
    return transformed.select(kept) if kept else transformed


def feature_dimension(df: DataFrame, features: str = FEATURES) -> int:
    """Vector size from the column's metadata, without a job."""
    return int(df.schema[features].metadata["ml_attr"]["num_attrs"])


def vector_slots(model: PipelineModel) -> list[tuple[str, str]]:
    """(column, value) behind every slot of the vector, in vector order.

    Each category block ends with the slot of unseen values and the encoder's own
    for invalid indexes.
    """
    indexer = next(s for s in model.stages if isinstance(s, StringIndexerModel))
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    slots: list[tuple[str, str]] = []
    for column, labels in zip(indexer.getInputCols(), indexer.labelsArray):
        slots += [(column, value) for value in [*labels, "(unseen)", "(invalid)"]]
    blocks = {f"{c}_vec" for c in indexer.getInputCols()}
    return slots + [(c, "") for c in assembler.getInputCols() if c not in blocks]


SPLIT_STEPS = 10_000


def split_data(
    df: DataFrame, train: float = 0.8, test: float = 0.2, seed: int = 42, key: str = "encounter_id"
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same rows on every run and every
    partitioning, where a random split moves rows when a task is retried."""
    for ratio in (train, test):
        if not 0 < ratio < 1:
            raise ValueError(f"ratios must lie between 0 and 1, got {ratio}")
    if abs(train + test - 1) > 1e-9:
        raise ValueError("ratios must sum to 1")
    missing = [c for c in (key, S.TARGET_COLUMN) if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    share = split_share(df, key, seed)
    return df.filter(share < train), df.filter(share >= train)


def split_share(df: DataFrame, key: str = "encounter_id", seed: int = 42) -> Column:
    """A number from 0 up to 1 for every row, from the first 32 bits of an MD5 hash of its key.

    The bits give a whole step of ten thousand and, with what is left of them, a place within
    it, so any ratio has its border. A row without a key is placed by ``patient_nbr``, or
    without that column by its target: few columns, so that a split reads few.
    """
    other = "patient_nbr" if "patient_nbr" in df.columns else S.TARGET_COLUMN
    text = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("no key "), F.xxhash64(other).cast("string")))
    bits = F.conv(F.substring(F.md5(F.concat(text, F.lit(f":{seed}"))), 1, 8), 16, 10).cast("long")
    within = F.floor(bits / SPLIT_STEPS) / F.lit(float(2**32 // SPLIT_STEPS + 1))
    return (bits % SPLIT_STEPS + within) / SPLIT_STEPS


def fold_of(df: DataFrame, folds: int, key: str = "encounter_id", seed: int = 42) -> Column:
    """The fold of every row, from 0, by the same hash."""
    return F.floor(split_share(df, key, seed) * folds).cast("int")
