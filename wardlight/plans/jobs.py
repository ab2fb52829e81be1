"""Whole jobs: from raw file to clean table, and from clean table to judged models."""

from __future__ import annotations

import argparse
import sys
from typing import Any

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from wardlight import schema as S
from wardlight.errors import ValidationError
from wardlight.learning.artifacts import (
    champion_version,
    check_signature,
    combine,
    load_version,
    promote,
    publish,
    signature_of,
)
from wardlight.learning.evaluate import evaluate_models
from wardlight.learning.features import fit_features, split_data, transform_features
from wardlight.learning.models import train_all_models
from wardlight.operators.checks import validate_cleaned_encounters, validate_input_columns
from wardlight.operators.cleaning import clean_encounters
from wardlight.operators.encoding import encode_encounters
from wardlight.operators.metrics import champion
from wardlight.operators.scoring import RISK, score_with_model
from wardlight.operators.views import patient_features
from wardlight.session import build_session, materialize
from wardlight.sources.files import header_names, read_clean, read_raw_csv, write_parquet
from wardlight.sources.tables import create_clean_table


def clean_and_encode(raw: DataFrame) -> DataFrame:
    return raw.transform(clean_encounters).transform(encode_encounters)


def run_preprocessing(
    spark: SparkSession, source: str, target: str, table: str | None = None
) -> tuple[DataFrame, Row]:
    """Raw CSV to checked clean Parquet; the stored frame and its report.

    The header is checked first: its columns may come in any order. The text is parsed once,
    into a staged copy. The report reads the few columns it
    needs from that copy, and only data that passes replaces the target.
    """
    names = header_names(spark, source)
    validate_input_columns(spark.createDataFrame([], ", ".join(f"`{n}` string" for n in names)))
    raw = read_raw_csv(spark, source, names=names)
    # The rows are counted while they are staged.
    seen = Observation("raw rows")
    watched = S.normalize_columns(raw).select(*S.RAW_COLUMNS).observe(seen, F.count(F.lit(1)).alias("rows"))
    staged = materialize(clean_and_encode(watched), "clean")
    raw_rows = seen.get["rows"]
    report = validate_cleaned_encounters(staged, raw_rows)
    write_parquet(staged, target)
    stored = create_clean_table(spark, table, target) if table else read_clean(spark, target)
    return stored, report


def prepare_training(
    clean: DataFrame, seed: int = 42, fit_on: str = "train"
) -> tuple[DataFrame, DataFrame, Any]:
    """Train and test vectors, and the feature model fitted on ``train`` or ``all`` rows."""
    if fit_on not in ("train", "all"):
        raise ValueError(f"fit_on is 'train' or 'all', not {fit_on!r}")
    # Stored once: indexes, scales and both sides' vectors each read it again.
    features = materialize(
        patient_features(clean).select(
            "encounter_id", "patient_nbr", *S.FEATURE_COLUMNS, S.TARGET_COLUMN
        ),
        "features",
    )
    train, test = split_data(features, seed=seed)
    model = fit_features(train if fit_on == "train" else features)
    return (
        materialize(transform_features(train, model), "train"),
        materialize(transform_features(test, model), "test"),
        model,
    )


def run_training(clean: DataFrame, folder: str, seed: int = 42) -> DataFrame:
    """Train, store and compare the four classifiers; the comparison report."""
    train, test, features = prepare_training(clean, seed)
    features.write().overwrite().save(f"{folder}/features")
    models, records = train_all_models(train, test, folder)
    return evaluate_models(models, test, records)


MODEL_INPUTS = ["encounter_id", "patient_nbr", *S.FEATURE_COLUMNS]


def run_training_job(spark: SparkSession, clean: str, folder: str, seed: int = 42, metric: str = "f1") -> DataFrame:
    """Train on a clean table, publish all four models as artifacts and promote the best.

    The comparison report is stored beside them, with each model's version.
    """
    train, test, features = prepare_training(read_clean(spark, clean), seed)
    models, records = train_all_models(train, test)
    report = evaluate_models(models, test, records)
    best = champion(report, metric).first()["model"]
    signature = signature_of(patient_features(read_clean(spark, clean)), MODEL_INPUTS)
    versions = {
        name: publish(
            spark, folder, combine(features, model), signature,
            {"model": name, "settings": records[name]["settings"], "train_rows": records[name]["train_rows"]},
        )
        for name, model in models.items()
    }
    promote(spark, folder, versions[best], champion_version(spark, folder))
    numbers = F.create_map(*[F.lit(x) for pair in versions.items() for x in pair])
    path = f"{folder}/reports/{versions[best]:08d}"
    report.withColumn("version", numbers[F.col("model")]).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def run_scoring(
    spark: SparkSession, source: str, folder: str, target: str, day: str, version: int | None = None
) -> DataFrame:
    """Score a raw CSV with a stored artifact (the champion); the day's partition of ``target``.

    Only that day's partition is replaced, so a day that runs again changes nothing, and other
    days stay as they are.
    """
    names = header_names(spark, source)
    validate_input_columns(spark.createDataFrame([], ", ".join(f"`{n}` string" for n in names)))
    raw = S.normalize_columns(read_raw_csv(spark, source, names=names)).select(*S.RAW_COLUMNS)
    rows = patient_features(clean_and_encode(raw))
    number, model, signature = load_version(spark, folder, version)
    check_signature(rows, signature)
    scored = score_with_model(rows, model).select(
        "encounter_id", "patient_nbr", RISK, "readmission_prediction", "risk_tier",
        F.lit(number).cast("long").alias("model_version"), F.lit(day).alias("score_date"),
    )
    scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("score_date").parquet(target)
    return spark.read.schema(scored.schema).parquet(target).filter(F.col("score_date") == day)


def main(argv: list[str] | None = None) -> int:
    """``spark-submit`` entry: clean raw encounters, or with ``--job`` train on clean ones or
    score raw ones with the champion."""
    parser = argparse.ArgumentParser(description="Clean, train on or score encounters.")
    parser.add_argument("--job", choices=("clean", "train", "score"), default="clean")
    parser.add_argument("--input-path", required=True)
    parser.add_argument("--output-path", required=True)
    parser.add_argument("--output-table")
    parser.add_argument("--artifacts", help="folder of the models; for training it is the output path")
    parser.add_argument("--day", help="partition of a scoring run, such as 2024-05-31")
    parser.add_argument("--master")
    args = parser.parse_args(argv)
    if args.job == "score" and not (args.artifacts and args.day):
        parser.error("a scoring run needs --artifacts and --day")
    spark = build_session(f"encounter {args.job}", args.master)
    try:
        if args.job == "train":
            run_training_job(spark, args.input_path, args.output_path).show()
            return 0
        if args.job == "score":
            scored = run_scoring(spark, args.input_path, args.artifacts, args.output_path, args.day)
            print({"score_date": args.day, "rows": scored.count()})
            return 0
        _, report = run_preprocessing(spark, args.input_path, args.output_path, args.output_table)
    except ValidationError as problem:
        print(f"rejected: {problem}", file=sys.stderr)
        return 1
    print(report.asDict())
    return 0


if __name__ == "__main__":
    sys.exit(main())
