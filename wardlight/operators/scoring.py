"""Risk scores, their factors, percentiles, what-if comparisons and listings."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight.functions import clinical as fn
from wardlight.operators.checks import require_unique
from wardlight.operators.ordered import rank_values, with_previous
from wardlight.operators.spread import join_spread

RISK = "risk_score"


def with_risk(df: DataFrame, probability: Column, threshold: float = 0.5) -> DataFrame:
    scored = df.withColumn(RISK, probability)
    return scored.withColumns(
        {
            "readmission_prediction": fn.flag(F.col(RISK) >= threshold),
            "risk_tier": fn.risk_tier(F.col(RISK)),
        }
    )


def score_with_model(df: DataFrame, model) -> DataFrame:
    """Probability, prediction and tier of every encounter under a fitted model."""
    scored = model.transform(df)
    return with_risk(scored, vector_to_array("probability")[1]).drop(
        "rawPrediction", "probability", "prediction"
    )


def _weighed(weights: Mapping[str, float]) -> dict[str, Column]:
    return {
        c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(float(w))
        for c, w in weights.items()
    }


def score_with_weights(df: DataFrame, weights: Mapping[str, float], intercept: float) -> DataFrame:
    """The same from a logistic model given as named weights."""
    margin = sum(_weighed(weights).values(), F.lit(float(intercept)))
    return with_risk(df, F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))


def with_cohort_tiers(
    scored: DataFrame,
    cohort: str,
    starts: Mapping[str, Sequence[tuple[str, float]]],
    to: str = "cohort_risk_tier",
) -> DataFrame:
    """Tier by the starts of the encounter's own cohort, the usual ones elsewhere."""
    tier = fn.risk_tier(F.col(RISK))
    for name, own in starts.items():
        tier = F.when(F.col(cohort) == name, fn.risk_tier(F.col(RISK), own)).otherwise(tier)
    return scored.withColumn(to, tier)


def contribution_array(weights: Mapping[str, float]) -> Column:
    """What each feature adds to the margin, as an array of (feature, contribution)."""
    return F.array(
        *[
            F.struct(F.lit(c).alias("feature"), part.alias("contribution"))
            for c, part in _weighed(weights).items()
        ]
    )


def model_contribution_array(model, slots: Sequence[tuple[str, str]], features: str = "features"):
    """The same for a fitted logistic regression, one entry per non-zero vector slot."""
    names = F.array(*[F.lit(f"{c}={v}" if v else c) for c, v in slots])
    factors = F.array(*[F.lit(float(w)) for w in model.coefficients.toArray()])
    parts = F.zip_with(vector_to_array(F.col(features)), factors, lambda x, w: x * w)
    named = F.zip_with(
        names, parts, lambda n, p: F.struct(n.alias("feature"), p.alias("contribution"))
    )
    return F.filter(named, lambda e: e["contribution"] != 0)


def contributions(
    df: DataFrame, parts: Column, key: str = "encounter_id", carry: Sequence[str] = ()
) -> DataFrame:
    """One row per encounter and feature, with any columns of the encounter to carry."""
    kept = [key, *carry]
    return df.select(*kept, F.explode(parts).alias("_part")).select(*kept, "_part.*")


def top_factors(
    df: DataFrame, parts: Column, k: int = 3, key: str = "encounter_id"
) -> DataFrame:
    """The k features that move each encounter's score most, by size then name.

    The factors of an encounter are an array of its own row, so ranking them is a
    sort inside the row and shuffles nothing.
    """
    ranked = F.array_sort(
        F.transform(
            parts,
            lambda p: F.struct(
                (-F.abs(p["contribution"])).alias("size"),
                p["feature"].alias("feature"),
                p["contribution"].alias("contribution"),
            ),
        )
    )
    return df.select(key, F.posexplode(F.slice(ranked, 1, k)).alias("_place", "_factor")).select(
        key,
        (F.col("_place") + 1).alias("factor_rank"),
        F.col("_factor.feature").alias("feature"),
        F.col("_factor.contribution").alias("contribution"),
    )


def top_factors_long(contributed: DataFrame, k: int = 3, key: str = "encounter_id") -> DataFrame:
    """The same from stored contribution rows; a group is one encounter's features."""
    window = W.partitionBy(key).orderBy(F.abs("contribution").desc(), "feature")
    return (
        contributed.withColumn("factor_rank", F.row_number().over(window))
        .filter(F.col("factor_rank") <= k)
        .select(key, "factor_rank", "feature", "contribution")
    )


def cohort_weighted(contributed: DataFrame, weights: DataFrame) -> DataFrame:
    """Contributions times their cohort's weight for the feature (1 where none is set).

    Contribution rows carry their encounter's ``cohort``; ``weights`` has ``cohort,
    feature, weight``, one row for each pair.
    """
    return join_spread(contributed, weights, ["cohort", "feature"]).select(
        "encounter_id",
        "cohort",
        "feature",
        "contribution",
        (F.col("contribution") * F.coalesce("weight", F.lit(1.0))).alias("weighted_contribution"),
    )


def risk_percentiles(scored: DataFrame, score: str = RISK, pieces: int | None = None) -> DataFrame:
    """Share of the other encounters that score lower, from 0 to 1, on every row.

    Ranks are found per distinct score and joined back on it, apart from the shuffle
    for scores that very many rows share. Rows without a score have no percentile.
    Give a stored table where scoring is dear: it is read more than once.
    """
    ranks = rank_values(scored, score, pieces)
    others = F.col("total_rows") - 1
    placed = ranks.select(
        score,
        F.col("rows").alias("_rows"),
        F.when(others > 0, F.col("rows_below") / others)
        .otherwise(F.lit(0.0))
        .alias("risk_percentile"),
    )
    known = scored.filter(F.col(score).isNotNull())
    unknown = scored.filter(F.col(score).isNull()).withColumn(
        "risk_percentile", F.lit(None).cast("double")
    )
    joined = join_spread(
        known, placed.drop("_rows"), [score], placed.select(score, "_rows"), pieces
    )
    return joined.select(*scored.columns, "risk_percentile").unionByName(unknown)


def what_if(
    encounters: DataFrame,
    scenarios: Mapping[str, Mapping[str, Column]],
    score: Callable[[DataFrame, Sequence[str]], DataFrame],
    key: str = "encounter_id",
) -> DataFrame:
    """Risk of every encounter under every scenario next to its own.

    A scenario overrides input columns. ``score(df, carry)`` derives features anew,
    adds the risk and keeps the carried columns, so everything that follows from a
    changed input changes with it. Scenarios are exploded within the row.
    """
    own = score(encounters, []).withColumnRenamed(RISK, "baseline_risk")
    names = F.array(*[F.lit(name) for name in scenarios])
    repeated = own.withColumn("scenario", F.explode(names))
    changes: dict[str, Column] = {}
    for name, overrides in scenarios.items():
        for column, value in overrides.items():
            otherwise = changes.get(column, F.col(column))
            changes[column] = F.when(F.col("scenario") == name, value).otherwise(otherwise)
    changed = repeated.withColumns(changes) if changes else repeated
    return score(changed, ["scenario", "baseline_risk"]).select(
        key,
        "scenario",
        "baseline_risk",
        F.col(RISK).alias("scenario_risk"),
        (F.col(RISK) - F.col("baseline_risk")).alias("risk_change"),
    )


def risk_listing(
    scored: DataFrame,
    limit: int,
    tier: str | None = None,
    after: int | None = None,
    page: int = 1,
    key: str = "encounter_id",
) -> DataFrame:
    """One page of risk records in id order.

    ``after`` (the last id of the page before) keeps a deep page as cheap as the
    first; ``page`` counts off the earlier pages instead.
    """
    rows = scored if tier is None else scored.filter(F.col("risk_tier") == tier)
    if after is not None:
        rows = rows.filter(F.col(key) > after)
    return rows.orderBy(key).offset((page - 1) * limit).limit(limit)


def first_rows(df: DataFrame, n: int, key: str = "encounter_id") -> DataFrame:
    """The first n rows by id."""
    return df.orderBy(key).limit(n)


def patient_profiles(
    details: DataFrame, scored: DataFrame, factors: DataFrame, pieces: int | None = None, k: int = 3
) -> DataFrame:
    """Encounters with their risk, the risk at the patient's last encounter, and their
    leading factors: as many as ``k``, which is that of ``top_factors``.

    ``scored`` is best a stored table, since it is read several times. Ids must not
    repeat in it or in ``details``, which is checked.
    """
    require_unique(details)
    require_unique(scored)
    risks = with_previous(
        scored.select("encounter_id", "patient_nbr", RISK, "risk_tier"),
        "patient_nbr",
        "encounter_id",
        RISK,
        "previous_risk_score",
        pieces,
    ).drop("patient_nbr")
    named = factors.groupBy("encounter_id").agg(
        *[
            F.max(F.when(F.col("factor_rank") == i, F.col("feature"))).alias(f"factor_{i}")
            for i in range(1, k + 1)
        ]
    )
    return details.join(risks, "encounter_id").join(named, "encounter_id", "left")
