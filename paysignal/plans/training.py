"""Labelled training set and a distributed baseline classifier."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paysignal.functions.columns import not_blank
from paysignal.functions.text import feature_text
from paysignal.operators.dedup import latest_per_key
from paysignal.operators.metrics import binary_metrics
from paysignal.operators.split import stratified_split
from paysignal.plans.analysis import HIGH_RISK

# Feature names of the Silver layer and their short forms.
SHORT_NAMES = {
    "tx_by_card_5m": "tx_5m",
    "distinct_merchants_10m": "merchants_10m",
    "distinct_countries_1h": "countries_1h",
}
NUMBERS = ("amount", "risk_score", "tx_5m", "merchants_10m", "countries_1h")
# Country spellings replaced in this step.
COUNTRY_FIXES = {"ESPAÑA": "ES", "SPAIN": "ES"}


def labelled(df: DataFrame, high_risk: float = HIGH_RISK) -> DataFrame:
    """Normalised rows, one per payment, with ``label`` and ``text``.

    The label is an existing ``label``, else ``is_fraud``, else a high score or a
    declined status.
    """
    present = {old: new for old, new in SHORT_NAMES.items() if old in df.columns and new not in df.columns}
    named = df.withColumnsRenamed(present)

    def text(name: str):
        return F.trim(F.col(name).cast("string")) if name in named.columns else F.lit("")

    def number(name: str):
        return F.col(name).try_cast("double") if name in named.columns else F.lit(0.0)

    country = F.upper(text("country"))
    columns = {
        "payment_id": text("payment_id"),
        "card_id": F.upper(text("card_id")),
        "country": F.coalesce(country, F.lit("")),
        "status": F.coalesce(F.lower(text("status")), F.lit("")),
        **{n: number(n) if n == "amount" else F.coalesce(number(n), F.lit(0.0)) for n in NUMBERS},
    }
    given = next((c for c in ("label", "is_fraud") if c in named.columns), None)
    if given:
        columns["label"] = F.coalesce(F.col(given).try_cast("double").cast("int"), F.lit(0))
    order = [c for c in ("event_time", "ingestion_ts") if c in named.columns]
    rows = (
        named.select(*order, *[c.alias(n) for n, c in columns.items()])
        .replace(COUNTRY_FIXES, subset=["country"])
        .filter(not_blank(F.col("payment_id")) & not_blank(F.col("card_id")) & (F.col("amount") >= 0))
    )
    latest = latest_per_key(rows, "payment_id", order).drop(*order)
    if not given:
        risky = (F.col("risk_score") >= F.lit(float(high_risk))) | (F.col("status") == "declined")
        latest = latest.withColumn("label", risky.cast("int"))
    return latest.withColumn("text", feature_text())


def training_set(df: DataFrame, high_risk: float = HIGH_RISK) -> DataFrame:
    return labelled(df, high_risk).select("text", "label")


def label_distribution(rows: DataFrame) -> DataFrame:
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("total"))


def require_two_classes(rows: DataFrame) -> None:
    """Fail when there is nothing to learn from."""
    found = rows.select("label").distinct().limit(2).count()
    if found == 0:
        raise ValueError("the training set is empty")
    if found < 2:
        raise ValueError("the training set has a single class")


def categories(rows: DataFrame, column: str, most: int) -> list[str]:
    """The ``most`` commonest values of a column, ties in text order."""
    counted = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)
    return [r[0] for r in counted.limit(most).collect()]  # at most ``most`` values


def feature_stages(train: DataFrame, with_label_inputs: bool, hash_size: int, most_categories: int) -> list:
    """Inputs of the classifier: numbers as they are, country and status one column per
    value, the card hashed into columns of its own.

    Values beyond the ``most_categories`` commonest of the train rows share the column
    of unknown values, so an open set of spellings does not reach the driver. Cards have
    no bound, so they get no index.
    """
    names = ["country"] + (["status"] if with_label_inputs else [])
    numbers = [n for n in NUMBERS if with_label_inputs or n != "risk_score"]
    stages = []
    for name in names:
        values = categories(train, name, most_categories) or [""]
        stages.append(StringIndexerModel.from_labels(values, inputCol=name, outputCol=f"{name}_index", handleInvalid="keep"))
    encoded = [f"{name}_vector" for name in names]
    stages.append(OneHotEncoder(inputCols=[f"{name}_index" for name in names], outputCols=encoded, dropLast=False))
    stages.append(FeatureHasher(inputCols=["card_id"], outputCol="card_vector", numFeatures=hash_size))
    stages.append(VectorAssembler(inputCols=[*numbers, *encoded, "card_vector"], outputCol="features"))
    return stages


def split_sizes(parts: DataFrame) -> DataFrame:
    """Rows and positives of each side of a split."""
    return parts.groupBy("split").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("label") == 1).alias("positives"))


def train_classifier(rows: DataFrame, with_label_inputs: bool = True, test_fraction: float = 0.2, seed: int = 42,
                     hash_size: int = 4096, iterations: int = 20, max_train_rows: int = 0, most_categories: int = 256):
    """Logistic regression on the eight inputs; returns model, evaluation rows and metrics.

    ``risk_score`` and ``status`` also define the default label;
    ``with_label_inputs=False`` leaves them out. ``hash_size`` is the number of
    columns that cards are hashed into. ``max_train_rows`` bounds
    the train rows of each label that the fit sees, in a stable hash order; the
    evaluation uses all of its rows.
    """
    require_two_classes(rows)
    parts = stratified_split(rows, "label", "payment_id", test_fraction, seed)
    train = parts.filter("split = 'train'")
    features = feature_stages(train, with_label_inputs, hash_size, most_categories)
    if max_train_rows > 0:
        order = Window.partitionBy("label").orderBy(F.xxhash64("payment_id", F.lit(seed)), "payment_id")
        train = train.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= max_train_rows).drop("_rank")
    model = Pipeline(stages=[*features, LogisticRegression(labelCol="label", maxIter=iterations, regParam=0.01)]).fit(train)
    scored = model.transform(parts.filter("split = 'eval'")).withColumn("score", vector_to_array("probability")[1])
    return model, scored, binary_metrics(scored, "label", "prediction", "score")
