"""Feature encoding: categories, numerics, the final vector."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexerModel,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latebird.operators.median import median
from latebird.schema import LABEL

# Column names of the predictions table.
NUMERIC_RAW = "num_features_raw"
NUMERIC_SCALED = "num_features_scaled"
FEATURES = "features"
ALL_FEATURES = "features_all"

#: Different values of a category column beyond which indexing raises: labels go
#: to the driver and into the schema's metadata.
MOST_LABELS = 100_000


class MedianFill(Estimator):
    """Learns the exact median of integer columns and fills their nulls with it.

    The median comes from the rows it is fitted on, so a scored batch is filled
    with the training value. A column without any value is filled with 0, where
    Spark's `Imputer` fails. The fitted stage is a plain `SQLTransformer`, which
    saves and loads without this package.
    """

    def __init__(self, columns: Sequence[str]):
        super().__init__()
        self.columns = list(columns)

    def _fit(self, dataset: DataFrame) -> Transformer:
        return fill_stage({c: median(dataset, c).first()["median"] or 0 for c in self.columns})


def fill_stage(values: Mapping[str, int]) -> SQLTransformer:
    """A stage that fills the nulls of each column with its value."""
    filled = ", ".join(f"coalesce({c}, {v}) AS {c}" for c, v in values.items())
    return SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(values)}), {filled} FROM __THIS__")


def impute(columns: Sequence[str], suffix: str = "_filled", relative_error: float = 0.001) -> Imputer:
    """Spark's own median fill, into new columns; the median is approximate."""
    return Imputer(
        strategy="median",
        inputCols=list(columns),
        outputCols=[c + suffix for c in columns],
        relativeError=relative_error,
    )


def index_name(column: str) -> str:
    return f"{column}_idx"


def one_hot_name(column: str) -> str:
    return f"{column}_ohe"


class FrequencyIndexer(Estimator):
    """Learns an index for each category by falling frequency, ties in value order.

    Values are counted by the shuffle, all columns in one pass, so a task sees
    its share of the values; only the labels come to the driver, and more than
    `most` of a column raise. What is fitted are Spark's `StringIndexerModel`s.
    """

    def __init__(self, columns: Sequence[str], most: int = MOST_LABELS):
        super().__init__()
        self.columns, self.most = list(columns), most

    def _fit(self, dataset: DataFrame) -> Transformer:
        values = F.array(*[F.col(c).cast("string") for c in self.columns])
        counted = (
            dataset.select(F.posexplode(values).alias("place", "value"))
            .where(F.col("value").isNotNull())
            .groupBy("place", "value")
            .count()
        )
        # Within the bound of each column all rows come; one more shows that a bound is passed.
        rows = counted.limit(self.most * len(self.columns) + 1).collect()
        return self.model([(r["place"], r["value"], r["count"]) for r in rows])

    def model(self, counted: Iterable[tuple[int, str, int]]) -> Transformer:
        """The fitted stage from (place of the column, value, count)."""
        labels: list[list[str]] = [[] for _ in self.columns]
        for place, value, _ in sorted(counted, key=lambda r: (-r[2], r[1])):
            labels[place].append(value)
        for name, own in zip(self.columns, labels):
            if len(own) > self.most:
                raise ValueError(f"{name} has {len(own)} different values or more, bound {self.most}")
        # One model per column: lists of different lengths do not reach one model whole.
        models = [
            StringIndexerModel.from_arrays_of_labels(
                [own], inputCols=[c], outputCols=[index_name(c)], handleInvalid="keep"
            )
            for c, own in zip(self.columns, labels)
        ]
        return models[0] if len(models) == 1 else PipelineModel(models)


def string_indexer(columns: Sequence[str], most: int = MOST_LABELS) -> FrequencyIndexer:
    """Index categories by falling frequency, ties in value order; numbers are
    indexed as text. Null and unseen values share one extra index."""
    return FrequencyIndexer(columns, most)


def one_hot_encoder(columns: Sequence[str]) -> OneHotEncoder:
    """Sparse one-hot vectors; the extra index becomes the all-zero vector."""
    return OneHotEncoder(
        inputCols=[index_name(c) for c in columns],
        outputCols=[one_hot_name(c) for c in columns],
    )


def numeric_assembler(columns: Sequence[str], invalid: str = "skip") -> VectorAssembler:
    """Numerics as one vector. A null or NaN drops the row (`skip`) or fails
    the job (`error`)."""
    return VectorAssembler(inputCols=list(columns), outputCol=NUMERIC_RAW, handleInvalid=invalid)


def numeric_scaler() -> StandardScaler:
    """Mean 0 and sample deviation 1 over the numeric block only: centring the
    one-hot block would turn its sparse vectors dense."""
    return StandardScaler(
        inputCol=NUMERIC_RAW, outputCol=NUMERIC_SCALED, withMean=True, withStd=True
    )


def feature_assembler(categories: Sequence[str], output: str = FEATURES) -> VectorAssembler:
    return VectorAssembler(
        inputCols=[one_hot_name(c) for c in categories] + [NUMERIC_SCALED], outputCol=output
    )


def slot_scores(df: DataFrame, features: str = ALL_FEATURES, label: str = LABEL) -> DataFrame:
    """(slot, f_value) of every slot of an assembled vector: the F statistic of its
    correlation with the label, F = r^2 / (1 - r^2) * (n - 2), infinite at r^2 = 1
    and 0 where the slot or the label does not vary.

    One pass over sums. A one-hot slot needs only its category's count and label
    sum, so the sparse vector is not unfolded: the category's index column names
    the one active slot. Only the numeric block is unfolded.
    """
    names = feature_names(df, features)
    entries = []
    for c in df.columns:
        prefix = one_hot_name(c) + "_"
        places = [i for i, name in enumerate(names) if name.startswith(prefix)]
        if not places or index_name(c) not in df.columns:
            continue
        active = F.when(F.col(index_name(c)) < len(places), F.col(index_name(c)).cast("int") + places[0])
        entries.append(F.struct(active.alias("slot"), F.lit(1.0).alias("x")))
    numeric = [i for i, name in enumerate(names) if name.startswith(NUMERIC_SCALED)]
    values = vector_to_array(NUMERIC_SCALED)
    entries += [
        F.struct(F.lit(slot).alias("slot"), values[place].alias("x")) for place, slot in enumerate(numeric)
    ]
    y = F.col(label).cast("double")
    rows = df.where(F.col(label).isNotNull())
    totals = rows.agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy")
    )
    sums = (
        rows.select(y.alias("y"), F.explode(F.array(*entries)).alias("e"))
        .where("e.slot IS NOT NULL")
        .groupBy("e.slot")
        .agg(
            F.sum("e.x").alias("sx"),
            F.sum(F.col("e.x") * F.col("e.x")).alias("sxx"),
            F.sum(F.col("e.x") * F.col("y")).alias("sxy"),
        )
    )
    joined = sums.join(F.broadcast(totals))  # one row
    r2 = F.expr(
        "try_divide(pow(n * sxy - sx * sy, 2), (n * sxx - sx * sx) * (n * syy - sy * sy))"
    )
    f_value = F.when(F.col("r2") >= 1, F.lit(float("inf"))).otherwise(
        F.col("r2") / (1 - F.col("r2")) * (F.col("n") - 2)
    )
    return joined.withColumn("r2", F.coalesce(r2, F.lit(0.0))).select("slot", f_value.alias("f_value"))


class TopFeatures(Estimator):
    """Learns which `k` slots of the assembled vector have the largest F, ties to
    the earlier slot. P-values are not used: they reach 0 for many slots at once
    as rows grow, and then say nothing. The fitted stage is a `VectorSlicer`."""

    def __init__(self, k: int, features: str, output: str, label: str):
        super().__init__()
        self.k, self.features, self.output, self.label = k, features, output, label

    def _fit(self, dataset: DataFrame) -> Transformer:
        scores = slot_scores(dataset, self.features, self.label)
        best = scores.orderBy(F.desc("f_value"), "slot").limit(self.k).collect()
        return VectorSlicer(
            inputCol=self.features, outputCol=self.output, indices=sorted(r["slot"] for r in best)
        )


def top_feature_selector(
    k: int = 20, features: str = ALL_FEATURES, output: str = FEATURES, label: str = LABEL
) -> TopFeatures:
    """The `k` features with the strongest F-test against a continuous label."""
    return TopFeatures(k, features, output, label)


def feature_names(
    df: DataFrame, column: str = FEATURES, numerics: Sequence[str] = ()
) -> list[str]:
    """Names of a vector column's slots, from its ML metadata. Scaling leaves
    the numerics as numbered slots; `numerics` gives them their names back."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"]
    slots = sorted((slot for group in groups.values() for slot in group), key=lambda s: s["idx"])
    renamed = {f"{NUMERIC_SCALED}_{i}": name for i, name in enumerate(numerics)}
    names = [slot.get("name", str(slot["idx"])) for slot in slots]
    return [renamed.get(name, name) for name in names]


def selected_features(
    model: VectorSlicer,
    df: DataFrame,
    numerics: Sequence[str] = (),
    label: str = LABEL,
) -> DataFrame:
    """The chosen slots as rows (index, name, f_value); `df` holds the selector's input."""
    chosen = model.getIndices()
    names = feature_names(df, model.getInputCol(), numerics)
    named = F.create_map(*[F.lit(x) for i in chosen for x in (i, names[i])])
    scores = slot_scores(df, model.getInputCol(), label)
    return scores.where(F.col("slot").isin(chosen)).select(
        F.col("slot").alias("index"), named[F.col("slot")].alias("name"), "f_value"
    )
