"""Feature recipes: which rows, columns and stages turn flights into features."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import Pipeline
from pyspark.ml.base import Estimator, Transformer

from latebird.operators import encoding
from latebird.plans import stages
from latebird.schema import LABEL, REQUIRED_COLUMNS

Stage = Estimator | Transformer


@dataclass(frozen=True)
class Recipe:
    categories: tuple[str, ...]
    numerics: tuple[str, ...]
    required: tuple[str, ...]
    # How nulls of TaxiOut are treated: "fitted" fills them with the training
    # median; "batch" replaces the whole column by the batch's own median;
    # "none" leaves them.
    taxi_fill: str = "fitted"
    # With "batch": take the median over zero-filled values.
    zero_fill_first: bool = False
    # Null minutes count as 0 in the clock arithmetic.
    null_as_zero: bool = True
    landing_after_takeoff: bool = True
    split_clock: bool = False
    # What a null numeric does: "skip" drops the row, "error" fails.
    invalid_numerics: str = "skip"
    top_features: int | None = None

    def parity(self) -> Recipe:
        """The recipe with the constant TaxiOut of the original steps."""
        return self if self.taxi_fill == "none" else replace(self, taxi_fill="batch")

    def row_stages(self, require_label: bool = True) -> list[Stage]:
        """Stages that look at one row at a time (with "batch", also at the
        batch's median). Nothing is learnt here."""
        required = [c for c in self.required if require_label or c != LABEL]
        batch = self.taxi_fill == "batch"
        steps = [
            stages.clean_stage(
                required, zero_fill=("TaxiOut",) if batch and self.zero_fill_first else ()
            ),
            stages.time_stage(
                null_as_zero=self.null_as_zero,
                landing_after_takeoff=self.landing_after_takeoff,
                taxi_out=stages.batch_median() if batch else "TaxiOut",
            ),
        ]
        if self.split_clock:
            steps += [stages.split_clock_stage(), stages.drop_clock_stage()]
        return steps

    def encoder_stages(self) -> list[Stage]:
        """Stages that learn from the training rows."""
        steps: list[Stage] = []
        if self.taxi_fill == "fitted":
            steps.append(encoding.MedianFill(["TaxiOut"]))
        assembled = encoding.ALL_FEATURES if self.top_features else encoding.FEATURES
        steps += [
            encoding.string_indexer(self.categories),
            encoding.one_hot_encoder(self.categories),
            encoding.numeric_assembler(self.numerics, self.invalid_numerics),
            encoding.numeric_scaler(),
            encoding.feature_assembler(self.categories, assembled),
        ]
        if self.top_features:
            steps.append(encoding.top_feature_selector(self.top_features))
        return steps

    def workflow(self, *extra: Stage, require_label: bool = True) -> Pipeline:
        """The unfitted pipeline from raw flights to features, then `extra`."""
        return Pipeline(stages=self.row_stages(require_label) + self.encoder_stages() + list(extra))

    def model_columns(self) -> list[str]:
        return [*self.categories, *self.numerics, LABEL]


# The feature lists of the three recipes.
_FIVE_CATEGORIES = ("UniqueCarrier", "Origin", "Dest", "Month", "DayOfWeek")
_TEN_NUMERICS = (
    "DepDelay",
    "TaxiOut",
    "Distance",
    "CRSElapsedTime",
    "LandingEst",
    "TakeOffTime",
    "DayofMonth",
    "Year",
    "CRSDepTime",
    "CRSArrTime",
)
_FOURTEEN_NUMERICS = (
    "DepDelay",
    "TaxiOut",
    "Distance",
    "CRSElapsedTime",
    "LandingEstMinute",
    "TakeOffTimeMinute",
    "CRSDepTimeMinute",
    "CRSArrTimeMinute",
    "DepTimeMinute",
    "LandingEstHour",
    "TakeOffTimeHour",
    "CRSDepTimeHour",
    "CRSArrTimeHour",
    "DepTimeHour",
)
_FEW_REQUIRED = ("CRSDepTime", "CRSArrTime", LABEL)

# Calendar columns as categories, clock times as hours and minutes.
DETAILED = Recipe(
    categories=(*_FIVE_CATEGORIES, "DayofMonth", "Year"),
    numerics=_FOURTEEN_NUMERICS,
    required=REQUIRED_COLUMNS,
    zero_fill_first=True,
    split_clock=True,
)

# Clock times as HHmm numbers, landing from the schedule, few required columns.
COMPACT = Recipe(
    categories=_FIVE_CATEGORIES,
    numerics=_TEN_NUMERICS,
    required=_FEW_REQUIRED,
    landing_after_takeoff=False,
)

# The compact columns without any fill, cut to the 20 strongest features.
SELECTED = Recipe(
    categories=_FIVE_CATEGORIES,
    numerics=_TEN_NUMERICS,
    required=_FEW_REQUIRED,
    taxi_fill="none",
    null_as_zero=False,
    landing_after_takeoff=False,
    invalid_numerics="error",
    top_features=20,
)

RECIPES = {"detailed": DETAILED, "compact": COMPACT, "selected": SELECTED}
