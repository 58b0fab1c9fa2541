"""Queries: fills, encoding, scaling, feature selection, whole feature recipes."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latebird.catalog import query
from latebird.catalog.flights import (
    CLEAN,
    DEPARTURE_SQL,
    TRAIN_CONDITION,
    check_sql,
    flights,
    hhmm_sql,
)
from latebird.catalog.relational import rounded
from latebird.operators import cleaning, encoding
from latebird.operators.category_index import fit_category_index
from latebird.plans import training
from latebird.plans.recipes import COMPACT, DETAILED, SELECTED, Recipe
from latebird.schema import LABEL, TAKEOFF_COLUMNS
from latebird.session import drop_at_exit, stage_table

# --- Fills -----------------------------------------------------------------

_FILLED = "coalesce({c}, (SELECT quantile_disc({c}, 0.5) FROM flights))"


@query(
    "impute_median",
    check_sql(
        f"""SELECT TaxiOut, DepDelay, {_FILLED.format(c='TaxiOut')} AS TaxiOut_filled,
          {_FILLED.format(c='DepDelay')} AS DepDelay_filled FROM flights"""
    ),
)
def impute_median(spark, sf_dir):
    df = flights(spark, sf_dir).select("TaxiOut", "DepDelay")
    return encoding.impute(["TaxiOut", "DepDelay"]).fit(df).transform(df)


@query(
    "median_fill",
    check_sql(
        f"""SELECT {_FILLED.format(c='TaxiOut')} AS TaxiOut,
          {_FILLED.format(c='DepDelay')} AS DepDelay FROM flights"""
    ),
)
def median_fill(spark, sf_dir):
    df = flights(spark, sf_dir).select("TaxiOut", "DepDelay")
    return encoding.MedianFill(["TaxiOut", "DepDelay"]).fit(df).transform(df)


# --- Categories ------------------------------------------------------------


def _index_ctes(columns: list[str], source: str = "flights") -> list[str]:
    """Per column: its values with their index, and how many there are."""
    return [
        f"""i_{c} AS (
          SELECT CAST({c} AS VARCHAR) AS v,
            row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS i
          FROM {source} WHERE {c} IS NOT NULL GROUP BY {c})"""
        for c in columns
    ]


def _index_joins(columns: list[str], source: str = "flights") -> str:
    return f"{source} f" + "".join(
        f" LEFT JOIN i_{c} ON i_{c}.v = CAST(f.{c} AS VARCHAR)" for c in columns
    )


def _index_of(c: str) -> str:
    return f"CAST(coalesce(i_{c}.i, (SELECT count(*) FROM i_{c})) AS DOUBLE)"


def _index_oracle(columns: list[str]) -> str:
    shown = ", ".join(f"f.{c} AS {c}, {_index_of(c)} AS {c}_idx" for c in columns)
    return check_sql(f"SELECT {shown} FROM {_index_joins(columns)}", *_index_ctes(columns))


def _indexed(spark, sf_dir, columns: list[str]) -> DataFrame:
    df = flights(spark, sf_dir).select(*columns)
    return encoding.string_indexer(columns).fit(df).transform(df)


_TEXT = ["UniqueCarrier", "Origin", "Dest"]
_CALENDAR = ["Month", "DayOfWeek", "DayofMonth", "Year"]


@query("string_index", _index_oracle(_TEXT))
def string_index(spark, sf_dir):
    return _indexed(spark, sf_dir, _TEXT)


@query("string_index_numeric", _index_oracle(_CALENDAR))
def string_index_numeric(spark, sf_dir):
    return _indexed(spark, sf_dir, _CALENDAR)


_WIDE = ["TailNum", "Origin", "DayOfWeek"]


@query("string_index_table", _index_oracle(_WIDE))
def string_index_table(spark, sf_dir):
    """Indices from a dictionary table; 50 frequent values are broadcast, the rest joined."""
    df = flights(spark, sf_dir).select(*_WIDE)
    return fit_category_index(df, _WIDE).transform(df, head=50)


def sparse_form(vector: str):
    """Size and active places of a vector in its sparse form, without unfolding
    it; null for a dense one."""
    parts = F.unwrap_udt(vector)
    return parts.getField("size"), parts.getField("indices")


_ONE_HOT = ["UniqueCarrier", "Month", "Origin"]


@query(
    "one_hot",
    check_sql(
        "SELECT "
        + ", ".join(
            f"""f.{c} AS {c}, CAST((SELECT count(*) FROM i_{c}) AS INT) AS {c}_size,
            CAST(coalesce(i_{c}.i, -1) AS INT) AS {c}_active"""
            for c in _ONE_HOT
        )
        + f" FROM {_index_joins(_ONE_HOT)}",
        *_index_ctes(_ONE_HOT),
    ),
)
def one_hot(spark, sf_dir):
    indexed = _indexed(spark, sf_dir, _ONE_HOT)
    encoded = encoding.one_hot_encoder(_ONE_HOT).fit(indexed).transform(indexed)
    shown = []
    for c in _ONE_HOT:
        size, indices = sparse_form(encoding.one_hot_name(c))
        shown += [
            F.col(c),
            size.alias(f"{c}_size"),
            F.coalesce(F.get(indices, F.lit(0)), F.lit(-1)).alias(f"{c}_active"),
        ]
    return encoded.select(*shown)


# --- Numerics --------------------------------------------------------------

_NUMERICS = ["DepDelay", "TaxiOut", "Distance", "CRSElapsedTime"]
_KEPT = " AND ".join(f"{c} IS NOT NULL" for c in _NUMERICS)


def _slots(df: DataFrame, vector: str) -> DataFrame:
    slots = vector_to_array(vector)
    return df.select(*[slots[i].alias(c) for i, c in enumerate(_NUMERICS)])


def _assembled(df: DataFrame, invalid: str = "skip") -> DataFrame:
    return encoding.numeric_assembler(_NUMERICS, invalid).transform(df.select(*_NUMERICS))


_DOUBLES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NUMERICS)


@query("assembler_skip", check_sql(f"SELECT count(*) AS kept FROM flights WHERE {_KEPT}"))
def assembler_skip(spark, sf_dir):
    kept = _assembled(flights(spark, sf_dir))
    return kept.agg(F.count(encoding.NUMERIC_RAW).alias("kept"))


@query("assemble_numeric", check_sql(f"SELECT {_DOUBLES} FROM flights WHERE {_KEPT}"))
def assemble_numeric(spark, sf_dir):
    return _slots(_assembled(flights(spark, sf_dir)), encoding.NUMERIC_RAW)


@query(
    "assemble_strict",
    check_sql(f"SELECT {_DOUBLES} FROM clean WHERE TaxiOut IS NOT NULL", CLEAN),
)
def assemble_strict(spark, sf_dir):
    complete = cleaning.clean_flights(flights(spark, sf_dir)).where("TaxiOut IS NOT NULL")
    return _slots(_assembled(complete, "error"), encoding.NUMERIC_RAW)


@query(
    "standard_scale",
    check_sql(
        "SELECT "
        + ", ".join(
            f"""round((f.{c} - (SELECT avg({c}) FROM kept)) /
              (SELECT stddev_samp({c}) FROM kept), 6) + 0.0 AS {c}"""
            for c in _NUMERICS
        )
        + " FROM kept f",
        f"kept AS (SELECT {_DOUBLES} FROM flights WHERE {_KEPT})",
    ),
)
def standard_scale(spark, sf_dir):
    assembled = _assembled(flights(spark, sf_dir))
    scaled = encoding.numeric_scaler().fit(assembled).transform(assembled)
    rows = rounded(_slots(scaled, encoding.NUMERIC_SCALED))
    # Adding zero turns a rounded -0.0 into 0.0.
    return rows.select(*[(F.col(c) + F.lit(0.0)).alias(c) for c in _NUMERICS])


# --- Whole recipes ---------------------------------------------------------

_DETAILED_INPUT = """
timed AS (
  SELECT *, coalesce(TaxiOut, 0) AS taxi FROM clean
)"""
_DETAILED_SPLIT = ", ".join(
    f"CAST(floor({value} / 100) AS INT) AS {name}Hour, CAST({value} % 100 AS INT) AS {name}Minute"
    for name, value in {
        "CRSDepTime": "CRSDepTime",
        "CRSArrTime": "CRSArrTime",
        "TakeOffTime": f"{hhmm_sql('DepDelay + taxi')}",
        "LandingEst": f"{hhmm_sql('DepDelay + taxi + CRSElapsedTime')}",
        "DepTime": "coalesce(DepTime, CRSDepTime)",
    }.items()
)
_PLAIN = ", ".join(
    c for c in TAKEOFF_COLUMNS if c not in ("DepTime", "CRSDepTime", "CRSArrTime")
)


def _row_features(df: DataFrame, recipe: Recipe) -> DataFrame:
    return Pipeline(stages=recipe.row_stages()).fit(df).transform(df)


@query(
    "flight_features",
    check_sql(
        f"SELECT {_PLAIN}, TaxiOut, {_DETAILED_SPLIT} FROM timed", CLEAN, _DETAILED_INPUT
    ),
)
def flight_features(spark, sf_dir):
    return _row_features(flights(spark, sf_dir), DETAILED)


@query(
    "flight_features_parity",
    check_sql(
        f"""SELECT {_PLAIN}, (SELECT quantile_disc(taxi, 0.5) FROM timed) AS TaxiOut,
        {_DETAILED_SPLIT} FROM timed""",
        CLEAN,
        _DETAILED_INPUT,
    ),
)
def flight_features_parity(spark, sf_dir):
    return _row_features(flights(spark, sf_dir), DETAILED.parity())


@query(
    "flight_features_compact",
    check_sql(
        f"""SELECT {', '.join(TAKEOFF_COLUMNS)}, TaxiOut, {DEPARTURE_SQL} AS CRSDepTimestamp,
          {hhmm_sql('coalesce(DepDelay, 0) + coalesce(TaxiOut, 0)')} AS TakeOffTime,
          {hhmm_sql('coalesce(CRSElapsedTime, 0)')} AS LandingEst
        FROM flights
        WHERE CRSDepTime IS NOT NULL AND CRSArrTime IS NOT NULL AND ArrDelay IS NOT NULL
          AND Cancelled <> 1"""
    ),
)
def flight_features_compact(spark, sf_dir):
    return _row_features(flights(spark, sf_dir), COMPACT)


_CATEGORIES = list(DETAILED.categories)


@query(
    "assemble_features",
    check_sql(
        f"""SELECT f.ArrDelay AS ArrDelay,
          CAST({' + '.join(f'(SELECT count(*) FROM i_{c})' for c in _CATEGORIES)}
            + {len(DETAILED.numerics)} AS INT) AS n_features,
          CAST(i_UniqueCarrier.i AS INT) AS first_active,
          CAST({len(_CATEGORIES)} AS INT) AS active_categories
        FROM {_index_joins(_CATEGORIES, 'clean')}""",
        CLEAN,
        *_index_ctes(_CATEGORIES, "clean"),
    ),
)
def assemble_features(spark, sf_dir):
    features = _encoded(training.model_rows(flights(spark, sf_dir), DETAILED))
    size, places = sparse_form(encoding.FEATURES)
    form = features.select(LABEL, size.alias("n_features"), places.alias("places"))
    first_numeric = F.col("n_features") - len(DETAILED.numerics)
    return form.select(
        LABEL,
        "n_features",
        F.col("places")[0].alias("first_active"),
        F.size(F.filter("places", lambda x: x < first_numeric)).alias("active_categories"),
    )


def _encoded(rows: DataFrame, other: DataFrame | None = None) -> DataFrame:
    """`other` (by default `rows`) encoded by what is learnt from `rows`, which are
    stored first, so that the learning stages share one narrow table."""
    spark = rows.sparkSession
    stored, path = stage_table(rows, "rows")
    drop_at_exit(spark, path)
    encoder = training.fit_encoder(stored, DETAILED)
    return encoder.transform(stored if other is None else other)


_SHOWN = ["UniqueCarrier", "Origin", "Dest"]


@query(
    "workflow_fit_transform",
    check_sql(
        f"""SELECT f.ArrDelay AS ArrDelay,
          {', '.join(f'{_index_of(c)} AS {c}_idx' for c in _SHOWN)},
          CAST(f.DepDelay AS DOUBLE) AS DepDelay_raw,
          CAST(coalesce(f.TaxiOut, (SELECT quantile_disc(TaxiOut, 0.5) FROM train)) AS DOUBLE)
            AS TaxiOut_raw,
          round((f.DepDelay - (SELECT avg(DepDelay) FROM train)) /
            (SELECT stddev_samp(DepDelay) FROM train), 6) + 0.0 AS DepDelay_scaled,
          CAST({' + '.join(f'(SELECT count(*) FROM i_{c})' for c in _CATEGORIES)}
            + {len(DETAILED.numerics)} AS INT) AS n_features
        FROM {_index_joins(_SHOWN, 'clean')} WHERE NOT ({TRAIN_CONDITION})""",
        CLEAN,
        f"train AS (SELECT * FROM clean WHERE {TRAIN_CONDITION})",
        *_index_ctes(_CATEGORIES, "train"),
    ),
)
def workflow_fit_transform(spark, sf_dir):
    """Fitted on the train part, applied to the test part."""
    train, test = cleaning.hash_split(flights(spark, sf_dir))
    features = _encoded(*(training.model_rows(part, DETAILED) for part in (train, test)))
    raw, scaled = vector_to_array(encoding.NUMERIC_RAW), vector_to_array(encoding.NUMERIC_SCALED)
    return features.select(
        LABEL,
        *[encoding.index_name(c) for c in _SHOWN],
        raw[0].alias("DepDelay_raw"),
        raw[1].alias("TaxiOut_raw"),
        (F.round(scaled[0], 6) + F.lit(0.0)).alias("DepDelay_scaled"),
        sparse_form(encoding.FEATURES)[0].alias("n_features"),
    )


# --- Feature selection -----------------------------------------------------

_CHOICES = list(SELECTED.categories)
_CHOICE_ROWS = f"""
rows AS (
  SELECT *, {hhmm_sql('DepDelay + TaxiOut')} AS TakeOffTime,
    {hhmm_sql('CRSElapsedTime')} AS LandingEst
  FROM clean WHERE TaxiOut IS NOT NULL
), totals AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(ArrDelay) AS DOUBLE) AS sy,
    CAST(sum(ArrDelay * ArrDelay) AS DOUBLE) AS syy FROM rows
)"""


def _before(position: int) -> str:
    sizes = [f"(SELECT count(*) FROM i_{c})" for c in _CHOICES[:position]]
    return " + ".join(sizes) if sizes else "0"


# The correlation of a 0/1 column with the label needs only the group's row
# count and label sum.
_CHOICE_CORRELATIONS = "correlations AS (" + " UNION ALL ".join(
    [
        f"""SELECT {_before(p)} + i AS idx, '{c}_ohe_' || v AS name,
          (n * gy - gn * sy) / sqrt((n * gn - gn * gn) * (n * syy - sy * sy)) AS r
        FROM totals, (
          SELECT CAST({c} AS VARCHAR) AS gv, CAST(count(*) AS DOUBLE) AS gn,
            CAST(sum(ArrDelay) AS DOUBLE) AS gy FROM rows GROUP BY {c}) g
        JOIN i_{c} ON i_{c}.v = g.gv"""
        for p, c in enumerate(_CHOICES)
    ]
    + [
        f"""SELECT {_before(len(_CHOICES))} + {p} AS idx, '{c}' AS name,
          corr({c}, ArrDelay) AS r FROM rows"""
        for p, c in enumerate(SELECTED.numerics)
    ]
) + """), chosen AS (
  SELECT idx, name, r * r AS r2 FROM correlations ORDER BY r * r DESC, idx LIMIT 20
)"""
_CHOICE_CTES = (CLEAN, _CHOICE_ROWS, *_index_ctes(_CHOICES, "rows"), _CHOICE_CORRELATIONS)


def _selection(spark, sf_dir):
    """The selector's input and the fitted selector, over rows without nulls."""
    df = cleaning.clean_flights(flights(spark, sf_dir)).where("TaxiOut IS NOT NULL")
    rows, path = stage_table(training.model_rows(df, SELECTED), "rows")
    drop_at_exit(spark, path)
    *before, selector = training.fit_encoder(rows, SELECTED).stages
    return PipelineModel(before).transform(rows), selector


@query(
    "feature_select_topk",
    check_sql('SELECT CAST(idx AS INT) AS "index", name FROM chosen', *_CHOICE_CTES),
)
def feature_select_topk(spark, sf_dir):
    df, selector = _selection(spark, sf_dir)
    return encoding.selected_features(selector, df, SELECTED.numerics).select("index", "name")


@query(
    "selected_features",
    check_sql(
        """SELECT CAST(idx AS INT) AS "index", name,
          round(r2 / (1 - r2) * (n - 2), 3) AS f_value FROM chosen, totals""",
        *_CHOICE_CTES,
    ),
)
def selected_features(spark, sf_dir):
    df, selector = _selection(spark, sf_dir)
    return rounded(encoding.selected_features(selector, df, SELECTED.numerics), 3)
