"""The housing-sales recipe: column lists, derived features, and the one-call preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.functions import log1p_or_null
from gablework.operators import encode, impute
from gablework.operators.rows import remove_above, suspicious
from gablework.plans.prep import PrepPlan, PrepRecipe, prepare
from gablework.shared import numeric_columns, string_columns
from gablework.sources.housing import KEY, TARGET

# They name columns and codes of the housing table, and results depend on them.
NONE_COLUMNS = [
    "PoolQC", "MiscFeature", "Alley", "Fence", "FireplaceQu", "GarageType", "GarageFinish", "GarageQual",
    "GarageCond", "BsmtQual", "BsmtCond", "BsmtExposure", "BsmtFinType1", "BsmtFinType2", "MasVnrType",
]
ZERO_COLUMNS = [
    "GarageYrBlt", "GarageArea", "GarageCars", "BsmtFinSF1", "BsmtFinSF2", "BsmtUnfSF", "TotalBsmtSF",
    "BsmtFullBath", "BsmtHalfBath", "MasVnrArea",
]
MODE_COLUMNS = ["Electrical", "KitchenQual", "Exterior1st", "Exterior2nd", "SaleType", "Functional"]
ORDINAL_COLUMNS = [
    "ExterQual", "ExterCond", "BsmtQual", "BsmtCond", "HeatingQC", "KitchenQual", "FireplaceQu", "GarageQual",
    "GarageCond", "PoolQC",
]
LABEL_COLUMNS = [
    "BsmtExposure", "BsmtFinType1", "BsmtFinType2", "GarageFinish", "Fence", "LotShape", "LandContour", "LandSlope",
    "Alley",
]
CATEGORY_COLUMNS = [
    "Neighborhood", "OverallQual", "ExterQual", "BsmtQual", "KitchenQual", "GarageFinish", "FireplaceQu",
]
QUALITY_CODES = {"None": 0, "Po": 1, "Fa": 2, "TA": 3, "Gd": 4, "Ex": 5}
OUTLIER_AREA = 4000
SUSPICIOUS_PRICE = 300000
SKEW_THRESHOLD = 0.75

DERIVED = [
    ("TotalSF", "TotalBsmtSF + `1stFlrSF` + `2ndFlrSF`"),
    ("TotalBathrooms", "FullBath + 0.5D * HalfBath + BsmtFullBath + 0.5D * BsmtHalfBath"),
    ("HouseAge", "YrSold - YearBuilt"),
    ("YearsSinceRemodel", "YrSold - YearRemodAdd"),
    ("Remodeled", "int(coalesce(YearRemodAdd <> YearBuilt, true))"),
    ("TotalPorchSF", "OpenPorchSF + EnclosedPorch + `3SsnPorch` + ScreenPorch"),
    ("HasPool", "int(coalesce(PoolArea > 0, false))"),
    ("HasGarage", "int(coalesce(GarageArea > 0, false))"),
    ("HasBsmt", "int(coalesce(TotalBsmtSF > 0, false))"),
    ("HasFireplace", "int(coalesce(Fireplaces > 0, false))"),
    ("OverallScore", "OverallQual * OverallCond"),
    ("GarageScore", "GarageCars * GarageArea"),
]


def recipe(fit_scope: str = "union", null_key: str = "keep") -> PrepRecipe:
    return PrepRecipe(
        key=KEY,
        target="y",
        drop=["Utilities"],
        outlier_column="GrLivArea",
        outlier_threshold=OUTLIER_AREA,
        fill_text=dict.fromkeys(NONE_COLUMNS, "None"),
        fill_number=dict.fromkeys(ZERO_COLUMNS, 0.0),
        group_median={"LotFrontage": "Neighborhood"},
        group_mode={"MSZoning": "MSSubClass"},
        global_mode=MODE_COLUMNS,
        skew_threshold=SKEW_THRESHOLD,
        derive=DERIVED,
        ordinal=dict.fromkeys(ORDINAL_COLUMNS, QUALITY_CODES),
        labels=LABEL_COLUMNS,
        null_key=null_key,
        fit_scope=fit_scope,
    )


# The steps one by one. Each measures what it needs on the given table and applies it at once;
# a recipe does the same but keeps what it learnt.


def remove_outliers(df: DataFrame, threshold: float = OUTLIER_AREA) -> DataFrame:
    """Rows above the living-area limit leave together with their target; the price is not tested."""
    return remove_above(df, "GrLivArea", threshold)


def outlier_report(df: DataFrame) -> DataFrame:
    """Large houses at a low price."""
    large, cheap = F.col("GrLivArea") > OUTLIER_AREA, F.col(TARGET) < SUSPICIOUS_PRICE
    return suspicious(df, [large, cheap], ["GrLivArea", TARGET, "Neighborhood", "OverallQual"])


def handle_missing_values(df: DataFrame, null_key: str = "keep") -> DataFrame:
    constants = {**dict.fromkeys(NONE_COLUMNS, "None"), **dict.fromkeys(ZERO_COLUMNS, 0)}
    df = df.fillna(constants)
    df = impute.fill_group_median(df, "LotFrontage", ["Neighborhood"], null_key)
    df = impute.fill_group_mode(df, "MSZoning", ["MSSubClass"], null_key)
    return impute.fill_global_mode(df, MODE_COLUMNS).drop("Utilities")


def fix_skewness(df: DataFrame, threshold: float = SKEW_THRESHOLD) -> DataFrame:
    """log1p of the right-skewed numeric columns; key and target stay."""
    return encode.fix_skewness(df, threshold, numeric_columns(df, (KEY, TARGET, "y")))


def engineer_features(df: DataFrame) -> DataFrame:
    """The twelve derived columns beside the given ones."""
    return df.select("*", *[F.expr(e).alias(n) for n, e in DERIVED])


def encode_features(df: DataFrame) -> DataFrame:
    """Quality texts to their rank, nine texts to label codes, all others to 0/1 columns."""
    df = encode.ordinal_encode(df, ORDINAL_COLUMNS, QUALITY_CODES)
    df = encode.label_encode(df, LABEL_COLUMNS)
    return encode.one_hot(df, string_columns(df, ("split",)))


def with_log_target(df: DataFrame) -> DataFrame:
    """``SalePrice`` becomes ``y = log1p(SalePrice)`` in the same row as its key."""
    return df.withColumn("y", log1p_or_null(F.col(TARGET))).drop(TARGET)


def full_preparation(train: DataFrame, test: DataFrame, fit_scope: str = "union") -> tuple[DataFrame, PrepPlan]:
    """Raw train and test to one feature table (Id, split, y, features as double)."""
    return prepare(with_log_target(train), test, recipe(fit_scope))
