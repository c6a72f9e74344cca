"""The raw housing-sales table: schema, reading, and the two result files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.shared import col, quoted

KEY = "Id"
TARGET = "SalePrice"

# The documented columns in file order; d = number that may be missing, i = number, s = text.
COLUMNS = [
    ("MSSubClass", "i"), ("MSZoning", "s"), ("LotFrontage", "d"), ("LotArea", "i"), ("Street", "s"), ("Alley", "s"),
    ("LotShape", "s"), ("LandContour", "s"), ("Utilities", "s"), ("LotConfig", "s"), ("LandSlope", "s"),
    ("Neighborhood", "s"), ("Condition1", "s"), ("Condition2", "s"), ("BldgType", "s"), ("HouseStyle", "s"),
    ("OverallQual", "i"), ("OverallCond", "i"), ("YearBuilt", "i"), ("YearRemodAdd", "i"), ("RoofStyle", "s"),
    ("RoofMatl", "s"), ("Exterior1st", "s"), ("Exterior2nd", "s"), ("MasVnrType", "s"), ("MasVnrArea", "d"),
    ("ExterQual", "s"), ("ExterCond", "s"), ("Foundation", "s"), ("BsmtQual", "s"), ("BsmtCond", "s"),
    ("BsmtExposure", "s"), ("BsmtFinType1", "s"), ("BsmtFinSF1", "d"), ("BsmtFinType2", "s"), ("BsmtFinSF2", "d"),
    ("BsmtUnfSF", "d"), ("TotalBsmtSF", "d"), ("Heating", "s"), ("HeatingQC", "s"), ("CentralAir", "s"),
    ("Electrical", "s"), ("1stFlrSF", "i"), ("2ndFlrSF", "i"), ("LowQualFinSF", "i"), ("GrLivArea", "i"),
    ("BsmtFullBath", "d"), ("BsmtHalfBath", "d"), ("FullBath", "i"), ("HalfBath", "i"), ("Bedroom", "i"),
    ("Kitchen", "i"), ("KitchenQual", "s"), ("TotRmsAbvGrd", "i"), ("Functional", "s"), ("Fireplaces", "i"),
    ("FireplaceQu", "s"), ("GarageType", "s"), ("GarageYrBlt", "d"), ("GarageFinish", "s"), ("GarageCars", "d"),
    ("GarageArea", "d"), ("GarageQual", "s"), ("GarageCond", "s"), ("PavedDrive", "s"), ("WoodDeckSF", "i"),
    ("OpenPorchSF", "i"), ("EnclosedPorch", "i"), ("3SsnPorch", "i"), ("ScreenPorch", "i"), ("PoolArea", "i"),
    ("PoolQC", "s"), ("Fence", "s"), ("MiscFeature", "s"), ("MiscVal", "i"), ("MoSold", "i"), ("YrSold", "i"),
    ("SaleType", "s"), ("SaleCondition", "s"),
]
# The texts that mean "missing" in the source files.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Names in the public files, and those of their description.
OTHER_NAMES = {"BedroomAbvGr": "Bedroom", "KitchenAbvGr": "Kitchen"}
_KINDS = {"i": T.IntegerType(), "d": T.DoubleType(), "s": T.StringType()}


def schema(with_target: bool) -> T.StructType:
    fields = [T.StructField(KEY, T.LongType())]
    fields += [T.StructField(n, _KINDS[k]) for n, k in COLUMNS]
    return T.StructType(fields + ([T.StructField(TARGET, T.DoubleType())] if with_target else []))


def read_csv(spark: SparkSession, path: str, wanted: T.StructType) -> DataFrame:
    """Header CSV with a fixed schema. All fields are read as text first, so that
    a missing-token in a number is NULL too; a text that is no number at all fails
    the read. NaN never gets in."""
    header = spark.read.csv(path, header=True).columns
    names = [OTHER_NAMES.get(c, c) for c in header]
    if sorted(names) != sorted(f.name for f in wanted):
        raise ValueError(f"columns that differ from the schema: {sorted(set(names) ^ {f.name for f in wanted})}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    raw = spark.read.schema(text).csv(path, header=True, enforceSchema=False).toDF(*names)
    missing = ", ".join(f"'{t}'" for t in NA_TOKENS)

    def typed(f: T.StructField) -> str:
        x = quoted(f.name) if isinstance(f.dataType, T.StringType) else f"trim({quoted(f.name)})"
        return f"CAST(CASE WHEN {x} NOT IN ({missing}) THEN {x} END AS {f.dataType.simpleString()}) AS {quoted(f.name)}"

    return raw.selectExpr(*[typed(f) for f in wanted])


def read_sales(spark: SparkSession, path: str, with_target: bool = True) -> DataFrame:
    return read_csv(spark, path, schema(with_target))


def nan_to_null(df: DataFrame) -> DataFrame:
    """One marker for missing: NaN becomes NULL in floating columns."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.when(~F.isnan(col(f.name)), col(f.name)).alias(f.name) if isinstance(f.dataType, floating) else col(f.name)
            for f in df.schema
        ]
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The prepared table, key and target beside the features. CSV gets a header."""
    writer = df.write.mode("overwrite")
    writer.csv(path, header=True) if fmt == "csv" else writer.format(fmt).save(path)


def read_target(spark: SparkSession, path: str, key: str, target: str) -> DataFrame:
    """(key, target) alone: column pruning instead of a separate one-column file."""
    return spark.read.parquet(path).select(quoted(key), quoted(target))


def submission(df: DataFrame, key: str, predicted: Column, name: str = TARGET) -> DataFrame:
    """(key, price): predictions on the log1p scale brought back to prices."""
    return df.select(col(key), F.expm1(predicted).alias(name))


def write_submission(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)
