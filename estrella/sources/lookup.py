"""Small lookup (seed) tables: a header CSV with an explicit schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column layout of the development-group seed.
GROUP_SEED_SCHEMA = T.StructType(
    [
        T.StructField("GRUPO", T.StringType(), True),
        T.StructField("DESARROLLO_CORTO", T.StringType(), True),
        T.StructField("DESARROLLO_LARGO", T.StringType(), True),
        T.StructField("GRUPO_2", T.StringType(), True),
    ]
)


def read_seed_csv(spark: SparkSession, path: str, schema: T.StructType = GROUP_SEED_SCHEMA) -> DataFrame:
    """Read a header CSV seed (UTF-8) with declared columns, names lower-cased."""
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return df.toDF(*[c.lower() for c in df.columns])


# What is folded before two spellings are compared.
ACCENTED, PLAIN = "ÁÉÍÓÚÜÑ", "AEIOUUN"


def fold(c: str) -> Column:
    """Text for comparing spellings: upper case, single inner and no outer blanks, no accents;
    blank text is null."""
    squeezed = F.regexp_replace(F.trim(F.col(c)), r"\s+", " ")
    return F.nullif(F.translate(F.upper(squeezed), ACCENTED, PLAIN), F.lit(""))


def seed_findings(seed: DataFrame, pair: tuple[str, str], group: str) -> DataFrame:
    """problem, the seed's columns, and n: the rows of a lookup that break its contract.

    ``blank``: a part of the pair or the group is missing; ``repeated_pair``: the folded pair
    is on ``n`` rows, so that a join on it would repeat rows; ``group_spelling``: the folded
    group is written in ``n`` ways. A row is returned once for each problem that it has.
    """
    a, b = (fold(c) for c in pair)
    rows = seed.select("*", a.alias("__a"), b.alias("__b"), fold(group).alias("__g"))
    whole = F.col("__a").isNotNull() & F.col("__b").isNotNull()
    blank = rows.where(~whole | F.col("__g").isNull()).withColumn("n", F.lit(1).cast("bigint"))
    pairs = rows.where(whole).groupBy("__a", "__b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    spellings = rows.where("__g is not null").groupBy("__g").agg(F.countDistinct(group).alias("n")).where("n > 1")
    found = {
        "blank": blank,
        "repeated_pair": rows.join(pairs, ["__a", "__b"]),
        "group_spelling": rows.join(spellings, "__g"),
    }
    parts = [df.select(F.lit(name).alias("problem"), *seed.columns, "n") for name, df in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def accepted_seed(seed: DataFrame, pair: tuple[str, str], group: str) -> DataFrame:
    """A lookup that is unique on its folded pair: rows with a blank part or group are left
    out, and of several rows of a pair the one with the greatest group stays."""
    folded = seed.select(*[fold(c).alias(c) for c in pair], fold(group).alias(group)).dropna()
    return folded.groupBy(*pair).agg(F.max(group).alias(group))
