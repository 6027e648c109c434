"""Column choice and staging shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.session import work_path

# The white space of the words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def find(df: DataFrame, name: str, missing: int | None = None) -> int:
    """The place of the column that `name` means: an exact match, else the first that ignores case."""
    found = [k for k, n in enumerate(df.columns) if n == name] or [
        k for k, n in enumerate(df.columns) if n.lower() == name.lower()
    ]
    if found:
        return found[0]
    if missing is None:
        raise ValueError(f"no column {name} among {df.columns}")
    return missing


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the wanted columns, as `new_name=source_name`.

    Other columns may have any name, also one that differs from a wanted one by case only: an exact
    match wins over one that ignores case. A missing column is a ValueError.
    """
    plain = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    chosen = [F.col(f"c{find(df, name)}").alias(new) for new, name in columns.items()]
    return plain.select(chosen)


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back: several jobs use it, no executor owns it."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z, all other characters stay. `lower` is the fast way where it does just that."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def stripped(text: Column) -> Column:
    """`text` without white space at both ends."""
    return F.btrim(text, F.lit(SPACES))


def text_marks(text: Column) -> tuple[Column, Column]:
    """128 bits that stand for a text, as two numbers."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def words(text: Column) -> Column:
    """The runs of characters other than white space; null and blank texts have none."""
    core = stripped(F.coalesce(text, F.lit("")))
    none = F.array().cast("array<string>")
    return F.when(core == "", none).otherwise(F.split(core, SPACE_CLASS + "+"))


def bound_to(value: Column, body) -> Column:
    """`body(value)` with `value` computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]
