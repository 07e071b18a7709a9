"""Tables whose files give one column different types."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CANNOT_MERGE = "CANNOT_MERGE_SCHEMAS"
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMBERS = (*WHOLE, T.FloatType, T.DoubleType, T.DecimalType)
DAYS = (T.DateType, T.TimestampType)


def unmergeable(error: Exception) -> bool:
    """Whether Spark refused to put files with different types of a column under one schema."""
    if isinstance(error, PySparkException) and error.getCondition() is not None:
        if CANNOT_MERGE in error.getCondition():
            return True
    return CANNOT_MERGE in str(error) or "Failed merging schema" in str(error)


def merged_schema(spark: SparkSession, path: str, files: list[str]) -> T.StructType | None:
    """The schema of some files of a table, read from their footers by a Spark job; None where they
    contradict each other."""
    reader = spark.read.option("mergeSchema", True).option("basePath", path)
    try:
        return reader.parquet(*files).schema
    except Exception as error:
        if unmergeable(error):
            return None
        raise


def runs_of_one_schema(
    spark: SparkSession, path: str, files: list[str]
) -> list[tuple[list[str], T.StructType]]:
    """``files``, which are in order, cut into runs that agree.

    A run that does not agree is halved. A type changes on some day and then stays, so the jobs grow
    with the changes times the logarithm of the files, not with the files.
    """
    schema = merged_schema(spark, path, files)
    if schema is not None:
        return [(files, schema)]
    half = len(files) // 2
    return runs_of_one_schema(spark, path, files[:half]) + runs_of_one_schema(
        spark, path, files[half:]
    )


def agree(a: T.StructType, b: T.StructType) -> bool:
    """Whether the columns that two schemas share have the same types."""
    return all(f.name not in b.names or b[f.name].dataType == f.dataType for f in a)


def folder_columns(files: list[str]) -> set[str]:
    """Columns that come from folder names, the same in all files of a table."""
    return {part.split("=")[0] for f in files[:1] for part in f.split("/")[:-1] if "=" in part}


def schema_groups(spark: SparkSession, path: str) -> list[tuple[list[str], T.StructType]]:
    """The files of a table in as few groups as there are types to tell apart, and their schemas.

    Columns that come from folder names have one type in all groups: that of the runs that have a
    value for them (a run of nothing but the folder without one would take them for text).
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    files = sorted(row["path"] for row in listed.select("path").collect())
    runs = runs_of_one_schema(spark, path, files)
    folders: dict[str, T.DataType] = {}
    for _, schema in runs:
        for name in folder_columns(files):
            if name in schema.names and not isinstance(folders.get(name), WHOLE):
                folders[name] = schema[name].dataType
    groups: list[tuple[list[str], T.StructType]] = []
    for run, schema in runs:
        schema = T.StructType(
            [T.StructField(f.name, folders.get(f.name, f.dataType)) for f in schema]
        )
        for i, (held, known) in enumerate(groups):
            if agree(known, schema):
                more = [f for f in schema if f.name not in known.names]
                groups[i] = (held + run, T.StructType(known.fields + more))
                break
        else:
            groups.append((run, schema))
    return groups


def common_type(kinds: list[T.DataType]) -> T.DataType:
    """The type that holds all of some types: the wider number, the stamp of a day, else text."""
    first = kinds[0]
    if all(k == first for k in kinds):
        return first
    if all(isinstance(k, WHOLE) for k in kinds):
        return T.LongType()
    if all(isinstance(k, NUMBERS) for k in kinds):
        return T.DoubleType()
    return T.TimestampType() if all(isinstance(k, DAYS) for k in kinds) else T.StringType()


def read_mixed(spark: SparkSession, path: str) -> DataFrame:
    """All files of a table under one schema, whatever types they give its columns.

    Files that agree are read together; each group's columns are cast to the type that holds those
    of all groups, and columns a group does not have are null. Whole numbers beside fractions become
    fractions, anything beside text becomes text, which the lenient casts of the reports read.
    """
    groups = schema_groups(spark, path)
    kinds: dict[str, list[T.DataType]] = {}
    for _, schema in groups:
        for field in schema:
            kinds.setdefault(field.name, []).append(field.dataType)
    target = {name: common_type(found) for name, found in kinds.items()}
    out = None
    for files, schema in groups:
        df = spark.read.schema(schema).option("basePath", path).parquet(*files)
        df = df.select(*[
            F.col(name).cast(kind).alias(name) if name in df.columns
            else F.lit(None).cast(kind).alias(name) for name, kind in target.items()
        ])
        out = df if out is None else out.unionByName(df)
    return out
