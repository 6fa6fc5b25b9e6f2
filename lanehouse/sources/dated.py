"""Tables kept in a folder per day, of which aged days leave as folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lanehouse.session import remove_folder, settle

DAY = "day"


def write_dated(df: DataFrame, path: str, age: str) -> None:
    """Write a new table with a folder per day of ``age``; fails when the destination exists."""
    dated = df.withColumn(DAY, F.col(age).cast("date"))
    dated.repartition(DAY).write.partitionBy(DAY).parquet(path)


def read_dated(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields]).add(DAY, "date")).parquet(path)


def drop_aged(
    spark: SparkSession,
    path: str,
    schema: StructType,
    age: str,
    cutoff: Column,
    kept: DataFrame | None = None,
) -> int:
    """Remove the rows at or before the cutoff for good, but for those at a ``kept`` instant; how many went.

    Days that age whole leave as folders, and their rows are counted without reading a column. Only the day
    of the cutoff and the days of kept instants are read and written again, beside the table until all of
    it is there. Files of other days stay as they are. NULL among the kept instants keeps every row, and
    rows without an age stay. A clean-up that is lost on the way can be run again.
    """
    table = read_dated(spark, path, schema)
    until = spark.range(1).select(cutoff.cast("date").alias(DAY)).first()[DAY]
    instants = spark.createDataFrame([], "_last timestamp_ntz")
    if kept is not None:
        instants = settle(kept.select(F.col("last").alias("_last")).distinct(), "kept")
        if not instants.where(F.col("_last").isNull()).isEmpty():
            return 0
    # days are folders of the table, which the planner lists anyway
    day_of = F.col("_last").cast("date")
    of_kept = {r[0] for r in instants.where(day_of <= F.lit(until)).select(day_of).distinct().collect()}
    present = {r[0] for r in table.where(F.col(DAY) <= F.lit(until)).select(DAY).distinct().collect()}
    mixed = present & (of_kept | {until})
    whole = present - mixed
    removed = table.where(F.col(DAY).isin(list(whole))).count()
    going, rewritten = set(whole), []
    if mixed:
        aged = F.coalesce(F.col(age) <= cutoff, F.lit(False))
        marked = table.where(F.col(DAY).isin(list(mixed))).join(instants, F.col(age) == F.col("_last"), "left")
        rows = settle(marked.withColumn("_stays", ~aged | F.col("_last").isNotNull()), "mixed-days")
        per_day = rows.groupBy(DAY).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_stays")).alias("stay")
        )
        for day, n, stay in per_day.collect():
            removed += n - stay
            if stay == 0:
                going.add(day)
            elif stay < n:
                rewritten.append(day)
        again = rows.where(F.col("_stays") & F.col(DAY).isin(rewritten)).select(*schema.names, DAY)
        if rewritten:
            writer = again.repartition(DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(DAY).parquet(path)
    for day in going:
        remove_folder(spark, f"{path}/{DAY}={day.isoformat()}")
    return removed
