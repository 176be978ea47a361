"""Session helpers: checkpoints in shared storage, key-skew-proof joins, table access."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A key is hot when it holds more than 1/HOT_SHARE of all rows, so there are fewer than HOT_SHARE hot keys
#: whatever the input: that bound is what makes broadcasting the rows of hot keys safe.
HOT_SHARE = 256


#: All characters that Unicode calls white space.
WHITE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is used only in local mode, where driver and
    executors are one machine; elsewhere a missing setting is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = sc.getConf().get("spark.checkpoint.dir")
        if where is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            where = tempfile.mkdtemp(prefix="evspark-checkpoint-")
        sc.setCheckpointDir(where)
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame, tidy: bool = False) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    ``tidy`` removes the shuffle files of the plan as soon as it is written: nothing reads them again, as the lineage is cut.
    """
    checkpoint_dir(df.sparkSession)
    if not tidy:
        return df.checkpoint(eager=True)
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, "false")
    conf.set(name, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # what is removed is settled when a plan is made
    finally:
        conf.set(name, before)


def blank_to_null(column: Column) -> Column:
    """The string without outer white space; NULL if it is missing, whether as NULL, empty or white space."""
    trimmed = F.btrim(column, F.lit(WHITE))
    return F.when(trimmed != "", trimmed)


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, counts: DataFrame, how: str = "left") -> DataFrame:
    """Join ``rows`` to ``lookup`` (at most one row a key) without sending a hot key to one task.

    ``counts`` has (key, n): the number of rows of each key. Keys with more than 1/HOT_SHARE of the rows number
    fewer than HOT_SHARE, so their lookup rows are broadcast; all other keys take the shuffle join.
    """
    total = counts.agg(F.sum("n").alias("_total"))
    hot = (
        counts.crossJoin(F.broadcast(total))  # one row
        .where(F.col("n") * HOT_SHARE > F.col("_total"))
        .select(F.col(key).alias("_hot"))
    )
    marked = rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot")), "left")
    hot_side = marked.where(F.col("_hot").isNotNull()).drop("_hot")
    cold_side = marked.where(F.col("_hot").isNull()).drop("_hot")
    hot_lookup = lookup.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left_semi")
    return cold_side.join(lookup, key, how).unionByName(hot_side.join(F.broadcast(hot_lookup), key, how))


def pairs_within(rows: DataFrame, keys: list[str], name: str, block: int = 500) -> DataFrame:
    """(keys, name_a, name_b): every pair of different values of ``name`` within a class, the smaller first.

    The values of a class are dealt to blocks of about ``block``: each task pairs one block with the class, never a
    large class with itself.
    """
    rows = checkpoint(rows.select(*keys, name))
    size = checkpoint(rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1"))
    sized = rows.join(size, keys)
    salts = F.ceil(F.col("_n") / block).cast("int")
    left = sized.select(*keys, F.col(name).alias(name + "_a"), F.pmod(F.xxhash64(name), salts).cast("int").alias("_salt"))
    right = sized.select(*keys, F.col(name).alias(name + "_b"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt"))
    return left.join(right, [*keys, "_salt"]).where(F.col(name + "_a") < F.col(name + "_b")).drop("_salt")


def numbered(df: DataFrame, name: str, *order: str, start: int = 1) -> DataFrame:
    """Rows with their number in an order, without sorting them in one task.

    Ranges are sorted apart and written to a checkpoint, so that they are the same when they are counted and when they
    are numbered; the offsets come from one row a range.
    """
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = checkpoint(sorted_.withColumns({"_range": F.spark_partition_id(), "_place": place}))
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")  # one row a range
    offsets = sizes.select("_range", before.alias("_before"))
    return rows.join(F.broadcast(offsets), "_range").withColumn(name, F.col("_before") + F.col("_place") + start).drop("_range", "_place", "_before")
