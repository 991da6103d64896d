"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
NULL_ID = -(2**63) + 1
#: Places in a bitmap of keys: 1,024 rows of 4 KB at most, whatever the input.
PLACES = 1 << 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """The folder that all executors share.  Only a local master may go without: then it is a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="brackish-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes df as a Parquet table in the shared folder and reads it again."""
    spark = df.sparkSession
    path = f"{scratch(spark).rstrip('/')}/brackish-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables made by `written` that nothing reads any more."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.written_at)
        path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def settle(spark: SparkSession) -> None:
    """Lets the driver drop finished queries, so that Spark's cleaner removes their shuffle files now, not at the next full collection, and hands freed memory back."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)
    spark._jvm.java.lang.System.gc()
    trim_jvm(spark)


def trim_jvm(spark: SparkSession) -> None:
    """The same for the driver's JVM: its compilers and buffers leave freed memory in the C library's pools, which no collection hands back.

    The command is reached through its public interface; a JVM that has none goes without."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    named = jvm.java.lang.Class.forName
    try:
        kinds, values = gateway.new_array(jvm.java.lang.Class, 4), gateway.new_array(jvm.java.lang.Object, 4)
        for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = named(kind)
        values[0], values[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        named("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), values)
    except Py4JError:
        pass


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def column(name: str) -> Column:
    """A column by its literal name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_key(id_col: Column, text: Column) -> list[Column]:
    """Two columns that name a row: rows equal in id and text share them, and share their fate."""
    return [F.coalesce(id_col.cast("long"), F.lit(NULL_ID)).alias("k_id"), F.xxhash64(id_col.isNull(), text).alias("k_th")]


def place_of(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(PLACES)) + 1


def bitmap(places: DataFrame, name: str) -> DataFrame:
    """places: a column h of `place_of`.  -> (at, bits), small enough to broadcast by the bound of PLACES."""
    return written(places.groupBy(F.bitmap_bucket_number("h").alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("bits")), name)


def marked(rows: DataFrame, bits: DataFrame, *keys: str) -> DataFrame:
    """The rows whose keys' place is set: all whose keys are in the bitmap, and few others while it is sparse."""
    h, names = place_of(*keys), rows.columns
    byte = F.conv(F.hex(F.substring("bits", (F.shiftright(F.bitmap_bit_position(h), 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    one = F.call_function("shiftright", byte, F.bitmap_bit_position(h).bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1
    return rows.withColumn("at", F.bitmap_bucket_number(h)).join(F.broadcast(bits), "at").where(one).select(*names)
