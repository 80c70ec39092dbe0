"""Session helpers shared by the bench, the tests and the iterative operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", **settings: str) -> SparkSession:
    """Local session used by tests and the bench; a cluster passes its own session instead.

    ``settings`` are further Spark settings, with underscores for the dots of their names.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("_", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the session names in ``spark.checkpoint.dir`` for driver and executors alike.

    Only a local session without that setting gets a folder of its own; on a cluster a missing folder is an
    error, because a machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="tallyloom-checkpoint-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def fingerprint(spark: SparkSession, folder: str, *names: str) -> str:
    """Paths, sizes and times of the files of some tables: what is stored from them holds while this stays the same."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
        store = path.getFileSystem(conf)
        files = store.listStatus(path)
        found += sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files)
    return repr(found)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of an iterative job with a reliable checkpoint.

    The folder is the one the session names in ``spark.checkpoint.dir``. Only a local session without
    that setting gets a folder of its own; on a cluster a missing folder is an error, because a
    machine-local folder would be lost with its executor.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="tallyloom-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


# Fixed layouts of the given tables: declared, so that opening a table starts no schema inference job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")
