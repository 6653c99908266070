"""Sources and sinks of the pipeline.

The reference hands data between steps as CSV files in one folder per
client.  Here a client is a partition value: inputs are read once for all
clients, outputs are written partitioned, and the manifest / folder logic
only decides *which paths* one scan reads.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosecast.functions.months import lenient_date

# Fixed values of the reference's input layout: the manifest file in each
# client folder, the roles it names and the columns that the pipeline reads
# of each (kinds: l long, d double, s string, ts timestamp, key yyyymmdd date).
MANIFEST_NAME = "STEinputFiles.json"
ROLE_COLUMNS = {
    "df_tranx": "hdp_shardid:l skclientkey:l medid:s medfullname:s device_naturalkey:l dispensingdevicename:s "
                "transactionlocaldatetime:ts transactionquantity:d actualbegincount:d",
    "unitcost": "hdp_shardid:l clientkey:l medid:s unitcost:d",
    "usage": "hdp_shardid:l clientkey:l medid:s devicename:s device_naturalkey:l year_month:l avgdailyusage30:d",
    "inv_eed_ssflag": "hdp_shardid:l skclientkey:l lastday_of_month:key medid:s dispensingdevicename:s "
                      "devicetypekey:l meditemflag:l device_naturalkey:l isinactive:l inventoryquantity:d "
                      "earliestnextexpirationdate:key standardstockwithindispensingdeviceflag:l "
                      "max_par_level:d min_par_level:d",
    "all_mednames": "skclientkey:l medid:s medfullname:s",
    "all_devicenames": "skclientkey:l device_naturalkey:l dispensingdevicename:s",
}
PIPELINE_ROLES = ("df_tranx", "usage", "inv_eed_ssflag", "unitcost")
# Renames on reading: the extracts name the client and the device differently.
RENAMES = {"clientkey": "skclientkey", "devicename": "dispensingdevicename"}


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """S3: the JSON manifest (role -> file name) as a one-row DataFrame."""
    return spark.read.option("multiLine", True).json(path)


def _file_system(path: str):
    """Hadoop's file system of ``path`` (local, HDFS, object store) and the path in it."""
    spark = SparkSession.getActiveSession()
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def manifest_paths(manifest_file: str) -> dict[str, str]:
    """S3: role -> path, from any store that Spark reads (a few bytes of metadata)."""
    spark = SparkSession.getActiveSession()
    m = json.loads(spark.read.text(manifest_file, wholetext=True).first().value)
    base = manifest_file.rsplit("/", 1)[0]
    return {k: f"{base}/{v}" for k, v in m.items()}


def client_folders(root: str, skip: tuple = ("all_data",)) -> list[tuple[int, str]]:
    """Client sub-folders; the key is the first five characters of the name.

    A folder that is neither listed in ``skip`` nor begins with a key is an error:
    leaving it out would lose a client without a word.
    """
    fs, p = _file_system(root)
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if not st.isDirectory() or name in skip:
            continue
        if not name[:5].isdigit():
            raise ValueError(f"{root}: folder {name!r} does not begin with a client key (list it in skip)")
        out.append((int(name[:5]), st.getPath().toString()))
    return sorted(out)


def read_role(spark: SparkSession, root: str, role: str, folders=None) -> DataFrame:
    """S1 + S4: one scan over every client folder's file of ``role``.

    All clients run in one job; ``client_folder_key`` comes from the file path.
    Columns are taken by name from the header (every file must have the same),
    typed as ``ROLE_COLUMNS`` says and renamed; a value that does not parse is null.
    A folder without a manifest, or a manifest without the role, is an error.
    """
    paths = []
    for key, folder in (client_folders(root) if folders is None else folders):
        names = manifest_paths(f"{folder}/{MANIFEST_NAME}")
        if role not in names:
            raise ValueError(f"the manifest of client {key} names no file for {role!r}")
        paths.append(names[role])
    df = spark.read.options(header=True, enforceSchema=False).csv(paths)
    cols = []
    for tok in ROLE_COLUMNS[role].split():
        name, kind = tok.split(":")
        c = F.col(name)
        c = {"s": lambda x: x, "l": lambda x: x.try_cast("double").cast("long"), "d": lambda x: x.try_cast("double"),
             "ts": lambda x: x.try_cast("timestamp_ntz"), "key": lenient_date}[kind](c)
        cols.append(c.alias(RENAMES.get(name, name)))
    key = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{5})[^/]*/[^/]*$", 1).cast("long")
    return df.select(*cols, key.alias("client_folder_key"))


def read_written_panels(spark: SparkSession, pattern: str, schema) -> DataFrame:
    """Previously written panels of all clients; the key is taken from the file name."""
    df = spark.read.schema(schema).option("header", True).csv(pattern)
    return df.withColumn("file_client", F.regexp_extract(F.col("_metadata.file_path"), r"df_all_(\d+)", 1)
                         .cast("long"))


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create-table-as-select with drop-if-exists = overwrite."""
    w = df.write.mode("overwrite")
    if path:
        w.option("path", path)
    w.saveAsTable(name)


def write_results(df: DataFrame, path: str, partition_cols=("skclientkey", "test_month")) -> None:
    """Result sinks partitioned by client and, where the table has one, test month.

    Only the partitions that ``df`` holds are replaced: the other clients' results stay.
    """
    cols = [c for c in partition_cols if c in df.columns]
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*cols).parquet(path))
