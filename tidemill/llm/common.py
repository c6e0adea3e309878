"""Shared helpers: work tables in the shared folder, the word definition, row ids, file access from tasks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import work_path

#: A word is a run of characters other than space and \t \n \v \f \r.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
MASK = (1 << 64) - 1
#: Deletes the shuffle files of a query when it ends, not when the driver happens to collect garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def arrow_limits(spark: SparkSession) -> None:
    """Bounds the Arrow batches that reach Python: a batch of long texts must not fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def materialize(df: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """Writes rows to a table in the shared folder and reads them back: lineage ends here, results survive lost executors."""
    return store(df, purpose, *partition_by)[0]


def store(df: DataFrame, purpose: str, *partition_by: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = work_path(spark, f"llm-{purpose}")
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    # nothing reads the write's own shuffle files once the table stands
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a work table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def with_row_id(docs: DataFrame, purpose: str) -> DataFrame:
    """(row, rid): each row as a struct, and an id that is unique and the same in every pass over the rows.

    Rows of a plain file scan are named by their file and place in it. Others are written once to a table, whose rows keep the number
    they got.
    """
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation" and "_metadata" not in docs.columns:
        try:
            return docs.select(F.struct("*").alias("row"), F.struct("_metadata.file_path", "_metadata.row_index").alias("rid"))
        except AnalysisException:
            pass  # a source without row numbers
    return materialize(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("rid")), purpose)


def text_of(name: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def bucket_of_id(divisor: int, name: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo divisor; null for a null id."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % F.lit(divisor)


def mix64(x: int) -> int:
    """splitmix64 finaliser on one integer."""
    x = (x + 0x9E3779B97F4A7C15) & MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def mix64_array(x):
    """splitmix64 finaliser on a numpy array of unsigned 64-bit integers."""
    import numpy as np
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word -> XXH64 of its bytes with A-Z in lower case, remembered up to a bound so that frequent words are hashed once per task."""

    def __init__(self, seed: int = 42, bound: int = 200_000):
        super().__init__()
        self.seed, self.bound = seed, bound

    def __missing__(self, word: str) -> int:
        import xxhash
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass").lower(), self.seed)
        return value


def shingle_hashes(hashes, width: int):
    """Hashes of all windows of `width` words, repeats kept; fewer words make one window of all of them."""
    import numpy as np
    if len(hashes) == 0:
        return hashes
    take = min(width, len(hashes))
    count = len(hashes) - take + 1
    total = np.zeros(count, np.uint64)
    for k in range(take):
        total = total * np.uint64(0x9FB21C651E98DF25) + mix64_array(hashes[k:k + count] + np.uint64(k + take * 31))
    return mix64_array(total)


def file_system(uri: str):
    """A pyarrow file system and path for a Hadoop URI or a plain path; works in tasks on any executor."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
