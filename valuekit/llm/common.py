"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import struct
import sys
from hashlib import blake2b

import numpy as np
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.session import scratch_path

# Functions of these modules travel inside the task, so executors need no copy
# of the repository on their path.
def ship(module_name: str) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


def kept_in_process(key: tuple, make):
    """What ``make()`` returns, made once in a Python worker and shared by the
    tasks that run in it (for read-only models and bounded caches). What tasks
    of other stages have left goes, unless it has the same key, so a worker that
    is used again does not hold the caches of all stages before."""
    context = TaskContext.get()
    stage = context.stageId() if context else -1
    kept = sys.__dict__.setdefault("_valuekit_kept", {})
    for other in [k for k, (last, _) in kept.items() if last != stage and k != key]:
        del kept[other]
    kept[key] = (stage, kept[key][1] if key in kept else make())
    return kept[key][1]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared checkpoint folder and read
    it back: cuts the lineage in a way that survives lost executors. The
    folder is deleted when the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    deleted_at_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def deleted_at_exit(spark: SparkSession, path: str) -> None:
    folder, fs = _folder(spark, path)
    fs.deleteOnExit(folder)


def dropped(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in tables:
        folder, fs = _folder(df.sparkSession, df.staged_path)
        fs.delete(folder, True)


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def byte_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, as UTF-8 bytes."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHashes(dict):
    """word bytes -> 64-bit hash, kept for words seen before; emptied when it
    holds ``limit`` words, so memory stays bounded on any vocabulary."""

    def __init__(self, limit: int = 400_000, bits: int = 64):
        super().__init__()
        self.limit, self.shift = limit, 64 - bits

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = struct.unpack("<Q", blake2b(word, digest_size=8).digest())[0] >> self.shift
        self[word] = h
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def odd_multipliers(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers drawn from a seeded generator."""
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hash of each run of k consecutive word hashes (k weighted terms)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    weights = odd_multipliers(k, seed)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += words[j:j + n] * weights[j]
    return mix(total)


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """Whether crc32(doc_id as text) mod ``modulus`` is ``remainder``; a null
    doc_id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")) % modulus == remainder
