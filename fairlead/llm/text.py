"""Helpers shared by the document operators: sessions, Arrow batches, words, hashes."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Odd multiplier of the wrapping polynomial hashes, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    file = Path(tempfile.mkdtemp(prefix="fairlead-")) / f"{root.name}.zip"
    with zipfile.ZipFile(file, "w") as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, source.relative_to(root.parent))
    context.addPyFile(str(file))
    _SHIPPED.add(context.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def is_local(master: str) -> bool:
    """Whether a master runs everything on this machine, in one process."""
    return master == "local" or master.startswith("local[")


#: Broadcasts of a pipeline stage, to be given back when the stage is written.
_SENT: list = []


def sent(spark: SparkSession, value):
    """A broadcast that `release` can give back."""
    out = spark.sparkContext.broadcast(value)
    _SENT.append(out)
    return out


def release(spark: SparkSession) -> None:
    """Take the broadcasts so far from the executors; a query that still needs one sends it again. The driver's own
    garbage goes too, and with it the shuffle files and blocks of finished stages that only it keeps alive."""
    while _SENT:
        _SENT.pop().unpersist()
    gc.collect()
    trim()
    spark.sparkContext._jvm.System.gc()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir). Where that is unset, a new folder of this machine
    in local mode; anywhere else this raises, since executors would not see it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="fairlead-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder and read from there from now on."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def trim() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def trimmed(run):
    """`run` over batches, freed memory given back to the system at its end: workers live on from stage to stage of
    a pipeline, and what they keep is missing to the executor's heap."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trim()

    return tidy


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about `limit` bytes of `column`, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words `[^\\x20\\x09-\\x0D]+` of all texts: words per text, word offsets, bytes without white space."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    values = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    sizes = pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    full = np.concatenate([[0], np.cumsum(sizes > 0)])
    counts = full[offsets[1:]] - full[offsets[:-1]]
    data = b"" if not len(values) else values.buffers()[2]
    first = 0
    if len(values):
        wide = pa.types.is_large_string(values.type)
        first = int(np.frombuffer(values.buffers()[1], np.int64 if wide else np.int32)[values.offset])
    at = np.concatenate([[0], np.cumsum(sizes[sizes > 0])]).astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8)[first : first + at[-1]] if data else np.zeros(0, np.uint8)
    return counts.astype(np.int64), at, bytes_


_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int, kind: str = "up") -> np.ndarray:
    """BASE**i ("up") or its inverse ("down") modulo 2**64 for i < n at least."""
    have = _POWERS[kind]
    while len(have) < n:
        step = pow(BASE if kind == "up" else BASE_INVERSE, len(have), 1 << 64)
        have = np.concatenate([have, have * np.uint64(step)])
    _POWERS[kind] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A well-stirred 64-bit hash of each 64-bit value."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Wrapping polynomial prefix sums, one more than values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * powers(len(values))[: len(values)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of values first..last-1, the same wherever the span stands."""
    return mix((prefix[last] - prefix[first]) * powers(len(prefix), "down")[first])


def word_hashes(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    prefix = prefix_hashes(data + np.uint64(1))
    return span_hashes(prefix, offsets[:-1], offsets[1:])
