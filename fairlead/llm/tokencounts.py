"""Token counts of documents in flat token files, by a scan for separators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairlead.llm.text import documents, shared_folder, ship, sliced
from fairlead.llm.tokens import END_OF_TEXT, VOCABULARY, tokenizer, vocabulary_path

#: A stored document begins with its doc_id in five digits, written as ids beyond the vocabulary.
DIGITS, RADIX_BITS = 5, 13
#: First digit of a null doc_id; the ones of 64-bit numbers are smaller.
NO_ID = 1 << 12
CHUNK = 4 << 20
#: Ids of one block of the scan.
BLOCK = 1 << 20
#: Blocks of text per token file at most.
ROWS_PER_FILE = 16


def write_flat(docs: DataFrame, folder: str, path: str | None = None, end: int = END_OF_TEXT) -> None:
    """Flat little-endian 16-bit token files: per document its id digits, its ids, then `end`; no index.

    Spark's text writer puts the raw ids into the shared folder, with `end` as its line
    separator, so a lost task is simply written again. A null doc_id has digits of its own; a
    null text has no ids.
    """
    ship(docs.sparkSession)
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        for batch in sliced(batches, "text", CHUNK):
            counts, flat = words.encode_texts(batch.column("text"))
            known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            key = batch.column("doc_id").fill_null(0).to_numpy().view(np.uint64)
            shift = np.arange(DIGITS - 1, -1, -1, dtype=np.uint64) * np.uint64(RADIX_BITS)
            digits = ((key[:, None] >> shift) & np.uint64((1 << RADIX_BITS) - 1)) + np.uint64(VOCABULARY)
            digits[~known, 0] = VOCABULARY + NO_ID
            size = DIGITS + counts + 1
            begin = np.cumsum(size) - size
            ids = np.empty(size.sum(), "<u2")
            ids[begin[:, None] + np.arange(DIGITS)] = digits
            ids[np.arange(len(flat)) + np.repeat(begin + DIGITS - (np.cumsum(counts) - counts), counts)] = flat
            ids[begin + size - 1] = end
            yield pa.RecordBatch.from_arrays([pa.array([ids[:-1].tobytes()], pa.binary())], ["ids"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "ids binary")
    (
        rows.select(F.col("ids").cast("string").alias("value"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", np.array([end], "<u2").tobytes().decode("latin-1"))
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .text(folder)
    )


def _headed(ids: np.ndarray) -> bool:
    """A stored document begins with these ids."""
    return len(ids) >= DIGITS and bool((ids[:DIGITS] >= VOCABULARY).all())


def _number(digits: np.ndarray) -> int | None:
    """The doc_id of a stored document that begins with these ids."""
    if not _headed(digits) or digits[0] == VOCABULARY + NO_ID:
        return None
    value = 0
    for d in digits[:DIGITS].tolist():
        value = (value << RADIX_BITS) | (d - VOCABULARY)
    value &= (1 << 64) - 1
    return value - (1 << 64) if value >> 63 else value


def scan(spark: SparkSession, folder: str, end: int = END_OF_TEXT, block: int = BLOCK) -> DataFrame:
    """(file, position, doc_id, n_tokens, closed, headed): every document of flat token files.

    Files are cut into blocks; each block is searched for `end` in one vectorised pass.
    Where the document that a block ends with began, and its first ids, come from a prefix
    scan over the block summaries of the file. Each file begins a document; ids after the
    last separator are one that is not closed. n_tokens counts neither digits nor separator.
    headed is false for what follows an `end` within a stored document.
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).filter("length > 0")
    size = 2 * block
    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.col("length") - 1) / size).cast("int")),
        lambda i: F.struct(i.alias("block"), F.substring("content", i * size + 1, F.lit(size)).alias("ids")),
    )
    blocks = files.select("path", F.explode(cut).alias("b")).select("path", "b.block", "b.ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, number, raw in zip(*(batch.column(c) for c in ("path", "block", "ids"))):
                ids = np.frombuffer(raw.as_buffer(), "<u2")
                first = number.as_py() * block
                at = np.flatnonzero(ids == end)
                begins = at[:-1] + 1
                heads = [ids[b : min(b + DIGITS, e)] for b, e in zip(begins.tolist(), at[1:].tolist())]
                names, headed = [_number(h) for h in heads], [_headed(h) for h in heads]
                tail = ids[at[-1] + 1 :] if len(at) else ids[:0]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path.as_py()]), pa.array([number.as_py()], pa.int32()), pa.array([first + len(ids)], pa.int64()),
                        pa.array([(first + at).tolist()], pa.list_(pa.int64())), pa.array([names], pa.list_(pa.int64())),
                        pa.array([headed], pa.list_(pa.bool_())),
                        pa.array([ids[: min(DIGITS, at[0]) if len(at) else DIGITS].tolist()], pa.list_(pa.int32())),
                        pa.array([tail[:DIGITS].tolist()], pa.list_(pa.int32())),
                    ],
                    ["path", "block", "until", "ends", "names", "headed", "lead", "tail"],
                )

    found = blocks.mapInArrow(
        run,
        "path string, block int, until long, ends array<long>, names array<long>, headed array<boolean>, lead array<int>, tail array<int>",
    )
    order = Window.partitionBy("path").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    following = F.coalesce(F.lead("lead").over(order), F.array().cast("array<int>"))
    some = F.size("ends") > 0
    found = found.withColumn(
        "open",
        F.when(some, F.struct((F.element_at("ends", -1) + 1).alias("start"), F.slice(F.concat("tail", following), 1, DIGITS).alias("ids"))),
    ).withColumn("more", following)
    initial = F.first(F.struct(F.lit(0).cast("long").alias("start"), F.slice(F.concat("lead", "more"), 1, DIGITS).alias("ids"))).over(before)
    own = F.struct(F.lit(0).cast("long").alias("start"), F.slice(F.concat("lead", "more"), 1, DIGITS).alias("ids"))
    found = found.withColumn("carried", F.coalesce(F.last("open", ignorenulls=True).over(before), initial, own))
    found = found.withColumn("last", F.lead("block").over(order).isNull())

    def stitched(open_, until, closed):
        """A document whose beginning is known from the scan."""
        numbers = F.transform(open_["ids"], lambda d: (d - VOCABULARY).cast("long"))
        headed = (F.size(numbers) == DIGITS) & (until - open_["start"] >= DIGITS) & ~F.exists(numbers, lambda d: d < 0)
        value = F.aggregate(
            numbers, F.lit(0).cast("long"), lambda a, d: F.shiftleft(a, RADIX_BITS).bitwiseOR(d)
        )
        return F.struct(
            open_["start"].alias("position"),
            F.when(headed & (F.element_at(numbers, 1) != NO_ID), value).alias("doc_id"),
            (until - open_["start"] - F.when(headed, DIGITS).otherwise(0)).cast("long").alias("n_tokens"),
            closed.alias("closed"),
            headed.alias("headed"),
        )

    inner = F.transform(
        F.when(F.size("ends") > 1, F.sequence(F.lit(2), F.size("ends"))).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            (F.element_at("ends", i - 1) + 1).alias("position"),
            F.element_at("names", i - 1).alias("doc_id"),
            (F.element_at("ends", i) - F.element_at("ends", i - 1) - 1
             - F.when(F.element_at("headed", i - 1), DIGITS).otherwise(0)).cast("long").alias("n_tokens"),
            F.lit(True).alias("closed"),
            F.element_at("headed", i - 1).alias("headed"),
        ),
    )
    nothing = F.slice(inner, 1, 0)
    spanning = F.when(some, F.array(stitched(F.col("carried"), F.element_at("ends", 1), F.lit(True)))).otherwise(nothing)
    ending = F.when(some, F.col("open")).otherwise(F.col("carried"))
    unclosed = F.when(
        F.col("last") & (F.col("until") > ending["start"]), F.array(stitched(ending, F.col("until"), F.lit(False)))
    ).otherwise(nothing)
    return found.select("path", F.explode(F.concat(spanning, inner, unclosed)).alias("d")).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "d.position", "d.doc_id", "d.n_tokens", "d.closed", "d.headed"
    )


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens): write the documents as flat token files and count by scanning these.

    One row per document, repeated rows and null doc_id included. The text of the separator
    within a document is one of its tokens: what follows without digits of its own is added to
    the document before. A null or empty text has no token; other columns are not read; an empty table gives no row.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_flat(docs, folder, path)
    so_far = Window.partitionBy("file").orderBy("position")
    pieces = scan(spark, folder).withColumn("document", F.sum(F.col("headed").cast("int")).over(so_far))
    whole = pieces.groupBy("file", "document").agg(
        F.max("doc_id").alias("doc_id"), (F.sum("n_tokens") + F.count("*") - 1).alias("n_tokens")
    )
    return whole.select("doc_id", "n_tokens")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
