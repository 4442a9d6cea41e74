"""Removal of repeated word windows by super-k-mer partitioning."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.llm.text import documents, mix, prefix_hashes, ship, sliced, span_hashes, split_words, word_hashes

WINDOW = 20
#: Words of a minimiser.
MINIMISER = 3
CHUNK = 2 << 20
#: Packed text that one bucket should hold; super-k-mers repeat each word about three times.
BUCKET_BYTES = 12 << 20
#: Text of super-k-mers that a map task gathers before it packs them by bucket.
GATHERED = 24 << 20
#: Documents looked at to find minimisers so frequent that they must not name a bucket.
SAMPLE_DOCS = 5_000
#: Windows of the sample from which on a minimiser is called frequent.
FREQUENT = 100
NOTHING = np.uint64(2**64 - 1)
NULL_ID = 2**63 - 1


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values."""
    have, low = 1, x
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    rest = width - have
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def _windows(counts: np.ndarray, offsets: np.ndarray, data: np.ndarray, window: int):
    """First words of all windows, the minimiser of each, and prefix hashes over the words."""
    words = word_hashes(offsets, data)
    prefix = prefix_hashes(words)
    ends = np.cumsum(counts)
    starts = ends - counts
    n = np.maximum(counts - window + 1, 0)
    first = np.arange(n.sum()) + np.repeat(starts - (np.cumsum(n) - n), n)
    return words, prefix, first, starts, np.repeat(np.arange(len(counts)), n)


def _minimisers(words: np.ndarray, window: int, frequent: np.ndarray) -> np.ndarray:
    """By first word of a window: the least hash of its word groups that is not frequent, else NOTHING."""
    m = min(MINIMISER, window)
    at = np.arange(len(words) - m + 1)
    groups = span_hashes(prefix_hashes(words), at, at + m)
    if len(frequent):
        groups[np.isin(groups, frequent)] = NOTHING
    return _sliding_min(groups, window - m + 1)


def frequent_minimisers(docs: DataFrame, window: int) -> np.ndarray:
    """Minimisers of very many windows, from a bounded sample; they steer routing, never the result."""
    ship(docs.sparkSession)
    total = docs.count()
    if not total:
        return np.zeros(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", CHUNK):
            words, _, first, _, _ = _windows(*split_words(batch.column("text")), window)
            if len(first):
                key, n = np.unique(_minimisers(words, window, np.zeros(0, np.uint64))[first], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    some = docs.select("text").sample(min(1.0, SAMPLE_DOCS / total), seed=1)
    counts = some.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    rows = counts.filter(F.col("n") >= FREQUENT).select("key").collect()
    return np.sort(np.array([r.key for r in rows], np.int64).view(np.uint64))


def pack(doc: np.ndarray, text_hash: np.ndarray, start: np.ndarray, sure: np.ndarray, texts: list[bytes]) -> bytes:
    """Super-k-mers of one bucket as one compressed string. sure: the number of windows already known as repeats."""
    head = struct.pack("<q", len(doc)) + np.diff(doc, prepend=0).tobytes() + text_hash.tobytes() + start.tobytes() + sure.tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"\n".join(texts))


def unpack(raw: bytes):
    raw = zstandard.ZstdDecompressor().decompress(raw)
    (n,) = struct.unpack_from("<q", raw)
    at, out = 8, []
    for kind in (np.int64, np.int32, np.int32, np.int32):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return (np.cumsum(out[0]), *out[1:], raw[at:].split(b"\n") if n else [])


class _Gathered:
    """Super-k-mers of some blocks of text; equal ones are kept once."""

    def __init__(self) -> None:
        self.bucket: list[int] = []
        self.key: list[tuple[int, int, int]] = []
        self.sure: list[int] = []
        self.span: list[int] = []
        self.texts: list[bytes] = []
        self.seen: dict[bytes, int] = {}
        self.size = 0

    def add(self, bucket: int, key: tuple[int, int, int], span: int, text: bytes) -> None:
        j = self.seen.setdefault(text, len(self.key))
        sure = 0
        if j == len(self.key):
            self.size += len(text) + 100
        elif key == self.key[j]:
            return  # the same document once more
        else:
            if key < self.key[j]:
                self.sure[j], self.texts[j], self.seen[text] = self.span[j], b"", len(self.key)
            else:
                sure, text = span, b""
            self.size += 100
        self.bucket.append(bucket)
        self.key.append(key)
        self.span.append(span)
        self.sure.append(sure)
        self.texts.append(text)

    def packed(self, buckets: int) -> pa.RecordBatch:
        bucket, sure = np.array(self.bucket, np.int32), np.array(self.sure, np.int32)
        doc, text_hash, start = (np.array(x, t) for x, t in zip(zip(*self.key), (np.int64, np.int32, np.int32)))
        # what is settled already need not crowd the bucket of a frequent passage
        known = sure > 0
        bucket[known] = mix(doc[known].astype(np.uint64)) % np.uint64(buckets)
        order = np.lexsort((start, doc, bucket))
        cuts = [0, *(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(order)]
        keys, out = [], []
        for a, b in zip(cuts, cuts[1:]):
            k = order[a:b]
            keys.append(int(bucket[k[0]]))
            out.append(pack(doc[k], text_hash[k], start[k], sure[k], [self.texts[i] for i in k.tolist()]))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(out, pa.binary())], ["bucket", "packed"])


def super_kmers(docs: DataFrame, window: int, buckets: int, frequent: np.ndarray) -> DataFrame:
    """(bucket, packed): runs of windows that share a minimiser, packed by task and bucket.

    Equal super-k-mers that a task gathers travel once: the earliest goes on, the windows of the
    others are repeats for sure. So a passage in a third of all documents costs a bucket
    one row per gathering, not per document. Windows whose word groups are all frequent go by
    their own hash.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = _Gathered()
        for batch in sliced(batches, "text", CHUNK):
            counts, offsets, data = split_words(batch.column("text"))
            words, prefix, first, starts, row = _windows(counts, offsets, data, window)
            if not len(first):
                continue
            low = _minimisers(words, window, frequent)[first]
            alone = low == NOTHING
            low[alone] = span_hashes(prefix, first[alone], first[alone] + window)
            new = np.ones(len(first), bool)
            new[1:] = (low[1:] != low[:-1]) | (first[1:] != first[:-1] + 1)
            at = np.flatnonzero(new)
            last = first[np.append(at[1:], len(first)) - 1] + window
            n_words = len(offsets) - 1
            spaced = np.full(len(data) + n_words, 32, np.uint8)
            spaced[np.arange(len(data)) + np.repeat(np.arange(n_words), np.diff(offsets))] = data
            whole = spaced.tobytes()
            left = offsets[first[at]] + first[at]
            right = offsets[last] + last - 1
            doc = pc.fill_null(batch.column("doc_id"), NULL_ID).to_numpy()[row[at]]
            text_hash = batch.column("text_hash").to_numpy()[row[at]]
            start = first[at] - starts[row[at]]
            bucket = mix(low[at]) % np.uint64(buckets)
            span = last - first[at] - window + 1
            columns = (x.tolist() for x in (bucket, doc, text_hash, start, span, left, right))
            for b, d, h, s, n, i, j in zip(*columns):
                gathered.add(b, (d, h, s), n, whole[i:j])
            if gathered.size > GATHERED:
                yield gathered.packed(buckets)
                gathered = _Gathered()
        if gathered.key:
            yield gathered.packed(buckets)

    rows = docs.select(F.col("doc_id").cast("long"), F.shiftright(F.xxhash64("text"), 32).cast("int").alias("text_hash"), "text")
    return rows.mapInArrow(run, "bucket int, packed binary")


def _repeats(parts: list[tuple], window: int):
    """(doc_id, text_hash, start, n): runs of windows of one bucket that also start earlier."""
    doc, text_hash, start, sure = (np.concatenate([p[k] for p in parts]) for k in range(4))
    texts = [t for p in parts for t in p[4]]
    known = sure > 0
    out = [(doc[known], text_hash[known], start[known], sure[known])]
    order = np.lexsort((start, text_hash, doc))
    order = order[~known[order]]
    if not len(order):
        return out[0]
    doc, text_hash, start = doc[order], text_hash[order], start[order]
    lists = pc.ascii_split_whitespace(pa.array([texts[i] for i in order.tolist()], pa.binary()).cast(pa.string()))
    ids = lists.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
    ends = lists.offsets.to_numpy()[1:].astype(np.int64)
    counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    n = counts - window + 1
    entry = np.repeat(np.arange(len(n)), n)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    first = (ends - counts)[entry] + inner
    hashes = span_hashes(prefix_hashes(mix(ids.astype(np.uint64) + np.uint64(1))), first, first + window)
    # windows stand in order of document and start; a stable sort keeps the earliest first
    by = np.argsort(hashes, kind="stable")
    same = np.zeros(len(by), bool)
    same[1:] = hashes[by[1:]] == hashes[by[:-1]]
    k = np.flatnonzero(same)
    equal = np.ones(len(k), bool)
    for t in range(window):
        equal &= ids[first[by[k]] + t] == ids[first[by[k - 1]] + t]
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))
    if not equal.all():  # two sequences share a hash: sort these windows by their words
        for h in np.unique(hashes[by[k[~equal]]]):
            group = np.flatnonzero(hashes[by] == h)
            leaders: dict[tuple, int] = {}
            for g in group.tolist():
                head[g] = leaders.setdefault(tuple(ids[first[by[g]] : first[by[g]] + window].tolist()), g)
    lead = np.empty(len(by), np.int64)
    lead[by] = by[head]
    place = start[entry] + inner
    repeat = (lead != np.arange(len(by))) & (
        (doc[entry] != doc[entry[lead]]) | (text_hash[entry] != text_hash[entry[lead]]) | (place != place[lead])
    )
    at = np.flatnonzero(repeat)
    if len(at):
        fresh = np.ones(len(at), bool)
        fresh[1:] = (np.diff(at) != 1) | (np.diff(entry[at]) != 0)
        a = np.flatnonzero(fresh)
        length = np.diff(np.append(a, len(at)))
        w = at[a]
        out.append((doc[entry[w]], text_hash[entry[w]], place[w], length))
    return tuple(np.concatenate([o[k] for o in out]) for k in range(4))


def repeated_runs(docs: DataFrame, window: int = WINDOW, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, text_hash, start, n): n windows from word `start` on that also start earlier.

    doc_id is 2**63 - 1 where the document has none. A task holds one bucket at a time.
    """
    ship(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-3 * size // bucket_bytes))
    packed = super_kmers(docs, window, buckets, frequent_minimisers(docs, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(parts: list[tuple]) -> pa.RecordBatch:
            a = _repeats(parts, window)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(x.astype(t.to_pandas_dtype())) for x, t in zip(a, kinds)], ["doc_id", "text_hash", "start", "n"]
            )

        running, parts = None, []
        for batch in batches:
            for bucket, raw in zip(batch.column("bucket").to_pylist(), batch.column("packed")):
                if bucket != running and parts:
                    yield out(parts)
                    parts = []
                running = bucket
                parts.append(unpack(raw.as_py()))
        if parts:
            yield out(parts)

    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        run, "doc_id long, text_hash int, start int, n int"
    )


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each text without words of windows that also start earlier.

    One row per input row. A null text has no word; a document without doc_id counts as the
    last one; rows of one doc_id with other texts are ordered by their text's hash, and rows
    that repeat both are one document. Words are compared as they are. Other columns are not read.
    """
    ship(docs.sparkSession)
    runs = repeated_runs(docs, window).groupBy(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")
    ).agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    rows = docs.select(
        F.col("doc_id").cast("long"),
        "text",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_key"),
        F.shiftright(F.xxhash64("text"), 32).cast("int").alias("_text_hash"),
    )
    joined = rows.join(runs, (F.col("_key") == F.col("_id")) & (F.col("_text_hash") == F.col("_hash")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", CHUNK):
            totals, removed, kept = [], [], []
            for text, runs in zip(batch.column("text"), batch.column("runs")):
                words = (text.as_py() or "").encode().split()
                gone = np.zeros(len(words) + 1, np.int32)
                if runs.is_valid and len(runs.values):
                    start = runs.values.field("start").to_numpy()
                    np.add.at(gone, start, 1)
                    np.add.at(gone, start + runs.values.field("n").to_numpy() + window - 1, -1)
                    stay = np.cumsum(gone)[:-1] == 0
                    words_left = [words[i] for i in np.flatnonzero(stay).tolist()]
                else:
                    words_left = words
                totals.append(len(words))
                removed.append(len(words) - len(words_left))
                kept.append(b" ".join(words_left).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return joined.select("doc_id", "text", "runs").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
