"""Near-duplicate documents of the pipeline: SimHash with pivot distance tables and MinHash bands name candidates, exact Jaccard
of word shingles decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.llm.components import components
from fairlead.llm.simhash import near_links, one_per_group, routed
from fairlead.llm.text import mix, powers, ship, sliced, split_words, stored, trimmed, word_hashes

#: Words of a shingle, and the Jaccard similarity from which two documents are near copies.
SHINGLE = 5
SIMILARITY = 0.8
#: A pair of similarity J shares no band with probability (1 - J**ROWS) ** BANDS: 0.4 % at 0.8.
BANDS, ROWS = 24, 7
#: Words of 64 parity bits of a set, and bits of a hash that name the word.
PARITIES, PARITY_BITS = 16, 4
CHUNK = 1 << 20
#: Texts to verify that are broadcast at most, by hash.
NARROW = 1_000_000


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles per text, and their hashes in order of text and hash.

    A text of fewer words than a shingle is one shingle; one without words has none.
    """
    counts, offsets, data = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
    padded = np.where(counts > 0, np.maximum(counts, size), 0)
    words = np.zeros(padded.sum(), np.uint64)
    begin = np.cumsum(padded) - padded
    words[np.arange(counts.sum()) + np.repeat(begin - (np.cumsum(counts) - counts), counts)] = word_hashes(offsets, data)
    n = np.maximum(padded - size + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(n.sum()) + np.repeat(begin - (np.cumsum(n) - n), n)
    factor = powers(size + 1)
    hashes = np.zeros(len(at), np.uint64)
    for k in range(size):
        hashes += words[at + k] * factor[k + 1]
    hashes = mix(hashes)
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    return np.bincount(row[first], minlength=len(n)), hashes[first]


def sketches(counts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each whole set (0 if it is empty), and its band keys, one row per set."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(SHINGLE)))])
    ends = np.cumsum(counts)
    node = sums[ends] - sums[ends - counts]
    keys = np.zeros((len(counts), BANDS), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        starts = (ends - counts)[some]
        seeds = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64))
        for band in range(BANDS):
            key = np.full(len(some), band, np.uint64)
            for k in range(band * ROWS, (band + 1) * ROWS):
                low = np.minimum.reduceat((hashes ^ seeds[2 * k]) * (seeds[2 * k + 1] | np.uint64(1)), starts)
                key = mix(key * np.uint64(31) + low)
            keys[some, band] = key
    return node.view(np.int64), keys.view(np.int64)


def simhashes(counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The SimHash of each set: a bit is 1 if it is set in over half of the shingles' hashes; 0 if the set is empty."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        starts = (np.cumsum(counts) - counts)[some]
        for k in range(64):
            ones = np.add.reduceat((hashes >> np.uint64(k)) & np.uint64(1), starts)
            out[some] |= (2 * ones > counts[some].astype(np.uint64)).astype(np.uint64) << np.uint64(k)
    return out.view(np.int64)


def parities(counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """PARITIES words per set of hashes in order: a bit is the parity of the hashes that fall on it. Two sets differ in as many
    hashes at least as their words do in bits."""
    out = np.zeros(len(counts) * PARITIES, np.uint64)
    place = np.repeat(np.arange(len(counts)), counts) * PARITIES + (hashes >> np.uint64(64 - PARITY_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    if len(first):
        bit = np.uint64(1) << (hashes >> np.uint64(58 - PARITY_BITS) & np.uint64(63))
        out[place[first]] = np.bitwise_xor.reduceat(bit, first)
    return out.view(np.int64)


def with_sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, node, size, fp, keys, bits) for every document; texts of equal shingles have one node."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", CHUNK):
            counts, hashes = shingles(batch.column("text"))
            node, keys = sketches(counts, hashes)
            lists = [
                pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1) * n, pa.int32()), pa.array(x.ravel()))
                for n, x in ((BANDS, keys), (PARITIES, parities(counts, hashes)))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_hash"), pa.array(node), pa.array(counts.astype(np.int64)),
                    pa.array(simhashes(counts, hashes)), *lists,
                ],
                ["doc_id", "text_hash", "node", "size", "fp", "keys", "bits"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    schema = "doc_id long, text_hash long, node long, size long, fp long, keys array<long>, bits array<long>"
    return rows.mapInArrow(trimmed(run), schema)


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, words): the shingles of the texts with these hashes (node, text_hash), one row per node."""
    few = F.broadcast(wanted) if wanted.count() <= NARROW else wanted.hint("merge")
    texts = docs.select("text", F.xxhash64("text").alias("text_hash")).join(few, "text_hash").select("node", "text")
    texts = texts.groupBy("node").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", CHUNK):
            counts, hashes = shingles(batch.column("text"))
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            words = pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("node"), words], ["node", "words"])

    return texts.mapInArrow(trimmed(run), "node long, words array<long>")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have Jaccard similarity SIMILARITY or more, in whole numbers."""
    tenths = round(10 * SIMILARITY)
    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    common = F.size(F.array_intersect("x", "y"))
    both = both.select("a", "b", common.alias("common"), (F.size("x") + F.size("y")).alias("total"))
    return both.filter(10 * F.col("common") >= tenths * (F.col("total") - F.col("common"))).select("a", "b")


def _alike(size: str, other: str):
    """Sets of these sizes can be similar enough."""
    tenths = round(10 * SIMILARITY)
    return 10 * F.least(size, other) >= tenths * F.greatest(size, other)


def fingerprint_pairs(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, size, fp) whose fingerprints are equal or linked (``simhash.near_links``: three or fewer differing bits, found
    by pivot distance tables), as a few pairs (a, b) a node: each with the smallest of its fingerprint, and these by the links;
    and the places (key, node, size) at which all pairs of such nodes meet."""
    firsts = stored(nodes.groupBy("fp").agg(F.min("node").alias("first"), F.max("node").alias("last")))
    n = firsts.count()
    near = stored(near_links(firsts.select("fp"), n))
    same = nodes.join(firsts, "fp").select(F.col("first").alias("a"), F.col("node").alias("b"))
    far = near.join(firsts.select("fp", "first").toDF("a", "x"), "a").join(firsts.select("fp", "first").toDF("b", "y"), "b")
    several = near.select(F.explode(F.array("a", "b")).alias("fp")).union(firsts.filter("first <> last").select("fp")).distinct()
    places = nodes.join(routed(several, n), "fp").select("key", "node", "size")
    return same.union(far.select(F.least("x", "y"), F.greatest("x", "y"))).filter("a <> b"), places


def across(places: DataFrame, roots: DataFrame, bits: DataFrame) -> DataFrame:
    """(a, b): all pairs of nodes that share a key of the places (key, node, size) but no component and can be similar enough
    by their sizes and by their parities (node, bits). Of a key's largest component each node meets only those of the others."""
    rest = places.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    parts = rest.groupBy("key", "root").agg(F.count("*").alias("n"))
    split = parts.groupBy("key").agg(F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("parts")).filter("parts > 1")
    rest = stored(rest.join(split.select("key", F.col("most.root").alias("main")), "key").join(bits, "node"))
    one = rest.filter("root <> main").select("key", *[F.col(x).alias(y) for x, y in zip(("node", "size", "root", "bits"), "ampx")])
    other = rest.select("key", "main", *[F.col(x).alias(y) for x, y in zip(("node", "size", "root", "bits"), "bnqy")])
    both = one.join(other, "key").filter("p <> q and (q = main or a < b)").filter(_alike("m", "n"))
    apart = sum(F.bit_count(F.get("x", k).bitwiseXOR(F.get("y", k))) for k in range(PARITIES))
    tenths = round(10 * SIMILARITY)
    # sets of m and n hashes are similar enough if they differ in (10 - tenths) / (10 + tenths) of m + n at most
    both = both.filter((10 + tenths) * apart <= (10 - tenths) * (F.col("m") + F.col("n")))
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links(docs: DataFrame, sketched: DataFrame) -> DataFrame:
    """(a, b): links that connect the nodes whose similarity is SIMILARITY or more and that share a band, or whose
    fingerprints are equal or differ in three or fewer bits.

    First a few pairs a node are compared: those of the SimHash links, and each node of a band key with two of the key.
    Only where the links found leave a key, of a band or of SimHash's routing, in several components, all its pairs across
    these are compared too, so a large group of near copies costs a few pairs a node and no similar pair is left out.
    """
    columns = [F.first(c).alias(c) for c in ("size", "fp", "keys", "bits")]
    nodes = sketched.groupBy("node").agg(F.min("text_hash").alias("text_hash"), *columns).filter("size > 0")
    alike, meetings = map(stored, fingerprint_pairs(nodes.select("node", "size", "fp")))
    places = nodes.select("node", "size", F.explode("keys").alias("key"))
    ends = places.groupBy("key").agg(F.min(F.struct("node", "size")).alias("low"), F.max(F.struct("node", "size")).alias("high"))
    places = stored(places.join(ends.filter("low.node <> high.node"), "key"))
    meetings = places.select("key", "node", "size").union(meetings)
    sets = stored(shingle_sets(docs, stored(nodes.select("node", "text_hash").join(meetings.select("node").distinct(), "node"))))
    ends = F.explode(F.array("low", "high")).alias("end")
    pairs = places.select("node", "size", ends).filter(F.col("node") != F.col("end.node")).filter(_alike("size", "end.size"))
    pairs = pairs.select(F.least("node", "end.node").alias("a"), F.greatest("node", "end.node").alias("b"))
    pairs = pairs.union(alike).distinct()
    found = stored(verified(pairs, sets))
    more = across(meetings, components(found).toDF("node", "root"), nodes.select("node", "bits"))
    return found.union(stored(verified(more.join(pairs, ["a", "b"], "left_anti"), sets)))


def grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, root) for every document: root names its group of near copies.

    Texts without a word are one group.
    """
    sketched = stored(with_sketches(docs))
    roots = components(links(docs, sketched)).toDF("node", "root")
    return sketched.select("doc_id", "text_hash", "node").join(roots, "node", "left").select(
        "doc_id", "text_hash", F.coalesce("root", "node").alias("root")
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents with one of each group of near copies (five-word shingles, Jaccard 0.8 or more), those without doc_id too."""
    return one_per_group(docs, grouped(docs), nameless=True)
