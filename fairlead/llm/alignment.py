"""Alignment of two tokenizers: byte offsets where both end a token cut a text into groups.

The shorter of a text's two lists of token ends drives an exponential, then binary search into the
longer one; the ranks of common ends give the tokens of each group on both sides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairlead.llm.text import documents, ship, shared_folder, sliced, trimmed
from fairlead.llm.tokens import _byte_of

#: Bytes of text whose token pairs are looked up together.
BLOCK = 4 << 20
#: Id pairs of a row of a block at most, and bytes of a row group and of a batch to Python: readers hold thousands of rows at once.
PIECE = 1_024
ROW_GROUP = 16 << 20
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
#: Groups of more links than this are linked by their distinct ids.
WIDE = 4_096
#: An id pair is packed as first * SECOND + second; both vocabularies are checked against it.
SECOND = 1 << 15
#: Characters on which the faster engine of the first tokenizer and its library cut alike.
_COMMON = regex.compile(r"[^\x09-\x0d\x20-\x7e¡-ɏ]")


def vocabulary_paths() -> tuple[str, str, str]:
    """Files of the first tokenizer, of its ranks, and of the second."""
    import public_tokenizers

    return tuple(map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")))


class Pair:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, first: str, ranks: str, second: str):
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(first)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=second)
        byte = _byte_of()
        self.bytes_a = [b""] * self.library.get_vocab_size()
        for token, i in self.library.get_vocab().items():
            self.bytes_a[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.bytes_b = []
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode())
        if len(self.bytes_b) > SECOND or len(self.bytes_a) > (1 << 31) // SECOND:
            raise ValueError("vocabularies are too large for packed id pairs")
        self.sizes_a, self.sizes_b = (np.array([len(b) for b in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        #: a token's text in the listing, by id and by what follows it: first , and |, second , and ;
        self.listed = np.array([f"{i}{s}" for n, s in ((len(self.bytes_a), ","), (len(self.bytes_a), "|"), (len(self.bytes_b), ","), (len(self.bytes_b), ";")) for i in range(n)], object)

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of a text with a space in front; none if the bytes of either side differ from it."""
        if not text:
            return [], []
        spaced = " " + text
        if _COMMON.search(text):
            a = self.library.encode(spaced, add_special_tokens=False).ids
        else:
            a = self.fast.encode_ordinary(spaced)
        b = self.pieces.encode(text)
        raw = spaced.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return [], []
        return a, b


_LOADED: dict[tuple[str, str, str], Pair] = {}


def pair(paths: tuple[str, str, str]) -> Pair:
    """One per worker and vocabularies."""
    if paths not in _LOADED:
        _LOADED[paths] = Pair(*paths)
    return _LOADED[paths]


def galloped(values: np.ndarray, into: np.ndarray, start: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """First place in [low, high) of the sorted `into` that is not below each value; high if there is none.

    Every search begins at its own start, doubles its step away from it until the value is
    bracketed, and halves the bracket.
    """
    first, last = low.copy(), high.copy()  # the answer lies in [first, last]
    at = np.clip(start, low, np.maximum(high - 1, low))
    active = np.flatnonzero(high > low)
    up = np.zeros(len(values), bool)
    up[active] = into[at[active]] < values[active]
    last[active] = np.where(up[active], high[active], at[active])
    first[active] = np.where(up[active], at[active] + 1, low[active])
    step = 1
    while len(active):
        probe = np.where(up[active], at[active] + step, at[active] - step)
        inside = (probe >= low[active]) & (probe < high[active])
        active, probe = active[inside], probe[inside]
        below = into[probe] < values[active]
        first[active] = np.where(below, probe + 1, first[active])
        last[active] = np.where(below, last[active], probe)
        active = active[below == up[active]]
        step *= 2
    active = np.flatnonzero(first < last)
    while len(active):
        middle = (first[active] + last[active]) // 2
        below = into[middle] < values[active]
        first[active] = np.where(below, middle + 1, first[active])
        last[active] = np.where(below, last[active], middle)
        active = active[first[active] < last[active]]
    return first


class Aligned:
    """Groups of many texts at once: a, b are all ids, n_a, n_b the tokens per text, and per group its text and tokens."""

    def __init__(self, tokens: Pair, texts: pa.Array):
        ids = [tokens.encode(t or "") for t in texts.to_pylist()]
        self.n_a, self.n_b = (np.array([len(x[k]) for x in ids], np.int64) for k in (0, 1))
        self.a, self.b = (np.fromiter((i for x in ids for i in x[k]), np.int64) for k in (0, 1))
        # byte offsets of token ends, running on from text to text
        ends = {False: np.cumsum(tokens.sizes_a[self.a]), True: np.cumsum(tokens.sizes_b[self.b])}
        n = {False: self.n_a, True: self.n_b}
        begin = {k: np.cumsum(v) - v for k, v in n.items()}
        # the side with fewer ends drives, text by text
        swap = self.n_b < self.n_a
        rank, partner, owner = [], [], []
        for side in (False, True):
            mine = np.flatnonzero(swap == side)
            count = n[side][mine]
            text = np.repeat(mine, count)
            k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            value = ends[side][begin[side][text] + k]
            low, size = begin[not side][text], n[not side][text]
            found = galloped(value, ends[not side], low + k * size // np.maximum(n[side][text], 1), low, low + size)
            hit = found < low + size
            hit[hit] = ends[not side][found[hit]] == value[hit]
            mine_rank, other_rank = k[hit], (found - low)[hit]
            owner.append(text[hit])
            rank.append(other_rank if side else mine_rank)
            partner.append(mine_rank if side else other_rank)
        text = np.concatenate(owner)
        order = np.argsort(text, kind="stable")
        #: per group: its text, its tokens on both sides, and its first token in a and b
        self.text = text[order]
        new = np.ones(len(text), bool)
        new[1:] = self.text[1:] != self.text[:-1]
        last_a, last_b = np.concatenate(rank)[order], np.concatenate(partner)[order]
        before_a, before_b = (np.where(new, -1, np.concatenate([[-1], x[:-1]]) if len(x) else x) for x in (last_a, last_b))
        self.size_a, self.size_b = last_a - before_a, last_b - before_b
        self.first_a, self.first_b = begin[False][self.text] + before_a + 1, begin[True][self.text] + before_b + 1
        self.groups = np.bincount(self.text, minlength=len(ids))
        self.links = np.zeros(len(ids), np.int64)
        np.add.at(self.links, self.text, self.size_a * self.size_b)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, id pair, links) of each distinct id pair that a text holds linked, in that order."""
        links = self.size_a * self.size_b
        usual = np.flatnonzero(links <= WIDE)
        n = links[usual]
        group = np.repeat(usual, n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        a, b = self.a[self.first_a[group] + k // self.size_b[group]], self.b[self.first_b[group] + k % self.size_b[group]]
        key, number = np.unique(self.text[group] << 32 | a * SECOND + b, return_counts=True)
        keys, numbers = [key], [number]
        for g in np.flatnonzero(links > WIDE).tolist():
            (a, in_a), (b, in_b) = (
                np.unique(x[f : f + s], return_counts=True)
                for x, f, s in ((self.a, self.first_a[g], self.size_a[g]), (self.b, self.first_b[g], self.size_b[g]))
            )
            keys.append((self.text[g] << 32 | a[:, None] * SECOND + b).ravel())
            numbers.append((in_a[:, None] * in_b).ravel())
        if len(keys) > 1:
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            number = np.zeros(len(key), np.int64)
            np.add.at(number, at, np.concatenate(numbers))
        return key >> 32, key & 0xFFFFFFFF, number

    def digests(self, tokens: Pair) -> list[str]:
        """sha256 of each text's groups, written as a1,a2|b1;a3|b2,b3; empty without tokens."""
        width_a, width_b = len(tokens.bytes_a), len(tokens.bytes_b)
        total = len(self.a) + len(self.b)
        listed = np.zeros(total, np.int64)
        group_a, group_b = (np.repeat(np.arange(len(self.text)), s) for s in (self.size_a, self.size_b))
        after_a, until_b = np.cumsum(self.size_a), np.cumsum(self.size_b) - self.size_b
        close_a, close_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        close_a[self.first_a + self.size_a - 1] = True
        close_b[self.first_b + self.size_b - 1] = True
        listed[np.arange(len(self.a)) + until_b[group_a]] = self.a + close_a * width_a
        listed[np.arange(len(self.b)) + after_a[group_b]] = 2 * width_a + self.b + close_b * width_b
        words = tokens.listed[listed]
        ends = np.cumsum(self.n_a + self.n_b)
        out = []
        for first, last in zip((ends - self.n_a - self.n_b).tolist(), ends.tolist()):
            out.append(hashlib.sha256("".join(words[first:last])[:-1].encode()).hexdigest() if last > first else "")
        return out


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def aligned(docs: DataFrame, paths: tuple[str, str, str] | None = None) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_sizes, b_sizes): both token sequences and how many tokens of each a group takes.

    Null and empty texts, and texts whose bytes a tokenizer does not give back, have empty lists;
    repeated rows and null doc_id are kept; other columns are not read.
    """
    paths = paths or vocabulary_paths()
    ship(docs.sparkSession)

    def lists(values: np.ndarray, n: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(values.astype(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", BLOCK // 4):
            x = Aligned(pair(paths), batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lists(x.a, x.n_a), lists(x.b, x.n_b), lists(x.size_a, x.groups), lists(x.size_b, x.groups)],
                ["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"],
            )

    return _narrow(docs).mapInArrow(run, "doc_id long, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>")


BLOCKS = (
    "block long, row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, digest string, "
    "place array<int>, links array<long>, pairs array<int>, docs array<int>"
)


def _pieces(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and begin of the pieces of at most PIECE values that each run of values is cut into, one piece at least."""
    n = np.maximum(-(-size // PIECE), 1)
    owner = np.repeat(np.arange(len(n)), n)
    return owner, first[owner] + PIECE * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))


def _blocks(docs: DataFrame, paths: tuple[str, str, str]) -> DataFrame:
    """The documents in blocks of BLOCK bytes of text, and the distinct id pairs of each block, in order.

    A document is a row, or several of the same number in its block: its counts, the places of its id pairs among those
    of the block, and their links. The block's pairs are rows without a number, with the documents that hold each pair.
    No row holds more than PIECE pairs, whatever the size of a document or block.
    """

    def lists(begin: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.append(begin, len(values)), pa.int32()), pa.array(values, kind))

    def rows(**columns) -> pa.RecordBatch:
        n = len(columns["block"])
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    list_of = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
    schema = pa.schema([(name, list_of[kind]) for name, kind in (f.split(" ") for f in BLOCKS.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        for batch in sliced(batches, "text", BLOCK):
            held: list[tuple] = []
            for part in sliced([batch], "text", BLOCK // 8):
                x = Aligned(pair(paths), part.column("text"))
                text, code, links = x.pairs()
                held.append((x.n_a, x.n_b, x.groups, x.links, x.digests(pair(paths)), np.bincount(text, minlength=part.num_rows), code, links))
            n_a, n_b, groups, total, digest, size, code, links = zip(*held)
            pairs, place = np.unique(np.concatenate(code), return_inverse=True)
            size = np.concatenate(size)
            row, begin = _pieces(np.cumsum(size) - size, size)
            facts = dict(zip(("n_a", "n_b", "n_groups", "n_links"), map(np.concatenate, (n_a, n_b, groups, total))))
            yield rows(
                block=pa.array(np.full(len(row), number)), row=pa.array(row, pa.int32()), doc_id=batch.column("doc_id").take(pa.array(row)),
                digest=pa.array([d for x in digest for d in x], pa.string()).take(pa.array(row)),
                place=lists(begin, place, pa.int32()), links=lists(begin, np.concatenate(links), pa.int64()),
                **{k: pa.array(v[row], pa.int64()) for k, v in facts.items()},
            )
            _, begin = _pieces(np.zeros(1, np.int64), np.array([len(pairs)]))
            held_by = np.bincount(place, minlength=len(pairs))
            yield rows(block=pa.array(np.full(len(begin), number)), pairs=lists(begin, pairs, pa.int32()), docs=lists(begin, held_by, pa.int32()))
            number += 1

    return _narrow(docs).mapInArrow(trimmed(run), BLOCKS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best): how many documents hold each id pair linked; whether that is its first id's highest count."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.docs").alias("n"))
    counts = each.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("_a", F.floor(F.col("pair") / SECOND))
    highest = F.max("count").over(Window.partitionBy("_a"))
    return counts.withColumn("best", F.col("count") == highest).drop("_a")


def link_statistics(docs: DataFrame, paths: tuple[str, str, str] | None = None) -> DataFrame:
    """Per document: tokens, groups and links of both tokenizers, and how common its links are in the corpus.

    n_best counts the links whose id pair is the commonest of its first id, ties included;
    count_sum adds up, over all links, the number of documents that hold the link's id pair. Null
    and empty texts, and texts whose bytes a tokenizer does not give back, have zeros; repeated
    rows count as documents each; null doc_id is kept; other columns are not read. Documents are
    worked on in blocks: a block asks for the counts of its distinct pairs once.
    """
    import uuid

    spark = docs.sparkSession
    paths = paths or vocabulary_paths()
    ship(spark)
    folder = f"{shared_folder(spark)}/alignment-{uuid.uuid4().hex}"
    before = spark.conf.get(BATCH[0])
    spark.conf.set(*BATCH)
    try:
        _blocks(docs, paths).write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(folder)
    finally:
        spark.conf.set(BATCH[0], before)
    blocks = spark.read.parquet(folder)
    answers = blocks.select("block", F.explode("pairs").alias("pair")).join(pair_counts(blocks), "pair")
    rows = spark.read.parquet(folder).filter("row is not null").drop("pairs", "docs")

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers["pair"].to_numpy())
        place, links = rows["place"].combine_chunks(), rows["links"].combine_chunks().flatten().to_numpy()
        ends = np.cumsum(np.concatenate([[0], pc.list_value_length(place).to_numpy()]))
        place, row = place.flatten().to_numpy(), rows["row"].to_numpy()
        _, first = np.unique(row, return_index=True)
        one = rows.take(pa.array(first))
        sums = []
        for name in ("best", "count"):
            weight = answers[name].to_numpy().astype(np.int64)[order]
            total = np.concatenate([[0], np.cumsum(weight[place] * links)]).astype(np.int64)
            each = np.zeros(len(first), np.int64)
            np.add.at(each, row, total[ends[1:]] - total[ends[:-1]])
            sums.append(pa.array(each))
        columns = [one[n] for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        return pa.table(columns + sums + [one["digest"]], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_statistics(documents(spark, sf_dir))
