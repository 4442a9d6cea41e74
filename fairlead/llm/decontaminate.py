"""Benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.llm.text import documents, mix, powers, sent as sent_value, ship, sliced, split_words, trimmed, word_hashes

#: Positions that count are 1. Several masks find overlaps whose substituted words break the others.
MASKS = ("11111", "1101011", "11001011", "101100101")
#: For items of fewer than OVERLAP words only, whose equal words may stand in short pieces.
SHORT_MASKS = ("111", "11011")
#: Share of equal words from which an overlap counts.
SIMILARITY = 0.8
#: Words of an overlap from which a part of an item counts; shorter items count as a whole.
OVERLAP = 13
#: Items of fewer words are no evidence.
SHORTEST = 5
CHUNK = 2 << 20
#: Words of benchmark items that are sent to the executors at once.
BLOCK_WORDS = 1_000_000
#: Candidate overlaps verified at once.
VERIFIED = 20_000
#: Words and index entries that are looked at together, about.
PIECE = 1_000_000
_BITS = 22
#: What an unequal word takes off, so that a sum of 0 is a share of SIMILARITY.
_COST = int(round(SIMILARITY / (1 - SIMILARITY)))
_NEVER = np.int64(1 << 60)


def normalised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words per text, and a hash of every word: runs of letters and digits, in lower case."""
    clean = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), "[^\\p{L}\\p{N}]+", " ")
    counts, offsets, data = split_words(clean)
    return counts, word_hashes(offsets, data)


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash at every word of the positions that the mask keeps."""
    n = max(len(words) - len(mask) + 1, 0)
    factor = powers(len(mask) + 2)
    out = np.zeros(n, np.uint64)
    for i, p in enumerate(k for k, c in enumerate(mask) if c == "1"):
        out += words[p : p + n] * factor[i + 1]
    return mix(out ^ np.uint64(len(mask)))


class Benchmark:
    """A block of items: their words, and the seeds of every mask with their places."""

    def __init__(self, item_ids: list[int], texts: list[str | None]):
        self.item_ids = np.array(item_ids, np.int64)
        self.counts, self.words = normalised(pa.array(texts, pa.string()))
        self.starts = np.cumsum(self.counts) - self.counts
        item = np.repeat(np.arange(len(self.counts)), self.counts)
        place = np.arange(len(self.words)) - np.repeat(self.starts, self.counts)
        self.index = []
        for mask in MASKS + SHORT_MASKS:
            key = seeds(self.words, mask)
            size = self.counts[item[: len(key)]]
            fits = (place[: len(key)] + len(mask) <= size) & (size >= SHORTEST)
            if mask in SHORT_MASKS:
                fits &= size < OVERLAP
            at = np.flatnonzero(fits)
            if not len(at):
                continue
            at = at[np.lexsort((item[at], key[at]))]
            table = np.zeros(1 << _BITS, bool)
            table[key[at] >> np.uint64(64 - _BITS)] = True
            # one entry per seed and item; its places follow each other from `first`
            new = np.ones(len(at), bool)
            new[1:] = (key[at][1:] != key[at][:-1]) | (item[at][1:] != item[at][:-1])
            first = np.flatnonzero(new)
            self.index.append((mask, key[at][first], item[at][first], first, np.diff(np.append(first, len(at))), place[at], table))

    def overlaps(self, texts: pa.Array) -> dict[str, np.ndarray]:
        """Verified overlaps, the best per text and item: row, item, words of the overlap, equal words among them."""
        counts, words = normalised(texts)
        starts = np.cumsum(counts) - counts
        row = np.repeat(np.arange(len(counts)), counts)
        candidates = self._candidates(words, row, counts)
        parts = [self._verify(candidates[:, i : i + VERIFIED], words, starts, counts) for i in range(0, candidates.shape[1], VERIFIED)]
        if not parts:
            return {k: np.zeros(0, np.int64) for k in ("row", "item", "overlap", "equal")}
        row, item, overlap, equal = np.concatenate(parts, axis=1)
        order = np.lexsort((-overlap, -equal, item, row))
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(row[order]) != 0) | (np.diff(item[order]) != 0)
        best = order[first]
        return {"row": row[best], "item": item[best], "overlap": overlap[best], "equal": equal[best]}

    def _entries(self, words: np.ndarray, row: np.ndarray, index) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word, entry): the index entries with the seed of each word of the texts, at most about PIECE at once."""
        mask, keys, _, _, _, _, table = index
        key = seeds(words, mask)
        at = np.flatnonzero(table[key >> np.uint64(64 - _BITS)])
        at = at[row[at] == row[at + len(mask) - 1]]
        low, high = (np.searchsorted(keys, key[at], side=s) for s in ("left", "right"))
        some = high > low
        at, low, n = at[some], low[some], (high - low)[some]
        block = (np.cumsum(n) - n) // PIECE
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(at)]
        for a, b in zip(cuts, cuts[1:]):
            m = n[a:b]
            yield np.repeat(at[a:b], m), np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(low[a:b], m)

    def _candidates(self, words: np.ndarray, row: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """(text, item, origin) of the diagonals on which a seed of a text meets one of an item, each once.

        A seed that stands often in both (repetitive text) meets itself at more places than there are
        diagonals. So hits are counted first, by text and item, without being listed; where they
        outnumber the diagonals, all of these are candidates, and only the other hits are listed.
        """
        hits: dict[int, int] = {}
        for index in self.index:
            for at, entry in self._entries(words, row, index):
                pair, back = np.unique(row[at] * len(self.counts) + index[2][entry], return_inverse=True)
                for p, n in zip(pair.tolist(), np.bincount(back, weights=index[4][entry]).astype(np.int64).tolist()):
                    hits[p] = hits.get(p, 0) + n
        if not hits:
            return np.zeros((3, 0), np.int64)
        pairs = np.array(sorted(hits), np.int64)
        text, item = pairs // len(self.counts), pairs % len(self.counts)
        starts = np.cumsum(counts) - counts
        diagonals = counts[text] + self.counts[item] - 1
        dense = np.array([hits[p] for p in pairs.tolist()]) > diagonals
        # a diagonal is packed as the number of its pair and its origin, counted from the first possible one
        reach = int(self.counts.max()) - 1
        span = len(words) + reach
        n = diagonals[dense]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found = [np.repeat(np.flatnonzero(dense) * span + starts[text[dense]] - self.counts[item[dense]] + 1 + reach, n) + k]
        for index in self.index:
            _, _, items, first, size, places, _ = index
            for at, entry in self._entries(words, row, index):
                pair = np.searchsorted(pairs, row[at] * len(self.counts) + items[entry])
                few = ~dense[pair]
                at, entry, pair = at[few], entry[few], pair[few]
                m = size[entry]
                k = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(first[entry], m)
                found.append(np.unique(np.repeat(pair * span + at + reach, m) - places[k]))
        code = np.unique(np.concatenate(found))
        pair = code // span
        return np.stack([text[pair], item[pair], code % span - reach])

    def _verify(self, candidates: np.ndarray, words: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Along each diagonal, the longest run of which SIMILARITY at least are equal words, of those with most equal ones.

        An equal word adds 1 to a running sum and another takes off `cost`: a run holds enough
        equal words if the sum is not lower at its end than at its beginning.
        """
        row, item, origin = candidates
        size = self.counts[item]
        low = np.maximum(starts[row] - origin, 0)
        high = np.minimum(starts[row] + counts[row] - origin, size)
        score, total = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
        #: sums at the last OVERLAP places, and the lowest of those before
        recent = np.zeros((OVERLAP, len(row)), np.int64)
        least = np.full(len(row), _NEVER)
        part = np.zeros(len(row), bool)
        for j in range(int(size.max(initial=0))):
            inside = (j >= low) & (j < high)
            at = np.clip(origin + j, 0, len(words) - 1)
            equal = inside & (words[at] == self.words[np.minimum(self.starts[item] + j, len(self.words) - 1)])
            total += equal
            # recent[j % OVERLAP] is the sum before word j; a run of OVERLAP words to j began at the one written over next
            recent[j % OVERLAP] = np.where(inside, score, _NEVER)
            score += np.where(equal, 1, -_COST) * inside
            if j + 1 >= OVERLAP:
                np.minimum(least, recent[(j + 1) % OVERLAP], out=least)
                part |= inside & (score >= least)
        whole = total * (_COST + 1) >= _COST * size
        length, same = np.where(whole, size, 0), np.where(whole, total, 0)
        for c in np.flatnonzero(part & ~whole):
            length[c], same[c] = self._longest(words, item[c], origin[c], low[c], high[c])
        ok = whole | part
        return np.stack([row, item, length, same])[:, ok]

    def _longest(self, words: np.ndarray, item: int, origin: int, low: int, high: int) -> tuple[int, int]:
        """Words and equal words of the longest run on one diagonal between two places of the item."""
        first = self.starts[item]
        equal = words[origin + low : origin + high] == self.words[first + low : first + high]
        sums = np.concatenate([[0], np.cumsum(np.where(equal, 1, -_COST))])
        begin = np.searchsorted(-np.minimum.accumulate(sums), -sums, side="left")
        length = np.arange(len(sums)) - begin
        same = (sums - sums[begin] + _COST * length) // (_COST + 1)
        best = np.lexsort((same, length))[-1]
        return length[best], same[best]


def blocks(benchmark: DataFrame, named: bool = True) -> list[Benchmark]:
    """All items, in blocks of bounded size; each block is joined with all documents in turn.

    Items without text, without id if they are to be named, or of fewer than SHORTEST words, match nothing.
    """
    items = benchmark.filter("text is not null").select(F.col("item_id").cast("long"), "text")
    if named:
        items = items.filter("item_id is not null")
    words = items.agg(F.sum(F.size(F.split("text", "\\s+")))).first()[0] or 0
    n = max(1, -(-words // BLOCK_WORDS))
    out = []
    for b in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        if rows:
            out.append(Benchmark([r.item_id or 0 for r in rows], [r.text for r in rows]))
    return out


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_words, overlap, equal): documents that hold a benchmark item or a long part of it.

    An overlap counts if at least SIMILARITY of its words are equal, and if it is the whole
    item or OVERLAP words long. One row per document row and item. Null texts hold nothing;
    a null doc_id is kept; other columns are not read; repeated items are reported once.
    """
    ship(docs.sparkSession)
    out = None
    for block in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for batch in sliced(batches, "text", CHUNK):
                got = block.overlaps(batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(got["row"])),
                        *(pa.array(x[got["item"]]) for x in (block.item_ids, block.counts)),
                        *(pa.array(got[k]) for k in ("overlap", "equal")),
                    ],
                    ["doc_id", "item_id", "n_words", "overlap", "equal"],
                )

        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            run, "doc_id long, item_id long, n_words long, overlap long, equal long"
        )
        out = part if out is None else out.union(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_words long, overlap long, equal long")
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, without those that hold a benchmark item, with id or without; nothing is shuffled."""
    ship(docs.sparkSession)
    place = docs.columns.index("text")
    for block in blocks(benchmark, named=False):
        sent = sent_value(docs.sparkSession, block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                named = pa.RecordBatch.from_arrays([batch.column(place), pa.array(np.arange(batch.num_rows))], ["text", "at"])
                stay = np.ones(batch.num_rows, bool)
                for part in sliced([named], "text", CHUNK):
                    stay[part.column("at").to_numpy()[sent.value.overlaps(part.column("text"))["row"]]] = False
                yield batch.filter(pa.array(stay))

        docs = docs.mapInArrow(trimmed(run), docs.schema)
    return docs


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
