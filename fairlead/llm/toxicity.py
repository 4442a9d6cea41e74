"""Toxicity of texts written to hide it: a noisy-channel decoder restores words, a learned model scores them.

Tokens that mix letters with look-alike signs, repeat a letter three times or more, or stand as
runs of single letters and pairs, are read as lattices of what their author may have meant.
The best path under a character language model of the whole corpus and the costs of the channel
(Viterbi) is the restored text; all other words are taken as they are, in lower case.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.llm.text import BASE, documents, mix, prefix_hashes, ship, sliced, span_hashes, stored

#: Letter classes of the language model: 0 ends a word, 1 to 26 are a to z, the others share the rest.
CLASSES = 64
#: Weight of the shorter context when the longer one is rare.
SMOOTHING = 8.0
#: Labelled documents that the classifier is fitted on, about; chosen by a hash of id and text.
FITTED = 20_000
#: Bytes of the word parts that are features (a word has a mark in front and behind), and the features kept.
PARTS = range(3, 9)
FEATURES = 4_096
#: Toxic sample documents that must share a part.
LEAST = 4
STEPS, RATE, DECAY = 300, 0.05, 0.1
CUT = 0.5
CHUNK = 1 << 20
#: Decoded tokens, in characters, that a worker remembers; then it starts anew.
MEMORY = 4_000_000

#: What a sign may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i",
}
#: Costs in nats: a look-alike, a look-alike that is only noise, the same written thrice or more, other
#: noise, a sign that parts words, a space within a word, a letter written thrice or more for one or for
#: two, a double letter for one. Between single letters a space is likely noise, so a kept one costs PART.
SWAP, FALSE, ROW, NOISE, PART, GAP, MANY_ONE, MANY_TWO, DOUBLE = 1.0, 7.0, 1.5, 1.0, 2.0, 2.0, 0.5, 1.0, 3.0

_SIGNS = re.escape("".join(LOOK_ALIKES))
_EDGES = rf"^[^\p{{L}}0-9@$+€£¡!]+|[^\p{{L}}0-9@$+€£¡]+$"
_PLAIN = r"^\p{L}+$"
_HAS_LETTER = r"\p{L}"


def letter_classes(codes: np.ndarray) -> np.ndarray:
    """Class of each code point; 0 for zero."""
    latin = (codes >= 97) & (codes <= 122)
    return np.where(latin, codes - 96, np.where(codes == 0, 0, 27 + codes % (CLASSES - 27)))


def letter_class(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % (CLASSES - 27)


def trigrams(words: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Counts by class of (two before, one before, letter or end) over words of letters, each by its weight."""
    out = np.zeros(CLASSES**3)
    if not len(words):
        return out
    text = np.frombuffer("\0".join(["", "", *words.to_numpy(zero_copy_only=False), ""]).replace("\0", "\0\0").encode("utf-32-le"), np.uint32)
    codes = letter_classes(text.astype(np.int64))
    number = np.repeat(weights, pc.utf8_length(words).to_numpy(zero_copy_only=False) + 2)
    # words are two ends apart: of (before, before, now) those whose last is the second end say nothing
    gram = (codes[:-2] * CLASSES + codes[1:-1]) * CLASSES + codes[2:]
    first = 2  # the leading marks are four zeros
    gram, now, before = gram[first:], codes[2:][first:], codes[1:-1][first:]
    use = (now > 0) | (before > 0)
    n = min(len(gram), len(number))
    return np.bincount(gram[:n][use[:n]], weights=number[:n][use[:n]], minlength=CLASSES**3)


def letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places where words begin and end in the code points of all words, and these code points; a line end parts words."""
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")[0].as_py() if len(words) else ""
    return np.cumsum(length + 1) - length - 1, np.frombuffer(joined.encode("utf-32-le"), np.uint32)


def thrice(words: pa.Array) -> np.ndarray:
    """Which words write a sign three times or more in a row."""
    starts, codes = letters(words)
    out = np.zeros(len(words), bool)
    hits = np.flatnonzero((codes[2:] == codes[1:-1]) & (codes[1:-1] == codes[:-2]) & (codes[2:] != 10))
    out[np.searchsorted(starts, hits, side="right") - 1] = True
    return out


class Tokens:
    """Words of many texts, by text, in order, as places in a table of distinct words."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        self.text = np.repeat(np.arange(len(texts)), np.diff(offsets))
        self.index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.words = pc.replace_substring_regex(pc.utf8_lower(coded.dictionary), _EDGES, "")
        self.thrice = thrice(self.words)
        self.plain = pc.match_substring_regex(self.words, _PLAIN).to_numpy(zero_copy_only=False) & ~self.thrice
        self.lettered = pc.match_substring_regex(self.words, _HAS_LETTER).to_numpy(zero_copy_only=False)


def counted(docs: DataFrame) -> DataFrame:
    """(gram, n): letter trigrams of all words of letters in all documents, summed per task before the shuffle."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3)
        for batch in batches:
            for part in sliced([batch], "text", CHUNK):
                tokens = Tokens(part.column("text"))
                n = np.bincount(tokens.index, minlength=len(tokens.words)).astype(float)
                total += trigrams(tokens.words.filter(pa.array(tokens.plain)), n[tokens.plain])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some].astype(np.int64))], ["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


class Channel:
    """The decoder: letter costs of the corpus, and the lattices."""

    def __init__(self, counts: np.ndarray):
        n = counts.reshape(CLASSES, CLASSES, CLASSES)
        one = (n.sum((0, 1)) + 1) / (n.sum() + CLASSES)
        pairs = n.sum(0)
        two = (pairs + SMOOTHING * one) / (pairs.sum(1, keepdims=True) + SMOOTHING)
        three = (n + SMOOTHING * two) / (n.sum(2, keepdims=True) + SMOOTHING)
        self.cost = -np.log(three).ravel()
        self.seen: dict[str, str] = {}
        self.size = 0

    def __getstate__(self):
        return {"cost": self.cost}

    def __setstate__(self, state):
        self.cost = state["cost"]
        self.table = self.cost.tolist()
        self.seen, self.size = {}, 0

    @staticmethod
    def options(sign: str, times: int, lone: bool = False) -> list[tuple[str, float]]:
        """What a sign written `times` times may stand for, and the cost; `lone`: a space between single letters."""
        if sign == " ":
            return [("", 0.0), (" ", PART)] if lone else [(" ", 0.0), ("", GAP)]
        if sign.isalpha():
            if times == 1:
                return [(sign, 0.0)]
            return [(sign * 2, 0.0), (sign, DOUBLE)] if times == 2 else [(sign, MANY_ONE), (sign * 2, MANY_TWO)]
        found = [("", NOISE), (" ", PART)] if sign not in LOOK_ALIKES else [("", ROW if times > 2 else FALSE), (" ", FALSE)]
        for letter in LOOK_ALIKES.get(sign, ""):
            found.append((letter, SWAP))
            if times > 1:
                found.append((letter * 2, SWAP + MANY_TWO))
        return found

    def decode(self, token: str) -> str:
        """The cheapest reading, words parted by one space; ties go to the first in the order of options."""
        known = self.seen.get(token)
        if known is not None:
            return known
        if self.size > MEMORY:
            self.seen, self.size = {}, 0
        self.seen[token] = out = self._decoded(token)
        self.size += len(token) + len(out)
        return out

    def _decoded(self, token: str) -> str:
        table = getattr(self, "table", None) or self.cost.tolist()
        self.table = table
        # state: the last two classes; value: cost and the reading as a chain
        paths: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
        at = 0
        while at < len(token):
            sign, end = token[at], at + 1
            while end < len(token) and token[end] == sign:
                end += 1
            lone = sign == " " and " " in (token[at - 2 : at - 1] or " ") and " " in (token[at + 2 : at + 3] or " ")
            reached: dict[int, tuple[float, tuple]] = {}
            for letters, cost in self.options(sign, end - at, lone):
                for state, (so_far, chain) in paths.items():
                    total, now = so_far + cost, state
                    for c in letters:
                        if c == " ":
                            if now % CLASSES:
                                total += table[now * CLASSES]
                            now = 0
                        else:
                            k = letter_class(c)
                            total += table[now * CLASSES + k]
                            now = now % CLASSES * CLASSES + k
                    best = reached.get(now)
                    if best is None or total < best[0]:
                        reached[now] = (total, (chain, letters) if letters else chain)
            paths = reached
            at = end
        ends = [(cost + (table[state * CLASSES] if state % CLASSES else 0.0), i, chain) for i, (state, (cost, chain)) in enumerate(paths.items())]
        chain = min(ends, key=lambda x: x[:2])[2]
        parts = []
        while chain:
            chain, letters = chain
            parts.append(letters)
        return " ".join("".join(reversed(parts)).split())


def restored_words(channel: Channel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(text, word, words): the restored words of all texts in order, as places in a table of words.

    The table begins with the tokens as they stand; what was decoded follows. A word may be in it twice.
    """
    tokens = Tokens(texts)
    more: dict[str, int] = {}

    def places(reading: str) -> list[int]:
        return [len(tokens.words) + more.setdefault(w, len(more)) for w in reading.split()]

    # a token is one word as it is, what it decodes to, or nothing (no letter)
    sizes = tokens.plain.astype(np.int64)
    odd = np.flatnonzero(tokens.lettered & ~tokens.plain)
    decoded = [places(channel.decode(w)) for w in tokens.words.take(pa.array(odd)).to_numpy(zero_copy_only=False)]
    sizes[odd] = [len(d) for d in decoded]
    begin = np.cumsum(sizes) - sizes
    flat = np.repeat(np.arange(len(sizes)), sizes)
    at = np.repeat(begin[odd], sizes[odd])
    flat[at + np.arange(len(at)) - np.repeat(np.cumsum(sizes[odd]) - sizes[odd], sizes[odd])] = [i for d in decoded for i in d]
    # runs of three tokens or more of one or two characters, within one text
    look = pc.match_substring_regex(tokens.words, rf"^(?:\p{{L}}|[{_SIGNS}]){{1,2}}$").to_numpy(zero_copy_only=False)
    short = look.astype(bool)[tokens.index]
    chained = np.zeros(len(short), bool)
    chained[1:] = (tokens.text[1:] == tokens.text[:-1]) & short[1:] & short[:-1]
    firsts = np.flatnonzero(~chained)
    lengths = np.diff(np.append(firsts, len(chained)))
    in_run = short & np.repeat(lengths >= 3, lengths)
    n = np.where(in_run, 0, sizes[tokens.index])
    text, order = np.repeat(tokens.text, n), np.repeat(np.arange(len(n)), n)
    word = flat[np.arange(n.sum()) + np.repeat(begin[tokens.index] - (np.cumsum(n) - n), n)]
    extra_at: list[int] = []
    extra: list[int] = []
    runs = np.flatnonzero((lengths >= 3) & short[firsts]) if len(firsts) else firsts
    few = tokens.words.take(pa.array(np.flatnonzero(look))).to_numpy(zero_copy_only=False)
    spelled = dict(zip(np.flatnonzero(look).tolist(), few))
    for a, size in zip(firsts[runs].tolist(), lengths[runs].tolist()):
        reading = " ".join([spelled[i] for i in tokens.index[a : a + size].tolist()])
        if any(map(str.isalpha, reading)):
            got = places(channel.decode(reading))
            extra += got
            extra_at += [a] * len(got)
    if extra:
        at = np.array(extra_at, np.int64)
        merged = np.argsort(np.concatenate([order, at]), kind="stable")
        text = np.concatenate([text, tokens.text[at]])[merged]
        word = np.concatenate([word, np.array(extra, np.int64)])[merged]
    return text, word, pa.concat_arrays([tokens.words, pa.array(list(more), tokens.words.type)])


def restored(docs: DataFrame, channel: Channel) -> DataFrame:
    """(doc_id, restored): every whole text as restored words, parted by single spaces.

    Null and empty texts, and texts without letters, give an empty string; repeated rows and null
    doc_id are kept; other columns are not read.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(channel)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", CHUNK):
            text, word, table = restored_words(sent.value, batch.column("text"))
            words = table.to_numpy(zero_copy_only=False)
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
            out = [" ".join(words[word[a:b]]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "restored"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, restored string")


#: Odd multipliers of the bytes of a part, by place.
_FACTORS = mix(np.arange(1, PARTS.stop + 1, dtype=np.uint64)) | np.uint64(1)
_BITS = 20


def parts(words: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(word, hash) of all parts of all words, a mark in front and behind, and of whole words; or of the parts in a sorted
    array of hashes only, then with their places there."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    marked = pc.binary_join_element_wise("\x02", words, "\x03", "")
    sizes = pc.binary_length(marked).to_numpy(zero_copy_only=False).astype(np.int64)
    last = np.cumsum(sizes)
    whole = np.frombuffer(marked.buffers()[2], np.uint8)[: last[-1]].astype(np.uint64)
    left = np.repeat(last, sizes) - np.arange(len(whole))
    #: of words no longer than a part, the whole word stands for it
    size = np.repeat(sizes, sizes)
    table = np.zeros(1 << _BITS, bool)
    if wanted is not None:
        table[wanted >> np.uint64(64 - _BITS)] = True
    owners, codes = [], []

    def found(at: np.ndarray, code: np.ndarray) -> None:
        place = code
        if wanted is not None:
            likely = table[code >> np.uint64(64 - _BITS)]
            at, code = at[likely], code[likely]
            place = np.searchsorted(wanted, code)
            hit = place < len(wanted)
            hit[hit] = wanted[place[hit]] == code[hit]
            at, place = at[hit], place[hit].astype(np.uint64)
        owners.append(np.searchsorted(last, at, side="right"))
        codes.append(place)

    prefix = prefix_hashes(whole + np.uint64(1))
    found(last - sizes, span_hashes(prefix, last - sizes, last))
    code = whole * _FACTORS[0]
    for n in range(2, PARTS.stop):
        code = code[:-1] + whole[n - 1 :] * _FACTORS[n - 1]
        if n >= PARTS.start:
            at = np.flatnonzero((left[: len(code)] >= n) & (size[: len(code)] > n))
            # the highest bits of the product stir the sum; the number of bytes tells parts of one sum apart
            stirred = (code[at] ^ np.uint64(n)) * np.uint64(BASE)
            found(at, stirred ^ (stirred >> np.uint64(29)))
    return np.concatenate(owners), np.concatenate(codes)


def matched(channel: Channel, texts: pa.Array, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs: hashes of parts, or places in the sorted array of those wanted."""
    text, word, words = restored_words(channel, texts)
    owner, code = parts(words, wanted)
    order = np.argsort(owner, kind="stable")
    owner, code = owner[order], code[order]
    first, size = np.searchsorted(owner, np.arange(len(words))), np.bincount(owner, minlength=len(words))
    pairs = np.unique(text * max(len(words), 1) + word) if len(text) else np.zeros(0, np.int64)
    text, word = pairs // max(len(words), 1), pairs % max(len(words), 1)
    n = size[word] if len(words) else np.zeros(0, np.int64)
    code = code[np.arange(n.sum()) + np.repeat(first[word] - (np.cumsum(n) - n), n)] if n.sum() else code[:0]
    text = np.repeat(text, n)
    order = np.lexsort((code, text))
    text, code = text[order], code[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (code[1:] != code[:-1])
    return text[new], code[new]


class Model:
    """Logistic regression on word parts that are commoner in toxic documents."""

    def __init__(self, features: np.ndarray, weight: np.ndarray, bias: float):
        self.features, self.weight, self.bias = features, weight, bias

    def score(self, channel: Channel, texts: pa.Array) -> np.ndarray:
        text, at = matched(channel, texts, self.features)
        z = self.bias + np.bincount(text, self.weight[at.astype(np.int64)], len(texts))
        return 1 / (1 + np.exp(-z))


def regressed(rows: list[tuple[list[int], float]], size: int) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam steps; the rows are few (FITTED, about) and sparse."""
    y = np.array([v for _, v in rows])
    at = np.repeat(np.arange(len(rows)), [len(c) for c, _ in rows])
    cols = np.fromiter((c for r, _ in rows for c in r), np.int64)
    share = (y.sum() + 0.5) / (len(y) + 1)
    theta = np.zeros(size + 1)
    theta[size] = np.log(share / (1 - share))
    if not 0 < y.sum() < len(y):
        return theta[:size], theta[size]
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        z = theta[size] + np.bincount(at, theta[cols], len(y))
        left = 1 / (1 + np.exp(-z)) - y
        slope = np.append(np.bincount(cols, left[at], size) + DECAY * theta[:size], left.sum())
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
        theta -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return theta[:size], theta[size]


def language_model(docs: DataFrame) -> Channel:
    """The decoder of a corpus; the driver gets one number per trigram of classes (262,144 at most)."""
    counts = np.zeros(CLASSES**3)
    for r in counted(docs).toLocalIterator():
        counts[r.gram] = r.n
    return Channel(counts)


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, y): about FITTED different labelled documents, stored.

    An id labelled more than once counts as toxic if one label says so; rows of the same id and
    text count once, so repeated rows cannot fill the sample. Only ids and hashes are shuffled
    until the sample is chosen.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    known = labels.filter(F.col("label").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("label").cast("double").alias("y"))
    pairs = stored(rows.select("doc_id", "hash").distinct().join(known, "doc_id"))
    cells = 1_000_000
    share = -(-cells * FITTED // max(pairs.count(), 1))
    some = pairs.filter(F.pmod(F.xxhash64("doc_id", "hash"), F.lit(cells)) < share)
    chosen = rows.join(F.broadcast(some), ["doc_id", "hash"])
    return stored(chosen.groupBy("doc_id", "hash").agg(F.first("text").alias("text"), F.first("y").alias("y")).select("text", "y"))


def fitted(docs: DataFrame, labels: DataFrame, channel: Channel) -> Model | None:
    """A model of the documents (doc_id, text) with labels (doc_id, label 0 or 1); None if none is labelled.

    Parts that at least LEAST toxic documents of the sample hold are counted over the whole sample;
    the FEATURES with the highest log-likelihood ratio stay.
    """
    rows = sample(docs, labels)
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("toxic")).first()
    if not total.n:
        return None
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(channel)

    def counts(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", CHUNK):
            text, code = matched(sent.value, batch.column("text"), wanted)
            key, n = np.unique(code.view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["part", "n"])

    def counted_parts(some: DataFrame, wanted=None) -> DataFrame:
        held = spark.sparkContext.broadcast(wanted)
        out = some.select("text").mapInArrow(lambda b: counts(b, held.value), "part long, n long")
        return out.groupBy("part").agg(F.sum("n").alias("n"))

    toxic = rows.filter("y = 1")
    often = counted_parts(toxic).filter(F.col("n") >= LEAST)
    found = [(r.part, r.n) for r in often.toLocalIterator()]
    if not found:
        return Model(np.zeros(0, np.uint64), np.zeros(0), regressed([([], r.y) for r in rows.select("y").collect()], 0)[1])
    code = np.array([p for p, _ in found], np.int64).view(np.uint64)
    order = np.argsort(code)
    code, a = code[order], np.array([n for _, n in found], float)[order]
    b = np.zeros(len(code))
    for r in counted_parts(rows.filter("y = 0"), code).toLocalIterator():
        b[r.part] = r.n
    na, nb = float(total.toxic), float(total.n - total.toxic)
    ratio = np.where(a / na > b / max(nb, 1), likelihood_ratio(a, b, na, nb), 0)
    best = np.sort(np.lexsort((code, -ratio))[:FEATURES])
    kept = code[best[ratio[best] > 0]]
    wanted = spark.sparkContext.broadcast(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", CHUNK):
            text, at = matched(sent.value, batch.column("text"), wanted.value)
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(at.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([lists, batch.column("y")], ["parts", "y"])

    sparse = sorted((r.parts, r.y) for r in rows.mapInArrow(run, "parts array<int>, y double").toLocalIterator())
    weight, bias = regressed(sparse, len(kept))
    return Model(kept, weight, bias)


def likelihood_ratio(a: np.ndarray, b: np.ndarray, na: float, nb: float) -> np.ndarray:
    """Twice the log-likelihood ratio of a part being in a of na and b of nb documents, against equal shares."""

    def term(x, expected):
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-300) / np.maximum(expected, 1e-300)), 0)

    n, t = na + nb, a + b
    return 2 * (term(a, t * na / n) + term(b, t * nb / n) + term(na - a, (n - t) * na / n) + term(nb - b, (n - t) * nb / n))


def scored(docs: DataFrame, model: Model | None, channel: Channel) -> DataFrame:
    """(doc_id, score, predicted) for every document, from its whole restored text alone.

    A null text counts as empty; without a model every score is 0; repeated rows and null doc_id
    are kept; other columns are not read.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((channel, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", CHUNK):
            decoder, fit = sent.value
            score = fit.score(decoder, batch.column("text")) if fit is not None else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= CUT).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def held_out():
    """One fifth of the documents by a checksum of their id; their labels are never learned."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out())
    channel = language_model(docs)
    model = fitted(docs, labels.select("doc_id", F.col("toxic").alias("label")), channel)
    return scored(docs, model, channel).select("doc_id", held_out().alias("held_out"), "score", "predicted")
