"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.llm.text import documents, sent as sent_value, ship, sliced, trim, trimmed

#: Bytes of the longest context.
ORDER = 3
#: Different labelled texts of each language that the models are fitted on, about; chosen by a hash.
FITTED = 1_500
#: Times that a context must occur to get a node of its own.
LEAST = 4
UNKNOWN = "und"
CHUNK = 1 << 20
#: Nodes that are blended at once.
ROWS = 4_096


def contexts_counted(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each run of ORDER + 1 bytes occurs, texts padded in front.

    gram packs the bytes, the last one lowest. Counts are summed per task before the shuffle.
    """
    ship(labelled.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", CHUNK):
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                grams = [np.zeros(0, np.int64)]
                for t in batch.column("text").filter(pa.array(langs == lang)).to_pylist():
                    codes = np.frombuffer(b"\0" * ORDER + t.encode(), np.uint8).astype(np.int64)
                    gram = np.zeros(max(len(codes) - ORDER, 0), np.int64)
                    for k in range(ORDER + 1):
                        gram = (gram << 8) | codes[k : k + len(gram)]
                    grams.append(gram)
                key, n = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key)), pa.array(key), pa.array(n)], ["lang", "gram", "n"])

    return labelled.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Context trees of all languages over one set of nodes, frozen as a table of code lengths.

    Symbols are the bytes seen while fitting, and one for all others. A node is a context
    of up to ORDER symbols; a position is coded in its longest context that has a node.
    """

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages = sorted(counts)
        grams = np.concatenate([g for g, _ in counts.values()])
        seen = np.unique(np.concatenate([(grams >> (8 * k)) & 255 for k in range(ORDER + 1)]))
        self.symbol = np.zeros(256, np.int64)  # 0: bytes never seen
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        self.size = a = len(seen) + 1
        coded = {}
        for lang, (gram, n) in counts.items():
            code = np.zeros(len(gram), np.int64)
            for k in range(ORDER, -1, -1):
                code = code * a + self.symbol[(gram >> (8 * k)) & 255]
            coded[lang] = (code, n)
        # while blending, symbol 0 stands for all bytes never seen together
        tables = {lang: np.full((1, a), 1 / a) for lang in coded}
        #: nodes[d]: node number by packed context of d symbols, or that of the longest shorter one.
        nodes = np.zeros(1, np.int32)
        for d in range(ORDER + 1):
            parent = np.tile(nodes, a) if d else nodes
            per_lang = {}
            total = np.zeros(a**d, np.int64)
            for lang, (code, n) in coded.items():
                key, at = np.unique(code % a ** (d + 1), return_inverse=True)
                per_lang[lang] = (key, np.bincount(at, weights=n, minlength=len(key)))
                np.add.at(total, key // a, per_lang[lang][1].astype(np.int64))
            own = np.flatnonzero(total >= (LEAST if d else 0))
            first = len(next(iter(tables.values())))
            number = parent.copy()
            number[own] = first + np.arange(len(own), dtype=np.int32)
            place = np.full(a**d, -1, np.int32)
            place[own] = np.arange(len(own), dtype=np.int32)
            del total
            for lang, (key, n) in per_lang.items():
                count = np.zeros((len(own), a))
                row = place[key // a]
                count[row[row >= 0], (key % a)[row >= 0]] = n[row >= 0]
                lower = tables[lang]
                for i in range(0, len(own), ROWS):  # some rows at a time, as blending takes several copies
                    count[i : i + ROWS] = self._blended(count[i : i + ROWS], lower[parent[own[i : i + ROWS]]])
                tables[lang] = np.concatenate((lower, count))
                del count, lower
            nodes = number
        self.node = nodes.astype(np.int32)
        self.bits = np.empty((len(tables[self.languages[0]]) * a, len(self.languages)), np.float32)
        for k, lang in enumerate(self.languages):
            bits = -np.log2(tables.pop(lang))
            bits[:, 0] += np.log2(max(256 - len(seen), 1))
            self.bits[:, k] = bits.ravel()

    @staticmethod
    def _blended(count: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Seen symbols by their counts; the escape, as likely as the number of distinct ones, shares the rest as the
        shorter context does, without the symbols seen here. Each row sums to 1."""
        total, distinct = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
        rest = np.where(count > 0, 0, lower)
        left = rest.sum(1, keepdims=True)
        escape = np.where(left > 0, distinct, 0)
        seen = count / np.maximum(total + escape, 1)
        out = seen + rest * (escape / np.maximum(total + escape, 1) / np.where(left > 0, left, 1))
        return np.where(total > 0, out, lower)

    def code_lengths(self, texts: pa.Array) -> np.ndarray:
        """Bits that each language's model needs for each whole text."""
        a, out = self.size, []
        raw = pc.fill_null(texts, "").to_pylist()
        data = [t.encode() for t in raw]
        sizes = np.array([len(t) for t in data], np.int64)
        # every text is padded in front, so that no context reaches into another text
        whole = np.frombuffer(b"".join(b"\0" * ORDER + t for t in data), np.uint8)
        symbols = self.symbol[whole].astype(np.int32)
        context = np.zeros(len(symbols) - ORDER, np.int32) if len(symbols) > ORDER else np.zeros(0, np.int32)
        for k in range(ORDER):
            context = context * a + symbols[k : k + len(context)]
        place = self.node[context] * np.int32(a) + symbols[ORDER:]
        begin = np.cumsum(sizes + ORDER) - (sizes + ORDER)
        for lang in range(len(self.languages)):
            sums = np.concatenate([[0.0], np.cumsum(self.bits[:, lang][place], dtype=np.float64)])
            ends = np.minimum(begin + sizes, len(sums) - 1)
            out.append(sums[ends] - sums[np.minimum(begin, len(sums) - 1)])
        return np.stack(out, axis=1)

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The language of the shortest code, and its share when every language is equally likely before."""
        bits = self.code_lengths(texts)
        best = bits.argmin(axis=1)
        share = 1 / np.exp2(-np.minimum(bits - bits.min(axis=1, keepdims=True), 1000)).sum(axis=1)
        return best, share


def fitted(labelled: DataFrame) -> Model | None:
    """Models of all languages of the labelled rows; None if there is none.

    Of each language about FITTED different texts, chosen by their hash (all if there are fewer),
    are counted once each in Spark; the counts, bounded by that sample, make the table.
    """
    rows = labelled.filter("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("_hash"))
    different = rows.select("lang", "_hash").distinct()
    counts = {r.lang: r.n for r in different.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    cells = 1_000_000
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(-(-cells * FITTED // n))) for k, n in counts.items()])
    some = rows.filter(F.pmod("_hash", F.lit(cells)) < share).groupBy("lang", "_hash").agg(F.first("text").alias("text"))
    found: dict[str, tuple[array, array]] = {}
    for r in contexts_counted(some).toLocalIterator():
        gram, n = found.setdefault(r.lang, (array("q"), array("q")))
        gram.append(r.gram)
        n.append(r.n)
    model = Model({k: (np.array(g, np.int64), np.array(n, np.int64)) for k, (g, n) in found.items()}) if found else None
    trim()
    return model


def predicted(model: Model | None, texts: pa.Array) -> tuple[list[str], list[float]]:
    """Language and score (0 to 1) per text; `und` with 0 for null texts, texts without a letter, and without a model."""
    known = pc.fill_null(pc.match_substring_regex(texts, "\\p{L}"), False)
    if model is None:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    langs: list[str] = []
    scores: list[float] = []
    batch = pa.RecordBatch.from_arrays([pc.if_else(known, texts, ""), known], ["text", "known"])
    for part in sliced([batch], "text", CHUNK):
        best, share = model.predict(part.column("text"))
        for b, s, ok in zip(best.tolist(), share.tolist(), part.column("known").to_pylist()):
            langs.append(model.languages[b] if ok else UNKNOWN)
            scores.append(s if ok else 0.0)
    return langs, scores


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every document, from its whole text alone.

    Repeated rows and null doc_id are kept; other columns are not read.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = predicted(sent.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model | None, least: float = 0.3) -> DataFrame:
    """The documents, all columns, whose text is in a learned language with that score; all with letters if none was learned."""
    ship(docs.sparkSession)
    sent, place = sent_value(docs.sparkSession, model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(place)
            if sent.value is None:
                stay = pc.fill_null(pc.match_substring_regex(text, "\\p{L}"), False)
            else:
                langs, scores = predicted(sent.value, text)
                stay = pa.array([k != UNKNOWN and s >= least for k, s in zip(langs, scores)], pa.bool_())
            yield batch.filter(stay)

    return docs.mapInArrow(trimmed(run), docs.schema)


def held_out():
    """One third of the documents by a checksum of their id; never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fitted(docs.filter(~held_out()))
    return identified(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
