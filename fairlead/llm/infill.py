"""Fill-in-middle transformation: texts cut at two code points and put together in another order.

Where code points begin is kept as a set of byte offsets in compressed containers of 65,536 bytes
(array, bitmap or runs, whichever is smallest) with cumulative cardinalities. A cut is the k-th member
of that set: a search among the containers, then a select within one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.llm.text import documents, ship, sliced

SPAN = 1 << 16
CHUNK = 4 << 20
#: The marks, and the shares in percent of texts left plain and of the second order.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TURNED, SUFFIX_FIRST = 90, 20
SEED = "1"


class ArrayContainer:
    """Few members: their offsets."""

    def __init__(self, at: np.ndarray):
        self.at = at.astype(np.uint16)

    def select(self, k: np.ndarray) -> np.ndarray:
        return self.at[k].astype(np.int64)


class RunContainer:
    """Members that follow each other: first offsets of the runs, and members before each."""

    def __init__(self, first: np.ndarray, length: np.ndarray):
        self.first, self.before = first.astype(np.uint16), np.cumsum(length) - length

    def select(self, k: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, k, side="right") - 1
        return self.first[run].astype(np.int64) + k - self.before[run]


class BitmapContainer:
    """Many members: one bit per offset, and members before each byte of bits."""

    #: offset of the j-th set bit of each byte, highest bit first
    PLACE = np.array([[*(i for i in range(8) if b >> (7 - i) & 1), *[0] * 8][:8] for b in range(256)], np.int64)

    def __init__(self, member: np.ndarray):
        self.bits = np.packbits(member)
        count = np.bitwise_count(self.bits).astype(np.int64)
        self.before = np.cumsum(count) - count

    def select(self, k: np.ndarray) -> np.ndarray:
        byte = np.searchsorted(self.before, k, side="right") - 1
        return byte * 8 + self.PLACE[self.bits[byte], k - self.before[byte]]


def container(member: np.ndarray):
    """The smallest container of the members (a mask of one span)."""
    edges = np.diff(np.concatenate([[0], member.view(np.int8), [0]]))
    first, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sizes = {"runs": 4 * len(first), "array": 2 * int((end - first).sum()), "bitmap": SPAN // 8}
    kind = min(sizes, key=sizes.__getitem__)
    if kind == "runs":
        return RunContainer(first, end - first)
    return ArrayContainer(np.flatnonzero(member)) if kind == "array" else BitmapContainer(member)


class Boundaries:
    """Where the code points of some UTF-8 bytes begin, and where they end as the last member."""

    def __init__(self, data: np.ndarray):
        member = np.append((data & 0xC0) != 0x80, True)
        parts = [member[a : a + SPAN] for a in range(0, len(member), SPAN)]
        self.containers = [container(p) for p in parts]
        cardinality = np.array([np.count_nonzero(p) for p in parts], np.int64)
        self.before = np.cumsum(cardinality) - cardinality

    def select(self, k: np.ndarray) -> np.ndarray:
        """Byte offset of the k-th boundary, from 0."""
        at = np.searchsorted(self.before, k, side="right") - 1
        out = np.zeros(len(k), np.int64)
        for c in np.unique(at).tolist():
            mine = at == c
            out[mine] = c * SPAN + self.containers[c].select(k[mine] - self.before[c])
        return out


def draws(doc_ids: list[int | None], seed: str = SEED) -> np.ndarray:
    """Four 32-bit numbers per document: the first digits of the sha256 of seed:doc_id (nothing for a null id)."""
    digests = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in doc_ids)
    return np.frombuffer(digests, ">u4").reshape(-1, 4).astype(np.int64)


def rebuilt(output: str, form: str) -> str:
    """The text that an output was made of."""
    if form == "psm":
        prefix, rest = output[len(PREFIX) :].split(SUFFIX, 1)
        suffix, middle = rest.split(MIDDLE, 1)
    elif form == "spm":
        suffix, rest = output[len(SUFFIX) :].split(PREFIX, 1)
        prefix, middle = rest.split(MIDDLE, 1)
    else:
        return output
    return prefix + middle + suffix


def transformed_texts(doc_ids: list[int | None], texts: pa.Array) -> list[tuple[int, str, int | None, int | None, str]]:
    """(code points, form, prefix, middle, output) per document."""
    raw = [(t or "").encode() for t in texts.to_pylist()]
    data = np.frombuffer(b"".join(raw), np.uint8)
    sizes = np.array([len(t) for t in raw], np.int64)
    start = np.cumsum(sizes) - sizes
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    n = begins[start + sizes] - begins[start]
    h = draws(doc_ids)
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    # the n-th boundary of a text is the first one of the next, so ranks run on
    offset = Boundaries(data).select((begins[start][:, None] + cuts).ravel()).reshape(-1, 2) - start[:, None]
    out = []
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    for text, size, (first, second), (a, b), (_, _, turn, order) in zip(raw, n.tolist(), cuts.tolist(), offset.tolist(), h.tolist()):
        if not text or turn % 100 >= TURNED or any(m in text for m in marks):
            out.append((size, "plain", None, None, text.decode()))
            continue
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        p, s, m = marks
        spm = order % 100 < SUFFIX_FIRST
        pieces = (s, suffix, p, prefix, m, middle) if spm else (p, prefix, s, suffix, m, middle)
        out.append((size, "spm" if spm else "psm", first, second - first, b"".join(pieces).decode()))
    return out


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def transformed(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every document.

    Null and empty texts and texts that hold a mark stay plain (a null text as an empty one);
    repeated rows are kept; a null doc_id draws as an empty one; other columns are not read.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", CHUNK):
            ids = batch.column("doc_id")
            n, form, prefix, middle, output = zip(*transformed_texts(ids.to_pylist(), batch.column("text")))
            longs = [pa.array(c, pa.int64()) for c in (n, prefix, middle)]
            yield pa.RecordBatch.from_arrays(
                [ids, longs[0], pa.array(form), *longs[1:], pa.array(output, pa.string())], [f.split(" ")[0] for f in SCHEMA.split(", ")]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def digests(docs: DataFrame) -> DataFrame:
    """The transformed rows with hashes in place of texts: of the output, and of the text rebuilt from it and the form."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "output", CHUNK):
            output, form = batch.column("output").to_pylist(), batch.column("form").to_pylist()
            made = [hashlib.sha256(o.encode()).hexdigest() for o in output]
            again = [hashlib.sha256(rebuilt(o, f).encode()).hexdigest() for o, f in zip(output, form)]
            kept = [batch.column(c) for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(made, pa.string()), pa.array(again, pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
            )

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return transformed(docs).mapInArrow(run, schema)


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))


ORACLE_SQL = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), cut AS (
    SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
        CASE
            WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
            WHEN CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
            WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm'
            ELSE 'psm'
        END AS form
    FROM drawn
), piece AS (
    SELECT *, substring(t, 1, least(c1, c2)) AS p, substring(t, least(c1, c2) + 1, abs(c1 - c2)) AS m, substring(t, greatest(c1, c2) + 1) AS s
    FROM cut
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN least(c1, c2) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN abs(c1 - c2) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END)
        AS output_sha256,
    sha256(CASE WHEN form = 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM piece
"""
