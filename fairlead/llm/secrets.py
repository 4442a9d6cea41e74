"""Secret scans by patterns and sliding-window entropy; DataFrame functions only."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.llm.text import documents

#: The kinds of plain secrets and what a match must have.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
#: Runs shorter than asked for fail, so asking for the length in the pattern finds the same spans.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"

#: Candidate strings of the entropy scan, its window, and the least entropy by class of characters.
CANDIDATE = "[A-Za-z0-9+/_-]{20,}"
WINDOW = 20
HEXADECIMAL = "^[0-9a-fA-F]+$"
LEAST = {"hexadecimal": 3.0, "mixed": 3.8}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
#: Candidates that are no secrets: words and names, plain numbers, paths, UUIDs, counted-up alphabets. Repeated groups
#: are possessive: the parts end at a sign that they cannot hold, so giving characters back never helps, and the engine
#: would keep a stack frame per repetition otherwise.
ALLOWED = (
    "^[A-Za-z_/+-]+$",
    "^[0-9_/+-]+$",
    "^/?[A-Za-z][a-z_-]*+[0-9]{0,2}+(/[A-Za-z]?+[a-z_-]*+[0-9]{0,2}+)++$",
    "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    "(?i)0123456789|abcdefghij|qwertyuiop",
    "^([a-z]++[-_])++[0-9a-z]{1,4}$",
)


def _once(value: Column, use) -> Column:
    """use(value) with the value computed once: a plain column is computed anew wherever a lambda names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _found(text: Column, pattern: str) -> Column:
    """array<struct<start, end, hit>> of the leftmost non-overlapping matches, in code points.

    What stands between the matches gives the positions: their lengths are summed up, in parts of about
    the square root of the number of matches, since adding to an array copies it.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(
        hits, F.transform(F.split(text, pattern, -1), lambda g: F.length(g)), lambda h, g: F.struct(h.alias("hit"), g.alias("gap"))
    )
    pairs = F.filter(pairs, lambda p: p["hit"].isNotNull())
    spans = F.array().cast("array<struct<start:int,end:int,hit:string>>")

    def shifted(s: Column, by: Column) -> Column:
        return F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["hit"].alias("hit"))

    def walked(part: Column) -> Column:
        """Spans of some matches as if the text began with them, and where the last one ends."""
        return F.aggregate(
            part,
            F.struct(F.lit(0).alias("at"), spans.alias("out")),
            lambda s, p: F.struct(
                (s["at"] + p["gap"] + F.length(p["hit"])).alias("at"),
                F.concat(
                    s["out"],
                    F.array(
                        F.struct(
                            (s["at"] + p["gap"]).alias("start"), (s["at"] + p["gap"] + F.length(p["hit"])).alias("end"), p["hit"].alias("hit")
                        )
                    ),
                ).alias("out"),
            ),
        )

    def parts(all_: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(all_))).cast("int")
        return F.transform(F.sequence(F.lit(1), F.size(all_), width), lambda k: walked(F.slice(all_, k, width)))

    def joined(found: Column) -> Column:
        begins = F.aggregate(
            found, F.array(F.lit(0)), lambda s, w: F.concat(s, F.array(F.element_at(s, -1) + w["at"]))
        )
        return F.flatten(
            F.zip_with(found, F.slice(begins, F.lit(1), F.size(found)), lambda w, by: F.transform(w["out"], lambda s: shifted(s, by)))
        )

    return F.when(text.rlike(pattern), _once(pairs, lambda all_: _once(parts(all_), joined))).otherwise(spans)


def window_entropy(value: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits, of the windows of a string over ALPHABET.

    Counts per character are kept while the window slides: each step adds one character and
    removes one, and changes the sum of c * log2(c) by these two.
    """

    def weight(c: Column) -> Column:
        return F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))

    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))

    def paired(codes: Column) -> Column:
        return F.transform(codes, lambda c, i: F.struct(c.alias("come"), F.when(i >= window, F.get(codes, i - window)).alias("go"), i.alias("i")))

    indexed = _once(codes, paired)

    def step(s: Column, x: Column) -> Column:
        come = F.element_at(s["counts"], x["come"])
        go = F.when(x["go"].isNotNull(), F.element_at(s["counts"], x["go"]) + (x["go"] == x["come"]).cast("int"))
        total = s["total"] + weight(come + 1) - weight(come) + F.when(go.isNotNull(), weight(go - 1) - weight(go)).otherwise(0.0)
        counts = F.transform(
            s["counts"],
            lambda c, k: c + (k + 1 == x["come"]).cast("int") - F.coalesce((k + 1 == x["go"]).cast("int"), F.lit(0)),
        )
        now = F.when(x["i"] >= window - 1, F.lit(math.log2(window)) - total / window).otherwise(0.0)
        return F.struct(counts.alias("counts"), total.alias("total"), F.greatest(s["best"], now).alias("best"))

    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best")
    )
    return F.aggregate(indexed, start, step, lambda s: s["best"])


def _suspicious(hit: Column) -> Column:
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | hit.rlike(pattern)
    least = F.when(hit.rlike(HEXADECIMAL), LEAST["hexadecimal"]).otherwise(LEAST["mixed"])
    return F.when(allowed, False).otherwise(window_entropy(hit) >= least)


def _of_kind(spans: Column, kind: str) -> Column:
    """Spans in the order of comparison: start, then kind as listed."""
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end"))
    )


def plain_spans(text: Column) -> Column:
    """array<struct<start, kind, end>>: assignments, access keys and long hexadecimal strings, sorted."""
    assign = F.filter(_found(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 2)) >= ASSIGN_VALUE)
    # cheap looks first: most texts have none of what a kind needs
    assign = F.when(text.contains("=") | text.contains(":"), assign).otherwise(F.filter(_found(F.lit(""), ASSIGN), lambda s: F.lit(False)))
    kinds = {"assign": assign, "access": _found(text, ACCESS), "hex": _found(text, HEX)}
    return F.array_sort(F.concat(*[_of_kind(spans, kind) for kind, spans in kinds.items()]))


def entropy_spans(text: Column) -> Column:
    """array<struct<start, kind, end>>: candidate strings with a window of high entropy that no allowed form explains."""
    return _of_kind(F.filter(_found(text, CANDIDATE), lambda s: _suspicious(s["hit"])), "entropy")


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) per row: plain spans, and all spans, sorted by start and kind.

    A null text counts as empty; spans of different kinds may overlap; repeated rows and null
    doc_id are kept; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    found = rows.select("doc_id", plain_spans(F.col("text")).alias("base"), entropy_spans(F.col("text")).alias("more"))
    return found.select("doc_id", "base", F.array_sort(F.concat("base", "more")).alias("spans"))


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents, all columns, every span (overlapping ones joined) replaced by a mark and n_chars set anew.

    Null texts stay null.
    """
    spans = f"spans_{uuid.uuid4().hex}"
    text = F.col("text")
    found = docs.withColumn(
        spans, F.array_sort(F.concat(plain_spans(F.coalesce(text, F.lit(""))), entropy_spans(F.coalesce(text, F.lit("")))))
    )
    cut = F.aggregate(
        F.col(spans),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda s, x: F.when(x["end"] <= s["at"], s).otherwise(
            F.struct(
                x["end"].alias("at"),
                F.when(x["start"] < s["at"], s["out"])
                .otherwise(F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(mark)))
                .alias("out"),
            )
        ),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
    )
    some = F.size(spans) > 0
    out = found.withColumn("text", F.when(some, cut).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(some, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return scanned(documents(spark, sf_dir)).select(
        "doc_id", *[count(k) for k in KINDS[:3]], F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )
