"""Repetitive, regex-hostile and very long texts, and packings of every shape of lengths."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fairlead.llm import decontaminate, packing, secrets, text
from tests.llm.test_whole import plain_overlap


def spans_of(spark, pattern, values):
    df = spark.createDataFrame([(v,) for v in values], "text string")
    return [[(s.start, s.end, s.hit) for s in r[0]] for r in df.select(secrets._found(F.col("text"), pattern)).collect()]


def test_positions_of_many_matches(spark):
    rnd = random.Random(2)
    values = ["", "x", "1", "é1é22 333", "".join(rnd.choice("ab1é ") for _ in range(3000)), "1 " * 100_000]
    start = time.time()
    got = spans_of(spark, "[0-9]+", values)
    assert got == [[(m.start(), m.end(), m.group()) for m in re.finditer("[0-9]+", v)] for v in values]
    assert time.time() - start < 30


HOSTILE = ["/a1" * 340_000 + "/b22+", "a1-b2-" * 170_000, "ab-" * 340_000 + "x9+/Q", "ab_cd-" * 170_000 + "z1"]


@pytest.mark.parametrize("value", HOSTILE)
def test_patterns_survive_long_paths(spark, value):
    df = spark.createDataFrame([(1, value)], "doc_id long, text string")
    start = time.time()
    assert secrets.scanned(df).count() == 1 and secrets.scanned(df).collect()[0].doc_id == 1
    assert time.time() - start < 90


def plain_entropy(value, window):
    best = 0.0
    for i in range(len(value) - window + 1):
        _, n = np.unique(list(value[i : i + window]), return_counts=True)
        best = max(best, float(-(n / window * np.log2(n / window)).sum()))
    return best


def test_entropy_of_long_candidates_is_linear_and_right(spark):
    rnd = random.Random(3)
    letters = secrets.ALPHABET
    values = ["".join(rnd.choice(letters[: rnd.randrange(2, 60)]) for _ in range(n)) for n in (5, 20, 21, 300, 2000)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(secrets.window_entropy(F.col("v"))).collect()]
    assert np.allclose(got, [plain_entropy(v, 20) for v in values])
    blob = "".join(rnd.choice(letters) for _ in range(200_000))
    start = time.time()
    found = secrets.scanned(spark.createDataFrame([(1, f"x {blob} y")], "doc_id long, text string")).collect()[0]
    assert any(s.start == 2 and s.end == 200_002 for s in found.spans) and time.time() - start < 60


def test_allowed_forms_are_those_of_backtracking_patterns(spark):
    """Possessive groups accept what the plain ones do."""
    plain = {
        secrets.ALLOWED[2]: "^(/?[A-Za-z][a-z_-]*[0-9]{0,2})(/[A-Za-z]?[a-z_-]*[0-9]{0,2})+$",
        secrets.ALLOWED[5]: "^([a-z]+[-_])+[0-9a-z]{1,4}$",
    }
    rnd = random.Random(4)
    values = ["".join(rnd.choice("aB1/-_2z") for _ in range(rnd.randrange(1, 14))) for _ in range(4000)]
    values += ["/usr/lib/x86", "a-b-c1", "ab_cd-12345", "/a/b//", "A1/b22/"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for possessive, backtracking in plain.items():
        got = [r[0] for r in df.select(F.col("v").rlike(possessive)).collect()]
        assert got == [bool(re.search(backtracking, v)) for v in values] and any(got)


# ---- decontamination ---------------------------------------------------------------


def test_repetitive_text_and_item_are_bounded():
    item = " ".join(["same"] * 200)
    block = decontaminate.Benchmark([1, 2], [item, "other words of an item that is never in there at all"])
    start = time.process_time()
    got = block.overlaps(pa.array([" ".join(["same"] * 400_000), "same " * 100, "nothing here"]))
    assert got["row"].tolist() == [0, 1] and got["overlap"].tolist() == [200, 100] and got["equal"].tolist() == [200, 100]
    assert time.process_time() - start < 60


def test_periodic_texts_against_all_runs(monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 7)
    rnd = random.Random(6)
    items = ["a b " * 15, "a a b " * 9, "c d e f g h " * 4, " ".join(rnd.choice("ab") for _ in range(40)), "a b c d e"]
    texts = ["a b " * 40, "a a b a b " * 12, "x " + "c d e f g h " * 3, " ".join(rnd.choice("abc") for _ in range(120)), "z a b c d e z", "q"]
    block = decontaminate.Benchmark(list(range(len(items))), items)
    got = block.overlaps(pa.array(texts))
    found = {(int(r), int(i)): (int(o), int(e)) for r, i, o, e in zip(got["row"], got["item"], got["overlap"], got["equal"])}
    want = {(r, i): plain_overlap(t.split(), x.split()) for r, t in enumerate(texts) for i, x in enumerate(items)}
    assert found == {k: w for k, w in want.items() if w[0]}


# ---- packing -----------------------------------------------------------------------

LAWS = {
    "lognormal 7.2": lambda r: np.exp(r.normal(7.2, 0.5, 20_000)),
    "lognormal 7.3": lambda r: np.exp(r.normal(7.3, 0.3, 20_000)),
    "lognormal 7.6": lambda r: np.exp(r.normal(7.6, 0.2, 20_000)),
    "bimodal": lambda r: np.where(r.random(20_000) < 0.5, r.normal(700, 60, 20_000), r.normal(2500, 100, 20_000)),
    "constant": lambda r: np.full(20_000, 1366),
    "small": lambda r: np.exp(r.normal(5.0, 1.0, 20_000)),
}


@pytest.mark.parametrize("law", LAWS)
def test_plan_is_never_worse_than_best_fit(law):
    lengths = np.clip(LAWS[law](np.random.default_rng(1)), 1, 4096).astype(int)
    key, n = np.unique(lengths, return_counts=True)
    histogram = dict(zip(key.tolist(), n.tolist()))
    kinds = packing.plan(histogram)
    used = {}
    for parts, many in kinds:
        assert sum(k * c for k, c in parts) <= 4096
        for k, c in parts:
            used[k] = used.get(k, 0) + c * many
    assert used == histogram
    alone = sum(m for _, m in packing.grouped_plan(histogram, 0))
    total = sum(m for _, m in kinds)
    assert -(-int(lengths.sum()) // 4096) <= total <= alone


# ---- shared folder -----------------------------------------------------------------


def test_only_one_machine_may_use_its_own_folder(monkeypatch):
    assert all(map(text.is_local, ("local", "local[8]", "local[*]")))
    assert not any(map(text.is_local, ("local-cluster[2,1,1024]", "yarn", "spark://host:7077", "k8s://x")))

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError):
        text.shared_folder(Session())
