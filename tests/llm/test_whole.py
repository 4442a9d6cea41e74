"""Rows that the operators once left out, against plain versions."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from fairlead.llm import decontaminate, language, simhash, tokencounts
from tests.llm import cases
from tests.llm.test_operators import ids_of


def plain_overlap(text, item):
    """Words and equal words of the whole item or of the longest run that counts, by all runs of all diagonals."""
    best = (0, 0)
    for d in range(-len(text) + 1, len(item)):
        on = [j for j in range(len(item)) if 0 <= j - d < len(text)]
        equal = [item[j] == text[j - d] for j in on]
        if 10 * sum(equal) >= 8 * len(item):
            best = max(best, (len(item), sum(equal)))
        for a in range(len(on)):
            for b in range(a + 13, len(on) + 1):
                same = sum(equal[a:b])
                if 10 * same >= 8 * (b - a):
                    best = max(best, (b - a, same))
    return best


def test_partial_overlaps_with_substitutions():
    rnd = random.Random(4)
    items = [[f"i{n}w{k}" for k in range(rnd.randrange(30, 45))] for n in range(12)]
    texts = [[*"before it".split(), *items[0][5:15], "zz", *items[0][16:19], "after"]]
    for n in range(400):
        item = items[n % len(items)]
        size = rnd.randrange(10, 28)
        at = rnd.randrange(len(item) - size + 1)
        part = item[at : at + size]
        for k in rnd.sample(range(size), rnd.randrange(size // 4 + 1)):
            part[k] = f"zz{k}"
        texts.append(["x"] * rnd.randrange(4) + part + ["y"] * rnd.randrange(4))
    block = decontaminate.Benchmark(list(range(len(items))), [" ".join(i) for i in items])
    got = block.overlaps(pa.array([" ".join(t) for t in texts]))
    found = {int(r): (int(o), int(e)) for r, o, e in zip(got["row"], got["overlap"], got["equal"])}
    want = {n: plain_overlap(t, items[max(n - 1, 0) % len(items)]) for n, t in enumerate(texts)}
    assert found == {n: w for n, w in want.items() if w[0]} and found[0] == (16, 13)


def test_every_place_of_substitutions_is_found():
    for size in range(5, 19):
        item = [f"w{k}" for k in range(size)]
        texts = [" ".join("zz" if k in places else w for k, w in enumerate(item)) for places in combinations(range(size), size // 5)]
        got = decontaminate.Benchmark([1], [" ".join(item)]).overlaps(pa.array(texts))
        assert np.array_equal(got["row"], np.arange(len(texts)))


def test_items_without_id_are_kept_from_the_documents(spark):
    items = spark.createDataFrame([(None, "five words of an item"), (None, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "here are five words of an item"), (2, "nothing of it")], "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.decontaminated(docs, items).collect()] == [2]
    assert decontaminate.contaminations(docs, items).count() == 0


def test_every_labelled_language_is_learned_however_often_its_texts_repeat(spark):
    rnd = random.Random(3)
    few = [(cases.sentence(rnd, 20), "few") for _ in range(5)]
    rows = few * 2000 + [(f"{cases.sentence(rnd, 12)} {k}", "many") for k in range(4000)] + [("same text again", "many")] * 3000
    labelled = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    seen = {}
    counted = language.contexts_counted

    def watched(some):
        seen.update({r.lang: (r.n, r.d) for r in some.groupBy("lang").agg({"*": "count", "text": "max"}).toDF("lang", "n", "d").collect()})
        return counted(some)

    language.contexts_counted = watched
    try:
        model = language.fitted(labelled)
    finally:
        language.contexts_counted = counted
    assert model.languages == ["few", "many"] and seen["few"][0] == 5 and 1300 < seen["many"][0] < 1700


def test_simhash_keeps_the_other_texts_of_a_repeated_id(spark):
    kept = {(r.doc_id, r.text) for r in simhash.deduplicated(cases.table(spark)).filter("doc_id is not null").collect()}
    rows = cases.rows()
    assert (3, rows[19][1]) in kept and (3, rows[3][1]) not in kept and (1, rows[0][1]) in kept
    rnd = random.Random(9)
    docs = [(7, cases.sentence(rnd, 60)) for _ in range(30)]
    table = spark.createDataFrame(docs + docs[:5], "doc_id long, text string").repartition(3)
    assert sorted((r.doc_id, r.text) for r in simhash.deduplicated(table).collect()) == sorted(docs)


@pytest.mark.parametrize("end", ["<|endoftext|>", ""])
def test_separator_in_a_text_is_counted_in_its_document(spark, end):
    docs = [(1, f"one {end} two{end}"), (2, end), (None, f"{end}{end} three"), (None, None), (2, f"again {end}"), (-1, "é" + end), (-(2**63), "x")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    for parts in (1, 3):
        got = tokencounts.token_counts(table.repartition(parts)).collect()
        assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted((str(i), len(ids_of(t))) for i, t in docs)
