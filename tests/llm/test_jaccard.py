"""The near-duplicate stage against all pairs of exact Jaccard similarities."""

import random
import re

import numpy as np
import pyarrow as pa

import corpus_pipeline
from fairlead.llm import jaccard
from tests.llm import cases
from tests.llm.test_operators import SF, SPACE


def plain_set(t):
    w = re.findall(SPACE, (t or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))}


def plain_survivors(docs):
    """(id, text) of the smallest id in each group by all pairs."""
    sets = [plain_set(t) for _, t in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] == sets[j] or 10 * common >= 8 * (len(sets[i]) + len(sets[j]) - common) > 0:
                group = [group[j] if g == group[i] else g for g in group]
    return {min(i for k, (i, _) in enumerate(docs) if group[k] == g) for g in set(group)}


def changed(rnd, words, n):
    words = list(words)
    for k in rnd.sample(range(len(words)), n):
        words[k] = f"other{rnd.random()}"
    return " ".join(words)


def test_stage_keeps_one_of_each_group_of_five_word_jaccard(spark):
    rnd = random.Random(5)
    docs = []
    for _ in range(25):  # each family: near copies on both sides of 0.8, also of one another
        base = [f"{rnd.choice(cases.WORDS)}{rnd.randrange(50)}" for _ in range(rnd.randrange(80, 400))]
        docs += [changed(rnd, base, n) for n in (0, 0, 1, 2, 3, 4, 6, 9)]
    docs += ["", " ", "two words", "Two  words", "three other words"]
    rnd.shuffle(docs)
    docs = list(enumerate(docs))
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, table, SF).collect()}
    want = plain_survivors(docs)
    assert len(want) < 180 and len(got ^ want) <= 1  # a pair of 0.8 exactly shares no band once in 250


def test_large_group_of_near_copies_takes_few_pairs(spark):
    rnd = random.Random(6)
    base = [f"w{k}" for k in range(150)]
    docs = [(k, changed(rnd, base, 1)) for k in range(300)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    sketched = jaccard.with_sketches(table)
    assert jaccard.links(table, sketched).count() < 20 * len(docs)
    assert [r.doc_id for r in jaccard.deduplicated(table).collect()] == [0]


def test_one_id_with_several_texts_keeps_each_group(spark):
    rnd = random.Random(8)
    a, b, c = ([f"w{rnd.random()}" for _ in range(200)] for _ in range(3))
    docs = [(1, " ".join(a)), (3, changed(rnd, a, 1)), (3, " ".join(b)), (3, " ".join(c)), (3, " ".join(c)), (5, changed(rnd, b, 1))]
    kept = jaccard.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([docs[0], docs[2], docs[3]])
    assert jaccard.deduplicated(cases.empty(spark)).count() == 0


def test_simhash_and_pivot_tables_link_without_a_common_band(spark):
    from pyspark.sql import functions as F

    rnd = random.Random(9)
    base = [f"w{rnd.random()}" for _ in range(1500)]
    docs = [(0, " ".join(base)), (1, changed(rnd, base, 1)), (2, changed(rnd, base, 2)), (3, " ".join(f"v{rnd.random()}" for _ in range(1500)))]
    table = spark.createDataFrame([*docs, (4, ""), (5, "two words")], "doc_id long, text string")
    sketched = jaccard.with_sketches(table)
    node = {r.doc_id: r.node for r in sketched.collect()}
    apart = sketched.withColumn("keys", F.array("node"))  # no two share a band
    found = {frozenset((r.a, r.b)) for r in jaccard.links(table, apart).collect()}
    assert found and found <= {frozenset((node[a], node[b])) for a in range(3) for b in range(a)}
    assert all(any(node[k] in pair for pair in found) for k in range(3))


def test_every_pair_of_a_band_or_of_near_fingerprints_is_compared(spark):
    from pyspark.sql import functions as F

    rnd = random.Random(10)
    a, b = ([f"w{rnd.random()}" for _ in range(200)] for _ in range(2))
    docs = [(0, " ".join(a)), (1, changed(rnd, a, 1)), (2, " ".join(b)), (3, changed(rnd, b, 1))]
    docs += [(k, " ".join(f"v{rnd.random()}" for _ in range(50))) for k in range(4, 44)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    sketched = jaccard.with_sketches(table).withColumn("keys", F.array("node")).withColumn("fp", F.col("node"))
    node = {r.doc_id: r.node for r in sketched.collect()}
    want = {frozenset((node[0], node[1])), frozenset((node[2], node[3]))}
    assert min(node, key=node.get) > 3 and max(node, key=node.get) > 3  # those that all are compared with are like none of them
    banded = sketched.withColumn("keys", F.array(F.lit(1).cast("long")))  # all in one band, no two fingerprints near
    assert {frozenset((r.a, r.b)) for r in jaccard.links(table, banded).collect()} == want
    # No two share a band. 0 and 1 have the fingerprint of many other texts; 2 and 3 are linked to it under a mask each, and meet under two others
    x, y = (sum(1 << k for k in bits) for bits in ((0, 20, 40), (20, 40, 50)))
    fp = F.when(F.col("doc_id") == 2, x).when(F.col("doc_id") == 3, y).otherwise(0)
    found = {frozenset((r.a, r.b)) for r in jaccard.links(table, sketched.withColumn("fp", fp.cast("long"))).collect()}
    assert found == want


def test_parities_bound_the_difference_of_sets():
    rnd = random.Random(12)
    texts = [" ".join(f"w{rnd.randrange(40)}" for _ in range(rnd.randrange(300))) for _ in range(40)] + ["", "a"]
    counts, hashes = jaccard.shingles(pa.array(texts))
    bits = jaccard.parities(counts, hashes).view(np.uint64).reshape(len(texts), -1)
    sets = [set(x.tolist()) for x in np.split(hashes, np.cumsum(counts)[:-1])]
    for s, b in zip(sets, bits):
        want = [0] * jaccard.PARITIES
        for h in s:
            want[h >> 60] ^= 1 << (h >> 54 & 63)
        assert b.tolist() == want
    assert all(np.bitwise_count(x ^ y).sum() <= len(s ^ t) for s, x in zip(sets, bits) for t, y in zip(sets, bits))


def test_documents_without_id_are_deduplicated_too(spark):
    rnd = random.Random(11)
    a, b, c = ([f"w{rnd.random()}" for _ in range(200)] for _ in range(3))
    docs = [(None, changed(rnd, a, 1)), (1, " ".join(a)), (None, " ".join(b)), (None, " ".join(b)), (None, changed(rnd, b, 1))]
    docs += [(None, " ".join(c)), (None, None), (None, "")]
    kept = [r.text for r in jaccard.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()]
    assert len(kept) == 4 and {docs[1][1], docs[5][1]} < set(kept)
    assert sum(t in {d[1] for d in docs[2:5]} for t in kept) == 1 and sum(not t for t in kept) == 1


def test_stages_give_back_what_earlier_ones_sent(spark):
    from fairlead.llm import text

    table = cases.table(spark)
    for name, stage in corpus_pipeline.STAGES[:3]:
        text.sent(spark, [name])
        before = list(text._SENT)
        stage(spark, table, SF).count()
        assert not set(map(id, before)) & set(map(id, text._SENT))
