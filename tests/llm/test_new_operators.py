"""Toxicity, alignment of tokenizers and fill-in-middle, against plain versions, on awkward rows and on empty tables."""

import hashlib
import random
import time
import zlib
from collections import Counter
from itertools import product

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from fairlead.llm import alignment, infill, queries, text, toxicity
from tests.llm import cases

SF = "/root/testdata/sf0.001"


def key(row):
    return str(row[0]), tuple(map(str, row))


def real(spark):
    return [(r.doc_id, r.text) for r in text.documents(spark, SF).select("doc_id", "text").collect()]


def inputs():
    return [(r[0], r[1]) for r in cases.rows()]


def sha(value):
    return hashlib.sha256(value.encode()).hexdigest()


# ---- toxicity --------------------------------------------------------------------


def channel_of(words):
    counted = Counter(words)
    return toxicity.Channel(toxicity.trigrams(pa.array(list(counted)), np.array(list(counted.values()), float)))


def test_trigrams_are_plain_counts():
    words, weights = ["ab", "b", "ééc", "abcd"], [2.0, 1.0, 3.0, 5.0]
    want = Counter()
    for w, n in zip(words, weights):
        codes = [0, 0, *map(toxicity.letter_class, w), 0]
        for i in range(2, len(codes)):
            want[(codes[i - 2] * toxicity.CLASSES + codes[i - 1]) * toxicity.CLASSES + codes[i]] += n
    got = toxicity.trigrams(pa.array(words), np.array(weights))
    assert {int(i): got[i] for i in np.flatnonzero(got)} == dict(want)


def cheapest(channel, token):
    """All readings of a token by their cost."""
    runs, at = [], 0
    while at < len(token):
        end = at
        while end < len(token) and token[end] == token[at]:
            end += 1
        lone = token[at] == " " and (at < 2 or token[at - 2] == " ") and (at + 2 >= len(token) or token[at + 2] == " ")
        runs.append(channel.options(token[at], end - at, lone))
        at = end
    best = {}
    for path in product(*runs):
        reading = " ".join("".join(p for p, _ in path).split())
        cost = sum(c for _, c in path)
        for word in reading.split():
            codes = [0, 0, *map(toxicity.letter_class, word), 0]
            cost += sum(channel.cost[(a * 64 + b) * 64 + c] for a, b, c in zip(codes, codes[1:], codes[2:]))
        best[reading] = min(best.get(reading, np.inf), cost)
    return best


def test_viterbi_finds_the_cheapest_reading():
    channel = channel_of(["idiot"] * 9 + ["clown"] * 5 + ["the", "is", "on", "boot", "loser"] * 4)
    for token in ["1d10t", "c l 0 w n", "th3", "b00t", "booooot", "i.d.i.o.t", "on is", "l0s3r$$$", "$$", "0n|y", "é1"]:
        readings = cheapest(channel, token)
        assert readings[channel.decode(token)] == pytest.approx(min(readings.values())), token
    assert channel.decode("c l 0 w n") == "clown" and channel.decode("i d i o t") == "idiot" and channel.decode("iiidiot") == "idiot"


def test_plain_words_and_short_words_stay():
    channel = channel_of(["de", "la", "y", "el", "casa", "blanca"] * 20)
    where, word, words = toxicity.restored_words(channel, pa.array(["De la Casa, (blanca)!", None, "", "12 34", "y el de la casa"]))
    assert [(int(t), words[w].as_py()) for t, w in zip(where, word.tolist())] == [
        (0, "de"), (0, "la"), (0, "casa"), (0, "blanca"), (4, "y"), (4, "el"), (4, "de"), (4, "la"), (4, "casa")
    ]


def test_parts_are_all_spans_of_marked_words():
    words = ["ab", "idiots", "ñu"]
    owner, code = toxicity.parts(pa.array(words))
    seen = {}
    for w, word in enumerate(words):
        raw = b"\2" + word.encode() + b"\3"
        spans = {raw} | {raw[i : i + n] for n in toxicity.PARTS for i in range(len(raw) - n + 1) if n < len(raw)}
        assert np.count_nonzero(owner == w) == len(spans)
        for s in spans:
            seen.setdefault(s, set())
    assert len(set(code.tolist())) == len(seen)
    wanted = np.unique(code)[::3]
    few, place = toxicity.parts(pa.array(words), wanted)
    assert sorted(zip(few.tolist(), wanted[place.astype(int)].tolist())) == sorted((o, c) for o, c in zip(owner.tolist(), code.tolist()) if c in set(wanted.tolist()))


def test_toxicity_held_out_and_hidden_words(spark):
    rnd = random.Random(5)
    bad = ["idiot", "moron", "clown"]
    hidden = {"idiot": ["1diot", "i d i o t", "idiooot", "i.d.i.o.t"], "moron": ["m0ron", "m o r o n", "moroooon"], "clown": ["cl0wn", "c l o w n", "c-l-o-w-n"]}
    rows, labels, written = [], [], {}
    for i in range(1200):
        words = cases.sentence(rnd, 40).split()
        toxic = i % 4 == 0
        if toxic:
            w = rnd.choice(bad)
            shown = rnd.choice(hidden[w]) if i >= 1000 else w
            words.insert(rnd.randrange(40), shown)
            written[i] = (w, shown)
        rows.append((i, " ".join(words)))
        if i < 1000:
            labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labelled = spark.createDataFrame(labels + labels[:50], "doc_id long, label int")
    channel = toxicity.language_model(docs)
    got = {r.doc_id: r for r in toxicity.scored(docs, toxicity.fitted(docs, labelled, channel), channel).collect()}
    assert len(got) == 1200 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    late = [i for i in range(1000, 1200)]
    assert sum(got[i].predicted for i in late if i % 4 == 0) >= 45 and not any(got[i].predicted for i in late if i % 4)
    restored = {r.doc_id: r.restored for r in toxicity.restored(docs, channel).collect()}
    assert sum(f" {written[i][0]} " in f" {restored[i]} " for i in written) >= 0.95 * len(written)


def test_toxicity_awkward_rows(spark):
    docs = cases.table(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (None, 1), (9, None), (13, 0), (16, 1)], "doc_id long, label int")
    channel = toxicity.language_model(docs)
    model = toxicity.fitted(docs, labels, channel)
    got = toxicity.scored(docs, model, channel).collect()
    assert sorted(map(str, (r.doc_id for r in got))) == sorted(str(i) for i, _ in inputs())
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert len(by[2]) == 1 and by[4] == by[5] and all(0 <= s <= 1 for v in by.values() for s in v)
    none = toxicity.fitted(docs, labels.filter("label = 5"), channel)
    assert none is None and {r.score for r in toxicity.scored(docs, none, channel).collect()} == {0.0}
    one_sided = toxicity.fitted(docs, labels.filter("label = 0"), channel)
    assert all(r.predicted == 0 for r in toxicity.scored(docs, one_sided, channel).collect())
    assert toxicity.scored(cases.empty(spark), model, toxicity.language_model(cases.empty(spark))).count() == 0
    assert {r.restored for r in toxicity.restored(docs, channel).filter("doc_id in (4, 5, 6, 7)").collect()} == {""}


def test_toxicity_of_a_hot_id(spark):
    rnd = random.Random(6)
    rows = [(1, "the same text of a hot id")] * 3000 + [(i, cases.sentence(rnd, 12)) for i in range(2, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 300)] * 3, "doc_id long, label int")
    assert toxicity.sample(docs, labels).count() == 299


def test_toxicity_of_long_tokens_is_linear():
    channel = channel_of(["aba", "bab"] * 5)
    start = time.process_time()
    for token in ["a1" * 20_000, "$" * 40_000, "ab" * 20_000 + "!", "a b " * 10_000, "aab" * 10_000 + "0"]:
        toxicity.restored_words(channel, pa.array([token]))
    assert time.process_time() - start < 20


def test_op11_query(spark):
    got = queries.QUERIES["op11_toxicity"](spark, SF).collect()
    ids = dict(real(spark))
    assert {r.doc_id for r in got} == set(ids) and len(got) == len(ids)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


# ---- alignment -------------------------------------------------------------------


def plain_alignment(docs):
    """Every column of the contract by the libraries' ids, sets of ends and loops over occurrences."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    from fairlead.llm.tokens import _byte_of

    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte, token = _byte_of(), {i: t for t, i in first.get_vocab().items()}
    rows, held = [], Counter()
    for i, t in docs:
        a, b = (first.encode(" " + t, add_special_tokens=False).ids, second.encode(t)) if t else ([], [])
        bytes_a = [bytes(byte[c] for c in token[k]) for k in a]
        bytes_b = [bytes([int(second.id_to_piece(k)[3:5], 16)]) if second.is_byte(k) else second.id_to_piece(k).replace("▁", " ").encode() for k in b]
        if t and not b"".join(bytes_a) == b"".join(bytes_b) == (" " + t).encode():
            a, b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b = ({int(e): k + 1 for k, e in enumerate(np.cumsum([len(x) for x in y]))} for y in (bytes_a, bytes_b))
        groups, pa_, pb = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            groups.append((a[pa_ : ends_a[e]], b[pb : ends_b[e]]))
            pa_, pb = ends_a[e], ends_b[e]
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        held.update(links.keys())
        rows.append((i, a, b, groups, links))
    top = Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for i, a, b, groups, links in rows:
        listing = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(n for k, n in links.items() if held[k] == top[k[0]])
        out.append((i, len(a), len(b), len(groups), sum(links.values()), best, sum(n * held[k] for k, n in links.items()), sha(listing) if groups else ""))
    return out


ODD = [
    (50, "a" * 20_000), (51, "x▁y"), (52, "<|endoftext|> <s> 漢​ \u0085z 　q"), (53, "ab" * 3000 + "é" * 2000),
    (54, "\x00\x01 tab\t\r\n  "), (55, "<|endoftext|>"), (56, "👩‍👩‍👧 İ ß ﬁ é"), (57, " "), (58, "9" * 5000 + "<0x41>"),
]


def test_alignment_against_plain_version(spark):
    got = [tuple(r) for r in queries.QUERIES["op12_alignment"](spark, SF).collect()]
    assert sorted(got, key=key) == sorted(plain_alignment(real(spark)), key=key)


def test_alignment_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(alignment, "WIDE", 3)  # the way of wide groups
    rows = inputs() + ODD
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, block int, pairs int").repartition(3)
    want = sorted(plain_alignment(rows), key=key)
    assert sorted((tuple(r) for r in alignment.link_statistics(docs).collect()), key=key) == want
    tokens = alignment.pair(alignment.vocabulary_paths())
    whole = alignment.Aligned(tokens, pa.array([t for _, t in rows]))
    narrow = whole.pairs()
    monkeypatch.setattr(alignment, "WIDE", 1 << 40)
    assert all(np.array_equal(x, y) for x, y in zip(narrow, whole.pairs()))
    assert alignment.link_statistics(cases.empty(spark)).count() == 0


def test_alignment_keeps_no_wide_rows(spark, monkeypatch):
    monkeypatch.setattr(alignment, "PIECE", 7)  # a document and a block's pairs take many rows
    rows = [(r[0], r[1]) for r in cases.rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    want = sorted(plain_alignment(rows), key=key)
    assert sorted((tuple(r) for r in alignment.link_statistics(docs).collect()), key=key) == want
    monkeypatch.setattr(alignment, "PIECE", 1_024)
    kept = alignment._blocks(docs, alignment.vocabulary_paths()).collect()
    assert max(len(v) for r in kept for v in r if isinstance(v, list)) <= alignment.PIECE < max(r.n_a or 0 for r in kept)


def test_alignment_groups_give_the_tokens_back(spark):
    docs = spark.createDataFrame(inputs() + ODD, "doc_id long, text string")
    for r in alignment.aligned(docs).collect():
        assert sum(r.a_sizes) == len(r.a_ids) and sum(r.b_sizes) == len(r.b_ids) and len(r.a_sizes) == len(r.b_sizes)


def test_galloping_is_a_lower_bound():
    rnd = np.random.default_rng(3)
    for _ in range(200):
        into = np.sort(rnd.choice(1000, rnd.integers(1, 300), replace=False))
        values = np.sort(rnd.choice(1000, 50, replace=False))
        low = rnd.integers(0, len(into) + 1, 50)
        high = low + (rnd.random(50) * (len(into) - low + 1)).astype(int)
        start = rnd.integers(-5, len(into) + 5, 50)
        want = [lo + int(np.searchsorted(into[lo:hi], v)) for v, lo, hi in zip(values, low, high)]
        assert alignment.galloped(values, into, start, low, high).tolist() == want


# ---- fill in the middle -----------------------------------------------------------


def plain_infill(doc_id, t):
    t = t or ""
    n, digest = len(t), sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, sha(t), sha(t))
    p, m, s = t[:a], t[a:b], t[b:]
    spm = h[3] % 100 < 20
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, n, "spm" if spm else "psm", a, b - a, sha(out), sha(t))


MARKED = [(60, "a <P> b"), (61, "<"), (62, "<<S"), (63, "x<M>"), (64, "é" * 70_000), (65, "aé" * 60_000), (66, "漢" * 30_000 + "x" * 200_000), (67, "<P<S<M" * 9)]


def test_infill_against_plain_version_and_sql(spark):
    got = sorted((tuple(r) for r in queries.QUERIES["op13_infill"](spark, SF).collect()), key=key)
    assert got == sorted((plain_infill(*r) for r in real(spark)), key=key)
    with duckdb.connect() as db:
        db.execute(f"create view documents as select * from '{SF}/documents.parquet'")
        assert sorted(db.execute(queries.ORACLE["op13_infill"]).fetchall(), key=key) == got


def test_infill_awkward_rows(spark):
    rows = inputs() + MARKED
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int").repartition(2)
    got = sorted((tuple(r) for r in infill.digests(docs).collect()), key=key)
    assert got == sorted((plain_infill(*r) for r in rows), key=key)
    texts = {r.doc_id: infill.rebuilt(r.output, r.form) for r in infill.transformed(docs).collect() if r.doc_id not in (None, 3)}
    assert texts == {i: t or "" for i, t in rows if i not in (None, 3)}
    assert infill.digests(cases.empty(spark)).count() == 0


def test_containers_select_like_a_list():
    rnd = np.random.default_rng(4)
    kinds = set()
    for share in (0.0, 0.001, 0.02, 0.5, 0.98, 1.0):
        member = rnd.random(infill.SPAN) < share
        member[rnd.integers(0, infill.SPAN)] = True
        made = infill.container(member)
        kinds.add(type(made))
        at = np.flatnonzero(member)
        assert np.array_equal(made.select(np.arange(len(at))), at)
    assert kinds == {infill.ArrayContainer, infill.BitmapContainer, infill.RunContainer}
    data = np.frombuffer(("aé漢👍" * 30_000 + "x" * 90_000).encode(), np.uint8)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    assert np.array_equal(infill.Boundaries(data).select(np.arange(len(at) + 1)), np.append(at, len(data)))
