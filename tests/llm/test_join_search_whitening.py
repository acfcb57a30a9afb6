"""N-gram join, ranked search and whitening against brute force, on small frames with hard rows."""

import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from test_corpus import empty_docs, hard_docs, union, words
from tributary.llm import lexical, ngrams, queries, whitening

# ---- n-gram join


def shingle_set(text):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    k = min(3, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute_join(rows):
    """For rows ``(doc_id, text)`` the triples of the result."""
    own = [shingle_set(t) for _, t in rows]
    pairs = [(i, j) for i, a in enumerate(own) for j, b in enumerate(own[:i]) if a and b and 100 * len(a & b) >= 90 * len(a | b)]
    root = union(pairs, len(rows))
    ids = {}
    for (d, _), r in zip(rows, root):
        ids.setdefault(r, []).append(d)
    return sorted(((d, len(s), min((x for x in ids[r] if x is not None), default=None)) for (d, _), s, r in zip(rows, own, root)), key=repr)


def joined(docs):
    return sorted((tuple(r) for r in ngrams.similar_documents(docs).collect()), key=repr)


def replaced(rnd, text, n):
    out = text.split()
    for _ in range(n):
        out[rnd.randrange(len(out))] = f"new{rnd.randrange(10**6)}"
    return " ".join(out)


def near_texts(rnd):
    """Groups of near copies with and without a common centre, shared passages, short texts, copies."""
    texts = ["A b", "a  B", "b a", "one", "ONE", " \n", "", None, "a b c"]
    passage = words(rnd, 60, 10**6)
    for size in (20, 60, 150):
        centre = words(rnd, size, 10**6)
        texts += [replaced(rnd, centre, rnd.randint(0, 3)) for _ in range(15)]
        texts += [f"{passage} {words(rnd, rnd.randint(1, 6), 10**6)}" for _ in range(8)] + [centre, centre]
    walk = words(rnd, 100, 10**6)
    for _ in range(25):
        texts.append(walk := replaced(rnd, walk, 1))
    return texts


@pytest.mark.parametrize("chunk", [1024, 8])
def test_join_matches_brute_force(spark, monkeypatch, chunk):
    """With small chunks, lists are cut into many cells."""
    monkeypatch.setattr(ngrams, "CHUNK", chunk)
    rnd = random.Random(chunk)
    rows = list(enumerate(near_texts(rnd)))
    assert joined(spark.createDataFrame(rows, "doc_id long, text string")) == brute_join(rows)


def test_join_without_leaders_still_finds_every_link(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "ROUNDS", 0)
    rows = list(enumerate(near_texts(random.Random(3))))
    assert joined(spark.createDataFrame(rows, "doc_id long, text string")) == brute_join(rows)


def test_join_of_a_group_without_a_centre(spark, monkeypatch):
    """Several hundred near copies, a few of their pairs linked, in cells of 64: as all pairs, few pairs verified."""
    monkeypatch.setattr(ngrams, "CHUNK", 64)
    rnd = random.Random(4)
    centre = words(rnd, 100, 10**6)
    rows = [(i, replaced(rnd, centre, rnd.randint(1, 4))) for i in range(300)]
    seen = []
    add = ngrams.Spanning.add

    def counted(self, pairs):
        pairs = self.keep(pairs, "pairs")
        seen.append(pairs.count())
        return add(self, pairs)

    monkeypatch.setattr(ngrams.Spanning, "add", counted)
    assert joined(spark.createDataFrame(rows, "doc_id long, text string")) == brute_join(rows)
    assert sum(seen) < 300 * 299 / 2 / 4


def test_join_of_hard_rows(spark):
    docs = hard_docs(spark, ["x y z", "X y z", "x y"])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert joined(docs) == brute_join(rows)
    assert joined(empty_docs(spark)) == []


def test_sketches_never_exceed_the_difference():
    rnd = np.random.default_rng(5)
    for n in (5, 40, 300, 5000):
        a = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.append(a[: n - n // 9], rnd.integers(0, 1 << 63, n // 8, dtype=np.uint64)))
        x, y = (np.frombuffer(ngrams.CONTRACT.sketch(s), np.uint8)[None, :] for s in (a, b))
        size = min(x.shape[1], y.shape[1])
        apart = int(np.bitwise_count(ngrams.folded(x, size) ^ ngrams.folded(y, size)).sum())
        assert apart <= len(np.setxor1d(a, b))
        assert np.array_equal(ngrams.folded(x, 32), np.frombuffer(np.packbits((np.bincount((a & np.uint64(255)).astype(int), minlength=256) & 1).astype(np.uint8)).tobytes(), np.uint8)[None, :])


# ---- ranked search


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_search(docs, items, k=10):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for d, b in bags:
            m = 10 + 90 * sum(b.values()) * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in set(terms(text)) if t in b)
            if s > 0:
                found.append((-s, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [200_000, 20])
def test_search_matches_brute_force(spark, block):
    rnd = random.Random(6)
    docs = [(i, words(rnd, rnd.randint(1, 30)).replace("w1", "É1").replace("w2", "W-2")) for i in range(300)]
    docs += [(400 + i, docs[7][1]) for i in range(30)] + [(i, t + " x") for i, t in docs[:20]]
    items = [(i, words(rnd, 6, 50)) for i in range(12)] + [(50, None), (51, ""), (52, "nowhere"), (3, "w3 W3 w5")]
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_terms=block)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_search(docs, items)


def test_search_of_hard_rows(spark):
    docs = hard_docs(spark, ["x y z", "X y", "q"]).withColumn("class", F.lit(1)).withColumn("item", F.lit("x"))
    items = spark.createDataFrame([(1, "x word5", 0.5), (None, "q", None), (2, None, 1.0)], "item_id long, text string, score double")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((tuple(r) for r in lexical.search(docs, items).collect()), key=repr)
    assert got == brute_search(rows, [(1, "x word5"), (None, "q"), (2, None)])
    assert lexical.search(empty_docs(spark), items).collect() == []
    assert lexical.search(docs, items.where("item_id > 5")).collect() == []


# ---- whitening

VECTORS = "vec_id long, embedding array<float>, row int, x string, n double"


def vectors_of(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "y", 0.0) for i, v in vectors], VECTORS)


def brute_whitening(vectors, components=16):
    kept = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max(len(v) for _, v in kept)
    x = np.array([[math.floor(64 * np.float64(np.float32(c))) + 1000000 for c in v] + [1000000] * (width - len(v)) for _, v in kept], np.int64)
    fit = np.unique(x, axis=0)
    n = len(fit)
    gaps = n * x - fit.sum(axis=0)
    inner = (n * fit - fit.sum(axis=0)) / n
    cov = inner.T @ inner / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return kept, n, (gaps**2).sum(axis=1), gaps / n, values, axes, np.trace(cov)


def test_whitening_matches_numpy(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(400, 20)) * np.linspace(0.2, 3, 20)
    vectors = [(i, v) for i, v in enumerate(base.tolist())] + [(1000 + i, base[3].tolist()) for i in range(150)]
    vectors += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 20), (2003, [float("-inf")] * 20), (2004, []), (2005, [0.5] * 7), (None, base[5].tolist()), (3, base[3].tolist())]
    got = whitening.whiten(vectors_of(spark, vectors)).collect()
    kept, n, deviation, centred, values, axes, trace = brute_whitening(vectors)
    assert len(got) == len(kept) * 16 and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9 and len({r.identity_error for r in got}) == 1
    assert all(abs(r.explained - values[r.component - 1] / trace) < 1e-12 for r in got)
    want = {(i, int(d)): c @ axes / np.sqrt(values) for (i, _), d, c in zip(kept, deviation, centred)}
    signs = np.zeros(16)
    for r in got:
        signs[r.component - 1] += r.whitened * want[r.vec_id, r.deviation][r.component - 1]
    assert max(abs(r.whitened - np.sign(signs[r.component - 1]) * want[r.vec_id, r.deviation][r.component - 1]) for r in got) < 1e-9


def test_whitening_over_several_blocks(spark, monkeypatch):
    for name, value in (("BLOCK_ROWS", 16), ("BLOCK_COLS", 3), ("GROUP_BYTES", 512)):
        monkeypatch.setattr(whitening, name, value)
    rng = np.random.default_rng(9)
    vectors = [(i, v) for i, v in enumerate((rng.normal(size=(101, 7)) * 4).tolist())]
    got = whitening.whiten(vectors_of(spark, vectors), components=5).collect()
    kept, n, deviation, centred, values, axes, trace = brute_whitening(vectors, 5)
    table = np.zeros((101, 5))
    for r in got:
        table[r.vec_id, r.component - 1] = r.whitened
    want = centred @ axes / np.sqrt(values)
    assert np.abs(np.abs(table) - np.abs(want)).max() < 1e-9 and max(r.identity_error for r in got) < 1e-9


def test_whitening_of_hard_rows(spark):
    assert whitening.whiten(vectors_of(spark, [])).collect() == []
    assert whitening.whiten(vectors_of(spark, [(1, None), (2, [])])).collect() == []
    one = whitening.whiten(vectors_of(spark, [(1, [0.5, 0.25]), (1, [0.5, 0.25])])).collect()
    assert [(r.vec_id, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, 0.0, 0.0)] * 4
    flat = whitening.whiten(vectors_of(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)])).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in flat) and flat[0].identity_error < 1e-9
    huge = whitening.whiten(vectors_of(spark, [(1, [3e38]), (2, [-3e38]), (3, [1.0])])).collect()
    assert len(huge) == 3 and all(r.whitened is not None for r in huge)


# ---- queries

@pytest.mark.parametrize("key", ["op11_ngram_jaccard_join", "op13_ranked_search"])
def test_queries_match_sql(spark, key):
    import parity
    from tributary.llm import oracles

    folder = "/root/testdata/sf0.001"
    assert parity.differences(queries.QUERIES[key](spark, folder), parity.connect(folder), oracles.STATEMENTS[key]) == []


def test_pairs_of_a_cell_are_never_held_all_at_once():
    """A list of copies has a million pairs in a cell; what is wanted of them is taken as they come."""
    n, sketch = 1024, ngrams.Rule(5, 80, 100).sketch(np.arange(600, dtype=np.uint64))
    own = {"gid": np.arange(n), "n": np.full(n, 600), "pos": np.zeros(n, np.int64), "low": np.arange(n), "high": np.arange(n), "members": np.ones(n, np.int64)}
    rows = pa.table({**own, "sketch": pa.array([sketch] * n, pa.binary())})
    entries, rule, places = ngrams.Entries(rows), ngrams.Rule(5, 80, 100), np.arange(n)
    for find, want in ((ngrams.spanning_pairs, n - 1), (ngrams.partners, n)):
        tracemalloc.start()
        a, _ = ngrams.pairs_of_cell(entries, places, places, True, rule, find)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(a) == want and peak < 48 << 20
    assert len(ngrams.pairs_of_cell(entries, places, places, True, rule, ngrams.every_pair)[0]) == n * (n - 1) // 2


def test_sketches_move_with_the_cells_only(spark, monkeypatch):
    """Lists are counted without sketches: the rows that a list's size is joined to are small."""
    seen, counted = [], ngrams.counted
    monkeypatch.setattr(ngrams, "counted", lambda lists: (seen.append(set(lists.columns)), counted(lists))[1])
    docs = spark.createDataFrame([(i, "a b c d e f g h i j k " + str(i // 2)) for i in range(8)], "doc_id long, text string")
    assert ngrams.similar_documents(docs).count() == 8
    assert seen and all("sketch" not in c for c in seen)
