"""The corpus operators against brute force, on small frames with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import io
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from tributary.llm import automaton, chat, contamination, exact, html, lines, minhash, mixing, quality, queries, secrets, simhash, tokens
from tributary.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, `_rank` int"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))


def hard_docs(spark, texts):
    """Texts with nulls and repeats around them, and extra columns whose names operators might use themselves."""
    rows = [(i, t, "en", f"s{i % 3}", 1, 0.5, "x", 1) for i, t in enumerate(texts)]
    rows += [(1000, None, None, None, None, None, None, None), (None, "", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    rows += [(1001, LONG, "en", "s0", 1, 0.5, "x", 1), rows[0], rows[0]]
    return spark.createDataFrame(rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def words(rnd, n, vocabulary=40):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- SimHash

def union(pairs, n):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_fingerprint_matches_its_definition():
    import xxhash

    for text in ("", " \n", "One", "One two", "a B c D e a B c", "é ü ñ é"):
        found = regex.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text))
        shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))] if found else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(text.encode()) == want


def test_links_connect_exactly_what_brute_force_connects(spark):
    rnd = random.Random(4)
    prints = set()
    for _ in range(60):
        x = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 8)):
            prints.add(x)
            low = rnd.choice((0, 0, 22, 43, 40))
            for _ in range(rnd.randint(1, 4)):
                x ^= 1 << (low + rnd.randrange(21) if rnd.random() < 0.5 else rnd.randrange(64))
    prints = sorted(prints)
    want = union([(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3], len(prints))
    nodes = spark.createDataFrame([(simhash.signed(p), i) for i, p in enumerate(prints)], "fp long, doc_id long")
    found, _ = simhash.classes(nodes)
    got = {r.fp: r.component_id for r in found.collect()}
    assert [got[simhash.signed(p)] for p in prints] == want


def test_near_duplicates_keeps_one_row_of_each_component(spark):
    rnd = random.Random(1)
    base = [words(rnd, 80, 10_000) for _ in range(6)]
    docs = hard_docs(spark, [*base, *base[:2], base[2] + " more"])
    report = simhash.near_duplicates(docs).collect()
    assert len(report) == docs.count()
    by_id = {r.doc_id: r.component_id for r in report}
    assert (by_id[6], by_id[7]) == (0, 1) and by_id[1000] == 1000
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(set(by_id.values()), key=repr)
    assert simhash.near_duplicates(empty_docs(spark)).count() == simhash.keep_one(empty_docs(spark)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, j) for j in range(200, 260)] + [(5, 5)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"))[0].collect())
    assert got == {i: 100 for i in range(100, 161)} | {i: 1 for i in [1, *range(200, 260)]}


def jaccard(a, b):
    """Similarity of the sets of five-word shingles."""
    def sets(t):
        w = "".join(c.lower() if c.isascii() else c for c in t or "").split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    a, b = sets(a), sets(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def replaced(rnd, text, n):
    """``n`` words of a text replaced, and the text's similarity to it falls."""
    out = text.split()
    for at in rnd.sample(range(len(out)), n):
        out[at] = f"x{rnd.randrange(10**6)}"
    return " ".join(out)


def test_pipeline_near_dedup_matches_all_pairs(spark):
    rnd = random.Random(11)
    texts = []
    for _ in range(30):
        base = words(rnd, rnd.choice((40, 100, 300)), 5000)
        n = len(base.split())
        texts += [base, *(replaced(rnd, base, rnd.randint(1, n // 25)) for _ in range(4))]
    for _ in range(10):  # much alike by a passage that repeats, different in the rest
        texts.append("the same notice stands in every text of this kind " * 8 + words(rnd, 60, 5000))
    docs = hard_docs(spark, texts)
    rows = docs.select("doc_id", "text").distinct().collect()
    close = [(i, j) for i, a in enumerate(rows) for j, b in enumerate(rows[:i]) if jaccard(a.text, b.text) >= 0.8]
    groups = {}
    for r, root in zip(rows, union(close, len(rows))):
        groups.setdefault(root, []).append(r.doc_id)
    want = sorted(min((i for i in ids if i is not None), default=None) for ids in groups.values())
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == want
    assert minhash.keep_one(empty_docs(spark)).count() == 0


def test_pipeline_near_dedup_meets_by_fingerprints(spark):
    """Ball hashing alone connects whatever is within three bits, with at most one pair for each text."""
    rnd = random.Random(12)
    texts = [f"{base} {rnd.randrange(40)}" for base in (words(rnd, 400, 5000) for _ in range(20)) for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("mark", F.xxhash64("text"))
    join = minhash.KeyJoin(docs, minhash.with_keys(docs, minhash.STAGE), minhash.STAGE)
    bits = {r.gid: r.bits & simhash.ALL_BITS for r in join.nodes.collect()}
    want = {simhash.fingerprint(" ".join(t.lower().split()).encode(), 5) for t in texts}
    assert set(bits.values()) == want
    ids = sorted(bits)
    pairs = [(r.a, r.b) for r in join.near.collect()]
    close = [(ids[i], ids[j]) for i in range(len(ids)) for j in range(i) if (bits[ids[i]] ^ bits[ids[j]]).bit_count() <= 3]
    assert pairs and set(pairs) <= set(close) and len(pairs) < len(ids)
    at = {g: i for i, g in enumerate(ids)}
    assert union([(at[a], at[b]) for a, b in pairs], len(ids)) == union([(at[a], at[b]) for a, b in close], len(ids))
    join.run()
    assert join.links.count() >= len(pairs) > 20


# ---- exact dedup

@pytest.mark.parametrize("digest", [exact.sha256_hex, lambda t: F.substring(F.sha2(t, 256), 1, 1)], ids=["sha256", "colliding"])
def test_exact_duplicates(spark, digest):
    docs = hard_docs(spark, [f"text {i % 7}" for i in range(40)])
    rows = docs.select("doc_id", "text").collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.text or "", []).append(r.doc_id)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    got = exact.exact_duplicates(docs, digest).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=repr) == sorted(
        ((r.doc_id, best[r.text or ""], len(groups[r.text or ""])) for r in rows), key=repr
    )
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    assert exact.exact_duplicates(empty_docs(spark), digest).count() == 0


def test_drop_copies_keeps_texts_under_null_ids_only(spark):
    rows = [(None, "only here", "en", "s1", 1, 0.5, "x", 1), (None, "also", "de", "s2", 2, 0.5, "y", 2), (None, "also", "fr", "s2", 2, 0.5, "y", 2), (None, "both", "en", "s", 1, 0.5, "x", 1), (3, "both", "it", "s", 1, 0.5, "x", 1)]
    kept = sorted((tuple(r) for r in exact.drop_copies(spark.createDataFrame(rows, DOCS)).collect()), key=lambda r: r[1])
    assert kept[0] in rows[1:3] and kept[1:] == [rows[4], rows[0]]


def test_drop_copies_keeps_whole_rows_and_uses_no_python(spark):
    docs = hard_docs(spark, ["a", "b", "a"])
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 1000, 1001, 2]
    assert "Python" not in kept._jdf.queryExecution().executedPlan().toString()


# ---- decontamination

def brute_hits(text, items):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "")
    own, hit, found = regex.findall(pattern, lower(text)), set(), set()
    for item, body in items:
        w = regex.findall(pattern, lower(body))
        size = min(13, len(w))
        windows = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
        for i in range(len(own) - size + 1 if size else 0):
            if tuple(own[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add("" if item is None else str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(own), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(own)


@pytest.mark.parametrize("block_pairs", [200_000, 30])
def test_contamination_matches_brute_force(spark, block_pairs):
    rnd = random.Random(2)
    items = [(i, words(rnd, rnd.choice((0, 1, 5, 13, 20, 30)), 1000)) for i in range(12)] + [(None, words(rnd, 15, 1000)), (77, None)]
    texts = []
    for _ in range(40):
        parts = [words(rnd, rnd.randint(0, 60), 1000)]
        if rnd.random() < 0.6:
            parts.append(rnd.choice(items)[1] or "")
        texts.append(", ".join(parts).upper() if rnd.random() < 0.5 else " ".join([*parts, "é;x"]))
    docs, bench = hard_docs(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(((r.doc_id, *brute_hits(r.text, items)) for r in docs.collect()), key=repr)
    assert rows_of(contamination.verdicts(docs, bench, block_pairs)) == want
    clean = contamination.decontaminate(docs, bench, block_pairs=block_pairs)
    assert clean.columns == docs.columns and clean.count() == sum(not w[-1] for w in want)
    again = contamination.verdicts(contamination.decontaminate(docs, bench.where("item_id <> 1"), "spans", block_pairs), bench.limit(0), block_pairs)
    assert again.count() == docs.count()
    assert contamination.verdicts(empty_docs(spark), bench, block_pairs).count() == 0


def test_spans_are_cut_out():
    hit = np.packbits(np.array([0, 1, 1, 0], bool), bitorder="little").tobytes()
    assert contamination.cut("one, TWO three; four", hit) == "one, ; four"


# ---- quality

def test_quality_learns_only_from_what_it_may_see(spark):
    rnd = random.Random(3)
    good, bad = [words(rnd, 60, 5000) + "." for _ in range(150)], [words(rnd, 30, 50).upper().replace(" ", "!! ") for _ in range(150)]
    docs = hard_docs(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(300)] + [(0, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    seen = quality.learnable(labels)
    assert not [r for r in seen.collect() if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    net = quality.fit(docs, seen, updates=120)
    scored = quality.score(docs, net).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    held = [r for r in scored if r.doc_id is not None and r.doc_id < 300 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum((r.score >= 0.7) == (r.doc_id < 150) for r in held) / len(held) > 0.95
    assert len({r.score for r in scored if r.doc_id == 0}) == 1
    assert quality.keep_good(docs, net).columns == docs.columns
    assert quality.fit(docs, labels.limit(0)).constant == 1.0
    assert quality.fit(docs, labels.where("quality = 0 and doc_id > 200")).constant == 0.0
    assert quality.score(empty_docs(spark), net).count() == 0


def test_quality_learns_from_whole_texts_and_one_row_of_an_id(spark):
    # What tells the labels apart stands at the end of texts of many chunks only.
    rnd = random.Random(4)
    texts = [words(rnd, 1500, 300) + (" zq zq zq zq" if i % 2 else " kv kv kv kv") for i in range(240)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(240)], "doc_id long, quality int, toxic int")
    docs = hard_docs(spark, texts)
    net = quality.fit(docs, labels.where("doc_id < 160"), updates=250)
    scored = {r.doc_id: r.score for r in quality.score(docs, net).where("doc_id >= 160 and doc_id < 240").collect()}
    assert sum((s >= 0.5) == (i % 2 == 1) for i, s in scored.items()) / len(scored) > 0.9
    # Many repeats of one id do not crowd out the other label.
    first = spark.range(160).orderBy(F.xxhash64(F.lit(7), "id")).first().id
    crowded = docs.where("doc_id < 160").union(docs.where(F.col("doc_id") == first).select("*", F.explode(F.sequence(F.lit(1), F.lit(400)))).drop("col"))
    assert quality.fit(crowded, labels, max_rows=100, updates=2).weights is not None
    # A bound on the bytes leaves whole texts of both labels, or nothing to learn from.
    assert quality.fit(docs, labels, max_bytes=200_000, updates=2).weights is not None
    assert quality.fit(docs, labels, max_bytes=10, updates=2).weights is None


def test_forward_pass_matches_naive_loops():
    rnd = np.random.default_rng(5)
    texts = [b"", b"short", bytes(rnd.integers(0, 256, 1500, dtype=np.uint8)), bytes(rnd.integers(97, 123, 700, dtype=np.uint8))]
    lengths = np.array([len(t) for t in texts])
    data, begins = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(lengths) - lengths
    each = [b + quality.chunk_starts(n) for b, n in zip(begins, lengths)]
    sizes = np.array([len(e) for e in each])
    first, labels = np.cumsum(sizes) - sizes, np.array([0, 1, 1, 0], np.float32)
    args = (data, np.concatenate(each), np.repeat(begins + lengths, sizes), first, labels, np.ones(4, np.float32))
    w = quality.train(*args, updates=3)

    def naive(w, text):
        hidden = []
        for start in quality.chunk_starts(len(text)):
            part = text[start : start + quality.CHUNK + quality.WIDTH - 1].ljust(quality.CHUNK + quality.WIDTH - 1, b"\0")
            pooled = [max(
                sum(float(w["embedding"][part[p + j]] @ w["filters"][j, :, k]) for j in range(quality.WIDTH)) for p in range(quality.CHUNK)
            ) for k in range(quality.FILTERS)]
            seen = np.array([max(x + b, 0) for x, b in zip(pooled, w["bias"])] + [min(len(text) - start, quality.CHUNK) / quality.CHUNK])
            hidden.append(np.maximum(seen @ w["hidden"] + w["hidden_bias"], 0))
        both = np.concatenate([np.mean(hidden, axis=0), np.max(hidden, axis=0)])
        return 1 / (1 + np.exp(-(both @ w["out"] + w["out_bias"][0])))

    import pyarrow as pa

    # The column is UTF-8; bytes go in as they are.
    column = pa.Array.from_buffers(pa.string(), 4, [None, pa.py_buffer(np.append(begins, lengths.sum()).astype(np.int32).tobytes()), pa.py_buffer(b"".join(texts))])
    got = quality.score_texts(quality.Network(w), column)
    assert np.allclose(got, [naive(w, t) for t in texts], atol=1e-5)


def test_chunks_cover_every_byte():
    for n in (0, 1, 511, 512, 513, 992, 993, 5000):
        starts = quality.chunk_starts(n)
        assert starts[0] == 0 and starts[-1] + quality.CHUNK >= n and all(np.diff(starts) == quality.STRIDE)


# ---- mixing

def test_mix_meets_its_targets(spark):
    rnd = random.Random(5)
    rows = [(i, words(rnd, rnd.randint(1, 90)), rnd.choice(["a", "a", "a", "b", "c", None])) for i in range(3000)]
    rows += [(5000, None, "d"), (5001, "", "a"), (None, "x y", "b"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_report(docs).toPandas()
    sizes = got.groupby("source", dropna=False)["size"].sum()
    order = sorted((s for s in sizes.index if isinstance(s, str))) + [s for s in sizes.index if not isinstance(s, str)]
    weights, total = [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5 * sizes.sum()
    targets, free = [0.0] * len(order), set(range(len(order)))
    while True:
        left = total - sum(t for i, t in enumerate(targets) if i not in free)
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = {i for i in free if share[i] > 2 * sizes[order[i]]}
        for i in over:
            targets[i] = 2.0 * sizes[order[i]]
        free -= over
        if not over:
            break
    for i in free:
        targets[i] = share[i]
    for i, source in enumerate(order):
        own = got[got["source"].isna()] if not isinstance(source, str) else got[got["source"] == source]
        assert own["target"].iloc[0] == pytest.approx(targets[i])
        assert abs(own["taken"].sum() - targets[i]) <= 0.01 * targets[i] + 2
    assert (got["taken"] <= 2 * got["size"]).all() and len(got) == len(rows)
    assert rows_of(mixing.mix_report(docs.repartition(5))) == rows_of(mixing.mix_report(docs))
    assert mixing.mixed(hard_docs(spark, ["a b", "c"])).columns == empty_docs(spark).columns
    assert mixing.mix_report(empty_docs(spark)).count() == 0


# ---- token files

def test_tokens_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    definition = queries.word_tokenizer()
    plain = Tokenizer.from_str(definition)
    docs = hard_docs(spark, ["Hello, World!", "don't  STOP\n\tnow", "<|endoftext|> x", "İé́≠", "a" * 3000])
    manifest = tokens.write_tokens(docs, definition, f"file://{tmp_path}", frame_bytes=64)
    got = sorted(tokens.read_tokens(manifest).collect(), key=lambda r: r.start)
    order = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.doc_id for r in got] == [r.doc_id for r in order]
    want = sorted((repr(r.doc_id), zlib.crc32(np.array(plain.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4").tobytes())) for r in order)
    assert sorted((repr(r.doc_id), r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    assert tokens.read_tokens(tokens.write_tokens(empty_docs(spark), definition)).count() == 0


def test_parts_of_a_text_encode_as_the_whole():
    from tokenizers import Tokenizer

    definition, rnd = queries.word_tokenizer(), random.Random(6)
    encoder, plain = tokens.Encoder(definition), Tokenizer.from_str(definition)
    pieces = ["a", "B", "é", "é", "́", "'s", "don't", " ", "\n", "\t", "\x1c", "\x85", "　", "1", "23", ".", ",", "!!", "<|endoftext|>", "Σ", "İ", "=", "̸", "ß", "中", "👍"]
    for _ in range(3000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 14)))
        assert next(encoder.texts([text])) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_other_tokenizers_get_whole_texts():
    from tokenizers import Tokenizer

    with open("/opt/tokenizers/byte_bpe_50k.json", encoding="utf-8") as file:
        definition = file.read()
    encoder, plain = tokens.Encoder(definition), Tokenizer.from_str(definition)
    assert not encoder.by_parts and tokens.by_parts(queries.word_tokenizer())
    for text in ("", "Hello  World", "a b\n\nc", " x", LONG):
        assert next(encoder.texts([text])) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_token_files_are_read_by_as_many_tasks(spark, tmp_path):
    docs = spark.range(400).selectExpr("id as doc_id", "concat('text ', id) as text").repartition(8)
    manifest = tokens.write_tokens(docs, queries.word_tokenizer(), f"file://{tmp_path}")
    copies = manifest.select("*", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("copy")).withColumn("part", F.col("part") * 10 + F.col("copy"))
    read = tokens.read_tokens(copies)
    assert read.select(F.spark_partition_id()).distinct().count() > 1
    assert read.count() == 6 * 400


@pytest.mark.parametrize("name", ["endoftext", "startoftext"])
def test_added_tokens_encode_alike_in_any_order(name):
    from tokenizers import Tokenizer

    definition = queries.word_tokenizer()
    plain = Tokenizer.from_str(definition)
    for texts in ([f"<|{name}", f"<|{name}|>", f"a<|{name}|>"], [f"<|{name}|>", f"<|{name}", f"{name}|>"], [name, f"{name}<|", f"{name}<|{name}|>"]):
        encoder = tokens.Encoder(definition)
        for text in texts * 2:
            assert next(encoder.texts([text])) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


class Counting(io.BytesIO):
    fetched = 0

    def read(self, n=-1):
        got = super().read(n)
        self.fetched += len(got)
        return got

    @property
    def size(self):
        return len(self.getbuffer())


def test_readers_fetch_only_wanted_frames_and_find_damage():
    import zstandard

    rnd = np.random.default_rng(0)
    docs = [(i, rnd.integers(0, 60_000, 500, dtype=np.uint32)) for i in range(200)]
    sink = io.BytesIO()
    tokens.write_file(sink, ((i, x.tobytes()) for i, x in docs), 2, 2048)
    raw = sink.getvalue()
    source = Counting(raw)
    (found,) = tokens.read_file(source, {117})
    assert found[:2] == (117, 117 * 500) and (found[2] == docs[117][1]).all() and source.fetched < len(raw) / 10
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert whole[:1000] == docs[0][1].astype("<u2").tobytes()
    for at in (100, len(raw) - 5, len(raw) - 40):
        broken = bytearray(raw)
        broken[at] ^= 0xFF
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(tokens.read_file(Counting(bytes(broken))))


# ---- secrets

BASE = [
    (regex.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", regex.I | regex.A), 2, 6),
    (regex.compile("AKIA[A-Z0-9]+"), 0, 20), (regex.compile("[0-9a-f]+"), 0, 24),
]


def brute_spans(text):
    return sorted((m.start(), k, m.end()) for k, (p, g, least) in enumerate(BASE) for m in p.finditer(text) if len(m.group(g)) >= least)


def test_secret_spans_match_regular_expressions(spark):
    rnd = random.Random(7)
    pieces = ["token", "Secret", "passwd", "api_key", "APIKEY", "=", ":", " ", '"', "'", "a", "f0", "0123456789abcdef", "AKIA", "AKIAABCDEFGH", "Z9", ".", "-", "é", "\n", "ſ", "ghp_", "xoxb-"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25))) for _ in range(2000)]
    docs = hard_docs(spark, texts + ["x" * 50_000 + "0a" * 40_000])
    for r in secrets.find_secrets(docs).join(docs.select("doc_id", "text").where("doc_id is not null").distinct(), "doc_id").collect():
        want = brute_spans(r.text or "")
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in want) for k in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(f"{secrets.BASE[k].kind}:{a}:{b}" for a, k, b in want).encode()).hexdigest()
    assert secrets.mask_secrets(docs).columns == docs.columns
    assert secrets.find_secrets(empty_docs(spark)).count() == 0


def test_automaton_is_minimal_and_refuses_what_it_cannot_do():
    tables = automaton.scanner(["a[bc]+"])
    assert len(tables.to) == 3
    with pytest.raises(ValueError):
        automaton.scanner(["a(bc)*"])
    with pytest.raises(ValueError):
        automaton.scanner(["a*"])


# ---- chats

def test_chats_round_trip(spark):
    rnd, rows = random.Random(8), []
    pieces = ["#", "##", "###", "\\", "</turn>", "<", "/turn>", "\n", " ", "a", "é", "### User: ", "</turn>\n", "$1"]
    for c in range(400):
        for t in range(rnd.randint(1, 3)):
            text = None if rnd.random() < 0.05 else "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 8)))
            rows.append((c, t, rnd.choice(["user", "assistant", "system", "tool: x\n", "", None]), text))
    rows += [(None, 0, "user", "x"), (None, None, "assistant", LONG), rows[0], rows[0]]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        whole, learned = want.get(c, ("", ""))
        want[c] = whole + f"{role or ''}\n{text or ''}\n", learned + (text or "" if role == "assistant" else "")
    read = chat.read_chats(chat.format_chats(turns))
    assert "Python" not in read._jdf.queryExecution().executedPlan().toString()
    got = {r.conv_id: (r.turns_sha256, r.loss_chars, r.loss_sha256) for r in read.collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {c: (sha(w), len(x), sha(x)) for c, (w, x) in want.items()}
    assert chat.read_chats(chat.format_chats(turns.limit(0))).count() == 0


# ---- HTML

@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain &lt;b&gt;", "plain <b>"), ("a<br>b", "a\nb"), ("<p>a<p>b", "a\n\nb"), ("<div>a</div>b", "a\nb"),
    ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol></ul>", "- a\n- b\n  3. x\n  4. y"),
    ("<table><tr><td>a<td>bb<tr><td>ccc<td>d<br>e</table>", "a    bb\nccc  d\n     e"),
    ("<table><td colspan=2>a<td>b<tr><td>c<td>d<td>e</table>", "a     b\nc  d  e"),
    ("<title>t</title><script>'</p>'</script>x<style>p{}</style><!-- c -->y", "xy"),
    ("<div hidden>a</div><p style='color:red; display : none'>b</p>c", "c"),
    ("<span style='visibility:hidden'>a<i style='visibility:visible'>b</i></span>c", "bc"),
    ("<pre>  k\n   l</pre>m", "  k\n   l\n\nm"), ("a < b > c", "a < b > c"), ("<p>x</b></i></div>y", "xy"),
    ("<details><summary>s</summary>gone</details>", "s"), ("a<b", "a<b"), ("<dl><dt>t<dd>d</dl>", "t\n  d"),
    ('<ol start="--5"><li>a<li value="\u00b2">b<li value="-3">c<li>d</ol>', "1. a\n2. b\n-3. c\n-2. d"), (f"<ol start={'9' * 5000}><li>a</ol>", "1. a"),
    ("<table><td colspan='\u00b2'>a<td rowspan=x>b</table>", "a  b"), ("<table><td rowspan=2>A<td>b<tr><td>c</table>", "A  b\n   c"),
    ("<table><tbody><td rowspan=0>A<td>b<tr><td>c<tbody><tr><td>d<td>e</table>", "A  b\n   c\nd  e"),
    ("<table><td colspan=1000>a<td>b<tr><td>c</table>", "a  b\nc"), ("x<!-->y<!-- z", "xy"), ("<a title='>'>q</a> <a x", "q <a x"), ("<p title=\"it's\">r", "r"),
    ("<div>" * 149 + "<div style='display:none'>HIDDEN</div>" + "<b hidden>H</b>s", "s"),
])
def test_pages_render_as_they_show(page, text):
    assert html.visible_text(page) == text


def test_pages_keep_all_words(spark):
    for tag in ("div", "b", "blockquote", "ul><li", "table><td", "pre"):
        assert html.visible_text(f"<{tag}>" * 20_000 + "deep<i hidden>no").strip(" -") == "deep"
    pages = spark.createDataFrame([(1, "u", "<title> a  b </title><p>x", "t"), (None, None, None, None), (1, "u", "<p>" + LONG, "t")], "page_id long, url string, html string, text string")
    got = html.extract_pages(pages)
    assert got.columns == ["page_id", "url", "title", "text"]
    assert {r.text for r in got.collect()} == {"x", "", LONG}
    assert html.extract_pages(pages.limit(0)).count() == 0


@pytest.mark.parametrize("piece", ["<a ", "<!", "<a<a", "<a \"", "<a '\"", "</a ", "<title", "<p><b>", "<td rowspan=2>", "<li><p></u>", "&", "<a x=y ;:"])
def test_broken_pages_take_time_in_proportion(piece):
    def seconds(page):
        started = time.process_time()
        html.title_of(page)
        html.visible_text(page)
        return time.process_time() - started

    for end in ("", "\">\"", "'>", ">"):
        assert seconds(piece * 40_000 + end) < 5, end


def naive_page(rnd, depth):
    """A random well-formed page, and the words it shows in order."""
    if depth == 0 or rnd.random() < 0.25:
        word = f"w{rnd.randrange(1000)}"
        return f" {word} ", [word]
    inner = [naive_page(rnd, depth - 1) for _ in range(rnd.randint(1, 4))]
    text, seen = "".join(i[0] for i in inner), [w for i in inner for w in i[1]]
    kind = rnd.randrange(7)
    if kind == 0:
        return f"<div {rnd.choice(['hidden', 'style=display:none'])}>{text}</div>", []
    if kind == 1:
        return f"<{(tag := rnd.choice(['script', 'noscript', 'template']))}>w</{tag}>", []
    if kind == 2:
        return "<table>" + "".join(f"<tr><td>{i[0]}</td></tr>" for i in inner) + "</table>", seen
    if kind == 3:
        return "<ul>" + "".join(f"<li>{i[0]}</li>" for i in inner) + "</ul>", seen
    tag = rnd.choice(["div", "section", "span", "b", "blockquote"])
    return f"<{tag} class='a > b'>{text}</{tag}>", seen


def test_pages_show_the_words_of_a_naive_rendering():
    rnd = random.Random(12)
    for _ in range(400):
        page, seen = naive_page(rnd, 6)
        assert [w for w in html.visible_text(page).split() if w != "-"] == seen


def test_table_cells_stand_in_their_columns():
    rnd = random.Random(13)
    for _ in range(200):
        rows, wide = rnd.randint(1, 6), rnd.randint(1, 5)
        taken, cells, places = {}, [], {}
        for r in range(rows):
            line = []
            for c in range(wide):
                if (r, c) in taken:
                    continue
                tall, name = rnd.randint(1, rows - r), f"c{r}x{c}" + "y" * rnd.randint(0, 5)
                taken.update({(r + i, c): name for i in range(tall)})
                places[name] = (r, c)
                line.append(f"<td rowspan={tall}>{name}")
            cells.append("<tr>" + "".join(line))
        lines = html.visible_text("<table>" + "".join(cells) + "</table>").split("\n")
        found = {word: i for line in lines for word, i in zip(line.split(), [m.start() for m in re.finditer(r"\S+", line)])}
        starts = [{i for name, i in found.items() if places[name][1] == c} for c in range(wide)]
        assert found.keys() == places.keys() and all(len(s) == 1 for s in starts)
        assert [min(s) for s in starts] == sorted(min(s) for s in starts)


# ---- lines

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rnd, text, most):
    out = list(text)
    for _ in range(rnd.randint(0, most)):
        at, kind = rnd.randrange(len(out)), rnd.random()
        if kind < 0.3:
            out.insert(at, "x")
        elif kind < 0.6 and len(out) > 1:
            out.pop(at)
        else:
            out[at] = "y"
    return "".join(out)


def test_banded_distance():
    rnd = random.Random(9)
    for _ in range(5000):
        a = "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 9)))
        b = edited(rnd, a, 4)
        assert lines.within(a, b) == (distance(a, b) <= 2)


def test_line_copies_match_brute_force(spark):
    rnd = random.Random(10)
    base = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randint(28, 45))) for _ in range(30)]
    texts = ["\n".join([edited(rnd, rnd.choice(base), 3) for _ in range(rnd.randint(0, 5))] + [" \t", "short"]) for _ in range(120)]
    docs = spark.createDataFrame([*enumerate(texts), (500, None), (501, "")], "doc_id long, text string")
    known = sorted({x.strip(lines.BLANKS) for t in texts for x in t.split("\n")} - {""})
    close = [(i, j) for i, a in enumerate(known) for j, b in enumerate(known[:i]) if min(len(a), len(b)) >= 30 and abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2]
    root, at, seen, want = union(close, len(known)), {a: i for i, a in enumerate(known)}, set(), {500: (0, 0, ""), 501: (0, 0, "")}
    for d, t in enumerate(texts):
        n, copies = 0, []
        for k, x in enumerate(t.split("\n")):
            if x := x.strip(lines.BLANKS):
                n += 1
                if root[at[x]] in seen:
                    copies.append(k)
                seen.add(root[at[x]])
        want[d] = (n, len(copies), ",".join(map(str, copies)))
    assert {r.doc_id: (r.n_lines, r.n_copies, r.copies) for r in lines.line_report(docs).collect()} == want
    kept = {r.doc_id: r.text for r in lines.drop_copied_lines(docs).collect()}
    assert kept[500] is None and kept[0] == "\n".join(x for k, x in enumerate(texts[0].split("\n")) if str(k) not in want[0][2].split(","))


def test_training_gives_its_memory_back(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(quality, "give_back", lambda: calls.append(1), raising=False)
    docs = spark.createDataFrame([(i, f"text {i} " * 5) for i in range(8)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    assert quality.fit(docs, labels, updates=1).weights is not None and calls == [1]


def test_line_keys_and_trimming_walk_no_line(spark):
    """Lines are trimmed at both ends by all blanks; keys are cut from text of fixed width, alike for any characters."""
    held = [a + x + b for x in ("", "word", "two\twords", "\u00e9\U0001f600") for a in ("", " ", "\t\x0b") for b in ("", "\r", " \x0c", "\u00a0")]
    raw = spark.createDataFrame([(x,) for x in [*held, None]], "line string")
    assert [r[0] for r in raw.select(lines.clean_line(F.col("line"))).collect()] == [x.strip(lines.BLANKS) for x in held] + [None]
    same = "abcdefghijk"
    each = spark.createDataFrame([(1, 0, same * 3), (2, 0, same + "\u00e9" * 11 + same), (3, 0, "\U0001f600" * 11 + same + "z" * 11)], "id long, sketch long, line string")
    found = lines.keyed(each, [(0, i, 0) for i in range(3)], 2)
    met = {tuple(sorted(r.ids)) for r in found.groupBy("key").agg(F.collect_list("id").alias("ids")).collect()}
    assert met == {(1, 2), (1, 3), (1, 2), (2,), (3,)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "substring(line" not in plan and "substring(wide" in plan


def test_lines_that_only_look_alike_give_no_pairs(spark):
    """Lines of the same characters pass the sketch; a cell gives verified links, not the square of its lines."""
    rnd = random.Random(11)
    words = [f"w{i:02d}" for i in range(20)]
    texts = ["a common beginning of a line, as long as the rest " + "".join(rnd.sample(words, 20)) for _ in range(150)]
    docs = spark.createDataFrame([*enumerate([*texts, texts[0] + "x"])], "doc_id long, text string")
    assert sum(r.n_copies for r in lines.line_report(docs).collect()) == 1
    held = [*texts[:100], *texts[:100]]
    rows = pa.table({
        "id": range(200), "root": range(200), "sketch": lines.sketches(held), "indexed": [True] * 100 + [False] * 100, "line": held,
    })
    a, b = lines.links_of_cell(rows, 2)
    assert sorted(zip(b.tolist(), a.tolist())) == [(i, i + 100) for i in range(100)]


def test_sketches_are_parities():
    rnd = random.Random(12)
    for line, found in zip(held := ["".join(rnd.choice("ab\u00e9\U0001f600z") for _ in range(rnd.randint(1, 60))) for _ in range(50)], lines.sketches(held)):
        want = 0
        for c in line:
            want ^= 1 << (ord(c) * int(lines.SKETCH_MIX) % (1 << 64) >> 58)
        assert int(found) % (1 << 64) == want


def test_lines_of_hard_rows(spark):
    docs = hard_docs(spark, ["one\ntwo", "one"])
    assert sum(r.n_copies for r in lines.line_report(docs).collect()) == 5
    assert lines.drop_copied_lines(docs).columns == docs.columns
    assert lines.line_report(empty_docs(spark)).count() == 0


# ---- queries and pipeline

@pytest.mark.parametrize("key", ["op5_benchmark_decontamination", "op6_exact_dedup", "op7_chat_formatting"])
def test_queries_match_sql(spark, key):
    import parity
    from tributary.llm import oracles

    folder = "/root/testdata/sf0.001"
    assert parity.differences(queries.QUERIES[key](spark, folder), parity.connect(folder), oracles.STATEMENTS[key]) == []


def test_pipeline_stages_keep_the_columns(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, _ = corpus_pipeline.written(stage(spark, docs, folder), name)
        assert docs.columns == columns
        assert name == "mix" or docs.count() <= before
        before = docs.count()
    final = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert final.count() == before and final.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
