"""Near-duplicate stage of the pipeline: documents whose five-word shingles have a Jaccard similarity of at least 0.8.

Candidates come by ball hashing first, the method of ``simhash``, here on fingerprints over five-word shingles: texts that
differ in at most three bits meet, and each is verified against the nearest of those it meets. Three of 64 bits reach
the closest copies only (a quarter of those at 0.9 to 0.95, see README), and a fingerprint of a few bits cannot tell 0.8
from 0.6. What is still apart meets by min-hashes: ``BANDS`` keys of ``ROWS`` minima each. Documents at a similarity s share
a key with probability 1 - (1 - s**ROWS)**BANDS, 0.9995 at 0.8. Every link is verified on the shingles of both texts;
nothing is linked by fingerprints or keys alone.

Documents of a key form a list, and lists are worked off as in ``ngrams.Spanning``: documents without a partner that passes
the size and sketch filters leave, the others are verified against a few leaders, and lists that still hold several
components yield pairs that join them, in cells of bounded size. A large group of near copies is not met all against all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_arrow, discard, free_names, row_hash, text_bytes, written
from .ngrams import Hashes, Rule, Spanning, counted, in_cells, over_cells, packed, partners, shingles
from .simhash import LOWER, fingerprint, links, one_of_each

STAGE = Rule(5, 80, 100)
SEED_OF_MIX = 5
BANDS, ROWS = 32, 7
BLOCK = 2048
MIX = np.random.default_rng(SEED_OF_MIX).integers(0, 1 << 63, (2, BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def normal(text: bytes) -> bytes:
    """The words of a text in lower case, one blank between them: texts alike in this have the same shingles."""
    return b" ".join(text.translate(LOWER).split())


def minima(hashes: np.ndarray) -> np.ndarray:
    found = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), BLOCK):
        found = np.minimum(found, ((hashes[at : at + BLOCK] ^ MIX[0]) * MIX[1]).min(axis=1))
    return found


def band_keys(found: np.ndarray) -> list[int]:
    return [xxhash.xxh64_intdigest(part.tobytes(), band) for band, part in enumerate(found.reshape(BANDS, ROWS))]


def with_keys(docs: DataFrame, rule: Rule) -> DataFrame:
    """``(doc_id, mark, print, n, bits, keys, sketch)`` of ``docs (doc_id, mark, text)``.

    ``print`` identifies the normal text, ``bits`` is its fingerprint.
    """
    added = {"print": F.lit(b""), "n": F.lit(0), "bits": F.lit(0).cast("long"), "keys": F.array(F.lit(0).cast("long")), "sketch": F.lit(b"")}
    schema = docs.select("doc_id", "mark", *[c.alias(k) for k, c in added.items()]).schema
    known, names = Hashes(), ["doc_id", "mark", *added]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch["text"])
        prints, sizes, bits, keys, sketches = [], [], [], [], []
        for a, b in zip(offsets, offsets[1:]):
            joined = normal(bytes(data[a:b]))
            own = shingles(joined, known, rule.size)
            prints.append(xxhash.xxh3_128_digest(joined))
            sizes.append(len(own))
            bits.append(fingerprint(joined, rule.size))
            keys.append(np.array(band_keys(minima(own)), np.uint64).view(np.int64))
            sketches.append(rule.sketch(own))
        columns = [pa.array(prints, pa.binary()), pa.array(sizes, pa.int32()), pa.array(np.array(bits, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
        return pa.RecordBatch.from_arrays([batch["doc_id"], batch["mark"], *columns], names)

    return by_arrow(docs.select("doc_id", "mark", "text"), schema, work)


def by_balls(held: DataFrame, rule: Rule) -> DataFrame:
    """``(a, b)``: pairs that fingerprints within the radius make of ``held (gid, n, bits)``, at most one for each node.

    Nodes of one fingerprint go with its first node, and that one with the first node of the nearest smaller fingerprint
    it meets. Pairs whose sizes alone rule out the similarity are left out.
    """
    leads, path = written(held.groupBy("bits").agg(F.min(F.struct("gid", "n")).alias("lead")).select("bits", F.col("lead.gid").alias("lead"), F.col("lead.n").alias("lead_n")), "leads")
    same = held.join(leads, "bits").where("gid <> lead").select("gid", "n", F.col("lead").alias("to"), F.col("lead_n").alias("to_n"))
    met = links(leads.select(F.col("bits").alias("fp")))
    near = met.groupBy("a").agg(F.min_by("b", F.struct(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).alias("d"), "b")).alias("b"))
    one, two = (leads.select(F.col("bits").alias(f"bits_{x}"), F.col("lead").alias(f"lead_{x}"), F.col("lead_n").alias(f"n_{x}")) for x in "ab")
    joined = near.join(one, F.col("a") == F.col("bits_a")).join(two, F.col("b") == F.col("bits_b")).select("lead_a", "n_a", "lead_b", "n_b")
    sized = same.union(joined).where(rule.link * F.greatest("n", "to_n") <= rule.of * F.least("n", "to_n"))
    found, _ = written(sized.select(F.greatest("gid", "to").alias("a"), F.least("gid", "to").alias("b")), "ball-pairs")
    discard(held.sparkSession, path)
    return found


class KeyJoin(Spanning):
    """Normal texts that meet by their fingerprints or share a key. ``prints`` is ``with_keys`` of ``docs``; one row stands for all of a text."""

    def __init__(self, docs: DataFrame, prints: DataFrame, rule: Rule):
        super().__init__(docs.sparkSession, rule)
        row = F.min(F.struct("mark", "doc_id"))
        of_print = prints.groupBy("print").agg(F.min("n").alias("n"), F.min("bits").alias("bits"), F.first("keys").alias("keys"), F.min("sketch").alias("sketch"), row.alias("row"))
        self.nodes = self.keep(of_print.select(F.monotonically_increasing_id().alias("gid"), "print", "n", "bits", "keys", "sketch", "row.*"), "nodes")
        self.members = self.spark.createDataFrame([], "gid long, cid long")
        self.near = self.keep(by_balls(self.nodes.where("n > 0").select("gid", "n", "bits"), rule), "near")
        each = self.nodes.where("n > 0").select(F.explode("keys").alias("token"), F.lit(0).alias("pos"), "gid", "n")
        every = self.keep(counted(each), "lists")
        sketches = self.nodes.select(F.col("gid").alias("g"), F.lit(1).cast("long").alias("members"), "sketch")
        met = every.join(sketches, F.col("gid") == F.col("g")).withColumns({"low": F.col("gid"), "high": F.col("gid")})
        alive = self.keep(over_cells(in_cells(met), rule, partners).select(F.col("a").alias("gid")), "alive")
        self.lists = self.keep(every.join(alive, "gid", "left_semi"), "live-lists")
        self.groups = self.keep(sketches.withColumnRenamed("g", "gid").join(alive, "gid", "left_semi"), "live-groups")
        ends = self.near.select(F.explode(F.array("a", "b")).alias("gid"))
        wanted = self.nodes.join(alive.union(ends), "gid", "left_semi").select(F.col("gid").alias("cid"), F.col("mark").alias("m"))
        own = packed(docs).join(self.keep(wanted, "wanted"), F.col("mark") == F.col("m")).select("cid", "text").dropDuplicates(["cid"])
        self.texts = self.keep(own, "candidate-texts")

    def run(self) -> None:
        self.add(self.near)
        super().run()

    def classes(self) -> DataFrame:
        """``(fp, root)`` for each print, as ``fp``; a table that is read after the others are gone."""
        found = self.nodes.join(self.roots, F.col("gid") == F.col("node"), "left").select(F.col("print").alias("fp"), F.coalesce("root", "gid").alias("root"))
        return self.keep(found, "classes")


def keep_one(docs: DataFrame, rule: Rule = STAGE) -> DataFrame:
    """One row of each group of similar documents, with all columns, by the rules of ``simhash.keep_one``.

    A group is a connected component of pairs with the similarity. Null and empty texts and those of blanks only are alike.
    """
    (mark,) = free_names(docs, "row_mark")
    marked = docs.select("*", row_hash(docs).alias(mark))
    own = marked.select("doc_id", "text", F.col(mark).alias("mark"))
    prints, prints_path = written(with_keys(own, rule), "prints")
    join = KeyJoin(own, prints, rule)
    join.run()
    kept = one_of_each(docs, marked, mark, prints.select("doc_id", "mark", F.col("print").alias("fp")), join.classes())
    discard(docs.sparkSession, prints_path, *join.paths)
    return kept
