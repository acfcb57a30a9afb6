"""Token ids in a seekable binary format.

A file holds whole documents in ascending order as independent zstandard frames, then two skippable frames: an index of
the documents, and the seek table of zstandard's seekable format (sizes of every frame and the low 32 bits of the XXH64
of its content). A reader fetches the end of a file, then only the frames that hold the documents it wants, and checks
each one. Any zstandard decoder reads a file from front to back.

    frame 0 | frame 1 | ... | skippable: document index | skippable: seek table

Ids are little-endian unsigned integers of two bytes where the vocabulary allows it, else four. Files are written under
names of their own by every task attempt; only those named in the manifest, which Spark commits, are part of the output.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, give_back, input_bytes, scratch, text_or_empty, written

END_ID = 1
FRAME_BYTES = 256 * 1024
MEMO_WORDS, MEMO_LETTERS = 200_000, 48  # some 50 MB in a worker
# Fixed values of the seekable format.
SEEK_MAGIC, SKIPPABLE_SEEK, SKIPPABLE_INDEX = 0x8F92EAB1, 0x184D2A5E, 0x184D2A5D
HAS_CHECKSUMS = 0x80
FOOTER, FOOTER_SIZE = "<IBI", 9
PUNCTUATION = "!#$%&()*+,-./:;?@[]^_`{|}~"
FILE_BYTES = 256 * 1024 * 1024
# The steps before the model under which a text's ids are those of its parts between blanks.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed", "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 as it is, others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b if b in shown else 256 + hidden.index(b)) for b in range(256)}


def by_parts(definition: str) -> bool:
    """Whether this tokenizer treats the parts of a text between blanks one by one, as ``Encoder`` may then do too."""
    rules = json.loads(definition)
    model = rules["model"]
    return (
        rules.get("normalizer") == NORMALIZER and rules.get("pre_tokenizer") == PRE_TOKENIZER
        and not any(rules.get(k) for k in ("truncation", "padding"))
        and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback"))
        and all(t["content"].startswith("<|") and not any(c.isspace() for c in t["content"]) for t in rules["added_tokens"])
        and not any(t[k] for t in rules["added_tokens"] for k in ("lstrip", "rstrip", "single_word", "normalized"))
    )


class Encoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes.

    A tokenizer whose steps are not those of ``by_parts`` gets every text whole. Else the tokenizer drops white space and never merges across it, so a text's ids are those of its parts between blanks
    and line feeds, one after the other. Ids of short parts are remembered, up to ``MEMO_WORDS`` of them. Words of Latin
    letters only are one piece to the tokenizer whatever its rules do elsewhere; they go to its model directly.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.by_parts = by_parts(definition)
        if not self.by_parts:
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.memo: dict[str, bytes] = {"": b""}

    def width(self) -> int:
        return 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4

    def whole(self, parts: list[str]) -> dict[str, bytes]:
        encoded = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False) if parts else []
        return {p: struct.pack(f"<{len(e.ids)}I", *e.ids) for p, e in zip(parts, encoded)}

    def word(self, word: str) -> bytes | None:
        """Ids of a word of Latin letters, None for any other text."""
        if not word.isalpha() or not word.isascii() and (max(word) > "\u017f" or "\u0130" in word):
            return None
        low = word.lower()
        if not low.isascii():
            low = low.encode().decode("latin-1").translate(self.letters)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(low)])

    def learn(self, parts: set[str]) -> dict[str, bytes]:
        """Ids of parts that are not remembered yet.

        Punctuation after a letter is a piece of its own to the tokenizer, so a Latin word is looked up without it. All
        other parts, which may hold added tokens, go to the tokenizer whole: their ids never depend on what is remembered.
        """
        memo, found, cut = self.memo, {}, []
        for part in parts:
            word = part.rstrip(PUNCTUATION)
            ids = memo.get(word) if word.isalpha() else None
            if ids is None and word and (ids := self.word(word)) is not None and len(word) <= MEMO_LETTERS:
                memo[word] = ids
            if ids is None or "<|" in part or len(word) < len(part) and not word[-1].lower()[-1].isalpha():
                cut.append((part, b"", part))
            elif len(word) < len(part):
                cut.append((part, ids, part[len(word) :]))
            else:
                found[part] = ids
        rest = self.whole([r for r in {r for _, _, r in cut} if r not in memo])
        found.update((part, ids + (rest[r] if r in rest else memo[r])) for part, ids, r in cut)
        memo.update((p, x) for new in (rest, found) for p, x in new.items() if len(p) <= MEMO_LETTERS)
        return found

    def texts(self, texts: list[str]) -> Iterator[bytes]:
        if not self.by_parts:
            yield from (self.whole([text])[text] for text in texts)
            return
        for text in texts:
            if len(self.memo) > MEMO_WORDS:
                self.memo.clear()
                self.memo[""] = b""
            parts = text.replace("\n", " ").split(" ")
            missing = set(parts).difference(self.memo)
            found = self.learn(missing) if missing else {}
            yield b"".join([found[p] if p in found else self.memo[p] for p in parts] if found else map(self.memo.__getitem__, parts))


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, which may be local or any that pyarrow knows."""
    return fs.FileSystem.from_uri(path)


def skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


def write_file(sink, documents: Iterable[tuple[int | None, bytes]], width: int, frame_bytes: int = FRAME_BYTES) -> tuple[int, int]:
    """Writes ``(doc_id, ids as <u4 bytes)`` to an open stream; the numbers of documents and ids."""
    packer = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
    table, ids, lengths, pending, size = [], [], [], [], 0

    def flush() -> None:
        content = b"".join(pending)
        packed = packer.compress(content)
        sink.write(packed)
        table.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        pending.clear()

    for doc_id, raw in documents:
        own = raw if width == 4 else np.frombuffer(raw, "<u4").astype("<u2").tobytes()
        pending.append(own)
        size += len(own)
        ids.append(doc_id)
        lengths.append(len(own) // width)
        if size >= frame_bytes:
            flush()
            size = 0
    if pending:
        flush()
    index = struct.pack("<QB", len(ids), width) + np.array([i is not None for i in ids], np.uint8).tobytes()
    index += np.array([i or 0 for i in ids], "<i8").tobytes() + np.array(lengths, "<u8").tobytes()
    sink.write(skippable(SKIPPABLE_INDEX, packer.compress(index)))
    entries = b"".join(struct.pack("<III", *x) for x in table)
    sink.write(skippable(SKIPPABLE_SEEK, entries + struct.pack(FOOTER, len(table), HAS_CHECKSUMS, SEEK_MAGIC)))
    return len(ids), sum(lengths)


def read_file(source, wanted: set[int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """``(doc_id, ids before it in the file, ids)`` in file order; only frames with a wanted document are fetched.

    Damage to the table, the index or a frame raises ValueError.
    """

    def fetch(at: int, n: int) -> bytes:
        source.seek(at)
        got = source.read(n)
        if len(got) != n:
            raise ValueError("the file is cut off")
        return got

    end = source.size() if callable(source.size) else source.size
    n_frames, flags, magic = struct.unpack(FOOTER, fetch(end - FOOTER_SIZE, FOOTER_SIZE))
    if magic != SEEK_MAGIC or flags != HAS_CHECKSUMS:
        raise ValueError("no seek table")
    start = end - 8 - 12 * n_frames - FOOTER_SIZE
    if struct.unpack("<II", fetch(start, 8)) != (SKIPPABLE_SEEK, 12 * n_frames + FOOTER_SIZE):
        raise ValueError("the seek table is damaged")
    table = np.frombuffer(fetch(start + 8, 12 * n_frames), "<u4").reshape(-1, 3).astype(np.int64)
    at = int(table[:, 0].sum())
    magic, n = struct.unpack("<II", fetch(at, 8))
    if magic != SKIPPABLE_INDEX or at + 8 + n != start:
        raise ValueError("the document index is damaged")
    unpacker = zstandard.ZstdDecompressor()
    index = unpacker.decompress(fetch(at + 8, n))
    count, width = struct.unpack_from("<QB", index)
    there = np.frombuffer(index, np.uint8, count, 9)
    ids = np.frombuffer(index, "<i8", count, 9 + count)
    ends = np.cumsum(np.frombuffer(index, "<u8", count, 9 + 9 * count).astype(np.int64))
    starts = np.append(0, ends[:-1])
    frame_ends = np.cumsum(table[:, 1]) // width
    of = np.searchsorted(frame_ends, starts, "right")
    places = np.cumsum(table[:, 0]) - table[:, 0]
    if (ends[-1] if count else 0) * width != table[:, 1].sum():
        raise ValueError("the seek table does not fit the document index")
    loaded, content = -1, np.empty(0, np.uint32)
    for i in range(count):
        doc_id = int(ids[i]) if there[i] else None
        if wanted is not None and doc_id not in wanted:
            continue
        if starts[i] == ends[i]:
            yield doc_id, int(starts[i]), np.empty(0, np.uint32)
            continue
        f = int(of[i])
        if f != loaded:
            raw = unpacker.decompress(fetch(int(places[f]), int(table[f, 0])))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != table[f, 2]:
                raise ValueError(f"frame {f} does not match its checksum")
            loaded, content = f, np.frombuffer(raw, f"<u{width}").astype(np.uint32)
        base = int(frame_ends[f]) - int(table[f, 1]) // width
        yield doc_id, int(starts[i]), content[starts[i] - base : ends[i] - base]


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Encodes all texts and writes them in ascending doc_id order, null first; the manifest, a row for each file.

    Rows of one doc_id follow each other, ordered by the hash of their text. A null text is empty and has the end id
    only. ``tokenizer`` is the tokenizer's definition (JSON). ``start`` counts the ids in the files before.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    folder = folder or scratch(spark, "tokens")
    # The encoder stays with the broadcast in each Python worker, and so does what it remembers.
    shared = spark.sparkContext.broadcast({"definition": tokenizer})
    end = np.array([end_id], "<u4").tobytes()

    def work(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        if "encoder" not in held:
            held["encoder"] = Encoder(held["definition"])
        encoder = held["encoder"]
        first = next((b for b in stream if b.num_rows), None)
        if first is None:
            return

        def documents() -> Iterator[tuple[int | None, bytes]]:
            batch = first
            while batch is not None:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    for doc_id, ids in zip(part["doc_id"].to_pylist(), encoder.texts(part["text"].to_pylist())):
                        yield doc_id, ids + end
                batch = next(stream, None)

        part = TaskContext.get().partitionId()
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.ids.zst"
        with store.open_output_stream(f"{base}/{name}", compression=None) as sink:
            n_docs, n_ids = write_file(sink, documents(), encoder.width(), frame_bytes)
        yield pa.RecordBatch.from_pylist([{"part": part, "path": f"{folder}/{name}", "n_docs": n_docs, "n_ids": n_ids}])
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), F.xxhash64("text").alias("tie"))
    # Files of bounded size: more partitions than the session asks for when the table is larger than they should hold.
    files = -(-input_bytes(docs) // FILE_BYTES)
    width = [files] if files > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    ordered = rows.repartitionByRange(*width, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    manifest, _ = written(ordered.mapInArrow(work, "part long, path string, n_docs long, n_ids long"), "manifest")
    # One row for each file: the running sum is over files, not documents.
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.select("*", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long").alias("start"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files of a manifest, read from the files.

    As many tasks as files: the manifest is tiny, the files are not, and its own size would put all of them in one task.
    """

    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def work(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in stream:
            for path, start in zip(files["path"].to_pylist(), files["start"].to_pylist()):
                store, place = open_store(path)
                with store.open_input_file(place) as source:
                    found = [(doc_id, start + before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for doc_id, before, ids in read_file(source)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names)
        give_back()

    spread = manifest.select("part", "path", "start").repartitionByRange(max(1, manifest.count()), "part")
    return spread.mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")
