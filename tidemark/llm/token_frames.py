"""Token ids as seekable zstandard files.

A file is a run of independent zstandard frames and a trailing seek table in a skippable frame:
for each frame its compressed size, its size and the low 32 bits of the XXH64 of its content, then
the number of frames, a descriptor byte and a magic number. A reader takes the table from the end
of the file and decompresses only frames that hold documents it wants; each frame is checked
against its checksum. Every document lies whole in one frame; a frame holds documents up to
``frame_ids`` ids, or one longer document. Ids are little-endian unsigned 32-bit integers.

Documents are range-partitioned by id, sorted, and each task encodes and writes one file, frame by
frame, so a task holds one batch of texts and one frame. The index (document, file, frame, place,
ids) is what Spark commits; a file of a failed or repeated attempt is named by no index row.

Files are written through pyarrow's file systems, so ``folder`` may be local or remote, but must be
shared by all executors.

The encoder keeps the library's ids of every different word (as its pre-tokeniser cuts texts) in a
bounded cache. Texts with characters above U+017F or with the special token's string go to the
library whole.

Defined results: a null or empty text has the end id only. Null ids of documents sort first. Equal
ids keep all their rows, in the order of their texts' hashes; an id that many rows have is split over files.
Columns other than doc_id and text are not written. No documents give no files and no rows.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize

CACHE = 400_000
FRAME_IDS = 1 << 16
# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80

# Words of the byte-level pre-tokeniser, for texts whose characters are all below U+0180.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ſ"
_NUMBER = "0-9²³¹¼-¾"
_BLANK = r"\t-\r \x85\xa0"
_WORD = re.compile(
    # Words first: no other alternative begins like one.
    rf" ?[{_LETTER}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_NUMBER}]+| ?[^{_BLANK}{_LETTER}{_NUMBER}]+"
    rf"|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
_WIDE = re.compile("[^\x00-ſ]")


def _byte_letters() -> str:
    """The letter by which the byte-level pre-tokeniser writes each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(hidden)) for b in range(256))


_LETTERS = _byte_letters()


class WordCache(dict):
    """Ids of a word as bytes, found by the library's model when first asked for."""

    def __init__(self, tokenizer):
        super().__init__()
        self.model = tokenizer.model

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        # The word is cut already, so only the merges are left to do.
        found = self.model.tokenize(word.encode().decode("latin-1").translate(_LETTERS))
        self[word] = ids = struct.pack(f"<{len(found)}I", *[t.id for t in found])
        return ids


class Encoder:
    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.words = WordCache(self.tokenizer)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")

    def encode(self, text: str) -> bytes:
        """Ids of a text, as the library gives them, in little-endian 32-bit integers."""
        if (text.isascii() or not _WIDE.search(text)) and not self.special.search(text):
            return b"".join(map(self.words.__getitem__, _WORD.findall(text)))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def _encoder(definition: str) -> Encoder:
    if definition not in _encoders:
        _encoders.clear()
        _encoders[definition] = Encoder(definition)
    return _encoders[definition]


def _open(path: str, write: bool):
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    if write:
        system.create_dir(name.rpartition("/")[0], recursive=True)
        return system.open_output_stream(name, compression=None)  # frames are compressed already
    return system.open_input_file(name)


class FrameWriter:
    """Writes frames and, when closed, the seek table."""

    def __init__(self, path: str, level: int = 1):
        import zstandard

        self.out, self.table = _open(path, True), []
        self.compressor = zstandard.ZstdCompressor(level=level)

    def add(self, content: bytes) -> None:
        import xxhash

        frame = self.compressor.compress(content)
        self.out.write(frame)
        self.table.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def close(self) -> None:
        body = b"".join(struct.pack("<III", *row) for row in self.table)
        footer = struct.pack("<IBI", len(self.table), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body) + len(footer)) + body + footer)
        self.out.close()


class FrameReader:
    """Reads single frames of a file by the seek table at its end."""

    def __init__(self, path: str):
        import zstandard

        self.file = _open(path, False)
        size = self.file.size()
        self.file.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        width = 12 if flags & CHECKSUMS else 8
        self.file.seek(size - 9 - n * width)
        rows = list(struct.iter_unpack("<III" if width == 12 else "<II", self.file.read(n * width)))
        self.rows, self.starts = rows, np.concatenate([[0], np.cumsum([r[0] for r in rows], dtype=np.int64)])
        self.path, self.decompressor = path, zstandard.ZstdDecompressor()

    def frame(self, k: int) -> bytes:
        import xxhash

        packed, size, *check = self.rows[k]
        self.file.seek(int(self.starts[k]))
        content = self.decompressor.decompress(self.file.read(packed), max_output_size=max(1, size))
        if len(content) != size or check and check[0] != xxhash.xxh64_intdigest(content) & 0xFFFFFFFF:
            raise ValueError(f"frame {k} of {self.path} is damaged")
        return content

    def close(self) -> None:
        self.file.close()


INDEX = "doc_id long, part int, file string, frame int, place int, n_tokens long, before long"


def write_documents(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, frame_ids: int = FRAME_IDS,
) -> DataFrame:
    """Write ``docs`` (doc_id, text) below ``folder``; returns the index of what was written.

    ``place`` is the document's first id in its frame, ``start`` the number of ids of all documents
    before it in the order of doc_id.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(definition.value), TaskContext.get().partitionId()
        path = f"{folder.rstrip('/')}/part-{part:06d}-{uuid.uuid4().hex}.zst"
        writer, frame, held, before, at = None, [], 0, 0, 0
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py() or "") + end
                n = len(ids) // 4
                writer = writer or FrameWriter(path)
                if held and held + n > frame_ids:
                    writer.add(b"".join(frame))
                    frame, held, at = [], 0, at + 1
                rows.append((key, part, path, at, held, n, before))
                frame.append(ids)
                held, before = held + n, before + n
            if rows:
                yield pa.RecordBatch.from_arrays([
                    pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                        pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)
                ], names=["doc_id", "part", "file", "frame", "place", "n_tokens", "before"])
        if writer:
            writer.add(b"".join(frame))
            writer.close()

    # An id that many rows have is split by the hash of the text.
    key = ("doc_id", "text_hash")
    order = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).repartitionByRange(*key).sortWithinPartitions(*key).select("doc_id", "text")
    index = materialize(order.mapInArrow(run, INDEX), "index")
    # One row for each file: its place in the order, and the ids of all files before it.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = index.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return index.join(F.broadcast(bases), "part").select(
        "doc_id", "file", "frame", "place", "n_tokens", (F.col("base") + F.col("before")).alias("start"))


def read_documents(index: DataFrame, ids: bool = True) -> DataFrame:
    """The index rows given, with what the files hold: ``ids`` (bytes) and ``ids_crc32``.

    Rows of one frame meet in one task, which reads that frame once.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if ids else "")
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if ids else [])]
    types = [pa.int64()] * 4 + [pa.binary()] * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, open_frame, content = None, None, b""
        for batch in batches:
            rows = []
            for key, path, frame, place, n, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if reader is None or reader.path != path:
                    if reader:
                        reader.close()
                    reader, open_frame = FrameReader(path), None
                if open_frame != frame:
                    content, open_frame = reader.frame(frame), frame
                own = content[4 * place:4 * (place + n)]
                if len(own) != 4 * n:
                    raise ValueError(f"frame {frame} of {path} is too short")
                rows.append((key, start, len(own) // 4, zlib.crc32(own), own)[:len(names)])
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
        if reader:
            reader.close()

    return (
        index.select("doc_id", "file", "frame", "place", "n_tokens", "start")
        .repartition("file", "frame").sortWithinPartitions("file", "frame", "place").mapInArrow(run, schema))
