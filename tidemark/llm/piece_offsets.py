"""Offset-preserving encoding and decoding with a sentencepiece model.

A text is first normalised: the longest prefix the model's compiled character map knows is replaced
by its image, other characters are copied, spaces become U+2581, and a dummy prefix is put in
front. While doing so the place in the original bytes is recorded for every normalised byte. The
normalised text is then cut before every run of U+2581 (no piece of such a model crosses that
boundary, which is checked when the model is loaded), the segments of a text that are new are merged into
pieces in one call, and each piece's normalised bytes are projected to a span of original bytes.

Texts without any character that the map or the white-space rules touch take a shorter way: there a
space is the only symbol whose length changes, so its length in original bytes is a property of
the piece.

Decoding is the reverse: byte pieces are collected and read as UTF-8, invalid bytes become U+FFFD,
control pieces give nothing, and the dummy prefix is taken off.

The merges of a segment are the library's own, on a copy of the model without normaliser and dummy
prefix. The cache of segments is bounded (``CACHE``) and only saves time.

Defined results: a null or empty text has the end id only (if asked for), no spans, and decodes to
''. The end id has the empty span at the end of the text. Every row gives one row; extra columns
are kept, columns named like an output are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .shared import fresh

SPACE = "▁"
CACHE = 200_000
OUTPUTS = ("ids", "starts", "ends")


class CharMap:
    """The compiled map: a double-array trie over UTF-8 and the images, ended by NUL bytes."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.images = blob[4 + size:]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix of ``text[at:]`` and its image."""
        units, found = self.units, None
        if not units:
            return None
        step = lambda u: (u >> 10) << ((u & 0x200) >> 6)
        node = step(units[0])
        for k in range(at, len(text)):
            node ^= text[k]
            unit = units[node]
            if unit & 0x800000FF != text[k]:
                break
            node ^= step(unit)
            if unit >> 8 & 1:
                found = k + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        image = self.images[found[1]:self.images.index(b"\0", found[1])]
        return found[0], image

    def first_bytes(self) -> set[int]:
        """Bytes with which a known prefix may begin."""
        if not self.units:
            return set()
        step = (self.units[0] >> 10) << ((self.units[0] & 0x200) >> 6)
        return {b for b in range(256) if step ^ b < len(self.units) and self.units[step ^ b] & 0x800000FF == b}


class Model:
    """A sentencepiece model with its normaliser taken apart."""

    def __init__(self, proto: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto.FromString(proto)
        spec = model.normalizer_spec
        if model.trainer_spec.treat_whitespace_as_suffix or not spec.escape_whitespaces:
            raise ValueError("models with white space as a suffix or without escapes are not supported")
        self.map = CharMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        touched = self.map.first_bytes()
        # Characters that keep a text off the short way.
        odd = {SPACE} | {chr(b) for b in touched if b < 128}
        self.odd = re.compile("[" + "".join(map(re.escape, sorted(odd))) + "]")
        self.plain_only_ascii = any(b >= 128 for b in touched)
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces = b"", False, False
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.end = self.merger.eos_id()
        self.surface, self.kind, self.length, plain = [], [], [], []
        crosses = False
        for p in model.pieces:
            raw = p.piece.encode()
            if p.type == 6:
                self.surface.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type in (3, 2):
                self.surface.append(model.trainer_spec.unk_surface.encode() if p.type == 2 else b"")
            else:
                self.surface.append(p.piece.replace(SPACE, " ").encode())
                crosses = crosses or SPACE in p.piece.lstrip(SPACE)
            self.kind.append(p.type)
            self.length.append(1 if p.type == 6 else len(raw))
            # Original bytes of the piece if every U+2581 stands for one space.
            plain.append(self.length[-1] - 2 * self.surface[-1].count(b" ") if p.type == 1 else self.length[-1])
        self.plain_length = np.array(plain, np.int32)
        if not model.trainer_spec.byte_fallback:
            raise ValueError("models without byte fallback are not supported")
        self.segment = re.compile(".*" if crosses else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", re.DOTALL)
        # The same cut on a text whose spaces are not yet escaped.
        self.raw_segment = re.compile(r".+" if crosses else " +[^ ]*|[^ ]+", re.DOTALL)
        self.ids: dict[str, bytes] = {}

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them (and the end) its place in ``text``.

        ``text`` may hold invalid UTF-8; each invalid byte becomes U+FFFD.
        """
        out, at, places = bytearray(), 0, []
        space = SPACE.encode()

        def unit(k: int) -> tuple[int, bytes]:
            known = self.map.longest(text, k)
            if known:
                return known
            for n in (1, 2, 3, 4):
                try:
                    text[k:k + n].decode()
                    return (n, text[k:k + n]) if text[k:k + n] else (1, b"")
                except UnicodeDecodeError:
                    continue
            return 1, "�".encode()

        if self.squeeze:
            while at < len(text):
                n, image = unit(at)
                if image != b" ":
                    break
                at += n
        if at >= len(text):
            return b"", np.zeros(1, np.int64)
        if self.dummy:
            out += space
            places += [at] * len(space)
        after_space = self.squeeze
        while at < len(text):
            n, image = unit(at)
            if self.squeeze and after_space:
                image = image.lstrip(b" ")
            for piece in re.findall(b" |[^ ]+", image):
                put = space if piece == b" " else piece
                out += put
                places += [at] * len(put)
            if image:
                after_space = self.squeeze and image.endswith(b" ")
            at += n
        if self.squeeze:
            while out.endswith(space):
                at = places[len(out) - len(space)]
                del out[-len(space):]
        places = places[:len(out)] + [at]
        return bytes(out), np.array(places, np.int64)

    def _learn(self, segments: list[str]) -> None:
        """Merge segments, with spaces not yet escaped, by one call of the library."""
        found = self.merger.encode([s.replace(" ", SPACE) for s in segments], num_threads=1)
        flat = np.fromiter(chain.from_iterable(found), "<i4").tobytes()
        ends = [4 * k for k in accumulate(map(len, found))]
        self.ids.update(zip(segments, [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))

    def forget(self) -> None:
        """Give back the memory of the cache between tasks."""
        self.ids.clear()

    def is_plain(self, text: str) -> bool:
        if self.squeeze or not self.dummy or self.plain_only_ascii and not text.isascii():
            return False
        return self.odd.search(text) is None

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and the start and end of each in the bytes of ``text``."""
        if not text:
            none = np.zeros(0, np.int32)
            return none, none, none
        if not self.is_plain(text):
            return self._encode_mapped(text)
        segments = self.raw_segment.findall(" " + text)
        new = set(segments).difference(self.ids)
        if new:
            if len(self.ids) + len(new) > CACHE:
                self.ids.clear()
                new = set(segments)
            self._learn(list(new))
        ids = np.frombuffer(b"".join(map(self.ids.__getitem__, segments)), "<i4")
        lengths = self.plain_length[ids]
        ends = np.cumsum(lengths, dtype=np.int32)
        starts = ends - lengths
        # The dummy prefix takes no byte of the text.
        return ids, np.maximum(starts - 1, 0), ends - 1

    def _encode_mapped(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        normal, places = self.normalise(text.encode())
        ids: list[int] = []
        for s in self.segment.findall(normal.decode()):
            ids.extend(self.merger.encode(s))
        cuts = np.concatenate([[0], np.cumsum([self.length[i] for i in ids], dtype=np.int64)])
        return np.array(ids, np.int32), places[cuts[:-1]].astype(np.int32), places[cuts[1:]].astype(np.int32)

    def decode(self, ids: np.ndarray) -> str:
        given = ids.tolist()
        raw = b"".join(map(self.surface.__getitem__, given))
        first = next((i for i in given if self.kind[i] != 3), None) if self.dummy else None
        if first is not None and self.kind[first] == 1 and raw.startswith(b" "):
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return _bytewise(raw)


def _bytewise(raw: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that is no part of a valid character."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_models: dict[bytes, Model] = {}


def _model(proto: bytes) -> Model:
    if proto not in _models:
        _models.clear()
        _models[proto] = Model(proto)
    return _models[proto]


def _kept(df: DataFrame, names: tuple[str, ...]) -> list[str]:
    return [c for c in df.columns if c.lower() not in names]


def encode(
    df: DataFrame, model_path: str, text: str = "text", add_end: bool = True, decoded: str | None = None,
) -> DataFrame:
    """``df`` with ``ids``, ``starts`` and ``ends`` (arrays of the same length; spans in UTF-8 bytes).

    ``decoded`` names a column for the text that the ids decode to: the round trip in the same task,
    as ``decode`` gives it for ids of any origin.
    """
    with open(model_path, "rb") as f:
        model = df.sparkSession.sparkContext.broadcast(f.read())
    more = [decoded] if decoded else []
    kept = _kept(df, (*OUTPUTS, *(c.lower() for c in more)))
    schema = T.StructType([df.schema[c] for c in kept] + [
        T.StructField(n, T.ArrayType(T.IntegerType(), False), False) for n in OUTPUTS] + [
        T.StructField(c, T.StringType(), False) for c in more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model.value)
        for batch in batches:
            parts, sizes, back = ([], [], []), [0], []
            for s in batch.column(len(kept)):
                word = s.as_py() or ""
                found = m.encode(word)
                if add_end:
                    end = np.array([len(word.encode())], np.int32)
                    found = np.append(found[0], np.int32(m.end)), np.append(found[1], end), np.append(found[2], end)
                for part, x in zip(parts, found, strict=True):
                    part.append(x)
                sizes.append(len(found[0]))
                if decoded:
                    back.append(m.decode(found[0]))
            offsets = pa.array(np.cumsum(sizes), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(p or [np.zeros(0, np.int32)]).astype(np.int32)))
                     for p in parts]
            texts = [pa.array(back, pa.string()) for _ in more]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], *lists, *texts], names=[*kept, *OUTPUTS, *more])
        m.forget()

    return df.select(*kept, df[text].alias(fresh(df, "text_in"))).mapInArrow(run, schema)


def decode(df: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids`` in ``out``, in place of ``ids``, ``starts`` and ``ends``."""
    with open(model_path, "rb") as f:
        model = df.sparkSession.sparkContext.broadcast(f.read())
    kept = _kept(df, (out.lower(), ids.lower(), *OUTPUTS))
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(out, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model.value)
        for batch in batches:
            lists = batch.column(len(kept))
            flat = lists.values.to_numpy(zero_copy_only=False)
            cuts = lists.offsets.to_numpy()
            texts = [m.decode(flat[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(texts, pa.string())], names=[*kept, out])

    return df.select(*kept, df[ids].alias(fresh(df, "ids_in"))).mapInArrow(run, schema)
