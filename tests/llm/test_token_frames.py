"""Files of token ids: library ids, exact round trip, seeking, damage."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import token_frames

PATH = public_tokenizers.path("byte_bpe_50k.json")
CASES = ["", " ", "I'll  don't\n\n x", "naïve ¼ ² café  ", "日本 🙂 x", "a<|endoftext|>b", "\x1c\x1d x\x85y\xa0 z", "a" * 5000, "'s 's''ll",
         "ſ ƀ Ł", "x\t \n", "$$$ && *** 12,5"]


@pytest.fixture(scope="module")
def both():
    with open(PATH, encoding="utf-8") as f:
        return token_frames.Encoder(f.read()), Tokenizer.from_file(PATH)


def same(both, text):
    want = both[1].encode(text, add_special_tokens=False).ids
    assert np.frombuffer(both[0].encode(text), "<u4").tolist() == want


@pytest.mark.parametrize("text", CASES)
def test_ids(both, text):
    same(both, text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x17F), st.sampled_from(" '\n\tst")), max_size=40))
def test_ids_of_random_texts(both, text):
    same(both, text)


def test_words_cost_their_merges_only():
    """A new word goes to the model alone, not through the whole library again; ids are the same."""
    whole = Tokenizer.from_file(PATH)

    class Model:
        model = whole.model  # no encode()

    words = token_frames.WordCache(Model())
    for word in ("word", " naïve", "¼", "\x85", " \x1c\x7f", "ſ", "a" * 3000, " $$$", "\n\n", "'ll"):
        assert np.frombuffer(words[word], "<u4").tolist() == whole.encode(word, add_special_tokens=False).ids


def test_round_trip(spark, both, tmp_path):
    rows = [(i, CASES[i % len(CASES)] * (1 + i % 3)) for i in range(200)] + [(5, "again"), (5, "again"), (7, None), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    index = token_frames.write_documents(df, f"file://{tmp_path}/out", PATH, 2, frame_ids=500)
    got = token_frames.read_documents(index).collect()
    assert len(got) == len(rows)
    want = {}
    for key, text in rows:
        ids = np.array(both[1].encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        want.setdefault(key, []).append((len(ids) // 4, zlib.crc32(ids), ids))
    start = 0
    by_place = sorted(got, key=lambda r: r["start"])
    keys = [r["doc_id"] for r in by_place]
    assert keys[0] is None and keys[1:] == sorted(keys[1:])
    for r in by_place:
        assert r["start"] == start
        start += r["n_tokens"]
        want[r["doc_id"]].remove((r["n_tokens"], r["ids_crc32"], bytes(r["ids"])))
    assert not any(want.values())
    assert token_frames.read_documents(index.where("doc_id = 11"), ids=False).count() == 1


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_frames.write_documents(df, f"file://{tmp_path}/none", PATH, 2).count() == 0


def test_reads_only_asked_frames_and_finds_damage(tmp_path):
    path = f"file://{tmp_path}/a.zst"
    writer = token_frames.FrameWriter(path)
    contents = [os.urandom(4000), b"", os.urandom(40)]
    for c in contents:
        writer.add(c)
    writer.close()
    raw = bytearray((tmp_path / "a.zst").read_bytes())
    reader = token_frames.FrameReader(path)
    assert [reader.frame(k) for k in (2, 0, 1)] == [contents[2], contents[0], contents[1]]
    raw[20] ^= 1
    (tmp_path / "a.zst").write_bytes(bytes(raw))
    reader = token_frames.FrameReader(path)
    assert reader.frame(2) == contents[2]
    with pytest.raises(Exception):
        reader.frame(0)


def test_other_zstandard_readers_accept_the_file(tmp_path):
    import io

    import zstandard

    writer = token_frames.FrameWriter(f"file://{tmp_path}/b.zst")
    writer.add(b"one")
    writer.add(b"two")
    writer.close()
    raw = (tmp_path / "b.zst").read_bytes()
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read() == b"onetwo"


def test_an_id_with_a_third_of_the_rows_is_split(spark, tmp_path):
    rows = [(7, f"the same id number {k}") for k in range(600)] + [(k, f"own {k}") for k in range(100, 1300)] + [(None, f"none {k}") for k in range(40)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, file string, part int").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = token_frames.write_documents(df, f"file://{tmp_path}/hot", PATH, 2, frame_ids=500)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = sorted(token_frames.read_documents(index).collect(), key=lambda r: r["start"])
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert keys == sorted(keys) and len(keys) == len(rows)
    assert index.where("doc_id = 7").select("file").distinct().count() > 1
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:], strict=False))
