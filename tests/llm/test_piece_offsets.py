"""Encoding against the library's own ids, offsets and texts."""

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2

from tidemark.llm import piece_offsets

PATH = public_tokenizers.path("piece_bpe_32k.model")
CASES = ["", " ", "a", "  a  b ", "Hello world", "x ▁ y▁▁z", "naïve café ßß", "日本語 text 🙂🙂", "\x00\n\t\r x", "▁", "a" * 3000,
         " " * 40 + "z", "�", "é", "</s> <s> <0x41> [INST]"]


@pytest.fixture(scope="module")
def ours():
    with open(PATH, "rb") as f:
        return piece_offsets.Model(f.read())


@pytest.fixture(scope="module")
def theirs():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def check(ours, theirs, text):
    ids, starts, ends = ours.encode(text)
    assert ids.tolist() == theirs.encode(text)
    assert ours.decode(np.append(ids, np.int32(ours.end))) == theirs.decode([*ids.tolist(), 2])
    raw = text.encode()
    # Spans follow each other and cover the text.
    assert starts[:1].tolist() in ([0], []) and ends[-1:].tolist() in ([len(raw)], [])
    assert (starts[1:] == ends[:-1]).all() and (ends >= starts).all()
    for i, a, b in zip(ids.tolist(), starts, ends, strict=True):
        if ours.kind[i] == 1 and a > 0:
            assert raw[a:b].replace("▁".encode(), b" ") == ours.surface[i]


@pytest.mark.parametrize("text", CASES)
def test_same_as_library(ours, theirs, text):
    check(ours, theirs, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁ab.\n"), st.characters(codec="utf-8")), max_size=60))
def test_same_as_library_on_random_texts(ours, theirs, text):
    check(ours, theirs, text)


@pytest.mark.parametrize("ids", [[300, 3, 200, 258, 5, 400], [230], [], [2, 2], [259, 259, 300], [229, 133, 131]])
def test_decodes_any_ids(ours, theirs, ids):
    assert ours.decode(np.array(ids, np.int32)) == theirs.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("squeeze", [True, False])
def test_character_map(rule, squeeze):
    """Normal form and places against the library's normaliser with the same compiled map."""
    made = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, remove_extra_whitespaces=squeeze)
    made_proto = sentencepiece_model_pb2.ModelProto.FromString(made.serialized_model_proto())
    with open(PATH, "rb") as f:
        proto = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    proto.normalizer_spec.precompiled_charsmap = made_proto.normalizer_spec.precompiled_charsmap
    proto.normalizer_spec.remove_extra_whitespaces = squeeze
    raw = proto.SerializeToString()
    ours, theirs = piece_offsets.Model(raw), sentencepiece.SentencePieceProcessor(model_proto=raw)
    for text in [*CASES, "ﬁ ﬂ Ⅷ ㌔  ｶﾞ ＡＢ　Ｃ", "  Å½  x  ", "ÀÉ ß"]:
        ids, starts, ends = ours.encode(text)
        assert ids.tolist() == theirs.encode(text), text
        assert (ends >= starts).all() and (np.diff(starts) >= 0).all()
        if len(ids):
            assert ends[-1] <= len(text.encode())


def test_tables(spark):
    rows = [(1, "a b", 9), (2, None, 9), (2, "", 8), (None, "Größe", 7), (1, "a b", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = piece_offsets.decode(piece_offsets.encode(df, PATH), PATH).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "", r["decoded"]) for r in got) == sorted(
        (a or 0, t or "", t or "") for a, t, _ in rows)
    assert [len(r["ids"]) for r in piece_offsets.encode(df.where("text is null"), PATH).collect()] == [1]
    assert piece_offsets.encode(df.limit(0), PATH).count() == 0
    both = piece_offsets.encode(df, PATH, decoded="back")
    assert both.columns == ["doc_id", "text", "ids", "starts", "ends", "back"]
    assert sorted(r["back"] for r in both.collect()) == sorted(t or "" for _, t, _ in rows)


def test_new_segments_of_a_text_are_merged_by_one_call(ours, theirs, monkeypatch):
    calls, merge = [], ours.merger.encode
    monkeypatch.setattr(ours, "merger", type("Merger", (), {
        "encode": staticmethod(lambda given, **options: calls.append(given) or merge(given, **options))}))
    monkeypatch.setattr(piece_offsets, "CACHE", 50)
    ours.forget()
    texts = [" ".join(f"w{k * n}q" for n in range(40)) for k in range(1, 6)]
    for text in [*texts, " ".join(texts), *texts]:
        calls.clear()
        check(ours, theirs, text)
        assert len(calls) <= 1
    ours.forget()
