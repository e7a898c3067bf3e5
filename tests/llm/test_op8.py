import re

import numpy as np
import pytest

from tidelog.llm import op8_sentencepiece as op

TEXTS = ["", None, "  Hello  world\n\tx <s> é🦄 ", "a", " ", "   ", "x▁y", "naïve Straße año 日本語 ゼ 梦", "the the of and " * 300,
         "nospace" * 20_000, "\x00\x7f￿", "▁▁ lead", "trailing   "]


@pytest.fixture(scope="module")
def model(tmp_path_factory):
    """A model file with the public pieces and their scores, of the library's unigram kind; the few scores
    of -1e9 are brought near the others, because the library adds them in 32 bits."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(op.model_path(), "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    for p in proto.pieces:
        p.score = max(p.score, -40_000.0)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    return str(path)


def test_trie_finds_exactly_its_keys():
    keys = [(w.encode(), i) for i, w in enumerate(["a", "ab", "abc", "b", "é", "éa", "\x00", "ÿz"])]
    t = op.Trie(keys)

    def look(word):
        s = 0
        for c in word:
            n = t.base[s] + c + 1
            if t.check[n] != s or n == 0:
                return -1
            s = n
        return t.value[s]

    for k, i in keys:
        assert look(k) == i
    assert look(b"ac") == -1 and look(b"bb") == -1 and look(b"\xc3") == -1


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_ids_and_text_equal_the_library(spark, model, sf):
    import sentencepiece

    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    pairs = [(r.doc_id, r.text) for r in rows] + list(enumerate(TEXTS, 10_000)) + [(None, "no id"), (10_002, TEXTS[2])]
    df = spark.createDataFrame([(i, t, "clash") for i, t in pairs], "doc_id long, text string, ids string")
    got = op.decode(op.encode(df, model, cache_size=50), model).collect()
    assert len(got) == len(pairs)
    lib, text_of = sentencepiece.SentencePieceProcessor(model_file=model), dict(pairs)
    for r in got:
        t = text_of[r.doc_id] or ""
        assert r.ids == lib.encode(t), (r.doc_id, t)
        assert r.decoded == lib.decode(r.ids)
        assert r.decoded == t.replace("▁", " ")


def test_score_is_the_best_path():
    model = op.load(op.model_path())
    codec = op.Codec(model)
    piece = {p: i for i, p in enumerate(model.surfaces)}

    def brute(part):
        """Best sum over all ways to cut a short part."""
        best = {0: 0.0}
        for j in range(1, len(part) + 1):
            ways = [best[i] + (model.scores[piece[part[i:j].encode()]] if part[i:j].encode() in piece
                               and piece[part[i:j].encode()] not in model.byte_ids else -np.inf if j - i > 1 else model.unknown_score) for i in range(j)]
            best[j] = max(ways)
        return best[len(part)]

    for text in ["hello", "antion", "thereof", "xqzj", "日xq"]:
        ids = codec.encode(text)
        assert codec.score(ids) == brute(" " + text)


def test_query_and_empty_table(spark):
    df = op.summary(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"))
    got = {r.doc_id: r for r in df.collect()}
    assert [i for i in got if not got[i].round_trip] == [i for i, t in enumerate(TEXTS) if "▁" in (t or "")]
    assert got[0].n_tokens == 0 and got[2].n_byte_tokens == 6
    assert op.summary(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_parts_are_encoded_side_by_side(monkeypatch):
    """Distinct short parts do not take a Viterbi run of Python's own each; pieces are those of such runs."""
    import random

    model, draw = op.load(op.model_path()), random.Random(8)
    signs = [*"abehint\n▁é日🦄\x00\x7f", "the", "ing", "\U0010ffff"]
    words = list({"".join(draw.choices(signs, k=draw.randint(1, 14))).replace("▁", "") for _ in range(5_000)} - {""})
    texts = [None, "", " ", *(" ".join(words[i:i + 9]) + "  " * (i % 2) for i in range(0, len(words), 9)), "▁ ▁the▁"]

    def alone(text):
        norm = "▁" + text.replace(" ", "▁") if text else ""
        return [i for p in re.findall("▁+[^▁]*|[^▁]+", norm) for i in model.viterbi(p.encode())]

    expected = [alone(t) for t in texts]
    one_by_one, viterbi = [], model.viterbi
    monkeypatch.setattr(model, "viterbi", lambda part: one_by_one.append(part) or viterbi(part))
    for size in (op.CACHE_SIZE, 50):
        codec = op.Codec(model, size)
        assert [ids.tolist() for ids in codec.encode_all(texts)] == expected
        assert len(codec.cache) <= size and len(one_by_one) < len(words) / 50
    lone = ["ab" * 400, "日本" * 300, "the" * 5_000]
    assert [ids.tolist() for ids in op.Codec(model).encode_all(lone)] == [alone(t) for t in lone]


def test_tables_agree_on_every_first_byte():
    assert [op.WIDTH[chr(c).encode()[0]] for c in (0, 0x7F, 0x80, 0x7FF, 0x800, 0xFFFF, 0x10000, 0x10FFFF)] == [1, 1, 2, 2, 3, 3, 4, 4]
    assert op.WIDTH.size == 256 and not op.WIDTH[0x80:0xC2].any() and not op.WIDTH[0xF5:].any() and op.WIDTH[op.PAD] == 0


def test_only_encoding_keeps_parts(monkeypatch):
    codec = op.Codec(op.load(op.model_path()))
    monkeypatch.setitem(op._codecs, -1, codec)
    codec.encode("some words to keep")
    assert len(codec.cache) == 4
    op._without_parts()
    assert not codec.cache and codec.decode(codec.encode("and words")) == "and words"
