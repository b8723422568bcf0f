import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrylog.llm import piece_codec
from ferrylog.llm.queries import TOKENIZERS


@pytest.fixture(scope="module")
def model():
    return piece_codec.read_model(f"{TOKENIZERS}/piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec(model):
    return piece_codec.Codec(model)


@pytest.fixture(scope="module")
def unigram(model):
    """The same pieces and scores as a unigram model, for the library; scores of a billion exceed its floats."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        piece.score = max(piece.score, -40000.0)
    return proto.SerializeToString()


def brute(codec, text):
    """The best sum over all segmentations, longest last piece first among equals."""
    score = {p: (s, i) for i, (p, s, kind) in enumerate(codec.pieces) if kind == piece_codec.NORMAL}
    spelled = codec.normalised(text)
    best = [(0.0, [])]
    for end in range(1, len(spelled) + 1):
        found = None
        for start in range(max(0, end - 16), end):
            piece = spelled[start:end]
            if piece in score:
                ids, value = [score[piece][1]], score[piece][0]
            elif len(piece) == 1:
                ids, value = [codec.bytes[b] for b in piece.encode()], codec.penalty
            else:
                continue
            value += best[start][0]
            if found is None or value > found[0]:
                found = (value, best[start][1] + ids)
        best.append(found)
    return best[-1][1]


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet="the ing\n éß▁.", max_size=40)))
def test_best_segmentation_and_round_trip(codec, text):
    ids = codec.encode(text)
    assert ids == brute(codec, text)
    assert codec.decode(ids) == text.replace("▁", " ")


def test_ids_are_those_of_the_library_for_a_unigram_model(unigram, spark):
    import sentencepiece
    from conftest import DATA

    library, own = sentencepiece.SentencePieceProcessor(model_proto=unigram), piece_codec.Codec(unigram)
    texts = [r.text for r in spark.read.parquet(str(DATA / "sf0.001" / "documents.parquet")).collect()]
    for text in random.Random(1).sample(texts, 60):
        assert own.encode(text) == library.encode(text)
        assert own.decode(own.encode(text)) == library.decode(own.encode(text)) == text


def test_rows_of_all_kinds(docs, model, codec):
    rows = [(1, None), (2, ""), (3, " a"), (4, "x" * 50_000), (5, "一二三😀"), (5, "一二三😀"), (None, "tab\there"), (6, "  b  ")]
    got = piece_codec.encode(docs(rows), model)
    found = {(r.doc_id, r.n_pieces, r.round_trip, tuple(r.ids)) for r in got.collect()}
    assert found == {(i, len(codec.encode(t)), True, tuple(codec.encode(t))) for i, t in rows}
    back = piece_codec.decode(got, model).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    assert piece_codec.encode(docs([]), model).count() == 0
    with pytest.raises(ValueError):
        codec.decode([40_000])


def test_merge_models_get_the_ids_of_their_own_tokenizer(docs, model, spark):
    import sentencepiece
    from conftest import DATA

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    given = spark.read.parquet(str(DATA / "sf0.001" / "documents.parquet")).collect()
    texts = [r.text for r in random.Random(2).sample(given, 60)]
    texts += ["tab\there", "that and", "一二三😀", "a" * 3000, "  b \n c", "ab▁▁c ▁d", ""]
    got = piece_codec.encode(docs(list(enumerate(texts))), model, as_trained=True)
    assert {r.doc_id: list(r.ids) for r in got.collect()} == {i: library.encode(t) for i, t in enumerate(texts)}


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet="the ing\n éß▁.", max_size=40)))
def test_merges_are_those_of_the_library(model, text):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    own = piece_codec.codec(model, True)
    if "\0" not in text:
        assert own.encode(text) == library.encode(text)


@pytest.mark.parametrize("drop_bytes", [False, True])
def test_merges_with_pieces_of_users_and_unused_ones(model, drop_bytes):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    proto.trainer_spec.byte_fallback = not drop_bytes
    for piece in proto.pieces:
        if drop_bytes and piece.type == piece_codec.BYTE:
            piece.type = piece_codec.NORMAL
        if piece.piece in ("he", "▁th"):
            piece.type = piece_codec.UNUSED
        if piece.piece == "ing":
            piece.type = piece_codec.USER
    changed = proto.SerializeToString()
    library, own = sentencepiece.SentencePieceProcessor(model_proto=changed), piece_codec.codec(changed, True)
    for text in ("the thing sings other", "heathen", "ingest 😀😀 ſ he", "\U0001f9ff\U0001f9ff ok"):
        assert own.encode(text) == library.encode(text)


def replay(own, text):
    """Merging step by step over the whole stretch, the rule itself."""
    return [i for part in own.merged(text) for i in own._named(part)]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="▁theingsandrou", max_size=60), st.text(alphabet="ab", max_size=60)))
def test_the_pass_over_the_automaton_gives_what_merging_leaves(model, text):
    own = piece_codec.codec(model, True)
    assert own.search(text) == replay(own, text)


def test_merges_on_whole_documents(model, spark):
    """Every document of the small table, and every stretch of it, by the automaton and by the library."""
    import sentencepiece
    from conftest import DATA

    library, own = sentencepiece.SentencePieceProcessor(model_proto=model), piece_codec.MergeCodec(model)
    texts = [r.text for r in spark.read.parquet(str(DATA / "sf0.01" / "documents.parquet")).collect()]
    for text in texts:
        assert own.encode(text) == library.encode(text or "")
    stretches = {x for text in texts for x in own.cut(own.normalised(text or ""))}
    assert all(own.search(x) == replay(own, x) for x in stretches if len(x) <= 60)


@pytest.mark.parametrize("kind", [1, 2])
def test_models_that_map_characters(model, unigram, kind):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto, rules = sentencepiece_model_pb2.ModelProto(), sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(unigram if kind == 1 else model)
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    proto.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
    changed = proto.SerializeToString()
    library = sentencepiece.SentencePieceProcessor(model_proto=changed)
    own = piece_codec.codec(changed, True)
    for text in ("plain words", "ﬁne Ⅷ ｆｕｌｌ", " two  spaces ", "tab\there", "№ 5 ½", ""):
        assert own.encode(text) == library.encode(text)


def test_stretches_met_again_and_again_are_searched_once(model, monkeypatch):
    """The table lets go of what was not met lately, not of everything, and the ids stay those of the library."""
    import sentencepiece

    monkeypatch.setattr(piece_codec, "KEPT_STRETCHES", 40)
    monkeypatch.setattr(piece_codec, "KEPT_PAIRS", 50)
    library, own = sentencepiece.SentencePieceProcessor(model_proto=model), piece_codec.MergeCodec(model)
    searched, search = [], own.kept.search
    own.kept.search = lambda stretch: searched.append(stretch) or search(stretch)
    r = random.Random(3)
    for i in range(60):
        text = " ".join(["the same words"] + ["".join(r.choices("theingsando", k=9)) for _ in range(10)]) + "\n"
        assert own.encode(text) == library.encode(text)
        assert own.decode(own.encode(text)) == text
        assert len(own.kept) + len(own.kept.older) <= 40
    assert searched.count("▁words") == 1


def test_decoding_of_bytes_and_pieces_side_by_side(model, codec):
    """Line feeds are bytes of their own; a byte that begins a character ends at them."""
    for text in ("a\nb\n\n", "\n", "ß\n一\n", "tab\there", "▁\n"):
        assert codec.decode(codec.encode(text)) == text.replace("▁", " ")
    feed, lead = codec.bytes[0x0A], codec.bytes[0xE4]
    assert codec.decode([feed, lead, feed]) == "\n�\n"
    with pytest.raises(ValueError):
        codec.decode([-1])
