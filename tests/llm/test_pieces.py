import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from ledgerline.llm import pieces

from .helpers import docs, words

FILE = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  ", "a  b", "   x", "\n\n", "日本𠀋\u0000x", "<s>hi</s>", "a" * 300, " " * 70 + "b", "x" * 5 + " " * 33,
    "Ünïcödé — “quotes” 日本語のテキストは長いです" * 3, "http://ex.com/a?b=c&d=%20", "\t\tif(x){return 1;}\n" * 3, "ab\u0301c", "👍🏽 ok", "²... 3.14 don't",
    "Donaudampfschifffahrtsgesellschaftskapitänsmütze" * 4, " ".join(words(400, 5)),
]


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The same pieces taken as a unigram model: scores set by rule, nothing trained."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(FILE, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for i, p in enumerate(m.pieces):
        if p.type == 1:
            p.score = -float(np.log(i + 10)) - (i % 97) / 1000
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(m.SerializeToString())
    return str(path)


def check(file, texts):
    lib, model = sentencepiece.SentencePieceProcessor(model_file=file), pieces.Model(file)
    got = pieces.Encoder(model).texts(texts)
    for t, ids in zip(texts, got):
        ids = np.frombuffer(ids, "<i4")
        assert ids.tolist() == lib.encode(t), t[:60]
        assert pieces.decode_ids(model, ids) == lib.decode(ids.tolist())


def test_bpe_ids_equal_the_library():
    check(FILE, TEXTS)


def test_unigram_ids_equal_the_library(unigram):
    check(unigram, [t for t in TEXTS if t != " " * 70 + "b"])


def test_bpe_ids_equal_the_library_on_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    check(FILE, [r["text"] for r in rows])


def test_frames_keep_columns_and_round_trip(spark):
    model = pieces.load(spark, FILE)
    rows = docs(spark, [(1, None), (2, ""), (3, "the end"), (3, "the end"), (None, " lead\n"), (5, "ab " * 40000)]).withColumn("ids", F.lit(1)).withColumn("decoded", F.lit(2))
    got = pieces.decode(pieces.encode(rows, model), model).collect()
    assert len(got) == 6 and all(r["decoded"] == r["text"] for r in got)
    assert [r["ids"] for r in got if r["doc_id"] == 1] == [None] and [r["ids"] for r in got if r["doc_id"] == 2] == [[]]
    assert pieces.encode(rows.limit(0), model).collect() == []


def test_query_round_trips_every_text(spark):
    got = pieces.op3_pieces(spark, "/root/testdata/sf0.001")
    assert got.count() == 200 and got.where(~F.col("round_trip")).count() == 0


def test_a_worker_keeps_one_encoder(spark):
    """Two loads of one model share it; another operator's task lets go of it."""
    import sys
    import types

    from ledgerline.llm import shared

    first, second = pieces.load(spark, FILE), pieces.load(spark, FILE)
    assert first.key == second.key
    encoder = first.encoder()
    assert second.encoder() is encoder
    state = sys.modules["_ledgerline_kept"].__dict__
    assert [k for k, v in state.items() if isinstance(v, pieces.Encoder)] == ["value"]
    shared.kept(("other",), lambda: 1)
    assert state["value"] == 1
    shared.release()
    assert state["value"] is None and isinstance(sys.modules["_ledgerline_kept"], types.ModuleType)


def test_memo_is_bounded_in_bytes(monkeypatch):
    encoder = pieces.Encoder(pieces.Model(FILE))
    monkeypatch.setattr(pieces, "MEMO_BYTES", 20_000)
    lib = sentencepiece.SentencePieceProcessor(model_file=FILE)
    for k in range(6):
        text = " ".join(f"word{k}x{i}" for i in range(200)) + " " + "q" * 5_000
        assert np.frombuffer(encoder.texts([text])[0], "<i4").tolist() == lib.encode(text)
        assert len(encoder) < 500
