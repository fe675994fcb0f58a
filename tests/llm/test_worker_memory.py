"""What the pipeline's workers and executors hold at once is bounded."""

import corpus_pipeline
import pyarrow as pa
import pytest

from cyclewise.llm import pieces


def _sizes(_path):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array([b.num_rows] * b.num_rows, pa.int64()), *[pa.nulls(b.num_rows, pa.string())] * 2], ["row", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


@pytest.mark.parametrize(("own", "most"), [(None, corpus_pipeline.BATCH_ROWS), ("1700", 1700)])
def test_stages_hand_few_texts_to_a_worker_at_once(spark, monkeypatch, own, most):
    monkeypatch.setattr(pieces, "_digest", _sizes)
    before = spark.conf.get(corpus_pipeline.ARROW_ROWS)
    try:
        spark.conf.set(corpus_pipeline.ARROW_ROWS, own or "10000")
        docs = spark.range(5000).selectExpr("id as doc_id", "'a text' as text").coalesce(1)
        assert max(r["n_tokens"] for r in corpus_pipeline.encode_pieces(spark, docs, "").collect()) == most
    finally:
        spark.conf.set(corpus_pipeline.ARROW_ROWS, before)


def test_words_are_forgotten_beyond_the_bound(monkeypatch):
    monkeypatch.setattr(pieces, "TEXT_BYTES", 1 << 10)
    monkeypatch.setattr(pieces, "CACHE_WORDS", 50)
    most, learn = [], pieces.Words.learn
    monkeypatch.setattr(pieces.Words, "learn", lambda self, m, words: (learn(self, m, words), most.append(len(self))))
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array([f"word{i} other{i}" for i in range(400)])], ["row", "text"])
    import public_tokenizers as P

    assert sum(b.num_rows for b in pieces._encode(P.path("piece_bpe_32k.model"))(iter([batch]))) == 400
    assert len(most) > 3 and max(most) < 200
