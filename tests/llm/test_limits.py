"""Long texts in parts, small tables, columns whose names clash with inner ones."""

import random

import numpy as np
import pytest

from clickscope.llm import line_dedup, minhash_dedup, mixing, queries, rp_forest, sentencepiece_codec


@pytest.mark.parametrize("limit", [1, 7, 50, 10_000])
def test_texts_cut_into_parts_encode_as_the_library_does(monkeypatch, limit):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    monkeypatch.setattr(sentencepiece_codec, "BATCH_CHARS", limit)
    rng = random.Random(limit)
    texts = ["".join(rng.choice(["ab", "the", "é", "\n", "🙂", " ", " ", "  ", "▁", "naïve"]) for _ in range(rng.randint(0, 200))) for _ in range(40)]
    texts += ["", " ", "a ", " a", "word" * 300, "one two  three   four "]
    codec = sentencepiece_codec.Codec(sentencepiece_codec.MODEL)
    ids, bounds = codec.encode([None, *texts])
    assert bounds[1] == 0
    for i, t in enumerate(texts, 1):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == sp.encode(t), t
    for t in texts:
        parts = list(sentencepiece_codec.parts_of(t))
        assert " ".join(parts) == t and (limit < 10_000 or len(parts) == 1)


@pytest.mark.parametrize("n", [1, 3, 10, 21, 60])
def test_small_tables_give_all_candidates(spark, n):
    x = np.random.default_rng(n).normal(size=(n, 8)).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = rp_forest.nearest(table, table).toPandas()
    dots = x.astype(float) @ x.astype(float).T
    for q in range(n):
        other = np.delete(np.arange(n), q)
        part = got[got.query_id == q].sort_values("rank")
        assert len(part) == min(20, n - 1) and q not in set(part.vec_id)
        if n <= 21:
            assert part.vec_id.tolist() == other[np.lexsort((other, -dots[q, other]))].tolist()


CLASH = ("doc_id long, text string, source string, n_chars long, some int, gone int, _left int, _k1 int, _k2 int, _a1 int, _in1 int, size int, "
         "mix_shard int, mix_position int, mix_pass int, mix_block int, mix_words int, k1 int, copy int")


def _clashing(spark):
    rng = random.Random(3)
    text = [" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60)) for _ in range(4)]
    rows = [(i, t, "s", len(t or "")) for i, t in enumerate([text[0], text[1], text[0] + "\n" + text[2], text[3], text[3], None, ""])]
    return spark.createDataFrame([(*r, *range(100, 115)) for r in rows], CLASH)


@pytest.mark.parametrize("stage", [line_dedup.line_dedup, minhash_dedup.near_dedup, mixing.mixed_documents])
def test_columns_with_inner_names_travel_along(spark, stage):
    docs = _clashing(spark)
    out = stage(docs)
    rows = out.collect()
    assert out.columns == docs.columns and rows
    assert all(tuple(r)[4:] == tuple(range(100, 115)) for r in rows)
    assert all(r["n_chars"] == len(r["text"]) for r in rows if r["text"])


def test_mixed_shards_replaces_columns_of_its_own_names(spark):
    out = mixing.mixed_shards(_clashing(spark))
    assert out.columns[-5:] == mixing.MIX and len(set(out.columns)) == len(out.columns)
    assert {r["mix_shard"] for r in out.collect()} == {0}


def test_op10_returns_one_row_per_document(spark):
    out = queries.op10_source_mixing(spark, "/root/testdata/sf0.001")
    rows = out.collect()
    assert out.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    goals = {(r["target"], r["source_size"]) for r in rows}
    assert abs(sum(r["taken"] for r in rows) - sum(t for t, _ in goals)) <= 256 * len(goals)
