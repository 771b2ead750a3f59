"""The training-data operators on small tables with nulls, empty texts, ties, repeated rows and extra columns."""

import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickscope.llm import (chat_trees, interpolation, line_dedup, minhash_dedup, mixing, quality_rules, rp_forest,
                            sentencepiece_codec, toxicity, warc)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size int, words string"


def _sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    base = [_sentence(rng, 120) for _ in range(12)]
    out = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)]
    near = base[0].split()
    near[60] = "changed"
    out += [(100, base[0], "en", "s1"), (101, " ".join(near), "en", None), (102, base[0][:200], None, "s0")]
    line = _sentence(rng, 20)
    out += [(110, line + "\n" + base[1][:80] + "\n\nx", "fr", "s2"), (111, "own words here\n" + line[:-1] + "q", "fr", "s2")]
    out += [(120, None, "en", "s0"), (121, "", None, None), (122, "one", "en", "s0"), (None, "no id at all here", "en", "s1")]
    out += [out[3], out[3]]
    return [(i, t, lang, s, len(t) if t is not None else None, True, 1, "w") for i, t, lang, s in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(0, 1, 0), (0, 0, 1), (1, 1, 0), (2, None, None), (None, 1, 1)],
                                 "doc_id long, quality int, toxic int")


def test_quality_counts_and_base_verdict(spark, docs, labels, none):
    got = quality_rules.quality_verdicts(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        text = r["_in1"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(words), sum(map(len, words)), len(hit))
        assert r["base_failed"] == (len(words) < 10 or 100 * len(hit) > 20 * len(words))
    kept = quality_rules.quality_filter(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r["base_failed"] for r in got)
    assert quality_rules.quality_filter(none, labels).count() == 0


def test_quality_thresholds_guarantee(spark):
    """A rule that separates the classes is certified; one without enough labels is not."""
    def made(lang, n):
        return [(i, lang, False, 500 if i % 5 == 0 else 3, 0, 0, 0, 0) for i in range(n)]

    cols = "doc_id long, lang string, base_failed boolean, " + ", ".join(f"s_{r} int" for r in quality_rules.RULES)
    big = [(i, *r[1:]) for i, r in enumerate(made("en", 3000) + made("xx", 50))]
    features = spark.createDataFrame(big, cols)
    quality = spark.createDataFrame([(r[0], int(r[3] != 500)) for r in big], "doc_id long, quality int")
    cut = {r["stratum"]: r["cut_symbols"] for r in quality_rules.thresholds(features, quality, "lang", quality_rules.RiskParams()).collect()}
    assert cut == {"en": 500}


def test_binomial_bound(spark):
    from math import comb
    cases = [(k, n) for n in (10, 60, 400, 3000) for k in range(0, 12, 3) if k <= n]
    got = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality_rules.binomial_cdf(F.col("k"), F.col("n"), 0.01).alias("p")).collect()
    for r in got:
        want = sum(comb(r["n"], j) * 0.01 ** j * 0.99 ** (r["n"] - j) for j in range(r["k"] + 1))
        assert r["p"] == 1.0 if r["k"] > r["n"] * 0.01 else abs(r["p"] - want) < 1e-10


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_line_links_equal_brute_force(spark):
    rng = random.Random(5)
    lines = set()
    for _ in range(60):
        s = "".join(rng.choice("abé") for _ in range(rng.randint(8, 16)))
        lines.add(s)
        for _ in range(4):
            t = list(s)
            for _ in range(rng.randint(1, 4)):
                at = rng.randrange(len(t))
                t[at:at + 1] = rng.choice([[], [rng.choice("abé")], [t[at], rng.choice("abé")]])
            lines.add("".join(t))
    lines = sorted(x for x in lines if x)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "h1 long, line string")
    got = {(r["a"], r["b"]): r["distance"] for r in line_dedup.line_links(df, 2, 6).collect()}
    want = {(i, j): d for i, a in enumerate(lines) for j, b in enumerate(lines) if i < j and len(a) >= 6 and len(b) >= 6
            for d in [_distance(a, b)] if d <= 2}
    assert got == want


def test_line_dedup(spark, docs, rows, none):
    out = {r["doc_id"]: r for r in line_dedup.line_dedup(docs).collect()}
    assert out[100 - 100]["text"] == rows[0][1] and 100 not in out  # a copy keeps no line
    assert out[110]["text"].split("\n")[0] == rows[15][1].split("\n")[0]
    assert out[111]["text"] == "own words here" and out[111]["n_chars"] == 14  # the near line goes
    assert out[120]["text"] is None and out[121]["text"] == "" and None in out
    assert line_dedup.line_dedup(none).count() == 0


def test_near_dedup(spark, docs, rows, none):
    classes = {(r["doc_id"]): r["class_id"] for r in minhash_dedup.near_classes(docs).collect()}
    assert classes[100] == 0 and classes[101] == 0 and classes[102] == 102 and classes[120] == classes[121] == 120
    assert len(classes) == len({r[0] for r in rows})
    kept = sorted((r["doc_id"] for r in minhash_dedup.near_dedup(docs).collect()), key=str)
    assert kept == sorted({classes[r[0]] for r in rows}, key=str)
    assert minhash_dedup.near_dedup(none).count() == 0


def test_near_dedup_keeps_classes_that_share_an_id(spark):
    rng = random.Random(6)
    texts = [_sentence(rng, 40) for _ in range(5)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (7, texts[4]), (8, texts[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r["text"], r["doc_id"]) for r in minhash_dedup.near_dedup(docs).collect())
    assert kept == sorted(zip(texts, (None, None, None, 7, 7)))
    roots = {}
    for r in minhash_dedup.near_classes(docs).collect():
        roots.setdefault(r["root"], set()).add(r["f1"])
    assert len(roots) == 5 and all(len(x) == 1 for x in roots.values())


def test_consistent_samples_estimate_the_similarity():
    rng = np.random.default_rng(0)
    weights = np.ones(1 << minhash_dedup.FEATURE_BITS, np.float32)
    sampler, agree, true = minhash_dedup.Sampler(), [], []
    for _ in range(60):
        words = rng.integers(0, 1 << 60, 400).astype(np.uint64)
        other = words.copy()
        other[rng.choice(400, 6, replace=False)] += np.uint64(1)
        a, b = (minhash_dedup.weighted_set(w, weights) for w in (words, other))
        true.append(minhash_dedup.weighted_jaccard(a, b))
        agree.append((sampler.draw(*a)[1] == sampler.draw(*b)[1]).mean())
    assert abs(np.mean(agree) - np.mean(true)) < 0.03


def test_near_classes_hold_all_clear_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: r["class_id"] for r in minhash_dedup.near_classes(docs).collect()}
    sets = {}
    for r in docs.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        sets[r["doc_id"]] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            assert got[a] == got[b] or j < 0.85
    assert all(any(len(sets[a] & sets[b]) >= 0.7 * len(sets[a] | sets[b]) for b in ids if b != a) for a in ids if got[a] != a)


def test_near_classes_hold_pairs_at_the_bar_in_a_large_group(spark):
    """A third of all rows copy one text of 100 shingles; the near copies have a plain overlap of 89/111 = 0.802 with it."""
    rng = random.Random(8)
    base = _sentence(rng, 104).split()
    near = {1000 + at: base[:at] + [f"own{at}x{i}" for i in range(7)] + base[at + 7:] for at in range(4, 92, 2)}
    rows = [(i, " ".join(base)) for i in range(200)] + [(i, " ".join(w)) for i, w in near.items()]
    rows += [(2000 + i, _sentence(rng, 104)) for i in range(400)]
    got = {r["doc_id"]: r["class_id"] for r in minhash_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i] == 0 for i in near) >= 0.97 * len(near)
    assert all(got[2000 + i] == 2000 + i for i in range(400))


def test_sentencepiece_equals_the_library(spark, docs, none):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    rng = random.Random(2)
    texts = ["", "  ", " a  b ", "日本語🙂\xa0x", "aaa aaaa aaaaaaa", "\t\n x\n", "é́ﬁ<s></s>", "ab" * 50, "▁x▁", "x" * 5000]
    texts += ["".join(rng.choice("ab éétno in thé\n🙂") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    codec = sentencepiece_codec.Codec(sentencepiece_codec.MODEL)
    ids, bounds = codec.encode(texts)
    for i, t in enumerate(texts):
        own = ids[bounds[i]:bounds[i + 1]]
        assert own.tolist() == sp.encode(t) and codec.decode(own) == sp.decode(sp.encode(t))
    back = sentencepiece_codec.round_trip(docs).collect()
    assert len(back) == docs.count() and all(r["same"] for r in back)
    assert sentencepiece_codec.round_trip(none).count() == 0


def test_mixing(spark, docs, none):
    params = mixing.MixParams(block_words=16, shard_words=200)
    mixed = mixing.mix(docs, params)
    taken = mixing.taken_words(mixed).collect()
    assert len(taken) == docs.count() and all(r["taken"] <= 2 * r["size"] for r in taken)
    per = {}
    for r in taken:
        per.setdefault(r["target"], [0])[0] += r["taken"]
    goals = {r["target"] for r in mixed.sources.collect()}
    assert all(abs(per[t][0] - t) <= 16 for t in goals if t in per)
    again = mixing.taken_words(mixing.mix(docs, params)).collect()
    assert sorted(map(str, taken)) == sorted(map(str, again))
    out = mixing.mixed_documents(docs, params)
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in out.collect())
    assert out.columns == docs.columns and words == sum(r["taken"] for r in taken)
    assert mixing.mixed_documents(none).count() == 0


def test_mixed_shards_are_shuffled_runs(spark, docs):
    params = mixing.MixParams(block_words=16, shard_words=200)
    ids = docs.where("doc_id < 12").dropDuplicates(["doc_id"])
    text = {r["doc_id"]: r["text"].split() for r in ids.collect()}
    # every row of the mix is one stretch of its document
    out = [(r["doc_id"], r["text"].split()) for r in mixing.mixed_documents(ids, params).collect()]
    assert all(any(text[i][at:at + len(w)] == w for at in range(0, len(text[i]), 16)) for i, w in out)
    rows = mixing.mixed_shards(ids, params).collect()
    assert [(r["doc_id"], r["text"].split()) for r in rows] == out
    places = [(r["mix_shard"], r["mix_position"]) for r in rows]
    assert places == sorted(places) and len(set(places)) == len(places) and len({s for s, _ in places}) > 3
    first = [r["doc_id"] for r in rows if r["mix_shard"] == 0]
    assert first != sorted(first)
    per = {}
    for r in rows:
        assert text[r["doc_id"]][16 * r["mix_block"]:][:r["mix_words"]] == r["text"].split()
        per[r["mix_shard"]] = per.get(r["mix_shard"], 0) + r["mix_words"]
    drawn = mixing.mix(ids, params).draws.groupBy("shard").agg(F.sum("words").alias("n")).collect()
    assert per == {r["shard"]: r["n"] for r in drawn}


def test_targets_and_split():
    got = mixing.source_targets([("b", 100), ("a", 10), (None, 50)], mixing.MixParams())
    assert [g[0] for g in got] == ["a", "b", None] and abs(sum(g[2] for g in got) - 240) < 1e-9
    assert got[0][2] == 20 and all(t <= 2 * s for _, s, t in got)
    quota = np.array([700, 11, 300])
    whole = list(mixing.split_quotas(quota, 7, 0, 7, 1))
    assert np.array_equal(sum(c for _, _, c in whole), quota)
    assert all(np.array_equal(a[2], b[2]) for a, b in zip(whole[3:5], mixing.split_quotas(quota, 7, 3, 5, 1)))


def test_warc_salvage():
    def record(i, text):
        block = b"HTTP/1.1 200 OK\r\n\r\n" + text
        return (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Type: application/http; msgtype=response\r\n"
                b"WARC-Block-Digest: sha256:%s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
                % (i, hashlib.sha256(block).hexdigest().encode(), len(block), block))

    plain = [record(i, b"text %d WARC/1.1 \r\n" % i) for i in range(4)]
    broken = plain[1].replace(b"text 1", b"toxt 1")
    out = list(warc.salvage(plain[0] + broken + plain[2] + b"junk" + plain[3]))
    assert [k for k, *_ in out] == ["record", "gap", "record", "gap", "record"]
    assert out[1][1:3] == (len(plain[0]), len(plain[0]) + len(broken)) and out[3][2] - out[3][1] == 4
    members = [gzip.compress(p) for p in plain]
    members[1] = members[1][:20] + bytes(x ^ 255 for x in members[1][20:40]) + members[1][40:]
    got = [h["warc-record-id"] for k, _, _, h, _ in warc.salvage(b"".join(members)) if k == "record"]
    assert got == ["<urn:page:0>", "<urn:page:2>", "<urn:page:3>"]
    assert any(k == "gap" for k, *_ in warc.salvage(b"".join(members)))


def test_warc_salvage_of_written_archives(spark, tmp_path):
    """One flipped byte costs one record of an archive that write_archives made, wherever it lies."""
    pages = spark.range(100).selectExpr("id as page_id", "'u' as url", "concat(sha2(string(id), 512), sha2(string(-id), 512)) as html")
    warc.write_archives(pages.coalesce(1), str(tmp_path / "a"))
    files = [p.read_bytes() for p in (tmp_path / "a").glob("part-*")]
    data = max(files, key=len)
    whole = [h["warc-record-id"] for k, _, _, h, _ in warc.salvage(data) if k == "record"]
    assert len(whole) == 100 and gzip.decompress(data).count(b"WARC/1.1\r\n") == 100
    for at in range(len(data) // 2, len(data), len(data) // 17):
        bad = data[:at] + bytes([data[at] ^ 255]) + data[at + 1:]
        assert sum(k == "record" for k, *_ in warc.salvage(bad)) >= 99


def test_warc_salvage_inside_a_member():
    """Of one member with many records, all that precede the damaged byte are read."""
    rng = random.Random(9)
    records = []
    for i in range(100):
        block = b"HTTP/1.1 200 OK\r\n\r\n" + rng.randbytes(200).hex().encode()
        records.append(b"WARC/1.1\r\nWARC-Record-ID: <urn:page:%d>\r\nWARC-Block-Digest: sha256:%s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
                       % (i, hashlib.sha256(block).hexdigest().encode(), len(block), block))
    data = gzip.compress(b"".join(records))
    assert len(data) < (1 << 16)
    for share in (0.6, 0.75, 0.9):
        at = int(share * len(data))
        bad = data[:at] + bytes([data[at] ^ 255]) + data[at + 1:]
        read = zlib.decompressobj(31).decompress(data[:at])
        got = [h["warc-record-id"] for k, _, _, h, _ in warc.salvage(bad) if k == "record"]
        sure = read.count(b"WARC/1.1\r\n") - 1
        assert sure > 40 and got[:sure] == [f"<urn:page:{i}>" for i in range(sure)]


def test_warc_pages(spark):
    long = "é" * 80
    pages = spark.createDataFrame([(1, "u\r\nX: y", long, 1), (5, None, long, 1), (3, "u", "tiny", 1), (4, "u", "tiny", 1),
                                   (6, "u", None, 1), (None, "u", "\r\n\r\nWARC/1.1\r\n", 1), (9, "u", long, 1)],
                                  "page_id long, url string, html string, kind int")
    got = {r["page_id"]: r for r in warc.archive_pages(pages).collect()}
    assert {k: (r["record_type"], r["refers_to"]) for k, r in got.items()} == {
        1: ("response", None), 5: ("revisit", 1), 3: ("response", None), 4: ("response", None), 6: ("response", None),
        None: ("response", None), 9: ("revisit", 1)}
    assert got[5]["payload_bytes"] == 160 and got[6]["payload_digest"] == hashlib.sha256(b"").hexdigest()
    assert got[None]["payload"] == "\r\n\r\nWARC/1.1\r\n"
    assert warc.archive_pages(pages.where("page_id = 77")).count() == 0


def test_chat_branches_and_round_trip(spark):
    schema = "tree long, node long, parent long, role string, text string, score double"
    data = [(1, 1, None, "user", "q", 1.0), (1, 2, 1, "assistant", "</s>\n<s>", 0.2), (1, 3, 1, "assistant", "best\\<[", 0.9),
            (1, 4, 3, "us\ner", None, 0.9), (1, 5, 2, "user", "x", 0.1), (2, 9, 7, "assistant", "orphan", None),
            (3, 1, 2, "user", "cycle", 1.0), (3, 2, 1, "user", "cycle", 1.0)]
    out = chat_trees.format_paths(spark.createDataFrame(data, schema))
    got = {r["tree"]: r for r in out.select(
        "tree", "leaf", chat_trees.read_back(F.col("formatted")).alias("turns"),
        chat_trees.loss_text(F.col("formatted"), F.col("loss")).alias("lost")).collect()}
    assert set(got) == {1, 2} and got[1]["leaf"] == 4
    assert [tuple(t) for t in got[1]["turns"]] == [("user", "q"), ("assistant", "best\\<["), ("us\ner", "")]
    assert got[1]["lost"] == "best\\<[" and got[2]["lost"] == "orphan"


def test_forest_recall_and_special_vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[700:1000] = x[700]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [None] * 16), (5080, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = rp_forest.nearest(table, table.where("vec_id % 20 = 0")).toPandas()
    dots = x.astype(float) @ x.astype(float).T
    hit = 0
    for q, part in got.groupby("query_id"):
        other = np.delete(np.arange(1500), q)
        want = other[np.lexsort((other, -dots[q, other]))][:20]
        hit += len(set(want) & set(part["vec_id"]))
        assert sorted(part["rank"]) == list(range(1, 21)) and part["vec_id"].max() < 5000
    assert hit >= 0.9 * 20 * got["query_id"].nunique() and got["query_id"].nunique() == 75
    assert rp_forest.nearest(table.where("vec_id < 0"), table).count() == 0


def test_interpolation_scores(spark, docs, rows, none):
    got = interpolation.score_documents(docs).toPandas()
    assert len(got) == len(rows) and (got["score"] < 0).all()
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 1]
    assert got["held_out"].sum() == len(held)
    train = [interpolation.tokens(r[1]) for r in rows if zlib.crc32(str(r[0]).encode()) % 5 != 1]
    assert (got["train_tokens"] == sum(map(len, train))).all()
    assert got[~got["held_out"]]["score"].sum() > got[~got["held_out"]]["base_score"].sum()
    assert interpolation.score_documents(none).count() == 0


def test_toxicity_learns_words_and_stems(spark, none):
    rng = random.Random(7)
    rows, marks = [], []
    for i in range(1200):
        words = _sentence(rng, rng.randint(5, 150)).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["zzot", "qqxqq" + _sentence(rng, 1)])
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    rows += [(9000, None), (9001, "")]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(docs, marks).join(marks, "doc_id", "left").toPandas()
    test = got[got["held_out"] & got["toxic"].notna()]
    assert (test["predicted"] == test["toxic"]).mean() > 0.85 and got["score"].between(0, 1).all() and len(got) == len(rows)
    constant = toxicity.score_documents(docs, marks.where("toxic = 0")).select("score").distinct().collect()
    assert [r[0] for r in constant] == [0.0]
    assert toxicity.score_documents(docs.where("doc_id < 0"), marks).count() == 0


def test_pipeline_stages_keep_the_columns(spark, docs, tmp_path):
    import corpus_pipeline
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    part, names = base, base.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        part = minhash_dedup.settle(stage(spark, part, "/root/testdata/sf0.001"), f"test-{name}")
        assert part.columns == names and part.count() > 0
    last = corpus_pipeline.STAGES[4][1](spark, part, "/root/testdata/sf0.001")
    assert last.where("not same").count() == 0 and last.count() == part.count()
