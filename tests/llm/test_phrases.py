"""Phrases: mining, exact counts and scores against counting by hand, small slices, special rows."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from clickscope.llm import phrases as P

SCHEMA = "doc_id long, text string, lang string, f long, shard string, phrase string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield [w for w in re.split(r"[\x20\x09]+", piece) if w]


def _by_hand(rows, support=10, longest=3, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for w in _pieces(text):
            n["und" if lang is None else lang] += len(w)
            for m in range(1, longest + 1):
                f["und" if lang is None else lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        found = []
        for phrase, a in c.items():
            if a < support or len(phrase) < 2:
                continue
            if any(len(x) > len(phrase) and b >= support and 100 * b >= 50 * a and any(x[i:i + len(phrase)] == phrase for i in range(len(x)))
                   for x, b in c.items()):
                continue
            score, k = min((1000000 * a * a // (c[phrase[:k]] * c[phrase[k:]]), k) for k in range(1, len(phrase)))
            found.append((-score, -a, " ".join(phrase).encode(), c[phrase[:k]], c[phrase[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, n[lang], -s) for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["Ab", "b", "cc", "dé", "É", "x-y", "1", "hot", "the", "𝒳"]

    def text(n):
        return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "! "]) for _ in range(n))

    out = [(text(rng.randint(0, 60)), rng.choice(["en", "de", None, ""])) for _ in range(80)]
    out += [(None, "en"), ("", "en"), (" \t.,", "fr"), ("new york city " * 40, "en"), ("new york city " * 40, "en"), ("w" * 3000 + " of state", "de")]
    return out + [("one word", None), ("hot the " * 3000, "es")]


def _table(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "s", "p") for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(5)


@pytest.mark.parametrize("params", [P.PhraseParams(), P.PhraseParams(slice_bytes=64), P.PhraseParams(shards=5, support=4, largest_filter=1 << 13),
                                    P.PhraseParams(shards=1, longest=4), P.PhraseParams(longest=2, top=3)])
def test_collocations_equal_counting_by_hand(spark, rows, params):
    got = P.collocations(_table(spark, rows), params)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == _by_hand(rows, params.support, params.longest, params.top)


def test_empty_tables_and_texts(spark):
    assert P.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert P.collocations(_table(spark, [(None, None), ("", "en"), (". , ;", "en")])).collect() == []


@pytest.mark.parametrize("limit", [1, 7, 40, 10_000])
def test_slices_hold_every_phrase_once(rows, limit):
    batch = pa.RecordBatch.from_arrays([pa.array([t or "" for t, _ in rows]), pa.array([lang or "und" for _, lang in rows]),
                                        pa.array([0] * len(rows), pa.int8())], names=["text", "lang", "shard"])
    for size in (1, 2, 3):
        got = Counter()
        for part in P.slices(batch.slice(3), size - 1, limit):
            words = part.words.to_pylist()
            for i in part.grams(size):
                got[tuple(words[part.word_of[c]] for c in part.code[i:i + size])] += 1
        want = Counter(tuple(w[i:i + size]) for t, _ in rows[3:] for w in _pieces(t) for i in range(len(w) - size + 1))
        assert got == want


def test_local_support_loses_nothing(spark, rows):
    """A phrase just at the support, dealt to the shards as evenly as can be, is found."""
    docs = [(f"rare pair {i}", "en") for i in range(10)]
    got = P.phrase_counts(_table(spark, docs)).where("size = 2").collect()
    assert [(r["phrase"], r["f"]) for r in got] == [("rare pair", 10)]


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_000_001
    counts = spark.createDataFrame([("en", 2, "a b", big), ("en", 1, "a", big + 1), ("en", 1, "b", big)], "lang string, size int, phrase string, f long")
    assert P.score_phrases(counts).collect()[0]["score"] == 1000000 * big * big // ((big + 1) * big) == 999999
