"""Line links where very many lines share their pieces."""

import os
import random

import pytest
from pyspark.sql import functions as F

from clickscope.llm import line_dedup


def _crowd(rng, alphabet, n, words):
    """n lines that differ from one another in whole words, and lines one to three characters from some of them."""
    word = lambda: "".join(rng.choice(alphabet) for _ in range(rng.randint(4, 7)))
    base, lines = [word() for _ in range(words)], set()
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(1, 3)):
            own[rng.randrange(words)] = word()
        lines.add(" ".join(own))
    for x in rng.sample(sorted(lines), n // 3):
        for _ in range(rng.randint(1, 3)):
            at = rng.choice([0, len(x) - 1, rng.randrange(len(x))])
            x = x[:at] + rng.choice(["", rng.choice(alphabet), x[at] + rng.choice(alphabet)]) + x[at + 1:]
        lines.add(x)
    return sorted(lines)


@pytest.mark.parametrize("max_edits, alphabet", [(2, "abcdefghijklmnopqrst"), (1, "äbc🙂défg漢hijk"), (3, "abcdefghijklmnopqrst")])
def test_crowded_lines_keep_every_link_and_are_not_all_paired(spark, monkeypatch, max_edits, alphabet):
    made, settle = {}, line_dedup.settle

    def counted(df, name, **options):
        out = settle(df, name, **options)
        made[name] = out.count()
        return out

    monkeypatch.setattr(line_dedup, "settle", counted)
    lines = _crowd(random.Random(max_edits), alphabet, 240, 30)
    df = spark.createDataFrame(list(enumerate(lines)), "h1 long, line string")
    links = line_dedup.line_links(df, max_edits, 40)
    got = {(r["a"], r["b"], r["distance"]) for r in links.collect()}
    a, b = df.select(F.col("h1").alias("a"), F.col("line").alias("x")), df.select(F.col("h1").alias("b"), F.col("line").alias("y"))
    near = a.join(b, F.col("a") < F.col("b")).withColumn("distance", F.levenshtein("x", "y"))
    want = {(r["a"], r["b"], r["distance"]) for r in near.where(F.col("distance") <= max_edits).collect()}
    assert got == want and len(want) > 30
    if max_edits <= 2:
        assert made["line-pairs"] < len(lines) ** 2 / 8


def test_line_dedup_leaves_only_the_marks_behind(spark):
    from clickscope.runtime import checkpoint_root
    tables = lambda: {p.split("-", 1)[1].rsplit("-", 1)[0] for p in set(os.listdir(root)) - before}
    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    lines = _crowd(random.Random(1), "abcdefghijklmnop", 60, 20)
    out = line_dedup.line_dedup(spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string"))
    assert tables() <= {"line-marks", "components"} and "line-marks" in tables()
    assert 0 < out.count() < len(lines)


@pytest.mark.parametrize("max_edits", [1, 2])
def test_ends_agree_for_all_pairs_within_reach(spark, max_edits):
    rng = random.Random(5)
    rows = []
    for _ in range(400):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 12)))
        rows.append((a, "".join(rng.choice("ab") for _ in range(rng.randint(0, 12)))))
    for _ in range(400):
        a = b = "".join(rng.choice("abé🙂") for _ in range(rng.randint(1, 70)))
        for _ in range(rng.randint(1, 3)):
            at = rng.randrange(len(b) + 1)
            b = b[:at] + rng.choice(["", "a", "🙂"]) + b[at + rng.randint(0, 1):]
        rows.append((a, b))
    df = spark.createDataFrame(rows, "a string, b string").where("a <> b")
    out = df.select(line_dedup._ends_agree(F.col("a"), F.col("b"), max_edits).alias("ends"), (F.levenshtein("a", "b") <= max_edits).alias("near"),
                    line_dedup._bags_agree(line_dedup._bags(F.col("a")), line_dedup._bags(F.col("b")), max_edits).alias("bags")).collect()
    assert all(r["ends"] == r["near"] and (r["bags"] or not r["near"]) for r in out) and any(r["near"] for r in out)


def test_a_pair_of_every_kind_is_found_whatever_the_length(spark, monkeypatch):
    rng = random.Random(8)
    lines = set()
    for length in [*range(40, 60), 127, 128, 500]:
        base = "".join(rng.choice("abcdefgh ") for _ in range(length))
        lines.add(base)
        for _ in range(12):
            x = base
            for _ in range(2):
                at = rng.randrange(len(x) + 1)
                x = x[:at] + rng.choice(["", "x", "y"]) + x[at + rng.randint(0, 1):]
            lines.add(x)
    lines = sorted(x for x in lines if len(x) >= 40)
    df = spark.createDataFrame(list(enumerate(lines)), "h1 long, line string")
    for few in (0, 16):
        monkeypatch.setattr(line_dedup, "FEW", few)
        got = {(r["a"], r["b"]) for r in line_dedup.line_links(df).collect()}
        a, b = df.select(F.col("h1").alias("a"), F.col("line").alias("x")), df.select(F.col("h1").alias("b"), F.col("line").alias("y"))
        want = a.join(b, (F.col("a") < F.col("b")) & (F.levenshtein("x", "y") <= 2))
        assert got == {(r["a"], r["b"]) for r in want.collect()}


def _links_and_brute_force(spark, lines, max_edits=2):
    df = spark.createDataFrame(list(enumerate(lines)), "h1 long, line string")
    got = {(r["a"], r["b"]) for r in line_dedup.line_links(df, max_edits).collect()}
    a, b = df.select(F.col("h1").alias("a"), F.col("line").alias("x")), df.select(F.col("h1").alias("b"), F.col("line").alias("y"))
    return got, {(r["a"], r["b"]) for r in a.join(b, (F.col("a") < F.col("b")) & (F.levenshtein("x", "y") <= max_edits)).collect()}


def test_finer_keys_take_the_place_of_crowded_ones_alone(spark, monkeypatch):
    """Lines that share their first third alone: 9 finer keys for each of their two nominal lengths, however many lines."""
    made, settle = [], line_dedup.settle

    def counted(df, name, **options):
        out = settle(df, name, **options)
        if name == "line-keys":
            made.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "settle", counted)
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefghijkl ") for _ in range(n))
    start = text(40)
    for n in (60, 120):
        made.clear()
        lines = [start + text(56) for _ in range(n - 10)]
        lines += [x[:at] + "XY"[: 1 + at % 2] + x[at + 1 + at % 2:] for x, at in zip(lines, range(41, 91, 5))]
        got, want = _links_and_brute_force(spark, lines)
        assert got == want and len(want) >= 10
        # beside them, the planted pairs may share other keys, yet never more than FEW lines
        assert made == [n * 2 * 4, n * 2 * 9]


@pytest.mark.parametrize("max_edits, few", [(1, 2), (2, 1), (2, 3)])
def test_no_link_is_lost_where_some_keys_are_crowded_and_others_not(spark, monkeypatch, max_edits, few):
    monkeypatch.setattr(line_dedup, "FEW", few)
    rng = random.Random(few)
    lines = set()
    for length in (40, 43, 47, 48, 61, 96, 97):
        base = "".join(rng.choice("abé🙂cd ") for _ in range(length))
        for most in (1, 1, 2, 2, 2, 3, 6):
            for low, high in ((0, 0.3), (0.3, 0.7), (0.6, 1), (0, 1)):
                x = base
                for _ in range(most):
                    at = int(len(x) * rng.uniform(low, high))
                    x = x[:at] + rng.choice(["", "x", "a", "yz"]) + x[at + rng.randint(0, 1):]
                lines.add(x)
    got, want = _links_and_brute_force(spark, sorted(x for x in lines if len(x) >= 40), max_edits)
    assert got == want and len(want) > 20
