"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every document is cut into blocks of at most `block_words` words. A source's target (in words) becomes an
exact block quota: whole passes over the source plus, for the rest, the first blocks of a pseudo-random
permutation whose words come nearest the target. A binary tree over the output shards splits the quota
vector of all sources: at each node the left half draws its share from a multivariate hypergeometric
distribution, so every shard is a uniform sample of the mix while the totals stay exact. Tree nodes are
seeded by their position, so any task can walk down to its own shards. The shares of a source are
consecutive ranges of its permuted blocks, hence disjoint. Inside a shard rows are ordered by a seeded hash.
A row is a run of adjacent blocks of a document that one pass put in one shard: blocks that are not adjacent
are never joined, so a long document is several rows.

Blocks are numbered with per-bucket counts and local ranks (a bucket is a 1/1024 slice of a source), so a
source that holds most rows is spread over many tasks. Only one row per source reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickscope.llm.common import broadcast_if_small, hidden, once, row_key, settle, words_of

WEIGHTS = (5, 2, 1)  # repeating, by code point of the source's name, null last
BUCKETS = 1024


@dataclass(frozen=True)
class MixParams:
    share: float = 1.5  # words of the mix over words of the input
    most: float = 2.0  # of a source's own size
    block_words: int = 256
    shard_words: int = 4_000_000
    seed: int = 11


def source_targets(sizes: list[tuple[str | None, int]], params: MixParams) -> list[tuple[str | None, int, float]]:
    """(source, size, target): targets in proportion to weight, stopped at `most` times the size; what a
    stopped source leaves is shared again by weight among the others until none is above."""
    ordered = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {i: WEIGHTS[i % len(WEIGHTS)] for i in range(len(ordered))}
    left = params.share * sum(s for _, s in ordered)
    target = dict.fromkeys(weight, 0.0)
    free = set(weight)
    while free:
        total = sum(weight[i] for i in sorted(free))
        over = {i for i in free if left * weight[i] / total > params.most * ordered[i][1]}
        if not over:
            target |= {i: left * weight[i] / total for i in free}
            break
        target |= {i: params.most * ordered[i][1] for i in over}
        left -= sum(target[i] for i in sorted(over))
        free -= over
    return [(name, size, target[i]) for i, (name, size) in enumerate(ordered)]


def sized(docs: DataFrame) -> DataFrame:
    """docs (hidden), with doc_id, source, text, size (words of the text, null: 0) and the row's key k1, k2."""
    return once(docs.select(*hidden(docs), "doc_id", "source", "text",
                            *[c.alias(n) for c, n in zip(row_key(docs), ("k1", "k2"))]),
                size=F.size(words_of(F.col("text"))).cast("long"))


def _copies():
    return F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)


def _blocks(numbers: DataFrame, params: MixParams) -> DataFrame:
    """One row per block: source, k1, k2, copy, block, words, slot (place in the source's permutation).

    `copy` tells repeated rows apart. slot orders a source's blocks by a seeded hash.
    """
    b = params.block_words
    rows = numbers.select("source", "k1", "k2", "size", F.explode(_copies()).alias("copy"))
    exploded = rows.where("size > 0").select(
        "source", "k1", "k2", "copy", "size",
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(size - 1) div {b}"))).alias("block"))
    return exploded.select(
        "source", "k1", "k2", "copy", "block", F.least(F.lit(b).cast("long"), F.col("size") - F.col("block") * b).alias("words"),
        F.xxhash64(F.lit(params.seed), "k1", "k2", "copy", "block").alias("slot"))


def _ranked(blocks: DataFrame) -> DataFrame:
    """Add, per source, `rank` (from 0) and `before` (words of the blocks ranked lower) in slot order."""
    bucket = F.shiftrightunsigned("slot", 54).cast("int")  # 1024 ranges of the unsigned hash
    cut = blocks.withColumn("bucket", bucket)
    totals = cut.groupBy("source", "bucket").agg(F.count("*").alias("n"), F.sum("words").alias("w"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(totals.select("source", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rank0"),
                                   F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("before0")), "mix-offsets")
    offsets = broadcast_if_small(offsets.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"), "rank0", "before0"))
    order = [F.col("slot"), F.col("k1"), F.col("k2"), F.col("copy"), F.col("block")]
    within = Window.partitionBy("source", "bucket").orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumns({"r": F.row_number().over(within) - 1, "w": F.coalesce(F.sum("words").over(upto), F.lit(0))})
    return (local.join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b")))
            .withColumns({"rank": F.col("rank0") + F.col("r"), "before": F.col("before0") + F.col("w")})
            .drop("_s", "_b", "rank0", "before0", "r", "w", "bucket"))


def split_quotas(quotas: np.ndarray, shards: int, first: int, last: int, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, start, count) of shards first..last-1: walk the splitting tree, skipping foreign branches.

    start is the number of a source's blocks in all shards to the left.
    """
    def walk(lo: int, hi: int, vector: np.ndarray, start: np.ndarray):
        if hi <= first or lo >= last:
            return
        if hi - lo == 1:
            yield lo, start, vector
            return
        mid = (lo + hi) // 2
        total = int(vector.sum())
        rng = np.random.default_rng([seed, lo, hi])
        left = _draw(rng, vector, total * (mid - lo) // (hi - lo))
        yield from walk(lo, mid, left, start)
        yield from walk(mid, hi, vector - left, start + left)

    yield from walk(0, shards, quotas.astype(np.int64), np.zeros(len(quotas), np.int64))


def _draw(rng: np.random.Generator, vector: np.ndarray, n: int) -> np.ndarray:
    """Multivariate hypergeometric by successive marginals, for populations beyond numpy's own limit too."""
    out, rest = np.zeros_like(vector), int(vector.sum())
    for i, have in enumerate(vector.tolist()):
        other = rest - have
        if n <= 0:
            break
        if other == 0:
            got = n
        elif max(have, other) < 10 ** 9:
            got = int(rng.hypergeometric(have, other, n))
        else:  # the normal limit; at this size its error is far below one part in a million
            mean = n * have / rest
            sd = (mean * (other / rest) * ((rest - n) / max(rest - 1, 1))) ** 0.5
            got = int(round(rng.normal(mean, sd)))
        out[i] = min(have, max(got, n - other))
        n -= int(out[i])
        rest = other
    return out


@dataclass(frozen=True)
class Mix:
    """rows: documents with their key and size. sources: source, source_size, target. numbers: doc_id,
    source, k1, k2, size, copies. draws: source, k1, k2, copy, block, words, pass, shard."""

    rows: DataFrame
    sources: DataFrame
    numbers: DataFrame
    draws: DataFrame


def mix(docs: DataFrame, params: MixParams = MixParams()) -> Mix:
    """Plan and draw the mix.

    An empty table, or one without words, draws nothing. A null source is a source of its own. Repeated
    rows are documents of their own (`copy`). Other columns of docs only travel along.
    """
    spark = docs.sparkSession
    rows = sized(docs)
    numbers = settle(rows.groupBy("doc_id", "source", "k1", "k2", "size").agg(F.count("*").alias("copies")), "mix-sizes")
    per = numbers.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("n")).collect()
    targets = source_targets([(r["source"], r["n"]) for r in per], params)
    sources = spark.createDataFrame(targets, "source string, source_size long, target double")
    ranked = settle(_ranked(_blocks(numbers, params)), "mix-blocks")
    counts = ranked.groupBy("source").agg(F.count("*").alias("n_blocks"))
    goal = broadcast_if_small(sources.join(counts, sources["source"].eqNullSafe(counts["source"]))
                       .select(sources["source"].alias("_s"), "source_size", "target", "n_blocks"))
    # whole passes, then the blocks whose middle lies before the rest of the target
    full = F.floor(F.col("target") / F.col("source_size")).cast("int")
    rest = F.col("target") - full * F.col("source_size")
    drawn = (ranked.join(goal, F.col("source").eqNullSafe(F.col("_s")))
             .withColumn("passes", full + (F.col("before") + F.col("words") / 2 <= rest).cast("int"))
             .where("passes > 0"))
    quota = {r["source"]: (r["n"], r["w"]) for r in drawn.groupBy("source").agg(
        F.sum("passes").alias("n"), F.sum(F.col("passes") * F.col("words")).alias("w")).collect()}
    shards = max(1, -(-sum(w for _, w in quota.values()) // params.shard_words))
    names = [s for s, _, _ in targets if s in quota]
    ranges = _shard_ranges(spark, names, np.array([quota[s][0] for s in names], np.int64), shards, params.seed)
    # a source's stream of draws: all its blocks in permuted order, then all again, then the last part
    number = F.expr("explode(transform(sequence(0, passes - 1), p -> struct(p as pass, p * n_blocks + rank as number)))")
    stream = drawn.select("source", "k1", "k2", "copy", "block", "words", number.alias("draw")).select(
        "source", "k1", "k2", "copy", "block", "words", "draw.pass", "draw.number")
    return Mix(rows, sources, numbers, _in_shards(stream, ranges))


CELL = 1024


def _shard_ranges(spark, names: list, vector: np.ndarray, shards: int, seed: int) -> DataFrame:
    """source, shard, start, stop: the draws of each source that each shard holds; 64 shards a task."""
    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in batch.column(0).to_pylist():
                for shard, start, count in split_quotas(vector, shards, lo, min(lo + 64, shards), seed):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names, pa.string()), pa.array([shard] * len(names), pa.int64()),
                         pa.array(start), pa.array(start + count)], names=["source", "shard", "start", "stop"])

    return (spark.range(0, shards, 64).mapInArrow(leaves, "source string, shard long, start long, stop long")
            .where("stop > start"))


def _in_shards(stream: DataFrame, ranges: DataFrame) -> DataFrame:
    """Give every draw its shard: an equality join on cells of 1024 draws, then the exact range."""
    cells = settle(ranges.select(F.col("source").alias("_s"), "shard", "start", "stop",
                                 F.explode(F.expr(f"sequence(start div {CELL}, (stop - 1) div {CELL})")).alias("_cell")), "mix-ranges")
    return (stream.withColumn("cell", F.expr(f"number div {CELL}"))
            .join(broadcast_if_small(cells), F.col("source").eqNullSafe(F.col("_s")) & (F.col("cell") == F.col("_cell")))
            .where("number >= start and number < stop")
            .drop("_s", "_cell", "cell", "start", "stop", "number"))


def taken_words(mixed: Mix) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, shards (that hold a part of it)."""
    per = mixed.draws.groupBy("k1", "k2", "copy").agg(F.sum("words").alias("taken"), F.countDistinct("shard").alias("shards"))
    each = mixed.numbers.withColumn("copy", F.explode(_copies()))
    goal = broadcast_if_small(mixed.sources.withColumnRenamed("source", "_s"))
    return (each.join(per, ["k1", "k2", "copy"], "left")
            .join(goal, F.col("source").eqNullSafe(F.col("_s")), "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                    F.coalesce("shards", F.lit(0)).cast("long").alias("shards")))


MIX = ["mix_shard", "mix_position", "mix_pass", "mix_block", "mix_words"]


def _mixed_rows(docs: DataFrame, params: MixParams) -> DataFrame:
    """The rows of the mix in order: the columns of docs as hidden() names them, and the MIX columns."""
    b = params.block_words
    mixed = mix(docs, params)
    key = ["k1", "k2", "copy", "pass", "shard"]
    ordered = Window.partitionBy(*key).orderBy("block")
    runs = (mixed.draws.withColumn("run", F.col("block") - F.row_number().over(ordered)).groupBy(*key, "run")
            .agg(F.min("block").alias("mix_block"), F.count("*").alias("_n"), F.sum("words").alias("mix_words"))
            .select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("copy").alias("_copy"), F.col("pass").alias("mix_pass"),
                    F.col("shard").alias("mix_shard"), "mix_block", "mix_words", "_n",
                    F.xxhash64(F.lit(params.seed), "shard", *key[:4], "mix_block").alias("mix_position")))
    parts = runs.groupBy("_k1", "_k2").agg(F.collect_list(F.struct(
        "mix_shard", "mix_position", "mix_pass", "mix_block", "mix_words", "_n")).alias("_runs"))
    texts = mixed.rows.dropDuplicates(["k1", "k2"]).join(
        parts, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")))
    whole = F.col("mix_words") == F.col("size")
    # words with the white space that follows them; a leading space belongs to no block
    pieces = F.filter(F.split(F.regexp_replace("text", r"^[\x20\x09-\x0D]+", ""), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])"), lambda w: w != "")
    # a text is split once, whatever the number of its rows
    split = once(texts, _pieces=F.when(F.exists("_runs", lambda r: r["mix_words"] < F.col("size")), pieces))
    cut = once(split.select("*", F.inline("_runs")).drop("_runs"),
               _text=F.when(whole, F.col("text")).otherwise(F.array_join(F.slice(
                   F.col("_pieces"), (F.col("mix_block") * b + 1).cast("int"), (F.col("_n") * b).cast("int")), "")))
    columns = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        own = F.col(f"_in{docs.columns.index('n_chars')}")
        columns["n_chars"] = F.when(whole, own).otherwise(F.length("_text").cast(docs.schema["n_chars"].dataType))
    out = [columns.get(c, F.col(f"_in{i}")).alias(f"_in{i}") for i, c in enumerate(docs.columns)]
    return (cut.select(*out, *MIX).repartitionByRange("mix_shard", "mix_position")
            .sortWithinPartitions("mix_shard", "mix_position"))


def mixed_shards(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """The mix by shard: the columns of `docs`, with the row's text, and mix_shard, mix_position (its seeded
    place in the shard), mix_pass, mix_block (its first block) and mix_words; columns of docs with these names are
    replaced. Tables without words, null and empty texts give no row; repeated rows are documents of their own.

    Rows are sorted by shard and position, partition after partition: a shard is one stretch of rows, which
    may span partitions. A row that holds a whole document keeps the text as it is; else the text is its
    blocks with the spaces that follow their words. n_chars, if present, is counted anew where text was left out.
    """
    rows = _mixed_rows(docs, params)
    return rows.select(*[F.col(f"_in{i}").alias(c) for i, c in enumerate(docs.columns) if c not in MIX], *MIX)


def mixed_documents(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """The rows of mixed_shards, in its order, with the columns of `docs` alone."""
    return _mixed_rows(docs, params).select(*[F.col(f"_in{i}").alias(c) for i, c in enumerate(docs.columns)])
