"""Phrases that stand together more often than their parts: SON partitioning over the documents of a table.

Mining. Documents are dealt to `shards` shards by a hash; a shard is a set of documents, not a task, and its counting
is spread like any other aggregate. A phrase that occurs `support` times must reach ceil(support / shards) in some
shard. Every shard is mined completely at that support, level by level: a phrase of m words is looked up only where
both of its parts of m - 1 words reached the local support in its shard. Tasks count inside slices of text and shuffle
(hash, count); a hash held by two phrases adds their counts, which can only let more through.
Union. The hashes that some shard let through go into one bit table per level (16 bits a hash, at most
`largest_filter` bits: beyond that more phrases pass, none is lost).
Counting. Another pass counts every phrase that the table lets through, by its text, over all documents; this is exact,
and what is below `support` goes. Parts of a phrase occur at least as often as it does, so they are counted too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscope.llm.common import settle

LANG = "und"
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
SHARD_BITS = 4
STRETCH = 200_000  # rows that one task ranks, about


@dataclass(frozen=True)
class PhraseParams:
    """support: least occurrences of a phrase. shards: at most 16. longest: words of the longest phrase.
    covered: share in percent of a phrase's occurrences that lie in one longer phrase and make it drop out.
    slice_bytes: text that a task holds as arrays at once. largest_filter: bits of a level's table."""

    support: int = 10
    shards: int = 3
    longest: int = 3
    covered: int = 50
    top: int = 2000
    slice_bytes: int = 1 << 22
    largest_filter: int = 1 << 30


_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(PIECE_ENDS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Slice:
    """Words of a stretch of text. code: number of (lang, word); run: number of the piece, never falling;
    shard: of the document; fresh: the first word that no slice before held."""

    code: np.ndarray
    run: np.ndarray
    shard: np.ndarray
    fresh: int
    langs: list[str]
    words: pa.Array
    lang_of: np.ndarray
    word_of: np.ndarray

    def grams(self, size: int) -> np.ndarray:
        """First words of the phrases of `size` words that end in a fresh word."""
        n = len(self.code) - size + 1
        at = np.arange(max(0, self.fresh - size + 1), max(n, 0))
        return at[self.run[at] == self.run[at + size - 1]]

    def hashes(self) -> np.ndarray:
        """A hash of every (lang, word) number."""
        word = pd.util.hash_array(self.words.to_numpy(zero_copy_only=False), categorize=False)
        lang = pd.util.hash_array(np.array(self.langs, object), categorize=False)
        return _mix(word[self.word_of] + _mix(lang)[self.lang_of])


def slices(batch: pa.RecordBatch, overlap: int, limit: int) -> Iterator[Slice]:
    """The words of a batch (text, lang, shard), cut at word ends into stretches of about `limit` bytes; each but the
    first of a text starts `overlap` words early."""
    text = batch.column("text").cast(pa.large_string())
    lang = batch.column("lang").dictionary_encode()
    shard = batch.column("shard").to_numpy()
    ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = text.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    langs, lang_code = lang.dictionary.to_pylist(), lang.indices.to_numpy()
    start, stop = int(ends[0]), int(ends[-1])
    begin, fresh_from = start, start
    while fresh_from < stop:
        end = min(stop, fresh_from + limit)
        while end < stop and not _KIND[data[end]] and ends[np.searchsorted(ends, end)] != end:
            end += 1
        part = _LOWER[data[begin:end]]
        kind = _KIND[part]
        inside = kind == 0
        first_row = int(np.searchsorted(ends, begin, "right")) - 1
        rows = ends[first_row + 1:np.searchsorted(ends, end)] - begin  # where the next rows start
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        opens[rows] |= inside[rows]
        closes[rows - 1] |= inside[rows - 1]
        a, b = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        if len(a):
            cuts = (kind == 2).astype(np.int32)
            np.add.at(cuts, rows, 1)
            run = np.cumsum(cuts, out=cuts)[a]
            of_row = first_row + np.searchsorted(rows, a, "right")
            lengths = np.concatenate([[0], np.cumsum(b - a)])
            strings = pa.Array.from_buffers(pa.large_string(), len(a), [None, pa.py_buffer(lengths.astype(np.int64)),
                                                                       pa.py_buffer(np.ascontiguousarray(part[inside]))])
            coded = strings.dictionary_encode()
            word, tongue = coded.indices.to_numpy().astype(np.int64), lang_code[of_row].astype(np.int64)
            both, code = np.unique(tongue * len(coded.dictionary) + word, return_inverse=True)
            yield Slice(code, run, shard[of_row], int(np.searchsorted(a, fresh_from - begin)), langs, coded.dictionary,
                        both // len(coded.dictionary), both % len(coded.dictionary))
            begin = begin + int(a[max(0, len(a) - overlap)]) if overlap else end
        fresh_from = end
        if not len(a):
            begin = end


def _keys(part: Slice, at: np.ndarray, size: int, word_hash: np.ndarray, sharded: bool) -> np.ndarray:
    """Phrase hashes; sharded ones hold the shard in their lowest bits instead of hash bits."""
    key = np.zeros(len(at), np.uint64)
    for i in range(size):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + word_hash[part.code[at + i]])
    key &= ~np.uint64((1 << SHARD_BITS) - 1)
    return key | part.shard[at].astype(np.uint64) if sharded else key


def _holds(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether both bits of a key are set; every key that was put in is held."""
    places = np.uint64(8 * len(table) - 1)
    found = np.ones(len(keys), bool)
    for turn in (keys, _mix(keys)):
        place = (turn ^ (turn >> np.uint64(32))) & places
        found &= (table[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def _filter_table(keys: DataFrame, bits: int) -> np.ndarray:
    """The bit table of a column of keys: tasks set bits in pages of 32 KB, Spark joins equal pages by OR."""
    page = min(bits, 1 << 18)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            key = batch.column(0).to_numpy().view(np.uint64)
            for turn in (key, _mix(key)):
                place = np.sort(((turn ^ (turn >> np.uint64(32))) & np.uint64(bits - 1)).astype(np.int64))
                for number in np.unique(place // page).tolist():
                    lo, hi = np.searchsorted(place, [number * page, (number + 1) * page])
                    some = held.setdefault(number, np.zeros(page, bool))
                    some[place[lo:hi] - number * page] = True
        for number, some in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()),
                                              pa.array([np.packbits(some, bitorder="little").tobytes()])], names=["page", "bits"])

    def joined(part: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(page // 8, np.uint8)
        for b in part["bits"]:
            out |= np.frombuffer(b, np.uint8)
        return pd.DataFrame({"page": part["page"].iloc[:1], "bits": [out.tobytes()]})

    pages = keys.mapInArrow(places, "page long, bits binary").groupBy("page").applyInPandas(joined, "page long, bits binary")
    table = np.zeros(bits // 8, np.uint8)
    for r in pages.collect():  # at most `bits` bits in all
        table[r["page"] * page // 8:(r["page"] + 1) * page // 8] = np.frombuffer(r["bits"], np.uint8)
    return table


def _bits(count: int, largest: int) -> int:
    return min(largest, 1 << max(13, (16 * count - 1).bit_length()))


def _counted(rows: DataFrame, size: int, table, p: PhraseParams) -> DataFrame:
    """key, count of the phrases of `size` words of every shard; those with a part that `table` lacks are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None if table is None else table.value
        for batch in batches:
            for part in slices(batch, size - 1, p.slice_bytes):
                word_hash, at = part.hashes(), part.grams(size)
                if held is not None and len(at):
                    start = np.unique(np.concatenate([at, at + 1]))
                    good = np.zeros(len(part.code) + 1, bool)
                    good[start[_holds(held, _keys(part, start, size - 1, word_hash, True))]] = True
                    at = at[good[at] & good[at + 1]]
                key, count = np.unique(_keys(part, at, size, word_hash, True), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(count.astype(np.int64))], names=["key", "count"])

    return rows.mapInArrow(run, "key long, count long").groupBy("key").agg(F.sum("count").alias("count"))


def _mined(rows: DataFrame, p: PhraseParams) -> np.ndarray:
    """The bit table of all phrases (without shard) that some shard let through, of every size."""
    context, local = rows.sparkSession.sparkContext, -(-p.support // p.shards)
    shard_bits = (1 << SHARD_BITS) - 1
    table, levels = None, []
    for size in range(1, p.longest + 1):
        level = settle(_counted(rows, size, table, p).where(F.col("count") >= local).select("key"), f"phrases-{size}")
        if size < p.longest:
            table = context.broadcast(_filter_table(level, _bits(level.count(), p.largest_filter)))
        levels.append(level)
    union = levels[0]
    for level in levels[1:]:
        union = union.unionByName(level)
    union = union.select(F.col("key").bitwiseAND(F.lit(~shard_bits)).alias("key"))
    return _filter_table(union, _bits(sum(level.count() for level in levels), p.largest_filter))


def phrase_counts(docs: DataFrame, params: PhraseParams = PhraseParams(), text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, size, phrase, f: exact counts of all phrases of 1 to `longest` words that occur `support` times, and per
    language a row of size 0 with a null phrase that counts all words."""
    p = params
    if not 1 <= p.shards <= 1 << SHARD_BITS:
        raise ValueError("1 to 16 shards")
    rows = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), F.coalesce(F.col(f"`{lang}`"), F.lit(LANG)).alias("lang"))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("text", "lang"), F.lit(p.shards)).cast("byte"))
    candidates = rows.sparkSession.sparkContext.broadcast(_mined(rows, p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = candidates.value
        for batch in batches:
            for part in slices(batch, p.longest - 1, p.slice_bytes):
                word_hash, tongue = part.hashes(), pa.array(part.langs, pa.string())
                fresh = np.bincount(part.lang_of[part.code[part.fresh:]], minlength=len(part.langs))
                seen = np.flatnonzero(fresh)
                yield pa.RecordBatch.from_arrays(
                    [tongue.take(pa.array(seen)), pa.array(np.zeros(len(seen), np.int32)), pa.nulls(len(seen), pa.string()),
                     pa.array(fresh[seen].astype(np.int64))], names=["lang", "size", "phrase", "f"])
                number = None
                for size in range(1, p.longest + 1):
                    at = part.grams(size)
                    at = at[_holds(held, _keys(part, at, size, word_hash, False))]
                    # equal words, equal number: exact, no hash
                    number = part.code[at]
                    for i in range(1, size):
                        number = np.unique(number, return_inverse=True)[1] * np.int64(len(part.word_of)) + part.code[at + i]
                    _, one, count = np.unique(number, return_index=True, return_counts=True)
                    one = at[one]
                    said = [part.words.take(pa.array(part.word_of[part.code[one + i]])).cast(pa.string()) for i in range(size)]
                    phrase = said[0] if size == 1 else pc.binary_join_element_wise(*said, " ")
                    yield pa.RecordBatch.from_arrays(
                        [tongue.take(pa.array(part.lang_of[part.code[one]])), pa.array(np.full(len(one), size, np.int32)), phrase,
                         pa.array(count.astype(np.int64))], names=["lang", "size", "phrase", "f"])

    counted = rows.mapInArrow(run, "lang string, size int, phrase string, f long")
    return (counted.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
            .where((F.col("size") == 0) | (F.col("f") >= p.support)))


def _words(phrase: Column, first: Column | int, count: Column | int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, count), " ")


def score_phrases(counts: DataFrame, params: PhraseParams = PhraseParams()) -> DataFrame:
    """lang, phrase, a, l, r, score of every candidate that no longer one covers. counts: as phrase_counts() gives."""
    whole = counts.where("size >= 2").select("lang", "size", "phrase", F.col("f").alias("a"))
    parts = counts.where(f"size between 1 and {params.longest - 1}").select("lang", "phrase", "f")
    cuts = whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = (cuts.withColumn("_left", _words(F.col("phrase"), F.lit(1), F.col("k")))
            .withColumn("_right", _words(F.col("phrase"), F.col("k") + 1, F.col("size") - F.col("k"))))
    left = parts.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "_left"]).join(right, ["lang", "_right"])
    # 10^6 a^2 stays below 10^38 up to a = 10^16
    score = F.expr("cast((cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)))"
                   " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0))) as long)")
    best = (cuts.withColumn("score", score).groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("b")).select("lang", "phrase", "a", "b.l", "b.r", "b.score"))
    inner = whole.where("size >= 3").select(
        "lang", F.col("a").alias("b"), F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(
            F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: _words(F.col("phrase"), i, m))))).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("b").alias("b"))
    return (best.join(longer, ["lang", "phrase"], "left")
            .where(F.coalesce(F.lit(100) * F.col("b") < F.lit(params.covered) * F.col("a"), F.lit(True))).drop("b"))


def collocations(docs: DataFrame, params: PhraseParams = PhraseParams()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of every language by score, a and phrase.

    docs: text, lang; other columns are not read. Null texts are empty, a null language is `und`; empty texts and
    tables give nothing; repeated rows count as often as they stand. Equal cuts go to the shorter first part, equal
    scores and counts to the phrase that is first in UTF-8.
    """
    counts = settle(phrase_counts(docs, params), "phrases-counts")
    scored = settle(score_phrases(counts, params), "phrases-scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of every stretch of rows first, so that no task sorts a whole language
    near = Window.partitionBy("lang", "_part").orderBy(*order)
    some = scored.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(1 + scored.count() // STRETCH)))
    some = some.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= params.top).drop("rank", "_part")
    total = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= params.top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
