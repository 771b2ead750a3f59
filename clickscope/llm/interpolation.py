"""Language-model scores by deleted interpolation of word bigrams, unigrams and a uniform floor.

    P(w | v) = a[b] * c(v, w) / c(v) + (1 - a[b]) * P1(w),  P1(w) = g * c(w) / N + (1 - g) / (V + 1)

v is the word before (a begin mark first), b the bucket of the context's frequency c(v) (powers of two). The
mixture weights a[b] and g are learned by expectation-maximisation on held-out counts: every training token
is left out of the counts that predict it (c - 1), which uses all training data and needs no second corpus.

Counts are exact and distributed. Documents are packed into blocks (one row, at most BLOCK_CHARS characters)
that are written once. A block asks for the counts of its distinct words, then of its distinct bigrams:
requests are sorted 64-bit keys, delta-coded and compressed, dealt to buckets by hash, so a frequent word is
one key per block and no bucket is hot. The answers come back per block in the order of its own keys. The
EM statistics are a histogram over (context bucket, log ratio of the two estimates), a fixed number of rows.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import settle

BLOCK_CHARS = 12_000_000
BUCKET_KEYS = 2_000_000  # requests that one bucket holds, about
LEVELS = 24  # context buckets: floor(log2(c)) up to 23
STEP = 0.02  # of the log ratio in the EM histogram
REACH = 1500  # bins on either side
END = "\n"  # no word holds a line end
_SPLIT = re.compile(r"[\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def tokens(text: str | None) -> list[str]:
    """Words with A-Z in lower case, then the end token."""
    words = [w for w in _SPLIT.split((text or "").translate(_LOWER)) if w]
    return [*words, END]


def _pack(keys: np.ndarray, *more: np.ndarray) -> bytes:
    """Sorted keys as deltas, and arrays beside them."""
    delta = np.diff(keys, prepend=np.uint64(0))
    planes = delta.view(np.uint8).reshape(-1, 8).T if len(keys) else np.empty((8, 0), np.uint8)
    body = b"".join([np.int64(len(keys)).tobytes(), planes.tobytes(), *[np.ascontiguousarray(m).tobytes() for m in more]])
    return zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(body, np.int64, 1)[0])
    planes = np.frombuffer(body, np.uint8, 8 * n, 8).reshape(8, n)
    out, at = [np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)], 8 + 8 * n
    for kind in kinds:
        out.append(np.frombuffer(body, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Block:
    """The documents of one row, as word numbers into its sorted distinct words."""

    def __init__(self, row):
        self.words, = _unpack(row["words"])
        body = zstandard.ZstdDecompressor().decompress(row["stream"])
        self.word = np.frombuffer(body, np.int32).astype(np.int64)  # of every token
        self.sizes = np.asarray(row["sizes"], np.int64)
        self.train = np.repeat(np.asarray(row["train"], bool), self.sizes)
        first = np.zeros(len(self.word), bool)
        first[np.cumsum(self.sizes) - self.sizes] = True
        self.before = np.where(first, -1, np.roll(self.word, 1))  # -1: begin
        key = np.where(first, np.uint64(0x5851F42D4C957F2D), self.words[self.before] if len(self.words) else np.uint64(0))
        self._key = key

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct bigrams, and the place of every token's bigram among them."""
        return np.unique(_mix(_mix(self._key) + self.words[self.word]), return_inverse=True)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo: dict[str, int] = {}
    ids, train, sizes, flat, chars = [], [], [], [], 0

    def flush():
        words, word = np.unique(np.array(flat, np.uint64), return_inverse=True)
        order = zstandard.ZstdCompressor(level=3).compress(word.astype(np.int32).tobytes())
        name = uuid.uuid4().int >> 65  # the table is written once and read back, so a name need only be unique
        return pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([ids], pa.list_(pa.int64())), pa.array([train], pa.list_(pa.bool_())),
             pa.array([sizes], pa.list_(pa.int64())), pa.array([_pack(words)], pa.binary()), pa.array([order], pa.binary())],
            names=["block", "ids", "train", "sizes", "words", "stream"])

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            own = tokens(text)
            for w in own:
                if w not in memo:
                    memo[w] = xxhash.xxh64_intdigest(w)
            flat += map(memo.__getitem__, own)
            ids.append(doc)
            train.append(zlib.crc32(str(doc).encode()) % 5 != 1)
            sizes.append(len(own))
            chars += len(text or "") + 1
            if chars >= BLOCK_CHARS:
                yield flush()
                ids, train, sizes, flat, chars, memo = [], [], [], [], 0, {}
    if ids:
        yield flush()


BLOCK_SCHEMA = "block long, ids array<long>, train array<boolean>, sizes array<long>, words binary, stream binary"


def _dealt(block: int, keys: np.ndarray, buckets: int, *more: np.ndarray) -> pa.RecordBatch:
    """One request per bucket: buckets are ranges of the key, so requests stay sorted."""
    cuts = [0, *[int(np.searchsorted(keys, np.uint64(i * (2 ** 64 // buckets)))) for i in range(1, buckets)], len(keys)]
    some = [i for i in range(buckets) if cuts[i] < cuts[i + 1]]
    return pa.RecordBatch.from_arrays(
        [pa.array([block] * len(some), pa.int64()), pa.array(some, pa.int64()),
         pa.array([_pack(keys[cuts[i]:cuts[i + 1]], *[m[cuts[i]:cuts[i + 1]] for m in more]) for i in some], pa.binary())],
        names=["block", "bucket", "request"])


def _answer(kinds, extra):
    """Sum the counts of a bucket's keys over all requests; give each request its counts."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        asked = [_unpack(r, *kinds) for r in pdf["request"]]
        keys, where = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
        count = np.bincount(where, weights=np.concatenate([a[1] for a in asked])).astype(np.int64)
        out, at = [], 0
        for block, bucket, a in zip(pdf["block"], pdf["bucket"], asked):
            n = len(a[0])
            got = count[where[at:at + n]]
            out.append((block, bucket, zstandard.ZstdCompressor(level=1).compress(got.tobytes()), int(0)))
            at += n
        rows = pd.DataFrame(out, columns=["block", "bucket", "answer", "bin"])
        rows["weight"] = 0.0
        # once per bucket: distinct keys with a count, and the EM histogram
        some = extra(asked, keys, count, where)
        return pd.concat([rows, some], ignore_index=True) if len(some) else rows
    return run


ANSWER_SCHEMA = "block long, bucket long, answer binary, bin long, weight double"


def _totals(asked, keys, count, where):
    """Bin 0: words, bin 1: tokens, bin 2: tokens of words seen once, bin 3 + k: tokens by ln(c - 1) / STEP."""
    c = count[count > 0]
    place = 2 + np.where(c > 1, 1 + np.rint(np.log(np.maximum(c - 1, 1)) / STEP), 0).astype(np.int64)
    bins, back = np.unique(place, return_inverse=True)
    weight = np.bincount(back, weights=c, minlength=len(bins))
    return pd.DataFrame({"block": -1, "bucket": -1, "answer": None, "bin": np.concatenate([[0, 1], bins]),
                         "weight": np.concatenate([[float(len(c)), float(c.sum())], weight])})


def _histogram(asked, keys, count, where):
    """Left-out log ratios: request columns are the count, the context bucket and log P1 * c(v), quantised."""
    own = np.concatenate([a[1] for a in asked]).astype(np.float64)
    level = np.concatenate([a[2] for a in asked]).astype(np.int64)
    base = np.concatenate([a[3] for a in asked]).astype(np.float64) * STEP
    c = count[where].astype(np.float64)
    live = own > 0
    with np.errstate(divide="ignore"):
        ratio = np.log(c[live] - 1) - base[live]  # ln of bigram estimate over unigram estimate; -inf if unseen
    place = np.where(np.isfinite(ratio), np.clip(np.rint(ratio / STEP), -REACH, REACH) + REACH, 2 * REACH + 1).astype(np.int64)
    bins, back = np.unique(level[live] * (2 * REACH + 2) + place, return_inverse=True)
    weight = np.bincount(back, weights=own[live], minlength=len(bins))
    return pd.DataFrame({"block": -1, "bucket": -1, "answer": None, "bin": bins, "weight": weight})


def mixture_weight(ratio: np.ndarray, weight: np.ndarray, rounds: int = 300) -> float:
    """EM for a in a * p + (1 - a) * q over held-out tokens with ratio p / q."""
    a = 0.5
    for _ in range(rounds):
        new = float((weight * a * ratio / (a * ratio + 1 - a)).sum() / weight.sum())
        if abs(new - a) < 1e-9:
            break
        a = new
    return min(max(a, 1e-9), 1 - 1e-6)


def bigram_weights(bins: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The weight of the bigram estimate in every context bucket; 0 where no training token falls."""
    level, place = bins // (2 * REACH + 2), bins % (2 * REACH + 2)
    ratio = np.where(place > 2 * REACH, 0.0, np.exp((place - REACH) * STEP))
    return np.array([mixture_weight(ratio[level == b], weight[level == b]) if weight[level == b].sum() else 0.0
                     for b in range(LEVELS + 1)])


def _level(count: np.ndarray) -> np.ndarray:
    """Context bucket; 0 for a context without a training count."""
    return np.where(count > 0, np.minimum(np.log2(np.maximum(count, 1)).astype(np.int64) + 1, LEVELS), 0)


def _gathered(answers) -> np.ndarray:
    """The counts of all of a block's keys from its answers in bucket order."""
    ordered = sorted(answers, key=lambda a: a["bucket"])
    return np.concatenate([np.frombuffer(zstandard.ZstdDecompressor().decompress(a["answer"]), np.int64) for a in ordered])


def _joined(blocks: DataFrame, **answers: DataFrame) -> DataFrame:
    for name, table in answers.items():
        grouped = table.where("block <> -1").groupBy("block").agg(F.collect_list(F.struct("bucket", "answer")).alias(name))
        blocks = blocks.join(grouped, "block")
    return blocks


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document.

    Trained on the rows whose crc32(doc_id as text) mod 5 is not 1 (a null id counts as the text None).
    score: log10 probability under the interpolated model; base_score: the smoothed unigram model. Null and
    empty texts are one end token. Without training tokens both models are uniform.
    """
    blocks = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_blocks, BLOCK_SCHEMA), "lm-blocks")
    total = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(8, -(-total // BUCKET_KEYS))

    def ask_words(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                n = np.bincount(b.word[b.train], minlength=len(b.words)).astype(np.uint32)
                yield _dealt(row["block"], b.words, buckets, n)

    words = settle(blocks.mapInArrow(ask_words, "block long, bucket long, request binary").groupBy("bucket")
                   .applyInPandas(_answer((np.uint32,), _totals), ANSWER_SCHEMA), "lm-words")
    sums = {r["bin"]: r["w"] for r in words.where("block = -1").groupBy("bin").agg(F.sum("weight").alias("w")).collect()}
    v, n = float(sums.get(0, 0)), float(sums.get(1, 0))
    tail = np.array(sorted((k, w) for k, w in sums.items() if k >= 2)).reshape(-1, 2)
    left_out = np.where(tail[:, 0] > 2, np.exp((tail[:, 0] - 3) * STEP), 0.0) / max(n - 1, 1.0) * (v + 1)
    floor = 1 - mixture_weight(left_out, tail[:, 1]) if n else 1.0

    def unigram(c, less):
        return (1 - floor) * np.maximum(c - less, 0) / max(n - less, 1.0) + floor / (v + 1)

    def ask_bigrams(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                c = _gathered(row["w"])
                bigrams, place = b.pairs()
                own = np.bincount(place[b.train], minlength=len(bigrams)).astype(np.uint32)
                one = np.zeros(len(bigrams), np.int64)
                one[place] = np.arange(len(place))  # any token of the bigram
                context = np.where(b.before[one] >= 0, c[b.before[one]], row["docs"])
                base = np.log(unigram(c[b.word[one]], 1.0) * np.maximum(context - 1, 1)) / STEP
                yield _dealt(row["block"], bigrams, buckets * 2, own, _level(context).astype(np.uint8), np.rint(base).astype(np.int16))

    # the begin mark's count is the number of training documents
    starts = blocks.agg(F.sum(F.size(F.filter("train", lambda x: x)))).first()[0] or 0
    with_words = _joined(blocks.withColumn("docs", F.lit(starts).cast("long")), w=words)
    pairs = settle(with_words.mapInArrow(ask_bigrams, "block long, bucket long, request binary").groupBy("bucket")
                   .applyInPandas(_answer((np.uint32, np.uint8, np.int16), _histogram), ANSWER_SCHEMA), "lm-pairs")
    learned = pairs.where("block = -1").groupBy("bin").agg(F.sum("weight").alias("w")).toPandas()
    alpha = bigram_weights(learned["bin"].to_numpy(np.int64), learned["w"].to_numpy(np.float64))

    def score(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                c, pair = _gathered(row["w"]), _gathered(row["p"])
                own = c[b.word]
                context = np.where(b.before >= 0, c[b.before], row["docs"])
                a = alpha[_level(context)]
                p = a * pair[b.pairs()[1]] / np.maximum(context, 1) + (1 - a) * unigram(own, 0.0)
                base = np.log10((own + 0.5) / (n + 0.5 * (v + 1)))
                at = np.cumsum(b.sizes) - b.sizes
                add = lambda x: np.add.reduceat(x, at)
                k = len(b.sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array([not t for t in row["train"]]), pa.array(b.sizes),
                     pa.array(add((own > 0).astype(np.int64))), pa.array(np.full(k, int(n))), pa.array(add(base)),
                     pa.array(add(np.log10(p)))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    ready = _joined(blocks.withColumn("docs", F.lit(starts).cast("long")), w=words, p=pairs)
    return ready.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                   "base_score double, score double")
