"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its 5-word shingles (a shorter text is one shingle). The weight of a
shingle is its count in the document times an inverse document frequency of 1, 1.125 or 1.25: ln((1 + N) /
(1 + df)) / ln(1 + N), between 0 and 1, rounded to thirds of that range; df is the number of documents that
hold the shingle's feature, one of 2^18 hashed features (as HashingTF with IDF count them), so the table of
frequencies has a fixed size at any scale and covers every document. A link is a true Jaccard similarity of
at least `similarity`, weighted or plain. Weights are that flat because the shingles a large group shares
are frequent: were they much lighter than each text's own, the bar would rise with the size of the group.

Equal word sequences form one distinct text. Each distinct text draws SAMPLES consistent samples (two texts
agree on one with a probability equal to their weighted Jaccard similarity), banded. Texts that share a band
are candidates. First all members of a bucket are compared with one leader, the text with most company.
Buckets that still hold several classes are refined exactly: two texts within reach share one of their rarest
shingles (of the larger all but `similarity` of its weight, of the smaller all but 2t / (1 + t)), at places
that leave enough weight behind it in both. So texts of a large group, each with more than about a ninth of
its own, never meet on what all of them share. A key is (bucket, rare shingle, size level); where one still
holds many texts, its members meet more leaders in each round, or all at once where that makes no more pairs,
until every pair of a key that lies in different classes was compared. No pair of a bucket within reach is lost.

Python runs only inside tasks on Arrow batches. What reaches the driver is the frequency table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import hidden, row_key, settle, shown, words_of
from clickscope.llm.components import connected_components

SHINGLE = 5
SIMILARITY = 0.8
FEATURE_BITS = 18
BANDS, ROWS = 14, 5
SAMPLES = BANDS * ROWS
IDF = np.array([1, 1.125, 1.25], np.float32)
LEVEL = 1.05  # texts whose weights differ by less may share a size level
SLACK = 1e-5  # of every bound, far above the rounding of sums
TABLE_BITS = 15  # rows of the table of random variates, picked by a shingle's hash
SEED = 7

_MUL = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the 5-word windows of a document given as word hashes."""
    if not len(words):
        return np.empty(0, np.uint64)
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = (h ^ mix(words[k:k + n])) * _MUL + np.uint64(size)
    return mix(h)


def _documents(batch: pa.RecordBatch, column: str) -> Iterator[np.ndarray]:
    values = batch.column(column)
    flat = values.values.to_numpy(zero_copy_only=False).view(np.uint64)
    bounds = values.offsets.to_numpy()
    for i in range(len(values)):
        yield flat[bounds[i]:bounds[i + 1]]


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, n = np.zeros(1 << FEATURE_BITS, np.int64), 0
    mask = np.uint64((1 << FEATURE_BITS) - 1)
    for batch in batches:
        for words in _documents(batch, "words"):
            counts[np.unique(shingles(words) & mask)] += 1
            n += 1
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(counts[some], n))],
                                     names=["feature", "n"])


def feature_rarity(words: DataFrame) -> np.ndarray:
    """Inverse document frequency per hashed feature, 0 to 1, counted over all documents (2^18 numbers)."""
    counted = words.mapInArrow(_count_features, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    table = counted.toPandas()
    df = np.zeros(1 << FEATURE_BITS)
    real = table["feature"].to_numpy() >= 0
    df[table["feature"].to_numpy()[real]] = table["n"].to_numpy()[real]
    n = float(table["n"].to_numpy()[~real].sum())
    return (np.log((1 + n) / (1 + np.minimum(df, n))) / max(np.log(1 + n), 1e-9)).astype(np.float32)


def feature_weights(rarity: np.ndarray) -> np.ndarray:
    return IDF[np.minimum(rarity * len(IDF), len(IDF) - 1).astype(np.int64)]


def weighted_set(words: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles and their weights."""
    h, tf = np.unique(shingles(words), return_counts=True)
    return h, tf.astype(np.float32) * weights[(h & np.uint64((1 << FEATURE_BITS) - 1)).astype(np.int64)]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = float(np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64))
    total = float(a[1].sum(dtype=np.float64)) + float(b[1].sum(dtype=np.float64)) - low
    return low / total if total else 0.0


def alike(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], similarity: float) -> bool:
    """The plain or the weighted Jaccard similarity is at least `similarity`."""
    n = len(np.intersect1d(a[0], b[0], assume_unique=True))
    return n >= similarity * (len(a[0]) + len(b[0]) - n) or weighted_jaccard(a, b) >= similarity


def _bands(sample: np.ndarray) -> np.ndarray:
    out = np.zeros(BANDS, np.uint64)
    for k in range(ROWS):
        out = mix(out ^ sample[k::ROWS]) * _MUL
    return out + np.arange(BANDS, dtype=np.uint64)


def _least(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum of every column and the first row that holds it."""
    low = values.min(axis=0)
    row, column = np.nonzero(values == low)
    at = np.empty(values.shape[1], np.int64)
    at[column[::-1]] = row[::-1]
    return low, at


class Sampler:
    """Improved consistent weighted sampling: r, c ~ Gamma(2, 1) and b ~ U(0, 1) per shingle and sample."""

    def __init__(self):
        rng = np.random.default_rng(SEED)
        shape = (1 << TABLE_BITS, SAMPLES)
        self.r = rng.gamma(2.0, 1.0, shape).astype(np.float32)
        self.b = rng.random(shape, dtype=np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, shape)).astype(np.float32)
        # most shingles occur once: log_a of each of their few possible weights
        every = np.arange(1 << TABLE_BITS)
        self.known = np.concatenate([self._log_a(every, np.full(len(every), w))[0] for w in IDF])

    def _log_a(self, row: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        r, b = self.r[row], self.b[row]
        t = np.floor(np.log(weight.astype(np.float32))[:, None] / r + b)
        return self.log_c[row] - r * (t - b) - r, t

    def draw(self, h: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One 64-bit key per band, and 64 bits of every sample."""
        row = (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        level = np.searchsorted(IDF, weight)
        usual = IDF[np.minimum(level, len(IDF) - 1)] == weight
        best = np.full(SAMPLES, np.inf, np.float32)
        pick = np.zeros(SAMPLES, np.int64)
        for some in (np.flatnonzero(usual), np.flatnonzero(~usual)):
            for at in range(0, len(some), 4096):
                part = some[at:at + 4096]
                value, first = _least(self.known[(level[part] << TABLE_BITS) + row[part]] if usual[part[0]]
                                      else self._log_a(row[part], weight[part])[0])
                new = value < best
                best, pick = np.where(new, value, best), np.where(new, part[first], pick)
        column = np.arange(SAMPLES)
        r, b = self.r[row[pick], column], self.b[row[pick], column]
        t = np.floor(np.log(weight[pick].astype(np.float32)) / r + b)
        sample = mix(h[pick] ^ mix(t.astype(np.int64).view(np.uint64)))
        return _bands(sample), sample


def _sketch(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in batches:
            drawn = [sampler.draw(*weighted_set(words, weights.value))[0] if len(words) else np.empty(0, np.uint64)
                     for words in _documents(batch, "words")]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in drawn])]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.uint64), *drawn]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "k1", "k2", "f1", "f2")], pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))],
                names=["doc_id", "k1", "k2", "f1", "f2", "bands"])
    return run


def _size_level(weight):
    return np.floor(np.log(weight) / np.log(LEVEL)).astype(np.int64)


def rare_prefix(h: np.ndarray, weight: np.ndarray, rarity: np.ndarray, similarity: float) -> tuple[np.ndarray, ...]:
    """For every shingle of a set by which a partner can be found, rarest first: the shingle, the size levels
    low to high of smaller partners that it can find, and the set's own level where it can be found by larger
    ones, else -1 (levels start at 0: no weight is below 1).

    Let the rarest shared shingle of two sets leave the weights x and y in them, itself included. What they
    share is at most the smaller of both, and must be t / (1 + t) of the sum of their weights. A partner's
    weight lies between t times and 1 / t times the set's own.
    """
    order = np.lexsort((h, -rarity[(h & np.uint64((1 << FEATURE_BITS) - 1)).astype(np.int64)]))
    h, weight = h[order], weight[order].astype(np.float64)
    left = np.cumsum(weight[::-1])[::-1]
    total, share = left[0], similarity / (1 + similarity) * (1 - SLACK)
    low, own = int(_size_level(max(1.0, similarity * total * (1 - SLACK)))), int(_size_level(total))
    levels = np.arange(low, own + 1)
    # a smaller partner weighs at least the foot of its level
    need = share * (total + np.maximum(LEVEL ** levels, similarity * total) * (1 - SLACK))
    high = low - 1 + (left[:, None] >= need).sum(axis=1)
    found = np.where(left >= share * 2 * total, own, -1)
    n = int(np.count_nonzero(high >= low))
    return h[:n], np.full(n, low), high[:n], found[:n]


def _prefixes(weights, rarity, similarity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, parts = batch.column("f1").to_numpy(), []
            for node, words in zip(nodes, _documents(batch, "words")):
                h, weight = weighted_set(words, weights.value)
                for kind, w in enumerate((weight, np.ones(len(h)))):
                    part = rare_prefix(h, w, rarity.value, similarity)
                    parts.append((np.full(len(part[0]), node), part[0].view(np.int64), np.full(len(part[0]), kind), *part[1:]))
            columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0)] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(k)) for c, k in zip(columns, ("i8", "i8", "i4", "i4", "i4", "i4"))],
                                             names=["node", "shingle", "kind", "low", "high", "found"])
    return run


def _verify(weights, similarity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            keep = np.zeros(len(a), bool)
            for i, (x, y) in enumerate(zip(_documents(batch, "words_a"), _documents(batch, "words_b"))):
                if a[i] != last:
                    last, held = a[i], weighted_set(x, weights.value)
                keep[i] = alike(held, weighted_set(y, weights.value), similarity)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])
    return run


def _hashed(text):
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of `docs`: doc_id, k1, k2 (its key), f1 (its distinct text), root (its class: the
    smallest f1 of the class), class_id (the smallest doc_id of its class), n_links_found (different texts
    linked to its text by the comparisons made: texts already in one class are not compared, so its true number
    of near copies can be higher).

    Classes are told apart by root alone: class_id is null where no row of a class has an id, and two classes
    share it where a doc_id occurs with different texts. Null and empty texts have no shingle; they are copies
    of each other. A null doc_id counts as larger than any other. Other columns of `docs` only tell rows apart.
    """
    spark = docs.sparkSession
    k1, k2 = row_key(docs)
    words = docs.select("doc_id", k1.alias("k1"), k2.alias("k2"), _hashed(F.col("text")).alias("words"))
    words = words.withColumns({"f1": F.xxhash64("words"), "f2": F.xxhash64(F.lit(23), F.col("words"))})
    counted = feature_rarity(words.select("words"))
    rarity, weights = spark.sparkContext.broadcast(counted), spark.sparkContext.broadcast(feature_weights(counted))
    sketches = settle(words.mapInArrow(_sketch(weights), "doc_id long, k1 long, k2 long, f1 long, f2 long, bands array<long>"),
                      "sketches")
    texts = sketches.groupBy("f1", "f2").agg(F.first("bands").alias("bands"))
    banded = settle(texts.select(F.col("f1").alias("node"), F.explode("bands").alias("bucket")), "banded")
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    buckets = settle(banded.join(sizes, "bucket"), "buckets")
    nodes = settle(buckets.select(F.col("node").alias("f1")).distinct(), "nodes")
    held = settle(docs.select("text", _hashed(F.col("text")).alias("words")).select("text", F.xxhash64("words").alias("f1"))
                  .join(nodes, "f1", "left_semi").groupBy("f1").agg(F.min("text").alias("text")), "texts")
    links, classes = _links(buckets, held, weights, rarity, similarity)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links_found"))
    roots = settle(classes.join(degree, "node"), "roots")
    named = sketches.drop("bands").join(roots, F.col("f1") == F.col("node"), "left").withColumns(
        {"root": F.coalesce("root", "f1"), "n_links_found": F.coalesce("n_links_found", F.lit(0))})
    named = settle(named.drop("node"), "named")
    names = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return named.join(names, "root").select("doc_id", "k1", "k2", "f1", "root", "class_id", F.col("n_links_found").cast("long").alias("n_links_found"))


def _compare(pairs: DataFrame, held: DataFrame, weights, similarity: float) -> DataFrame:
    """Those of the pairs (a, b of distinct texts) that are within reach."""
    hashed = held.select("f1", _hashed(F.col("text")).alias("words"))
    tasks = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    # pairs are few bytes but much work: a fixed number of tasks, whatever their size
    compared = (met.join(hashed.select(F.col("f1").alias("b"), F.col("words").alias("words_b")), "b")
                .repartition(tasks, "a").join(hashed.select(F.col("f1").alias("a"), F.col("words").alias("words_a")), "a")
                .select("a", "b", "words_a", "words_b"))
    return settle(compared.mapInArrow(_verify(weights, similarity), "a long, b long"), "near-links")


def _open(members: DataFrame, roots: DataFrame, group: str) -> DataFrame:
    """The members of groups that hold several classes, with their root and the group's largest class."""
    labelled = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = (labelled.groupBy(group, "root").agg(F.count("*").alias("n"))
               .groupBy(group).agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"))
               .where("main.n < n").select(group, "main", F.expr("(n - main.n) * n").alias("pairs"), F.col("n").alias("size")))
    return settle(labelled.join(several, group), "open")


def _keys(open_: DataFrame, held: DataFrame, weights, rarity, similarity: float) -> DataFrame:
    """node, key, found: (bucket, rare shingle, kind, size level) of the texts of open buckets; a pair within
    reach that shares a bucket shares a key that `found` marks for one of them."""
    nodes = settle(open_.select(F.col("node").alias("f1"), "root").distinct(), "open-nodes")
    prefixes = (held.join(nodes, "f1", "left_semi").select("f1", _hashed(F.col("text")).alias("words"))
                .mapInArrow(_prefixes(weights, rarity, similarity), "node long, shingle long, kind int, low int, high int, found int"))
    rare = settle(prefixes.join(nodes.withColumnRenamed("f1", "node"), "node"), "prefixes")
    for levels in (False, True):
        # a key serves only where classes differ, first whatever the size level, then at each
        by = ["shingle", "kind", "level"][:2 + levels]
        useful = (rare.groupBy(*by).agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.max("found").alias("some"))
                  .where("r1 <> r2 and some >= 0").select(*by))
        rare = rare.join(useful, by)
        if not levels:
            rare = settle(rare.select("node", "root", "shingle", "kind", F.explode(F.sequence("low", "high")).alias("level"),
                                      F.col("found").alias("own"))
                          .withColumn("found", F.when(F.col("own") == F.col("level"), 0).otherwise(-1)).drop("own"), "rare")
    return settle(rare.join(open_.select("node", "bucket"), "node")
                  .select("node", F.xxhash64("bucket", "shingle", "kind", "level").alias("key"), (F.col("found") >= 0).alias("found")), "keys")


def _links(buckets: DataFrame, held: DataFrame, weights, rarity, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Verified links of texts in a common bucket, enough to join every class (see the module's text), and
    the root of every linked text."""
    company = buckets.groupBy("node").agg(F.sum("size").alias("company"))
    leads = buckets.join(company, "node").groupBy("bucket").agg(F.max_by("node", F.struct("company", "node")).alias("a"))
    links = _compare(buckets.join(leads, "bucket").where("node <> a").select("a", F.col("node").alias("b")), held, weights, similarity)
    roots = connected_components(links)
    keys = _keys(_open(buckets.select("node", "bucket"), roots, "bucket"), held, weights, rarity, similarity)
    leaders = 1
    while True:
        labelled = _open(keys, roots, "key")
        largest, members = labelled.agg(F.max("size"), F.count("*")).first()
        if not largest:
            return links, roots
        pairs = labelled.select("key", "pairs").distinct().agg(F.sum("pairs")).first()[0]
        last = leaders >= largest or pairs <= leaders * members
        # at last every text outside its key's largest class meets the whole key
        chosen = labelled.where("root <> main.root" if last else F.expr(f"pmod(xxhash64(node, key), size) < {leaders}"))
        chosen = chosen.select("key", F.col("node").alias("a"), F.col("root").alias("root_a"), F.col("found").alias("found_a"))
        met = labelled.join(chosen, "key").where("root <> root_a and (found or found_a)").select("a", F.col("node").alias("b"))
        new = _compare(met, held, weights, similarity)
        # pairs of different classes only: no link comes twice
        links = links.unionByName(new)
        if last:
            return links, connected_components(links)
        if not new.isEmpty():
            roots = connected_components(links)
        leaders *= 8


def near_dedup(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """`docs` with one row per class: the one with the smallest doc_id (then the smallest row key)."""
    keep = (near_classes(docs, similarity).groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")).alias("first"))
            .select("first.k1", "first.k2"))
    names = ("_k1", "_k2")
    keyed = docs.select(*hidden(docs), *[c.alias(n) for c, n in zip(row_key(docs), names)]).dropDuplicates(list(names))
    kept = settle(keep.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")), "kept")
    return keyed.join(kept, list(names), "left_semi").select(*shown(docs))
