"""SentencePiece BPE encoding and decoding by suffix-array matching.

The words of a batch of texts (a word: its leading space marks and what follows up to the next mark; no
piece of the vocabulary goes further) are concatenated without repeats. A suffix array over that text,
ordered by the first MAX characters, is searched for every piece of the vocabulary at once; the range of
suffixes found are the piece's occurrences. Each occurrence is an edge from its start to its end. Edges
are sorted by start and relaxed from left to right for all words together: an edge (start, end, piece) is
taken if the segmentation of the text before `start` ends in a piece that byte-pair merging would leave
apart from this one. Byte-pair merging leaves exactly one such chain, so the result equals the
library's. Characters outside the vocabulary become byte pieces.

The boundary of two pieces stays if no pair (last part of the left piece, first part of the right piece)
that exists side by side at some moment of the merging is itself a piece of a higher priority than the
merge that ends that moment.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BATCH_CHARS = 1_000_000  # of text that shares one index; a longer text is cut between words
HELD_WORDS = 300_000  # encoded words that a task remembers between batches


class Vocabulary:
    """Pieces, ranks and the merge tree of a SentencePiece BPE model with byte fallback and no normalisation."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte = [None] * n
        self.byte_id = [0] * 256
        for i in range(n):
            if sp.is_byte(i):
                self.byte[i] = int(self.pieces[i][1:-1], 16)
                self.byte_id[self.byte[i]] = i
        self.spelt = [bytes([b]) if b is not None else p.replace(MARK, " ").encode() for p, b in zip(self.pieces, self.byte)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece goes beyond its word")
        # rank: smaller merges first; the order of the scores
        self.rank = np.full(n, n, np.int64)
        self.rank[sorted(plain, key=lambda i: -sp.get_score(i))] = np.arange(len(plain))
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.made = np.zeros(n, bool)  # pieces that merging their own characters yields
        for i in plain:
            parts, last = self._merge(self.pieces[i])
            if len(parts) == 1:
                self.made[i] = True
                if last:
                    self.left[i], self.right[i] = last
        self.pair_keys, self.pair_rank = self._pairs(plain)
        self.known, self.answer = np.full(1 << 21, -1, np.int64), np.zeros(1 << 21, bool)

    def _merge(self, text: str):
        parts, last = [self.ids.get(c) for c in text], None
        if None in parts:
            return parts, None
        while len(parts) > 1:
            options = [(self.rank[j], k) for k in range(len(parts) - 1)
                       if (j := self.ids.get(self.pieces[parts[k]] + self.pieces[parts[k + 1]])) is not None]
            if not options:
                break
            _, k = min(options)
            last = (parts[k], parts[k + 1])
            parts[k:k + 2] = [self.ids[self.pieces[parts[k]] + self.pieces[parts[k + 1]]]]
        return parts, last

    def _pairs(self, plain):
        keys, ranks = [], []
        for i in plain:
            p = self.pieces[i]
            for cut in range(1, len(p)):
                a, b = self.ids.get(p[:cut]), self.ids.get(p[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    ranks.append(self.rank[i])
        keys, ranks = np.array(keys, np.int64), np.array(ranks, np.int64)
        order = np.argsort(keys)
        return keys[order], ranks[order]

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether byte-pair merging leaves piece a next to piece b; negative ids merge with nothing.

        Answers are remembered in a fixed table, one per hash of the pair.
        """
        good = np.ones(len(a), bool)
        real = np.flatnonzero((a >= 0) & (b >= 0))
        key = a[real] << 32 | b[real]
        slot = (key * 0x9E3779B97F4A7C1 >> 20) & (len(self.known) - 1)
        miss = self.known[slot] != key
        good[real] = self.answer[slot]
        if miss.any():
            fresh, back = np.unique(key[miss], return_inverse=True)
            answer = self._apart(fresh >> 32, fresh & 0xFFFFFFFF)
            at = slot[miss]
            self.known[at] = key[miss]
            # of pairs that share a slot the last write stays, with its own answer
            self.answer[at] = answer[back]
            good[real[miss]] = answer[back]
        return good

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        never = np.iinfo(np.int64).max
        good, at = np.ones(len(a), bool), np.arange(len(a))
        x, y = a.copy(), b.copy()
        end_x, end_y = np.full(len(at), never), np.full(len(at), never)  # rank of the merge that uses x, y up
        while len(at):
            key = x << 32 | y
            i = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            rank = np.where(self.pair_keys[i] == key, self.pair_rank[i], never)
            joins = (rank < end_x) & (rank <= end_y) & (rank < never)
            good[at[joins]] = False
            # step back in time: the side that was made later falls into its parts
            made_x = np.where(self.left[x] >= 0, self.rank[x], -1)
            made_y = np.where(self.left[y] >= 0, self.rank[y], -1)
            # of two equal merges the left one is done first, so the right one is the later
            go_y = (made_y >= made_x) & (made_y >= 0)
            go_x = ~go_y & (made_x >= 0)
            live = ~joins & (go_x | go_y)
            end_x, end_y = np.where(go_x, made_x, end_x)[live], np.where(go_y, made_y, end_y)[live]
            x, y = np.where(go_x, self.right[x], x)[live], np.where(go_y, self.left[y], y)[live]
            at = at[live]
        return good


class Index:
    """A suffix array over codes, ordered by the first `depth` of every suffix.

    Codes are packed into 63-bit keys, as many as fit; the first key is searched directly, the further
    ones only for pieces longer than a key.
    """

    def __init__(self, codes: np.ndarray, depth: int):
        alphabet, dense = np.unique(codes, return_inverse=True)
        self.alphabet = alphabet
        self.bits = int(len(alphabet) + 1).bit_length()
        self.width = 63 // self.bits
        padded = np.zeros(len(codes) + depth + self.width, np.int64)
        padded[:len(codes)] = dense + 1
        n = len(codes)
        keys = []
        for at in range(0, depth, self.width):
            key = np.zeros(n, np.int64)
            for k in range(self.width):
                key = key << self.bits | padded[at + k:at + k + n]
            keys.append(key)
        self.order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
        self.keys = [k[self.order] for k in keys]

    def ranges(self, queries: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last+1 place in `order` of the suffixes that begin with each query (zero-padded rows).

        Every query is bisected; a longer one is bisected again by its next key inside the range found.
        """
        i = np.minimum(np.searchsorted(self.alphabet, queries), len(self.alphabet) - 1)
        inside = np.arange(queries.shape[1]) < sizes[:, None]
        known = ((self.alphabet[i] == queries) | ~inside).all(axis=1)
        dense = np.where(inside, i + 1, 0)
        low, high = self._pack(dense, inside, 0)
        lo = np.searchsorted(self.keys[0], low, "left")
        hi = np.searchsorted(self.keys[0], high, "right")
        hi = np.where(known, hi, lo)
        for part in range(1, len(self.keys)):
            low, high = self._pack(dense, inside, part * self.width)
            for q in np.flatnonzero((hi > lo) & (sizes > part * self.width)):
                key = self.keys[part][lo[q]:hi[q]]
                lo[q], hi[q] = lo[q] + np.searchsorted(key, low[q], "left"), lo[q] + np.searchsorted(key, high[q], "right")
        return lo, hi

    def _pack(self, dense, inside, at):
        low, high = np.zeros(len(dense), np.int64), np.zeros(len(dense), np.int64)
        top = (1 << self.bits) - 1
        for k in range(at, at + self.width):
            here = inside[:, k] if k < dense.shape[1] else np.zeros(len(dense), bool)
            code = dense[:, k] if k < dense.shape[1] else 0
            low = low << self.bits | np.where(here, code, 0)
            high = high << self.bits | np.where(here, code, top)
        return low, high


class Codec:
    def __init__(self, path: str):
        self.v = v = Vocabulary(path)
        made = [(p, i) for p, i in v.ids.items() if v.made[i]]
        self.piece_ids = np.array([i for _, i in made], np.int64)
        self.sizes = np.array([len(p) for p, _ in made], np.int64)
        self.depth = int(self.sizes.max())
        self.queries = np.zeros((len(made), self.depth), np.int32)
        for k, (p, _) in enumerate(made):
            self.queries[k, :len(p)] = [ord(c) for c in p]
        self._forget()

    def _forget(self):
        self.index: dict[str, int] = {}
        self.flat, self.bounds = np.empty(0, np.int32), np.zeros(1, np.int64)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of distinct words, all matched through one suffix array: ids, and bounds of the words."""
        lengths = np.array([len(w) for w in words], np.int64)
        # words are separated by code 0, which no piece holds
        text = "\0".join(words) + "\0"
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.int32)
        starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        own = np.ones(len(codes), bool)
        own[starts + lengths] = False
        index = Index(codes + 1, self.depth)
        lo, hi = index.ranges(self.queries + (self.queries > 0), self.sizes)
        found = hi - lo
        edge_piece = np.repeat(self.piece_ids, found)
        edge_size = np.repeat(self.sizes, found)
        shift = np.repeat(lo - np.concatenate([[0], np.cumsum(found)[:-1]]), found)
        edge_start = index.order[np.arange(len(edge_piece)) + shift]
        # characters without a piece: an edge of one character, marked -1
        bare = own.copy()
        bare[edge_start[edge_size == 1]] = False
        # a character may be a piece only inside others; it is bare if the vocabulary lacks it
        bare = np.flatnonzero(bare)
        edge_start = np.concatenate([edge_start, bare])
        edge_size = np.concatenate([edge_size, np.ones(len(bare), np.int64)])
        edge_piece = np.concatenate([edge_piece, np.full(len(bare), -1)])
        # relax: by start inside the word, so all words advance together
        word_of = np.repeat(np.arange(len(words)), lengths + 1)
        offset = edge_start - starts[word_of[edge_start]]
        order = np.argsort(offset, kind="stable")
        edge_start, edge_size, edge_piece, offset = (x[order] for x in (edge_start, edge_size, edge_piece, offset))
        bounds = np.searchsorted(offset, np.arange(int(lengths.max(initial=0)) + 1))
        last = np.full(len(codes) + 1, -3, np.int64)  # piece that ends before this place; -3: unreached
        size = np.zeros(len(codes) + 1, np.int64)
        last[starts] = -2
        for k in range(len(bounds) - 1):
            a, b = bounds[k], bounds[k + 1]
            s, p = edge_start[a:b], edge_piece[a:b]
            before = last[s]
            take = before != -3
            take[take] = self.v.apart(before[take], p[take])
            s, p, z = s[take], p[take], edge_size[a:b][take]
            last[s + z], size[s + z] = p, z
        return self._chains(codes, starts, lengths, last, size)

    def _chains(self, codes, starts, lengths, last, size):
        """Follow the taken edges back from the end of every word."""
        at, rows = starts + lengths, np.arange(len(starts))
        hops_row, hops_piece, hops_at = [], [], []
        while True:
            live = at > starts[rows]
            rows, at = rows[live], at[live]
            if not len(rows):
                break
            if not size[at].all():
                raise AssertionError("a word has no segmentation")
            hops_row.append(rows)
            hops_piece.append(last[at])
            at = at - size[at]
            hops_at.append(at)
        if not hops_row:
            return np.empty(0, np.int32), np.zeros(len(starts) + 1, np.int64)
        row, piece, place = (np.concatenate(x) for x in (hops_row, hops_piece, hops_at))
        order = np.argsort(place)  # places grow with the words
        row, piece, place = row[order], piece[order], place[order]
        bare = np.flatnonzero(piece < 0)
        if len(bare):
            # a character outside the vocabulary becomes the pieces of its bytes
            spelt = [chr(c).encode("utf-8", "surrogatepass") for c in codes[place[bare]].tolist()]
            times = np.ones(len(piece), np.int64)
            times[bare] = [len(x) for x in spelt]
            row, piece = np.repeat(row, times), np.repeat(piece, times)
            piece[piece < 0] = [self.v.byte_id[b] for x in spelt for b in x]
        return piece.astype(np.int32), np.searchsorted(row, np.arange(len(starts) + 1))

    @staticmethod
    def words(text: str) -> list[str]:
        """A text with its space marks, cut before every run of marks. Each space is a mark of its own."""
        if not text:
            return []
        parts = (MARK + text.replace(MARK, " ").replace(" ", " " + MARK)).split(" ")
        if MARK not in parts:
            return parts
        out, marks = [], ""
        for p in parts:
            if p == MARK:
                marks += MARK
            else:
                out.append(marks + p)
                marks = ""
        return out + [marks] * bool(marks)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): text i has ids[bounds[i]:bounds[i + 1]]. A null text counts as empty.

        Texts are taken in stretches of BATCH_CHARS; what is held at once does not grow with a text."""
        ids, counts, held, size = [], np.zeros(len(texts), np.int64), [], 0

        def flush():
            flat, bounds = self._encode([part for _, part in held])
            ids.append(flat)
            np.add.at(counts, [i for i, _ in held], np.diff(bounds))
            held.clear()

        for i, text in enumerate(texts):
            for part in parts_of(text or ""):
                if held and size + len(part) > BATCH_CHARS:
                    flush()
                    size = 0
                held.append((i, part))
                size += len(part)
        if held:
            flush()
        return np.concatenate(ids) if ids else np.empty(0, np.int32), np.concatenate([[0], np.cumsum(counts)])

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = [self.words(t) for t in texts]
        seen = set().union(*cut)
        if len(self.index) > HELD_WORDS:
            self._forget()
        new = [w for w in seen if w not in self.index]
        if new:
            ids, bounds = self.encode_words(new)
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + bounds[1:]])
            self.flat = np.concatenate([self.flat, ids])
        get = self.index.__getitem__
        rows = np.fromiter((i for ws in cut for i in map(get, ws)), np.int64, sum(map(len, cut)))
        first, sizes = self.bounds[rows], self.bounds[rows + 1] - self.bounds[rows]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(first - (ends - sizes), sizes)]
        words = np.concatenate([[0], np.cumsum([len(ws) for ws in cut])]).astype(np.int64)
        return ids, np.concatenate([[0], ends])[words]

    def decode(self, ids: np.ndarray) -> str:
        """The text: byte pieces joined to UTF-8, marks to spaces, without the mark put before the text."""
        text = b"".join(map(self.v.spelt.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


_GAP = re.compile(rf"(?<![ {MARK}]) +(?![ {MARK}]|$)")


def parts_of(text: str) -> Iterator[str]:
    """A text in parts of about BATCH_CHARS, cut at the first space of a gap between words; that space is left out,
    since encoding puts one before every part. Words do not pass a gap, so the parts' ids are the text's."""
    at = 0
    while len(text) - at > BATCH_CHARS and (gap := _GAP.search(text, at + BATCH_CHARS)):
        yield text[at:gap.start()]
        at = gap.start() + 1
    yield text[at:]


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec per Python worker and model."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _added(df: DataFrame, name: str, kind: str) -> str:
    """The schema of df with one more column, for mapInArrow."""
    from pyspark.sql.types import StructType

    return StructType.fromJson({"type": "struct", "fields": [
        *df.schema.jsonValue()["fields"],
        {"name": name, "type": {"type": "array", "elementType": "integer", "containsNull": True} if kind == "ids" else "string",
         "nullable": True, "metadata": {}}]})


ROWS = 1000  # of a result that is held at once


def _id_lists(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat, pa.int32()))


def sentencepiece_encode(df: DataFrame, text: str = "text", ids: str = "ids", model: str = MODEL) -> DataFrame:
    """df with the piece ids of its texts. A null or empty text has none. `ids` must be a new name.

    `model` is a path that every executor has; the vocabulary is loaded once per Python worker.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([*part.columns, _id_lists(*c.encode(part.column(text).to_pylist()))],
                                                 names=[*part.schema.names, ids])

    return df.mapInArrow(run, _added(df, ids, "ids"))


def sentencepiece_decode(df: DataFrame, ids: str = "ids", text: str = "decoded", model: str = MODEL) -> DataFrame:
    """df with the texts that its ids spell; null ids give the empty text. Bytes that are no UTF-8 become
    replacement characters. `text` must be a new name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            lists = batch.column(ids)
            flat, bounds = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            out = [c.decode(flat[bounds[i]:bounds[i + 1]]) for i in range(len(lists))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, text])

    return df.mapInArrow(run, _added(df, text, "text"))


def round_trip(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Encode every text and decode it again: doc_id, n_ids, ids, same (the decoded text equals the text,
    a null text counting as empty; false only where a text itself holds the space mark U+2581)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = part.column("text").to_pylist()
                flat, bounds = c.encode(texts)
                same = [c.decode(flat[bounds[i]:bounds[i + 1]]) == text for i, text in enumerate(texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(bounds)), _id_lists(flat, bounds), pa.array(same, pa.bool_())],
                    names=["doc_id", "n_ids", "ids", "same"])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_ids long, ids array<int>, same boolean")
