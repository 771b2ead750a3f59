"""Line deduplication with an edit-distance join.

Lines are the \\n-separated parts of a text that hold a word. Equal lines form one distinct line, whatever
their length; two distinct lines of at least `min_chars` code points are linked if their edit distance
(insert, delete, replace) is at most `max_edits`. Links are found by segment partition: a line is cut
into max_edits + 1 even segments; of any line within reach, at least one segment occurs unchanged, at a
position that the length difference restricts. Each line is indexed by its own segments and probes the
segments of lines of every length from its own down to max_edits less. What shares a segment is verified
with a banded bit-parallel edit distance.

Classes are the connected components of the links. In every class the first occurrence (smallest document,
then line number) stays. Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import broadcast_if_small, discard, hidden, let, once, row_key, settle, shown
from clickscope.llm.components import connected_components
from clickscope.operators.session import maybe_in, session_bitmap

MAX_EDITS = 2
MIN_CHARS = 40
STEP = 16  # lengths a nominal length stands for
FEW = 16  # lines under one key that are paired; more are keyed anew by finer pieces
FINER = 6  # pieces of a line at the finer level, a multiple of those before
BAG_CHARS = 30_000  # below 2^15: counts of longer lines may pass 63 bits
HAS_WORD = r"[^\x20\x09-\x0D]"


def banded_distance(a: Column, b: Column, max_edits: int) -> Column:
    """Edit distance of two strings (in code points) if it is at most max_edits, else null.

    Bit-parallel over a band of 2 * max_edits + 1 diagonals held in the low bits of one long. After the
    column of the j-th character of b, bit i stands for row j + i - max_edits of the distance matrix. `up`
    and `down` mark the rows where the column rises or falls by one from the row above. The score is
    followed along the lower edge of the band while that edge is inside the matrix, then along the last row.
    """
    width = 2 * max_edits + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    word = lambda x: F.lit(x).cast("long")
    inverse = lambda x: F.bitwise_not(x).bitwiseAND(word(full))

    def distance(p: Column, t: Column) -> Column:
        m = F.size(p)

        def step(s, c):
            j, up, down = s["j"], s["up"], s["down"]
            equal = word(0)
            for i in range(width):
                row = j + (i - max_edits)
                hit = F.coalesce(F.get(p, F.when(row >= 0, row)) == c, F.lit(False))
                equal = equal.bitwiseOR(F.when(hit, word(1 << i)).otherwise(word(0)))

            def after(flat):  # flat: rows whose value equals their upper left neighbour's
                right = down.bitwiseOR(inverse(flat.bitwiseOR(up)))
                left = flat.bitwiseAND(up)
                next_flat = F.shiftright(flat, 1)
                bit = m - 1 - j + max_edits  # of the last row
                last = F.get(F.array(*[word(1 << i) for i in range(width)]), F.when(bit.between(0, width - 1), bit))
                change = F.when(j + 1 + max_edits <= m, F.when(flat.bitwiseAND(word(top)) == 0, 1).otherwise(0)).otherwise(
                    F.when(right.bitwiseAND(last) != 0, 1).when(left.bitwiseAND(last) != 0, -1).otherwise(0))
                return F.struct((j + 1).alias("j"), (s["score"] + change).alias("score"),
                                left.bitwiseOR(inverse(next_flat.bitwiseOR(right))).alias("up"),
                                next_flat.bitwiseAND(right).alias("down"))

            return let(equal, lambda x: let(
                (x.bitwiseAND(up) + up).bitwiseXOR(up).bitwiseOR(x).bitwiseOR(down).bitwiseAND(word(full)), after))

        start = F.struct(F.lit(0).alias("j"), F.least(F.lit(max_edits), m).alias("score"),
                         word(full & ~((1 << max_edits) - 1)).alias("up"), word(0).alias("down"))
        out = F.aggregate(t, start, step, lambda s: s["score"])
        return F.when(F.abs(m - F.size(t)) <= max_edits, F.when(out <= max_edits, out))

    chars = lambda x: F.when(F.length(x) > 0, F.split(x, "")).otherwise(F.array().cast("array<string>"))
    return let(chars(a), lambda p: let(chars(b), lambda t: distance(p, t)))


def _segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment i of a line cut into `parts`: the last ones take the rest."""
    base = F.floor(length / parts).cast("int")
    short = parts - length % parts  # segments without an extra character
    return F.lit(i) * base + F.greatest(F.lit(0), F.lit(i) - short), base + (F.lit(i) >= short).cast("int")


def _cells(length: Column, max_edits: int, min_chars: int) -> Column:
    """The nominal lengths a line is cut for: its own, rounded down, and those of lines up to max_edits shorter.
    Two lines within reach share that of the shorter one."""
    step = max(max_edits, 1, min(STEP, min_chars // 2))
    return F.array_distinct(F.array(*[(length - d) - (length - d) % step for d in range(max_edits + 1)]))


def _places(max_edits: int) -> list[tuple[int, int]]:
    """Piece and shift of each piece key."""
    places = []
    for i in range(max_edits + 1):
        most = min(i, max_edits - i)
        places += [(i, shift) for shift in range(0 if max_edits <= 2 else -most, most + 1)]
    return places


def _piece_keys(line: Column, length: Column, cell: Column, max_edits: int) -> Column:
    """One piece of max_edits + 1 is unchanged, with i edits before it if it is piece i. The first pieces keep
    their place from the start, the last ones from the end, up to a shift by the edits on that side. Of two
    lines either may be the shifted one, so up to 2 edits shifts to one side are enough."""
    keys = []
    for i, shift in _places(max_edits):
        at = F.floor(cell * i / (max_edits + 1)).cast("int")
        size = F.floor(cell * (i + 1) / (max_edits + 1)).cast("int") - at
        start = at if i <= max_edits - i else length - (cell - at)
        keys.append(F.xxhash64(cell, F.lit(i), F.substring(line, start + shift + 1, size)))
    return F.array(*keys)


def _rest_keys(line: Column, length: Column, cell: Column, place: Column, max_edits: int, parts: int) -> Column:
    """Everything outside max_edits (1 or 2) open pieces of `parts`. What is before the first open piece keeps
    its place from the start, what is after the last from the end; what is between two pieces with an edit each
    is shifted by at most one. Two edits in one piece leave all unchanged outside it and a neighbour.

    Only the keys that refine the piece key numbered `place`. Lines that agree up to the end of the first large
    piece share its key and need the open pieces behind it alone. Of the others, those that agree from the start
    of the last large piece share that key and need the open pieces before it. What is left has an edit in the first
    and one in the last, and between them a common middle piece, shifted as the rest between the edits is."""
    at, large = [F.floor(cell * i / parts).cast("int") for i in range(parts + 1)], parts // (max_edits + 1)
    keys = {x: [] for x in _places(max_edits)}
    for u in range(parts):
        for v in range(u + 1, parts) if max_edits == 2 else [u]:
            for shift in range(2 if v > u + 1 else 1):
                middle = [F.substring(line, at[u + 1] + shift + 1, at[v] - at[u + 1])] if v > u + 1 else []
                of = (0, 0) if u >= large else (max_edits, 0) if v < parts - large else (1, shift)
                keys[of].append(F.xxhash64(cell, F.lit(u), F.lit(v), F.substring(line, F.lit(1), at[u]), *middle,
                                           F.substring(line, length - (cell - at[v + 1]) + 1, cell - at[v + 1])))
    return F.coalesce(*[F.when(place == i, F.array(*x)) for i, x in enumerate(keys.values())])


def _bags(line: Column) -> Column:
    """How many characters fall in each of 21 classes (code point mod 21), 7 counts of 8 bits in each of three longs.
    Sums carry over exactly; of a line too long for 63 bits: null."""
    ones = [F.array(*[F.lit(1 << 8 * (r % 7) if r // 7 == k else 0).cast("long") for r in range(21)]) for k in range(3)]

    def counts(chars, k):
        return F.aggregate(chars, F.lit(0).cast("long"), lambda n, c: n + F.get(ones[k], F.ascii(c) % 21))

    return F.when(F.length(line) < BAG_CHARS, let(F.split(line, ""), lambda chars: F.array(*[counts(chars, k) for k in range(3)])))


def _bags_agree(a: Column, b: Column, max_edits: int) -> Column:
    """A necessary condition: an edit changes one count, or two by one in opposite directions."""
    apart = F.lit(0).cast("long")
    for k in range(3):
        shifted = F.get(a, F.lit(k)) - F.get(b, F.lit(k)) + sum(64 << 8 * i for i in range(7))
        for i in range(7):
            apart = apart + F.abs(F.shiftright(shifted, 8 * i).bitwiseAND(255) - 64)
    return F.coalesce(apart <= 2 * max_edits, F.lit(True))


def _candidates(long: DataFrame, max_edits: int, min_chars: int, passing: list[str]) -> DataFrame:
    """Pairs a < b that may be within reach, none within reach left out. `long`: h1, line, length.

    Lines that share a key meet. Where more than FEW share one, they are not paired but keyed again by finer
    pieces, of which all but max_edits must be unchanged, and paired only if their characters' counts agree.
    A line gets finer keys only in place of those of its keys that are crowded: a constant number for each.
    """
    of_line, found = [F.col("line"), F.col("length"), F.col("cell")], []
    celled = long.select("h1", "line", "length", F.explode(_cells(F.col("length"), max_edits, min_chars)).alias("cell"))
    keyed = celled.select("h1", "length", "cell", F.posexplode(_piece_keys(*of_line, max_edits)).alias("place", "key"))
    levels = [0, *([FINER] if max_edits in (1, 2) else [])]
    for parts in levels:
        carried = ["h1", "length", *(["bags"] if parts else [])]
        keys = settle(keyed, "line-keys", passing=passing)
        met = settle(keys.groupBy("key").agg(
            F.min("h1").alias("a"), F.max("h1").alias("b"), F.min("length").alias("low"), F.max("length").alias("high"),
            F.count("*").alias("n")).where("a < b"), "line-meetings", passing=passing)
        last = parts == levels[-1]
        found.append(met.where((F.col("n") == 2) & (F.col("high") - F.col("low") <= max_edits)).select("a", "b"))
        several = met.where((F.col("n") > 2) & (F.lit(last) | (F.col("n") <= FEW)))
        members = settle(keys.join(broadcast_if_small(several.select("key")), "key").select("key", *carried), "line-members", passing=passing)
        others = members.select("key", *[F.col(c).alias(f"{c}_2") for c in carried])
        near = (F.col("h1") < F.col("h1_2")) & (F.abs(F.col("length") - F.col("length_2")) <= max_edits)
        if parts:
            near = near & _bags_agree(F.col("bags"), F.col("bags_2"), max_edits)
        found.append(members.join(others, (members["key"] == others["key"]) & near).select(F.col("h1").alias("a"), F.col("h1_2").alias("b")))
        crowded = met.where(F.col("n") > FEW)
        if last or crowded.isEmpty():
            break
        again = settle(keys.join(broadcast_if_small(crowded.select("key")), "key").groupBy("h1").agg(
            F.collect_set(F.struct("cell", "place")).alias("crowded")), "line-again", passing=passing)
        rest = settle(long.select("h1", "line", "length").join(broadcast_if_small(again), "h1").withColumn("bags", _bags(F.col("line"))), "line-rest", passing=passing)
        keyed = rest.select(*rest.columns, F.inline("crowded")).select(
            "h1", "length", "bags", F.explode(_rest_keys(*of_line, F.col("place"), max_edits, FINER)).alias("key"))
    return settle(reduce(DataFrame.unionByName, found).distinct(), "line-pairs", passing=passing)


def _enough_pieces(a: Column, b: Column, max_edits: int) -> Column:
    """A cheap necessary condition: of 4 * max_edits pieces of a, an edit spoils at most one, and every
    other piece occurs in b at most max_edits positions away."""
    parts = max(4 * max_edits, 1)
    length, found = F.length(a), F.lit(0)
    for i in range(parts):
        start, size = _segment(length, i, parts)
        piece = F.substring(a, start + 1, size)
        near = F.lit(False)
        for shift in sorted(range(-max_edits, max_edits + 1), key=abs):
            at = start + shift
            near = near | ((at >= 0) & (F.substring(b, F.greatest(at, F.lit(0)) + 1, size) == piece))
        found = found + near.cast("int")
    return found >= parts - max_edits


def _ends_agree(a: Column, b: Column, max_edits: int) -> Column:
    """A necessary condition for 1 or 2 edits, far cheaper than the distance. Outside the common start and the
    common end of two lines the first characters differ and so do the last: an edit lies at either end of what
    is left, and between them the lines are equal."""
    most = F.least(F.length(a), F.length(b))
    steps = F.reverse(F.transform(F.sequence(F.lit(0), F.length(F.bin(most)) - 1), lambda i: F.pow(F.lit(2), i).cast("int")))

    def common(limit, part):  # the longest n <= limit with part(a, n) = part(b, n), bit by bit
        return F.aggregate(steps, F.lit(0), lambda n, step: F.when(
            (n + step <= limit) & (part(a, n, step) == part(b, n, step)), n + step).otherwise(n))

    def between(start, end):  # lengths of the common start and end
        cut = lambda x, front, back: F.substring(x, start + 1 + front, F.length(x) - start - end - front - back)
        left = lambda x: F.length(x) - start - end
        one = [(1, 1), (1, 0), (0, 1)]  # characters that an edit takes from a and from b
        fits = lambda x, y: (left(a) >= x) & (left(b) >= y)
        ways = F.lit(False)
        for x, y in one:
            if max_edits == 1:
                ways = ways | (fits(x, y) & (cut(a, x, 0) == cut(b, y, 0)))
            else:
                for x2, y2 in one:
                    ways = ways | (fits(x + x2, y + y2) & (cut(a, x, x2) == cut(b, y, y2)))
        return ways | (F.greatest(left(a), left(b)) <= max_edits)

    front = common(most, lambda x, n, step: F.substring(x, n + 1, step))
    return let(front, lambda start: let(
        common(most - start, lambda x, n, step: F.substring(x, F.length(x) - n - step + 1, step)),
        lambda end: between(start, end)))


def lines_of(docs: DataFrame) -> DataFrame:
    """One row per line that holds a word: doc_id, k1, k2 (the row's key), line_no (from 0), line, h1, h2."""
    keyed = docs.select("doc_id", *[c.alias(n) for c, n in zip(row_key(docs), ("k1", "k2"))],
                        F.posexplode(F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)).alias("line_no", "line"))
    return keyed.where(F.col("line").rlike(HAS_WORD)).withColumns(
        {"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(17), F.col("line"))})


def distinct_lines(lines: DataFrame) -> DataFrame:
    """One row per distinct line with its first occurrence (doc_id, k1, k2, line_no)."""
    first = F.struct("doc_id", "k1", "k2", "line_no", "line")
    return lines.groupBy("h1", "h2").agg(F.min(first).alias("first")).select("h1", "h2", "first.*")


def line_links(distinct: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, passing: list[str] | None = None) -> DataFrame:
    """All pairs a < b of distinct lines (by h1) of at least min_chars within max_edits, with their distance."""
    if min_chars <= max_edits:
        raise ValueError("min_chars must exceed max_edits")
    long = distinct.withColumn("length", F.length("line")).where(F.col("length") >= min_chars)
    pairs = _candidates(long, max_edits, min_chars, inner := [])
    # a bitmap of fixed size drops most lines without a pair before their texts are shuffled
    ends = pairs.select(F.explode(F.array("a", "b")).alias("session_id"))
    texts = maybe_in(long.select(F.col("h1").alias("session_id"), "line"), session_bitmap(ends)).withColumnRenamed("session_id", "h1")
    both = (pairs.join(texts.select(F.col("h1").alias("a"), F.col("line").alias("line_a")), "a")
            .join(texts.select(F.col("h1").alias("b"), F.col("line").alias("line_b")), "b")
            .where((_ends_agree if max_edits in (1, 2) else _enough_pieces)(F.col("line_a"), F.col("line_b"), max_edits)))
    links = settle(once(both, distance=banded_distance(F.col("line_a"), F.col("line_b"), max_edits))
                   .select("a", "b", "distance").where("distance is not null"), "line-links", passing=passing)
    discard(distinct.sparkSession, inner)
    return links


def line_classes(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, passing: list[str] | None = None) -> DataFrame:
    """One row per line that holds a word: doc_id, k1, k2, line_no, h1, first_doc_id, first_line_no (the
    occurrence of its class that stays), n_links (distinct other lines within reach), kept.

    A row of `docs` that is repeated in full counts once. Null and empty texts have no such line. A null
    doc_id comes first. Other columns take part only in telling rows apart. The result is read from tables whose
    folders are added to `passing`, if given.
    """
    lines = lines_of(docs)
    distinct = settle(distinct_lines(lines), "lines", passing=passing)
    links = line_links(distinct, max_edits, min_chars, passing)
    degree = (links.select(F.explode(F.array("a", "b")).alias("node"))
              .groupBy("node").agg(F.count("*").alias("n_links")))
    roots = connected_components(links)
    members = (distinct.drop("line")
               .join(roots.join(degree, "node"), F.col("h1") == F.col("node"), "left")
               .withColumn("root", F.coalesce("root", "h1")))
    firsts = (members.where("node is not null").groupBy("root")
              .agg(F.min(F.struct("doc_id", "k1", "k2", "line_no")).alias("lead")))
    classes = settle(members.join(firsts, "root", "left").select(
        "h1", "h2", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("lead", F.struct("doc_id", "k1", "k2", "line_no")).alias("lead")), "line-classes", passing=passing)
    return (lines.drop("line").distinct().join(classes, ["h1", "h2"])
            .select("doc_id", "k1", "k2", "line_no", "h1", F.col("lead.doc_id").alias("first_doc_id"),
                    F.col("lead.line_no").alias("first_line_no"), "n_links",
                    ((F.col("k1") == F.col("lead.k1")) & (F.col("k2") == F.col("lead.k2"))
                     & (F.col("line_no") == F.col("lead.line_no"))).alias("kept")))


def line_dedup(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """`docs` without the lines that are not their class's first. n_chars, if present, is counted anew.

    A document goes only if it had a line with a word and keeps none; texts without any such line, null
    texts included, stay as they are. Rows repeated in full become one.
    """
    passing = []
    marks = (line_classes(docs, max_edits, min_chars, passing).groupBy("k1", "k2")
             .agg(F.min("kept").alias("whole"), F.max("kept").alias("some"),
                  F.sort_array(F.collect_list(F.struct("line_no", "kept"))).alias("flags"))
             .where("not whole")
             .select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "some",
                     F.filter("flags", lambda x: ~x["kept"])["line_no"].alias("gone")))
    marks = settle(marks, "line-marks")
    discard(docs.sparkSession, passing)
    k1, k2 = row_key(docs)
    one = docs.select(*hidden(docs), F.inline(F.array(F.struct(F.col("text").alias("_text"), k1.alias("_a1"), k2.alias("_a2"))))
                      ).dropDuplicates(["_a1", "_a2"])
    joined = once(one.join(marks, (F.col("_a1") == F.col("_k1")) & (F.col("_a2") == F.col("_k2")), "left")
                  .where("some is null or some"), _left=_without(F.col("_text"), F.col("gone")))
    columns = {"text": F.when(F.col("gone").isNull(), F.col("_text")).otherwise(F.col("_left"))}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("gone").isNull(), F.col(f"_in{docs.columns.index('n_chars')}")).otherwise(
            F.length("_left").cast(docs.schema["n_chars"].dataType))
    return joined.select(*shown(docs, **columns))


def _without(text: Column, gone: Column) -> Column:
    """The text without the lines whose numbers are in the sorted array `gone`: the runs between them."""
    def runs(lines, cuts):
        return F.flatten(F.transform(F.slice(cuts, 1, F.size(cuts) - 1),
                                     lambda g, i: F.slice(lines, g + 2, F.get(cuts, i + 1) - g - 1)))

    return let(F.split(text, "\n", -1), lambda lines: let(
        F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines))), lambda cuts: F.array_join(runs(lines, cuts), "\n")))
