"""Near duplicates: rare-shingle keys against all pairs, samples of long texts, groups without a common text."""

import random

import numpy as np

from clickscope.llm import minhash_dedup as M


def _keys(h, weight, rarity):
    """All keys of a set, and those by which larger sets find it."""
    every, found = set(), set()
    for shingle, low, high, own in zip(*M.rare_prefix(h, weight, rarity, 0.8)):
        every |= {(int(shingle), level) for level in range(low, high + 1)}
        found |= {(int(shingle), own)} if own >= 0 else set()
    return every, found


def test_rare_keys_find_every_pair_within_reach():
    rng = np.random.default_rng(3)
    rarity = rng.random(1 << M.FEATURE_BITS, dtype=np.float32)
    weights, near, met, apart = M.feature_weights(rarity), 0, 0, 0
    for size in (1, 2, 5, 9, 40, 150):
        for _ in range(60):
            base = rng.integers(1, 1 << 62, size).astype(np.uint64)
            sets = []
            for _ in range(4):
                keep = base[rng.random(size) > rng.choice([0, 0.04, 0.1, 0.2])]
                own = rng.integers(1, 1 << 62, rng.integers(0, 2 + size // 8)).astype(np.uint64)
                h = np.unique(np.concatenate([keep, own]))
                if len(h):
                    count = rng.choice([1, 1, 1, 1, 2, 7], len(h)) if rng.random() < 0.3 else 1
                    sets.append((h, (count * weights[(h & np.uint64((1 << M.FEATURE_BITS) - 1)).astype(np.int64)]).astype(np.float32)))
            for i, a in enumerate(sets):
                for b in sets[:i]:
                    for x, y in (a, b), ((a[0], np.ones(len(a[0]))), (b[0], np.ones(len(b[0])))):
                        j = M.weighted_jaccard(x, y)
                        (k, f), (m, g) = _keys(*x, rarity), _keys(*y, rarity)
                        share = bool(k & g or f & m)
                        assert share or j < 0.8
                        near, met, apart = near + (j >= 0.8), met + (share and j < 0.8), apart + (j < 0.8)
    assert near > 300 and met < 0.6 * apart


def test_texts_with_much_of_their_own_never_meet():
    """Of 200 sets that share 100 shingles and hold 15 to 20 of their own, no two share a key."""
    rng = np.random.default_rng(4)
    rarity = np.ones(1 << M.FEATURE_BITS, np.float32)
    base = rng.integers(1, 1 << 62, 100).astype(np.uint64)
    rarity[(base & np.uint64((1 << M.FEATURE_BITS) - 1)).astype(np.int64)] = 0.1
    seen, found = {}, {}
    for i in range(200):
        own = rng.integers(1, 1 << 62, rng.integers(15, 21)).astype(np.uint64)
        h = np.concatenate([base, own])
        every, mine = _keys(h, np.ones(len(h)), rarity)
        for key in every:
            seen.setdefault(key, set()).add(i)
        for key in mine:
            found.setdefault(key, set()).add(i)
    assert not any(seen[key] - {i} for key, some in found.items() for i in some)


def test_samples_of_long_texts():
    """Beyond the rows of the table of variates, samples agree as often as the sets are alike."""
    rng = np.random.default_rng(5)
    sampler, agree, true = M.Sampler(), [], []
    for part in (0.05, 0.1, 0.2):
        for _ in range(6):
            both = M.mix(np.arange(150_000 * len(true), 150_000 * (len(true) + 1), dtype=np.uint64) + np.uint64(1 << 40))
            own = rng.random(len(both)) < part
            sets = [np.sort(np.where(own, M.mix(both ^ np.uint64(k)), both)) for k in (1, 2)]
            weight = [M.IDF[(s % np.uint64(3)).astype(np.int64)] for s in sets]
            true.append(M.weighted_jaccard(*zip(sets, weight)))
            agree.append((sampler.draw(sets[0], weight[0])[1] == sampler.draw(sets[1], weight[1])[1]).mean())
    assert abs(np.mean(agree) - np.mean(true)) < 0.04


def test_large_group_without_its_common_text(spark):
    """Texts that differ from a common one, absent itself, in one or in four places: classes are those of all pairs."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(120):
        text = list(base)
        for at in rng.sample(range(5, 145), 1 if i % 3 else 4):
            text[at] = f"own{i}x{at}"
        rows.append((i, " ".join(text)))
    rows += [(500 + i, " ".join(f"v{rng.randrange(10**6)}" for _ in range(80))) for i in range(200)]
    got = {r["doc_id"]: r["class_id"] for r in M.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for i, t in rows for w in [t.split()]}
    want = {i: i for i in sets}
    for a in range(120):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared >= 0.8 * (len(sets[a]) + len(sets[b]) - shared):
                low, high = sorted((want[a], want[b]))
                want = {i: low if c == high else c for i, c in want.items()}
    assert got == want
