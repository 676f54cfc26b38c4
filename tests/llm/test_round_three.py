"""The prefix trie, the Jaccard join and ball k-means against brute force; edge cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from spotlattice.llm import ball_kmeans, ngram_join, prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- prefix trie


def rebuilt(rows, every=20, most=3):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        base = c - (abs(c) % every) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie(convs):
    nodes = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    below, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in nodes:
        if p:
            below[p[:-1]] += 1
    for p, members in nodes.items():
        worth = (len(members) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in below
            saved[p[:d]] += worth
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), below[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations():
    r = random.Random(7)

    def some(n, turns, words):
        return [(c, t, r.choice(["user", "assistant"]), " ".join(r.choice("abc") for _ in range(r.randrange(words)))) for c in range(n) for t in range(r.randrange(1, turns))]

    return {
        "random": some(400, 5, 3),
        "one in most": [(c, t, "user", f"same {t}") for c in range(300) for t in range(4)] + [(1000 + c, 0, "user", f"own {c}") for c in range(50)],
        "nested": [(20 * c + 3, t, "user", "x") for c in range(40) for t in range(c)],
        "nulls": [(1, None, None, None), (1, 2, "user", None), (1, 2, "assistant", "b"), (None, 1, "user", "lost"), (20, 1, None, "a b"), (21, 5, "user", ""), (-3, 0, "user", "q"), (0, 0, "user", "z")],
        "repeated rows": [(5, 0, "user", "a")] * 3 + [(6, 0, "user", "a")] * 2,
        "turnless": [(1, 0, "u", "x"), (21, 0, "u", "x")],
        "deep": [(40 * c, t, "user", f"{t}") for c in range(3) for t in range(600 + c)],
    }


@pytest.mark.parametrize("name", conversations())
@pytest.mark.parametrize("partitions", [1, 13])
def test_prefix_trie(spark, name, partitions):
    rows = conversations()[name]
    given = spark.createDataFrame([(*x, 1, "k") for x in rows], "conv_id long, turn long, role string, text string, depth int, kind string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = prefix_trie.prefix_trie(prefix_trie.branched(given, 20, 3)).select(*prefix_trie.NODE).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((tuple(r) for r in got), key=str) == trie(rebuilt(rows))


def test_prefix_trie_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(prefix_trie.branched(none, 20, 3)).collect() == []


def test_sweeps_give_the_same_parts_wherever_they_are_cut():
    r = random.Random(1)
    keys = sorted((b"".join(bytes([r.randrange(3)]) * 16 for _ in range(r.randrange(6))), i) for i in range(200))

    def total(cuts):
        nodes = defaultdict(lambda: [0, 0, 0, 0])
        closed = 0
        for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            left = prefix_trie.common_turns(keys[a - 1][0], keys[a][0]) if a else -1
            right = prefix_trie.common_turns(keys[b - 1][0], keys[b][0]) if b < len(keys) else -1
            s = prefix_trie.Sweep(0, left, right)
            for k, c in keys[a:b]:
                s.row(k, [2] * (len(k) // 16), c)
            s.end()
            for x in s.take():
                if x[0] == "s":
                    nodes[x[2]] = [p + q for p, q in zip(nodes[x[2]], x[7:11], strict=True)]
                elif x[0] in "nk":
                    closed += 1
                    nodes[("n", x[4], x[5])] = x[7:11]
        return sorted(map(tuple, nodes.values()))

    assert total([]) == total([50, 51, 120]) == total(sorted(r.sample(range(1, 200), 60)))


# ---- Jaccard join


def shingle_set(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components_of(data):
    sets = [shingle_set(t) for _, t in data]
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(data):
        p = find(i)
        low[p] = d if low.get(p) is None else low[p] if d is None else min(low[p], d)
    return sorted(((d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(data)), key=str)


def corpora():
    r = random.Random(3)

    def words(n, of=2000):
        return [f"w{r.randrange(of)}" for _ in range(n)]

    def edited(w, k):
        w = list(w)
        for _ in range(k):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        return w

    passage = words(60)
    base = words(150)
    family = [(1000 + i, " ".join(edited(base, r.randrange(4)))) for i in range(120)]
    chains = []
    for c in range(12):
        w = words(100)
        for i in range(8):
            chains.append((2000 + 10 * c + i, " ".join(w)))
            w = edited(w, 2)
    odd = [(0, None), (1, ""), (2, " \t\n"), (3, "a"), (4, "A"), (5, "a b c d"), (6, "a b c d e"), (7, "a  b\x0bc D\x1fe"), (None, "a b c d e"), (8, "É a b c d"), (8, "é a b c d"), (9, "x\x00y"), (9, "x\x00y")]
    return {
        "family": family + chains + [(3000 + i, " ".join(words(80))) for i in range(100)],
        "common passage": [(i, " ".join(words(r.randrange(1, 30)) + passage + words(r.randrange(1, 30)))) for i in range(150)] + [(500 + i, " ".join(passage + words(i % 9))) for i in range(60)],
        "few words": [(i, " ".join(f"w{r.randrange(3)}" for _ in range(r.randrange(8)))) for i in range(300)],
        "odd": odd,
        "copies": [(i, " ".join(base)) for i in range(200)] + [(300, " ".join(base[:140])), (301, " ".join(base[:100]))],
        "long": [(1, " ".join(base * 2000)), (2, " ".join(base * 1999)), (3, "w" * 3_000_000), (4, "w" * 3_000_000 + " b"), (5, " ".join(words(60_000, 10**6)))],
        "empty": [],
    }


@pytest.mark.parametrize("name", corpora())
@pytest.mark.parametrize("block", [512, 16])
def test_jaccard_components(spark, name, block):
    data = corpora()[name]
    given = spark.createDataFrame([(d, t, 1, "x") for d, t in data], "doc_id long, text string, n int, digest string")
    s = ngram_join.Settings(block=block, block_shingles=4000 if block < 512 else 1 << 20, leaf=4, fanout=3)
    got = ngram_join.jaccard_components(given, settings=s).collect()
    assert sorted((tuple(r) for r in got), key=str) == components_of(data)


def test_every_link_is_kept_by_trees():
    r = np.random.default_rng(5)
    pool = r.integers(1, 2**63, 4000).astype(np.uint64)
    sets = []
    for _ in range(60):
        base = r.choice(pool, r.integers(5, 200), replace=False)
        for _ in range(r.integers(1, 6)):
            keep = r.random(len(base)) > 0.06
            sets.append(np.unique(np.concatenate([base[keep][:1], base[keep], r.choice(pool, r.integers(0, 6))])))

    def classes(n, links):
        root = list(range(n))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            root[find(a)] = find(b)
        return [min(j for j in range(n) if find(j) == find(i)) for i in range(n)]

    s = ngram_join.Settings(leaf=3, fanout=2)
    n = len(sets)
    want = [(i, j) for i in range(n) for j in range(i) if ngram_join.linked(sets[i], sets[j], 80)]
    assert classes(n, ngram_join.joined(sets, None, s)) == classes(n, want)
    half = n // 3
    crossed = [(i, half + j) for i, j in ngram_join.joined(sets[:half], sets[half:], s)]
    assert classes(n, crossed) == classes(n, [(i, j) for i, j in want if (i < half) != (j < half)])


def test_trees_leave_pairs_out(monkeypatch):
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(1, 2**63, 200).astype(np.uint64)) for _ in range(256)]
    seen = []
    real = ngram_join.linked
    monkeypatch.setattr(ngram_join, "linked", lambda x, y, p: (seen.append(1), real(x, y, p))[1])
    assert ngram_join.joined(sets, None, ngram_join.Settings()) == [] and seen == []


# ---- ball k-means


def kmeans(data, k, rounds, seed="2"):
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in data if v is not None and len(v) == 4 and all(x is not None and np.isfinite(x) for x in v)]
    kept = [(i, [max(-(1 << 25), min(1 << 25, x)) for x in v]) for i, v in kept]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [v for _, v in start]

    def assign():
        out = []
        for _, v in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), j) for j, m in enumerate(c)))
        return out

    for _ in range(rounds):
        a = assign()
        for j in range(len(c)):
            own = [v for (_, v), (_, i) in zip(kept, a, strict=True) if i == j]
            if own:
                c[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    a = assign()
    per = defaultdict(int)
    for d, j in a:
        per[j] += d
    every = sum(d for d, _ in a)
    return sorted(((i, j, d, per[j], every, hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for (i, _), (d, j) in zip(kept, a, strict=True)), key=str)


def vector_sets():
    r = random.Random(4)
    return {
        "spread": [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(500)],
        "clusters": [(i, [r.gauss(5 * (i % 9), 0.2) for _ in range(4)]) for i in range(400)],
        "ties": [(i, [float(i % 5), float(i % 3), 0.0, 0.0]) for i in range(300)],
        "one common vector": [(i, [1.0, 1.0, 1.0, 1.0] if i % 3 else [r.random() for _ in range(4)]) for i in range(300)],
        "odd": [(1, None), (2, [1.0]), (3, [1.0, None, 1.0, 1.0]), (4, [float("nan"), 0.0, 0.0, 0.0]), (None, [0.5, 0.5, 0.5, 0.5]), (5, [3e4, -3e4, 0.0, 0.0]), (6, [0.0] * 4), (6, [0.0] * 4), (7, [1e30, 0.0, 0.0, 0.0])],
        "few": [(1, [0.1, 0.2, 0.3, 0.4])],
        "empty": [],
    }


@pytest.mark.parametrize("name", vector_sets())
def test_ball_kmeans(spark, name):
    data = vector_sets()[name]
    given = spark.createDataFrame([(i, v, 1, 2) for i, v in data], "vec_id long, embedding array<float>, cluster int, d2 int")
    got = ball_kmeans.ball_kmeans(given, ball_kmeans.Settings(components=4, clusters=7, rounds=3)).collect()
    assert sorted((tuple(r) for r in got), key=str) == kmeans(data, 7, 3)


def test_balls_compare_few_and_agree():
    r = np.random.default_rng(1)
    x = np.concatenate([r.normal(100 * (i + 1), 3, (200, 8)) for i in range(10)]).astype(np.int64)
    c = np.stack([x[200 * i] for i in range(10)])
    first, d2 = ball_kmeans.Balls(c, None).first(x)
    moved = np.stack([x[first == i].mean(0).astype(np.int64) if (first == i).any() else c[i] for i in range(10)])
    radii = np.array([np.sqrt(d2[first == i].max(initial=0)) for i in range(10)]) + np.sqrt(((moved - c) ** 2).sum(1))
    best, own, compared = ball_kmeans.Balls(moved, radii).again(x, first)
    want, far = ball_kmeans.Balls(moved, None).first(x)
    assert (best == want).all() and (own == far).all() and compared < len(x)
