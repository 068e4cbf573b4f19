import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import jaccard, topk
from tests.llm.conftest import EDGES

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_components(rows):
    sets = []
    for doc, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} if words else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc)
    return [(doc, len(s), min(least[find(i)])) for i, ((doc, _), s) in enumerate(zip(rows, sets))]


def near_copies(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    common = [rnd.choice(words) for _ in range(30)]
    rows = []
    for k in range(25):
        base = [rnd.choice(words) for _ in range(rnd.randint(3, 80))]
        base += common if k % 2 else []
        for _ in range(rnd.randint(1, 6)):
            own = list(base)
            for _ in range(rnd.randint(0, max(1, len(own) // 25))):
                own[rnd.randrange(len(own))] = rnd.choice(words)
            rows.append(" ".join(own))
    return rows


@pytest.mark.parametrize("short", [128, 2])
def test_components_equal_brute_force(docs, monkeypatch, short):
    texts = [*near_copies(short), *EDGES, "A b", "a B"]
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    got = sorted(tuple(r) for r in jaccard.join(docs(rows)).collect())
    assert got == sorted(brute_components(rows))


def test_lists_short_and_long_give_all_cross_pairs():
    """Pairs of one list whose sizes and places can link, whether a list is short or read by blocks."""
    rnd = np.random.default_rng(1)
    token = np.sort(rnd.integers(0, 4, 900))
    size, group, place = rnd.integers(50, 90, 900), rnd.integers(0, 40, 900), rnd.integers(0, 18, 900)
    order = np.lexsort((size, token))
    size, group, place = size[order], group[order], place[order]
    group[token == 2] = 7
    got = [(a, b) for x, y in jaccard.pairs_of_lists(token, size, group, place) for a, b in zip(x.tolist(), y.tolist())]

    def can_link(i, j):
        most = min(place[i], place[j]) + 1 + min(size[i] - place[i] - 1, size[j] - place[j] - 1)
        return 100 * size[i] >= 80 * size[j] and 180 * most >= 80 * (size[i] + size[j])

    want = {(i, j) for j in range(900) for i in range(j) if token[i] == token[j] and group[i] != group[j] and can_link(i, j)}
    assert len(got) == len(set(got)) and set(got) == want


def test_signatures_rule_out_no_link():
    rnd = np.random.default_rng(5)
    ruled_out = 0
    for n in (1, 3, 60, 500, 3000):
        for share in (0.99, 0.9, 0.85, 0.6, 0.2):
            base = np.unique(rnd.integers(0, 1 << 62, n).astype(np.uint64))
            kept = base[rnd.random(len(base)) < share]
            other = np.unique(np.concatenate([kept, rnd.integers(0, 1 << 62, int(n * (1 - share) * rnd.random())).astype(np.uint64)]))
            may = jaccard.may_link(jaccard.signature(base), len(base), jaccard.signature(other), len(other))
            assert may or not (len(other) and jaccard.similar(base, other))
            ruled_out += not may
    assert ruled_out >= 8


def test_folded_signatures_rule_out_no_link_and_most_of_a_family():
    """Pairs of a family that do not link end in the bucket where they meet."""
    rnd = np.random.default_rng(11)
    base = np.unique(rnd.integers(0, 1 << 62, 400).astype(np.uint64))
    for share, fewest, most in ((0.97, 1.0, 1.0), (0.8, 0.0, 0.05)):
        sets = [np.unique(np.concatenate([base[rnd.random(len(base)) < share],
                                          rnd.integers(0, 1 << 62, int(400 * (1 - share))).astype(np.uint64)])) for _ in range(40)]
        sets += [np.arange(0, dtype=np.uint64), base[:3]]
        n, mark = np.array([len(x) for x in sets], np.int32), jaccard.folded([jaccard.signature(x) for x in sets])
        a, b = np.triu_indices(len(sets), 1)
        kept = jaccard.unruled(n, mark, a, b)
        assert all(k or not jaccard.similar(sets[i], sets[j]) for i, j, k in zip(a, b, kept) if n[i] and n[j])
        family = (a < 40) & (b < 40)
        assert fewest <= kept[family].mean() <= most


@pytest.mark.parametrize("held", [50, 1_000_000])
def test_family_of_which_few_link(docs, monkeypatch, held):
    """Pairs leave a bucket only with their share; those counted in parts leave it as they are."""
    monkeypatch.setattr(jaccard, "PAIRS_HELD", held)
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        own = list(base)
        for k in rnd.sample(range(300), 13):
            own[k] = f"x{i}.{k}"
        rows.append((i, " ".join(own)))
    rows.append((99, rows[7][1] + " end"))
    assert sorted(tuple(r) for r in jaccard.join(docs(rows)).collect()) == sorted(brute_components(rows))


def test_linked_prefixes_share_the_least_common():
    rnd = np.random.default_rng(8)
    none = np.empty(0, np.int64), np.empty(0, np.int8)
    for _ in range(300):
        a = np.unique(rnd.integers(0, 1 << 62, rnd.integers(2, 200)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rnd.random(len(a)) < 0.93], rnd.integers(0, 1 << 62, rnd.integers(0, 9)).astype(np.uint64)]))
        if len(b) and jaccard.similar(a, b):
            common = np.intersect1d(jaccard.prefix(a, *none, 8), jaccard.prefix(b, *none, 8))
            assert len(common) >= jaccard.least_common(np.array([len(a)]), np.array([len(b)]))[0]


def test_one_sequence_in_half_of_all_sets(docs):
    """A passage that half of the texts share, most of them in their prefix too."""
    rnd = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [f"{passage} " + " ".join(rnd.choice("abcdefgh") + str(rnd.randrange(50)) for _ in range(rnd.choice((2, 6, 14)))) for _ in range(150)]
    texts += [" ".join(f"u{rnd.randrange(900)}" for _ in range(50)) for _ in range(150)]
    rows = list(enumerate(texts))
    assert sorted(tuple(r) for r in jaccard.join(docs(rows)).collect()) == sorted(brute_components(rows))


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_many_small_parts_give_the_same(docs, monkeypatch, few):
    """Pairs sent on in parts, sides joined by shuffle."""
    monkeypatch.setattr(jaccard, "PAIRS_HELD", 3)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", few)
    rows = list(enumerate(near_copies(9)))
    assert sorted(tuple(r) for r in jaccard.join(docs(rows)).collect()) == sorted(brute_components(rows))


def test_links_the_hubs_miss_come_from_the_index(docs, monkeypatch):
    # With one constant min-hash nothing groups sensibly; the index must still find every link.
    monkeypatch.setattr(jaccard, "verified", lambda d, r, p, real=jaccard.verified, seen=[]: (
        seen.append(1), real(d, r, p.limit(0)) if len(seen) == 1 else real(d, r, p))[1])
    rows = list(enumerate(near_copies(9)))
    assert sorted(tuple(r) for r in jaccard.join(docs(rows)).collect()) == sorted(brute_components(rows))


def test_repeated_and_missing_ids_and_empty_table(docs, prose):
    text = prose(1, 60)
    rows = [(5, text), (5, text), (3, text + " end"), (None, text), (9, prose(2, 60)), (9, prose(3, 60))]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in jaccard.join(docs(rows)).collect())
    assert got == [(False, 3, 3), (False, 5, 3), (False, 5, 3), (False, 9, 9), (False, 9, 9), (True, 0, 3)]
    assert jaccard.join(docs([])).count() == 0


def test_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "hub bigint, doc bigint")
    got = {r.node: r.root for r in jaccard.components(edges, "hub", "doc").collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def brute_top(rows, k):
    sound = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            q = tuple(int(np.floor(64 * np.float64(np.float32(x)))) for x in v)
            sound[i] = max(sound.get(i, q), q)
    out = []
    for i in sorted(sound):
        if i % 5 == 0:
            scored = sorted((-sum(a * b for a, b in zip(sound[i], v)), j) for j, v in sound.items()
                            if j != i and len(v) == len(sound[i]))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return out


@pytest.mark.parametrize("block, queries", [(4096, 512), (16, 7)])
def test_top_k_equals_brute_force(spark, block, queries):
    rnd = random.Random(7)
    rows = [(i, [rnd.gauss(0, 0.2) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(40)]  # ties
    rows += [(300, None), (None, [1.0] * 6), (305, [None] + [1.0] * 5), (310, [float("nan")] * 6), (315, [float("inf")] * 6),
             (320, [0.0] * 6), (325, []), (330, [0.5, 0.5]), (335, [0.5, -0.5]), (5, rows[9][1]), (10, rows[10][1])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit(1))
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=4, block_rows=block, block_queries=queries)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute_top(rows, 4))
    assert topk.top_k(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_threshold_stops_early():
    rnd = np.random.default_rng(3)
    vectors = rnd.integers(0, 3, (2000, 3))
    vectors[:30] = 60
    block = topk.Block(np.arange(2000), vectors)
    ids, scores, depth = block.top(np.array([1, 1, 1]), 20, None, 0)
    assert ids.tolist() == list(range(1, 21)) and set(scores) == {180} and depth < 2000
