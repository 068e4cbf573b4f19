import random
import re
from itertools import permutations

import numpy as np
import pytest

from docloom.llm import interactions
from tests.llm.conftest import EDGES

WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id bigint, text string, lang string, failing array<int>, n int, d0 string"
LABELS = "doc_id bigint, quality int, toxic int, part string"


def brute(rows, labels, order):
    """(part, step) to counts, document by document."""
    texts = [(d, t or "", p or "") for d, t, p in rows]
    failing = []
    for d, t, _ in texts:
        words = WORD.findall(t)
        failing.append({
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": any(c in "#$%&*|" for c in t),
            "E": d is not None and any(o is not None and o < d and u == t for o, u, _ in texts)})
    good = {d for d, q, x in labels if d is not None and q == 1}
    toxic = {d for d, q, x in labels if d is not None and x == 1}
    out = {}
    for part in {p for _, _, p in texts}:
        left = [i for i, t in enumerate(texts) if t[2] == part]
        size, gone = len(left), []
        for step, f in enumerate(order, 1):
            removed = [i for i in left if failing[i][f]]
            redundant = sum(failing[i][f] for i in gone)
            only = sum(failing[i][f] and sum(failing[i].values()) == 1 for i in left + gone)
            left = [i for i in left if not failing[i][f]]
            gone += removed
            out[part, step] = (len(left), len(removed), redundant, only,
                               sum(texts[i][0] in good for i in removed), sum(texts[i][0] in toxic for i in removed))
            assert len(left) + len(gone) == size
    return out


def table(seed):
    rnd = random.Random(seed)
    words = ["ab", "AB", "x#y", "long", "Ünï", "q", "The"] + [f"w{i}" for i in range(300)]
    texts = [" ".join(rnd.choices(words[rnd.choice((0, 7)):], k=rnd.choice((3, 99, 100, 160)))) for _ in range(25)] + EDGES
    rows = [(rnd.choice([None, *range(60)]), rnd.choice(texts), rnd.choice(["en", "de", None])) for _ in range(140)]
    rows += [rows[0]] * 5 + [(None, texts[0], "en")] * 3 + [(7, t, "de") for t in texts[:4]]
    labels = [(rnd.choice([None, *range(70)]), rnd.choice([0, 1, None]), rnd.choice([0, 1])) for _ in range(50)]
    return rows, labels


@pytest.mark.parametrize("seed, span", [(1, 1 << 16), (2, 3)])
def test_every_order_equals_document_by_document(rows, monkeypatch, seed, span):
    """Nulls in every column, repeated rows, ids over different texts, labels given twice."""
    monkeypatch.setattr(interactions, "SPAN", span)
    data, labels = table(seed)
    got = interactions.audit(rows(DOCS, *[(*r, [1], 2, "z") for r in data]).repartition(3),
                             rows(LABELS, *[(*r, "p") for r in labels])).collect()
    assert len(got) == 3 * 600
    found = {}
    for r in got:
        found.setdefault(r.filter_order, {})[r.part, r.step] = tuple(r[3:9])
    orders = ["".join(p) for p in permutations("ABCDE")]
    assert sorted(found) == orders
    want = {o: brute(data, labels, o) for o in orders}
    assert found == want
    for r in got:
        assert r.shapley == sum(want[o][r.part, o.index(r.filter_order[r.step - 1]) + 1][1] for o in orders)


def test_ranges_hold_sorted_lists_of_their_ids(rows, monkeypatch):
    monkeypatch.setattr(interactions, "SPAN", 7)
    data = [(i, "word " * (90 + i), "en" if i % 3 else "de") for i in range(40)]
    lists = interactions.posting_lists(rows(DOCS, *[(*r, [1], 2, "z") for r in data]), rows(LABELS, (3, 1, 0, "p"))).collect()
    assert sorted(d for r in lists for d in r.ids) == list(range(40)) and max(len(r.ids) for r in lists) == 7
    short = [r.ids[i] for r in lists for i in r.failing[0]]
    assert sorted(short) == list(range(10))
    assert [r.ids[i] for r in lists for i in r.good] == [3]
    assert all(list(x) == sorted(x) for r in lists for x in r.failing)


def test_merges_equal_sets():
    rnd = np.random.default_rng(3)
    for _ in range(60):
        lists = [np.unique(rnd.integers(0, 200, rnd.integers(0, n))).astype(np.int32) for n in (2, 5, 90, 400)]
        sets = [set(x.tolist()) for x in lists]
        assert interactions.union(lists).tolist() == sorted(set().union(*sets))
        for a, x in zip(lists, sets):
            for b, y in zip(lists, sets):
                assert interactions.difference(a, b).tolist() == sorted(x - y)
                assert interactions.common(a, b).tolist() == sorted(x & y)


def test_empty_tables(rows):
    none, unlabelled = rows(DOCS, (1, "a", "en", [1], 2, "z")).limit(0), rows(LABELS, (1, 1, 1, "p")).limit(0)
    assert interactions.audit(none, unlabelled).collect() == []
    got = interactions.audit(rows(DOCS, (1, None, None, [1], 2, "z")), unlabelled).collect()
    assert len(got) == 600 and {(r.part, r.good_lost) for r in got} == {("", 0)}
    assert {(r.removed, r.shapley) for r in got if r.filter_order[r.step - 1] == "A"} == {(1, 120)}


def test_more_parts_than_a_task_holds(rows):
    data = [(i, "Word", f"l{i % 30}") for i in range(90)]
    df = rows(DOCS, *[(*r, [1], 2, "z") for r in data])
    lists = interactions.posting_lists(df, rows(LABELS, (1, 1, 1, "p")))
    few, many = (sorted((r.part, sorted(r.cells.items())) for r in interactions.added_sizes(lists, n).collect()) for n in (2, 1000))
    assert few == many and len(few) == 30
