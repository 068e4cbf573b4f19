"""Resampling towards a target and decontamination against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from docloom.llm import crc, decontamination, resampling
from tests.llm.conftest import EDGES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id bigint, text string, lang string, score double, word string, row int, hits int"


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def make_docs(rows, data):
    return rows(DOCS, *[(*r, "en", 1.0, "w", 3, 4) for r in data]).repartition(3)


# Importance resampling ---------------------------------------------------------------------------


def test_crc_of_strings_and_of_joined_strings():
    rnd = random.Random(4)
    parts = [rnd.randbytes(rnd.choice([0, 1, 2, 7, 47, 48, 49, 300])) for _ in range(80)]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    single = crc.crc_of(data, starts, ends)
    assert single.tolist() == [zlib.crc32(p) for p in parts]
    join = crc.Joiner()
    joined = join(single[:-1], single[1:], (ends - starts)[1:])
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in zip(parts, parts[1:])]


def brute_resample(docs, target, longest, buckets, min_words, percent, seed):
    def features(text):
        words = words_of(text)
        return [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets
                for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for b in features(text):
            s[b] += 1
    for text in target:
        for b in features(text):
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (sum(s) + buckets) / ((s[b] + 1.0) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for doc, text in docs:
        own = features(text)
        weight, score = sum(gain[b] for b in own), None
        if doc is not None:
            h = int(hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(own), weight, score, len(words_of(text)) >= min_words])
    take = sum(r[4] for r in rows) * percent // 100
    drawn = sorted((r for r in rows if r[4] and r[0] is not None), key=lambda r: (-r[3], r[0], r[1], r[2]))[:take]
    place = {id(r): i for i, r in enumerate(drawn, 1)}
    return sorted((tuple(r[:4]) + (place.get(id(r)),) for r in rows), key=str)


@pytest.mark.parametrize("longest, buckets, head", [(1, 10_000, 65_536), (2, 97, 65_536), (2, 97, 0), (3, 300, 5)])
def test_resampling_equals_brute_force(rows, monkeypatch, longest, buckets, head):
    """Whatever the head holds: all words, a few, or none."""
    monkeypatch.setattr(resampling, "HEAD", head)
    rnd = random.Random(longest)
    words = ["the", "The", "été", "x-y", "a1", "ß", "w" * 60] + [f"w{i}" for i in range(120)]
    texts = [" ".join(rnd.choices(words, k=rnd.choice((1, 19, 20, 60)))) for _ in range(60)] + EDGES
    docs = [(100 - i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, None), (50, texts[1] + " the"), (50, texts[1] + " the")]
    target = [" ".join(rnd.choices(words[:40], k=30)) for _ in range(9)] + [None, ""]
    got = resampling.resample(make_docs(rows, docs), make_docs(rows, [(i, t) for i, t in enumerate(target)]),
                              longest, buckets, 20, 30, 7)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_resample(docs, target, longest, buckets, 20, 30, 7)


def test_resampling_of_empty_tables(rows):
    one = make_docs(rows, [(1, "a b c " * 10)])
    assert resampling.resample(one.limit(0), one).collect() == []
    got = resampling.resample(one, one.limit(0), percent=100).collect()
    assert [(r.n_features, r.rank) for r in got] == [(30, 1)]


# Decontamination ---------------------------------------------------------------------------------


def brute_hits(docs, items, size):
    windows = []
    for item, text in items:
        w = words_of(text)
        windows += [(item, w[i:i + size]) for i in range(max(len(w) - size + 1, 1))] if w else []
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for item, w in windows:
            for i in range(len(words) - len(w) + 1):
                if words[i:i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    found.add(item)
        found = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(words), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def leaks():
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(40)] + ["Straße", "ok"]
    items = [(i, " ".join(rnd.choices(words, k=rnd.choice((1, 2, 5, 12, 30))))) for i in range(12)]
    items += [(None, "null item with five words"), (3, items[5][1]), (99, None), (98, " .,; "), (97, items[4][1].upper())]
    docs = []
    known = [t for _, t in items if t]
    for i in range(40):
        body = " ".join(rnd.choices(words, k=25))
        docs.append((i, f"{body} -- {rnd.choice(known).replace(' ', ',  ')}! {body}" if i % 3 else body))
    docs += [(i + 100, t) for i, t in enumerate(EDGES)] + [(7, docs[1][1]), (None, docs[2][1]), (200, (known[4] + " x ") * 300)]
    return docs, items


@pytest.mark.parametrize("size, most", [(4, 1 << 17), (10, 20), (3, 1)])
def test_decontamination_equals_brute_force(rows, size, most):
    """Items shorter than a window, without id, repeated; one automaton, a few, and one for each window."""
    docs, items = leaks()
    if most == 1:
        items = items[:5]
    benchmark = rows("text string, item_id bigint, n int", *[(t, i, 1) for i, t in items])
    got = decontamination.decontaminate(make_docs(rows, docs), benchmark, size, most)
    assert sorted(map(tuple, got.collect()), key=str) == brute_hits(docs, items, size)


def test_hits_lead_back_to_the_original_text(rows):
    text = "Ünïcode – Before. The QUICK,brown\nfox: jümps over; THE quick\tbrown fox"
    item = "quick brown fox"
    benchmark = rows("item_id string, text string", ("q-1", item))
    row = decontamination.matches(make_docs(rows, [(1, text)]), benchmark, 3).collect()[0]
    assert [text[h.start:h.end] for h in row["hits"]] == ["QUICK", "brown", "fox", "quick", "brown", "fox"]
    assert [words_of(text)[h.word] for h in row["hits"]] == item.split() * 2 and row["items"] == ["q-1"]


def test_decontamination_of_empty_tables_and_long_texts(rows, monkeypatch):
    docs = make_docs(rows, [(1, "a b c"), (2, None)])
    benchmark = rows("item_id bigint, text string", (1, "b"))
    none = hashlib.sha256(b"").hexdigest()
    got = decontamination.decontaminate(docs, benchmark.limit(0)).collect()
    assert sorted(map(tuple, got)) == [(1, 3, 0, 0, none, False), (2, 0, 0, 0, none, False)]
    assert decontamination.decontaminate(docs.limit(0), benchmark).collect() == []
    monkeypatch.setattr(decontamination, "STEP", 64)
    words = [f"w{i % 997}x{i // 997}" for i in range(60_000)]
    item = " ".join(words[100:1_000])
    row = decontamination.decontaminate(make_docs(rows, [(1, " ".join(words) + " " + "y" * 3_000_000)]),
                                        rows("item_id bigint, text string", (1, item))).collect()[0]
    assert (row.n_words, row.n_hit, row.n_items) == (60_001, 900, 1)
