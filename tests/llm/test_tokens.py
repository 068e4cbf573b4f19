import hashlib
import random
from itertools import chain
import zlib

import numpy as np
import pytest

from docloom.llm import bpe_codec, packing, token_counts, tokens
from tests.llm.conftest import EDGES

PIECES = ["a", "b", "the", " ", "  ", "\n", "\n\n", "'s", "'re", "'", "v", "e", "<|endoftext|>", "<|", "endoftext|>",
          "1", "23", "!", "?", "é", "日本", "😀", "́", "\t", "   ", " x", "ß", "\xa0", "'ll", "|"]


def jumble(rnd, n):
    pool = rnd.sample(PIECES, rnd.randint(2, len(PIECES)))
    return "".join(rnd.choice(pool) for _ in range(n))


@pytest.fixture(scope="module")
def library():
    return tokens.load(token_counts.VOCABULARY)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_spliced_counts_equal_whole_counts(library):
    rnd = random.Random(1)
    for _ in range(250):
        text = jumble(rnd, rnd.randint(60, 300))
        chunk = rnd.choice([40, 64, 100])
        if len(text) > chunk:
            assert token_counts.count_spliced(library, text, chunk, rnd.choice([4, 8, 20])) == len(ids_of(library, text))


def test_joined_chunks_equal_whole_texts(library, monkeypatch):
    rnd = random.Random(2)
    monkeypatch.setattr(bpe_codec, "MASK", np.uint64(7))
    for _ in range(250):
        least, most, reach = rnd.choice([(1, 30, 2), (5, 40, 4), (10, 60, 8)])
        monkeypatch.setattr(bpe_codec, "LEAST", least)
        monkeypatch.setattr(bpe_codec, "MOST", most)
        monkeypatch.setattr(bpe_codec, "REACH", reach)
        text = jumble(rnd, rnd.randint(1, 200))
        assert bpe_codec.Coder(library).encode_batch([text.encode()])[0].tolist() == ids_of(library, text)


def test_a_chunk_is_encoded_once_and_shared_passages_share_chunks(library, prose):
    passage = prose(1, 4000)
    coder = bpe_codec.Coder(library)
    coder.encode_batch([(prose(2, 50) + " " + passage).encode()])
    first = coder.made
    coder.encode_batch([(prose(3, 90) + " " + passage).encode()])
    assert coder.made - first <= 3 < first
    small = bpe_codec.Coder(library, kept_bytes=1)
    assert [x.tolist() for x in small.encode_batch([b"a b", b"c"])] == [ids_of(library, "a b"), ids_of(library, "c")]


def test_counts_and_codec_on_edge_rows(spark, docs, library, prose):
    texts = [*EDGES, "a <|endoftext|> b", prose(4, 9000), prose(5, 30), prose(5, 30)]
    counted = {r.doc_id: r for r in token_counts.token_counts(docs(texts)).collect()}
    coded = {r.doc_id: r for r in bpe_codec.encode_decode(docs(texts), keep_ids=True).collect()}
    assert len(counted) == len(coded) == len(texts)
    for i, text in enumerate(texts):
        ids = ids_of(library, text)
        assert (counted[i].n_bytes, counted[i].n_tokens, counted[i].over_limit) == \
            (len((text or "").encode()), len(ids), len(ids) > 1024)
        assert coded[i].ids == ids and coded[i].n_tokens == len(ids)
        assert coded[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert coded[i].decoded == back == (text or "")
        assert coded[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_empty_tables(docs):
    none = docs([])
    assert token_counts.token_counts(none).count() == bpe_codec.encode_decode(none).count() == packing.pack(none).count() == 0


def test_word_coder_equals_the_library():
    library, rnd = tokens.load(packing.VOCABULARY), random.Random(3)
    latin = [chr(c) for c in range(0x250)]
    texts = ["".join(rnd.choice(rnd.sample(latin, 12) + ["a", "b", " ", "'s", "'re", "E", "1"]) for _ in range(40))
             for _ in range(300)] + ["".join(latin), " ".join(latin), "<|endoftext|> a", "日本 語", "é x", ""]
    for kept in (10, 10_000):
        coder = packing.WordCoder(library, kept_words=kept)
        for text, raw in zip(texts, coder.encode_batch(texts)):
            assert np.frombuffer(raw, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_word_coder_keeps_words_that_return_and_no_more_than_two_lots():
    library, rnd = tokens.load(packing.VOCABULARY), random.Random(4)
    coder = packing.WordCoder(library, kept_words=50)
    for _ in range(40):
        words = ["often", "again,", "It's", *("".join(rnd.choice("aeioubc.,'") for _ in range(6)) for _ in range(20))]
        assert np.frombuffer(coder.encode_batch([" ".join(words)])[0], "<u4").tolist() == ids_of(library, " ".join(words))
        assert {"often", "again,", "it's"} <= coder.words.keys()
        assert len(coder.words) + len(coder.older) < 2 * (50 + 200)


def test_word_coder_looks_up_distinct_words_and_cuts_parts_like_the_library():
    library, rnd = tokens.load(packing.VOCABULARY), random.Random(7)
    coder = packing.WordCoder(library, kept_words=200, kept_parts=100)
    whole = []
    coder.library = lambda texts, own=coder.library: whole.extend(texts) or own(texts)
    signs = [*"aestrvmld''\"!.,12\u00b2\u00bd\u00d7\u00c9\u00df\u0101\x00\x7f \n\t", "'s", "'re", "'ve", "'ll", "'t", "'d", "'"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(50))) for _ in range(3000)] + ["", " ", "'", "'llama's''re"]
    for k in range(0, len(texts), 100):
        for text, raw in zip(texts[k:k + 100], coder.encode_batch(texts[k:k + 100])):
            assert np.frombuffer(raw, "<u4").tolist() == ids_of(library, text)
    assert not whole  # parts need the model alone
    odd = ["\u0130a b", "a\u023a", "a\x1cb", "a\u2003b", "\u65e5", "a <|endoftext|>"]
    assert coder.encode_batch(["a", *odd, "b"])[1:-1] == [np.array(ids_of(library, t), "<u4").tobytes() for t in odd]
    assert whole == odd
    for c in map(chr, range(0x1C, 0x300)):
        ok = packing.PLAIN.fullmatch(c) is not None
        assert packing.all_plain(c) == ok and (not ok or len(c.lower()) == 1 and len(c.lower().encode()) <= 2)


def test_token_bytes_decode_like_the_library(library):
    decoder, rnd = bpe_codec.Decoder(library), random.Random(5)
    size = library.get_vocab_size()
    ids = [[i] for i in range(0, size, 97)] + [[rnd.randrange(size) for _ in range(30)] for _ in range(300)] + [[]]
    ids += [ids_of(library, t) for t in ("<|endoftext|> é", "日本😀", "\x00\x7f\xad\xa0")]
    assert decoder.decode_batch(ids) == library.decode_batch(ids, skip_special_tokens=False)
    words = tokens.load(packing.VOCABULARY)
    assert bpe_codec.token_bytes(words) is None
    assert bpe_codec.Decoder(words).decode_batch([ids_of(words, "some words")]) == [words.decode(ids_of(words, "some words"))]


def test_units_that_return_are_encoded_once(library):
    coder, rnd = bpe_codec.Coder(library, kept_units=40), random.Random(8)
    encoded = []

    class Library:
        def encode_batch_fast(self, texts, **rest):
            encoded.extend(chain.from_iterable(t.split("\n") for t in texts))
            return library.encode_batch_fast(texts, **rest)

        def __getattr__(self, name):
            return getattr(library, name)

    coder.tokenizer = Library()
    for _ in range(30):
        text = " ".join(["often", "B\u00e4r,", *("".join(rnd.choice("aeioubc\u0394.,") for _ in range(6)) for _ in range(20))]) + " often"
        assert coder.encode_batch([text.encode()])[0].tolist() == ids_of(library, text)
    assert encoded.count(" often") == encoded.count(" B\u00e4r") == 1
    assert len(coder.units.lot.words) + len(coder.units.older.words) < 2 * (40 + 25)


def test_places_near_the_ends_of_a_long_chunk_suffice(library):
    coder, rnd = bpe_codec.Coder(library), random.Random(6)
    texts = [" ".join(rnd.choice(["it.", "a", "Bär,", "x1.", "ab", "\u0394.", "end,"]) for _ in range(n)) for n in (10, 90, 700, 4000)]
    for text, ids in zip(texts, coder.encode_batch([t.encode() for t in texts])):
        assert ids.tolist() == ids_of(library, text)
    assert all(len(e.points) <= 2 * bpe_codec.EDGE_UNITS for e in coder.kept.values())


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for w in sorted(lengths, reverse=True):
        fit = [i for i, r in enumerate(rooms) if r >= w]
        if fit:
            rooms[min(fit, key=rooms.__getitem__)] -= w
        else:
            rooms.append(capacity - w)
    return len(rooms)


def fewest(lengths, capacity):
    """Optimal number of bins of a small instance, by search."""
    best = best_fit_decreasing(lengths, capacity)
    order = sorted(lengths, reverse=True)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(order):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= order[i] and rooms[k] not in rooms[:k]:
                place(i + 1, rooms[:k] + [rooms[k] - order[i]] + rooms[k + 1:])
        place(i + 1, rooms + [capacity - order[i]])

    place(0, [])
    return best


def test_plans_hold_every_piece_and_dominance_costs_nothing():
    rnd = random.Random(4)
    for _ in range(150):
        capacity = rnd.choice([10, 20, 50])
        lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 9))]
        histogram = {n: lengths.count(n) for n in lengths}
        plan = packing.make_plan(histogram, capacity)
        held = {}
        for items, count in plan:
            assert sum(n * k for n, k in items) <= capacity and count > 0
            for n, k in items:
                held[n] = held.get(n, 0) + k * count
        assert held == histogram
        assert sum(c for _, c in plan) <= best_fit_decreasing(lengths, capacity)
        # What reduction fixes is part of some optimal packing.
        left = np.zeros(capacity + 1, np.int64)
        for n, c in histogram.items():
            left[n] = c
        fixed = packing.reduce_dominated(left, capacity)
        rest = [n for n in range(capacity + 1) for _ in range(int(left[n]))]
        assert sum(c for _, c in fixed) + fewest(rest, capacity) == fewest(lengths, capacity)


@pytest.mark.parametrize("rank_rows", [3, 1000])
def test_packed_pieces(spark, docs, prose, rank_rows):
    texts = [*EDGES, *(prose(i, 40 * i) for i in range(40)), prose(7, 6000), prose(8, 10), prose(8, 10)]
    library = tokens.load(packing.VOCABULARY)
    rows = packing.pack(docs(texts), rank_rows=rank_rows).toPandas()
    want = []
    for i, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want += [(i, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(np.array(ids[k:k + 2048], "<u4").tobytes()))
                 for k in range(0, len(ids), 2048)]
    assert sorted(want) == sorted(rows[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None))
    for _, own in rows.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.length.sum() <= 2048 and own.offset.tolist() == [0, *own.length.cumsum()[:-1]]
    assert rows.sequence_id.nunique() == -(-rows.length.sum() // 2048)


@pytest.mark.parametrize("kind", ["letters", "spaces", "mixed"])
def test_long_stretches_without_splits(library, prose, kind):
    """Time grows with the length, and ids stay the library's."""
    import time

    rnd = random.Random(6)
    letters = "".join(rnd.choices("acgt", k=300_000))
    text = {"letters": letters, "spaces": " " * 90_000 + "a" + " " * 30_000,
            "mixed": f"{prose(3, 9_000)} {letters[:90_000]} {prose(4, 9_000)}{letters[:50_000]}\n\n{prose(5, 900)}"}[kind]
    want = ids_of(library, text)
    start = time.time()
    assert token_counts.count_spliced(library, text) == len(want)
    assert bpe_codec.Coder(library).encode_batch([text.encode()])[0].tolist() == want
    assert time.time() - start < 60
