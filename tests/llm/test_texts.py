import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from docloom.llm import langid, pii, quality, substrings, toxicity
from tests.llm.conftest import EDGES

WORD = re.compile("[^\x20\x09-\x0d]+")
OTHER = ("ch", "sch", "ei", "un", "ß", "ö", "te", "ver", "lich", "ü")


def labelled(spark, prose, per=60):
    rows = [(i, prose(i, 60), "aa") for i in range(per)] + [(per + i, prose(i, 60, OTHER), "bb") for i in range(per)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_languages_of_unseen_texts_and_edges(spark, docs, prose):
    model = langid.train(labelled(spark, prose))
    texts = [prose(900, 5), prose(901, 5, OTHER), prose(902, 900), *EDGES, prose(900, 5)]
    got = {r.doc_id: r for r in langid.identify(docs(texts).select("doc_id", "text", "spans"), model).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2)] == ["aa", "bb", "aa"]
    assert [got[3 + i].lang_pred for i in (0, 1, 2, 5)] == ["und"] * 4  # null, empty, blank, digits
    assert all(0 <= r.score <= 1 for r in got.values()) and got[3].score == 0 and got[0].spans == "q"
    assert got[0][1:] == got[len(texts) - 1][1:]
    kept = {r.doc_id for r in langid.accepted(langid.identify(docs(texts).select("doc_id", "text"), model)).collect()}
    assert {0, 1, 2} <= kept and not kept & {3, 4, 5, 8}


def test_long_texts_are_learned_to_their_end(spark, docs, prose):
    head = prose(1, 6000)
    assert len(head) > 20_000
    rows = [(0, f"{head} {prose(2, 500)}", "aa"), (1, f"{head} {prose(3, 500, OTHER)}", "bb")]
    model = langid.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    got = langid.identify(docs([prose(4, 40, OTHER)]).select("doc_id", "text"), model).first()
    assert got.lang_pred == "bb"


def test_code_lengths_equal_a_plain_coder(spark, prose):
    order = 2
    rows = labelled(spark, prose, 3)
    model = langid.build_model(langid.gram_counts(rows.select("lang", "text"), order).toPandas(), order)
    text = (prose(5, 20) + " öß zz").encode()
    padded, at, _ = langid.folded(np.frombuffer(text, np.uint8), np.array([0, len(text)]), order)
    got = model.lengths(padded, at).sum(axis=0)
    for column, lang in enumerate(model.languages):
        seen = {}
        for row in rows.filter(f"lang = '{lang}'").collect():
            raw = row.text.encode()
            own, places, _ = langid.folded(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), order)
            for k in range(order + 1):
                for p in places:
                    seen.setdefault(bytes(own[p - k:p]), Counter())[int(own[p])] += 1
        bits = 0.0
        for p in at:
            for k in range(order, -1, -1):
                found = seen.get(bytes(padded[p - k:p]))
                if not found:
                    continue
                total = sum(found.values()) + len(found)
                if found[int(padded[p])]:
                    bits -= np.log2(found[int(padded[p])] / total)
                    break
                bits -= np.log2(len(found) / total)
            else:
                bits += 8
        assert got[column] == pytest.approx(bits, rel=1e-4)


def test_no_language_to_learn(spark, docs):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    model = langid.train(empty)
    got = langid.identify(docs(["abc"]).select("doc_id", "text"), model).first()
    assert (got.lang_pred, got.score) == ("und", 0.0)
    assert langid.identify(docs([]).select("doc_id", "text"), model).count() == 0


def brute_quality(text):
    words = WORD.findall(text or "")
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_quality_counts(docs, prose):
    rnd = random.Random(1)
    texts = [*EDGES, *(" ".join(rnd.choice("ab#*\n<") + rnd.choice(["", "\n", "c"]) for _ in range(rnd.randint(0, 120)))
                       for _ in range(60)), "the and of " + prose(1, 200), "q " * 60]
    got = {r.doc_id: r for r in quality.quality(docs(texts)).collect()}
    for i, text in enumerate(texts):
        assert got[i][1:6] + (got[i].base_failed,) == brute_quality(text), repr(text)
        assert not (got[i].base_failed and got[i].kept)
    assert got[len(texts) - 2].kept and quality.quality(docs([])).count() == 0


def test_rule_table(docs, prose):
    none = quality.quality(docs(["the and of " + prose(1, 200)]), rules=(quality.Rule("x", "n_symbols", "n_words", 0.5, None),))
    assert not none.first().kept


def brute_spans(text):
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    out = []
    for kind, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == 2 and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans():
    rnd = random.Random(3)
    parts = [*"ab1234567890", "@", ".", " ", "-", "+", "(", ")", "@b.c", "1.2.3.4", "4111111111111111", "é", "\n"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))
        assert pii.base_spans(text) == brute_spans(text), repr(text)
    assert pii.base_spans("1" * 200_000) == [] and pii.base_spans("a" * 200_000 + "@") == []


def personal(rnd, prose, i):
    host = f"mail{i % 9}.example.com"
    kinds = (f"joe.{i}@{host}", f"{rnd.randint(1, 255)}.2.3.{rnd.randint(1, 255)}", f"+1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}")
    digits = f"4{rnd.randint(10**13, 10**14 - 1)}"
    card = next(digits + str(d) for d in range(10) if pii.luhn(digits + str(d)))
    return " ".join([prose(i, 12), kinds[i % 3], prose(i + 1, 9), card, prose(i + 2, 5), str(rnd.randint(1, 10**16))])


def test_boosted_candidates(docs, prose):
    rnd = random.Random(5)
    model = pii.train(docs([personal(rnd, prose, i) for i in range(300)]))
    texts = ["write to ann [at] mail.example [dot] com now", "4111111111111111 4111111111111111 and", prose(1, 300),
             "mail joe@x.org or 1.2.3.4", *EDGES]
    got = {r.doc_id: r for r in pii.find(docs(texts), model).collect()}
    assert got[0].spans.startswith("email:9:") and got[0].n_email == 0
    assert got[1].spans == "card:0:16,card:17:33" and got[2].spans == ""
    assert got[3].spans == "email:5:14,ip:18:25" and (got[3].n_email, got[3].n_ip) == (1, 1)
    for i, text in enumerate(texts):
        base = pii.written(brute_spans(text or ""))
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(got[i].spans.split(","))
    red = {r.doc_id: r for r in pii.find(docs(texts).drop("spans"), model, redact=True).collect()}
    assert red[3].redacted == "mail [EMAIL] or [IP]" and red[3].source == "s"


def test_rare_personal_data_is_sampled(docs, prose):
    rnd = random.Random(9)
    rows = [prose(i, 12) for i in range(4000)] + [personal(rnd, prose, i) for i in range(12)]
    assert pii.train(docs(rows), sample_docs=40) is not None
    assert pii.shares({0: 10, 1: 1000, 4: 10**7}, 410) == {0: 1.0, 1: 0.2, 4: 200 / 10**7}


def test_spans_of_a_rich_row_are_of_every_kind():
    text = " ".join(f"joe{i}@mail.example.com" for i in range(100)) + " , 4111111111111111 , +1 (212) 555-0100"
    made = pii.examples(text, 1)
    assert all(any(x[k] for x, _ in made) for k in (0, 2, 3))


def test_no_example_of_personal_data(docs, prose):
    assert pii.train(docs([prose(1, 50)])) is None and pii.train(docs([])) is None
    assert pii.find(docs(["a@b.c"]), None).first().spans == "email:0:5"
    assert pii.find(docs([]), None).count() == 0


def brute_removed(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("hot, shard", [(1000, 40_000), (2, 300)])
def test_repeated_passages(docs, hot, shard):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(200)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(0, 120))] for _ in range(30)]
    texts = []
    for _ in range(80):
        own = []
        for _ in range(rnd.randint(0, 5)):
            b = rnd.choice(base)
            a = rnd.randint(0, len(b))
            own += b[a:a + rnd.randint(0, 90)] + [rnd.choice(words) for _ in range(rnd.randint(0, 30))]
        texts.append(rnd.choice([" ", "\n", "  "]).join(own))
    texts += [*EDGES, "a b " * 100, "x y z " * 60, texts[3], texts[3]]
    rows = substrings.remove_repeated(docs(texts), hot_runs=hot, shard_words=shard).collect()
    got = {r.doc_id: tuple(r)[1:] for r in rows}
    assert [got[i] for i in range(len(texts))] == brute_removed(texts, 35)


def test_kept_text_and_empty_table(docs):
    shared = " ".join(f"s{i}" for i in range(40))
    got = {r.doc_id: r for r in substrings.remove_repeated(
        docs([f"one\n{shared} two", f"{shared}\nthree  four", "alone \n x"]), carried=("doc_id", "spans"), keep_text=True).collect()}
    assert [got[i].kept_text for i in range(3)] == ["one\ntwo", "three  four", "alone \n x"] and got[0].spans == "q"
    assert substrings.remove_repeated(docs([])).count() == 0


def toxic_corpus(prose):
    insults = ("idiot", "moron", "vermin", "scumbag")
    rnd, rows, marks = random.Random(6), [], []
    for i in range(240):
        words = prose(i, 60).split()
        if i % 3 == 0:
            for k in range(4):
                words.insert(rnd.randint(0, len(words)), insults[(i // 3 + k) % 4])
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 3 == 0)))
    return rows, marks


def test_toxicity_of_plain_gapped_and_clean_texts(spark, docs, prose):
    rows, marks = toxic_corpus(prose)
    labels = spark.createDataFrame([*marks, (0, 1), (1, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(docs(rows), labels)
    texts = [prose(901, 60) + " moron", prose(902, 60) + " you i-d-i-o-t x", prose(903, 60), prose(904, 500), *EDGES]
    got = {r.doc_id: r for r in toxicity.score(docs(texts), model).collect()}
    assert [got[i].predicted for i in range(4)] == [1, 1, 0, 0]
    assert all(0 <= r.score <= 1 for r in got.values()) and all(got[i].predicted == 0 for i in range(4, len(texts)))
    gapped = [model.margin(bytes(toxicity.CODE[np.frombuffer(w, np.uint8)])) for w in (b"moron", b"morxon", b"therean")]
    assert gapped[0] > gapped[1] > gapped[2]


def test_every_telling_word_is_learned(spark, docs, prose, monkeypatch):
    seen, fit = [], toxicity.fit_words
    monkeypatch.setattr(toxicity, "fit_words", lambda positive, negative: seen.append(positive) or fit(positive, negative))
    rnd, rows = random.Random(8), []
    forms = ["idiot" + "".join(rnd.choice("bcdfghjklmnpqrstvwxyz") for _ in range(4)) for _ in range(2000)]
    for i in range(200):
        words = prose(i, 60).split()
        for form in forms[10 * i:10 * i + 20] if i % 2 == 0 else ():
            words.insert(rnd.randint(0, len(words)), form)
        rows.append((i, " ".join(words)))
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(200)], "doc_id bigint, toxic int")
    assert toxicity.train(docs(rows), labels) is not None
    codes = {bytes(toxicity.CODE[np.frombuffer(f.encode(), np.uint8)]) for f in forms}
    assert len(codes) > 1900 and all(codes <= set(positive) for positive in seen)


def test_toxicity_without_labels(spark, docs):
    labels = spark.createDataFrame([(0, 1)], "doc_id bigint, toxic int")
    assert toxicity.train(docs(["a b c"]), labels) is None
    assert toxicity.train(docs([]), labels.filter("toxic = 0")) is None
    assert toxicity.score(docs(["x"]), None).first().predicted == 0 and toxicity.score(docs([]), None).count() == 0


def test_a_row_rich_in_numbers(monkeypatch):
    """Spans of a long row equal those of the plain rule, in time that does not grow with their square."""
    class Coin:
        threshold = 0.3

        def probability(self, x):
            return np.random.default_rng(len(x)).random(len(x))

    def row(n):
        rnd = random.Random(n)
        return " ".join(f"{rnd.randrange(10 ** rnd.randint(2, 14))} a{rnd.randrange(99)}@b.com {rnd.randrange(300)}.{rnd.randrange(300)}.1.2"
                        for _ in range(n))

    def plain(text):
        base = pii.base_spans(text)
        free = [s for s in pii.candidates(text) if not any(a < s[2] and s[1] < b for _, a, b in base)]
        p, added = Coin().probability(free), []
        for i in np.argsort(-p, kind="stable"):
            if p[i] >= Coin.threshold and not any(a < free[i][2] and free[i][1] < b for _, a, b in added):
                added.append(free[i])
        return base, sorted(base + added)

    monkeypatch.setattr(pii, "features", lambda text, span: [0.0])
    for n in (1, 7, 300):
        assert pii.chosen_spans(row(n), Coin()) == plain(row(n))
    import time
    start = time.time()
    assert len(pii.chosen_spans(row(20_000), Coin())[1]) > 20_000
    assert time.time() - start < 30
