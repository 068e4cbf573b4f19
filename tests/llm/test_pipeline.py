
import corpus_pipeline as pipe
from docloom.llm import queries
from tests.llm.conftest import EDGES


def test_stages(spark, prose, tmp_path):
    shared = " ".join(f"s{i}" for i in range(50))
    texts = [prose(i, 120) for i in range(30)]
    texts += [texts[0], texts[1] + " more", f"{texts[2]} {shared}", f"{shared} {prose(50, 80)}", prose(51, 80) + " joe@mail.example.com", *EDGES]
    rows = [(i, t, "en", "s", len(t or ""), 7.0, 1) for i, t in enumerate(texts)] + [(0, texts[0], "en", "s", 1, 7.0, 1)]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, n_words int")
    columns, kept = docs.columns, docs
    seen = {}
    for name, stage in pipe.STAGES[:-1]:
        kept = stage(spark, kept, "")
        assert kept.columns == columns and [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
        path = str(tmp_path / name)
        kept.write.parquet(path)
        kept = spark.read.parquet(path)
        seen[name] = {r.doc_id: r for r in kept.collect()}
        assert all(r.score == 7.0 and r.n_words == 1 for r in seen[name].values())
    assert set(range(35)) <= set(seen["language_id"]) and not {35, 36, 37, 40} & set(seen["language_id"])
    near = seen["jaccard_join"]
    assert not {30, 31} & set(near) and {0, 1, 32, 33, 34} <= set(near)
    assert kept.filter("doc_id = 0").count() == 1
    cut = seen["substring_dedup"]
    assert "s20" not in cut[32].text and "s20" not in cut[33].text and cut[33].n_chars == len(cut[33].text)
    assert cut[3].text == texts[3] and cut[3].n_chars == len(texts[3])
    assert "[EMAIL]" in seen["pii"][34].text and "@" not in seen["pii"][34].text
    packed = pipe.STAGES[-1][1](spark, kept, "")
    assert {r.doc_id for r in packed.collect()} == set(seen["pii"])


def test_run_writes_and_rereads(spark, prose, tmp_path):
    docs = spark.createDataFrame([(i, prose(i, 60), "en", "s", 1) for i in range(12)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id for r in pipe.run(spark, str(tmp_path)).collect()} == set(range(12))


def test_empty_documents(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert pipe.run(spark, str(tmp_path)).count() == 0


def test_every_operator_has_a_query():
    names = sorted(queries.QUERIES)
    assert [n for n in range(1, 14) if not any(x.startswith(f"op{n}_") for x in names)] == [] and "pipeline" in names


def test_near_duplicates_where_ids_repeat_or_lack(spark, prose):
    """A doc_id over a copied text and one of its own, copies without doc_id, and no words at all."""
    a, b, c, d = (prose(i, 80) for i in range(4))
    rows = [(1, a), (2, a + " end"), (2, b), (2, b), (None, c), (None, c), (3, c + " end"), (None, d), (4, ""), (4, ""), (5, ""), (None, "")]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id bigint, text string, lang string").repartition(3)
    got = sorted(((r.doc_id or 0, r.text) for r in pipe.near_duplicates(spark, docs, "").collect()))
    assert got == sorted([(1, a), (2, b), (3, c + " end"), (0, d), (4, ""), (5, ""), (0, "")])
    assert pipe.near_duplicates(spark, docs, "").columns == docs.columns
