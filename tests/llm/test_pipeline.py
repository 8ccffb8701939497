import corpus_pipeline
from rushcart.llm.mixing import mix
from rushcart.llm.pieces import decode_pieces
from rushcart.llm.queries import QUERIES
from rushcart.llm.toxicity import score_toxicity, train
from rushcart.sources.folders import stored
from rushcart.sources.tables import load_table
from .conftest import rows_of
from .test_ngram_join import wanted as near_groups

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_one_after_the_other(spark):
    docs = load_table(spark, SF, "documents")
    labels = load_table(spark, SF, "labels")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, SF), "stage")
        assert docs.columns == columns, name
        kept[name] = (before, docs)
    names = list(kept)
    assert len(corpus_pipeline.STAGES) == 5

    before, after = kept[names[0]]
    clean = score_toxicity(before, train(before, labels)).where("predicted = 0")
    assert rows_of(after, "doc_id") == rows_of(clean, "doc_id") and 0 < after.count() < before.count()

    before, after = kept[names[1]]
    last = {}
    for i, text in before.select("doc_id", "text").collect():
        last[text] = max(i, last.get(text, i))
    assert rows_of(after, "doc_id", "text") == sorted([(i, t) for t, i in last.items()], key=repr)

    before, after = kept[names[2]]
    rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
    assert {i for (i,) in rows_of(after, "doc_id")} == {c for _, _, c in near_groups(rows, 5, 80)}

    before, after = kept[names[3]]
    copies = {r.doc_id: r.copies for r in mix(before).collect()}
    got = {i: n for i, n in after.groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in copies.items() if n}

    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert rows_of(decode_pieces(pieces), "doc_id", "text") == rows_of(docs, "doc_id", "text")


def test_run_is_the_stages(spark):
    result = corpus_pipeline.run(spark, SF)
    assert result.columns == ["doc_id", "ids"] and 0 < result.count() < 400


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
