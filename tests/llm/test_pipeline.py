import corpus_pipeline
import test_decontaminate
import test_lines
import test_simhash
from tapeworks.llm import bpe, toxicity
from tapeworks.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = table(spark, SF, "documents").limit(90)
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "bpe"]
    stages = dict(corpus_pipeline.STAGES)

    clean = stages["toxicity"](spark, docs, SF)
    index = toxicity.fit(docs, table(spark, SF, "labels"))
    assert clean.columns == columns
    rows = {r.doc_id: r for r in docs.collect()}
    assert {r.doc_id for r in clean.collect()} == {i for i, r in rows.items() if index.score(r.text)[0] < 0.5}

    lined = stages["line_dedup"](spark, docs, SF)
    order = sorted(rows)
    assert lined.columns == columns
    want = dict(zip(order, test_lines.brute([rows[i].text for i in order]), strict=True))
    assert {r.doc_id: r.text for r in lined.collect()} == want

    single = stages["simhash_near_dedup"](spark, lined, SF)
    texts = {r.doc_id: r.text for r in lined.collect()}
    ids = sorted(texts)
    groups = test_simhash.groups([test_simhash.plain(texts[i]) for i in ids], ids)
    assert single.columns == columns and {r.doc_id for r in single.collect()} == {i for i, g in zip(ids, groups, strict=True) if i == g}

    pure = stages["decontamination"](spark, docs, SF)
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert pure.columns == columns and {r.doc_id for r in pure.collect()} == {i for i, r in rows.items() if not test_decontaminate.brute(r.text, items, 10)[4]}

    coded = {r.doc_id: r for r in stages["bpe"](spark, docs, SF).collect()}
    codec = bpe.codec(bpe.default_vocab())
    assert all(coded[i].ids == codec.encode(r.text) for i, r in rows.items())


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns) and out.count() > 100
