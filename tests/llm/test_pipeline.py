from collections import Counter

import corpus_pipeline as cp
from tessera.llm.mixing import mix
from tessera.llm.quality import ACCEPT, train
from tessera.llm.sentencepiece import MODEL, Unigram
from tessera.llm.piece_model import PieceModel
from tests.llm.tables import awkward, documents, empty
from tests.llm.test_simhash import plain_components, plain_fp

SF = "/root/testdata/sf0.001"


def test_run_against_plain_steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [r for r in docs.collect() if model.score([r.text])[0] >= ACCEPT]
    last = {}
    for r in rows:
        last[r.text] = max(last.get(r.text, r.doc_id), r.doc_id)
    rows = [r for r in rows if last[r.text] == r.doc_id]
    fp = {r.doc_id: plain_fp(r.text) for r in rows}
    by_id = plain_components(sorted(fp), [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4])
    rows = [r for r in rows if by_id[r.doc_id] == r.doc_id]
    kept = spark.createDataFrame(rows, docs.schema)
    copies = {r.doc_id: r.copies for r in mix(kept).collect()}
    with open(MODEL, "rb") as f:
        u = Unigram(PieceModel.read(f.read()))
    want = Counter()
    for r in rows:
        if copies[r.doc_id]:
            want[(r.doc_id, tuple(u.encode([r.text])[0].tolist()))] += copies[r.doc_id]
    got = Counter((r.doc_id, tuple(r.ids)) for r in cp.run(spark, SF).collect())
    assert got == want and len(got) > 20


def test_stages_keep_columns_and_take_awkward_rows(spark):
    df, rows = awkward(spark, ["a good text. It has two sentences.", "b b b b", "a good text. It has two sentences."])
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, df, SF)
        if k < len(cp.STAGES) - 1:
            assert out.columns == df.columns, name
        out.count()
        assert stage(spark, empty(df), SF).count() == 0, name


def test_rows_go_by_id_and_text(spark):
    near = [" ".join(f"w{k}" for k in range(400)) + end for end in ("", " more")]
    assert 0 < (plain_fp(near[0]) ^ plain_fp(near[1])).bit_count() <= 4
    rows = [(1, "copied text"), (None, "copied text"), (None, "only here, without an id"), (None, None),
            (3, "copy of four"), (4, "copy of four"), (3, "three's other text, nowhere else")]
    left = [tuple(r)[:2] for r in cp.exact(spark, documents(spark, rows), SF).collect()]
    assert Counter(left) == Counter([rows[0], rows[2], rows[3], *rows[5:]])
    rows = [(1, near[0]), (None, near[1]), (None, "far from it, without an id"), (8, near[1]), (8, "eight's other text, far from all")]
    left = [tuple(r)[:2] for r in cp.near(spark, documents(spark, rows), SF).collect()]
    assert Counter(left) == Counter([rows[0], rows[2], rows[4]])
