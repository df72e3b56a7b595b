"""The pipeline: each stage against what it must keep, and run() against the chain of them."""

import pytest

import corpus_pipeline
from shiplens.llm import exact_dedup, mixing, piece_codec, quality, simhash
from tests.conftest import SF_CHECK
from tests.llm.test_simhash import plain_components


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    """Inputs and results of every stage, written and read again."""
    docs, out = spark.read.parquet(f"{SF_CHECK}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, SF_CHECK).write.parquet(path)
        got = spark.read.parquet(path)
        out.append((docs, got))
        docs = got
    return out


def test_stage_names_and_columns(spark, chain):
    assert len(corpus_pipeline.STAGES) == 5
    for docs, got in chain[:-1]:
        assert got.columns == chain[0][0].columns and 0 < got.count()


def test_quality_stage_drops_what_the_query_rejects(spark, chain):
    want = {r.doc_id for r in quality.op7_quality_classifier(spark, SF_CHECK).collect() if r.predicted}
    assert {r.doc_id for r in chain[0][1].collect()} == want
    low = {r.doc_id for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").where("quality = 1").collect()}
    assert len(low - want) <= 0.01 * len(low)


def test_exact_stage_keeps_one_of_each_text(chain):
    norm = lambda t: exact_dedup._normal(t)
    before, after = chain[1][0].collect(), chain[1][1].collect()
    best = {}
    for r in before:
        best[norm(r.text)] = min(best.get(norm(r.text), (1, 0)), (-len(r.text or ""), r.doc_id))
    assert sorted(r.doc_id for r in after) == sorted(d for _, d in best.values())


def test_simhash_stage_keeps_the_smallest_of_each_component(chain):
    rows = chain[2][0].collect()
    comps = plain_components([simhash.fingerprint(r.text) for r in rows], [r.doc_id for r in rows])
    assert sorted(r.doc_id for r in chain[2][1].collect()) == sorted(set(comps))


def test_mixing_stage_meets_the_targets(chain):
    before = {r.doc_id for r in chain[3][0].collect()}
    rows = chain[3][1].collect()
    assert {r.doc_id for r in rows} <= before
    total = sum(len(r.text.split()) for r in rows)
    for d, share in mixing.TARGETS.items():
        assert sum(len(r.text.split()) for r in rows if r.lang == d) / total == pytest.approx(share, abs=0.08)


def test_pieces_stage_decodes_to_its_input(chain):
    t = piece_codec.merge_table(piece_codec.default_model_path())
    want = sorted((r.doc_id, r.text) for r in chain[4][0].collect())
    got = sorted((r.doc_id, piece_codec.decode_ids(r.piece_ids, t)) for r in chain[4][1].collect())
    assert got == want


def test_run_equals_the_chain(spark, chain):
    got = corpus_pipeline.run(spark, SF_CHECK).collect()
    key = lambda r: (r.doc_id, r.decoded_sha256, r.n_pieces)
    assert sorted(map(key, got)) == sorted(map(key, chain[4][1].collect()))


def test_stages_on_an_empty_table_and_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, `row` int, quality_score int, id int, `sha` int, keep_id int, piece_ids int"
    odd = [(None, None, None, None, None), (7, "", "en", "s", 0), (7, "", "en", "s", 0), (8, "some plain words in a row, here.", None, None, 9), (9, "x " * 60_000, "en", "s", 1)]
    rows = [(*r, 1, 2, 3, 4, 5, 6) for r in odd]
    for docs in (spark.createDataFrame([], schema), spark.createDataFrame(rows, schema)):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            got = stage(spark, docs, SF_CHECK)
            if i < 4:
                assert got.columns == docs.columns
            assert got.count() <= 3 * len(rows)
