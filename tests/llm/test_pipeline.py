"""The pipeline's stages: each on what the one before kept, decisions taken, columns kept."""

import zlib

import numpy as np
import pytest

import corpus_pipeline
from vizquarry.llm import quality_rules, registry
from vizquarry.session import cut_lineage

from .test_near_dedup import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of each stage, with odd rows and a clashing column among the documents."""
    docs = registry.table(spark, SF, "documents")
    long_text = " ".join(f"w{k % 977}" for k in range(30_000))
    odd = [(None, "a text without an id " * 9, "en", "src1", 1), (9001, None, None, None, None), (9002, "", "en", "src2", 0), (9003, long_text, "en", None, 5)]
    odd += [tuple(r) for r in docs.where("doc_id = 1").collect()]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).selectExpr("*", "7 AS n_tokens", "'x' AS whole", "1 AS rep", "2 AS kept", "3 AS _mix_whole", "4 AS _mix_last", "5 AS _mix_domain", "6 AS _mix_row", "8 AS row")
    found = []
    for _, stage in corpus_pipeline.STAGES:
        made = cut_lineage(stage(spark, docs, SF))
        found.append((docs, made))
        docs = made
    return found


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "MinHash near-dedup", "benchmark decontamination", "mixing sources to target weights", "token-ID / binary output",
    ]
    for before, after in stages[:-1]:
        assert after.columns == before.columns and set(ids(after)) <= {r.doc_id for r in before.collect()}
        assert after.count() > 0
    mixed = stages[3][1].select("_mix_whole", "_mix_last", "_mix_domain", "_mix_row", "row").distinct().collect()
    assert [tuple(r) for r in mixed] == [(3, 4, 5, 6, 8)]


def test_of_two_texts_under_one_id_the_smaller_stays(spark):
    rows = [(1, t, "en", "src1", 1) for t in ("one text of five words or more", "another text, which is not like it", "some third text under the same id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    for parts in (1, 3):
        left = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(parts), SF).collect()
        assert [r.text for r in left] == ["another text, which is not like it"]


def test_rules(stages):
    before, after = stages[0]
    kept = {r.doc_id for r in quality_rules.quality_rules(before.drop("kept")).where("kept").collect()} - {None}
    assert set(ids(after)) == kept and not {9001, 9002} & kept


def test_one_of_each_group_stays(stages):
    before, after = stages[1]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert ids(after) == sorted({key for key, _, _, kept in brute(rows, 5, 80) if kept})


def test_no_item_is_left(spark, stages):
    before, after = stages[2]

    def shingles(text):
        words = (text or "").lower().split()
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    items = [s for s in (shingles(r.text) for r in registry.table(spark, SF, "benchmark").collect()) if s]
    want = [r.doc_id for r in before.collect() if not any(100 * len(shingles(r.text) & s) >= 80 * len(s) for s in items)]
    assert ids(after) == sorted(want)


def test_mix_takes_its_share(stages):
    before, after = stages[3]
    count = lambda df: sum(len((r.text or "").split()) for r in df.collect())
    share = count(after) / count(before)
    assert corpus_pipeline.MIX_SHARE - 0.02 < share < corpus_pipeline.MIX_SHARE + 0.35 and len(set(ids(after))) == after.count()


def test_token_rows(stages):
    from tokenizers import Tokenizer

    before, after = stages[4]
    whole, start = Tokenizer.from_file(registry.tokenizer_path()), 0
    got = {r.doc_id: r for r in after.collect()}
    for r in sorted(before.collect(), key=lambda r: r.doc_id):
        want = whole.encode(r.text or "", add_special_tokens=False).ids + [0]
        row = got[r.doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        start += len(want)
    assert len(got) == before.count()


def test_run_and_empty(spark, tmp_path):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    docs = registry.table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, SF))
        assert docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0
