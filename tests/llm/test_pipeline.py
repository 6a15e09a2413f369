"""The corpus pipeline: each stage against brute force on what the stage before kept."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from personweave.llm.pii import Pseudonyms
from personweave.llm.queries import KEY, ORACLES, QUERIES
from personweave.llm.quality import quality_scores
from personweave.sources.scratch import scratch_table
from tests.llm.common import clashing, components, documents, groups
from tests.llm.test_exact_dedup import normal
from tests.llm.test_simhash import slow_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(scratch_table(stage(spark, docs[-1], SF), f"test-{name}"))
    return docs


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:-1])


def test_quality_rejects_and_keeps(spark, stages):
    scores = quality_scores(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id for r in scores.where("predicted = 1").collect()}
    assert rows(stages[1]) == sorted(tuple(r) for r in stages[0].collect() if r.doc_id in kept)
    assert len(kept) < stages[0].count()


def test_exact_copies(stages):
    found = groups((normal(r.text), r) for r in stages[1].collect())
    best = [min(rs, key=lambda r: (-len(r.text or ""), r.doc_id)) for rs in found.values()]
    assert rows(stages[2]) == sorted(map(tuple, best))


def test_near_copies(stages):
    docs = sorted(stages[2].collect(), key=lambda r: r.doc_id)
    marks = [slow_fingerprint(r.text) for r in docs]
    links = [(a, b) for a in range(len(docs)) for b in range(a) if (marks[a] ^ marks[b]).bit_count() <= 3]
    keep = set(components(len(docs), links))
    assert rows(stages[3]) == sorted(tuple(r) for i, r in enumerate(docs) if i in keep)


def test_pseudonyms(stages):
    hide = Pseudonyms(KEY)
    want = []
    for r in stages[3].collect():
        text, counts = hide(r.text)
        want.append((r.doc_id, text, r.lang, r.source, len(text) if counts else r.n_chars))
    assert rows(stages[4]) == sorted(want)


def test_packing(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in stages[4].collect()}
    out = stages[5].collect()
    total = groups((r.doc_id, r.length) for r in out)
    assert {k: sum(v) for k, v in total.items()} == want
    fill = groups((r.sequence_id, r.length) for r in out)
    assert max(map(sum, fill.values())) <= 1024 and len(fill) <= 1.03 * sum(want.values()) / 1024 + 1


def test_run_gives_the_last_stage(spark, stages):
    assert rows(corpus_pipeline.run(spark, SF).drop("sequence_id", "offset")) == rows(stages[5].drop("sequence_id", "offset"))


def test_queries_are_registered():
    import __spark_entry__
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES if q.startswith("op")) == list(range(1, 14)) and "pipeline" in QUERIES


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


ODD = [(1, "one text of several words here"), (2, "one text of several words here"), (2, "quite another thing that stands under the same id"),
       (None, None), (None, ""), (5, None), (5, "mail to a.b@example.com or +1 (143) 555-3824"), (7, "x " * 30_000), (7, "x " * 30_000),
       (None, "a row without an id that is like no other row")]


@pytest.mark.parametrize("name", list(dict(corpus_pipeline.STAGES)))
def test_empty_table(spark, name):
    docs = clashing(documents(spark, []))
    out = stage(name)(spark, docs, SF)
    assert out.collect() == [] and (name == "packing" or out.columns == docs.columns)


@pytest.mark.parametrize("name", ["quality", "exact_dedup", "near_dedup", "pii"])
def test_odd_rows_and_clashing_names(spark, name):
    docs = clashing(documents(spark, ODD))
    out = stage(name)(spark, docs, SF)
    assert out.columns == docs.columns
    got, given = [(r.doc_id, r.text) for r in out.collect()], ODD
    if name == "pii":
        assert len(got) == len(given) and sorted(map(str, (i for i, _ in got))) == sorted(map(str, (i for i, _ in given)))
        changed = {t for _, t in got} - {t for _, t in given}
        assert len(changed) == 1 and "a.b@example.com" not in next(iter(changed))
    else:
        assert set(got) <= set(given)


def test_near_copies_go_by_row(spark):
    got = sorted(((r.doc_id, r.text) for r in stage("near_dedup")(spark, documents(spark, ODD), SF).collect()), key=str)
    # Texts without a word are near each other; the clean row under a repeated id stays.
    assert got == sorted([ODD[0], ODD[2], (5, None), ODD[6], ODD[7], ODD[9]], key=str)


def test_near_copies_without_ids(spark):
    docs = documents(spark, [(None, "the very same words in this row")] * 3 + [(None, "something else altogether is written here")])
    assert sorted(r.text for r in stage("near_dedup")(spark, docs, SF).collect()) == [
        "something else altogether is written here", "the very same words in this row"]


def test_odd_rows_are_packed(spark):
    out = stage("packing")(spark, clashing(documents(spark, ODD)), SF).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ODD)
    assert sum(r.length for r in out) == want and len({(r.sequence_id, r.offset) for r in out}) == len(out)
