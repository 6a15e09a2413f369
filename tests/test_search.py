"""Search by postings, as-of lookups and exports, against plain Python."""

import random

from pyspark.sql import functions as F

from personweave.operators.graph import crosswalk_as_of, entities_at, entity_history, validity
from personweave.operators.search import SearchIndex
from personweave.operators.upsert import export_between

GOLDEN = "entity_id string, first_name string, last_name string, email string, phone string, company_name string"
LINKS = "source_system string, source_id string, entity_id string"


def test_search_against_contains(spark, tmp_path):
    rng = random.Random(5)
    parts = ["an", "na", "Bo", "li", "ö", "😀", "x", "mar"]

    def word():
        return rng.choice([None, "".join(rng.choices(parts, k=rng.randrange(1, 4)))])

    def rows(first, n):
        return [(f"e{i}", word(), word(), f"{word() or 'q'}@x.com".lower(), word(), "") for i in range(first, first + n)]

    def texts(records):
        return {r[0]: " ".join(x for x in (r[1], r[2], r[3], r[4], r[5]) if x is not None).lower() for r in records}

    asked = ["an", "A", "anan", "x.com", " Bo ", "ö", "😀", "missing", "", None, "li mar", "@x.com", "mar mar", "e1", "an"]
    queries = spark.createDataFrame([(q,) for q in asked], "q string")

    def expected(records):
        return sorted((q, e) for q in {q for q in asked if q and q.strip()} for e, t in texts(records).items() if q.strip().lower() in t)

    records = rows(0, 60)
    index = SearchIndex.create(spark, str(tmp_path / "s"), spark.createDataFrame(records, GOLDEN), buckets=8)
    assert sorted(map(tuple, index.search(queries).collect())) == expected(records)
    changed = [(f"e{i}", "Zora", "Quill", "z@y.com", None, None) for i in (3, 4)] + rows(100, 5)
    ended = ["e7", "e8", "e59"]
    index.refresh(spark.createDataFrame(changed, GOLDEN), spark.createDataFrame([(e,) for e in ended], "entity_id string"))
    ids = {r[0] for r in changed} | set(ended)
    records = [r for r in records if r[0] not in ids] + changed
    asked += ["zora", "quill z@"]
    queries = spark.createDataFrame([(q,) for q in asked], "q string")
    assert sorted(map(tuple, index.search(queries).collect())) == expected(records)
    assert index.search(queries.where(F.lit(False))).collect() == []


def test_entities_at_any_version(spark):
    states = [{}, {"a": "E1", "b": "E1", "c": "E2"}, {"a": "E1", "b": "E2", "c": "E2"}, {"b": "E2", "d": "E4"}, {"a": "E9", "b": "E2", "d": "E4"}]
    tables = [spark.createDataFrame([("s", k, e) for k, e in s.items()], LINKS) for s in states]
    events = None
    for version in range(1, len(states)):
        step = entity_history(tables[version - 1], tables[version], version)
        events = step if events is None else events.unionByName(step)
    events = spark.createDataFrame(events.collect(), events.schema)
    asked = [("s", k, v) for k in "abcde" for v in range(7)] + [("s", "a", 1)]
    found = entities_at(spark.createDataFrame(asked, "source_system string, source_id string, version long"), validity(events)).collect()
    want = sorted((k, v, states[min(v, 4)].get(k)) for _, k, v in asked)
    assert sorted(((r.source_id, r.version, r.entity_id) for r in found), key=str) == sorted(want, key=str)
    for v in range(5):
        assert {r.source_id: r.entity_id for r in crosswalk_as_of(events, v).collect()} == states[v]


def test_export_brings_a_receiver_up_to_date(spark):
    schema = "k string, v string, w int"
    before = [("same", "x", 1), ("changed", "x", 1), ("null", None, 1), ("gone", "x", 1), ("to null", "x", 1)]
    after = [("same", "x", 1), ("changed", "y", 1), ("null", None, 1), ("to null", None, 1), ("new", None, None)]
    out = export_between(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema), ["k"]).collect()
    assert sorted(map(tuple, out), key=str) == sorted(
        [("changed", "y", 1, False), ("gone", "x", 1, True), ("to null", None, 1, False), ("new", None, None, False)], key=str)
    state = {r[0]: r for r in before}
    for r in out:
        state.pop(r.k, None)
        if not r.removed:
            state[r.k] = (r.k, r.v, r.w)
    assert sorted(state.values()) == sorted(after)
