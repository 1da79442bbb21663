"""Tool-call linking against a direct model; the pipeline's stages."""

import json
import random

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from sparktally.llm import chat, neardup, substring, toxicity
from sparktally.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMOKE

SCHEMA = "conv_id long, turn long, kind string, call_id string, parent_id string, name string, body string, level int"
TOOLS = {
    "add": {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": "array", "items": {"type": "number"}}},
            "additionalProperties": False},
}


def _events(spark, rows):
    return spark.createDataFrame([(*r, 9) for r in rows], SCHEMA)


def test_linking_status_counts_and_canonical_json(spark):
    rows = [
        (1, 0, "call", "x", None, "add", '{"b": [1, 2.5],\n "a": 1}'), (1, 1, "result", "x", None, None, "one"),
        (1, 1, "result", "x", None, None, "one"), (1, 2, "call", "y", "x", "add", '{"a": -1, "é": "ü"}'),
        (1, 3, "call", "y", "x", "add", '{"a": -1, "é": "ü"}'), (2, 0, "result", "z", None, None, None),
        (2, 1, "call", None, None, "add", "{}"), (2, 2, "result", None, None, None, "r"), (3, 0, "call", "n", "gone", "other", "{}"),
        (3, 1, "call", "j", "n", "add", "not json"), (3, 2, "call", "nul", "j", "add", None), (3, 3, "call", "dup", None, "add", '{"a":1,"a":2}'),
    ]
    got = {(r.call_id, r.status): r for r in chat.link_calls(_events(spark, rows), TOOLS).collect()}
    x, y = got["x", "linked"], got["y", "unanswered"]
    assert (x.n_calls, x.n_results, x.level, x.valid, x.errors) == (1, 2, 0, True, [])
    assert x.call_json == '{"arguments":{"a":1,"b":[1,2.5]},"id":"x","level":0,"name":"add"}'
    assert x.result_json == '{"content":"one","id":"x"}'
    assert (y.n_calls, y.level, y.valid, y.errors) == (2, 1, False, ["$.a: below minimum", "$.é: unknown"])
    assert '"é":"ü"' in y.call_json
    z = got["z", "orphan"]
    assert (z.n_calls, z.level, z.valid, z.call_json, z.result_json) == (0, None, None, None, '{"content":null,"id":"z"}')
    assert got["n", "unanswered"].level == 0 and got["n", "unanswered"].errors == ["unknown tool"]
    assert got["j", "unanswered"].level == 1 and got["nul", "unanswered"].level == 2
    assert got["nul", "unanswered"].errors == ["no arguments"]
    assert got["dup", "unanswered"].valid is False
    loose = [r for r in chat.link_calls(_events(spark, rows), TOOLS).collect() if r.status == "unidentified"]
    assert sorted((r.n_calls, r.n_results) for r in loose) == [(0, 1), (1, 0)]
    assert json.loads(got["j", "unanswered"].call_json)["arguments"] == "not json"


def test_texts_that_no_record_can_hold_are_problems(spark):
    bodies = {
        "inf": '{"a": 1e999}', "neg": '{"a": -1e999}', "half": '{"a": "\\ud800"}', "key": '{"\\udc00": 1}', "pair": '{"a": 1, "b": []}',
        "deep": '{"a": ' + "[" * 100_000 + "]" * 100_000 + "}", "long": '{"a": ' + "9" * 6000 + "}", "nan": '{"a": NaN}', "empty": "",
    }
    rows = [(1, i, "call", k, None, "add", b) for i, (k, b) in enumerate(bodies.items())]
    got = {r.call_id: r for r in chat.link_calls(_events(spark, rows), TOOLS).collect()}
    assert {k for k, r in got.items() if r.valid} == {"pair"}
    for k, r in got.items():
        if k != "pair":
            assert r.errors[0].startswith("not JSON")
            assert json.loads(r.call_json)["arguments"] == bodies[k]


def test_numbers_are_written_by_value():
    for text, want in {
        "1.0": "1", "1e2": "100", "-0.0": "0", "1E+2": "100", "0.10": "0.1", "1e-7": "1e-07", "12345678901234567890": "12345678901234567890",
        "1.5e3": "1500", "[2.50, 2.5]": "[2.5,2.5]", "1e22": "1" + "0" * 22,
    }.items():
        value, problem = chat.parse(text)
        assert problem is None and chat.canonical(value) == want
    assert chat.violations(chat.parse("1.0")[0], {"type": "integer"}) == []
    assert chat.violations(chat.parse("1.5")[0], {"type": "integer"}) != []


@pytest.mark.parametrize("seed", [1, 2])
def test_linking_against_a_direct_model(spark, seed):
    rng = random.Random(seed)
    ids = [None, *"abcdefghij"]
    rows = [
        (rng.choice([None, 1, 2]), rng.choice([None, 0, 1, 2]), rng.choice(["call", "call", "result", "note"]), rng.choice(ids),
         rng.choice(ids), rng.choice([None, "add", "other"]), rng.choice([None, "", "{}", '{"a": 2.0}', '{"a": -1}', '{"a": 1e999}', "x"]))
        for _ in range(80)
    ]
    first = lambda events: min(events, key=lambda e: [(v is not None, v if v is not None else 0) for v in (e[0], e[1])] + [(e[6] is not None, e[6] or "")])
    want = {}
    for call_id in {r[3] for r in rows} - {None}:
        calls = [r for r in rows if r[2] == "call" and r[3] == call_id]
        results = [r for r in rows if r[2] == "result" and r[3] == call_id]
        if calls or results:
            status = "linked" if calls and results else "unanswered" if calls else "orphan"
            body = first(calls)[6] if calls else None
            want[call_id] = (status, len(calls), len(results), body, first(results)[6] if results else None)
    loose = sorted((r[2] == "call", str(r[6])) for r in rows if r[3] is None)
    got = chat.link_calls(_events(spark, rows), TOOLS).collect()
    seen = {}
    for r in got:
        if r.status != "unidentified":
            result = json.loads(r.result_json)["content"] if r.result_json else None
            arguments = json.loads(r.call_json)["arguments"] if r.call_json else None
            seen[r.call_id] = (r.status, r.n_calls, r.n_results, result)
            if r.n_calls:
                value, problem = chat.parse(want[r.call_id][3])
                assert arguments == (want[r.call_id][3] if problem else value)
    assert seen == {k: (s, c, n, res) for k, (s, c, n, _, res) in want.items()}
    assert len(loose) == sum(r.status == "unidentified" for r in got)


def test_levels_of_chains_trees_and_cycles(spark):
    rng = random.Random(1)
    parent = {"r": None}
    for i in range(150):
        parent[f"c{i}"] = f"c{i - 1}" if i else "r"
    for i in range(100):
        parent[f"t{i}"] = rng.choice(list(parent))
    parent |= {"k1": "k2", "k2": "k3", "k3": "k1", "below": "k1", "self": "self"}
    rows = list(parent.items())
    rng.shuffle(rows)
    got = {r.call_id: r.level for r in chat.call_levels(spark.createDataFrame(rows, "call_id string, parent_id string")).collect()}

    def level(c):
        n = 0
        while parent[c] is not None:
            c, n = parent[c], n + 1
            if n > len(parent):
                return None
        return n

    assert got == {c: level(c) for c in parent}


def test_no_events_and_conversations(spark):
    assert chat.link_calls(_events(spark, []), TOOLS).collect() == []
    rows = [(1, 0, "system", "set"), (1, 1, "user", "hi"), (1, 2, "assistant", "yo"), (1, 3, "user", ""), (2, 0, "user", "a" * 100_000),
            (2, 1, "assistant", None), (2, 1, "assistant", "b"), (None, 0, "user", "x"), (3, 5, None, "lost")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, level int")
    got = {r.call_id: r for r in chat.link_conversations(df).collect()}
    assert (got["c1-0"].status, got["c1-0"].level, got["c1-0"].name) == ("unanswered", 0, "configure")
    assert (got["c1-1"].status, got["c1-1"].level, got["c1-1"].parent_id) == ("linked", 1, "c1-0")
    assert (got["c1-3"].level, got["c1-3"].valid) == (2, False)
    assert (got["c2-0"].n_results, len(json.loads(got["c2-0"].call_json)["arguments"]["text"])) == (2, 100_000)
    assert got[None].status == "unidentified" and got["c3-4"].status == "orphan"


def test_query_covers_every_turn(spark):
    rows = QUERIES["op1_tool_calls"](spark, SF_SMOKE).collect()
    turns = spark.read.parquet(f"{SF_SMOKE}/conversations.parquet").count()
    assert sum(r.n_calls + r.n_results for r in rows) == turns
    order = {r.call_id: r.level for r in rows}
    assert all(r.level == order[r.parent_id] + 1 for r in rows if r.parent_id in order and r.level is not None and order[r.parent_id] is not None)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("conversations", "documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMOKE)
    res = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str) == sorted(res.fetchall(), key=str)


def test_all_queries_are_registered():
    names = contract.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "packing"]


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    columns = docs.columns
    clean = corpus_pipeline.toxicity_stage(spark, docs, SF_SMOKE)
    labels = spark.read.parquet(f"{SF_SMOKE}/labels.parquet").select("doc_id", "toxic")
    scores = {r.doc_id: r.predicted for r in toxicity.score_documents(docs, labels).collect()}
    clean = clean.cache()
    assert clean.columns == columns
    assert {r.doc_id for r in clean.collect()} == {i for i, p in scores.items() if not p}
    once = corpus_pipeline.near_dedup_stage(spark, clean, SF_SMOKE).cache()
    assert once.columns == columns
    kept = {r.doc_id for r in neardup.near_duplicates(clean).collect() if r.kept}
    assert sorted(r.doc_id for r in once.collect()) == sorted(kept)
    cut = corpus_pipeline.substring_stage(spark, once, SF_SMOKE).cache()
    assert cut.columns == columns
    before = {r.doc_id: r for r in once.collect()}
    touched = {r.doc_id for r in substring.repeated_passages(once).collect()}
    for r in cut.collect():
        assert r.n_chars == len(r.text) if r.doc_id in touched else r == before[r.doc_id]
        assert (len(r.text) < len(before[r.doc_id].text)) == (r.doc_id in touched)
    packed = corpus_pipeline.packing_stage(spark, cut, SF_SMOKE).collect()
    assert {r.doc_id for r in packed} == set(before)
    for df in (clean, once, cut):
        df.unpersist()


def test_pipeline_stages_take_odd_tables(spark, tmp_path):
    rows = [(1, "same words here again and again", "en", "s", 1, 0.5), (1, "same words here again and again", "en", "s", 1, 0.5),
            (None, "no id at all", "en", "s", None, 0.1), (3, None, None, None, None, None), (4, "", "en", "s", 0, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")
    spark.createDataFrame([(1, 0), (9, 1), (None, None)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for table in (docs, docs.limit(0)):
        cur = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            cur = stage(spark, cur, str(tmp_path))
            assert cur.columns == docs.columns, name
        out = corpus_pipeline.packing_stage(spark, cur, str(tmp_path)).collect()
        ids = sorted((str(r.doc_id) for r in out))
        assert ids == (["1", "3", "4", "None"] if table is docs else [])


def test_pipeline_keeps_every_text_of_a_repeated_id_and_any_column(spark, tmp_path):
    """Rows of one id with different texts, and columns named as the stages'
    own joins name theirs."""
    words = [f"w{i}" for i in range(300)]
    rng = random.Random(3)
    text = lambda: " ".join(rng.choices(words, k=80))
    a, b, c = text(), text(), text()
    near = a + " one more"
    rows = [(1, a), (2, near), (2, b), (2, b), (3, c), (3, near)]
    names = ["_spans", "_span_doc", "_span_text", "_cut", "_kept_id", "_kept", "_rows", "rows", "text_id", "kept", "c0", "node", "start"]
    docs = spark.createDataFrame([(i, t, len(t), *range(len(names))) for i, t in rows], ["doc_id", "text", "n_chars", *names])
    spark.createDataFrame([(1, 0), (9, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    once = corpus_pipeline.near_dedup_stage(spark, docs, str(tmp_path))
    assert once.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in once.collect()) == sorted([(1, a), (2, b), (3, c)])
    cur = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        cur = stage(spark, cur, str(tmp_path))
        assert cur.columns == docs.columns
    cut = corpus_pipeline.substring_stage(spark, docs, str(tmp_path))
    assert all(r.n_chars == len(r.text) and r["_cut"] == names.index("_cut") for r in cut.collect())


def test_pipeline_runs_whole(spark):
    out = corpus_pipeline.run(spark, SF_SMOKE)
    assert out.columns[:1] == ["doc_id"] and out.count() > 0
