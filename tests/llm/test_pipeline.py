"""The stages on small tables, against what each operator says by itself."""

import pytest

import corpus_pipeline as P
from chronogrid.llm import decontaminate, jaccard_join, mixing, queries, token_records, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in P.STAGES:
        docs = P.saved(stage(spark, docs, SF), "t")
        out.append(docs)
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_each_stage_takes_effect(spark, stages):
    docs, clean, single, kept, mixed, tokens = stages
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(clean) == ids(toxicity.score(docs, model).where("predicted = 0"))
    assert ids(single) == ids(jaccard_join.jaccard_groups(clean).where("doc_id = component_id"))
    held = ids(decontaminate.matches(single, spark.read.parquet(f"{SF}/benchmark.parquet")))
    assert ids(kept) == ids(single) - held
    assert ids(mixed) == ids(mixing.mix(kept).taken().where("taken > 0"))
    again = token_records.round_trip(mixed, queries.tokenizer_path())
    assert sorted(map(tuple, tokens.collect())) == sorted(map(tuple, again.collect()))
    assert all(d.columns == docs.columns for d in stages[1:-1])


def test_run_is_the_stages_in_turn(spark, stages):
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, stages[-1].collect()))
    assert [name for name, _ in P.STAGES] == ["toxicity", "near_duplicates", "benchmark", "mix", "tokens"]


ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta", "en", None, 3, "p"),
    (1, "one two three four five six seven eight", "en", "s", 3, "p"),
    (1, "one two three four five six seven eight", "en", "s", 3, "q"),
    (2, "Alpha  beta gamma delta epsilon zeta eta", None, "s", None, "p"),
    (3, None, None, None, None, None),
    (4, "", "", "", 0, ""),
    (None, "alpha beta gamma delta epsilon zeta eta", "en", "s", 1, "p"),
    (5, "word " * 30_000, "en", "s", 150_000, "p"),
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id string"


def test_near_duplicates_keep_differing_texts_of_an_id(spark):
    for parts in (1, 5):
        got = P.near_duplicates_stage(spark, spark.createDataFrame(ROWS, DOCS).repartition(parts), SF)
        rows = sorted((tuple(r) for r in got.collect()), key=str)
        assert got.columns == [c.split()[0] for c in DOCS.split(", ")]
        assert [r[:2] for r in rows] == sorted(((r[0], r[1]) for k, r in enumerate(ROWS) if k not in (2, 3)), key=str)
        one = [r for r in rows if r[1] and r[1].startswith("one")]
        assert parts == 1 or one == before
        before = one


def test_near_duplicates_deal_out_texts_of_repeated_ids_alone(spark):
    rows = [(k, f"text {k} of many unlike others that share no words with it x{k} y{k} z{k}", "en", "s", 3, "p") for k in range(40)] + [(None, "no id", "en", "s", 1, "p")] * 2
    got = P.near_duplicates_stage(spark, spark.createDataFrame(rows, DOCS), SF)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Window" not in final and "Sort" not in final


@pytest.mark.parametrize("name", [name for name, _ in P.STAGES])
def test_stages_take_any_rows_and_none(spark, name):
    stage = dict(P.STAGES)[name]
    docs = spark.createDataFrame(ROWS, DOCS)
    got = stage(spark, docs, SF)
    assert name == "tokens" or got.columns == docs.columns
    assert got.count() > 0
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_settings_are_given_back(spark):
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.streaming.stateStore.providerClass", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"]
    before = [spark.conf.get(k, None) for k in keys]
    for f in queries.queries().values():
        f(spark, SF)
        assert [spark.conf.get(k, None) for k in keys] == before


def test_work_folders_are_shared_or_refused(spark, monkeypatch):
    from chronogrid.llm import common

    class Context:
        master = "yarn"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        common.work_dir(Session(), "t")
