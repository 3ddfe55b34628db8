"""Every core query runs; those with SQL agree with DuckDB."""

from collections import Counter

import pytest
from oracle import connect, same

from respondo.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_duckdb(spark, data, con, name):
    same(QUERIES[name](spark, data), con, SQL[name])


def usable(t):
    rows = [r for r in t("answer_vectors") if r.emb and len(r.emb) == 384 and any(r.emb) and r.survey_id is not None and r.open_question_number is not None]
    sizes = Counter((r.survey_id, r.open_question_number) for r in rows)
    return {r.vec_id: sizes[r.survey_id, r.open_question_number] for r in rows}


def labels_cover(rows, t, alone=-1):
    """One label for every usable vector; labels of a group count up from 0 beside the one for those alone."""
    assert {r.id for r in rows} == set(usable(t))
    assert len({r.id for r in rows}) == len(rows)
    groups = {}
    for r in rows:
        groups.setdefault(r.grp, set()).add(r.label)
    assert all(sorted(g - {alone}) in (list(range(len(g - {alone}))), list(range(1, len(g - {alone}) + 1))) for g in groups.values())


def check_q_mcl_labels(rows, t):
    labels_cover(rows, t)


def check_q_mcl_backup_labels(rows, t):
    labels_cover(rows, t)


def check_q_script_mcl_labels(rows, t):
    assert {r.id for r in rows} == set(usable(t)) and all(r.label >= 0 for r in rows)


def check_q_manual_train(rows, t):
    sizes = usable(t)
    assert {r.id for r in rows} == set(sizes) and all(r.label == -1 for r in rows if sizes[r.id] < 5)


def check_q_kmeans_limited(rows, t):
    large = {i for i, n in usable(t).items() if n >= 5}
    per = {}
    for r in rows:
        per.setdefault(r.k, set()).add(r.id)
    assert per[2] == large and max(per) <= 7 and all(-1 <= r.label < r.k for r in rows)


def check_q_estimate(rows, t):
    assert rows and all(2 <= r.estimated_clusters <= 7 and r.recommended_k == 15 for r in rows)


def check_q_ensemble_best(rows, t):
    vectors = [r for r in t("answer_vectors") if r.vec_id in usable(t)]
    assert {r.grp for r in rows} == {f"{r.survey_id}/{r.open_question_number}" for r in vectors} and len({r.grp for r in rows}) == len(rows) and all(0 <= r.score <= 1 for r in rows)


def check_q_auto_train(rows, t):
    assert rows and len({r.grp for r in rows}) == len(rows) and all(r.method.startswith("inflation") for r in rows)


def check_q_classified_answers(rows, t):
    assert rows and len({(r.grp, r.text) for r in rows}) == len(rows) and all(r.label >= -1 for r in rows)


def check_q_choice_ranges(rows, t):
    texts = {r.question_key: r.question_text for r in t("survey_questions") if r.question_text is not None}
    assert {r.question_key for r in rows} == set(texts) and all(r.n_choices >= 0 for r in rows)


def check_q_grammar_rule(rows, t):
    texts = {r.record_id: r.org_text for r in t("grammar_records") if r.org_text is not None}
    assert {r.record_id for r in rows} == set(texts) and all("  " not in r.corrected and r.corrected == r.corrected.strip() for r in rows)


def check_q_sentence_analysis(rows, t):
    assert rows and all(r.pos_neg in ("POSITIVE", "NEGATIVE", "NEUTRAL") and 1 <= r.n_sentences <= 3 and r.error is None for r in rows)


def check_q_hash_embedding(rows, t):
    assert len(rows) == len(t("answer_vectors")) and all((r.dim, round(r.length, 3)) in ((384, 1.0), (0, 0.0)) for r in rows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_queries_without_sql_hold_what_they_promise(spark, data, name):
    tables = {}

    def t(table):
        if table not in tables:
            tables[table] = spark.read.parquet(f"{data}/{table}.parquet").collect()
        return tables[table]

    globals()[f"check_{name}"](QUERIES[name](spark, data).collect(), t)


def test_entry_has_core_queries():
    import __spark_entry__

    named = __spark_entry__.queries()
    assert set(QUERIES) <= set(named)
    assert set(__spark_entry__.oracle_sql()) <= set(named)


def test_knn_plan_has_no_cross_join(spark, data):
    plan = QUERIES["q_knn_topk"](spark, data)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_scan_reads_only_needed_columns(spark, data):
    plan = QUERIES["q_polarity_counts"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "svc_keywords" not in plan and "automic_sentence" not in plan


def test_wide_table_holds_every_record(spark):
    from respondo.plans import responses

    rows = [(i, "s", "r" if i < 7 else "q", f"text {i}") for i in range(9)]
    df = spark.createDataFrame(rows, "record_id bigint, survey_id string, respondent_key string, corrected string")
    found = {r.respondent_key: [x for x in r[2:] if x] for r in responses.q_wide_responses(lambda name: df).collect()}
    assert found == {"r": [f"text {i}" for i in range(7)], "q": ["text 7", "text 8"]}
    assert responses.q_unpivot_cells(lambda name: df).count() == 9
    merged = {r.respondent_key: r.merged for r in responses.q_merged_columns(lambda name: df).collect()}
    assert merged["r"] == " ".join(f"text {i}" for i in range(7))
