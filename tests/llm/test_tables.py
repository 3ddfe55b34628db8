import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import copies as brute_copies
from pyspark.sql import functions as F

from respondo.llm import merkle, mixture, queries, subjects
from respondo.llm.term_counts import ALL_RECORDS, TermStore, marks, svc_roles

# --- copies

RECORDS = [
    (1, "S", "Q7-1", "R1-A", "Price: high / Taste: good"), (2, "S", "Q7-1", "r1 a", "taste = GOOD; price = High"), (3, "S", "Q7-1", "R1-A", "Price: good / Taste: high"),
    (4, "S", "Q1", "R2", "Straße  ist GUT!"), (5, "S", "Q1", "R2", "* STRASSE ist gut"), (6, "S", "Q1", "R2", "Straße ist gut.\n"), (7, "S", "Q1", "R3", "Straße ist gut"),
    (8, "S", "Q1", "R2", None), (9, "S", "Q1", "R2", "  "), (10, None, "Q1", "R2", "x"), (11, None, "Q1", "R2", "X"), (12, "", "Q1", "R2", "x"), (13, "S", "Q1", "R2", "!!!"), (14, "S", "Q1", "R2", "! ! !"),
    (15, "S", "Q1", "R2", "???"),
]
FIELDS = ["survey_id", "open_question_number", "respondent_key"]


def records(spark, rows):
    df = spark.createDataFrame(rows, "record_id bigint, survey_id string, open_question_number string, respondent_key string, corrected string")
    return df.withColumn("root", F.lit("clash")).withColumn("key", F.lit(0))


def test_copies(spark):
    found = {tuple(r) for r in merkle.copies(records(spark, RECORDS), "record_id", FIELDS, "corrected").collect()}
    assert found == {(1, 2), (4, 5), (4, 6), (10, 11), (13, 14)}
    assert merkle.copies(records(spark, RECORDS).limit(0), "record_id", FIELDS, "corrected").count() == 0
    counts = {r.first_id: r.copies for r in merkle.collapsed(records(spark, RECORDS), "record_id", FIELDS, "corrected").collect()}
    assert counts[4] == 3 and sum(counts.values()) == 13


def test_copies_of_the_whole_table(spark, data):
    df = spark.read.parquet(f"{data}/grammar_records.parquet")
    found = {tuple(r) for r in merkle.copies(df, "record_id", FIELDS, "corrected").collect()}
    assert found == brute_copies([(r.record_id, (r.survey_id, r.open_question_number, r.respondent_key), r.corrected) for r in df.collect()])


def test_a_third_of_all_rows_are_copies(spark):
    rows = [(i, "S", "Q1", "R", "same" if i % 3 == 0 else f"text {i}") for i in range(6000)]
    found = merkle.copies(records(spark, rows), "record_id", FIELDS, "corrected").collect()
    assert len(found) == 1999 and {r.first_id for r in found} == {0}


# --- term counts

ANALYSES = "analysis_id bigint, svc_keywords map<string,struct<s:array<string>,v:array<string>,c:array<string>>>"


def analyses(spark, rows):
    return spark.createDataFrame(rows, ANALYSES).withColumn("term", F.lit("clash"))


def brute_counts(rows):
    occurrences, holders = Counter(), defaultdict(set)
    for i, keywords in rows:
        for lists in (keywords or {}).values():
            for role, terms in zip("svc", lists or ()):
                for t in terms or ():
                    if t is not None and t.strip():
                        occurrences[role, t.strip()] += 1
                        holders[role, t.strip()].add(i)
    return {k: (n, len(holders[k])) for k, n in occurrences.items()}


BEFORE = [(1, {"sentence1": (["a", " a ", "b"], ["v"], [])}), (2, {"sentence1": (["a"], None, [None, "", "　"])}), (3, None), (4, {}), (5, {"sentence1": (["b"], ["v"], ["c"])})]
AFTER = [(1, {"sentence1": (["a", " a ", "b"], ["v"], [])}), (2, {"sentence1": (["z"], ["v"], [])}), (3, {"sentence1": (["a"], [], ["c", "c"])}), (6, {"sentence2": (["q"], [], [])})]


def stored(store):
    return {(r.role, r.term): (r.occurrences, r.records) for r in store.counts().collect()}


def test_deltas_give_the_counts_of_the_new_collection(spark, tmp_path):
    store = TermStore(spark, str(tmp_path / "store"), buckets=4)
    assert stored(store) == {}
    store.apply(None, analyses(spark, BEFORE), "analysis_id", ["svc_keywords"], svc_roles)
    assert stored(store) == {**brute_counts(BEFORE), (ALL_RECORDS, ""): (5, 5)}
    store.apply(analyses(spark, BEFORE), analyses(spark, AFTER), "analysis_id", ["svc_keywords"], svc_roles)
    assert stored(store) == {**brute_counts(AFTER), (ALL_RECORDS, ""): (4, 4)}
    store.apply(analyses(spark, AFTER), None, "analysis_id", ["svc_keywords"], svc_roles)
    assert stored(store) == {}


def test_every_repetition_of_a_row_counts(spark, tmp_path):
    one, two = {"sentence1": (["a"], [], [])}, {"sentence1": (["b"], [], [])}
    before, after = [(1, one), (1, one), (2, one), (None, two), (None, two)], [(1, one), (2, one), (None, two), (None, two), (None, two)]
    store = TermStore(spark, str(tmp_path / "r"), buckets=2)
    store.apply(None, analyses(spark, before), "analysis_id", ["svc_keywords"], svc_roles)
    store.apply(analyses(spark, before), analyses(spark, after), "analysis_id", ["svc_keywords"], svc_roles)
    assert stored(store) == {("s", "a"): (2, 2), ("s", "b"): (3, 3), (ALL_RECORDS, ""): (5, 5)}


def test_two_changes_from_one_state_are_not_both_published(spark, tmp_path):
    from respondo.llm.term_counts import ConcurrentChange

    store = TermStore(spark, str(tmp_path / "c"), buckets=2)
    store.apply(None, analyses(spark, BEFORE), "analysis_id", ["svc_keywords"], svc_roles)
    seen = store._manifest()
    store.apply(analyses(spark, BEFORE), analyses(spark, AFTER), "analysis_id", ["svc_keywords"], svc_roles)
    with pytest.raises(ConcurrentChange):
        store._publish(seen)
    expected = {**brute_counts(AFTER), (ALL_RECORDS, ""): (4, 4)}
    assert stored(store) == expected
    store.vacuum()
    assert stored(store) == expected


def test_marks(spark, tmp_path):
    rows = [(i, {"sentence1": (["all"] + (["some"] if i < 4 else []) + (["few"] if i < 2 else []), [], [])}) for i in range(100)]
    store = TermStore(spark, str(tmp_path / "m"))
    store.apply(None, analyses(spark, rows), "analysis_id", ["svc_keywords"], svc_roles)
    assert {r.term: r.mark for r in marks(store.counts()).collect()} == {"all": "common", "some": None, "few": "rare"}
    empty = TermStore(spark, str(tmp_path / "e"))
    empty.apply(None, analyses(spark, []), "analysis_id", ["svc_keywords"], svc_roles)
    assert marks(empty.counts()).count() == 0


# --- mixture


def test_pivot_keeps_tokens_and_chances():
    rng = random.Random(0)
    keys = list(range(200))
    tokens = [rng.randint(1, 90) for _ in keys]
    parts = [0.3] * 200
    wanted = sum(0.3 * t for t in tokens)
    hits = Counter()
    for seed in range(300):
        out = mixture.pivot(keys, tokens, parts, str(seed))
        left = [p for p in out if 0 < p < 1]
        assert len(left) <= 1 and abs(sum(p * t for p, t in zip(out, tokens)) - wanted) < 1e-6
        for k, p in zip(keys, out):
            hits[k] += p
    assert all(50 <= hits[k] <= 130 for k in keys)  # 90 on average
    assert mixture.pivot([], [], [], "s") == [] and mixture.pivot([1], [5], [0.4], "s") == [0.4]


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, text string").withColumn("n_tokens", F.lit(-1)).withColumn("part", F.lit("x"))


def test_shares_are_reached(spark):
    rng = random.Random(1)
    sizes = {"a": 600, "b": 150, "c": 40}
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, source, "word " * rng.randint(5, 60)))
            i += 1
    rows += [(i, None, "x"), (i + 1, "other", "x"), (i + 2, "a", None), (i + 3, "b", ""), (None, "a", "x")]
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3)], "source string, target_share double, max_repeats int")
    df = documents(spark, rows)
    for group in (20_000, 7):  # one leaf, and a tree of several levels
        found = mixture.mix(df, targets, group=group).cache()
        cap = {"a": 1, "b": 2, "c": 3}
        assert all(1 <= r.copies <= cap[r.source] and r.n_tokens > 0 for r in found.collect())
        reached = {r.source: r.actual_share for r in mixture.shares(found, targets).collect()}
        assert all(abs(reached[s] - t) < 0.005 for s, t in (("a", 0.5), ("b", 0.3), ("c", 0.2)))
        assert found.count() == found.select("doc_id").distinct().count()


def test_mixture_of_nothing(spark):
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    assert mixture.mix(documents(spark, []), targets).count() == 0
    assert mixture.mix(documents(spark, [(1, "b", "x")]), targets).count() == 0
    assert mixture.mix(documents(spark, [(1, "a", "x")]), targets.limit(0)).count() == 0


# --- subjects


def labelled_corpus(seed=0):
    rng = random.Random(seed)
    nouns = {"law": ["court", "attorney", "verdict", "clause", "appeal"], "food": ["recipe", "broth", "dessert", "pickle", "dough"], "sport": ["match", "coach", "stadium", "squad", "league"]}
    frames = ["For me the {} matters more than the rest.", "Someone should explain the {} in plain words.", "Why did the {} change?", "I left because the {} kept getting worse."]
    docs, truth, labels = [], {}, []
    for i in range(400):
        about = rng.sample(list(nouns), rng.choice([0, 1, 1, 2]))
        lines = [rng.choice(frames).format(rng.choice(nouns[s])) for s in about for _ in range(rng.randint(2, 4))]
        passing = rng.choice([s for s in nouns if s not in about])
        if rng.random() < 0.3:
            lines.append(rng.choice(frames).format(rng.choice(nouns[passing])))
        lines += ["Multiple answers are allowed.", "Skip to the next item if nothing applies."]
        rng.shuffle(lines)
        docs.append((i, "\n".join(lines)))
        truth[i] = set(about)
        if rng.random() < 0.25:
            labels += [(i, s if rng.random() < 0.95 else "none") for s in about] or [(i, "none")]
    return docs, truth, labels, sorted(nouns)


def run_subjects(spark, docs, labels, areas):
    from respondo.llm.sentences import BoundaryModel

    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("subject", F.lit("clash"))
    marked = spark.createDataFrame(labels, "key bigint, subject string")
    units = subjects.featurise(df, "doc_id", "text", BoundaryModel.fit([]))
    model, data = subjects.fit(units, marked, areas, rounds=2)
    return subjects.assign(data, model)


def test_subjects_of_documents(spark):
    docs, truth, labels, areas = labelled_corpus()
    docs += [(1000, None), (1001, ""), (1002, "  "), (1003, docs[0][1])]
    labels += [(None, "law"), (5, None), (7, "unheard of")]
    found = run_subjects(spark, docs, labels, areas).collect()
    got = {(r.key, r.subject) for r in found}
    expected = {(i, s) for i, about in truth.items() for s in about} | {(1003, s) for s in truth[0]}
    assert len(got & expected) >= 0.95 * len(expected) and len(got & expected) >= 0.95 * len(got)
    assert all(0.5 < r.posterior <= 1 for r in found)


def test_without_documents_or_labels(spark):
    assert run_subjects(spark, [], [], ["law"]).count() == 0
    assert run_subjects(spark, [(1, "The court.\nThe court.")], [], ["law"]).count() == 0


def test_logistic_recovers_a_threshold():
    x = np.array([-3.0, -2, -1, 1, 2, 3] * 20)
    a, b = subjects._logistic(x, (x > 0).astype(float))
    assert a > 0 and abs(b / a) < 0.5


def test_wrong_labels_do_not_move_a_calibrated_threshold():
    rng = np.random.RandomState(0)
    x = np.r_[rng.uniform(5, 15, 300), rng.uniform(-15, -5, 900)]
    y = (x > 0).astype(float)
    flip = rng.rand(len(x)) < 0.05
    y[flip] = 1 - y[flip]
    a, b = subjects.calibrated(x, y)
    assert a > 0.3 and abs(b / a) < 2.5


def test_posteriors_decide_and_cover_every_pair(spark):
    from respondo.llm.sentences import BoundaryModel

    docs, _, labels, areas = labelled_corpus(3)
    docs.append((999, None))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    model, data = subjects.fit(subjects.featurise(df, "doc_id", "text", BoundaryModel.fit([])), spark.createDataFrame(labels, "key bigint, subject string"), areas)
    every = subjects.posteriors(data, model).collect()
    assert len(every) == len(docs) * len(areas)
    assert {(r.key, r.subject) for r in every if r.posterior > 0.5} == {(r.key, r.subject) for r in subjects.assign(data, model).collect()}
    model.curves = [(1.0, -1e6)] * len(areas)  # what the curves say is what comes out
    assert subjects.assign(data, model).count() == 0


def test_units_of_documents():
    from respondo.llm.sentences import BoundaryModel

    cut = lambda t: [u.strip() for u in subjects.units(BoundaryModel.fit([]), t)]
    assert cut("Dr. Ash came. Then he left!\nA line") == ["Dr. Ash came.", "Then he left!", "A line"]
    assert cut("好吃。很贵!不错") == ["好吃。", "很贵!", "不错"] and cut("") == []
    assert cut("Am 3. Mai war es gut, z. B. dort... Oder v9.4 hier") == ["Am 3. Mai war es gut, z. B. dort...", "Oder v9.4 hier"]


# --- queries


def check_p1_neighbours(rows, t):
    usable = {r.vec_id for r in t("answer_vectors") if r.emb and any(r.emb)}
    per = Counter(r.vec_id for r in rows)
    assert set(per) == usable and set(per.values()) == {15} and all(r.vec_id != r.neighbour_id and -1.000001 <= r.cosine <= 1.000001 for r in rows)


def check_p1_found(rows, t):
    assert rows and all(r.vec_lo < r.vec_hi for r in rows) and len({tuple(r) for r in rows}) == len(rows)


def check_p2_found(rows, t):
    heads = Counter(r.head_id for r in rows)
    assert all(n >= 5 for n in heads.values()) and all(r.head_id <= r.vec_id for r in rows) and {r.vec_id for r in rows} >= set(heads)
    assert len({r.vec_id for r in rows}) == len(rows)


def check_p2_clusters(rows, t):
    assert rows and all(r["size"] >= 5 and 1 <= r.n_peaks <= r["size"] and len(r.typical) == 3 for r in rows)


def check_p3_found(rows, t):
    texts = {r.record_id: r.corrected for r in t("grammar_records")}
    ends = {}
    for r in rows:
        assert 0 < r.end_pos <= len(texts[r.record_id]) and not texts[r.record_id][r.end_pos - 1].isspace()
        ends.setdefault(r.record_id, []).append(r.end_pos)
    assert set(ends) == {i for i, x in texts.items() if x and x.strip()}
    assert all(len(set(e)) == len(e) for e in ends.values())


def check_p3_sentences(rows, t):
    assert rows and all(r.start_pos < r.end_pos and r.ordinal >= 0 for r in rows)


def check_p4_found(rows, t):
    assert {r.table_name for r in rows} <= {"grammar_records", "survey_questions"} and len({tuple(r) for r in rows}) == len(rows) > 0


def check_p4_canonical(rows, t):
    assert len(rows) == len(t("grammar_records")) + len(t("survey_questions"))


def check_p5_found(rows, t):
    assert rows and all(r.first_id < r.copy_id for r in rows) and not {r.first_id for r in rows} & {r.copy_id for r in rows}


def check_p5_collapsed(rows, t):
    texts = [r.corrected for r in t("grammar_records") if r.corrected and r.corrected.strip()]
    assert sum(r.copies if "copies" in r else r[-1] for r in rows) >= len(rows) and len(rows) <= len(texts)


def check_p6_found(rows, t):
    texts = {r.record_id: r.corrected for r in t("grammar_records")}
    assert rows and all(0 <= r.start_pos < len(texts[r.record_id]) for r in rows) and {r.kind for r in rows} <= {"email", "phone", "id_number", "address", "person"}


def check_p6_redacted(rows, t):
    texts = {r.record_id: r.corrected for r in t("grammar_records")}
    assert len(rows) == len(texts) and all((r.redacted is None) == (texts[r.record_id] is None) for r in rows)


def check_p8_ids(rows, t):
    assert {r.doc_id for r in rows} == {r.doc_id for r in t("documents")} and all((len(r.ids) > 0) == bool(x) for r, x in ((r, {d.doc_id: d.text for d in t("documents")}[r.doc_id]) for r in rows[:20]))


def check_p8_tokens_by_source(rows, t):
    assert sum(r.n_docs for r in rows) == len(t("documents"))


def check_p9_mix(rows, t):
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in t("documents")}


def check_p9_shares(rows, t):
    assert {r.source for r in rows} >= {r.source for r in t("mix_targets")}


def check_p10_found(rows, t):
    assert rows and {r.subject for r in rows} <= {r.subject for r in t("subject_areas")} and len({tuple(r) for r in rows}) == len(rows)


def check_p10_posteriors(rows, t):
    assert len(rows) == len(t("documents")) * len(t("subject_areas")) and all(0 <= r.posterior <= 1 for r in rows)


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_query_holds_what_its_problem_demands(spark, data, name):
    tables = {}

    def t(table):
        if table not in tables:
            tables[table] = spark.read.parquet(f"{data}/{table}.parquet").collect()
        return tables[table]

    globals()[f"check_{name}"](queries.queries()[name](spark, data).collect(), t)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_agrees_with_duckdb(spark, data, name):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).parent.parent))
    from oracle import connect, same

    same(queries.queries()[name](spark, data), connect(data), queries.oracle_sql()[name])


def test_columns_are_those_asked_for(spark, data):
    wanted = {
        "p1_found": ["vec_lo", "vec_hi"], "p2_found": ["head_id", "vec_id"], "p3_found": ["record_id", "end_pos"], "p4_found": ["table_name", "row_id"], "p5_found": ["first_id", "copy_id"],
        "p6_found": ["record_id", "kind", "start_pos"], "p7_found": ["svc_role", "term", "mark"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id", "subject"],
    }
    for name, columns in wanted.items():
        assert queries.queries()[name](spark, data).columns == columns
