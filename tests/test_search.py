import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import history as H
from tidemark.operators import metrics as M
from tidemark.operators import grams as G
from tidemark.operators import search as S
from tidemark.operators import vectors as V
from tidemark.plans.queries.search import _CATEGORIES, MESSAGES

CATALOG = "name string, database string, description string, tags array<string>, columns array<struct<name: string, type: string>>"


def catalog(spark):
    return spark.createDataFrame(
        [
            ("orders", "db", "All orders with revenue by region", ["sales"], [("order_id", "int"), ("region", "string")]),
            ("customers", "db", None, ["people"], [("customer_id", "int"), ("region_id", "int")]),
            ("events", "db", "clicks", None, []),
        ],
        CATALOG,
    )


def test_keyword_search_over_a_catalog(spark):
    search = lambda q: [(r.name, round(r.score, 4)) for r in S.keyword_search(catalog(spark), S.catalog_text(), q, ["name"]).collect()]
    assert search("Revenue by REGION") == [("orders", 1.0), ("customers", 0.3333)]
    assert search("xyznonexistent") == []
    assert search("") == []
    assert S.query_tokens("a A b") == ["a", "b"]


def vectors(spark, n, width=16):
    values = np.random.default_rng(3).normal(size=(n, width)).astype("float32")
    values[5] = 0
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)]
    return values.astype("float64"), spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(6)


def brute(values, query, k):
    norms = np.linalg.norm(values, axis=1) * np.linalg.norm(query)
    scores = np.divide(values @ query, norms, out=np.zeros(len(values)), where=norms > 0)
    return [int(i) for i in np.lexsort((np.arange(len(values)), -scores))[:k]]


@pytest.mark.parametrize("block", [1024, 4])
def test_vector_topk_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(V, "QUERY_BLOCK", block)
    values, df = vectors(spark, 700)
    odd = spark.createDataFrame([(9000, [1.0]), (9001, None)], "vec_id long, embedding array<float>")
    queries = df.filter("vec_id < 12 AND vec_id <> 5").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    got = {}
    for r in V.vector_topk(df.union(odd), queries, 5).orderBy("query_id", F.desc("score"), "vec_id").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {i: brute(values, values[i], 5) for i in range(12) if i != 5}


def test_postings_round_trip():
    for numbers in ([], [0], [0, 1, 2], [5, 127, 128, 300, 70_000, 70_001, 2**33]):
        assert G.decoded(G.encoded(numbers)).tolist() == numbers


@pytest.mark.parametrize("block", [3, 1 << 16])
def test_token_search_equals_contains(spark, monkeypatch, plan, block):
    """1000 tokens of every length against a contains test of every pair, with awkward rows, in small blocks and groups."""
    monkeypatch.setattr(G, "BLOCK_ROWS", block)
    monkeypatch.setattr(G, "TOKENS_AT_ONCE", 300)
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abcde  é𝕊"), size=rng.integers(0, 60))) for _ in range(80)] + [None, "", "abc" * 40, "abc" * 40]
    tokens = ["".join(rng.choice(list("abcde é𝕊"), size=rng.integers(1, 7))) for _ in range(998)] + [None, ""]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "id int, text string, token string")
    asked = spark.createDataFrame([(x,) for x in tokens + tokens[:50]], "token string")
    found = G.token_search(G.build_grams(docs, "text", ["id"]), asked)
    assert "CartesianProduct" not in plan(found) and "NestedLoop" not in plan(found)
    want = {(x, k) for x in tokens if x for k, t in enumerate(texts) if t and x in t}
    rows = [tuple(r) for r in found.collect()]
    assert set(rows) == want and len(rows) == len(want) > 1000
    assert G.token_search(G.build_grams(docs.limit(0), "text", ["id"]), asked).count() == 0
    assert G.token_search(G.build_grams(docs, "text", ["id"]), asked.limit(0)).count() == 0


def test_cells_search(spark, monkeypatch, plan):
    """All cells probed: exact. A few: most of it. Odd vectors are filed apart, hot cells are cut, and only asked cells are joined."""
    monkeypatch.setattr(V, "CHUNK", 16)
    monkeypatch.setattr(V, "QUERY_BLOCK", 5)
    values, df = vectors(spark, 600)
    odd = spark.createDataFrame([(9000, [1.0]), (9001, None), (9002, [float("nan")] * len(values[0])), (9003, [0.0] * len(values[0]))], "vec_id long, embedding array<float>")
    queries = df.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    index = V.build_cells(df.union(odd), cells=12)
    assert index.table.select(F.sum(F.size("ids"))).first()[0] == 602 and index.table.count() > 30
    exact = V.vector_topk(df.union(odd), queries, 6)
    rows = lambda d: sorted((r.query_id, r.vec_id) for r in d.collect())
    assert rows(V.search_cells(index, queries, 6, probes=12)) == rows(exact)
    some = V.search_cells(index, queries, 6, probes=5)
    assert "CartesianProduct" not in plan(some) and "NestedLoop" not in plan(some)
    share = V.recall(some, exact).first()
    assert share.queries == 30 and share.hit >= 0.6 * share.wanted
    none = V.build_cells(df.limit(0))
    assert V.search_cells(none, queries, 3, probes=2).count() == 0 and V.search_cells(index, queries.limit(0), 3, probes=2).count() == 0


def test_vector_topk_ties_and_short_sides(spark):
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in (4, 2, 9)], "vec_id long, embedding array<float>").repartition(3)
    query = spark.createDataFrame([(1, [2.0, 0.0])], "query_id long, query array<float>")
    assert sorted(r.vec_id for r in V.vector_topk(df, query, 2).collect()) == [2, 4]
    assert V.vector_topk(df, query, 10).count() == 3
    assert V.vector_topk(df, query.limit(0), 2).count() == 0
    named = df.withColumns({"namespace": F.lit("schema"), "title": F.concat(F.lit("t"), F.col("vec_id").cast("string"))})
    found = V.with_metadata(V.vector_topk(named, query, 2, where=F.col("namespace") == "schema"), named, ["title"])
    assert sorted(r.title for r in found.collect()) == ["t2", "t4"]
    assert V.vector_topk(named, query, 2, where=F.col("namespace") == "other").count() == 0


def test_approximate_search_recalls_most(spark):
    values, df = vectors(spark, 300)
    near = S.vector_topk_approximate(df.filter("vec_id <> 5"), list(values[7]), 10, bucket_length=2.0)
    expected = set(brute(values, values[7], 10))
    assert len(expected & {r.vec_id for r in near.collect()}) >= 6


def test_schema_relations(spark):
    names = {"a": ["id", "x", "y", "z", "w"], "b": ["id", "x", "y", "z", "w", "v"], "c": ["id"], "d": ["q"]}
    df = spark.createDataFrame([(t, c) for t, cs in names.items() for c in cs], "table_name string, column_name string")
    shared = {(r.table_name, r.other_table): r.shared for r in S.shared_columns(df).collect()}
    assert shared == {("a", "b"): ["id", "w", "x", "y", "z"], ("a", "c"): ["id"], ("b", "c"): ["id"]}
    assert ("a", "b") in {(r.table_name, r.other_table) for r in S.likely_versions(df).collect()}


def test_candidates_of_one_table_merge(spark):
    df = spark.createDataFrame(
        [("db.orders", "glue", [1, 2]), ("orders", "flat", [1, 2, 3]), ("Other", "flat", None)],
        "name string, source string, columns array<int>",
    )
    assert sorted((r.table_key, r.source) for r in S.merged_candidates(df).collect()) == [("orders", "flat"), ("other", "flat")]


def store(spark):
    rows = [
        ("revenue", "d", "SUM(x)", "orders", "", True, "2024-01-01", "user"),
        ("users", "d", "COUNT(*)", "events", "", False, "2024-01-01", "user"),
    ]
    return spark.createDataFrame(rows, M.METRIC_SCHEMA)


def test_metric_store(spark):
    s, today = store(spark), F.lit("2024-05-01").cast("date")
    assert M.lookup_metric(s, "Revenue").count() == 1 and M.approved_metrics(s).count() == 1
    said = spark.createDataFrame(
        [(1, "Users", "incorrect"), (2, "users", "Correct"), (3, "revenue", "INCORRECT"), (4, "revenue", "use net")],
        "seq int, metric string, feedback string",
    )
    after = {r.name: (r.approved, r.updated_by) for r in M.apply_feedback(s, said).collect()}
    assert after == {"revenue": (False, "needs_review"), "users": (True, "user_feedback")}
    confirmed = spark.createDataFrame([(1, "revenue", "correct")], "seq int, metric string, feedback string")
    assert {r.updated_by for r in M.apply_feedback(s, confirmed).collect()} == {"user"}
    new = spark.createDataFrame([("USERS", "other", "1", "t", ""), ("Margin", "m", "2", "t", "")], "name string, definition string, sql_expression string, table string, filters string")
    suggested = M.suggest_metrics(s, new, today)
    assert {r.name: (r.definition, r.approved) for r in suggested.collect()} == {"revenue": ("d", True), "users": ("d", False), "margin": ("m", False)}
    changed = M.upsert_metrics(s, new.withColumns({"approved": F.lit(True), "updated_by": F.lit("me")}), today)
    assert {r.name: (r.definition, r.last_updated) for r in changed.collect()} == {
        "revenue": ("d", "2024-01-01"), "users": ("other", "2024-05-01"), "margin": ("m", "2024-05-01")
    }


def test_metric_requests_are_checked(spark):
    with pytest.raises(ValueError):
        M.metric_query({}, M.Request([M.Metric("m", "1", "t", approved=False)]))
    with pytest.raises(ValueError):
        M.metric_query({}, M.Request([M.Metric("m", "1", "t"), M.Metric("n", "1", "u")]))


def test_metric_filters(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("ab", None)], "k string, v int")
    count = lambda *f: M.metric_query({"t": df}, M.Request([M.Metric("n", "COUNT(*)", "t")], filters=[f])).first().n
    assert [count("k", "like", "a%"), count("v", "is null", None), count("v", "!=", 1), count("v", "between", (1, 2))] == [2, 1, 1, 2]


def test_history(spark, tmp_path):
    row = lambda i, q, ok, at, s="s": (str(i), s, q, "", "", ok, 0, 1, "", None, 0.5, at)
    log = spark.createDataFrame(
        [row(1, "Total REVENUE", 1, "2024-01-01"), row(2, "revenue by day", 1, "2024-01-03", "z"), row(3, "revenue", 0, "2024-01-04"), row(4, "100%", 1, "2024-01-02")],
        H.HISTORY_SCHEMA,
    )
    assert [r.id for r in H.search_history(log, "revenue").collect()] == ["2", "1"]
    for _ in range(2):
        H.append_history(log, str(tmp_path / "log"))
    assert spark.read.schema(H.HISTORY_SCHEMA).parquet(str(tmp_path / "log")).count() == 8
    assert [r.id for r in H.search_history(log, "0%").collect()] == ["4"]
    assert [r.id for r in H.recent_history(log, limit=2).collect()] == ["3", "2"]
    assert [r.id for r in H.recent_history(log, "z").collect()] == ["2"]


def test_evaluation(spark):
    runs = spark.createDataFrame(
        [(["Orders", "x"], ["orders"], ["SUM", "join"], "select sum(a)", True, 1, True, 2.0, False, 0.5), ([], ["y"], [], "", False, 0, False, 4.0, True, 0.1)],
        "expected_tables array<string>, discovered_tables array<string>, expected_sql_contains array<string>, generated_sql string, "
        "execution_success boolean, retry_count int, validation_passed boolean, latency_seconds double, human_escalated boolean, confidence_score double",
    )
    scored = [(r.discovery_accuracy, r.fragment_share) for r in H.scored_runs(runs).collect()]
    assert scored == [(0.5, 0.5), (1.0, 0.0)]
    report = H.evaluation_report(runs).first()
    assert (report.total_queries, report.discovery_accuracy, report.sql_correctness, report.avg_latency_seconds) == (2, 0.75, 0.5, 3.0)
    assert H.evaluation_report(runs.limit(0)).first().total_queries == 0


def test_error_categories(spark):
    texts = [*MESSAGES, 'column "x" does not exist', "operator does not exist: text + int", None]
    expected = [*_CATEGORIES, "MISSING_COLUMN", "TYPE_ERROR", "UNKNOWN"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, m string").orderBy("i")
    assert [r[0] for r in df.select(H.error_category(F.col("m"))).collect()] == expected


def test_vectors_that_are_no_numbers_match_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [-1.0, 0.1]), (3, [nan, 1.0]), (4, None), (5, [inf, 0.0]), (6, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [nan, 0.0])], "query_id bigint, query array<float>")
    found = V.vector_topk(df, queries, 5).orderBy(F.desc("score")).collect()
    assert [(r.query_id, r.vec_id) for r in found] == [(1, 1), (1, 2)]


def test_a_metric_name_counts_once(spark):
    from tidemark.operators import metrics as M

    store = spark.createDataFrame([], "name string, expression string, last_updated string")
    changes = spark.createDataFrame([("Rev", "a", 1), ("rev", "b", 2)], "name string, expression string, seq int")
    rows = M.upsert_metrics(store, changes, F.lit("2024-01-01"), [F.desc("seq")]).collect()
    assert [(r.name, r.expression) for r in rows] == [("rev", "b")]


def test_cells_send_each_query_once(spark, monkeypatch):
    """A query is kept as one row whatever number of cells it probes, and sent to groups of cells, hot ones among them."""
    counts, write = {}, V.written
    monkeypatch.setattr(V, "written", lambda df, purpose: counts.setdefault(purpose, []).append(df.count()) or write(df, purpose))
    for name, value in (("CHUNK", 16), ("QUERY_BLOCK", 5), ("TILE_BYTES", 2000)):
        monkeypatch.setattr(V, name, value, raising=False)
    values, df = vectors(spark, 200)
    same = spark.createDataFrame([(1000 + i, [float(x) for x in values[7]]) for i in range(100)], "vec_id long, embedding array<float>")
    odd = spark.createDataFrame([(9000, [1.0]), (9001, [2.0]), (9002, None)], "vec_id long, embedding array<float>")
    index = V.build_cells(df.union(same).union(odd), cells=12)
    queries = df.union(odd).filter("vec_id % 20 = 0 OR vec_id IN (7, 9001)").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    counts.clear()
    found = V.search_cells(index, queries, 6, probes=12)
    assert counts["probes"] == [13]
    got = {}
    for r in found.orderBy("query_id", F.desc("score"), "vec_id").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
    assert [score for _, score in got[7]] == [1.0] * 6
    assert got[9000] == got[9001] == [(9000, 1.0), (9001, 1.0)]
    assert [i for i, _ in got[20]] == brute(np.vstack([values, *[values[7:8]] * 100]), values[20], 6) and len(got) == 13


def test_postings_of_all_grams():
    """All lists are coded and decoded at once as one by one, in slices of an array too; n-grams do not cross texts."""
    lists = [[0], [0, 1, 2], [5, 127, 128, 300, 70_000, 70_001, 2**33], [3, 16_383, 16_384], [2**21]]
    first = np.cumsum([0, *map(len, lists[:-1])])
    coded = G._encoded_all(np.concatenate(lists), first)
    assert coded.to_pylist() == [G.encoded(x) for x in lists]
    for part, want in ((coded, lists), (coded.slice(1, 3), lists[1:4]), (coded.slice(0, 0), [])):
        numbers, begins = G._decoded_all(part)
        assert [numbers[a:b].tolist() for a, b in zip(begins, begins[1:])] == want
    texts = ["ab", "", "bca", "é𝕊é", "abab", "b" * 300]
    names, coded = G._inverted(texts)
    holders = {x: [k for k, t in enumerate(texts) if x in t] for x in {t[k : k + n] for t in texts for n in (1, 2, 3) for k in range(len(t) - n + 1)}}
    assert dict(zip(names, coded.to_pylist(), strict=True)) == {x: G.encoded(ks) for x, ks in holders.items()} and len(names) == len(holders)
    assert G._inverted([""])[0] == G._inverted([])[0] == []


def test_blocks_of_the_index_are_few_to_a_file(spark):
    """No file holds many blocks, nor a block many characters, however many a task writes."""
    import pyarrow.parquet as pq

    docs = spark.range(300, numPartitions=1).select("id", F.repeat(F.lit("some words "), 5000).alias("text"))
    index = G.build_grams(docs, "text", ["id"])
    blocks = index.select(F.size("rows").alias("n"), F.aggregate("texts", F.lit(0), lambda a, x: a + F.length(x)).alias("chars")).collect()
    assert sum(r.n for r in blocks) == 300 and max(r.chars for r in blocks) <= 1 << 20 and len(blocks) > 16
    assert max(pq.ParquetFile(f.removeprefix("file://")).metadata.num_rows for f in index.inputFiles()) <= 16


def test_many_queries_meet_tiles_and_keep_the_best(spark, monkeypatch, plan):
    """Every vector a query, in many tiles: as brute force, with ties, repeated ids, other lengths and short sides; no packed pair goes through a join."""
    for name, value in (("CHUNK", 16), ("QUERY_BLOCK", 5), ("TILE_BYTES", 2000)):
        monkeypatch.setattr(V, name, value, raising=False)
    values, df = vectors(spark, 150)
    odd = spark.createDataFrame([(9000, [1.0]), (9001, [2.0]), (9002, None), (9003, [])], "vec_id long, embedding array<float>")
    twice = df.filter("vec_id = 3")
    everything = df.union(odd).union(twice)
    queries = everything.select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("query"))
    found = V.vector_topk(everything, queries, 4)
    assert "Join" not in plan(found)
    got = {}
    for r in found.orderBy("query_id", F.desc("score"), "vec_id").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    near = {i: brute(np.vstack([values, values[3:4]]), values[i], 4) for i in range(150) if i not in (3, 5)}
    assert {i: got[i] for i in near} == {i: [3 if x == 150 else x for x in ids] for i, ids in near.items()}
    assert got[3] == [3, 3, 3, 3] and got[5] == [0, 1, 2, 3] and got[9000] == got[9001] == [9000, 9001]
    assert V.vector_topk(df.limit(0), queries, 4).count() == 0 and set(got) == {*range(150), 9000, 9001}


@pytest.mark.parametrize("most", [1, 10, 1 << 19])
def test_best_matches_are_kept_by_score_and_id(monkeypatch, most):
    monkeypatch.setattr(V, "TIES_AT_ONCE", most, raising=False)
    rng = np.random.default_rng(5)
    scores, ids = rng.integers(0, 4, size=(7, 60)) / 4, rng.permutation(60)
    asked = V._Asked(np.arange(7), np.eye(7), None, 5)
    for at in range(0, 60, 12):
        asked.meet(ids[at : at + 12], scores[:, at : at + 12].T.copy(), -1)
    order = [np.lexsort((ids, -row))[:5] for row in scores]
    assert asked.found.tolist() == [ids[o].tolist() for o in order]
    assert asked.scores.tolist() == [scores[k, o].tolist() for k, o in enumerate(order)]
