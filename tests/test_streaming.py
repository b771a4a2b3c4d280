import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.device_events import EVENT_SCHEMA, enriched
from tidemark.plans.views import ntz
from tidemark.sources.sinks import read_newest, read_puts
from tidemark.streaming import jobs


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def done(*queries):
    for q in queries:
        q.awaitTermination(60)
        assert q.exception() is None


def lines(path, rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


def test_enrichment_equals_the_batch_form(spark, folder):
    rows = [
        {"status": "faulty", "event_type": "alert", "location": {"latitude": 1.0, "longitude": -2.0}},
        {"status": "active", "event_type": "heartbeat", "location": {"latitude": 0.0, "longitude": 0.0}},
    ]
    lines(folder / "in" / "a.json", rows)
    run = lambda: done(jobs.enrich_stream(spark, str(folder / "in"), str(folder / "out"), str(folder / "cp")))
    run()
    lines(folder / "in" / "b.json", rows[:1])
    run()
    run()
    batch = enriched(spark.createDataFrame([(r["status"], r["event_type"], tuple(r["location"].values())) for r in rows + rows[:1]], EVENT_SCHEMA))
    stream = spark.read.schema(batch.schema).json(str(folder / "out"))
    text = lambda df: sorted(r[0] for r in df.select(F.to_json(F.struct("*"))).collect())
    assert text(stream) == text(batch)


def test_orders_split_count_and_replay(spark, folder):
    bodies = ['{"order_id": "1", "amount": 5, "order_date": "2024-01-01"}', '{"order_id": "2", "amount": 0, "order_date": "2024-01-01"}', "{bad"]
    lines(folder / "in" / "a.json", [{"body": b} for b in bodies])
    now, out = ntz("2024-06-01 00:00:00"), str(folder / "out")
    done(jobs.order_stream(spark, str(folder / "in"), out, str(folder / "cp"), now))

    def check():
        good = spark.read.json(f"{out}/success")
        assert [(r.order_id, r.status) for r in good.collect()] == [("1", "SUCCESS")]
        bad = spark.read.json(f"{out}/failure")
        assert bad.count() == 2 and bad.filter("corrupt = '{bad'").count() == 1
        assert {r.status: r.n for r in spark.read.json(f"{out}/counters").collect()} == {"SUCCESS": 1, "FAILURE": 2}

    check()
    jobs.split_orders(spark.createDataFrame([(b,) for b in bodies], "body string"), 0, now, out)
    check()


def test_puts_are_idempotent(spark, folder):
    message = lambda *m: {"body": json.dumps(dict(zip(("id", "name", "age"), m)))}
    target, schema = str(folder / "table"), "id string, name string, age int, isAdult boolean"
    run = lambda: done(jobs.person_stream(spark, str(folder / "in"), target, str(folder / "cp")))
    lines(folder / "in" / "a.json", [message("1", "ann", 18), message("2", "bob", 17)])
    run()
    lines(folder / "in" / "b.json", [message("2", "zoe", 40), message("2", "rob", 40), message("3", "cy", 1), {"body": "oops"}])
    run()
    expected = [("1", "ANN", 18, True), ("2", "ROB", 40, True), ("3", "CY", 1, False)]
    table = lambda: sorted(tuple(r) for r in read_puts(spark, target, schema, ["id"]).collect())
    assert table() == expected
    replay = spark.createDataFrame([(message("2", "rob", 40)["body"],), (message("3", "cy", 1)["body"],)], "body string")
    jobs.put_persons(replay.withColumn("arrived", F.lit("2024-01-01").cast("timestamp")), 1, target)
    assert table() == expected


def test_layers(spark, folder):
    person = lambda i, age, kind: {"customer_id": str(i), "name": "n", "age": age, "subscription_type": kind, "signup_date": "2024-09-1", "active": True}
    (folder / "in" / "a.json").write_text(json.dumps([person(1, 18, "Basic"), person(2, 17, "Basic"), person(3, 50, "Gold")]))
    passed, failed, metrics = (str(folder / n) for n in ("pass", "fail", "metrics"))

    def run():
        done(*jobs.validate_stream(spark, str(folder / "in"), passed, failed, str(folder / "cp")))
        done(jobs.subscription_metrics_stream(spark, passed, metrics, str(folder / "cp2")))

    run()
    assert [r.customer_id for r in spark.read.json(passed).collect()] == ["1"]
    assert {r.customer_id: r.reason for r in spark.read.json(failed).collect()} == {"2": "age", "3": "subscription_type"}
    (folder / "in" / "b.json").write_text(json.dumps([person(4, 20, "Basic"), person(5, 20, "Premium")]))
    run()
    assert {r.subscription_type: r.customers for r in read_newest(spark, metrics, "subscription_type string, customers bigint").collect()} == {"Basic": 2, "Premium": 1}


def test_bulk_load_takes_each_file_once(spark, folder):
    target = str(folder / "table")
    columns = [("c1", "string", "place"), ("c2", "double", "sales")]
    run = lambda: done(jobs.bulk_load_stream(spark, str(folder / "in"), columns, target, str(folder / "cp")))
    (folder / "in" / "a.csv").write_text("h,h\n a , 1.5\n")
    run()
    run()
    (folder / "in" / "b.csv").write_text("h,h\nb,2\n")
    run()
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect()) == [("a", 1.5), ("b", 2.0)]


def test_refresh_runs_once_per_trigger(spark, folder):
    calls = []
    (folder / "in" / "tick.txt").write_text("1\n")
    ticks = spark.readStream.text(str(folder / "in"))
    done(jobs.periodic_refresh(ticks, lambda s: calls.append(s.range(1).count()), str(folder / "cp"), jobs.AVAILABLE))
    assert calls == [1]


def test_observed_counters_are_written_per_batch(spark, folder):
    """Counters come from the batches themselves; a failed write of them is raised."""
    now, out = ntz("2024-06-01 00:00:00"), str(folder / "out")
    start = lambda: jobs.observed_order_stream(spark, str(folder / "in"), out, str(folder / "cp"), now)
    run = lambda: jobs.counted_run(spark, start, jobs.ORDER_COUNTERS, str(folder / "counters"))
    lines(folder / "in" / "a.json", [{"body": b} for b in ('{"order_id": "1", "amount": 5, "order_date": "2024-01-01"}', "{bad")])
    run()
    lines(folder / "in" / "b.json", [{"body": '{"order_id": "2", "amount": 0, "order_date": "2024-01-01"}'}])
    run()
    run()
    counted = spark.read.json(str(folder / "counters"))
    assert sorted((r.batch_id, r.messages, r.success_count, r.failure_count) for r in counted.collect()) == [(0, 2, 1, 1), (1, 1, 0, 1)]
    sink = spark.read.schema("order_id string, status string").json(out)
    assert sorted((r.order_id or "", r.status) for r in sink.collect()) == [("", "FAILURE"), ("1", "SUCCESS"), ("2", "FAILURE")]
    lines(folder / "in" / "c.json", [{"body": "{}"}])
    with pytest.raises(Exception, match="nowhere"):
        jobs.counted_run(spark, start, jobs.ORDER_COUNTERS, f"nowhere://{folder}/counters")
