import datetime
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import ledger

START = datetime.datetime(2024, 1, 1)


def events(spark, rows):
    """Rows of (job, seq, status); the time follows seq."""
    timed = [(j, s, status, START + datetime.timedelta(minutes=s)) for j, s, status in rows]
    return spark.createDataFrame(timed, "job_id string, seq long, status string, at timestamp")


LIFE = [
    ("a", 1, "pending"),
    ("a", 2, "running"),
    ("a", 3, "paused"),
    ("a", 4, "running"),
    ("a", 5, "completed"),
    ("b", 6, "pending"),
    ("b", 7, None),
    ("c", 8, "pending"),
    ("c", 9, "completed"),
    ("a", 10, "rolled_back"),
]


def test_latest_state(spark):
    state = {r.job_id: r for r in ledger.latest_state(events(spark, LIFE)).collect()}
    assert {j: r.status for j, r in state.items()} == {
        "a": "rolled_back",
        "b": "pending",
        "c": "completed",
    }
    assert state["a"].n_events == 6
    assert state["b"].last_seq == 7


def test_a_job_without_any_status_has_none(spark):
    assert ledger.latest_state(events(spark, [("x", 1, None)])).first().status is None


def test_latest_state_uses_hash_aggregation(spark, plan_of):
    plan = plan_of(ledger.latest_state(events(spark, LIFE)))
    assert "HashAggregate" in plan
    assert "SortAggregate" not in plan


def test_status_times(spark):
    row = ledger.status_times(events(spark, LIFE)).where("job_id = 'a'").first()

    def minute(at):
        return (at - START).seconds // 60

    assert minute(row.first_started_at) == 2
    assert minute(row.started_at) == 4
    assert minute(row.completed_at) == 5
    assert minute(row.rolled_back_at) == 10
    assert row.failed_at is None


def test_listing_is_newest_first(spark):
    state = ledger.latest_state(events(spark, LIFE))
    assert [r.job_id for r in ledger.with_status(state, None).collect()] == ["c", "b", "a"]
    assert [r.job_id for r in ledger.with_status(state, "pending").collect()] == ["b"]


def test_bad_transitions(spark):
    found = ledger.bad_transitions(spark, events(spark, [r for r in LIFE if r[2]]))
    assert [(r.job_id, r.previous_status, r.status) for r in found.collect()] == [
        ("c", "pending", "completed")
    ]


STATUS_RUNS = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "cold"]), st.sampled_from(ledger.STATUSES)), max_size=60
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(STATUS_RUNS, st.sampled_from([1, 7, 1 << 17]))
def test_transitions_across_chunks(spark, runs, width):
    rows = [(job, 3 * i, status) for i, (job, status) in enumerate(runs)]
    last, expected = {}, []
    for job, seq, status in rows:
        if (last.get(job, "none"), status) not in ledger.ALLOWED_CHANGES:
            expected.append((job, seq, last.get(job, "none"), status))
        last[job] = status
    found = ledger.bad_transitions(spark, events(spark, rows), chunk_width=width)
    got = [(r.job_id, r.seq, r.previous_status, r.status) for r in found.collect()]
    assert sorted(got) == sorted(expected)


RUNS = [
    # pair, run, status, last id, start, dry run
    ("p", 1, "completed", 100, None, False),
    ("p", 2, "completed", 900, 100, True),
    ("p", 3, "failed", 950, 100, False),
    ("q", 4, "completed", 50, None, False),
    ("q", 5, "completed", None, 50, False),
    ("r", 6, "running", 10, None, False),
]


def test_resume_points_skip_dry_and_unfinished_runs(spark):
    runs = spark.createDataFrame(
        RUNS, "pair string, run long, status string, last_id long, start long, dry_run boolean"
    )
    points = ledger.resume_points(runs, ["pair"], "run", "last_id", "start").collect()
    assert {r.pair: r.resume_after for r in points} == {"p": 100, "q": 50}
    latest = ledger.latest_completed(runs, ["pair"], "run", ["run", "last_id"]).collect()
    assert {r.pair: r.run for r in latest} == {"p": 2, "q": 5}


def test_error_pages_round_trip(spark):
    entries = [("j", i // 3, i, f'bad "{i}" \\ é \U0001f600') for i in range(10)]
    errors = spark.createDataFrame(entries, "job string, page long, id long, error string")
    pages = ledger.error_pages(errors, ["job", "page"])
    by_page = {r.page: r for r in pages.collect()}
    assert {p: r.total for p, r in by_page.items()} == {0: 3, 1: 3, 2: 3, 3: 1}
    assert [e["id"] for e in json.loads(by_page[1].errors)] == [3, 4, 5]
    back = ledger.parse_errors(pages, ["page"]).orderBy("id").collect()
    assert [(r.page, r.id, r.error) for r in back] == [e[1:] for e in entries]


def test_json_array_append(spark):
    row = spark.range(1).select(
        F.to_json(
            F.array_append(
                F.from_json(F.lit('[{"id":1,"error":"a"}]'), "array<struct<id:bigint,error:string>>"),
                F.struct(F.lit(2).cast("long").alias("id"), F.lit("b").alias("error")),
            )
        )
    )
    assert json.loads(row.first()[0]) == [{"id": 1, "error": "a"}, {"id": 2, "error": "b"}]
