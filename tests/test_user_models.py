"""Ridge models kept as keyed state."""

import datetime as dt

import numpy as np

from quillrank.streaming import user_models as um

SCHEMA = "user_id string, reward double, x array<double>, at timestamp"
D = 3


def events(seed, users, minutes):
    rng = np.random.default_rng(seed)
    start = dt.datetime(2024, 1, 1)
    return [(u, float(rng.integers(2)), [float(v) for v in rng.normal(size=D)], start + dt.timedelta(minutes=m))
            for u, m in zip(users, minutes)]


def write(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def batch(rows, ridge=0.1):
    want = {}
    for user in {r[0] for r in rows if r[0] is not None}:
        own = [r for r in rows if r[0] == user]
        x = np.array([r[2] for r in own if r[2] is not None]).reshape(-1, D)
        y = np.array([r[1] or 0.0 for r in own if r[2] is not None])
        want[user] = (len(own), np.linalg.solve(ridge * np.eye(D) + x.T @ x, x.T @ y))
    return want


def agree(table, want):
    got = {r.user_id: (r.n, np.array(r.theta)) for r in table.collect()}
    assert got.keys() == want.keys()
    for user, (n, theta) in want.items():
        assert got[user][0] == n
        np.testing.assert_allclose(got[user][1], theta, atol=1e-8)


def test_absorb_is_the_inverse_of_the_sum():
    rng = np.random.default_rng(1)
    a, x = np.eye(4) * 0.3, rng.normal(size=(6, 4))
    step = np.linalg.inv(a)
    for row in x:
        step = um.absorb(step, row[None])
    for got in (step, um.absorb(np.linalg.inv(a), x)):
        np.testing.assert_allclose(got, np.linalg.inv(a + x.T @ x), atol=1e-10)


def test_stream_equals_batch_after_a_restart_and_with_late_events(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    first = events(1, ["hot"] * 40 + ["a", "b"], range(42)) + [(None, 1.0, [1.0] * D, None), ("bare", 1.0, None, None)]
    write(spark, folder, "1", first)
    agree(um.stream_user_models(stream(spark, folder), D, path=path), batch(first))
    second = events(2, ["hot", "c", "a"], [-5000, 3, 9000])
    write(spark, folder, "2", second)
    agree(um.stream_user_models(stream(spark, folder), D, path=path), batch(first + second))
    agree(um.stream_user_models(stream(spark, folder), D, path=path), batch(first + second))


def test_idle_users_leave_and_start_anew(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    old, far = events(3, ["a", "b", "a"], [0, 1, 2]), events(4, ["b"], [3000])
    for name, rows in (("1", old), ("2", far)):
        write(spark, folder, name, rows)
        table = um.stream_user_models(stream(spark, folder), D, idle="10 minutes", delay="1 minute", path=path)
    assert {r.user_id: r.expired for r in table.collect()}["a"]
    assert {r.user_id: r.n for r in table.collect()}["a"] == 2
    write(spark, folder, "3", events(5, ["a"], [3001]) + events(6, ["b"], [5]))  # the last comes too late
    table = um.stream_user_models(stream(spark, folder), D, idle="10 minutes", delay="1 minute", path=path)
    got = {r.user_id: (r.n, r.expired) for r in table.collect()}
    assert got["a"] == (1, False)


def test_a_batch_of_states_is_bounded_by_bytes(spark, tmp_path, monkeypatch):
    """Rows of an Arrow batch are as few as their matrices are large, and the session's setting is put back."""
    name, sizes = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(name)
    real = um.latest
    monkeypatch.setattr(um, "latest", lambda *a: sizes.append(int(spark.conf.get(name))) or real(*a))
    monkeypatch.setattr(um, "BATCH_BYTES", 8 * D * D * 2)
    folder = str(tmp_path / "in")
    rows = events(7, [f"u{k % 13}" for k in range(60)], range(60))
    write(spark, folder, "1", rows)
    agree(um.stream_user_models(stream(spark, folder), D, path=str(tmp_path / "out")), batch(rows))
    assert sizes == [2]
    assert spark.conf.get(name) == before
