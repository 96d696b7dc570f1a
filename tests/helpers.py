"""Hand-made rows for the tests, and the registered SQL run over such rows."""

import duckdb

from tidemark.plans import oracle
from tidemark.schemas import DATASET, JOB

def history(reads, writes=None):
    writes = writes or [1] * len(reads)
    return [(1000 + 3600 * i, r, w, 1024, i % 24, 0) for i, (r, w) in enumerate(zip(reads, writes))]


def dataset(name, reads, backend="public-cold", size=100.0, writes=None, initial=None):
    h = None if reads is None else history(reads, writes)
    return (name, size, initial or backend, backend, 0, 0, 0, 0, None, h)


def datasets(spark, rows):
    return spark.createDataFrame(rows, DATASET)


def job(job_id, dataset_id="d", status="PENDING", attempts=0, created=1.0, reason="r", to="on-prem", retry=None,
        start="public-cold", duration=None):
    return (job_id, dataset_id, start, to, reason, status, attempts, created, None, None, duration, None, retry)


def jobs(spark, rows):
    return spark.createDataFrame(rows, JOB)


def by_sql(d, body, columns):
    """Rows of the SQL that ``body`` makes of the definitions in ``oracle``, over datasets with history: ``ranked`` (their
    entries, newest first), ``state`` and ``fc`` (forecast of a day)."""
    rows = [r for r in d.collect() if r.history]
    con = duckdb.connect()
    con.execute("create table state (dataset_id varchar, size_gb double, current_backend varchar, initial_backend varchar)")
    con.execute("create table ranked (dataset_id varchar, rn bigint, reads_1h bigint, writes_1h bigint, bytes_read_1h bigint)")
    for r in rows:
        con.execute("insert into state values (?, ?, ?, ?)", [r.dataset_id, r.size_gb, r.current_backend, r.initial_backend])
        con.executemany("insert into ranked values (?, ?, ?, ?, ?)", [
            [r.dataset_id, i + 1, e.reads_1h, e.writes_1h, e.bytes_read_1h] for i, e in enumerate(reversed(r.history))])
    view = lambda name, text: con.execute(f"create view {name} as {text}")
    view("prices", oracle.CTE["prices"])
    view("win", oracle.window("ranked", 24))
    view("fc", oracle.forecast("win", "state", 24))

    class Definitions:
        place = staticmethod(oracle.place)

        @staticmethod
        def window(source, hours):
            view(f"win_{hours}", oracle.window(source, hours))
            return f"win_{hours}"

        forecast = staticmethod(oracle.forecast)

    return con.execute(f"select {columns} from ({body(Definitions)})").fetchall()
