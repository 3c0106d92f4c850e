"""Upserts against a plain dictionary."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lexitrack.operators import maintain

SCHEMA = "id long, user_id string, word_id long, marking int, updated_at timestamp_ntz"
T0 = dt.datetime(2026, 1, 1)

times = st.one_of(st.none(), st.integers(0, 3).map(lambda d: T0 + dt.timedelta(days=d)))
changes = st.lists(
    st.tuples(st.sampled_from("ab"), st.integers(1, 3), st.one_of(st.none(), st.integers(0, 5)), times), max_size=12)


def rank(v, t, i):
    """Order of rows of one key: time, id, code, missing values first."""
    return (t is not None, t or T0, i, v is not None, v or 0)


def apply(table, batch):
    """Table {key: (id, code, time)} after a batch of (id, user, word, code, time)."""
    newest = {}
    for i, u, w, v, t in batch:
        if (u, w) not in newest or rank(v, t, i) > newest[u, w][0]:
            newest[u, w] = (rank(v, t, i), v, t)
    out = dict(table)
    for key, (_, v, t) in newest.items():
        first = table[key][0] if key in table else min(i for i, u, w, _, _ in batch if (u, w) == key)
        out[key] = (first, v, t)
    return out


def numbered(rows, start):
    return [(start + i, *r) for i, r in enumerate(rows)]


def as_dict(df):
    rows = [tuple(r) for r in df.collect()]
    out = {(r[1], r[2]): (r[0], r[3], r[4]) for r in rows}
    assert len(out) == len(rows)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(log=changes, batches=st.lists(changes, max_size=2))
def test_upsert_sequence(spark, log, batches):
    log = numbered(log, 1)
    frame = maintain.latest_markings(spark.createDataFrame(log, SCHEMA))
    table = apply({}, log)
    assert as_dict(frame) == table
    for n, batch in enumerate(batches, 1):
        batch = numbered(batch, 100 * n)
        frame = maintain.upsert_markings(frame, spark.createDataFrame(batch, SCHEMA))
        table = apply(table, batch)
        assert as_dict(frame) == table
