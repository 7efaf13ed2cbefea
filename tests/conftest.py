import datetime as dt

import pytest

from gaugeworks import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="tests", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    return session


def t(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df) -> set:
    return {tuple(r) for r in df.collect()}


def dicts(df, *key) -> dict:
    """Rows as dicts by key tuple (or single key value)."""
    out = {}
    for r in df.collect():
        name = r[key[0]] if len(key) == 1 else tuple(r[k] for k in key)
        assert name not in out
        out[name] = r.asDict()
    return out
