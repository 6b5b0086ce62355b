"""Intermediate tables and their removal."""

import os

import pytest

from contrail.llm import tables


def test_what_was_landed_on_the_way_is_removed(spark):
    seen = []

    def land(n):
        out = tables.landed(spark.range(n), "rows")
        seen.append(tables.place_of(out))
        return out

    given = land(3)

    def inner():
        return land(4).crossJoin(given.selectExpr("id as other"))

    def outer():
        first = tables.settled(inner, "inner")
        seen.append(tables.place_of(first))
        assert not os.path.exists(seen[1]) and os.path.exists(seen[2])
        return first.join(land(2), "id")

    whole = tables.settled(outer, "outer")
    assert whole.count() == 6 and given.count() == 3
    assert [os.path.exists(p) for p in seen] == [True, False, False, False]
    assert os.path.exists(tables.place_of(whole)) and tables._open.scopes == []


def test_a_failure_leaves_no_scope_open(spark):
    def broken():
        tables.landed(spark.range(1), "rows")
        raise ValueError("no")

    with pytest.raises(ValueError):
        tables.settled(lambda: tables.settled(broken, "inner"), "outer")
    assert tables._open.scopes == []
