"""Queries of the package against their SQL."""

from __future__ import annotations

import pytest
from compare import connect, difference

from ledgerline.llm.oracle import ORACLE
from ledgerline.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sf, name) -> None:
    assert difference(QUERIES[name](spark, sf), connect(sf), ORACLE[name]) is None
