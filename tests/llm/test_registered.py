import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from compare import assert_same

from folio.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows_as_sql(spark, smallest, name):
    assert_same(spark, smallest, registry.QUERIES[name], registry.ORACLE_SQL[name])


def test_native_plans_hold_no_python(spark, smallest):
    for name in ("op5_line_dedup", "op6_chat", "op8_decontaminate"):
        plan = registry.QUERIES[name](spark, smallest)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
