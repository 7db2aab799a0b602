"""How often a query reads its tables, in the plan that ran."""

import pytest
from catalog.queries import REGISTRY
from conftest import executed_plan


def scans(df):
    """Scans of the final adaptive plan; what a reused exchange stands for is not read again."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = executed_plan(df)
    return plan.split("== Initial Plan ==")[0].count("FileScan") or plan.count("FileScan")


@pytest.mark.parametrize(
    ("name", "most"),
    [("quality_gates", 2), ("recommendations", 1), ("pii_residual_audit", 1), ("structure_rows_changed", 2), ("quick_stats", 1)],
)
def test_scans(spark, tiny, name, most):
    assert scans(REGISTRY[name](spark, tiny)) <= most


@pytest.mark.parametrize("name", ["pii_redact_documents", "pii_redact_pages", "pii_redact_seeded", "annotation_records"])
def test_no_shuffle(spark, tiny, name):
    assert "Exchange" not in executed_plan(REGISTRY[name](spark, tiny))


def test_nothing_is_cached(spark, tiny):
    for name in ("quick_stats", "review_report"):
        assert "InMemoryTableScan" not in executed_plan(REGISTRY[name](spark, tiny))
