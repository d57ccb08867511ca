import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from odoscore.session import get_spark  # noqa: E402

BASE = {
    "customer_id": "C1", "tenure_months": 9, "contract_type": "month_to_month",
    "payment_method": "bank_transfer", "internet_service": "dsl", "monthly_charges": 81.25,
    "total_charges": 731.25, "online_security": 0, "online_backup": 0, "device_protection": 1, "tech_support": 0,
    "streaming_tv": 1, "streaming_movies": 0, "multiple_lines": 0, "senior_citizen": 0, "has_partner": 1,
    "has_dependents": 0, "paperless_billing": 0, "churn": 0,
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark("tests", master="local[4]", extra={
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def customers(spark):
    """Snapshot rows from overrides of one base row."""
    from odoscore.schemas import SNAPSHOT, SNAPSHOT_COLUMNS

    def make(*overrides):
        rows = [dict(BASE, **o) for o in (overrides or ({},))]
        return spark.createDataFrame([tuple(r.get(c) for c in SNAPSHOT_COLUMNS) for r in rows], SNAPSHOT)

    return make
