import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerloom.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        {
            "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def transactions(spark):
    """100 rows in the shape of the training sample: keys, a category, numbers and a rare label."""
    rng = random.Random(42)
    rows = [
        (
            i, rng.randint(1, 19), rng.uniform(10, 1000), rng.choice(["retail", "food", "transport", "online"]),
            rng.randint(0, 23), rng.randint(0, 6), rng.randint(0, 1), rng.uniform(0, 100),
            1 if rng.random() < 0.2 else 0,
        )
        for i in range(1, 101)
    ]
    return spark.createDataFrame(
        rows,
        "transaction_id long, customer_id long, amount double, merchant_category string, transaction_hour long, "
        "day_of_week long, is_weekend long, distance_from_home double, target long",
    ).repartition(3)


@pytest.fixture(scope="session")
def transactions_with_nulls(spark):
    rng = random.Random(7)
    rows = [
        (
            i, rng.randint(1, 19), None if i % 10 == 0 else rng.uniform(10, 1000),
            None if i % 4 == 0 else rng.choice(["retail", "food", "transport"]), rng.randint(0, 23), rng.randint(0, 1),
        )
        for i in range(1, 51)
    ]
    return spark.createDataFrame(
        rows,
        "transaction_id long, customer_id long, amount double, merchant_category string, transaction_hour long, "
        "target long",
    )


@pytest.fixture(scope="session")
def model_rows(spark):
    """Rows with five numbers and a label that two of them decide, with some noise."""
    rng = random.Random(42)
    rows = []
    for i in range(300):
        x = [rng.random() for _ in range(5)]
        label = int(x[0] + x[1] > 1) if rng.random() > 0.05 else rng.randint(0, 1)
        rows.append((i, *x, label))
    schema = "row_id long, " + ", ".join(f"feature_{j} double" for j in range(1, 6)) + ", target long"
    return spark.createDataFrame(rows, schema)
