import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskframe.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[*]", 8, app="riskframe-tests",
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="riskframe-test-ckpt-")})
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="riskframe-test-")


@pytest.fixture()
def raw_fixture(spark):
    """The reference's 4-row, 22-column transaction fixture (2 rows per class)."""
    rows = [
        ("2020-06-21 12:14:25", "1234", "merchant_a", "grocery_pos", 100.0, "John", "Doe", "M", "123 St", "CityX",
         "CA", "90001", 34.05, -118.24, 100000, "Engineer", "1980-01-01", "txn1", 1234567890, 34.06, -118.23, 0),
        ("2020-06-21 12:14:25", "5678", "merchant_b", "shopping_net", 250.0, "John", "Doe", "F", "123 St", "CityX",
         "TX", "73301", 30.26, -97.74, 200000, "Doctor", "1990-01-01", "txn2", 1234567890, 30.30, -97.78, 1),
        ("2020-06-21 12:14:25", "9101", "merchant_a", "grocery_pos", 15.0, "John", "Doe", "M", "123 St", "CityX",
         "CA", "90001", 34.05, -118.24, 100000, "Engineer", "1980-01-01", "txn3", 1234567890, 34.06, -118.23, 0),
        ("2020-06-21 12:14:25", "1121", "merchant_c", "misc_net", 40.0, "John", "Doe", "F", "123 St", "CityX",
         "NY", "10001", 40.71, -74.00, 300000, "Artist", "1975-01-01", "txn4", 1234567890, 40.73, -73.99, 1),
    ]
    from riskframe.sources.io import TX_SCHEMA
    return spark.createDataFrame(rows, TX_SCHEMA)
