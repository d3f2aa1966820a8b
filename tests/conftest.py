import os
import sys
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidegate.sources.parsing import as_struct  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from tidegate.session import build_session

    s = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.log.level": "ERROR",
    })
    yield s
    s.stop()


@pytest.fixture
def rows(spark):
    """Build a frame from a schema string and tuples."""

    def make(schema, *data):
        kinds = [f.dataType for f in as_struct(schema).fields]

        def fit(x, kind):
            if isinstance(kind, T.DecimalType) and x is not None:
                return Decimal(str(x))
            return float(x) if isinstance(kind, T.DoubleType) and x is not None else x

        return spark.createDataFrame([tuple(map(fit, r, kinds)) for r in data], schema)

    return make


@pytest.fixture
def values(rows):
    """Evaluate expressions over one-column (or wider) literal rows."""

    def run(schema, data, **exprs):
        out = rows(schema, *data).withColumn("_i", F.monotonically_increasing_id())
        got = out.select("_i", *[c.alias(n) for n, c in exprs.items()]).orderBy("_i").collect()
        if len(exprs) == 1:
            return [r[1] for r in got]
        return [tuple(r)[1:] for r in got]

    return run
