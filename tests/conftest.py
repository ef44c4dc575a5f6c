import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terrane import domain as D  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from terrane.session import get_spark
    s = get_spark("local[4]", 4, app="terrane-tests", extra={"spark.driver.memory": "4g"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="terrane-test-ckpt-"))
    yield s
    s.stop()


def raw_row(**kw):
    """One staging row (13 snake_case string columns); unspecified fields are NULL."""
    row = {c: None for c in D.RENAME_MAP.values()}
    row.update(kw)
    return row


@pytest.fixture
def src_df(spark):
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField(c, StringType(), True) for c in D.RENAME_MAP.values()])

    def make(rows):
        return spark.createDataFrame([tuple(r[c] for c in D.RENAME_MAP.values()) for r in rows], schema)
    return make
