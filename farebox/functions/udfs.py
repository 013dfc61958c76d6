"""The one Python function in the library: hour of day as an Arrow-batched UDF.

Kept only as the comparison variant of ``hour()``; ``hour()`` stays in the JVM
and is the default everywhere.  The pandas form moves whole Arrow batches
instead of pickling one row at a time.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


@F.pandas_udf(IntegerType())
def hour_udf(ts: pd.Series) -> pd.Series:
    # Spark hands timestamps over as session-zone wall-clock values, so this
    # agrees with hour() for both TIMESTAMP and TIMESTAMP_NTZ input.
    return ts.dt.hour.astype("Int32")
