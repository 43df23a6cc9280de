"""Computed inputs that are read more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from semesta.session import scratch_path


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder and read back from there.

    Meant for results that are much smaller than what they are computed from, such as the semesters present
    in a table: Catalyst's estimate for them is the size of the whole table. Read back, they have their real
    size, and Catalyst or AQE chooses the join by it, whatever it is. The folder goes with the ``temporary``
    block it was made in, or with the application.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
