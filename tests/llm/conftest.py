import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def edges(spark):
    """The edge rows, with columns whose names the operators use inside."""
    from brute import EDGES

    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGES, "doc_id long, text string")
    for name in ("node", "n", "key", "q", "kept", "spans", "toxic", "root", "label", "__t", "__row", "count"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def corpus(spark):
    from brute import FOLDER

    return spark.read.parquet(f"{FOLDER}/documents.parquet")
