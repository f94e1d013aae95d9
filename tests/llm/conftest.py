import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark):
    """The documents and some odd ones: null, empty, white space, short, repeated rows, extra columns."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = [
        (900_001, None),
        (900_002, ""),
        (900_003, " \n\t"),
        (900_004, "A b"),
        (900_005, "a  B"),
        (900_006, "a b c d e"),
        (900_006, "a b c d e"),
        (None, "a b c d e"),
        (900_007, "long " * 30_000),
        (900_008, "x" * 50_000),
    ]
    return docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
