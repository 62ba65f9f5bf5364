import os

import pytest

SF = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

LONG = "lorem ipsum dolor " * 4000
#: id, text, then columns whose names clash with those that operators make.
EDGE = [
    (1, "alpha beta gamma delta epsilon", "x", 1, "t"),
    (2, None, "x", 2, None),
    (3, "", None, 3, "t"),
    (None, "alpha beta gamma delta epsilon", "x", 4, "t"),
    (5, LONG, "x", None, "t"),
    (6, LONG, "x", 6, "t"),
    (7, " \n\t ", "x", 7, "t"),
    (7, " \n\t ", "x", 7, "t"),
    (8, "Ünïcödé 世界 😀 text", "x", 8, "t"),
    (8, "another text under a repeated id", "x", 8, "t"),
]
EDGE_SCHEMA = "doc_id bigint, text string, kept string, id bigint, name string"


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    spark.createDataFrame(EDGE, EDGE_SCHEMA).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(edge):
    return edge.where("doc_id = -1")


def table(spark, name, sf=SF):
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


def dicts(df):
    """Rows as dictionaries; a row id as a tuple."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    for r in out:
        for k, v in r.items():
            if isinstance(v, dict) and set(v) == {"file", "row"}:
                r[k] = (v["file"], v["row"])
    return out
