import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    from strata.llm.queries import prepare
    from strata.session import build_session
    s = build_session("local[4]", app_name="strata-llm-tests", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="strata-llm-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    prepare(s)
    yield s


@pytest.fixture()
def make_docs(spark):
    """Documents from (doc_id, text[, source]); columns whose names an operator uses inside
    are added, to clash with them."""
    def make(*rows):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0) for r in rows]
        df = spark.createDataFrame(rows, DOCS)
        from pyspark.sql import functions as F
        for name in ("size", "node", "score", "uid", "key", "kept", "length", "_row", "_b", "_id", "_sha", "_text", "_rejected", "id", "i", "s", "row"):
            df = df.withColumn(name, F.lit("clash"))
        return df
    return make


@pytest.fixture()
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
