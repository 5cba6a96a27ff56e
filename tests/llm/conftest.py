import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from lavra.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, app_name="lavra-llm-tests")
    yield s
    s.stop()


@pytest.fixture()
def docs_of(spark):
    """Documents table of texts, numbered from 0 (or of (doc_id, text) pairs), with a clashing extra column."""
    def make(texts):
        rows = [(i, t) if not isinstance(t, tuple) else t for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in rows],
                                     DOCS + ", node string")
    return make


@pytest.fixture(scope="session")
def small(spark):
    return {t: spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels", "pages")}
