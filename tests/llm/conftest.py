import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_texts import prose  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from tidal.session import get_spark, ship_package
    s = get_spark(master="local[4]", shuffle_partitions=3, app_name="tidal-llm-tests")
    ship_package(s)
    yield s


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty, repeated rows, a long text, near copies, clashing columns."""
    base = prose(1, 60)
    near = base.replace(base.split()[30], "changed")
    rows = [(1, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", None), (4, None, None, "b"), (5, "", "en", "b"),
            (6, "short text", "en", "b"), (7, prose(5, 9000), "en", "a"), (8, "mail jo@mail.example.com or +1 (017) 555-7713", "en", "b"),
            (8, "mail jo@mail.example.com or +1 (017) 555-7713", "en", "b"), (None, prose(9, 40), "en", "c"),
            (10, "You idiot, you stupid moron. " + prose(3, 30), "en", "a")]
    return spark.createDataFrame([(*r, 1.5, "x") for r in rows],
                                 "doc_id long, text string, lang string, source string, score double, spans string")
