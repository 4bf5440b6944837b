import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from goldens import TITLES  # noqa: E402

from textweft.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", shuffle_partitions=4)


@pytest.fixture(scope="session")
def titles(spark):
    from pyspark.sql import functions as F

    from textweft.functions import text as tx
    from textweft.sources.lines import from_documents

    words = tx.remove_stopwords(tx.tokenize_ws(F.col("text")))
    return from_documents(spark, TITLES).select("doc_id", words.alias("words"))
