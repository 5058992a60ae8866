import sys
from pathlib import Path

import public_tokenizers
import pytest

sys.path.append(str(Path(__file__).resolve().parent))

DOCS = "doc_id long, text string, lang string, n_words long, score double, node string, digest string, part int"


@pytest.fixture(scope="session", autouse=True)
def shared(spark, tmp_path_factory):
    """A folder for kept tables where the session names none, and the package on the workers."""
    from flowspark.llm.common import shipped

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    shipped(lambda session: None)(spark)


@pytest.fixture(scope="session")
def bpe():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture()
def docs(spark):
    """Builds documents from (doc_id, text) with further columns whose names the operators use themselves."""

    def build(rows):
        return spark.createDataFrame([(i, t, "en", 7, 0.5, "x", "y", 1) for i, t in rows], DOCS)

    return build
