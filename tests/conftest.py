import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tonescale.runtime import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", memory="4g", shuffle_partitions=4)
    yield session
    session.stop()


def rows(frame, *columns):
    """Sorted tuples of the named (or all) columns."""
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.fixture(scope="session")
def edge_documents(spark):
    """Documents with the traps of cleaning, dedup and labels."""
    data = [
        (1, "Profit ROSE, strongly!", "positive"),
        (2, "Profit ROSE, strongly!", "negative"),
        (3, "profit rose strongly", "neutral"),
        (4, "   ", "neutral"),
        (5, "!!! ... ---", "neutral"),
        (6, None, "positive"),
        (7, None, "neutral"),
        (8, "up\N{NO-BREAK SPACE}down\N{EM SPACE}x", "positive"),
        (9, "don't re-enter 3.5%", None),
        (10, "“Strong” – GROWTH", "neutral"),
        (11, "loss loss profit", " Positive "),
        (12, "profit loss", "mixed"),
        (13, "", "neutral"),
        (14, "CAFÉ\tÜBER\nStraße", "neutral"),
    ]
    return spark.createDataFrame(data, "doc_id bigint, text string, label string")


@pytest.fixture(scope="session")
def edge_lexicon(spark):
    from tonescale.operators.scoring import lexicon_table

    return lexicon_table(
        spark, {"Profit": 1, "rose": 1, "strong": 1, "growth": 1, "up": 1, "loss": -1}
    )
