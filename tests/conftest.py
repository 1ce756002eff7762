import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from quern.session import local_session

    session = local_session(8, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    from quern.staging import release

    release(session)
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """The generic table: gaps, copies, constants, extremes and awkward texts."""
    rows = []
    for i in range(1, 201):
        rows.append(
            (
                i,
                None if i % 10 == 0 else float(i % 37) - 5.0,
                i * i % 101,
                7.0,
                "abcd"[i % 4],
                f"u{i:03d}",
                ["Yes", "no", "1", "0", "t"][i % 5],
                f"2024-01-{1 + i % 28:02d}",
                float((i * 7919) % 1000) / 10,
            )
        )
    return spark.createDataFrame(
        rows,
        "id bigint, num_a double, num_b bigint, const double, cat_lo string, cat_hi string, flag string, when string, "
        "target double",
    )
