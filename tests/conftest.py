from __future__ import annotations

import pytest

from affinis.session import local_session

# (user, item, rating)
INTRO = [
    (1, 101, 5.0), (1, 102, 3.0), (1, 103, 2.5),
    (2, 101, 2.0), (2, 102, 2.5), (2, 103, 5.0), (2, 104, 2.0),
    (3, 101, 2.5), (3, 104, 4.0), (3, 105, 4.5), (3, 107, 5.0),
    (4, 101, 5.0), (4, 103, 3.0), (4, 104, 4.5), (4, 106, 4.0),
    (5, 101, 4.0), (5, 102, 3.0), (5, 103, 2.0), (5, 104, 4.0), (5, 105, 3.5), (5, 106, 4.0),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "4g", str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def intro(spark):
    return spark.createDataFrame(INTRO, "user_id bigint, item_id bigint, rating double")


def as_dict(df, keys, value):
    return {
        tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r[value] for r in df.collect()
    }
