import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from affinity.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", shuffle_partitions=8, app="affinity-tests")
    yield s
    s.stop()


# FIXTURES.md §2.2: hand-sized grades (sno, cno, score, cohort).
GRADES = [
    ("s1", "a", 50.0, "2015级"), ("s1", "b", 60.0, "2015级"), ("s1", "c", 85.0, "2015级"),
    ("s2", "a", 40.0, "2015级"), ("s2", "c", 65.0, "2015级"),
    ("s3", "a", 60.0, "2015级"), ("s3", "b", 55.0, "2015级"), ("s3", "c", 68.0, "2015级"),
    ("s4", "a", 69.5, "2016级"), ("s5", "b", 70.0, "2015级"),
    ("p1", "a", 45.0, "2016级"), ("p2", "b", 64.0, "2016级"), ("p2", "c", 30.0, "2016级"),
    ("p3", "a", 65.0, "2016级"),
]
HOLDOUT = "2016级"


@pytest.fixture(scope="session")
def grades(spark):
    rows = [(s, c, v, None, h) for s, c, v, h in GRADES]
    return spark.createDataFrame(rows, "sno string, cno string, score double, term string, cohort string")


def as_dict(df, key=("item1", "item2"), val="sim"):
    return {tuple(r[k] for k in key): r[val] for r in df.collect()}
