import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from annolake.session import get_session
    s = get_session("local[4]", shuffle_partitions=8, extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def recordings(spark):
    return spark.createDataFrame(
        [("exp1", "C1", "2024-06-01", "09:00:00", "dev1", "recording_1.wav", 62000),
         ("exp1", "C2", "2024-06-02", "10:30:00", "dev1", "recording_2.wav", 52000)],
        "experiment string, child_id string, date_iso string, start_time string, "
        "recording_device string, recording_filename string, duration long")


@pytest.fixture(scope="session")
def annotations(spark):
    return spark.createDataFrame(
        [("human", "recording_1.wav", "recording_1.wav", 0, 42000, 60000, "recording_1_0_60000"),
         ("human", "recording_1.wav", "recording_1.wav", 0, 0, 38000, "recording_1_0_60000"),
         ("human", "recording_2.wav", "recording_2.mp3", 5000, 15000, 45000, "recording_2_15000_45000")],
        "set string, recording_filename string, raw_filename string, time_seek long, "
        "range_onset long, range_offset long, annotation_filename string")
