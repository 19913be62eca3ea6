"""One session for all tests."""

from __future__ import annotations

import datetime as dt

import pytest

from motionloom.session import local_session

FRAME = "global_index long, episode_index long, frame_index long, t double, task_index long, state array<float>, action array<float>, received_at timestamp"
START = dt.datetime(2025, 1, 6)


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", 4, "tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def frames(spark):
    """Builds frames of one episode from rows of state (and action), at a given rate."""

    def build(states, actions=None, episode=1, first=0, fps=10.0, times=None, width=2, extra=()):
        rows = []
        for i, s in enumerate(states):
            a = (actions or states)[i]
            t = times[i] if times else i / fps
            rows.append((first + i, episode, i, t, 0, s, a, START + dt.timedelta(seconds=i)))
        return spark.createDataFrame(rows + list(extra), FRAME)

    return build


@pytest.fixture(scope="session")
def episodes(spark):
    def build(*numbers, robot="r1", fps=10.0, length=None):
        rows = [(n, robot, 0, fps, length, 0, length, True, START, START, None) for n in numbers]
        return spark.createDataFrame(
            rows, "episode_index long, robot_id string, task_index long, fps double, length long, dataset_from_index long, dataset_to_index long, is_episode_successful boolean, recorded_at timestamp, registered_at timestamp, withdrawn_at timestamp"
        )

    return build
