import datetime as dt
import itertools
import math

import numpy as np
import pytest

from motionloom.operators.units import common_units, decode, note_code, number_of, text_code, unit_code, viterbi

READING = "reading_id long, robot_id string, episode_index long, representation string, control_type string, unit string, value double, value_text string, note string, read_at timestamp"
SEMANTICS = "robot_id string, modality string, component int, representation string, control_type string, unit string, periodic boolean, coordinate_frame string"
T = lambda i: dt.datetime(2025, 1, 1) + dt.timedelta(minutes=i)


def test_spellings_and_notes():
    assert unit_code("N·cm", "joint_torque") == "Ncm" and unit_code(" Rad.", "joint_position") == "rad" and unit_code("M ", "cartesian_position") == "m"
    assert unit_code("rad", "joint_torque") is None and unit_code("n/a", "joint_position") is None
    assert note_code("value given in in.", "cartesian_position") == "in"
    assert note_code("operator confirms fraction, not the importer default", "gripper_position") == "dimensionless"
    assert note_code("Werte in rad s^-1", "joint_velocity") == "rad/s" and note_code("(all numbers per cent)", "gripper_position") == "percent"
    for remark in ("cable slack about 30 mm, reseated", "retaken after the base moved 2 m", "see card 14", "", None):
        assert note_code(remark, "cartesian_position") is None
    assert number_of("~ -1,25rad") == -1.25 and number_of("= 1.234,5 mm") == 1234.5 and number_of("err") is None and number_of(None) is None
    assert text_code("0.5  deg", "joint_position") == "deg" and text_code("deg", "joint_position") is None


def test_common_units(spark):
    s = spark.createDataFrame([("r1", "sensor", None, "joint_position", None, "deg", None, None)] * 2, SEMANTICS)
    rows = [
        (1, "r1", 1, "joint_position", None, "rad", 90.0, "90 mrad", "unit: deg", T(1)), (2, "r1", 1, "joint_position", None, "rad", None, "90 mrad", None, T(2)), (3, "r1", 1, None, "delta_joint_position", "rad", 1.0, None, "ok", T(3)),
        (4, "r1", 1, "joint_position", None, "?", 180.0, None, None, T(4)), (5, "r1", 1, "joint_position", None, None, float("nan"), "---", None, T(5)), (6, "r1", 1, "mystery", None, None, 1.0, None, None, T(6)),
        (7, None, 1, "eef_pose", "eef_pose", "cm", 1.0, None, None, None), (8, None, None, "cartesian_position", None, "cm", 0.0, None, None, None),
    ]
    r = spark.createDataFrame(rows + rows[:1], READING)
    got = {x["reading_id"]: (x["unit"], x["stated_by"], x["common_value"]) for x in common_units(r, s).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 8}
    assert got[1][:2] == ("deg", "note") and got[1][2] == pytest.approx(math.pi / 2)
    assert got[2][:2] == ("mrad", "value_text") and got[2][2] == pytest.approx(0.09)
    assert got[3][:2] == ("rad", "unit") and got[4][:2] == ("deg", "declaration") and got[5][2] is None and got[8] == ("cm", "unit", 0.0)
    assert common_units(r.where("false"), s).count() == 0


M = np.log([1.0, 1e-3])


def blocks(scale, own=None, weak=0, declared=True):
    n = len(scale)
    true = np.exp(np.random.default_rng(4).normal(0, 0.3, n))
    full = lambda v: np.full(n, v) if np.isscalar(v) else v
    return decode(np.log(true * scale), full(-1) if own is None else own, full(weak), np.full(n, declared), M)


def test_unstated_units_follow_the_level():
    scale = np.where((np.arange(200) >= 80) & (np.arange(200) < 140), 1000.0, 1.0)
    weak = np.where(np.arange(200) < 5, 0, -1)
    unit, _ = blocks(scale, weak=weak)
    assert unit.tolist() == [int(s > 1) for s in scale]


@pytest.mark.parametrize("declared", [True, False])
def test_a_sustained_jump_overrules_a_bare_statement_and_a_single_one_does_not(declared):
    at = np.arange(2000)
    stretch = (at >= 800) & (at < 840)
    unit, overruled = blocks(np.where(stretch, 1000.0, 1.0), declared=declared)
    assert (unit == stretch).all() and (overruled == stretch).all()
    unit, overruled = blocks(np.where(at == 900, 1000.0, 1.0), declared=declared)
    assert not unit.any() and not overruled.any()


def test_what_a_reading_says_itself_is_never_overruled():
    at = np.arange(2000)
    stretch = (at >= 800) & (at < 840)
    own = np.where(stretch, 0, -1)
    unit, overruled = blocks(np.where(stretch, 1000.0, 1.0), own=own)
    assert not unit.any() and not overruled.any()


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(7)
    emit, move = rng.normal(size=(6, 3)), rng.normal(size=(3, 3))
    score = lambda p: emit[range(6), p].sum() + sum(move[a, b] for a, b in zip(p, p[1:])) + move[0, p[0]]
    best = max(itertools.product(range(3), repeat=6), key=score)
    assert viterbi(emit, move).tolist() == list(best)


def test_blocks_do_not_change_stated_units(spark):
    s = spark.createDataFrame([], SEMANTICS)
    r = spark.createDataFrame([(i, "r1", 1, "joint_torque", None, ("Nm", "mNm")[i % 3 == 0], 1.0 + i, None, None, T(i)) for i in range(300)], READING)
    a, b = ({x["reading_id"]: x["unit"] for x in common_units(r, s, n).collect()} for n in (50_000, 40))
    assert a == b and len(a) == 300
