import os
from collections import defaultdict

import numpy as np
import pytest

from motionloom.llm import mixing
from motionloom.llm.mixing import Mix, sources_of_slots
from motionloom.llm.tokens import VOCABULARY, encoder

pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary files")
DOC, TARGET = "doc_id long, text string, source string, slot int", "source string, target_share double, max_repeats int"


def test_mix_keeps_shares_and_caps(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS_PER_CHUNK", 16)
    docs = [(i, f"word number {i} " * (1 + i % 7), ("A b", "a-B ", "c", "tiny", None, "other")[i % 6], 1) for i in range(300)]
    docs += [(i, "long text " * 200, "c", 1) for i in range(300, 304)] + [(400, None, "c", 1), (401, "", "c", 1), docs[0]]
    targets = [("a_b", 0.5, 3), ("c", 0.2, 1), ("tiny", 0.2, 2), ("absent", 0.1, 5), ("other", None, 2)]
    m = Mix(spark.createDataFrame(docs, DOC), spark.createDataFrame(targets, TARGET), block=32)
    report = {r["source"]: r for r in m.report().collect()}
    pieces = m.pieces().collect()
    size = encoder(VOCABULARY)
    tokens = {d: size([t or ""])[0] for d, t, *_ in docs}
    used, slots, cover = defaultdict(int), defaultdict(set), defaultdict(list)
    for p in pieces:
        used[p["source"]] += p["to_token"] - p["from_token"]
        slots[p["source"]].add(p["slot"])
        cover[p["doc_id"], p["repeat"]].append((p["from_token"], p["to_token"]))
    for s, r in report.items():
        assert used[s] == r["tokens_mixed"], s
        assert r["short"] == (r["tokens_available"] * r["max_repeats"] < r["target_share"] * m.total)
    for (d, rep), spans in cover.items():
        spans.sort()
        assert spans[0][0] == 0 or rep >= 0
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= tokens[d]
    limit = {"a_b": 3, "c": 1, "tiny": 2}
    source_of = {d: s for d, _, s, _ in docs}
    assert all(rep < limit[mixing_name(source_of[d])] for d, rep in cover)
    assert report["absent"]["short"] and report["absent"]["tokens_mixed"] == 0
    assert sum(report[s]["slots"] for s in report) == m.slots


def mixing_name(s):
    return "_".join(s.lower().replace("-", " ").split())


def test_schedule_is_even_in_every_prefix():
    of = sources_of_slots(0, 5000, np.cumsum([0.6, 0.3, 0.1]))
    for n in (10, 100, 1000, 5000):
        share = np.bincount(of[:n], minlength=3) / n
        assert np.abs(share - [0.6, 0.3, 0.1]).max() <= 3 / n


def test_empty(spark):
    none = Mix(spark.createDataFrame([], DOC), spark.createDataFrame([("a", 1.0, 1)], TARGET))
    assert none.pieces().count() == 0 and [r["short"] for r in none.report().collect()] == [False]
    assert Mix(spark.createDataFrame([(1, "x", "a", 0)], DOC), spark.createDataFrame([], TARGET)).report().count() == 0
