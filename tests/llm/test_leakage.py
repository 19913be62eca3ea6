import random

from motionloom.llm.leakage import LEAST_EQUAL, MASKS, SPAN, leaked_passages
from motionloom.llm.words import plain_words

DOC, ITEM = "doc_id long, text string, item_id string", "item_id long, item_text string, doc_id long"


def passages(spark, docs, items, at_once=100):
    d = spark.createDataFrame([(i, t, "clash") for i, t in docs], DOC)
    e = spark.createDataFrame([(i, t, 0) for i, t in items], ITEM)
    return {(r["doc_id"], r["item_id"]): (r["exact_words"], r["tolerant_words"]) for r in leaked_passages(d, e, at_once).collect()}


def brute(docs, items):
    grams = lambda t: {tuple(w[i : i + SPAN]) for w in [plain_words(t)] for i in range(len(w) - SPAN + 1)}
    return {(d, i) for d, t in docs if t for i, u in items if u and grams(t) & grams(u)}


def test_against_brute_force(spark):
    r = random.Random(5)
    words = [f"w{k}" for k in range(60)]
    items = [(i, " ".join(r.choices(words, k=r.randrange(8, 40)))) for i in range(30)] + [(90, None), (91, "")]
    docs = [(900, None), (901, "  ")]
    for d in range(80):
        source = (items[r.randrange(30)][1] or "").split()
        a = r.randrange(max(1, len(source) - 10))
        piece = source[a : a + r.randrange(8, 20)]
        if d % 3 == 0 and len(piece) > 12:
            piece[6] = "other"
        docs.append((d, " ".join(r.choices(words, k=20) + piece + r.choices(words, k=20)).replace(" w1", ",\n<b>W1</b>")))
    docs.append(docs[5])
    want = brute(docs, items)
    for at_once in (100, 7):
        got = passages(spark, docs, items, at_once)
        assert {k for k, v in got.items() if v[0] >= SPAN} == want and want


def test_substitutions_are_tolerated(spark):
    item = " ".join(f"a{k}" for k in range(30))
    doc = " ".join("x" if k % 9 == 4 else f"a{k}" for k in range(30))
    got = passages(spark, [(1, doc)], [(7, item)])
    assert got[1, 7][0] < SPAN <= got[1, 7][1]
    assert all(len(m) == SPAN for m in MASKS)
    assert passages(spark, [], [(7, item)]) == {} and passages(spark, [(1, doc)], []) == {}


def test_every_tolerated_passage_is_found(spark):
    r = random.Random(8)
    items = [(i, " ".join(r.choices([f"w{k}" for k in range(40)], k=r.choice((12, 20, 40))))) for i in range(20)]
    docs, n = [], 0
    for i, text in items:
        for spots in [r.sample(range(12), 3) for _ in range(12)] + [range(3, 40, 4), range(4, 40, 5)]:
            words = text.split()
            for k in [k for k in spots if k < len(words)]:
                words[k] = "other"
            docs.append((n, " ".join(words)))
            n += 1
    near = lambda a, b: any(sum(x == y for x, y in zip(a[i : i + SPAN], b[j : j + SPAN])) >= LEAST_EQUAL for i in range(len(a) - SPAN + 1) for j in range(len(b) - SPAN + 1))
    want = {(d, i) for d, t in docs for i, u in items if near(t.split(), u.split())}
    assert set(passages(spark, docs, items)) == want and len(want) >= len(docs)


def test_words_ignore_form():
    assert plain_words("«Ünder» <i>the</i> tAbLe,\xa0﻿**NOT** &amp; Straße") == ["under", "the", "table", "not", "strasse"]
    assert plain_words(None) == [] and plain_words("... --") == []
