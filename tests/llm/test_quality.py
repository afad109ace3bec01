import re

from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import kernels as K
from quern.llm import quality
from quern.llm.quality import LIMITS, LINE_LIMIT

WORD = re.compile(r"[0-9A-Za-z_\u0080-\U0010ffff]+")


def slow(text):
    w = WORD.findall((text or "").lower())
    out = [sum(map(len, w))]
    for n in sorted(LIMITS):
        seen, inside = set(), set()
        for i in range(len(w) - n + 1):
            g = tuple(w[i : i + n])
            if g in seen:
                inside |= set(range(i, i + n))
            seen.add(g)
        out.append(sum(len(w[i]) for i in inside))
    seen, lines = set(), 0
    for line in (text or "").lower().split("\n"):
        x = tuple(WORD.findall(line))
        if x and x in seen:
            lines += sum(map(len, x))
        seen.add(x)
    return (*out, lines)


def measured(texts):
    import numpy as np

    raw = [t.lower().encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return list(zip(*[v.tolist() for v in quality._measure(np.frombuffer(b"".join(raw), np.uint8), off, sorted(LIMITS))]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "über", ",", "\n", "\n", "c1"]), max_size=80).map(" ".join), min_size=1, max_size=4))
def test_equals_brute_force(texts):
    assert measured(texts) == [slow(t) for t in texts]


def test_odd_rows(spark):
    rows = [(1, "a b c d e f " * 5, "x"), (2, "", "x"), (3, None, "x"), (None, "one two", "x"), (1, "a b c d e f " * 5, "x"), (4, " ".join(f"w{i}" for i in range(300_000)), "x"), (5, "same line here\nsame line here", "x"), (6, "...\n...\n", "x")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, keep STRING")
    got = quality.repetition_coverage(df).collect()
    assert len(got) == len(rows)
    assert sorted((tuple(r)[:-1] for r in got), key=str) == sorted(((i, *slow(t)) for i, t, _ in rows), key=str)
    verdict = {r["doc_id"]: r["keep"] for r in got}
    assert verdict == {1: False, 2: True, 3: True, None: True, 4: True, 5: False, 6: True}
    kept = quality.keep_quality(df)
    assert kept.columns == df.columns and sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 2, 3, 4, 6]
    assert quality.repetition_coverage(df.limit(0)).count() == 0 and quality.keep_quality(df.limit(0)).count() == 0


def test_limits_hold_exactly(spark):
    assert slow("a\n" * 2)[-1] / slow("a\n" * 2)[0] > LINE_LIMIT
    line = "x\nx\n" + "".join(chr(98 + i) for i in range(8)) + "\n"  # ten characters, one in a repeated line
    assert quality.repetition_coverage(spark.createDataFrame([(1, line)], "doc_id INT, text STRING"), line_limit=0.1).first()["keep"]


def test_blocks_do_not_matter():
    texts = ["a b a b " * 300, "", "c d " * 5, "é " * 700]
    whole = measured(texts)
    assert whole == [measured([t])[0] for t in texts]
    assert list(K.blocks(__import__("numpy").array([0, 5, 5, 9, 30]), 8)) == [(0, 2), (2, 3), (3, 4)]
