import itertools
import random

from brute import leaks as brute

from tallyspark.llm import decontaminate as dc


def test_masks_leave_no_gap():
    for size in range(8, 14):
        for wrong in itertools.combinations(range(size), int(size * dc.TOLERATED)):
            fits = (all(at + k not in wrong for k in mask) for mask in dc.MASKS for at in range(size - mask[-1]))
            assert any(fits), (size, wrong)


def corpus(seed=8):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randrange(1, 6)))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([3, 7, 8, 9, 10, 13, 14, 25, 40, 60])]
    items += [(20, items[7][1].upper() + "!"), (21, "the the the " * 9), (22, None)]
    docs = []
    for k in range(80):
        words = [word() for _ in range(rng.randrange(0, 60))]
        if k % 4:
            part = dc_words(rng.choice(items)[1] or "")
            start = rng.randrange(max(1, len(part) - 12))
            part = part[start : start + rng.randrange(8, 40)]
            for _ in range(rng.randrange(0, 5)):
                if part:
                    part[rng.randrange(len(part))] = word()
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        docs.append((k, ", ".join(words)))
    return docs, items


def dc_words(text):
    return text.split()


def test_equals_brute_force(spark):
    docs, items = corpus()
    frame = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item int")
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = {r["doc_id"]: (set(r["items"]), r["contaminated"]) for r in dc.report(frame, bench).collect()}
    want = {}
    for doc_id, text in docs:
        found = brute(text, items)
        found = {7 if x == 20 else x for x in found}  # the same words as item 7
        want[doc_id] = (found, bool(found))
    assert got == want
    assert sum(bool(x) for x, _ in want.values()) > 20
    stayed = dc.clean(frame, bench)
    assert stayed.columns == frame.columns
    assert {r["doc_id"] for r in stayed.collect()} == {i for i, (x, _) in want.items() if not x}


def test_unusual_rows(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen"
    rows = [(None, passage), (1, None), (2, ""), (3, "x " * 50_000 + passage), (3, "clean"), (4, "clean"), (4, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, passage), (None, "a b")], "item_id long, text string")
    assert sorted(r["doc_id"] for r in dc.clean(docs, bench).collect()) == [1, 2, 4, 4]
    assert dc.clean(docs, bench.limit(0)).count() == len(rows)
    assert dc.report(docs.limit(0), bench).count() == 0
