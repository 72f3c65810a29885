import hashlib
import random

import pytest
from brute import base_spans

from tallyspark.llm import pii

ODD = [
    "a@b.co_x@y.com", "x@y@z.com a@b a@b.c.d..e", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255", "+1 (988) 555-2485+44 20 7946 0958.",
    "4041894974608795 4041-8949-7460-8795 4111 1111 1111 1111 12", "é😀a@b.de 😀 1.1.1.1", "", "x" * 5000 + "@", ("9" * 40 + " ") * 30,
    "...@a.b", "a.b@c-d.e-f", "++1 234 567 890", "1.2.3.4@x.com", "1." * 3000 + "a@" + "b." * 3000, "9 " * 5000, "+" * 2000,
]


def given():
    rng = random.Random(5)
    texts = list(ODD)
    texts += ["".join(rng.choice("ab1 2.3-@+()4é😀_%9 ") for _ in range(60)) for _ in range(400)]
    for _ in range(60):
        key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        texts.append(f'some words token = "{key}" and more')
        texts.append(f"hello AKIA{''.join(rng.choice('ABCDEFGH0123') for _ in range(16))} end")
        texts.append(f"order number {rng.randrange(10**8)} of part A-{rng.randrange(100)} and chapter 12")
    return texts


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t, "x") for i, t in enumerate(given())] + [(None, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    return {r["doc_id"]: r for r in pii.report(docs).collect()}


def test_base_spans_equal_brute_force(found):
    for i, text in enumerate(given()):
        spans = base_spans(text)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert found[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), text[:80]
        for kind in pii.BASE:
            assert found[i][f"n_{kind}"] == sum(k == kind for k, _, _ in spans)
        assert not spans or set(listed.split(",")) <= set(found[i]["spans"].split(","))
    assert found[None]["spans"] == "" and found[None]["n_email"] == 0


def test_trees_add_secrets_and_leave_numbers(found):
    texts = given()
    secrets = [i for i, t in enumerate(texts) if "token =" in t or "AKIA" in t]
    assert sum("secret:" in found[i]["spans"] for i in secrets) >= 0.95 * len(secrets)
    assert not any(found[i]["spans"] for i, t in enumerate(texts) if t.startswith("order number"))


def test_redaction(spark):
    rows = [(1, "mail a@b.co or 1.2.3.4, +1 234 567 890!"), (1, "none"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["text"] for r in pii.redact(docs).collect()) == ["", "mail [email] or [ip], [phone]!", "none"]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.report(docs).count() == 0


def kinds_given():
    """Values of each added kind: most with a word that says so, some without; and look-alikes of another format without one."""
    rng = random.Random(6)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 8)))
    make = {
        "secret": ("key = ", lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40)), lambda: f"{word()}-{word()}-v{digits(1)}-{word()}"),
        "number": ("tel ", lambda: f"{digits(4)}-{digits(3)}-{digits(4)}", lambda: digits(8)),
        "mail_like": ("mail ", lambda: f"{word()}.{word()} (at) {word()} (dot) com", lambda: f"{word()} at {word()}.{word()}"),
        "ip6": ("host ", lambda: ":".join("".join(rng.choice("0123456789abcdef") for _ in range(4)) for _ in range(8)), lambda: ":".join(digits(1) for _ in range(8))),
    }
    docs = []
    for kind, (cue, good, bad) in make.items():
        docs += [(kind, True, f"well {cue}{good()} so") for _ in range(150)]
        docs += [(kind, True, f"well and {good()} so") for _ in range(4)]
        docs += [(kind, False, f"well and {bad()} so") for _ in range(120)]
    return docs


def test_every_added_kind_is_chosen_and_refused(spark):
    """Format decides: values without a word before them are found too, look-alikes are left alone."""
    docs = kinds_given()
    frame = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(docs)], "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.report(frame).collect()}
    for kind in pii.ADDED:
        mine = [(good, f"{kind}:" in found[i], "well and" in t) for i, (k, good, t) in enumerate(docs) if k == kind]
        assert sum(hit for good, hit, _ in mine if good) >= 0.95 * 154, kind
        assert sum(hit for good, hit, bare in mine if good and bare) >= 3, kind
        assert not any(hit for good, hit, _ in mine if not good), kind


def test_thresholds_are_set_by_kind():
    bins = [("secret", 49, 9, 10), ("secret", 20, 0, 50), ("number", 40, 5, 10), ("ip6", 48, 3, 3), ("ip6", 10, 2, 2)]
    assert pii.thresholds(bins) == {"secret": 0.98, "ip6": 0.5}


def test_of_overlapping_spans_the_likeliest_stays(spark):
    rows = [(1, 0, 10, "number", 0.7), (1, 8, 20, "secret", 0.9), (1, 30, 40, "ip6", 0.6), (2, 5, 9, "number", 0.5), (2, 5, 9, "secret", 0.5), (3, 0, 4, "number", 0.6), (3, 4, 8, "number", 0.8)]
    spans = spark.createDataFrame(rows, "row long, start int, end int, kind string, p double")
    got = sorted((r["row"], r["start"], r["kind"]) for r in pii.likeliest(spans).collect())
    assert got == [(1, 8, "secret"), (1, 30, "ip6"), (2, 5, "number"), (3, 0, "number"), (3, 4, "number")]


def test_very_many_matches_in_one_text(spark):
    text = "a@b.co 1.2.3.4 " * 30_000
    got = pii.report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (got["n_email"], got["n_ip"]) == (30_000, 30_000)


def test_every_candidate_teaches_and_sets_thresholds(spark, monkeypatch):
    """the trees and the thresholds see all candidates, however many there are."""
    docs = spark.range(26_000).selectExpr("id AS doc_id", "if(id % 2 = 0, 'token = ' || md5(string(id)), 'see chap-' || id % 97 || '-of-the-long-book') AS text")
    spans = pii._spans(pii._found(docs))
    fitted, judged = [], []

    class Trees(pii.GBTClassifier):
        def fit(self, rows):
            fitted.append(rows.count())
            return super().fit(rows)

    monkeypatch.setattr(pii, "GBTClassifier", Trees)
    monkeypatch.setattr(pii, "thresholds", lambda bins: judged.extend(bins))
    pii.fit(spans)
    n = pii.candidates(spans).count()
    assert n >= 26_000 and max(fitted) == n and sum(b[3] for b in judged) == n
