import random
import re

from scorecast.llm import pii

from .corpus import empty, frame

PATTERN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
           "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, text):
    d = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "phone":
        return 9 <= len(d) <= 15
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        return 12 <= len(d) <= 19 and total % 10 == 0
    return True


def brute(text):
    found = [(m.start(), n, k, m.end()) for n, (k, p) in enumerate(PATTERN.items()) for m in re.finditer(p, text or "") if passes(k, m.group())]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def test_base_spans_against_brute_force(spark):
    rng = random.Random(4)
    parts = ["a.b@c.d-e_f@g.h", "x@y", "@", "é", "😀", " ", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (988) 555-2485", "+49.30.1234567", "+1--", "5", ".", "-", "+", "a", "9" * 40, "4012888888881881", "me@mail.example.com", "_", "%"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "1" * 20000), (1003, "a" * 20000), (1004, ".a" * 8000 + "@b" + ".c" * 8000), (1005, "+" + "-" * 20000),
             (1006, "1 " * 10000), (1000, "+1 (988) 555-2485")]
    out = pii.find(frame(spark, rows)).collect()
    got = sorted((str(r["doc_id"]), [(s["kind"], s["start"], s["stop"]) for s in r["base"]]) for r in out)
    assert got == sorted((str(i), brute(t)) for i, t in rows)
    for r in out:        # the method adds spans and never takes one away
        assert {(s["kind"], s["start"]) for s in r["base"]} <= {(s["kind"], s["start"]) for s in r["spans"]}


def test_very_many_spans_in_one_text(spark):
    rows = [(1, " ".join(f"{i % 90 + 10}" for i in range(100_000))), (2, "12 34, " * 30_000),
            (3, " ".join(f"a{i}@b{i % 7}.org" for i in range(5_000))), (4, ", ".join(f"10.{i % 256}.3.{i // 256}" for i in range(5_000))),
            (5, "; ".join(["4111 1111 1111 1111", "5", "4111 1111 1111 1112", "1234 5678 9012 3456 789 0 1"] * 1_500))]
    out = {r["doc_id"]: [(s["kind"], s["start"], s["stop"]) for s in r["base"]] for r in pii.find(frame(spark, rows)).collect()}
    assert out == {i: brute(t) for i, t in rows} and len(out[3]) == len(out[4]) == 5_000 and len(out[5]) == 1_500


def test_classifier_adds_secrets(spark):
    rows = [(i, f"the password={i:02d}a7f9c3e1b2d4f{i:02d} of it") for i in range(40)] + [(100 + i, f"mail me{i}@host{i}.com") for i in range(40)]
    rows += [(200 + i, "key AKIAIOSFODNN7EXAMPL" + "ABCDFGHJ"[i] + " end") for i in range(8)]
    out = {r["doc_id"]: r["spans"] for r in pii.find(frame(spark, rows)).collect()}
    assert all([s["kind"] for s in out[i]] == ["secret"] for i in range(40))
    assert out[0][0]["text"] == "00a7f9c3e1b2d4f00"
    assert all([s["kind"] for s in out[200 + i]] == ["secret"] for i in range(8))


def test_expectation_maximisation_finds_the_reliable_labelers():
    rng = random.Random(1)
    counts = {}
    for _ in range(4000):
        y = 1 if rng.random() < 0.4 else -1
        votes = (y if rng.random() < 0.95 else -y, y if rng.random() < 0.9 else -y, rng.choice((-1, 1)), 0, y if rng.random() < 0.7 else 0)
        counts["k", *votes] = counts.get(("k", *votes), 0) + 1
    post = pii.expectation_maximisation(list(counts.items()))
    assert post["k", 1, 1, -1, 0, 1] > 0.95 and post["k", -1, -1, 1, 0, 0] < 0.05


def test_empty_and_native(spark):
    assert pii.find(empty(spark)).count() == 0
    plan = pii.find(frame(spark, [(1, "a@b.c")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
