import random
import re
import time

from textloom.llm.pii import _context, base_spans, candidates, digest_text, find_pii, learn_patterns, redact_pii

PARTS = ["a", "@", "@", ".", ".", "1", "23", "255", "0", "-", " ", "+", "(", ")", "b.c", "x@y.z", "12345678901", "٣", "é", "\n", "4111111111111111"]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (2 if k % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for kind, pattern, low, high, check in ((2, r"[0-9]([\x20-]?[0-9])+", 12, 19, luhn), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15, bool)):
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m.group())
            if low <= len(digits) <= high and check(digits):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_fixed_patterns():
    r = random.Random(1)
    for _ in range(20_000):
        t = "".join(r.choice(PARTS) for _ in range(r.randint(0, 16)))
        assert base_spans(t) == brute(t), t
    base_spans("1" * 200_000 + "@" * 200_000 + "a" * 200_000 + "+1" + " " * 200_000)  # in linear time


def test_candidates_and_contexts():
    r = random.Random(2)
    for _ in range(5_000):
        t = "".join(r.choice([*PARTS, "555-867-5309", " at ", " dot com"]) for _ in range(r.randint(0, 16)))
        base = base_spans(t)
        loose = candidates(t, [])
        assert candidates(t, base) == [f for f in loose if all(f[1] <= s or f[0] >= e for s, _, e in base)], t
        for start, *_ in loose:
            words = re.findall(r"[^\x20\x09-\x0D]+", t[:start].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
            assert _context(t, start) == (words[-2:] if start and t[start - 1] in " \t\n\x0b\x0c\r" else [])
    assert _context("A" * 4300 + " is" + " " * 900 + "5", 5203) == ["a" * 4300, "is"]
    begin, log = time.time(), "2024-01-02 10.0.0.7 order 5558675309 +1 555 010 1234\n" * 40_000
    base = base_spans(log)
    assert len(base) >= 80_000 and len(candidates(log, base)) and time.time() - begin < 60


def planted(spark):
    rows = [(i, f"hello there my phone number is +1 (555) 010-{1000 + i} thanks {i}") for i in range(40)]
    rows += [(100 + i, f"some text of the year is 2020{i:03d} and the count {i}") for i in range(40)]
    rows += [(900, "well, my phone number is 555-867-5309 ok"), (901, "order number 555-867-5301 of the year"), (902, None), (903, ""),
             (None, "mail é a.b@c.de"), (904, "1.2.3.4 " * 3000)]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' AS spans", "-1L AS n_chars")


def test_contexts_find_more(spark):
    df = planted(spark)
    assert {r["words"] for r in learn_patterns(df).collect()} >= {"number is"}
    got = {r["doc_id"]: r for r in find_pii(df).collect()}
    assert got[900]["spans"] == "phone:25:37" and got[900]["n_phone"] == 0
    assert got[901]["spans"] == got[902]["spans"] == got[903]["spans"] == ""
    assert got[None]["spans"] == "email:7:15" and got[904]["n_ip"] == 3000
    assert all(r["spans"] == "" for i, r in got.items() if i is not None and 100 <= i < 140)
    for r in got.values():  # base spans stay
        assert r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] <= len(r["found"])


def test_redaction(spark):
    got = {r["doc_id"]: r for r in redact_pii(planted(spark)).collect()}
    assert got[900]["text"] == "well, my phone number is [PHONE] ok" and got[900]["n_chars"] == 35
    assert got[None]["text"] == "mail é [EMAIL]" and got[902]["text"] is None and got[901]["text"].startswith("order number 555")


def test_empty_table(spark):
    assert find_pii(planted(spark).limit(0)).count() == 0
    assert digest_text([(3, 0, 5), (3, 1, 9)]) == "email:3:5,ip:3:9"


def test_ip_part_of_any_length(spark):
    text = "1.2.3." + "0" * 4301
    assert [s[1] for s in base_spans(text)] == [1] and not base_spans(text + "256") and len(base_spans("1.2.3." + "0" * 5000 + "255")) == 1
    df = spark.createDataFrame([(1, text), (2, "1.2.3." + "9" * 6000)], "doc_id long, text string")
    assert {r["doc_id"]: r["n_ip"] for r in find_pii(df).collect()} == {1: 1, 2: 0}
