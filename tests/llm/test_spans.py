import hashlib
import itertools
import math
import random
import re
import time

import numpy as np
from helpers import frame

from cohortmark.llm import pii, secret_scan
from cohortmark.llm import spans as S


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (2 * int(c) > 9)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_pii(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


def base_secret(t):
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(pattern, t, re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def test_base_patterns_equal_plain_search():
    rng = random.Random(8)
    bits = ["a.b@c.de", "@", "x@y.z.w+q@r.s", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (743) 555-3824", "+", "12", ".", " ", "-", "é", "\n", "0" * 30, "007.1.2.3"]
    for _ in range(3000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))
        assert pii.base_spans(t) == base_pii(t)
    bits = ["password", "Token", "API_KEY", "apikey", "secret", '"', "'", " ", ":", "=", "abc123/+", "x", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "fedcba98", "é", "\n", "AKIAAKIA"]
    for _ in range(3000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))
        assert secret_scan.base_spans(t, True) == base_secret(t)


def hard():
    phone = "call +1 (743) 555-3824 now"
    rows = [(i, f"text {i} {phone} and mail me.{i}@example.com or 10.0.0.{i} end", "en", "a") for i in range(40)]
    rows += [(50, "first +1 743 555 3824 later reach me at 743 555 3824 or 17435553824 today", "en", "a"), (51, None, None, None), (52, "", "en", "a"), (53, "no data here", "en", "a"), (54, "x" * 9000 + " 9.9.9.9", "en", "a"), (54, "x" * 9000 + " 9.9.9.9", "en", "a"), (55, "+1 (743) 555-3824 again 1-743-555-3824 and 7435553824", "en", "a")]
    return rows


def test_pii_query(spark):
    rows = hard()
    got = pii.pii(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    text = {i: t or "" for i, t, *_ in rows}
    for r in got:
        base = base_pii(text[r.doc_id])
        form = ",".join(f"{k}:{s}:{e}" for s, _, e, k in base)
        assert r.base_sha256 == hashlib.sha256(form.encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(form.split(",") if form else []) <= set(spans)
        assert len(spans) - len(base) == r.n_added
    by_id = {r.doc_id: r for r in got}
    assert by_id[53].n_added == 0
    assert pii.pii(frame(spark).limit(0)).count() == 0


def test_skip_edges_carry_labels():
    rng = random.Random(3)
    model = pii.fitted([pii.taught(t, rng) for t in [x[1] for x in hard() if x[1]]])
    assert model["pair"].shape == (2, 5, 5)
    text = "+17435553824 was the number, write it as 17435553824 on the form"
    got = pii.added(text, pii.base_spans(text), model, 0.8)
    assert [(text[s:e], k) for s, _, e, k in got] == [("17435553824", "crf_phone")]
    assert pii.added("the number 99 and 17 of 2020", [], model, 0.8) == []
    assert pii.fitted([]) is None


def made_up(rng):
    word = lambda: "".join(rng.choice("abdeilnorst") for _ in range(rng.randint(2, 8)))
    data = [lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", lambda: f"{word()}.{word()}@{word()}.com", lambda: ".".join(str(rng.randint(1, 254)) for _ in range(4)), lambda: str(rng.randint(1, 2030))]
    return " ".join(rng.choice(data)() if rng.random() < 0.08 else word() for _ in range(80))


def test_field_finds_other_spellings_in_texts_it_has_not_seen():
    rng = random.Random(12)
    model = pii.fitted([pii.taught(made_up(rng), rng) for _ in range(150)])
    found = missed = wrong = 0
    for _ in range(150):
        text = made_up(rng)
        longer, planted = pii.respelt(text, pii.base_spans(text), rng)
        base = pii.base_spans(longer)
        planted = [x for x in planted if all(x[2] <= s or x[0] >= e for s, _, e, _ in base)]
        got = pii.added(longer, base, model, pii.SURE)
        hit = [any(s < x[2] and e > x[0] and k == "crf_" + x[3] for s, _, e, k in got) for x in planted]
        found, missed = found + sum(hit), missed + len(hit) - sum(hit)
        wrong += sum(not any(s < x[2] and e > x[0] for x in planted) for s, _, e, _ in got)
    assert found > 100 and found >= 0.75 * (found + missed) and wrong <= 0.1 * found


def test_marginals_equal_enumeration_on_trees_and_are_near_on_loops():
    rng = np.random.default_rng(1)
    pair = rng.normal(0, 0.7, (2, 5, 5))
    pair[1] = (pair[1] + pair[1].T) / 2
    for edges, near in (([(0, 1, 0), (1, 2, 0), (2, 5, 1), (3, 5, 1), (3, 4, 0)], 1e-3), ([(0, 1, 0), (1, 2, 0), (0, 5, 1), (2, 5, 1), (3, 5, 1), (3, 4, 0)], 0.1)):
        node = rng.normal(0, 1, (6, 5))
        want = np.zeros((6, 5))
        for labels in itertools.product(range(5), repeat=6):
            p = math.exp(sum(node[i, v] for i, v in enumerate(labels)) + sum(pair[k, labels[a], labels[b]] for a, b, k in edges))
            for i, v in enumerate(labels):
                want[i, v] += p
        want /= want.sum(axis=1, keepdims=True)
        assert np.abs(pii.beliefs(node, np.array(edges), pair) - want).max() < near


def test_long_texts_take_time_in_proportion():
    texts = ["1 " + "日" * 500_000, "a" * 500_000 + "@", "@" * 200_000, "a@" * 200_000, "1." * 200_000, "+1" * 200_000, "1-" * 200_000, "password" * 50_000 + " " * 200_000, "a." * 200_000 + ":", "x@y.zz " * 20_000]
    began = time.time()
    for t in texts:
        base = pii.base_spans(t)
        pii.Nodes(t, base)
        secret_scan.parts(t, secret_scan.base_spans(t, True))
    many = "client_id = app-7 " + "token=abcdef1 Zx9fQ2mLw7TbR4kVn8Ys1Hd3 client_id=abcd " * 20_000
    secret_scan.parts(many, secret_scan.base_spans(many, True))
    assert time.time() - began < 60


def test_taken_places():
    rng = random.Random(2)
    for _ in range(300):
        spans = [(s, s + rng.randint(1, 9)) for s in (rng.randrange(60) for _ in range(rng.randint(0, 8)))]
        taken = S.Taken(spans)
        for s in range(70):
            for e in range(s + 1, s + 6):
                assert taken.free(s, e) == all(e <= a or s >= b for a, b in spans)


def test_secret_links_need_complements(spark):
    weak = "Zx9fQ2mLw7TbR4kVn8Ys1Hd3"
    rows = [
        (1, f"client_id = app-7731\nvalue {weak}\nhttps://login.example.com/x", "en", "a"),
        (2, f"value {weak} alone", "en", "a"),
        (3, "client_id = app-7731 alone", "en", "a"),
        (4, f"client_id = app-7731\n\nvalue {weak}", "en", "a"),
        (5, f"client_id = app-7731 {'far ' * 200} {weak}", "en", "a"),
        (6, f"AKIA{'B' * 16} then {weak}", "en", "a"),
        (7, None, None, None), (8, "", "en", "a"), (8, "", "en", "a"),
        (9, "token = abcdef123456 client_id: svc-99", "en", "a"),
    ]
    got = secret_scan.secret_scan(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    kinds = {r.doc_id: sorted(x.split(":")[0] for x in r.spans.split(",")) if r.spans else [] for r in got}
    assert kinds == {1: ["linked_endpoint", "linked_id", "linked_secret"], 2: [], 3: [], 4: [], 5: [], 6: ["access", "linked_secret"], 7: [], 8: [], 9: ["assign", "linked_id"]}
    text = {i: t or "" for i, t, *_ in rows}
    for r in got:
        form = ",".join(f"{k}:{s}:{e}" for s, _, e, k in base_secret(text[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(form.encode()).hexdigest()
    assert secret_scan.secret_scan(frame(spark).limit(0)).count() == 0


def test_near_equals_brute_force(spark):
    rng, parts = random.Random(4), []
    for uid in range(400):
        at = rng.randint(0, 3000)
        for side in rng.sample("lr", 2):
            size = rng.choice([1, 24, 40, 100, 300, 400, 800, 5000])
            parts.append((side, uid, 0, at, at + size))
            at += size + rng.choice([0, 1, 200, 399, 400, 401, rng.randint(0, 900)])
    df = spark.createDataFrame(parts, "side string, uid long, scope long, start long, end long")
    left, right = (df.where(df.side == s).drop("side") for s in "lr")
    got = sorted(r.uid for r in secret_scan.near(left, right, 400).collect())
    r = {p[1]: p for p in parts if p[0] == "r"}
    want = sorted(p[1] for p in parts if p[0] == "l" and max(r[p[1]][3] - p[4], p[3] - r[p[1]][4]) <= 400)
    assert got == want and 100 < len(want) < 400


def test_links_reach_past_long_parts(spark):
    jwt = "aZ9x" * 300
    rows = [(i, "x " * i + f"token={jwt} {'y' * 300} client_id = app-7731", "en", "a") for i in range(0, 400, 40)]
    rows += [(1000 + i, "x " * i + f"client_id = app-7731 https://h.example.com/{'p' * 900} {'word ' * 10}Zx9fQ2mLw7TbR4kVn8Ys1Hd3", "en", "a") for i in (0, 77)]
    kinds = {r.doc_id: sorted(x.split(":")[0] for x in r.spans.split(",")) for r in secret_scan.secret_scan(frame(spark, rows)).collect()}
    assert all(kinds[i] == ["assign", "linked_id"] for i in range(0, 400, 40))
    assert all(kinds[1000 + i] == ["linked_endpoint"] for i in (0, 77))


def test_other_spellings_share_the_label(spark):
    phone = "call +1 743 555 3824 now, " + "or write (743) 555-3824 or 743 555 3824 or 7435553824 there, " * 50
    card = "paid by 4111 1111 1111 1111 today, " + "card 4111 11111111 1111 again, " * 3
    rows = hard()[:40] + [(200 + i, f"card 4111 1111 1111 1111 and {i} more", "en", "a") for i in range(20)]
    rows += [(100, phone, "en", "a"), (101, card, "en", "a"), (102, "rooms 743 555 and 20 30 2020 743 years", "en", "a")]
    got = {r.doc_id: r for r in pii.pii(frame(spark, rows)).collect()}
    found = [x.split(":") for x in got[100].spans.split(",") if x.startswith("crf_phone")]
    assert [re.sub("[^0-9]", "", phone[int(s) : int(e)]) for _, s, e in found] == ["7435553824"] * 150
    assert got[102].n_added == 0 and got[101].n_card == 4
