"""Personal data: base spans against plain patterns, the field against enumeration, added spans, odd rows."""

import random
import re
from itertools import combinations, product

import numpy as np
from pyspark.sql import functions as F

from tagweave.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def check_digit(digits):
    values = [int(d) for d in digits]
    return (sum(values[-1::-2]) + sum(sum(divmod(2 * v, 10)) for v in values[-2::-2])) % 10 == 0


def expected(text):
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and check_digit(digits):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def sample():
    rng = random.Random(6)
    bits = ["@", "@", ".", "-", "+", " ", " ", "(", ")", "_", "a", "b.c", "x@y.z", "é", "1", "12", "255", "256", "007", "4111 1111 1111 1111", "\n"]
    bits += ["4111111111111111", "+1 (729) 555-7725", "84.27.175.186", "joe.d+x@mail.example.com", "٣", "00000000255"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    return [*texts, "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "@a.b@c.d", "9" * 5000, "1 " * 5000, "x" * 30_000 + "@y.z"]


def test_base_spans():
    for text in sample():
        assert pii.base_spans(text) == expected(text), text


def cuts(places, atoms):
    """Every choice of candidates that do not overlap."""
    for size in range(len(places) + 1):
        for chosen in combinations(range(len(places)), size):
            spans = sorted((places[k][0], places[k][1]) for k in chosen)
            if all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False)):
                yield chosen


def test_dynamic_programs_against_enumeration():
    rng = np.random.default_rng(3)
    places = np.array([(0, 1), (1, 1), (1, 3), (2, 4), (4, 4), (0, 4), (3, 3)])
    scores = rng.normal(size=(len(places), 2)) * 2
    weight, best, total = np.zeros_like(scores), (-np.inf, None), 0.0
    for chosen in cuts(places.tolist(), 5):
        for kinds in product(range(2), repeat=len(chosen)):
            score = sum(scores[k, y] for k, y in zip(chosen, kinds, strict=True))
            total += np.exp(score)
            for k, y in zip(chosen, kinds, strict=True):
                weight[k, y] += np.exp(score)
            best = max(best, (score, list(zip(chosen, kinds, strict=True))), key=lambda b: b[0])
    assert np.allclose(pii.span_chances(places, scores, 5), weight / total)
    found = pii.best_spans(places, scores, 5)
    assert sorted(found) == sorted(best[1])


def added(text, weights):
    own = pii.base_spans(text)
    return [(pii.KINDS[k], text[s:e]) for k, s, e in pii.added_spans(text, weights, own)]


def test_added_spans():
    weights = pii.fit([])
    assert added("call (555) 123-4567 now", weights) == [("phone", "(555) 123-4567")]
    assert [k for k, _ in added("write to jane.doe [at] mail.org", weights)] == ["email"]
    for harmless in ["on 2024-05-06 at 12:30", "version 1.2.3", "room 12, 13 and 14", "number 1234567890123456", "ISBN 978-3-16-148410-0", "a@b"]:
        assert not added(harmless, weights), harmless
    assert not added("mail joe@example.com or 84.27.175.186", weights)


def test_odd_rows(spark):
    texts = [None, "", "nothing here", "joe@example.com and joe@example.com", "é𐐷 +1 (729) 555-7725", "word " * 20_000 + "84.27.175.186"]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(3, texts[3])], "doc_id long, text string").withColumn("base", F.lit(1))
    got = pii.find(docs, pii.train(docs))
    rows = got.withColumn("line", pii.listed("found")).withColumn("n", pii.count_of("email")).collect()
    assert len(rows) == 7
    lines = {r.doc_id: r.line for r in rows}
    assert lines[0] == lines[1] == lines[2] == ""
    assert lines[3] == "email:0:15,email:20:35" and {r.n for r in rows if r.doc_id == 3} == {2}
    assert lines[4] == "phone:3:20" and lines[5] == "ip:100000:100013"
    assert got.limit(0).count() == 0


def test_repeatable():
    texts = ["mail joe@example.com about 4111 1111 1111 1111", "host 84.27.175.186"]
    assert np.array_equal(pii.fit(texts), pii.fit(texts))


def test_every_stretch_is_learned_from():
    """Texts of more than eight stretches and four matches give all of them; beyond the bounds the lot decides, not the place."""
    texts = [f"{k}\n".join(f"call +1 729 555 77{k}{i} now\n" for i in range(10)) for k in range(10, 13)]
    near, found = pii.learned_from(texts)
    assert len(near) == sum(len(pii.islands(t)) for t in texts) >= 30
    assert sorted(found) == sorted((t, s) for t in texts for s in pii.base_spans(t)) and len(found) >= 30
    near, found = pii.learned_from(texts, 9, 7)
    assert (len(near), len(found)) == (9, 7) and {t for t, _ in near} == set(texts)
    assert pii.learned_from(texts, 9, 7) == (near, found)
