"""Licence scans against Dice coefficients of every unit with every template."""

import random
import re

from tagweave.llm import licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def bigrams(text):
    own = words(text)
    return set(zip(own, own[1:], strict=False))


def expected(text):
    text = text or ""
    lines = text.split("\n")
    units, run = [*lines, text], []
    for line in [*lines, ""]:
        if words(line):
            run.append(line)
        else:
            units.append("\n".join(run))
            run = []
    best = {}
    for unit in units:
        for name, template in licenses.TEMPLATES:
            a, b = bigrams(unit), bigrams(template)
            dice = 2 * len(a & b) / (len(a) + len(b)) if a else 0
            if dice >= 0.8:
                best[name] = max(best.get(name, 0), dice)
    return best


def sample():
    rng = random.Random(9)
    texts = [None, "", "\n\n", "license", "Released under the MIT License", "prose\nLicensed under CC BY-NC 4.0.\nmore prose"]
    for name, template in licenses.TEMPLATES:
        own = template.split(" ")
        wrapped = "\n".join(" ".join(own[i : i + 9]) for i in range(0, len(own), 9))
        texts += [template.upper(), f"code here\n\n{wrapped}\n\nmore of it {name}", wrapped]
        for _ in range(4):
            noisy = [w if rng.random() > 0.12 else rng.choice(["a", "the", "é", ""]) for w in own]
            texts.append("x y z\n" * rng.randint(0, 2) + " ".join(noisy) + "\n of the software")
    return texts


def test_against_every_unit(spark):
    texts = sample()
    docs = spark.createDataFrame(list(enumerate(texts)) + [(5, texts[5])], "doc_id long, text string").selectExpr("*", "1 as licenses")
    got = licenses.scan(docs).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert {x.license: round(x.dice, 9) for x in r.licenses} == {k: round(v, 9) for k, v in expected(r.text).items()}, r.text
        for x in r.licenses:
            assert 0 <= x.word_begin < x.word_end <= len(words(r.text))


def test_long_and_empty(spark):
    docs = spark.createDataFrame([(1, "word of the software " * 30_000 + "\nReleased under the MIT License.\n")], "doc_id long, text string")
    row = licenses.scan(docs).first()
    assert [(x.license, x.word_begin, x.word_end) for x in row.licenses] == [("MIT", 120_000, 120_005)]
    assert licenses.scan(docs.limit(0)).count() == 0
