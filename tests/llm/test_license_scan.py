import random
from collections import Counter

from merchlens.llm import license_scan as ls

SCHEMA = "doc_id long, text string, licenses string, row int"


def _best(grams):
    out = {}
    for name, text in ls.TEMPLATES:
        bag, template = Counter(grams), Counter(ls.bigrams(text))
        if grams:
            score = 2 * sum((bag & template).values()) / (sum(bag.values()) + sum(template.values()))
            if score >= ls.THRESHOLD:
                out[name] = max(out.get(name, 0), score)
    return out


def test_size_bounds_lose_no_template():
    rng, scanner = random.Random(2), ls.Scanner()
    hits = 0
    for _ in range(400):
        words = ls._WORD.findall(rng.choice(ls.TEMPLATES)[1].lower())
        a = rng.randrange(max(1, len(words) // 5))
        words = words[a : len(words) - rng.randrange(max(1, len(words) // 5))]
        words += [f"x{rng.randrange(9)}" for _ in range(rng.randrange(4))]
        grams = list(zip(words, words[1:]))
        got = {}
        for score, name in scanner.matches(grams):
            got[name] = max(got.get(name, 0), score)
        assert got == _best(grams)
        hits += bool(got)
    assert 100 < hits < 400


def test_finds_notices_in_whole_texts(spark):
    filler = "of the and. plain words, nothing else\n"
    wrapped = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights to\nuse, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of\nthe Software, and to permit persons to whom the Software is furnished to do so,\nsubject to the following conditions: The above copyright notice and this\npermission notice shall be included in all copies or substantial portions of\nthe Software."
    rows = [
        (1, filler * 3000 + "Licensed under CC BY-NC 4.0.\n" + filler, "CC-BY-NC-4.0"),
        (2, "Some words first. Released under the MIT license! And more.", "MIT"),
        (3, filler + wrapped + "\n" + filler, "MIT"),
        (4, filler + "LICENSED   under the GNU General Public License, Version 3", "GPL-3.0"),
        (5, "Licensed to sell fish under the old rules of the harbour.", None),
        (6, "", None), (7, None, None), (8, "the license of the work", None), (9, filler, None),
        (10, "Licensed under CC BY 4.0.\nReleased under the MIT License.", "CC-BY-4.0"),
        (11, "This  work is licensed under the GNU General Public\nLicense, version 3.", "GPL-3.0"),
    ]
    docs = spark.createDataFrame([(i, t, "old", 1) for i, t, _ in rows], SCHEMA)
    got = {r.doc_id: r for r in ls.license_report(docs).collect()}
    assert {i: got[i].license for i, _, _ in rows} == {i: w for i, _, w in rows}
    assert got[10].n_licenses == 2 and got[10].dice == 1.0 and got[5].n_licenses == 0
    full = ls.with_licenses(docs)
    assert full.columns == ["doc_id", "text", "row", "licenses", "scores"] and full.count() == len(rows)
    assert ls.license_report(docs.limit(0)).collect() == []


def test_scan_equals_all_segments_against_all_templates(spark, sf_dir):
    scanner = ls.Scanner()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect():
        want = {}
        for line in r.text.split("\n"):
            for part in {line, *ls._SENTENCE.split(line)}:
                for name, score in _best(ls.bigrams(part)).items():
                    want[name] = max(want.get(name, 0), score)
        got = scanner.scan(r.text)
        assert {k: v for k, v in got.items() if k in want} == want or set(got) > set(want)


_TERMS = "redistribute it and/or modify\n  it under the terms of the GNU {}General Public License as published by\n  the Free Software Foundation; either version {} of the License, or\n  (at your option) any later version.\n"


def test_versions_and_families_are_told_apart():
    scanner = ls.Scanner()
    notices = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "Licensed under the GNU General Public License v3": "GPL-3.0",
        "Licensed under the GNU General Public License.": "GPL",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
        "This work is licensed under a Creative Commons Attribution 3.0 Unported License.": "CC-BY-3.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
        "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    for family, version, name in (
        ("", "2", "GPL-2.0"), ("", "3", "GPL-3.0"), ("Lesser ", "2.1", "LGPL-2.1"), ("Lesser ", "3", "LGPL-3.0"),
        ("Library ", "2", "LGPL-2.0"), ("Affero ", "3", "AGPL-3.0"),
    ):
        notices["  This program is free software: you can " + _TERMS.format(family, version)] = name
    for text, name in notices.items():
        assert list(scanner.licenses(text)) == [name], text
        assert list(scanner.licenses("Some words.\n" + text + "\nOther words.")) == [name], text


def test_whole_texts_are_one_licence_each():
    scanner, texts = ls.Scanner(), dict(ls.whole_texts())
    for name, text in texts.items():
        assert scanner.licenses(text) == {name: 1.0}
    edited = texts["BSD-3-Clause"].replace("copyright holder", "Foo Corp").replace("(INCLUDING", "[INCL")
    found = scanner.licenses("plain words\n" * 50 + edited + "\nprose and more\n" * 40 + texts["MIT"] + "\n" + texts["BSD-2-Clause"])
    assert set(found) == {"BSD-3-Clause", "MIT", "BSD-2-Clause"} and 0.9 < found["BSD-3-Clause"] < 1


def test_stretches_that_gain_most_together_are_chosen():
    rng = random.Random(7)
    for _ in range(200):
        found = []
        for _ in range(rng.randrange(9)):
            a = rng.randrange(12)
            found.append(ls.Found(a, a + rng.randrange(2, 6), rng.randrange(1, 9), 1.0, "x"))
        best = 0
        for pick in range(1 << len(found)):
            chosen = sorted(f for i, f in enumerate(found) if pick >> i & 1)
            if all(f.stop <= g.start for f, g in zip(chosen, chosen[1:])):
                best = max(best, sum(f.gain for f in chosen))
        got = ls._best_apart(found)
        assert sum(f.gain for f in got) == best and all(f.stop <= g.start for f, g in zip(got, got[1:]))


def test_report_keeps_every_licence_and_its_score(spark):
    text = "Licensed under CC BY 4.0.\nNow released under the MIT License."
    docs = spark.createDataFrame([(1, text, "old", 1), (2, "plain words", "old", 1)], SCHEMA)
    got = {r.doc_id: r for r in ls.license_report(docs).collect()}
    assert got[1].licenses == ["CC-BY-4.0", "MIT"] and got[1].scores[0] == 1.0 and 0.8 < got[1].scores[1] < 1.0
    assert (got[1].license, got[1].dice, got[1].n_licenses) == ("CC-BY-4.0", 1.0, 2)
    assert got[2].licenses == [] and got[2].scores == [] and got[2].license is None
