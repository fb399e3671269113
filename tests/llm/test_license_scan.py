import random

import pytest

from quillmark.llm import license_scan as ls


def prose(seed, n):
    r = random.Random(seed)
    words = "the river ran on and over to old new stone bridge fields rain they walked free public work under general rights".split()
    return [" ".join(r.choice(words) for _ in range(r.randrange(5, 40))) + "." for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    return ls.fit(prose(1, 300))


def test_held_out_variants_are_found(model):
    r = random.Random(9)
    right = total = 0
    for family, own in ls.TEMPLATES.items():
        for t in own:
            words = t.split()
            for k in range(len(words) // 12 + 1):  # fewer changes than training makes, in other places
                words[r.randrange(len(words))] = "changed" if k else words[0]
            found = model.judge("In short: " + " ".join(words) + " So it is.")
            total += 1
            right += bool(found) and found[0] == family
    assert right / total > 0.8


def test_templates_and_unknown(model):
    for family, own in ls.TEMPLATES.items():
        for t in own:
            assert (model.judge(t) or [None])[0] == family, t
    for text in [*ls.OTHERS, *prose(2, 300), "", "   ", "license", "A driver's license was shown.", "He was released under the MIT supervision."]:
        assert model.judge(text) is None, text


def plain_stretches(model, words):
    """Templates of which some run of at most twice their words holds enough pairs, all runs compared."""
    out = set()
    for k, (_, t, _) in enumerate(model.templates):
        wide = 2 * len(t) + 1
        if any(ls.contained(words[i : i + wide], t) >= ls.needed(t) - 1e-9 for i in range(len(words))):
            out.add(k)
    return out


def test_stretches_are_those_of_all_runs(model):
    r = random.Random(4)
    for n in range(40):
        words = ls.terms(" ".join(prose(50 + n, 3)))
        for _, t, _ in r.sample(model.templates, 4):
            words += [w for w in t if r.random() > r.choice([0, 0.1, 0.3])] + ls.terms(prose(n, 1)[0])
        assert {x[2] for x in model.stretches(words)} == plain_stretches(model, words)


GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining
a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""


def test_wrapped_notices(spark, model):
    texts = {"gpl": GPL, "mit": MIT, "apache-2.0": APACHE, "bsd": BSD, "mpl-2.0": MPL}
    rows = [(k, "\n".join([*prose(k, 2), "", t, "", *prose(90 + k, 2)])) for k, t in enumerate(texts.values())]
    got = ls.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert {(r.doc_id, r.family) for r in got} == set(enumerate(texts))
    one = next(r for r in got if r.family == "gpl")
    assert (one.line_no, one.last_line, one.paragraph) == (3, 6, GPL)


def test_several_families_in_one_line(model):
    words = ls.terms(" ".join([*prose(11, 3), ls.TEMPLATES["mit"][0], *prose(12, 3), "Licensed under CC BY-NC 4.0.", *prose(13, 3), "All rights reserved."]))
    assert [x.family for x in model.spans(words)] == ["mit", "cc-by-nc", "proprietary"]


def test_long_paragraph(model):
    text = " ".join(prose(3, 200)) + " Released under the MIT License. " + " ".join(prose(5, 200))
    assert model.judge(text)[0] == "mit"


def test_scan(spark):
    lines = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0."]
    rows = [(1, "\n".join([prose(6, 1)[0], lines[0], prose(7, 1)[0]]), 0), (2, lines[1] + "\n" + lines[2], 0), (2, lines[1], 0), (3, None, 0), (4, "", 0), (None, lines[0], 0), (5, "\n".join(prose(8, 30)), 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, family int")
    got = sorted((r.doc_id or 0, r.line_no, r.family) for r in ls.scan(docs, ls.train(docs)).collect())
    assert got == [(0, 0, "mit"), (1, 1, "mit"), (2, 0, "apache-2.0"), (2, 0, "apache-2.0"), (2, 1, "cc-by-nc")]
    assert ls.scan(docs.limit(0), ls.train(docs.limit(0))).count() == 0
