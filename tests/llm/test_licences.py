import math

import pytest

from tests.llm.helpers import docs, odd_columns
from tidemart.llm import licences as L


@pytest.fixture(scope="module")
def model():
    return L.Model.train(["Thnd of the ereath.", "mit der und", "Es for er ertheation of."])


def brute(model, text):
    accepted = []
    for line in (text or "").split("\n"):
        words = L.words_of(line)
        if not words:
            continue
        z = list(model.bias)
        for g in L.grams_of(words) & set(model.features):
            z = [a + b for a, b in zip(z, model.features[g], strict=True)]
        top = max(z)
        k = max(range(len(z) - 1), key=lambda k: z[k])
        p = math.exp(z[k] - top) / sum(math.exp(v - top) for v in z)
        if p >= model.least:
            family = model.classes[k]
            grams = L.grams_of(words)
            best = max((len(grams & set(t)) / len(t), c) for f, c, t in L.templates() if f == family)
            accepted.append((round(p, 6), best[1], family, best[0]))
    sure = [a for a in accepted if a[3] >= L.CONFIRM]
    top = max(sure or accepted, default=(0.0, None, None, 0.0))
    return (top[2] if sure else L.UNKNOWN if accepted else "none", top[1] if sure else None, top[0], top[3],
            len(accepted), len(sure))


TEXTS = [
    "Released under the MIT License.", "Text before.\nLicensed under the Apache License, Version 2.0.\nafter",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
    "RELEASED UNDER THE MIT LICENSE\nLicensed under the Apache License, Version 2.0.", "mit der und die mit einem",
    "His driver's license was renewed.", "Licensed under the law of the land", "GPLv2 or GPLv3", "é\n\n \nMIT",
    "GNU Lesser General Public License, version 2.1", "apache apache apache", "under the public license", "", None,
    "word " * 50_000 + "under the MIT License", "License: BSD 3-Clause License", "This is Mozilla license text",
]


def test_scan_matches_brute_force(spark, model):
    rows = [*enumerate(TEXTS), (1, TEXTS[1]), (None, TEXTS[0])]
    got = sorted(((r.doc_id, r.family, r.licence, r.probability, round(r.similarity, 9), r.accepted, r.confirmed)
                  for r in L.scan(odd_columns(docs(spark, rows)), model).collect()), key=repr)
    want = []
    for i, t in rows:
        f, c, p, s, a, n = brute(model, t)
        want.append((i, f, c, p, round(s, 9), a, n))
    assert got == sorted(want, key=repr)
    found = dict((r[0], r[2]) for r in got if r[0] is not None)
    assert [found[k] for k in range(5)] == ["MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0", "Apache-2.0"] or found[4] == "MIT"
    assert all(found[k] is None for k in (5, 6, 7, 11, 13, 14))


def test_nothing_is_accepted_without_a_trigger(model):
    triggers = set(model.triggers())
    need = math.log(model.least / (1 - model.least))
    for k in range(len(model.classes) - 1):
        most = model.bias[k] - model.bias[-1] + sum(
            max(0, w[k] - w[-1]) for g, w in model.features.items() if not triggers & set(g.split()))
        assert most < need


def test_every_statement_of_every_licence_is_found(model):
    missed = [p for family, licences in L.LICENCES.items() for phrases in licences.values() for p in phrases
              if brute(model, f"Released under the {p}.")[0] != family]
    assert not missed


def test_look_alikes_are_left_alone(model):
    assert [t for t in L.LOOK_ALIKES if brute(model, t)[0] not in ("none", L.UNKNOWN)] == []


def test_plan_is_native(spark, model):
    assert L.scan(docs(spark, []), model).count() == 0
    plan = L.scan(docs(spark, [(1, "a")]), model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "from_json" not in plan


GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
BSD = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are
# met:"""
MIT = """Permission is hereby granted, free of charge, to any person obtaining
a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including"""
LGPL = """ * This library is free software; you can redistribute it and/or modify
 * it under the terms of the GNU Lesser General Public License as published
 * by the Free Software Foundation; either version 2.1 of the License"""
PROSE = "some words of no matter that go on and on\n" * 40


def licences(spark, model, texts):
    rows = L.scan(docs(spark, list(enumerate(texts))), model).orderBy("doc_id").collect()
    return [(r, {x.licence for x in r.licences}) for r in rows]


def test_wrapped_notices_are_found(spark, model):
    texts = [GPL, BSD, MIT, LGPL, PROSE + GPL + "\n" + PROSE, PROSE + "\n" + MIT + "\r\n\r\n" + PROSE,
             "Released under the GNU Lesser\nGeneral Public License,\nversion 3.", MIT + "\n\n" + GPL]
    want = [{"GPL-3.0"}, {"BSD-3-Clause"}, {"MIT"}, {"LGPL-2.1"}, {"GPL-3.0"}, {"MIT"}, {"LGPL-3.0"}, {"MIT", "GPL-3.0"}]
    got = licences(spark, model, texts)
    assert [found for _, found in got] == want
    for r, found in got:
        assert r.licence in found and r.confirmed == len(found) <= r.accepted and r.similarity >= L.CONFIRM


def test_windows_hold_every_statement_together(spark, model):
    for n in range(0, 3 * L.REACH, 17):
        text = "word\n" * n + MIT.replace(" ", "\n") + "\nword" * (3 * L.REACH - n)
        assert licences(spark, model, [text])[0][1] == {"MIT"}, n
    assert max(len(p.split()) for p in L.phrases()) < L.REACH


def test_wrapped_statement_without_template_is_unknown(spark, model):
    (r, found), = licences(spark, model, ["Released under the GNU General\nPublic License"])
    one, = L.scan(docs(spark, [(1, "Released under the GNU General Public License")]), model).collect()
    assert not found and r.family == one.family and r.accepted >= (one.family == L.UNKNOWN)


def test_all_licences_of_a_document(spark, model):
    texts = ["MIT License or Apache License, Version 2.0", "GPLv2 or GPLv3", TEXTS[4],
             "GNU General Public License, version 3.\nApache License, Version 2.0.",
             "GNU Lesser General Public License, version 3", "Licensed under CC BY-SA 4.0", "under the law", ""]
    got = licences(spark, model, texts)
    assert [found for _, found in got] == [{"MIT", "Apache-2.0"}, {"GPL-2.0", "GPL-3.0"}, {"MIT", "Apache-2.0"},
                                           {"GPL-3.0", "Apache-2.0"}, {"LGPL-3.0"}, {"CC-BY-SA-4.0"}, set(), set()]
    for r, found in got:
        assert r.licence == (r.licences[0].licence if found else None)
        assert [x.probability for x in r.licences] == sorted((x.probability for x in r.licences), reverse=True)


def test_examples_are_not_an_alphabetical_prefix():
    texts = ["\n".join(f"{c}{i} line" for i in range(40)) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdé漢"]
    lines = L.sample_lines(texts)
    assert len(lines) == len(set(lines)) == L.SAMPLE_LINES and {x[0] for x in lines} >= set("AZadé漢")
    assert lines == L.sample_lines(texts[::-1])
