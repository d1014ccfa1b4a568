"""Licence scans: a paragraph classifier confirmed by templates (built-in functions only).

Model: multinomial logistic regression over word 1- and 2-grams (present or
not), made sparse by an L1 penalty. Its classes are the licence families and
``unknown``. It is trained on the driver from the fixed phrases below, each put
into common statements, against look-alikes (statements without a licence's
name, other uses of the word) and paragraphs of at most SAMPLE documents of
the corpus. Every third example is kept from training: a temperature is
calibrated on those, and the least probability at which a family is accepted is
above what any held-out look-alike gets from any family.

Scan: a paragraph is a line, or a window of 2 * REACH words over the lines between
two blank ones (lines without a word), for statements that are wrapped; windows
overlap by REACH words, more than the longest template has. A family needs one
of the model's trigger words: the triggers are chosen so that without any of them
the positive weights that remain cannot reach acceptance, whatever else the
paragraph holds; so texts without a trigger are passed over and nothing is lost.
Each other paragraph is scored; every family that is likely against ``unknown``
(by the odds that acceptance takes, whatever other families share the
probability) is compared with its templates. A template is confirmed if it
stands in the paragraph word by word, or if at least CONFIRM of its 2-grams do
and these are not merely parts of other templates there (GPL within LGPL, two
statements side by side); for windows, parts of other templates in the document.
All of it is higher-order functions within the row: no shuffle, no Python,
whatever the sources.

Result, one row per document: family and licence (the template) of the most
probable confirmed paragraph, ``unknown`` if paragraphs were accepted but none
confirmed, ``none`` otherwise; probability and similarity of that paragraph (0
for ``none``), the numbers of accepted and confirmed paragraphs (lines, and
licences that only windows show; accepted windows if there are neither), and ``licences``: every confirmed licence with its
family, highest probability and similarity there, most probable first. Families named in one
paragraph share its probability.

Defined cases: null text counts as empty; empty texts have ``none``; of equally
probable licences the most similar counts, then the greatest name; repeated rows give
repeated results; an empty table gives an empty result; extra columns are not
looked at."""

from __future__ import annotations

import hashlib
import json
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import rows_of, table

UNKNOWN = "unknown"
SAMPLE = 64             # documents whose paragraphs are examples of no licence
SAMPLE_LINES = 300
SAMPLE_CHARS = 2000     # longer paragraphs are not trained on
CONFIRM = 0.8
REACH = 48              # words that any window holds together; above the longest template's
LEAST = 0.5             # least probability of an accepted family
L1 = 0.002
STEPS = 400

# Family -> licence -> phrases that name it or open its text.
LICENCES = {
    "AGPL": {"AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3"]},
    "Apache": {"Apache-2.0": ["Apache License, Version 2.0", "Apache-2.0", "Apache License 2.0"]},
    "BSD": {"BSD-2-Clause": ["BSD 2-Clause License", "simplified BSD license"],
            "BSD-3-Clause": ["BSD 3-Clause License", "new BSD license",
                             "Redistribution and use in source and binary forms, with or without modification, "
                             "are permitted provided that the following conditions are met"]},
    "CC-BY": {"CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"]},
    "CC-BY-NC": {"CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"]},
    "CC-BY-SA": {"CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"]},
    "CC0": {"CC0-1.0": ["CC0 1.0 Universal", "CC0 public domain dedication"]},
    "EPL": {"EPL-2.0": ["Eclipse Public License, version 2.0", "EPL-2.0"]},
    "GPL": {"GPL-2.0": ["GNU General Public License, version 2", "GPL-2.0", "GPLv2"],
            "GPL-3.0": ["GNU General Public License, version 3", "GPL-3.0", "GPLv3"]},
    "ISC": {"ISC": ["ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose "
                    "with or without fee is hereby granted"]},
    "LGPL": {"LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPL-2.1"],
             "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPLv3"]},
    "MIT": {"MIT": ["MIT License", "MIT licence",
                    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                    "associated documentation files, to deal in the Software without restriction"]},
    "MPL": {"MPL-2.0": ["Mozilla Public License, version 2.0", "MPL-2.0", "Mozilla Public License, v. 2.0"]},
    "Unlicense": {"Unlicense": ["The Unlicense", "This is free and unencumbered software released into the public domain"]},
}
# Statements a licence's name is put into.
STATEMENTS = [
    "Released under the {}.", "Licensed under the {}.", "Licensed under {}.", "This work is licensed under the {}.",
    "This work is licensed under {}.", "This project is distributed under the terms of the {}.", "License: {}",
    "Available under {}.", "The code in this repository is covered by the {}.", "See the {} for details.",
    "SPDX-License-Identifier: {}", "{}", "You may use this file under the {} only.", "Copyright the authors, {}.",
]
# What resembles such a statement and names no licence.
LOOK_ALIKES = [
    "His driver's license was renewed last year.", "The bar lost its licence to sell alcohol.", "Licensed under the law.",
    "The university license covers all students.", "She studied at MIT for four years.", "mit der und die mit einem",
    "The general public is invited.", "A version of the story was released under another name.", "Apache helicopters flew by.",
    "The public domain contains many books.", "Read the terms of the agreement.", "Version 2.0 was released in May.",
    "This work is licensed to the publisher.", "Permission to enter is hereby granted.", "free of charge for any person",
    "Creative people share common goals.", "The Mozilla project began in 1998.", "An eclipse was seen by the public.",
    "All rights reserved.", "The software comes with documentation.", "Copyright the authors.", "GNU is an animal.",
    "Redistribution of income and use of sources", "Distributed under the bridge.", "See the manual for details.",
    "The license fee is due.", "Licensed electricians only.", "Commons debate on public attribution of costs",
    "version 3 of the general plan", "a lesser general", "The code is covered.", "with or without modification",
]
_BLANK = r"\n[^A-Za-z0-9\x{80}-\x{10FFFF}]*\n"
_SPLIT = r"[^a-z0-9\x{80}-\x{10FFFF}]+"


def words_of(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9\x80-\U0010ffff]+", text.lower()) if w]


def grams_of(words: list[str]) -> set[str]:
    return set(words) | {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


def examples(corpus: list[str]) -> tuple[list[str], list[str]]:
    """Texts and their families."""
    texts, families = [], []
    for family, licences in LICENCES.items():
        for phrases in licences.values():
            for p in phrases:
                for s in STATEMENTS if len(p) < 60 else ["{}", "{}."]:
                    texts.append(s.format(p))
                    families.append(family)
    bare = [s.replace("{}", "").strip() for s in STATEMENTS] + [s.format("rules") for s in STATEMENTS]
    for t in [*LOOK_ALIKES, *bare, *corpus]:
        if t and "licen" not in t.lower() or t in LOOK_ALIKES or t in bare:
            texts.append(t)
            families.append(UNKNOWN)
    return texts, families


class Model:
    """features: gram -> weights by class; classes in order, the last one unknown."""

    def __init__(self, classes: list[str], bias: list[float], features: dict[str, list[float]], least: float):
        self.classes, self.bias, self.features, self.least = classes, bias, features, least

    @classmethod
    def train(cls, corpus: list[str]) -> Model:
        import numpy as np
        texts, families = examples(sorted(set(corpus)))
        classes = [*sorted(LICENCES), UNKNOWN]
        grams = [grams_of(words_of(t)) for t in texts]
        seen: dict[str, int] = {}
        for g in grams:
            for x in g:
                seen[x] = seen.get(x, 0) + 1
        named = {x for g, f in zip(grams, families, strict=True) if f != UNKNOWN for x in g}
        vocabulary = sorted(x for x, n in seen.items() if n > 1 and x in named)
        place = {x: k for k, x in enumerate(vocabulary)}
        x = np.zeros((len(texts), len(vocabulary) + 1))
        for k, g in enumerate(grams):
            x[k, [place[w] for w in g if w in place]] = 1
        x[:, -1] = 1
        y = np.zeros((len(texts), len(classes)))
        y[range(len(texts)), [classes.index(f) for f in families]] = 1
        held = np.arange(len(texts)) % 3 == 2
        w = _fit(x[~held], y[~held])
        z = x[held] @ w
        heat = min(np.geomspace(0.2, 5, 41), key=lambda t: -float((y[held] * _log_softmax(z / t)).sum()))
        w /= heat
        p = np.exp(_log_softmax(x[held] @ w))
        alike = p[y[held][:, -1] == 1][:, :-1]
        top = float(alike.max()) if alike.size else 0.0
        features = {g: [round(float(v), 6) for v in w[k]] for g, k in place.items() if np.abs(w[k]).max() > 1e-6}
        return cls(classes, [round(float(v), 6) for v in w[-1]], features, min(0.9, max(LEAST, top + 0.02)))

    def triggers(self) -> list[str]:
        """Words of which a paragraph must have one for any family to be accepted: all
        other features together leave every family's log-odds to ``unknown`` below what
        acceptance takes."""
        need = math.log(self.least / (1 - self.least))
        chosen: set[str] = set()
        for k in range(len(self.classes) - 1):
            gain: dict[str, float] = {}     # by word: the positive margins of the grams that have it
            rest = self.bias[k] - self.bias[-1]
            margins = {g: w[k] - w[-1] for g, w in self.features.items() if w[k] > w[-1]}
            for g, m in margins.items():
                if not chosen.intersection(g.split()):
                    rest += m
                    for word in g.split():
                        gain[word] = gain.get(word, 0) + m
            while rest >= need and gain:
                word = max(gain, key=lambda v: (gain[v], v))
                chosen.add(word)
                rest, gain = self.bias[k] - self.bias[-1], {}
                for g, m in margins.items():
                    if not chosen.intersection(g.split()):
                        rest += m
                        for v in g.split():
                            gain[v] = gain.get(v, 0) + m
        return sorted(chosen)


def _log_softmax(z):
    import numpy as np
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def _fit(x, y):
    """Weights by accelerated proximal gradient steps; the last row, the constant, is not shrunk."""
    import numpy as np
    step = 1 / (0.5 * np.linalg.norm(x, 2) ** 2 / len(x))
    w = ahead = np.zeros((x.shape[1], y.shape[1]))
    shrink = np.full((x.shape[1], 1), L1 * step)
    shrink[-1] = 0
    for k in range(STEPS):
        new = ahead - step * (x.T @ (np.exp(_log_softmax(x @ ahead)) - y)) / len(x)
        new = np.sign(new) * np.maximum(np.abs(new) - shrink, 0)
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return w


def templates() -> list[tuple[str, str, list[str]]]:
    """(family, licence, 2-grams) of every phrase of two words or more."""
    out = []
    for family, licences in sorted(LICENCES.items()):
        for licence, phrases in sorted(licences.items()):
            for p in phrases:
                w = words_of(p)
                pairs = sorted({f"{a} {b}" for a, b in zip(w, w[1:], strict=False)}) or w
                out.append((family, licence, pairs))
    return out


def phrases() -> list[str]:
    """The words of every template, in the order of ``templates``."""
    return [" ".join(words_of(p)) for _, licences in sorted(LICENCES.items())
            for _, own in sorted(licences.items()) for p in own]


def train(docs: DataFrame) -> Model:
    """A model whose examples of no licence include paragraphs of SAMPLE documents."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # ids first: each task sends the driver SAMPLE ids, not as many texts
    picked = F.broadcast(docs.select("doc_id").orderBy(*order).limit(SAMPLE).distinct())    # at most SAMPLE rows
    rows = (rows_of(docs).where(F.length("text") <= 1 << 16).join(picked, "doc_id")
            .orderBy(*order, "text").limit(SAMPLE).collect())
    return Model.train(sample_lines([r.text for r in rows]))


def sample_lines(texts: list[str]) -> list[str]:
    """SAMPLE_LINES different lines, chosen by a hash, whatever they begin with."""
    lines = {x for t in texts for x in t.split("\n") if 0 < len(x) <= SAMPLE_CHARS}
    return sorted(lines, key=lambda x: (hashlib.sha256(x.encode("utf-8", "surrogatepass")).digest(), x))[:SAMPLE_LINES]


def _literal(value, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)      # folded to a constant by the optimiser


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPLIT), lambda w: w != "")


def _pairs(words: Column) -> Column:
    n = F.size(words)
    return F.when(n > 1, F.zip_with(F.slice(words, 1, n - 1), F.slice(words, 2, n - 1),
                                    lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))


def _windows(words: Column) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - REACH, F.lit(1)), F.lit(REACH))
    return F.transform(starts, lambda i: F.slice(words, i, 2 * REACH))


def _own(mine: Column, pool: Column) -> Column:
    """Of the matches ``mine`` those that stand word by word, or whose 2-grams beyond such
    templates of ``pool`` are not a part of another match's there."""
    whole = F.flatten(F.transform(F.filter(pool, lambda c: c["verbatim"]), lambda c: c["found"]))

    def part_of(c, d):
        rest, other = F.array_except(c["found"], whole), F.array_except(d["found"], whole)
        more = F.struct(F.size(other), d["similarity"], d["licence"]) > F.struct(F.size(rest), c["similarity"], c["licence"])
        return (F.size(rest) == 0) | (more & (F.size(F.array_except(rest, other)) == 0))
    return F.filter(mine, lambda c: c["verbatim"] | ~F.exists(pool, lambda d: part_of(c, d)))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs`` (see the module's text)."""
    need = math.log(model.least / (1 - model.least))
    triggers = _literal(model.triggers(), "array<string>")
    vocabulary = _literal(sorted(model.features), "array<string>")
    weights = _literal(model.features, "map<string,array<double>>")
    bias = _literal(model.bias, "array<double>")
    known = _literal([{"n": n, "k": model.classes.index(f), "family": f, "licence": c, "pairs": g, "phrase": f" {p} "}
                      for n, ((f, c, g), p) in enumerate(zip(templates(), phrases(), strict=True))],
                     "array<struct<n:int,k:int,family:string,licence:string,pairs:array<string>,phrase:string>>")
    every = _literal(sorted({c for _, c, _ in templates()}), "array<string>")
    none = F.array().cast("array<string>")
    has_trigger = rows_of(docs).withColumn("hit", F.arrays_overlap(_words(F.col("text")), triggers))
    blocks = has_trigger.select(
        "doc_id", F.when(F.col("hit"), F.split("text", "\n")).otherwise(none).alias("lines"),
        F.when(F.col("hit"), F.filter(F.split("text", _BLANK), lambda b: F.contains(b, F.lit("\n")))).otherwise(none)
        .alias("blocks"))
    words = blocks.select("doc_id", F.transform("lines", _words).alias("lines"),
                          F.transform("blocks", _words).alias("blocks"))
    words = words.select("doc_id", "lines", F.flatten(F.transform("blocks", _windows)).alias("windows"))

    def grammed(name, wide):
        return F.transform(F.filter(name, lambda w: F.arrays_overlap(w, triggers)), lambda w: F.struct(
            F.lit(wide).alias("wide"), w.alias("words"), _pairs(w).alias("pairs")))
    grams = words.select("doc_id", F.concat(grammed("lines", False), grammed("windows", True)).alias("grams"))

    def logits(g):
        present = F.array_intersect(F.concat(g["words"], g["pairs"]), vocabulary)
        return F.aggregate(present, bias, lambda s, x: F.zip_with(s, F.element_at(weights, x), lambda a, b: a + b))
    scored = grams.select("doc_id", F.transform("grams", lambda g: F.struct(
        g["wide"].alias("wide"), g["pairs"].alias("pairs"), g["words"].alias("words"), logits(g).alias("z"))).alias("scored"))
    last = len(model.classes)
    likely = scored.select("doc_id", F.filter("scored", lambda s: F.array_max(F.slice(s["z"], 1, last - 1))
                                              - F.element_at(s["z"], last) >= need).alias("likely"))

    def probable(s):
        top = F.array_max(s["z"])
        total = F.aggregate(s["z"], F.lit(0.0), lambda t, v: t + F.exp(v - top))
        return F.struct(s["wide"].alias("wide"), F.concat(s["pairs"], s["words"]).alias("grams"),
                        F.concat(F.lit(" "), F.concat_ws(" ", s["words"]), F.lit(" ")).alias("text"),
                        F.transform(s["z"], lambda v: v - F.element_at(s["z"], last) >= need).alias("likely"),
                        F.transform(s["z"], lambda v: F.exp(v - top) / total).alias("p"))
    given = likely.select("doc_id", F.transform("likely", probable).alias("given"))

    def matched(s):
        return F.transform(known, lambda t: F.struct(
            F.element_at(s["p"], t["k"] + 1).alias("p"), F.element_at(s["likely"], t["k"] + 1).alias("likely"),
            t["n"].alias("n"), t["family"].alias("family"), t["licence"].alias("licence"),
            F.size(t["pairs"]).alias("of"), F.array_intersect(t["pairs"], s["grams"]).alias("found"),
            F.contains(s["text"], t["phrase"]).alias("verbatim")))

    def match(c):
        return F.struct((F.size(c["found"]) / c["of"]).alias("similarity"), F.round(c["p"], 6).alias("p"),
                        *(c[x].alias(x) for x in ("likely", "n", "family", "licence", "found", "verbatim")))
    compared = given.select("doc_id", F.transform("given", lambda s: F.struct(
        s["wide"].alias("wide"), F.array_max(F.slice(s["p"], 1, last - 1)).alias("p"),
        F.transform(matched(s), match).alias("matches"))).alias("given"))

    def similarity(s):      # of the most probable family
        best = F.filter(s["matches"], lambda c: c["p"] == F.round(s["p"], 6))
        return F.array_max(F.transform(best, lambda c: c["similarity"]))
    compared = compared.select("doc_id", F.transform("given", lambda s: F.struct(
        s["wide"].alias("wide"), s["p"].alias("p"), similarity(s).alias("similarity"),
        F.filter(s["matches"], lambda c: c["similarity"] >= CONFIRM).alias("matches"))).alias("given"))
    lines = F.transform(F.filter("given", lambda s: ~s["wide"]), lambda s: F.struct(
        s["p"].alias("p"), s["similarity"].alias("similarity"),
        F.filter(_own(s["matches"], s["matches"]), lambda c: c["likely"]).alias("sure")))
    weak = F.transform(F.filter("given", lambda s: s["wide"] & (s["p"] >= model.least)), lambda s: F.struct(
        s["p"].alias("p"), s["similarity"].alias("similarity"), F.slice(s["matches"], 1, 0).alias("sure")))
    split = compared.select(
        "doc_id", lines.alias("lines"), weak.alias("weak"),
        F.flatten(F.transform("given", lambda s: s["matches"])).alias("pool"),
        F.flatten(F.transform(F.filter("given", lambda s: s["wide"]), lambda s: s["matches"])).alias("wide"))

    def best_of(matches, holds=lambda c: F.lit(True)):      # one for each template, whatever the number of paragraphs
        tops = F.transform(known, lambda t: F.array_max(F.filter(matches, lambda c: (c["n"] == t["n"]) & holds(c))))
        return F.when(F.size(matches) > 0, F.filter(tops, lambda c: c.isNotNull())).otherwise(F.slice(matches, 1, 0))
    split = split.select(
        "doc_id", F.filter("lines", lambda s: (F.size(s["sure"]) > 0) | (s["p"] >= model.least)).alias("lines"),
        F.flatten(F.transform("lines", lambda s: s["sure"])).alias("sure"),
        best_of(F.col("pool")).alias("pool"), best_of(F.col("wide"), lambda c: c["likely"]).alias("wide"), "weak")
    split = split.select("doc_id", "lines", "weak", "sure", F.filter(_own(F.col("wide"), F.col("pool")), lambda c: ~F.array_contains(
        F.transform("sure", lambda d: d["licence"]), c["licence"])).alias("wide"))

    def licences(matches):
        ranked = F.transform(matches, lambda c: F.struct(*(c[x].alias(x) for x in ("p", "similarity", "licence", "family"))))
        tops = F.transform(every, lambda e: F.array_max(F.filter(ranked, lambda c: c["licence"] == e)))
        return F.sort_array(F.filter(tops, lambda c: c.isNotNull()), asc=False)
    only_weak = (F.size("lines") == 0) & (F.size("wide") == 0)
    listed = split.select("doc_id", F.when(only_weak, F.col("weak")).otherwise(F.col("lines")).alias("lines"), licences(F.concat("sure", "wide")).alias("found"),
                          F.size(F.array_distinct(F.transform("wide", lambda c: c["licence"]))).alias("in_windows"),
                          F.size(F.filter("lines", lambda s: F.size(s["sure"]) > 0)).alias("in_lines"))
    top = F.when(F.size("found") > 0, F.struct(F.get("found", F.lit(0))["p"].alias("p"), F.get("found", F.lit(0))["similarity"].alias(
        "similarity"))).otherwise(F.array_max(F.transform("lines", lambda s: F.struct(F.round(s["p"], 6).alias("p"), s["similarity"].alias("similarity")))))
    picked = listed.withColumn("top", top)
    is_sure = F.size("found") > 0
    return picked.select(
        "doc_id",
        F.when(is_sure, F.get("found", F.lit(0))["family"]).when(F.size("lines") > 0, UNKNOWN).otherwise("none").alias("family"),
        F.get("found", F.lit(0))["licence"].alias("licence"),
        F.coalesce("top.p", F.lit(0.0)).alias("probability"),
        F.coalesce("top.similarity", F.lit(0.0)).alias("similarity"),
        (F.size("lines") + F.col("in_windows")).alias("accepted"),
        (F.col("in_lines") + F.col("in_windows")).alias("confirmed"),
        F.transform("found", lambda c: F.struct(
            c["family"].alias("family"), c["licence"].alias("licence"), c["p"].alias("probability"),
            c["similarity"].alias("similarity"))).alias("licences"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, train(docs))
