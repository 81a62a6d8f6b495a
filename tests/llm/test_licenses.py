import math
import re
import textwrap

import pytest
from conftest import SF_SMALL

from fixtures import awkward, docs_of, table
from segmint.llm import licenses as L


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(table(spark, SF_SMALL, "documents"))


def plain(text, m):
    """The scan of one text, paragraph by paragraph."""
    out, start = [], 0
    for at, line in enumerate((text or "").split("\n")):
        grams = set(L._grams(line))
        features = [g for g in m.weights if g in grams]
        z = list(m.bias)
        for g in features:
            z = [a + b for a, b in zip(z, m.weights[g], strict=True)]
        best = max(range(len(z)), key=lambda i: (z[i], -i))
        if features and m.classes[best] != L.NONE:
            p = 1 / sum(math.exp((x - z[best]) / m.temperature) for x in z)
            family = m.classes[best] if p >= m.accept else "unknown"
            of = L.TEMPLATES[family] if family != "unknown" else [t for ts in L.TEMPLATES.values() for t in ts]
            share = max(len(set(L._grams(t)) & grams) / len(L._grams(t)) for t in of)
            out.append((at, start, family, round(p, 6), round(share, 6), family != "unknown" and share >= 0.6))
        start += len(line) + 1
    return out


def test_scan_equals_a_plain_scan(spark, model):
    extra = [(9001, "x\n" + "\n".join(t for ts in L.TEMPLATES.values() for t in ts)), (9002, "This file is under some licence agreement of ours."), (9003, None), (9004, "É licensed\n\nunder the MIT license, É")]
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()] + extra
    got = {}
    for r in L.scan_licenses(docs_of(spark, rows), model).collect():
        got.setdefault(r.doc_id, []).append((r.paragraph, r.start, r.family, round(r.probability, 6), round(r.similarity, 6), r.confirmed))
    want = {d: found for d, t in rows if (found := plain(t, model))}
    assert {d: sorted(x) for d, x in got.items()} == want


def test_families_are_named(spark, model):
    known = [(f, t) for f, ts in L.TEMPLATES.items() if f != "unknown" for t in ts]
    got = {r.doc_id: r for r in L.scan_licenses(docs_of(spark, [(i, f"Some words before. {t} And some after.") for i, (_, t) in enumerate(known)]), model).collect()}
    right = sum(i in got and got[i].family == f and got[i].confirmed for i, (f, _) in enumerate(known))
    assert right >= 0.9 * len(known)
    strange = L.scan_licenses(docs_of(spark, [(1, "Licensed under the terms of the Foo Bar license agreement."), (2, "Nothing of the kind is in this text.")]), model).collect()
    assert not any(r.confirmed for r in strange) and {r.doc_id for r in strange} <= {1}


def test_main_path_is_native(spark, model):
    plan = L.scan_licenses(docs_of(spark, [(1, "MIT License")]), model)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapInArrow", plan)


def test_awkward_rows(spark, model):
    assert L.scan_licenses(awkward(spark), model).count() == 0
    assert L.scan_licenses(awkward(spark).limit(0), model).count() == 0
    assert L.fit(awkward(spark).limit(0)).classes[-1] == L.NONE
    twice = docs_of(spark, [(None, "Released under the MIT License."), (None, "Released under the MIT License.")])
    assert [(r.doc_id, r.family, r.start) for r in L.scan_licenses(twice, model).collect()] == [(None, "mit", 0)] * 2


MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND."""


@pytest.mark.parametrize("wrapped", [False, True])
def test_a_frequent_licence_is_still_found(spark, wrapped):
    body = "\n".join(textwrap.wrap(MIT_BODY.split("\n")[0], 72)) if wrapped else MIT_BODY
    bodies = [f"code {i}\n{body}\nmore code {i}" for i in range(100)]
    docs = docs_of(spark, [(i, bodies[i // 3] if i % 3 == 0 else f"def f{i}(x):\n    return the value of x + {i}\nand so on") for i in range(300)])
    frequent = L.fit(docs)
    assert {"hereby", "obtaining", "hereby granted"} <= set(frequent.weights)
    if not wrapped:
        found = [r for r in L.scan_licenses(docs, frequent).collect() if r.family == "mit" and r.confirmed]
        assert {r.doc_id for r in found} == set(range(0, 300, 3))


WRAPPED = {
    "gpl-3.0": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.""",
    "gpl-2.0": """ * You can redistribute it and/or modify it under the terms of the GNU
 * General Public License as published by the Free Software Foundation,
 * version 2""",
    "bsd": """// Redistribution and use in source and binary forms, with or without
// modification, are permitted provided that the following conditions are met:""",
    "mit": """Permission is hereby granted, free of
charge, to any person obtaining
a copy of this software and
associated documentation files""",
}


@pytest.mark.parametrize("family", WRAPPED)
def test_wrapped_notices(spark, model, family):
    notice = WRAPPED[family]
    k = notice.count("\n") + 1
    docs = docs_of(spark, [(1, f"import os\n\n{notice}\n\nx = 1"), (2, "a b\n" * 3 + f"{notice}\nthe end of it"), (3, notice.replace("\n", "\n\n")),
                           (4, f"{notice}\n\n{notice}"), (5, f"{notice}\nReleased under the MIT License.")])
    got = {}
    for r in L.scan_licenses(docs, model).collect():
        got.setdefault(r.doc_id, []).append(r)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for d, rows in got.items():
        for r in rows:
            assert texts[d][r.start:].startswith(r.text) and texts[d][:r.start].count("\n") == r.paragraph
    named = {d: [(r.paragraph, r.family) for r in sorted(rows, key=lambda r: r.paragraph) if r.confirmed] for d, rows in got.items()}
    assert [f for _, f in named[1]] == [f for _, f in named[2]] == [family]
    assert [f for _, f in named[4]] == [family] * 2 and named[4][1][0] >= k + 1
    assert [f for _, f in named[5]] == [family, "mit"] and named[5][1][0] == k
    best = next(r for r in got[1] if r.confirmed)
    assert best.similarity > 0.9 and best.text.count("\n") >= 1
    assert not any(best.paragraph <= r.paragraph < best.paragraph + best.text.count("\n") + 1 for r in got[1] if r is not best)
