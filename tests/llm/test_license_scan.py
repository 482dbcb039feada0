from __future__ import annotations

import random
import re

import pytest

from tallyflow.llm import license_scan as lic
from tests.llm.helpers import documents, lower, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    w = WORD.findall(lower(text or ""))
    places, labels = [], set()
    for phrase, label in lic.BASE.items():
        p = phrase.split()
        for k in range(len(w) - len(p) + 1):
            if w[k : k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def texts():
    rng = random.Random(6)
    notes = ["MIT License", "mit-license!", "Apache\nLicense, Version 2.0", "GNU Lesser General Public License", "general public", "License", "MITLicense", "émit license"]
    out = []
    for _ in range(120):
        w = words(rng, rng.randint(0, 30))
        for _ in range(rng.randint(0, 4)):
            w.insert(rng.randint(0, len(w)), rng.choice(notes))
        out.append(" ".join(w))
    return out + [None, "", "mit license " * 3000, "mit license apache license general public license"]


def test_base_equals_brute_force(spark):
    t = texts()
    got = lic.scan_licenses(documents(spark, t)).collect()
    assert len(got) == len(t)
    for r in got:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(t[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] == 0) == (r["labels"] == "")


def test_expressions():
    assert lic.postfix("MIT or Apache-2.0 and (GPL-2.0+ with Classpath-exception-2.0)") == [
        "mit", "apache-2.0", "gpl-2.0+", "classpath-exception-2.0", "with", "and", "or",
    ]
    required, offered = lic.evaluate("(MIT OR ISC) AND BSD-3-Clause")
    assert required == {"bsd-3-clause"} and offered == {"mit", "isc", "bsd-3-clause"}
    assert lic.evaluate("GPL-2.0 WITH Classpath-exception-2.0")[0] == {"gpl-2.0 with classpath-exception-2.0"}
    for bad in ("", "and", "mit or", "mit isc", "(mit", "mit)", "()", "(mit or isc) with x", "mit with (a or b)", "m!t"):
        with pytest.raises(ValueError):
            lic.evaluate(bad)


def test_tags():
    find = lic.automaton()
    got = lic.scan("// SPDX-License-Identifier: (MIT OR Apache-2.0) AND ISC\nnext", find)
    assert got["labels"] == "apache-2.0,isc,mit" and got["expressions"] == ["( MIT OR Apache-2.0 ) AND ISC"]
    assert got["n_base"] == 0 and got["score"] == 0.75
    assert lic.scan("SPDX-License-Identifier: MIT or", find)["labels"] == "mit"
    many = " OR ".join(f"L-{k}" for k in range(200))
    assert lic.leading_expression(many + " ) x") == many
    assert lic.leading_expression("MIT WITH (A OR B)") == "MIT" and lic.leading_expression("( MIT") is None
    assert lic.scan("SPDX-License-Identifier: )(", find)["labels"] == ""


def test_edges(spark):
    assert lic.scan_licenses(documents(spark, [])).collect() == []
    df = spark.createDataFrame([(1, "MIT License", 0.5), (1, "MIT License", 0.5), (None, None, None)], "doc_id long, text string, score double")
    got = lic.scan_licenses(df).collect()
    assert sorted(r["base_labels"] for r in got) == ["", "mit", "mit"] and sorted(r["score"] for r in got) == [0.0, 0.75, 0.75]
