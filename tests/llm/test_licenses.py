"""License rules: wrapped notices, order, longest rule, odd rows."""

import re

import pytest

from llm_fixtures import documents, odd  # noqa: F401

from commutewell.llm import licenses

MIT = """Some Library, Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
CASES = [
    (MIT, "MIT", "mit-grant mit-notice"),
    (APACHE, "Apache-2.0", "apache-you apache-comply apache-copy apache-basis apache-see"),
    ("first words without an end\nReleased under the MIT License.\nmore", "MIT", "mit-ref"),
    ("RELEASED  under the\tMIT license! And: Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0,MIT", "cc-by-nc-ref,mit-ref"),
    ("We released under the MIT License.", "", ""),
    ("You may not use this file except in compliance with the License. Licensed under the Apache License", "", ""),
    ("All rights reserved.", "", ""),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_cases(documents, case):
    text, found, rules = CASES[case]
    got = licenses.scan(documents([(1, text, None, None, None)])).first()
    assert (got.licenses, got.rules) == (found, rules)


def test_anchors_lose_no_known_sentence():
    for sentence in licenses.SENTENCES.values():
        assert any(a in sentence.lower() for a in licenses.ANCHORS) or sentence.lower().startswith(("licensed", "you may")), sentence
        assert any(a in sentence.lower() for a in licenses.ANCHORS), sentence


def test_signs_and_line_ends_between_words(documents):
    """Every known sentence is found with any signs between its words."""
    texts = [re.sub(r"(?<=[a-zA-Z0-9]) (?=[a-zA-Z0-9])", " *\n# ", s) for s in licenses.SENTENCES.values()]
    got = {r.doc_id: r.sentences.split(",") for r in licenses.scan(documents([(i, t, None, None, 0) for i, t in enumerate(texts)])).collect()}
    for i, known in enumerate(licenses.SENTENCES):
        assert known in got[i], known


def test_rules_name_known_sentences():
    assert {name for _, rule in licenses.RULES for name in rule.split()} <= set(licenses.SENTENCES)


def test_no_python_in_the_plan(odd):
    plan = licenses.scan(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_odd_rows_and_empty_table(odd):
    got = licenses.scan(odd).collect()
    assert len(got) == odd.count() and {r.licenses for r in got} == {""}
    assert licenses.scan(odd.limit(0)).count() == 0


MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"""


@pytest.mark.parametrize(
    ("text", "found", "rules"),
    [
        ("// SPDX-License-Identifier: MIT", "MIT", "spdx-mit"),
        ("#!/bin/sh\n# SPDX-License-Identifier: Apache-2.0\nset -e", "Apache-2.0", "spdx-apache"),
        ("x. SPDX-License-Identifier: BSD-3-Clause. y", "BSD-3-Clause", "spdx-bsd3"),
        ("SPDX-License-Identifier:GPL-3.0-or-later", "GPL-3.0-or-later", "spdx-gpl3"),
        (MPL, "MPL-2.0", "mpl2-form"),
        ("SPDX-License-Identifier: ", "", ""),
        ("SPDX-License-Identifier: x. MIT", "", ""),
    ],
)
def test_sentences_that_hold_a_sentence_end(documents, text, found, rules):
    got = licenses.scan(documents([(1, text, None, None, None)])).first()
    assert (got.licenses, got.rules) == (found, rules)


def test_every_rule_matches_its_own_text(documents):
    texts = [". ".join(licenses.SENTENCES[name] for name in rule.split()) + "." for _, rule in licenses.RULES]
    got = {r.doc_id: r for r in licenses.scan(documents([(i, t, None, None, None) for i, t in enumerate(texts)])).collect()}
    for i, (lic, rule) in enumerate(licenses.RULES):
        assert lic in got[i].licenses.split(",") and rule in got[i].rules.split(","), rule
