"""The gated scan against all rules on texts made from the rules themselves."""

from itertools import product
from re import _parser

import pytest

from tableferry.llm import licenses


def samples(node) -> list[str]:
    """Texts a pattern matches: every branch, and every repeat at its least and its most (at most 2)."""
    made = [""]
    for kind, value in node:
        name = str(kind)
        if name == "LITERAL":
            more = [chr(value)]
        elif name == "IN":
            more = [chr(v if str(k) == "LITERAL" else v[0]) for k, v in value[:1]]
        elif name == "ANY":
            more = ["x"]
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = value
            one = samples(inner)[-1]
            more = sorted({one * low, one * min(int(high), max(low, 2))} if high > 1 else {"" if not low else one, one})
        elif name == "SUBPATTERN":
            more = samples(value[3])
        elif name == "BRANCH":
            more = [text for branch in value[1] for text in samples(branch)]
        else:
            assert name in ("ASSERT", "AT"), name
            more = [""]
        made = [a + b for a, b in product(made, more)][:64]
    return made


def ungated(scan: licenses.Scanner, form: bytes) -> list[licenses.Detection]:
    found = []
    for place, rule in enumerate(scan.rules):
        for match in rule.pattern.finditer(form):
            first = form.count(b" ", 0, match.start()) - 1
            found.append(
                licenses.Detection(rule.label, place, first, first + match[0].count(b" "), rule.priority)
            )
    return licenses.suppress(found)


def test_gate_passes_a_match_of_every_rule():
    scan = licenses.Scanner()
    for rule in scan.rules:
        texts = samples(_parser.parse(rule.pattern.pattern.decode()))
        forms = [scan.normal(text)[0] for text in texts]
        assert any(rule.pattern.search(form) for form in forms)
        for form in {f for f in forms if rule.pattern.search(f)}:
            assert any(word in form.decode() for word in rule.keywords), (rule.pattern.pattern, form)
        form = next(f for f in forms if rule.pattern.search(f))
        assert scan.detect(form) == ungated(scan, form)


@pytest.mark.parametrize(
    "text, label",
    [
        ("Licensed under the Q Public License", "qpl-1.0"),
        ("released under the Open RAIL-M license", "openrail"),
        ("under the terms of the University of Illinois Open Source License", "ncsa"),
        ("subject to the Open Source License", "ncsa"),
        ("You may not use this file except in compliance with the License", "apache"),
    ],
)
def test_names_without_their_label(text, label):
    scan = licenses.Scanner()
    assert label in {d.label for d in scan.detect(scan.normal(text)[0])}
