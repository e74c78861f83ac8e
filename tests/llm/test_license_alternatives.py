"""Every alternative of every license rule is found through the keyword gate."""

from re import _constants as c
from re import _parser

import pytest
from ratecraft.llm import op03_licenses as lic

SHORTEST_WORDS = {c.CATEGORY_WORD: "a", c.CATEGORY_DIGIT: "2"}


def texts_of(tree) -> list[str]:
    """Texts of a parsed pattern that use each of its alternatives and optional parts at least once."""
    parts = []
    for op, arg in tree:
        if op is c.LITERAL:
            parts.append([chr(arg)])
        elif op is c.ANY:
            parts.append(["z"])
        elif op is c.NOT_LITERAL:
            parts.append(["z"])
        elif op is c.IN:
            parts.append([chr(x) if k is c.LITERAL else SHORTEST_WORDS[x] for k, x in arg if k in (c.LITERAL, c.CATEGORY)])
        elif op is c.BRANCH:
            parts.append([t for b in arg[1] for t in texts_of(b)])
        elif op is c.SUBPATTERN:
            parts.append(texts_of(arg[3]))
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
            low, _, sub = arg
            parts.append(([""] if low == 0 else []) + [t * max(low, 1) for t in texts_of(sub)])
        elif op is not c.ASSERT:
            raise AssertionError(op)
    # each choice of each part once, beside the first choice of the others
    out = ["".join(p[0] for p in parts)]
    for i, p in enumerate(parts):
        out += ["".join(x if k == i else q[0] for k, q in enumerate(parts)) for x in p[1:]]
    return out


def test_every_alternative_wakes_its_rule():
    scanner = lic.Scanner()
    seen = missed = 0
    for i, rule in enumerate(scanner.rules):
        for text in texts_of(_parser.parse(rule.pattern.pattern)):
            line = f" {text} "
            if not rule.pattern.search(line):
                continue
            seen += 1
            present = {k for _, k in scanner.automaton.iter(line)}
            if not scanner.needs[i] <= present:
                missed += 1
                print(rule.label, rule.pattern.pattern, rule.literals, repr(line))
    assert seen > 3000 and not missed


@pytest.mark.parametrize("text", ["CC Zero 1.0", "Creative Commons 0", "creative commons zero", "CC0 1.0 Universal", "CC0"])
def test_cc0_names(text):
    assert "cc0" in lic.Scanner().scan(text)["labels"].split(",")


def test_every_name_has_signatures_of_its_text():
    """Each named license is found by three sentences of its text at least, each without the license's name around it."""
    scanner = lic.Scanner()
    labels = {label for label, _, _ in lic.NAMES}
    assert set(lic.SIGNATURES) == labels and all(len(s) >= 3 for s in lic.SIGNATURES.values())
    assert sum(map(len, lic.SIGNATURES.values())) >= 200
    sentences = [x for s in lic.SIGNATURES.values() for x in s]
    assert len(set(sentences)) == len(sentences)
    for label, own in lic.SIGNATURES.items():
        for sentence in own:
            text = "Before, " + sentence.replace(" ... ", " some other (words) ").capitalize() + "; after."
            assert label in scanner.scan(text)["labels"].split(","), (label, sentence)


def test_signatures_are_written_normalised():
    from ratecraft.llm.op07_decontam import words_of
    for own in lic.SIGNATURES.values():
        for sentence in own:
            for part in sentence.split(" ... "):
                assert b" ".join(words_of(part)).decode() == part
