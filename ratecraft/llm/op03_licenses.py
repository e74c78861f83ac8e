"""License scan by ordered signature rules.

Texts are normalised (A-Z lower-cased, words of digits, letters and non-ASCII
joined by single spaces). A rule is a regular expression over that line with a
label, a priority, a weight and the literals it cannot match without. One
Aho-Corasick pass over the line finds which literals occur; only rules whose
literals all occur are run. Detections are then ordered by priority, length
and place, and one whose words lie inside a kept one is suppressed, so a
license notice is not also reported as the mention that it contains.

The rules (some 800) are hand-written signatures: sentences of the texts and
notices of each license (``license_texts``, three at least for every label),
patterns of notices, and patterns for the ways a license is named (tag, grant,
versioned name, plain name) filled in for each name. The base phrases are
counted beside them and their labels always stay.

Defined cases: a null or empty text has no words and no detections (score 0);
overlapping detections neither of which holds the other are both kept; equal
detections of one label count once; repeated rows are scanned each by itself;
columns named like the added ones are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ratecraft.llm.common import ship, table
from ratecraft.llm.license_texts import SIGNATURES, pattern_and_literal
from ratecraft.llm.op07_decontam import words_of

#: Base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Names as normalised words: label, ways to name it, versions that get a label of their own.
NAMES = (
    ("mit", ("mit", "mit x11", "expat"), ()),
    ("apache", ("apache", "apache software", "asl"), ("1 0", "1 1", "2 0")),
    ("gpl", ("gpl", "gnu gpl", "gnu general public", "general public"), ("1", "2", "2 0", "3", "3 0")),
    ("lgpl", ("lgpl", "gnu lgpl", "gnu lesser general public", "lesser general public", "library general public"), ("2", "2 0", "2 1", "3", "3 0")),
    ("agpl", ("agpl", "gnu agpl", "gnu affero general public", "affero general public"), ("1", "3", "3 0")),
    ("gfdl", ("gfdl", "gnu free documentation", "free documentation"), ("1 1", "1 2", "1 3")),
    ("bsd", ("bsd", "new bsd", "modified bsd", "simplified bsd", "revised bsd", "berkeley software distribution"), ()),
    ("bsd-2-clause", ("2 clause bsd", "bsd 2 clause", "freebsd"), ()),
    ("bsd-3-clause", ("3 clause bsd", "bsd 3 clause"), ()),
    ("mpl", ("mpl", "mozilla public"), ("1 0", "1 1", "2 0")),
    ("epl", ("epl", "eclipse public"), ("1 0", "2 0")),
    ("edl", ("eclipse distribution",), ("1 0",)),
    ("cddl", ("cddl", "common development and distribution"), ("1 0", "1 1")),
    ("cpl", ("common public",), ("1 0",)),
    ("ipl", ("ibm public",), ("1 0",)),
    ("eupl", ("eupl", "european union public"), ("1 0", "1 1", "1 2")),
    ("isc", ("isc", "internet systems consortium"), ()),
    ("zlib", ("zlib", "zlib libpng"), ()),
    ("libpng", ("libpng",), ("2 0",)),
    ("boost", ("boost software", "bsl"), ("1 0",)),
    ("artistic", ("artistic", "perl artistic", "clarified artistic"), ("1 0", "2 0")),
    ("python", ("python software foundation", "psf", "python"), ("2", "2 0")),
    ("ruby", ("ruby",), ()),
    ("php", ("php",), ("3 0", "3 01")),
    ("openssl", ("openssl", "ssleay"), ()),
    ("wtfpl", ("wtfpl", "do what the fuck you want to public"), ("2",)),
    ("unlicense", ("the unlicense",), ()),
    ("beerware", ("beerware", "beer ware"), ("42",)),
    ("w3c", ("w3c", "w3c software"), ()),
    ("ofl", ("ofl", "sil open font", "open font"), ("1 0", "1 1")),
    ("osl", ("open software",), ("1 0", "2 0", "2 1", "3 0")),
    ("afl", ("academic free",), ("1 1", "2 0", "2 1", "3 0")),
    ("ecl", ("educational community",), ("1 0", "2 0")),
    ("ms-pl", ("ms pl", "microsoft public"), ()),
    ("ms-rl", ("ms rl", "microsoft reciprocal"), ()),
    ("odbl", ("odbl", "open database"), ("1 0",)),
    ("odc-by", ("odc by", "open data commons attribution"), ("1 0",)),
    ("pddl", ("pddl", "open data commons public domain dedication and"), ("1 0",)),
    ("upl", ("universal permissive",), ("1 0",)),
    ("ncsa", ("ncsa", "university of illinois ncsa open source"), ()),
    ("postgresql", ("postgresql",), ()),
    ("vim", ("vim",), ()),
    ("ijg", ("independent jpeg group",), ()),
    ("tcl", ("tcl tk", "tcl"), ()),
    ("curl", ("curl",), ()),
    ("x11", ("x11", "x consortium"), ()),
    ("zope", ("zope public", "zpl"), ("1 1", "2 0", "2 1")),
    ("sleepycat", ("sleepycat",), ()),
    ("apsl", ("apple public source",), ("1 0", "1 1", "1 2", "2 0")),
    ("lppl", ("lppl", "latex project public"), ("1 0", "1 2", "1 3")),
    ("intel", ("intel open source",), ()),
    ("nasa", ("nasa open source agreement",), ("1 3",)),
    ("mulan", ("mulan permissive software", "mulan psl"), ("1", "2")),
    ("cecill", ("cecill", "cecill b", "cecill c"), ("1 0", "1 1", "2 0", "2 1")),
    ("sspl", ("sspl", "server side public"), ("1",)),
    ("busl", ("business source",), ("1 1",)),
    ("elastic", ("elastic",), ("2", "2 0")),
    ("polyform", ("polyform noncommercial", "polyform small business"), ("1 0 0",)),
    ("openrail", ("openrail", "openrail m", "bigscience openrail m"), ()),
    ("blueoak", ("blue oak model",), ("1 0 0",)),
)

#: Creative Commons elements: code, words.
CC = (
    ("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("by-nc", "attribution non ?commercial"), ("by-nc-sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
)

#: Signatures of license texts and notices: label, pattern, literals it needs, priority, weight.
TEXTS = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", ("permission is hereby granted",), 95, .98),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies", ("this permission notice",), 90, .9),
    ("isc", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy",), 95, .98),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use",), 95, .98),
    ("bsd-3-clause", r"neither the names? of .{1,120}? nor the names of its contributors may be used to endorse", ("used to endorse",), 92, .9),
    ("apache-2-0", r"you may not use this file except in compliance with the license", ("in compliance with the license",), 95, .95),
    ("apache-2-0", r"www apache org licenses license 2 0", ("apache org licenses",), 96, .98),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", ("this program is free software",), 95, .98),
    ("gpl", r"either version \d(?: of the license)? or at your option any later version", ("any later version",), 85, .8),
    ("gpl", r"you should have received a copy of the gnu general public license", ("received a copy of the gnu general",), 93, .95),
    ("lgpl", r"you should have received a copy of the gnu (?:lesser|library) general public license", ("received a copy of the gnu l",), 93, .95),
    ("agpl", r"you should have received a copy of the gnu affero general public license", ("received a copy of the gnu affero",), 93, .95),
    ("mpl-2-0", r"subject to the terms of the mozilla public license v(?:ersion)? ?2 0", ("terms of the mozilla",), 95, .98),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", ("provided as is without any express",), 90, .9),
    ("boost", r"permission is hereby granted free of charge to any person or organization obtaining a copy", ("person or organization obtaining",), 95, .98),
    ("unlicense", r"this is free and unencumbered software released into the public domain", ("free and unencumbered",), 95, .98),
    ("cc0", r"cc0(?: 1 0)?(?: universal)?", ("cc0",), 70, .8),
    ("cc0", r"creative commons (?:zero|0)(?: 1 0)?(?: universal)?", ("creative commons",), 70, .8),
    ("cc0", r"cc zero(?: 1 0)?(?: universal)?", ("cc zero",), 70, .8),
    ("cc0", r"creative commons (?:cc0|zero)", ("creative commons",), 75, .9),
    ("public-domain", r"(?:released|dedicated|placed|is) (?:in|into|to) the public domain", ("the public domain",), 70, .8),
    ("public-domain", r"public domain(?: dedication| mark)?", ("public domain",), 30, .4),
    ("proprietary", r"all rights reserved", ("all rights reserved",), 20, .3),
    ("proprietary", r"(?:proprietary and confidential|confidential and proprietary)", ("proprietary",), 60, .7),
    ("proprietary", r"(?:unauthorized|unauthorised) (?:copying|use|reproduction|distribution)(?: or \w+)? (?:of this \w+ )?is (?:strictly )?prohibited", ("prohibited",), 60, .7),
    ("proprietary", r"may not be (?:reproduced|copied|redistributed|republished)(?: \w+){0,8} without (?:the )?(?:prior )?(?:express )?(?:written )?(?:permission|consent)", ("may not be", "without"), 60, .7),
    ("copyright", r"copyright(?: c)?(?: by)? (?:19|20)\d\d(?: (?:19|20)\d\d)?(?: [^ ]+){0,4}", ("copyright",), 25, .3),
    ("copyright", r"copyright (?:notice|holders?|owners?)", ("copyright",), 15, .2),
    ("warranty-disclaimer", r"without warrant(?:y|ies)(?: or conditions)? of any kind", ("without warrant",), 40, .4),
    ("warranty-disclaimer", r"the software is provided as is", ("software is provided as is",), 45, .5),
    ("open-source", r"(?:free and )?open source (?:software )?licen[sc]e", ("open source",), 30, .4),
    ("dual", r"dual(?:ly)? licen[sc]ed(?: under)?", ("dual",), 50, .6),
    ("license-notice", r"see (?:the )?licen[sc]e(?: file| txt| md)?(?: for (?:more )?details)?", ("see ",), 20, .2),
)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    literals: tuple[str, ...]
    priority: int
    weight: float


def build_rules() -> list[Rule]:
    """All rules, highest priority first."""
    out: list[Rule] = []

    def add(label, pattern, literals, priority, weight):
        out.append(Rule(label, re.compile(rf"(?<= ){pattern}(?= )"), tuple(literals), priority, weight))

    for label, pattern, literals, priority, weight in TEXTS:
        add(label, pattern, literals, priority, weight)
    for label, sentences in SIGNATURES.items():
        for sentence in sentences:
            pattern, literal = pattern_and_literal(sentence)
            add(label, pattern, (literal,), 91, .9)
    for label, names, versions in NAMES:
        for name in names:
            word = re.escape(name).replace(r"\ ", " ")
            add(label, rf"(?:released|licen[sc]ed|distributed|available|published|provided|covered)(?: \w+)? under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{word}(?: licen[sc]e)?",
                (f" {name} ", " under "), 60, .85)
            add(label, rf"{word} licen[sc]e", (f" {name} licen",), 40, .6)
            for v in versions:
                add(f"{label}-{v.replace(' ', '-')}", rf"{word}(?: licen[sc]e)?(?: v| version)? v?{v}(?: or later)?", (f" {name} ", v), 70, .85)
        tag = label.replace("-", " ")
        add(label, rf"spdx license identifier {tag}(?: \d)*(?: only| or later)?", (" spdx license identifier", tag), 99, .99)
        add(label, rf"licen[sc]e {tag}", (f" {tag} ", " licen"), 35, .5) if label not in ("python", "ruby", "vim", "elastic") else None
    for code, words in CC:
        short = code.replace("-", " ")
        add(f"cc-{code}", rf"creative commons {words}(?: (?:\d(?: \d)?))?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)?", ("creative commons",), 72 + len(code), .9)
        add(f"cc-{code}", rf"cc {short}(?: \d(?: \d)?)?", (f" cc {short}",), 65 + len(code), .8)
        add(f"cc-{code}", rf"creativecommons org licenses {short}(?: \d(?: \d)?)?", ("creativecommons org licenses",), 80 + len(code), .95)
    return sorted(out, key=lambda r: (-r.priority, r.label, r.pattern.pattern))


class Scanner:
    """Keyword automaton, rules and suppression over one text."""

    def __init__(self, rules: list[Rule] | None = None):
        import ahocorasick
        self.rules = build_rules() if rules is None else rules
        self.literals = sorted({x for r in self.rules for x in r.literals})
        at = {x: i for i, x in enumerate(self.literals)}
        self.needs = [frozenset(at[x] for x in r.literals) for r in self.rules]
        self.rare = {}                           # literal -> rules that it can wake
        for i, need in enumerate(self.needs):
            self.rare.setdefault(max(need, key=lambda k: len(self.literals[k])), []).append(i)
        self.automaton = ahocorasick.Automaton()
        for x, i in at.items():
            self.automaton.add_word(x, i)
        self.automaton.make_automaton()

    def detections(self, line: str) -> list[tuple[int, int, Rule]]:
        """Kept detections (start, end, rule) in a normalised line that starts and ends with a space."""
        present = {i for _, i in self.automaton.iter(line)}
        if not present:
            return []
        woken = sorted(i for k in present for i in self.rare.get(k, ()) if self.needs[i] <= present)
        found = [(m.start(), m.end(), self.rules[i]) for i in woken for m in self.rules[i].pattern.finditer(line)]
        found.sort(key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label))
        kept: list[tuple[int, int, Rule]] = []
        reach = Cover()
        for a, b, rule in found:
            if not reach.holds(a, b):
                kept.append((a, b, rule))
                reach.add(a, b)
        return sorted(kept, key=lambda d: (d[0], d[1], d[2].label))

    def scan(self, text: str | None) -> dict:
        words = words_of(text)
        line = (b" " + b" ".join(words) + b" ").decode("latin-1")
        out = {"n_words": len(words), "n_base": 0, "first_word": None, "last_word": None, "base_labels": "",
               "labels": "", "score": 0.0, "found": []}
        kept = self.detections(line)
        base = []
        if "license" in line:
            for phrase, label in BASE:
                at = line.find(f" {phrase} ")
                while at >= 0:
                    base.append((at, label))
                    at = line.find(f" {phrase} ", at + 1)
        if not kept and not base:
            return out
        starts = np.cumsum([0] + [len(w) + 1 for w in words])
        word = lambda at: int(np.searchsorted(starts, at))
        if base:
            places = [word(at) for at, _ in base]
            out |= {"n_base": len(base), "first_word": min(places), "last_word": max(places),
                    "base_labels": ",".join(sorted({x for _, x in base}))}
        best: dict[str, float] = {}
        for _, label in base:
            best[label] = max(best.get(label, 0), .6)
        for _, _, rule in kept:
            best[rule.label] = max(best.get(rule.label, 0), rule.weight)
        out["labels"] = ",".join(sorted(best))
        out["score"] = float(1 - np.prod([1 - w for w in best.values()]))
        out["found"] = [{"label": r.label, "first": word(a - 1), "after": word(b), "priority": r.priority} for a, b, r in kept]
        return out


class Cover:
    """Intervals kept so far; ``holds`` tells whether one of them contains another interval."""

    def __init__(self):
        self.starts: list[int] = []
        self.reach: list[int] = []               # largest end of the intervals up to each start

    def holds(self, a: int, b: int) -> bool:
        from bisect import bisect_right
        i = bisect_right(self.starts, a)
        return i > 0 and self.reach[i - 1] >= b

    def add(self, a: int, b: int) -> None:
        from bisect import bisect_right
        i = bisect_right(self.starts, a)
        if i and self.reach[i - 1] >= b:
            return
        j = i
        while j < len(self.starts) and self.reach[j] <= b:
            j += 1
        # starts whose reach is not larger than b now reach b
        self.starts[i:j] = [a]
        self.reach[i:j] = [b]


_FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
           T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
           T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
           T.StructField("score", T.DoubleType()),
           T.StructField("found", T.ArrayType(T.StructType([
               T.StructField("label", T.StringType()), T.StructField("first", T.LongType()),
               T.StructField("after", T.LongType()), T.StructField("priority", T.LongType())])))]
_ARROW = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
          "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(),
          "found": pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("after", pa.int64()), ("priority", pa.int64())]))}
_SCANNER: list[Scanner] = []


def _scan(batches):
    if not _SCANNER:
        _SCANNER.append(Scanner())
    for batch in batches:
        rows = [_SCANNER[0].scan(t) for t in batch.column("text").to_pylist()]
        new = [pa.array([r[c] for r in rows], kind) for c, kind in _ARROW.items()]
        yield pa.record_batch([*batch.columns, *new], names=[*batch.schema.names, *_ARROW])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``docs`` (any columns, ``text`` among them) with the counts, labels, score and detections."""
    ship(docs.sparkSession)
    docs = docs.drop(*_ARROW)
    return docs.mapInArrow(_scan, T.StructType([*docs.schema.fields, *_FIELDS]))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
