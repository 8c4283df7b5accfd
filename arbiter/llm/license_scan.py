"""License scan by ordered signature rules.

Two layers:

* base phrases: the places where the words of a short phrase stand one after
  the other (only words count, whatever stands between them);
* signature rules: hundreds of regular expressions, most written by hand
  (``license_rules``: notices, sentences of the licenses, names, short forms)
  and some by family (names with a version, Creative Commons kinds).  They are
  ordered: a smaller priority number is more specific.  A rule runs only on a
  text that holds all its key words, wherever they stand (prefilter, one
  Aho-Corasick pass; every match holds each of them as it is written), and
  a detection whose interval lies inside one that ranks before it (priority,
  then length, then start) is suppressed.

In a license expression (``SPDX-License-Identifier: (MIT OR Apache-2.0)``)
every known identifier is a detection of its own; a ``+`` is ``-or-later``.

Defined results: a null text is empty: no words, no labels, score 0; repeated
rows are scanned one by one; extra columns are ignored.  One narrow pass.

``score`` is the share of the text's words that detections and base places
cover, raised to at least 0.5 when anything was found (a single license line
in a long text is still a license), at most 1.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbiter.llm import license_rules as LR
from arbiter.llm.common import lean, prepare

# The base phrases and their labels.
BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache",
                "cc by": "cc-by", "mit license": "mit"}

WORD_BYTE = np.ones(256, bool)
WORD_BYTE[:0x30] = WORD_BYTE[0x3A:0x61] = WORD_BYTE[0x7B:0x80] = False
_NON_WORD = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
_WORD = r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]"


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str  # one or more words, each a literal part of every match
    pattern: str
    group: str | int = 0  # what of the match is the detection


# Families: label stem, key words, names as regular expressions, versions.
FAMILIES = [
    ("gpl", "gnu", [r"gnu general public licen[cs]e", r"gnu gpl"], ["1.0", "2.0", "3.0"]),
    ("lgpl", "gnu", [r"gnu (?:lesser|library) general public licen[cs]e", r"gnu lgpl"], ["2.0", "2.1", "3.0"]),
    ("agpl", "gnu", [r"gnu affero general public licen[cs]e", r"gnu agpl"], ["3.0"]),
    ("gfdl", "gnu", [r"gnu free documentation licen[cs]e", r"gnu fdl"], ["1.1", "1.2", "1.3"]),
    ("apache", "apache", [r"apache(?: software)? licen[cs]e"], ["1.0", "1.1", "2.0"]),
    ("mpl", "mozilla", [r"mozilla public licen[cs]e"], ["1.0", "1.1", "2.0"]),
    ("epl", "eclipse", [r"eclipse public licen[cs]e"], ["1.0", "2.0"]),
    ("cddl", "common development", [r"common development and distribution licen[cs]e"], ["1.0", "1.1"]),
    ("eupl", "european union", [r"european union public licen[cs]e"], ["1.0", "1.1", "1.2"]),
    ("artistic", "artistic", [r"artistic licen[cs]e"], ["1.0", "2.0"]),
    ("osl", "open software", [r"open software licen[cs]e"], ["1.0", "2.0", "3.0"]),
    ("afl", "academic free", [r"academic free licen[cs]e"], ["2.0", "2.1", "3.0"]),
    ("lppl", "latex", [r"latex project public licen[cs]e"], ["1.2", "1.3"]),
    ("psf", "python software", [r"python software foundation licen[cs]e"], ["2.0"]),
    ("ofl", "open font", [r"sil open font licen[cs]e", r"open font licen[cs]e"], ["1.0", "1.1"]),
    ("bsl", "boost software", [r"boost software licen[cs]e"], ["1.0"]),
    ("zpl", "zope", [r"zope public licen[cs]e"], ["2.0", "2.1"]),
    ("odbl", "open database", [r"open (?:data commons open )?database licen[cs]e"], ["1.0"]),
]
# Creative Commons: long and short names of each kind, in all versions.
CC_KINDS = {"by": "attribution", "by-sa": "attribution share ?alike", "by-nc": "attribution non ?commercial",
            "by-nd": "attribution no ?deriv(?:ative)?s", "by-nc-sa": "attribution non ?commercial share ?alike",
            "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s"}
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
# Names and sentences that have no version: label, key words, expression.
PLAIN = [
    ("mit", "mit licen", r"(?:the )?mit licen[cs]e"),
    ("mit", "permission hereby granted", r"permission is hereby granted,? free of charge"),
    ("mit", "expat", r"expat licen[cs]e"),
    ("isc", "isc licen", r"isc licen[cs]e"),
    ("isc", "permission copy modify distribute", r"permission to use,? copy,? modify,? and(?:/or)? distribute this software"),
    ("bsd", "bsd", r"bsd licen[cs]e"),
    ("bsd-2-clause", "bsd", r"(?:2|two)-clause bsd licen[cs]e|simplified bsd licen[cs]e"),
    ("bsd-3-clause", "bsd", r"(?:3|three)-clause bsd licen[cs]e|(?:new|modified|revised) bsd licen[cs]e"),
    ("bsd-4-clause", "bsd", r"(?:4|four)-clause bsd licen[cs]e|original bsd licen[cs]e"),
    ("bsd", "redistribution source retain", r"redistributions? of source code must retain"),
    ("zlib", "zlib", r"zlib(?:/libpng)? licen[cs]e"),
    ("unlicense", "unlicense", r"(?:the )?unlicense\b"),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", r"(?:released |dedicated )?(?:in)?to the public domain"),
    ("wtfpl", "what want public", r"do what the f\w+ you want to public licen[cs]e"),
    ("cc0-1.0", "cc0", r"cc0(?: 1\.0)?(?: universal)?"),
    ("proprietary", "all rights reserved", r"all rights reserved"),
    ("proprietary", "proprietary", r"proprietary (?:and confidential|licen[cs]e)"),
    ("copyright-notice", "copyright", r"copyright (?:\(c\) |© )?(?:19|20)\d\d"),
]
# Labels that are no license.
NO_LICENSE = {"proprietary", "copyright-notice", "public-domain", "commons-clause"}
# What may stand before an identifier in its expression, on one line.
EXPRESSION = r"spdx-license-identifier:[ \t]*(?:[ \t(]*[\w.+-]+[ \t)]+(?:or|and|with)[ \t]+)*[ \t(]*"


def build_rules() -> list[Rule]:
    """All signature rules, most specific first: identifier lines, names with
    a version, creative-commons kinds with and without one, bare names."""
    rules = []
    joined = lambda name: name.replace(" ?", r"\s*").replace(" ", r"\s+")  # noqa: E731 - lines may break in a name
    for stem, key, names, versions in FAMILIES:
        for v in versions:
            number = re.escape(v.removesuffix(".0")) + (r"(?:\.0)?" if v.endswith(".0") else "") + r"(?![\d.]*\d)"
            for suffix, tail in (("-or-later", r"[\s,]+(?:or\s+(?:\(at\s+your\s+option\)\s+)?any\s+later|or\s+later)"),
                                 ("-only", r"[\s,]+only"), ("", "")):
                if suffix and stem not in ("gpl", "lgpl", "agpl", "gfdl"):
                    continue
                for name in names:
                    rules.append(Rule(f"{stem}-{v}{suffix}", 1 if suffix else 2, key,
                                      rf"\b{joined(name)}[\s,(]*(?:version|v\.?)?\s*{number}{tail}"))
        for name in names:
            rules.append(Rule(stem, 5, key, rf"\b{joined(name)}"))
    for kind, long in CC_KINDS.items():
        short = kind.replace("-", r"[\s-]")
        for v in CC_VERSIONS:
            number = rf"\s*-?(?:version\s+|v)?{re.escape(v)}(?:\s+international|\s+unported)?"
            rules.append(Rule(f"cc-{kind}-{v}", 1, "cc", rf"\bcc[\s-]{short}{number}"))
            rules.append(Rule(f"cc-{kind}-{v}", 1, "creative commons",
                              rf"creative\s+commons\s+{long.replace(' ', '[ -]?')}{number}"))
            rules.append(Rule(f"cc-{kind}-{v}", 1, "creativecommons",
                              rf"creativecommons\.org/licen[cs]es/{kind}/{re.escape(v)}"))
        rules.append(Rule(f"cc-{kind}", 4, "cc", rf"\bcc[\s-]{short}\b"))
        rules.append(Rule(f"cc-{kind}", 4, "creative commons", rf"creative\s+commons\s+{long.replace(' ', '[ -]?')}\b"))
    for label, key, expression in PLAIN:
        rules.append(Rule(label, 3, key, rf"(?<!\w){joined(expression)}"))
    for priority, table in ((1, LR.NOTICES), (3, LR.SENTENCES), (3, LR.NAMES), (4, LR.SHORT)):
        rules += [Rule(label, priority, key, rf"(?<!\w)(?:{joined(expression)})") for label, key, expression in table]
    for label in sorted({r.label for r in rules} - NO_LICENSE | set(LR.MORE_IDENTIFIERS)):
        name = re.escape(label).removesuffix(r"\-or\-later") + (r"(?:\+|\-or\-later)" if label.endswith("-or-later") else "")
        rules.append(Rule(label, 0, "spdx-license-identifier", rf"{EXPRESSION}(?P<id>{name})(?![\w.+-])", "id"))
    return sorted(rules, key=lambda r: r.priority)


class Scanner:
    def __init__(self, phrases: dict[str, str] | None = None, rules: list[Rule] | None = None):
        import ahocorasick
        self.rules = [(r, frozenset(r.keyword.split()), re.compile(r.pattern))
                      for r in (build_rules() if rules is None else rules)]
        self.phrases = [(p.split()[0], label, len(p.split()),
                         re.compile(rf"(?<!{_WORD}){_NON_WORD.join(map(re.escape, p.split()))}(?!{_WORD})"))
                        for p, label in (phrases or BASE_PHRASES).items()]
        self.keys = ahocorasick.Automaton()
        for key in {key for _, keys, _ in self.rules for key in keys} | {first for first, *_ in self.phrases}:
            self.keys.add_word(key, key)
        self.keys.make_automaton()

    def places(self, text: str) -> list[tuple[str, int, int]]:
        """Base places as (label, start, end) characters of a lower-cased text."""
        found = []
        for first, label, _, pattern in self.phrases:
            if first in text:
                at = 0
                while m := pattern.search(text, at):
                    found.append((label, *m.span()))
                    at = m.start() + 1  # places may overlap
        return found

    def detections(self, text: str, present: set[str]) -> list[tuple[str, int, int]]:
        """Signature detections that no better one contains."""
        hits = [(r.priority, a - b, a, b, r.label)
                for r, keys, pattern in self.rules if keys <= present
                for m in pattern.finditer(text) for a, b in [m.span(r.group)]]
        kept: list[tuple[str, int, int]] = []
        starts: list[int] = []   # kept intervals by start; ends run with them
        ends: list[int] = []     # (none contains another, so both ascend)
        for _, _, a, b, label in sorted(hits):
            i = bisect.bisect_right(starts, a)
            if i and ends[i - 1] >= b:
                continue
            while i < len(starts) and ends[i] <= b:  # a wider one of lower rank keeps its own
                i += 1
            kept.append((label, a, b))
            j = bisect.bisect_right(starts, a)
            starts[j:i], ends[j:i] = [a], [b]
        return kept

    def scan(self, text: str) -> tuple:
        low = text.translate(_LOWER)
        raw = np.frombuffer(low.encode(), np.uint8)
        word = WORD_BYTE[raw]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        n_words = int(np.count_nonzero(begins))
        present = {key for _, key in self.keys.iter(low)}
        if not present:
            return n_words, 0, None, None, "", "", 0.0, []
        places = self.places(low)
        found = self.detections(low, present)
        if not places and not found:
            return n_words, 0, None, None, "", "", 0.0, []
        # characters to word numbers, through the bytes before them
        spans = [(label, a, b) for label, a, b in places + found]
        cut = sorted({x for _, a, b in spans for x in (a, b)})
        at, byte, last = {}, 0, 0
        for c in cut:
            byte += len(low[last:c].encode())
            at[c], last = byte, c
        numbers = np.flatnonzero(begins)
        first_word = lambda c: int(np.searchsorted(numbers, at[c]))
        base = [first_word(a) for _, a, _ in places]
        covered: set[int] = set()
        for _, a, b in spans:
            covered.update(range(first_word(a), max(first_word(a) + 1, first_word(b))))
        base_labels = {label for label, _, _ in places}
        labels = base_labels | {label for label, _, _ in found}
        score = min(1.0, max(0.5, len(covered) / max(1, n_words)))
        return (n_words, len(base), min(base, default=None), max(base, default=None),
                ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, found)


_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
          "base_labels string, labels string, score double")


def scan_licenses(docs: DataFrame, phrases: dict[str, str] | None = None,
                  rules: list[Rule] | None = None, with_spans: bool = False) -> DataFrame:
    """One row per document; ``with_spans`` adds ``detections``: label and
    character interval (of the text) of each signature detection."""
    prepare(docs.sparkSession)
    schema = RESULT + (", detections array<struct<label:string,begin:int,end:int>>" if with_spans else "")
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
    if with_spans:
        types.append(pa.list_(pa.struct([("label", pa.string()), ("begin", pa.int32()), ("end", pa.int32())])))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, rules)
        for batch in batches:
            rows = [(doc, *scanner.scan(text.as_py() or ""))
                    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1))]
            cols = list(zip(*rows)) or [()] * 9
            if with_spans:
                cols[8] = [[dict(zip(("label", "begin", "end"), d)) for d in ds] for ds in cols[8]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names[:len(types)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(scan), schema)
