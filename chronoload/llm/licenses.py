"""License scan: ordered signature rules behind a keyword prefilter, overlaps settled by priority and containment.

``RULES`` are over two hundred regular expressions, made from the rows of ``FAMILIES`` (a license's id, its hand-written
name, tag and address patterns) by ``_rules``, plus the notices of ``NOTICES``. A rule runs on a text only if one of its
keywords stands in it, white space folded to single spaces; every match holds one of them. Detections are settled in order of priority (lower first), then length, then place: a detection
whose interval lies inside a kept one is dropped.

The base phrases are found on words, the rules on the lower-cased text as UTF-8 bytes; a detection's place is counted
in bytes there.

Defined results: a null or empty text has no words, no label and score 0; a place of a phrase counts each time; repeated
rows are scanned each; texts are scanned whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from chronoload.llm.common import LOWER, WORDS, keyed_texts, table, texts_of
from chronoload.session import prepare

PHRASES = {b"cc by": "cc-by", b"general public license": "gpl", b"all rights reserved": "reserved"}


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[bytes, ...]
    pattern: str
    priority: int
    score: float


# id | keywords of its name, one for each alternative | name | tag (as after SPDX-License-Identifier) | address
FAMILIES = r"""
mit | mit, expat | (?:the )?(?:mit|expat) licen[cs]e | mit | opensource\.org/licenses?/mit
mit-0 | mit | mit no attribution(?: licen[cs]e)? | mit-0 | github\.com/aws/mit-0
x11 | x11 | x11 licen[cs]e | x11 | xfree86\.org/[\w./]*copyright
isc | isc | (?:the )?isc licen[cs]e | isc | opensource\.org/licenses?/isc
0bsd | bsd | (?:bsd zero clause|zero[- ]clause bsd) licen[cs]e | 0bsd | opensource\.org/licenses?/0bsd
bsd-2-clause | bsd | (?:bsd[- ]2[- ]clause|(?:2|two)[- ]clause bsd|simplified bsd|freebsd) licen[cs]e | bsd-2-clause | opensource\.org/licenses?/bsd-2-clause
bsd-3-clause | bsd | (?:bsd[- ]3[- ]clause|(?:3|three)[- ]clause bsd|(?:new|modified|revised) bsd) licen[cs]e | bsd-3-clause | opensource\.org/licenses?/bsd-3-clause
bsd-4-clause | bsd | (?:bsd[- ]4[- ]clause|(?:4|four)[- ]clause bsd|original bsd) licen[cs]e | bsd-4-clause | directory\.fsf\.org/wiki/license:bsd[-_]4clause
apache-1.1 | apache | apache (?:software )?licen[cs]e,?\s+(?:version |v\.?\s?)?1\.1 | apache-1\.1 | apache\.org/licenses/license-1\.1
apache-2.0 | apache | apache (?:software )?licen[cs]e,?\s+(?:version |vers\.? ?|v\.?\s?)?2(?:\.0)? | apache-2\.0 | apache\.org/licenses/license-2\.0
gpl-1.0 | gnu | gnu (?:gpl|general public licen[cs]e),?\s+(?:version |v\.?\s?)1(?:\.0)? | gpl-1\.0(?:-only|-or-later|\+)? | gnu\.org/licenses/(?:old-licenses/)?gpl-1\.0
gpl-2.0 | gnu | gnu (?:gpl|general public licen[cs]e),?\s+(?:version |v\.?\s?)2(?:\.0)? | gpl-2\.0(?:-only|-or-later|\+)? | gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0
gpl-3.0 | gnu | gnu (?:gpl|general public licen[cs]e),?\s+(?:version |v\.?\s?)3(?:\.0)? | gpl-3\.0(?:-only|-or-later|\+)? | gnu\.org/licenses/gpl-3\.0
lgpl-2.0 | gnu | gnu (?:lgpl|library general public licen[cs]e),?\s+(?:version |v\.?\s?)2(?:\.0)? | lgpl-2\.0(?:-only|-or-later|\+)? | gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.0
lgpl-2.1 | gnu | gnu (?:lgpl|lesser general public licen[cs]e),?\s+(?:version |v\.?\s?)2\.1 | lgpl-2\.1(?:-only|-or-later|\+)? | gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1
lgpl-3.0 | gnu | gnu (?:lgpl|lesser general public licen[cs]e),?\s+(?:version |v\.?\s?)3(?:\.0)? | lgpl-3\.0(?:-only|-or-later|\+)? | gnu\.org/licenses/lgpl-3\.0
agpl-3.0 | gnu | gnu (?:agpl|affero general public licen[cs]e),?\s+(?:version |v\.?\s?)3(?:\.0)? | agpl-3\.0(?:-only|-or-later|\+)? | gnu\.org/licenses/agpl-3\.0
gfdl-1.3 | gnu | gnu free documentation licen[cs]e,?\s+(?:version |v\.?\s?)1\.3 | gfdl-1\.3(?:-only|-or-later)? | gnu\.org/licenses/fdl-1\.3
mpl-1.1 | mozilla | mozilla public licen[cs]e,?\s+(?:version |v\.?\s?)1\.1 | mpl-1\.1 | mozilla\.org/mpl/(?:mpl-1\.1|1\.1)
mpl-2.0 | mozilla | mozilla public licen[cs]e,?\s+(?:version |v\.?\s?)2(?:\.0)? | mpl-2\.0 | mozilla\.org/(?:en-us/)?mpl/2\.0
epl-1.0 | eclipse | eclipse public licen[cs]e,?\s+(?:- |version |v\.?\s?)*1(?:\.0)? | epl-1\.0 | eclipse\.org/legal/epl-v10
epl-2.0 | eclipse | eclipse public licen[cs]e,?\s+(?:- |version |v\.?\s?)*2(?:\.0)? | epl-2\.0 | eclipse\.org/legal/epl-(?:2\.0|v20)
cddl-1.0 | distribution | common development and distribution licen[cs]e(?:,?\s+(?:version |v\.?\s?)?1\.0)? | cddl-1\.0 | opensource\.org/licenses?/cddl-1\.0
cddl-1.1 | distribution | common development and distribution licen[cs]e,?\s+(?:version |v\.?\s?)?1\.1 | cddl-1\.1 | glassfish\.java\.net/public/cddl
cpl-1.0 | common public | common public licen[cs]e(?:,?\s+(?:version |v\.?\s?)?1\.0)? | cpl-1\.0 | opensource\.org/licenses?/cpl1\.0
artistic-1.0 | artistic | artistic licen[cs]e(?:,?\s+(?:version |v\.?\s?)?1(?:\.0)?) | artistic-1\.0(?:-perl|-cl8)? | opensource\.org/licenses?/artistic-1\.0
artistic-2.0 | artistic | artistic licen[cs]e,?\s+(?:version |v\.?\s?)?2(?:\.0)? | artistic-2\.0 | opensource\.org/licenses?/artistic-2\.0
bsl-1.0 | boost | boost software licen[cs]e(?:,?\s+(?:- |version |v\.?\s?)*1(?:\.0)?)? | bsl-1\.0 | boost\.org/license_1_0
busl-1.1 | business | business source licen[cs]e(?:,?\s+(?:version |v\.?\s?)?1\.1)? | busl-1\.1 | mariadb\.com/bsl11
sspl-1.0 | server side | server side public licen[cs]e(?:,?\s+(?:version |v\.?\s?)?1)? | sspl-1\.0 | mongodb\.com/licensing/server-side-public-license
elastic-2.0 | elastic | elastic licen[cs]e,?\s+(?:version |v\.?\s?)?2(?:\.0)? | elastic-2\.0 | elastic\.co/licensing/elastic-license
zlib | zlib | zlib(?:/libpng)? licen[cs]e | zlib | zlib\.net/zlib_license
libpng-2.0 | libpng, png reference | (?:png reference library|libpng) licen[cs]e(?:,?\s+version 2)? | libpng-2\.0 | libpng\.org/pub/png/src/libpng-license
unlicense | unlicen | the unlicen[cs]e | unlicense | unlicense\.org
wtfpl | what the | do what the f\S+ you want to public licen[cs]e | wtfpl | wtfpl\.net
cc0-1.0 | cc0 | (?:creative commons )?cc0(?:[- ]1\.0)?(?: universal)? | cc0-1\.0 | creativecommons\.org/publicdomain/zero
cc-by-2.0 | creative | creative commons attribution 2\.0 | cc-by-2\.0 | creativecommons\.org/licenses/by/2\.0
cc-by-2.5 | creative | creative commons attribution 2\.5 | cc-by-2\.5 | creativecommons\.org/licenses/by/2\.5
cc-by-3.0 | creative | creative commons attribution 3\.0 | cc-by-3\.0 | creativecommons\.org/licenses/by/3\.0
cc-by-4.0 | creative | creative commons attribution 4\.0 | cc-by-4\.0 | creativecommons\.org/licenses/by/4\.0
cc-by-sa-3.0 | creative | creative commons attribution[- ]share[- ]?alike 3\.0 | cc-by-sa-3\.0 | creativecommons\.org/licenses/by-sa/3\.0
cc-by-sa-4.0 | creative | creative commons attribution[- ]share[- ]?alike 4\.0 | cc-by-sa-4\.0 | creativecommons\.org/licenses/by-sa/4\.0
cc-by-nd-4.0 | creative | creative commons attribution[- ]no[- ]?deriv(?:ative|atives|s)? 4\.0 | cc-by-nd-4\.0 | creativecommons\.org/licenses/by-nd/4\.0
cc-by-nc-4.0 | creative | creative commons attribution[- ]non[- ]?commercial 4\.0 | cc-by-nc-4\.0 | creativecommons\.org/licenses/by-nc/4\.0
cc-by-nc-sa-4.0 | creative | creative commons attribution[- ]non[- ]?commercial[- ]share[- ]?alike 4\.0 | cc-by-nc-sa-4\.0 | creativecommons\.org/licenses/by-nc-sa/4\.0
cc-by-nc-nd-4.0 | creative | creative commons attribution[- ]non[- ]?commercial[- ]no[- ]?deriv(?:ative|atives|s)? 4\.0 | cc-by-nc-nd-4\.0 | creativecommons\.org/licenses/by-nc-nd/4\.0
pddl-1.0 | public domain dedication | (?:odc )?public domain dedication (?:and|&) licen[cs]e | pddl-1\.0 | opendatacommons\.org/licenses/pddl
odbl-1.0 | open database | open database licen[cs]e(?: \(odbl\))? | odbl-1\.0 | opendatacommons\.org/licenses/odbl
odc-by-1.0 | open data | open data commons attribution licen[cs]e | odc-by-1\.0 | opendatacommons\.org/licenses/by
ofl-1.1 | open font | (?:sil )?open font licen[cs]e(?:,?\s+(?:version |v\.?\s?)?1\.1)? | ofl-1\.1 | scripts\.sil\.org/ofl
psf-2.0 | python | python software foundation licen[cs]e(?:,?\s+(?:version |v\.?\s?)?2)? | psf-2\.0 | docs\.python\.org/[\w./]*license
ruby | ruby | ruby licen[cs]e | ruby | ruby-lang\.org/[\w./]*license
php-3.01 | php | php licen[cs]e,?\s+(?:version |v\.?\s?)?3\.01 | php-3\.01 | php\.net/license/3_01
postgresql | postgresql | postgresql licen[cs]e | postgresql | opensource\.org/licenses?/postgresql
openssl | openssl | openssl licen[cs]e | openssl | openssl\.org/source/license
ncsa | ncsa | (?:university of illinois/)?ncsa open source licen[cs]e | ncsa | opensource\.org/licenses?/ncsa
ms-pl | microsoft | microsoft public licen[cs]e | ms-pl | opensource\.org/licenses?/ms-pl
ms-rl | microsoft | microsoft reciprocal licen[cs]e | ms-rl | opensource\.org/licenses?/ms-rl
eupl-1.2 | european union | european union public licen[cs]e(?:,?\s+(?:version |v\.?\s?)?1\.2)? | eupl-1\.2 | joinup\.ec\.europa\.eu/[\w./]*eupl
cecill-2.1 | cecill | cecill(?: free software)? licen[cs]e(?: agreement)?(?:,?\s+(?:version |v\.?\s?)?2\.1)? | cecill-2\.1 | cecill\.info/licences
osl-3.0 | open software | open software licen[cs]e(?:,?\s+(?:version |v\.?\s?)?3\.0)? | osl-3\.0 | opensource\.org/licenses?/osl-3\.0
afl-3.0 | academic free | academic free licen[cs]e(?:,?\s+(?:version |v\.?\s?)?3\.0)? | afl-3\.0 | opensource\.org/licenses?/afl-3\.0
upl-1.0 | universal permissive | universal permissive licen[cs]e(?:,?\s+(?:version |v\.?\s?)?1\.0)? | upl-1\.0 | oss\.oracle\.com/licenses/upl
vim | vim | vim licen[cs]e | vim | vimhelp\.org/uganda
beerware | beer | beer-?ware licen[cs]e | beerware | people\.freebsd\.org/~phk
""".strip()

# label | keywords | pattern | priority | score
NOTICES = r"""
mit | permission is hereby granted | permission is hereby granted, free of charge, to any person obtaining a copy | 2 | 0.95
isc | permission to use | permission to use, copy, modify, and(?:/or)? distribute this software for any purpose | 2 | 0.9
bsd | redistribution and use | redistribution and use in source and binary forms, with or without\s+modification,? are permitted | 2 | 0.9
apache-2.0 | you may not use this file | you may not use this file except in compliance with the licen[cs]e | 2 | 0.9
gpl-notice | free software | this program is free software[;:,] you can redistribute it and/or modify | 2 | 0.9
lgpl-notice | free software | this library is free software[;:,] you can redistribute it and/or modify | 2 | 0.9
mpl-2.0 | source code form | this source code form is subject to the terms of the mozilla public licen[cs]e | 1 | 0.95
unlicense | unencumbered | this is free and unencumbered software released into the public domain | 1 | 0.95
bsl-1.0 | boost | distributed under the boost software licen[cs]e | 1 | 0.95
zlib | as-is | this software is provided 'as-is', without any express or implied warranty | 2 | 0.8
apache | apache | (?:under the )?apache licen[cs]e | 6 | 0.7
bsd | bsd | bsd licen[cs]e | 6 | 0.7
gpl | gnu | gnu general public licen[cs]e | 6 | 0.7
lgpl | gnu | gnu (?:lesser|library) general public licen[cs]e | 6 | 0.7
agpl | gnu | gnu affero general public licen[cs]e | 6 | 0.7
mpl | mozilla | mozilla public licen[cs]e | 6 | 0.7
creative-commons | creative | creative commons(?: attribution)?(?: licen[cs]e)? | 7 | 0.6
cc-by | cc | \bcc[- ]by(?:[- ](?:sa|nd|nc|nc-sa|nc-nd))?(?:[- ][1-4]\.[05])?\b | 5 | 0.7
public-domain | public domain | (?:released |dedicated |placed )?(?:into|to|in) the public domain | 6 | 0.6
warranty-disclaimer | warrant | without warrant(?:y|ies) (?:of any kind|or conditions) | 8 | 0.4
proprietary | confidential | proprietary and confidential | 6 | 0.6
proprietary | unauthori | unauthori[sz]ed (?:copying|reproduction|distribution) (?:of this \w+ )?is (?:strictly )?prohibited | 6 | 0.6
copyright-notice | copyright | copyright (?:\(c\)|©|\xc2\xa9)?\s*(?:19|20)\d\d | 8 | 0.3
copyright-notice | © | © ?(?:19|20)\d\d | 8 | 0.3
copyright-notice | (c) | \(c\) (?:19|20)\d\d | 8 | 0.3
all-rights-reserved | all rights | all rights reserved | 9 | 0.3
spdx-other | spdx- | spdx-licen[cs]e-identifier:\s*[\w.+() -]{2,60} | 9 | 0.5
license-grant | licensed under | licensed under the (?:terms of the )?[\w .-]{1,40}licen[cs]e | 9 | 0.4
""".strip()


def _rules() -> list[Rule]:
    """Four rules a family: its tag, its address, its name in a grant, and its name alone; then the notices."""
    out = []
    for row in FAMILIES.splitlines():
        label, keyword, name, tag, address = (x.strip() for x in row.split(" | "))
        keywords = tuple(keyword.encode().split(b", "))
        out += [
            Rule(label, (b"spdx-",), rf"spdx-licen[cs]e-identifier:\s*(?:\(\s*)?{tag}(?![\w.+-])", 0, 1.0),
            Rule(label, (re.match(r"[a-z0-9-]+", address)[0].encode(),), rf"(?:https?://)?(?:www\.)?{address}", 1, 0.95),
            Rule(label, keywords, rf"(?:licen[cs]ed|released|distributed|available|provided)\s+under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?{name}", 3, 0.9),
            Rule(label, keywords, rf"\b{name}", 4, 0.8),
        ]
    for row in NOTICES.splitlines():
        label, keyword, pattern, priority, score = (x.strip() for x in row.split(" | "))
        out.append(Rule(label, tuple(keyword.encode().split(b", ")), pattern, int(priority), float(score)))
    return out


RULES = _rules()


@lru_cache(maxsize=1)
def _compiled() -> dict[tuple[bytes, ...], list[tuple[int, re.Pattern]]]:
    by: dict[tuple[bytes, ...], list] = {}
    for k, rule in enumerate(RULES):
        spaced = re.sub(r"(?<!\\|\[) (?![^\[]*\])", r"\\s+", rule.pattern)
        by.setdefault(rule.keywords, []).append((k, re.compile(spaced.encode())))
    return by


def settled(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, rule) without those that lie inside one of higher standing: priority, then length, then place."""
    order = sorted(found, key=lambda f: (RULES[f[2]].priority, f[0] - f[1], f[0], f[2]))
    kept: list[tuple[int, int, int]] = []
    starts: list[int] = []  # kept intervals that lie in no other kept one: starts and ends both ascend
    ends: list[int] = []
    for f in order:
        at = bisect_right(starts, f[0])
        if at and ends[at - 1] >= f[1]:
            continue
        lo, hi = bisect_left(starts, f[0]), bisect_right(ends, f[1])
        starts[lo : max(lo, hi)], ends[lo : max(lo, hi)] = [f[0]], [f[1]]
        kept.append(f)
    return sorted(kept)


def detections(text: bytes) -> list[tuple[int, int, int]]:
    """Settled detections of a lower-cased text."""
    found = []
    folded = b" ".join(text.split())
    for keywords, rules in _compiled().items():
        if any(k in folded for k in keywords):
            for k, pattern in rules:
                found += [(m.start(), m.end(), k) for m in pattern.finditer(text)]
    return settled(found) if found else []


def phrase_places(words: list[bytes]) -> list[tuple[int, bytes]]:
    """(word number, phrase) of every place, by number."""
    line = b" " + b" ".join(words) + b" "
    out = []
    for phrase in PHRASES:
        needle = b" " + phrase + b" "
        at, word, last = line.find(needle), 0, 0
        while at >= 0:
            word += line.count(b" ", last, at)
            last = at
            out.append((word, phrase))
            at = line.find(needle, at + 1)
    return sorted(out)


def scan(text: bytes | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    if not text:
        return 0, 0, None, None, "", "", 0.0
    words = text.translate(WORDS).split()
    lower = text.translate(LOWER)
    places = phrase_places(words) if b"cc" in lower or b"public" in lower or b"reserved" in lower else []
    base = {PHRASES[p] for _, p in places}
    found = {RULES[k] for _, _, k in detections(lower)}
    labels = base | {r.label for r in found}
    score = max([r.score for r in found] + [0.5] * bool(base), default=0.0)
    first, last = (places[0][0], places[-1][0]) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score


_FIELDS = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
           ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]


def license_report(docs: DataFrame) -> DataFrame:
    """One row per document: words, places of the base phrases, labels of phrases and of rules, and a score."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            columns = list(zip(*map(scan, texts_of(batch)), strict=True)) or [()] * 7
            arrays = [batch.column(0)] + [pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in _FIELDS])

    return keyed_texts(docs).mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string,"
             " labels string, score double")


def license_spans(docs: DataFrame) -> DataFrame:
    """Every settled detection: ``doc_id, label, rule, start, end, score``; places in bytes of the UTF-8 text."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            rows = [(i, RULES[k].label, k, a, b, RULES[k].score)
                    for i, t in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True) if t
                    for a, b, k in detections(t.translate(LOWER))]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                             names=["doc_id", "label", "rule", "start", "end", "score"])

    return keyed_texts(docs).mapInArrow(run, "doc_id long, label string, rule int, start long, end long, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))
