"""Licences in documents by sentence rules.

As in sentence-based identification (German, Manabe, Inoue 2010): a text is cut into
sentences, each is normalised and mapped to the identifier of a known licence sentence, and
the document's sequence of identifiers is matched against ordered rules, each a sequence
that makes a licence. An earlier rule takes its sentences before a later one sees them, so
a longer text is not also counted as the shorter one it contains. Known sentences that no
rule takes are reported as ``incomplete``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Unknown sentences that may stand between two sentences of one rule.
GAP = 2

# Names of licences, normalised, and what they stand for.
NAMES = {
    "mit": "MIT",
    "x11": "X11",
    "isc": "ISC",
    "bsd 2 clause": "BSD-2-Clause",
    "simplified bsd": "BSD-2-Clause",
    "bsd 3 clause": "BSD-3-Clause",
    "new bsd": "BSD-3-Clause",
    "apache 2.0": "Apache-2.0",
    "apache 2": "Apache-2.0",
    "gnu general public 3": "GPL-3.0",
    "gnu general public 2": "GPL-2.0",
    "gpl 3": "GPL-3.0",
    "gpl 2": "GPL-2.0",
    "gnu lesser general public 3": "LGPL-3.0",
    "gnu lesser general public 2.1": "LGPL-2.1",
    "lgpl 3": "LGPL-3.0",
    "lgpl 2.1": "LGPL-2.1",
    "gnu affero general public 3": "AGPL-3.0",
    "agpl 3": "AGPL-3.0",
    "mozilla public 2.0": "MPL-2.0",
    "mpl 2.0": "MPL-2.0",
    "eclipse public 2.0": "EPL-2.0",
    "boost software 1.0": "BSL-1.0",
    "zlib": "Zlib",
    "unlicense": "Unlicense",
    "cc0 1.0": "CC0-1.0",
    "cc by 4.0": "CC-BY-4.0",
    "cc by sa 4.0": "CC-BY-SA-4.0",
    "cc by nc 4.0": "CC-BY-NC-4.0",
    "cc by nd 4.0": "CC-BY-ND-4.0",
    "cc by nc sa 4.0": "CC-BY-NC-SA-4.0",
    "cc by nc nd 4.0": "CC-BY-NC-ND-4.0",
    "cc by 3.0": "CC-BY-3.0",
    "cc by sa 3.0": "CC-BY-SA-3.0",
    "creative commons attribution 4.0": "CC-BY-4.0",
    "creative commons attribution sharealike 4.0": "CC-BY-SA-4.0",
    "creative commons attribution noncommercial 4.0": "CC-BY-NC-4.0",
}

# Sentences of licence texts, and their identifiers. Names of organisations stand for {name}.
SENTENCES = {
    "permission_any": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
    "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions",
    "notice_included": "The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software",
    "as_is_software": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
    "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "no_liability_authors": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
    "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
    "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "permission_fee": "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted, provided that the above copyright notice and this permission notice appear in "
    "all copies",
    "permission_fee_and": "Permission to use, copy, modify, and distribute this software for any purpose with or "
    "without fee is hereby granted, provided that the above copyright notice and this permission notice appear in "
    "all copies",
    "redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
    "source_retains": "Redistributions of source code must retain the above copyright notice, this list of conditions "
    "and the following disclaimer",
    "binary_reproduces": "Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution",
    "no_endorsement": "Neither the name of {name} nor the names of {name} contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission",
    "apache_2": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License",
    "apache_copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl_3_later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
    "your option) any later version",
    "gpl_2_later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at "
    "your option) any later version",
    "mpl_2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "public_domain": "This is free and unencumbered software released into the public domain",
}

# The rules in their order. A statement that names a licence is a rule by itself.
RULES = [
    ("MIT", ["permission_any", "notice_included", "as_is_software", "no_liability_authors"]),
    ("MIT", ["permission_any", "notice_included", "as_is_software"]),
    ("MIT", ["permission_any", "notice_included"]),
    ("BSD-3-Clause", ["redistribution", "source_retains", "binary_reproduces", "no_endorsement"]),
    ("BSD-2-Clause", ["redistribution", "source_retains", "binary_reproduces"]),
    ("Apache-2.0", ["apache_2", "apache_copy"]),
    ("Apache-2.0", ["apache_2"]),
    ("ISC", ["permission_fee"]),
    ("ISC", ["permission_fee_and"]),
    ("GPL-3.0-or-later", ["gpl_3_later"]),
    ("GPL-2.0-or-later", ["gpl_2_later"]),
    ("MPL-2.0", ["mpl_2"]),
    ("Unlicense", ["public_domain"]),
]

# Every known sentence and statement holds one of these, so that other texts need no look.
_HINT = re.compile(r"(?i)under|spdx|licen[sc]e|copyright|permission|redistribut|public\s+domain|software|warranty")
# A sentence does not end in "v. 2.0" or after an SPDX tag.
_SPLIT = re.compile(
    r"(?:(?!(?<=\b[vV])\.\s+[0-9])[.!?](?=\s|$)|(?<!(?i:spdx-license-identifier)):(?=\s|$)|\n[ \t#*/;-]*\n)"
)
_COMMENT = re.compile(r"(?m)^[ \t]*(?:[#*;]+|//+|--+|<!--)?[ \t]*")
_DROPPED = re.compile(r"[^a-z0-9.+ ]+")
_NUMBERED = re.compile(r"^(?:\(?[0-9a-z]\)?[.)] |[0-9] )")
_STATEMENT = re.compile(
    r"^(?:(?:(?:this|the) (?:work|project|program|software|file|code|library|document|text|content)s?|it) (?:is|are) )?"
    r"(?:(?:dual )?(?:released|licensed|distributed|available|published|provided|made available)|"
    r"you (?:may|can) (?:use|copy|redistribute) (?:it|(?:this|the) (?:work|project|program|software|file|code|library)s?)) under "
    r"(?:the )?(?:terms of )?(?:the )?(?P<name>.+)$"
)
_SPDX = re.compile(r"^spdx license identifier (?P<name>.+)$")
_OPENS = re.compile(r"(?:this|the|it|you|dual|released|licensed|distributed|available|published|provided|made|spdx)\b")
_CUT = re.compile(r"[,;(]|\s[-\u2013\u2014]+\s")
_FILLER = {"license", "licenses", "version", "v", "international", "gnu"}
_LATER = re.compile(r"(?:(?:license|version) )*(?:(?P<only>only)|(?:or )?(?:at your option )?any later|or (?:at your option )?(?:any )?(?:later|newer)|\+)(?: version)?(?: |$)")
#: Words in which a statement says its licence, or a known sentence ends.
_REACH = 96
#: Words that may follow a name and belong to it.
_AHEAD = 16


def _cleaned(sentence: str) -> str:
    text = _COMMENT.sub("", sentence).lower().replace("licence", "license")
    return " ".join(_DROPPED.sub(" ", text).split()).strip(" .")


def normalised(sentence: str) -> str:
    """Lower case; comment marks, quotes and other punctuation gone; single spaces; no number in front."""
    return _NUMBERED.sub("", _cleaned(sentence))


def _numbered(sentence: str) -> int:
    """How many words the number in front of a sentence takes."""
    return int(bool(_NUMBERED.match(_cleaned(sentence))))


def _words(name: str) -> list[str]:
    """The words of a normalised name, versions in one spelling."""
    plain = re.sub(r"\b([al]?gpl|mpl|epl|apache)v?(?=[0-9])", r"\1 ", name)
    plain = re.sub(r"\bv(?=[0-9])", "", plain)
    plain = re.sub(r"\b([0-9]+)\.0\b(?!\.?[0-9])", r"\1", plain)
    return [w.rstrip(".") for w in re.sub(r"(?<=[0-9])\+", " +", plain).split() if w.rstrip(".")]


_NAMED = {
    tuple(w for w in _words(normalised(name)) if w not in _FILLER): tag
    for name, tag in [*NAMES.items(), *((tag, tag) for tag in NAMES.values())]
}
_LONGEST = max(map(len, _NAMED))


def _named(words: list[str]) -> tuple[list[str], bool, bool, int]:
    """The licences that a statement's object begins with; whether that is all of it, or beyond doubt;
    and how many words that rests on: any more of them would have said the same.

    Names joined by "or" and "and" are all taken. A name is beyond doubt if it has a version or
    the word licence with it, so that other words may follow.
    """
    found, sure, at, seen = [], True, 0, 0
    while True:
        start = at
        while start < len(words) and words[start] in {"a", "an", "the", "either", "both", "of"}:
            start += 1
        best, taken, i = None, [], start
        while i < len(words) and len(taken) < _LONGEST:
            if words[i] not in _FILLER:
                taken.append(words[i])
                if tuple(taken) in _NAMED:
                    best = (_NAMED[tuple(taken)], i + 1)
            i += 1
        seen = max(seen, i + 1)
        if not best:
            return found, False, sure, seen
        tag, end = best
        later = _LATER.match(" ".join(words[end : end + _AHEAD]))
        if later:
            end += len(later[0].split())
            tag += "-only" if later["only"] else "-or-later"
        while end < len(words) and words[end] in _FILLER:
            end += 1
        seen = max(seen, end + _AHEAD)
        own = words[start:end]
        sure = sure and any(w[0].isdigit() or w in ("license", "licenses") for w in own)
        found.append(tag)
        at = end
        while at < len(words) and words[at] in ("or", "and"):
            at += 1
        if end == len(words):
            return found, True, sure, seen
        if at == end:
            return found, False, sure, seen


_KNOWN = {normalised(text): name for name, text in SENTENCES.items() if "{name}" not in text}
#: What a known sentence may begin with, for one that the splitter cuts.
_PREFIXES = {" ".join(plain.split()[:k]).strip(" .") for plain in _KNOWN for k in range(1, len(plain.split()) + 1)}
_NAME = r"(?: \S+){1,12}? "
_OPEN = [
    (normalised(text.split("{name}")[0]), re.compile(_NAME.join(re.escape(normalised(p)) for p in text.split("{name}"))), name)
    for name, text in SENTENCES.items()
    if "{name}" in text
]


_BEGINNINGS = (*_KNOWN, *(opens for opens, _, _ in _OPEN))


def _known(plain: str) -> str | None:
    """The identifier of a normalised sentence that is known, whatever organisation it names."""
    if plain in _KNOWN:
        return _KNOWN[plain]
    return next((name for opens, whole, name in _OPEN if plain.startswith(opens) and whole.fullmatch(plain)), None)


def identifier(sentence: str) -> str | None:
    """The identifier of a known licence sentence; ``=X`` or ``=X Y`` for a statement that names licences.

    A statement may end at any comma and the like: the longest beginning that says a licence
    counts. The words are read once; only beginnings as short as what the names rest on are tried.
    """
    plain = normalised(sentence)
    known = _known(plain)
    if known:
        return known
    if not _OPENS.match(plain):
        return None
    for pattern in (_STATEMENT, _SPDX):
        found = pattern.match(plain)
        if not found:
            continue
        words, counts = [], [0]
        for word in found["name"].split():
            words += _words(word)
            counts.append(len(words))
        before = len(plain.split()) - (len(counts) - 1)
        licences, whole, sure, seen = _named(words)
        tried, at, read = {len(words)}, 0, -_numbered(sentence)
        shorter = []
        for m in _CUT.finditer(sentence):
            read += len(_cleaned(sentence[at : m.start()]).split())
            at = m.start()
            if read > before:
                k = counts[min(read - before, len(counts) - 1)]
                if k > seen:
                    break
                if k not in tried:
                    tried.add(k)
                    shorter.append(k)
        for k in [None, *reversed(shorter)]:
            if k is not None:
                licences, whole, sure, _ = _named(words[:k])
            if licences and (whole or sure or pattern is _SPDX):
                return "=" + " ".join(dict.fromkeys(licences))
    return None


def _statement(lines: list[str]) -> tuple[str | None, int]:
    """The identifier of the statement that begins with the first line, and how many lines it takes."""
    words, most = 0, 0
    while most < len(lines) and words < _REACH:
        words += len(lines[most].split())
        most += 1
    plain = normalised("\n".join(lines[:most]))
    if not (_STATEMENT.match(plain) or _SPDX.match(plain) or plain.startswith(_BEGINNINGS)):
        return None, 1
    for most in range(most, 0, -1):
        known = identifier("\n".join(lines[:most]))
        if known:
            return known, next(k for k in range(1, most + 1) if identifier("\n".join(lines[:k])) == known)
    return None, 1


def identifiers(text: str) -> list[tuple[int, int, int, str]]:
    """``number, start, end, identifier`` of the known sentences of a text, in order."""
    if not _HINT.search(text):
        return []
    pieces, at = [], 0
    for m in _SPLIT.finditer(text):
        pieces.append((at, m.start()))
        at = m.end()
    pieces.append((at, len(text)))
    found, number, p = [], 0, 0
    while p < len(pieces):
        at, stop = pieces[p]
        whole = text[at:stop]
        # A known sentence may go on over the next cuts.
        known, last, q, plain = None, p, p, normalised(whole)
        while plain in _PREFIXES:
            if plain in _KNOWN and _KNOWN[plain] != known:
                known, last = _KNOWN[plain], q
            q += 1
            if q == len(pieces):
                break
            plain = normalised(text[at : pieces[q][1]])
        known = known or _known(normalised(whole))
        if known:
            found.append((number, at + len(whole) - len(whole.lstrip()), pieces[last][1], known))
            number += 1
        else:
            # A statement begins with a line, and ends where its lines say no more.
            lines, i, line_at = whole.split("\n"), 0, at
            while i < len(lines):
                line, taken = lines[i], 1
                if line.strip():
                    plain = normalised(line)
                    known = _known(plain)
                    if not known and _OPENS.match(plain):
                        known, taken = _statement(lines[i : i + _REACH])
                    if known:
                        said = "\n".join(lines[i : i + taken]).rstrip()
                        found.append((number, line_at + len(line) - len(line.lstrip()), line_at + len(said), known))
                    number += 1
                line_at += sum(len(each) + 1 for each in lines[i : i + taken])
                i += taken
        p = last + 1
    return found


def matched(sequence: list[tuple[int, int, int, str]]) -> list[tuple[str, int, int]]:
    """``licence, start, end`` of every match of the rules, and of what is left over."""
    free = [True] * len(sequence)
    found = []
    for licence, rule in RULES:
        for i in range(len(sequence) - len(rule) + 1):
            part = range(i, i + len(rule))
            if (
                all(free[k] and sequence[k][3] == name for k, name in zip(part, rule, strict=True))
                and all(sequence[k + 1][0] - sequence[k][0] <= GAP + 1 for k in part[:-1])
            ):
                found.append((licence, sequence[i][1], sequence[part[-1]][2]))
                for k in part:
                    free[k] = False
    for k, (_, start, end, name) in enumerate(sequence):
        if free[k]:
            names = name[1:].split(" ") if name.startswith("=") else ["incomplete"]
            found += [(licence, start, end) for licence in names]
    return sorted(found, key=lambda f: (f[1], f[2], f[0]))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """A row per document: ``doc_id, licenses, n_licenses, n_sentences, spans``.

    ``licenses`` lists the distinct licences by name, comma-joined, ``incomplete`` standing
    for known sentences that make no licence; a statement that joins licences by "or" or
    "and" is a match of each of them; ``n_licenses`` counts the matches and
    ``spans`` lists them as ``licence:start:end`` by start, in code points. ``n_sentences``
    counts the known sentences. Null and empty texts have none. Null and repeated
    ``doc_id`` are kept, a row for each row; other columns are ignored.
    """
    out = pa.schema(
        [("doc_id", pa.int64()), ("licenses", pa.string()), ("n_licenses", pa.int64()), ("n_sentences", pa.int64()),
         ("spans", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                sequence = identifiers(text.as_py() or "")
                rows.append((sequence, matched(sequence)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([",".join(sorted({n for n, _, _ in found})) for _, found in rows], pa.string()),
                    pa.array([len(found) for _, found in rows], pa.int64()),
                    pa.array([len(sequence) for sequence, _ in rows], pa.int64()),
                    pa.array([",".join(f"{n}:{s}:{e}" for n, s, e in found) for _, found in rows], pa.string()),
                ],
                schema=out,
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, licenses string, n_licenses long, n_sentences long, spans string")
