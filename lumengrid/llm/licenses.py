"""Licence scans by sentence rules.

Texts are cut into pieces at line ends and at full stops, colons and the like before white space; pieces are normalised
(lower case, other than letters and digits one space, so marks of comments vanish). A known licence sentence occurs
where neighbouring pieces of a paragraph, one or more, make up its words, so it may be wrapped over lines and hold such
marks itself ("free software: you can", "v. 2.0"). A sentence may have slots: <5> stands for one to five words, such as
the name of an organisation. Each licence of an SPDX-License-Identifier line is an identifier of its own, spdx: and its
name, which is its own rule. The identifiers of a text, in order, are matched against licence rules: ordered sequences,
each of whose identifiers comes within SPREAD further ones after the one before (which is what keeps sentences of
different notices apart).

The sentences and rules below are a small table; scan() takes others as DataFrames. They are held by every task, so
their size is checked against MAX_BYTES.

Defined cases: null and empty texts have no sentences; repeated sentences count each time, a licence once; where a known
sentence and a longer one that begins with it both end at a cut, both count, the shorter one first; very long texts are
scanned whole, a paragraph at a time; repeated rows get equal results; an empty table gives an empty result, empty
tables of sentences or rules find nothing; only doc_id and text are read, so other columns can't clash.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

#: Known licence sentences, normalised: fixed values.
SENTENCES = {
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache-licensed": "licensed under the apache license version 2 0",
    "apache-licensed-the": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-no-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-name": "neither the name of <16> nor the names of <6> contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "lgpl21-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl3-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl3-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "cc0-dedicated": "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "bsd-names": "the names of <8> contributors may not be used to endorse or promote products derived from this software without specific prior written permission",
    "mit-file": "this <3> is licensed under the mit license",
    "mit-terms": "this <3> is licensed under the terms of the mit license",
    "apache-file": "this <3> is licensed under the apache license version 2 0",
    "apache-title": "apache license version 2 0 january 2004",
    "gpl2-title": "gnu general public license version 2 june 1991",
    "gpl3-title": "gnu general public license version 3 29 june 2007",
    "lgpl21-title": "gnu lesser general public license version 2 1 february 1999",
    "lgpl3-title": "gnu lesser general public license version 3 29 june 2007",
    "agpl3-title": "gnu affero general public license version 3 19 november 2007",
    "mpl2-title": "mozilla public license version 2 0",
    "epl2-title": "eclipse public license v 2 0",
    "bsl1-title": "boost software license version 1 0 august 17th 2003",
    "cc0-title": "cc0 1 0 universal",
    "unlicense-refer": "for more information please refer to http unlicense org",
    "unlicense-refer-s": "for more information please refer to https unlicense org",
}
#: Licence rules, ordered sequences of sentence identifiers: fixed values. A third field names a licence that, if found too, takes the rule's place.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("Apache-2.0", ("apache-licensed-the", "apache-comply", "apache-as-is")),
    ("Apache-2.0", ("apache-licensed",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-no-warranty")),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-no-warranty")),
    ("GPL-3.0", ("gpl3-work",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary"), "BSD-3-Clause"),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl-subject",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("Unlicense", ("unlicense",)),
    ("LGPL-2.1-or-later", ("lgpl21-free",)),
    ("LGPL-3.0-or-later", ("lgpl3-free",)),
    ("AGPL-3.0-or-later", ("agpl3-free",)),
    ("BSL-1.0", ("boost-grant",)),
    ("Zlib", ("zlib-grant",)),
    ("CC0-1.0", ("cc0-dedicated",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("MIT", ("mit-file",)),
    ("MIT", ("mit-terms",)),
    ("Apache-2.0", ("apache-file",)),
    ("Apache-2.0", ("apache-title",)),
    ("GPL-2.0", ("gpl2-title",)),
    ("GPL-3.0", ("gpl3-title",)),
    ("LGPL-2.1", ("lgpl21-title",)),
    ("LGPL-3.0", ("lgpl3-title",)),
    ("AGPL-3.0", ("agpl3-title",)),
    ("MPL-2.0", ("mpl2-title",)),
    ("EPL-2.0", ("epl2-title",)),
    ("BSL-1.0", ("bsl1-title",)),
    ("CC0-1.0", ("cc0-title",)),
    ("Unlicense", ("unlicense-refer",)),
    ("Unlicense", ("unlicense-refer-s",)),
)
#: Further identifiers that may stand between those of a rule.
SPREAD = 8
#: Bytes of sentences and rules that tasks hold at most.
MAX_BYTES = 64 << 20
_CUT = re.compile(r"(?<=[.;:!?])\s+|\n+")
_OTHER = re.compile(r"[^a-z0-9]+")
_END, _SLOT = "", "<>"
_SLOTTED = re.compile(r"<(\d+)>")
#: A line of SPDX: its licences by name, joined by AND, OR and WITH (fixed words), maybe in parentheses.
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+()\- \t]+)", re.I)
SPDX = "spdx:"


def spdx_licences(expression: str) -> list[str]:
    """The licences of an SPDX expression, in order; one with an exception is named with it. GNU licences without a suffix are `-only`, those with a plus sign `-or-later`."""
    out: list[str] = []
    words = re.findall(r"[A-Za-z0-9.+-]+", expression)
    for before, word in zip(["", *words], words):
        if word.upper() in ("AND", "OR", "WITH") or not re.search("[A-Za-z0-9]", word):
            continue
        if before.upper() == "WITH" and out:
            out[-1] += f" WITH {word}"
            continue
        if out and before.upper() not in ("AND", "OR"):
            break  # what follows is no part of the expression
        gnu = re.fullmatch(r"([AL]?GPL-\d\.\d)(\+?)", word, re.I)
        out.append(gnu[1].upper() + ("-or-later" if gnu[2] else "-only") if gnu else word)
    return out


def normalise(sentence: str) -> str:
    return _OTHER.sub(" ", sentence.lower()).strip()


def _words(sentence: str) -> list[str]:
    """The words of a known sentence, and its slots as they stand."""
    return [w for k, part in enumerate(_SLOTTED.split(sentence)) for w in (normalise(part).split() if k % 2 == 0 else [f"<{part}>"])]


class Rulebook:
    """Sentences as a tree of words, the rules, and a hint: words of which each sentence has one, so that most texts need no cutting."""

    def __init__(self, sentences: dict[str, str], rules):
        self.rules = [(name, tuple(ids), less[0] if less else None) for name, ids, *less in rules if ids]
        self.tree: dict = {}
        known = {i: words for i, words in ((i, _words(t)) for i, t in sentences.items()) if words}
        for name, words in known.items():
            node = self.tree
            for w in words:
                if w[0] == "<":  # all slots after the same words share a node, which knows the longest; a word counts how long it is in
                    node = node.setdefault(_SLOT, {}).setdefault(int(w[1:-1]), {})
                else:
                    node = node.setdefault(w, {})
            node.setdefault(_END, []).append(name)
        known = {i: [w for w in words if w[0] != "<"] for i, words in known.items()}
        known = {i: words for i, words in known.items() if words}
        amount: dict[str, set[str]] = {}
        for name, words in known.items():
            for w in words:
                amount.setdefault(w, set()).add(name)
        open_, hint = set(known), []
        while open_:  # a word that many sentences have and that is long is seldom met elsewhere
            best = max(amount, key=lambda w: (len(amount[w] & open_) > 0, min(len(w), 8), len(amount[w] & open_), w))
            hint.append(best)
            open_ -= amount.pop(best)
        self.hint = re.compile("|".join(["spdx-license", *map(re.escape, hint)]), re.I)

    def identify(self, text: str) -> list[str]:
        """The identifiers of the known sentences of a text, in order of their first words."""
        if not self.hint.search(text):
            return []
        out = []
        for block in re.split(r"\n\s*\n", text):
            if self.hint.search(block):
                out += self._of(block)
        return out

    def _of(self, block: str) -> list[str]:
        found: list[tuple[int, int, str]] = []  # where, which of those there, identifier
        pieces, at = [], 0
        for cut in [*_CUT.finditer(block), None]:
            end = cut.start() if cut else len(block)
            if words := normalise(block[at:end]).split():
                pieces.append((at, words))
            at = cut.end() if cut else end
        for i, (start, _) in enumerate(pieces):
            states: list[tuple[dict, int, dict]] = [(self.tree, 0, {})]  # a node, or with a number the words left of a slot that leads to it
            j = i
            while states and j < len(pieces):
                for w in pieces[j][1]:
                    now = []
                    for node, left, into in states:
                        if left:
                            if left > 1:
                                now.append((node, left - 1, into))
                            now.append((into, 0, {}))
                            continue
                        if w in node:
                            now.append((node[w], 0, {}))
                        for most, after in node.get(_SLOT, {}).items():
                            if most > 1:
                                now.append((after, most - 1, after))
                            now.append((after, 0, {}))
                    states = now
                    if not states:
                        break
                names = [n for node, left, _ in states if not left for n in node.get(_END, ())]
                found += [(start, len(found) + k, n) for k, n in enumerate(dict.fromkeys(names))]
                j += 1
        for line in _SPDX.finditer(block):
            found += [(line.start(), len(found) + k, SPDX + n) for k, n in enumerate(spdx_licences(line[1]))]
        return [n for *_, n in sorted(found)]

    def licences(self, ids: list[str]) -> list[str]:
        """The licences whose rules match a sequence of identifiers."""
        places: dict[str, list[int]] = {}
        for i, x in enumerate(ids):
            places.setdefault(x, []).append(i)
        found, less = {x.removeprefix(SPDX) for x in places if x.startswith(SPDX)}, {}
        for x in found:
            less[x] = {None}
        for name, rule, other in self.rules:
            now = places.get(rule[0], [])
            for want in rule[1:]:  # places that some place of the identifier before reaches
                now = [j for j in places.get(want, []) if (k := bisect_left(now, j)) and j - now[k - 1] <= SPREAD + 1] if now else now
            if now:
                found.add(name)
                less.setdefault(name, set()).add(other)
        return sorted(n for n in found if None in less[n] or not less[n] & found)


BOOK = Rulebook(SENTENCES, RULES)
identify, licences = BOOK.identify, BOOK.licences


def rulebook(sentences: DataFrame, rules: DataFrame) -> Rulebook:
    """From tables (id, text) and (licence, sentences: array of ids, unless: a licence, or null). Rules are tried in any order."""
    size = sentences.agg(F.sum(F.octet_length("text") + F.octet_length("id"))).first()[0] or 0
    size += rules.agg(F.sum(F.octet_length("licence") + F.octet_length(F.array_join("sentences", ",")))).first()[0] or 0
    if size > MAX_BYTES:
        raise ValueError(f"{size} bytes of sentences and rules; tasks hold {MAX_BYTES} at most")
    known = {r.id: r.text for r in sentences.select("id", "text").where("id is not null and text is not null").collect()}
    return Rulebook(known, [(r.licence, r.sentences, r.unless) for r in rules.select("licence", "sentences", "unless").where("licence is not null").collect()])


_FOUND = pa.struct([("ids", pa.list_(pa.string())), ("names", pa.list_(pa.string()))])


def scan(docs: DataFrame, book: Rulebook = BOOK) -> DataFrame:
    """One row per document: doc_id, n_sentences, sentences, n_licences, licences."""

    @F.arrow_udf("struct<ids:array<string>,names:array<string>>")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            out = []
            for text in column.to_pylist():
                ids = book.identify(text or "")
                out.append({"ids": ids, "names": book.licences(ids)})
            yield pa.array(out, _FOUND)

    got = docs.select("doc_id", run("text").alias("_f"))
    return got.select("doc_id", F.size("_f.ids").cast("long").alias("n_sentences"), F.array_join("_f.ids", ",").alias("sentences"), F.size("_f.names").cast("long").alias("n_licences"), F.array_join("_f.names", ",").alias("licences"))


def op9_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
