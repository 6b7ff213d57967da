"""Licence scans: whole notices, plain and in comments; brute force; other tables; repeats, long texts and clashing columns."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lumengrid.llm import licenses
from tests.llm.test_llm import REAL

MIT = "MIT License\n\nCopyright (c) 2020 Someone\n\n" + "\n\n".join(REAL[k] for k in ("mit-grant", "mit-notice", "mit-as-is")) + " SHALL THE\nAUTHORS BE LIABLE FOR ANY CLAIM."
APACHE = "Copyright 2020 Someone\n\n" + REAL["apache-licensed-the"] + "\n" + REAL["apache-comply"] + "\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n" + REAL["apache-as-is"] + "\nSee the License for the specific language governing permissions and\nlimitations under the License."
GPL3 = "<one line to give the program's name>\nCopyright (C) 2020  Someone\n\n" + REAL["gpl-free"] + "\n\n" + REAL["gpl-no-warranty"] + "\nGNU General Public License for more details.\n\nYou should have received a copy of the GNU General Public License\nalong with this program.  If not, see <https://www.gnu.org/licenses/>."
GPL2 = GPL3.replace(REAL["gpl-free"], REAL["gpl2-free"])
BSD3 = "Copyright (c) 2020, Someone\nAll rights reserved.\n\n" + "\n\n".join(REAL[k] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")) + "\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS"
BSD2 = BSD3.replace(REAL["bsd-name"] + "\n\n", "")
MPL = REAL["mpl-subject"] + "\nYou can obtain one at https://mozilla.org/MPL/2.0/."
WHOLE = {"MIT": MIT, "Apache-2.0": APACHE, "GPL-3.0-or-later": GPL3, "GPL-2.0-or-later": GPL2, "BSD-3-Clause": BSD3, "BSD-2-Clause": BSD2, "MPL-2.0": MPL, "ISC": REAL["isc-grant"], "LGPL-2.1-or-later": REAL["lgpl21-free"], "AGPL-3.0-or-later": REAL["agpl3-free"], "BSL-1.0": REAL["boost-grant"], "Zlib": REAL["zlib-grant"], "CC0-1.0": REAL["cc0-dedicated"], "Unlicense": REAL["unlicense"]}


def test_whole_notices_plain_and_in_comments(spark):
    rows = []
    for name, text in WHOLE.items():
        rows.append((name, text))
        for mark in ("# ", "// ", " * ", ";; ", "-- ", "% "):
            rows.append((name, "\n".join(mark + line for line in text.split("\n"))))
        rows.append((name, "/*\n" + "\n".join(" * " + line for line in text.split("\n")) + "\n */\nint main() { return 0; }\n"))
    got = licenses.scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")).collect()
    assert {r.doc_id: r.licences for r in got} == {i: n for i, (n, _) in enumerate(rows)}


def test_any_organisation_and_expressions(spark):
    own = [("BSD-3-Clause", BSD3.replace("the copyright holder", who)) for who in ("Example Inc.", "the University of California, Berkeley", "Foo", "Some-Body GmbH & Co. KG")]
    own += [("BSD-3-Clause", "\n".join("# " + x for x in t.split("\n"))) for _, t in own[:2]]
    said = {
        "GPL-2.0": "GPL-2.0-only", "GPL-2.0-or-later": "GPL-2.0-or-later", "gpl-3.0+": "GPL-3.0-or-later", "LGPL-2.1-only": "LGPL-2.1-only", "MIT OR Apache-2.0": "Apache-2.0,MIT", "(MIT AND BSD-2-Clause)": "BSD-2-Clause,MIT", "Apache-2.0 WITH LLVM-exception": "Apache-2.0 WITH LLVM-exception", "0BSD": "0BSD", "LicenseRef-Own": "LicenseRef-Own", "MIT */": "MIT", "Apache-2.0 --> see": "Apache-2.0",
    }
    own += [(want, f"{mark} SPDX-License-Identifier: {text}\nint x;\n") for text, want in said.items() for mark in ("//", "#", "/*", "")]
    own += [("MIT", "This file is licensed under the MIT License."), ("", "Not licensed under the GNU public licence.")]
    own += [(n, f"{mark}{REAL[k]}\n".replace("\n", f"\n{mark}") + "\n\nPreamble follows.") for mark in ("", "# ") for k, n in (("gpl3-title", "GPL-3.0"), ("apache-title", "Apache-2.0"), ("lgpl21-title", "LGPL-2.1"), ("agpl3-title", "AGPL-3.0"), ("mpl2-title", "MPL-2.0"))]
    got = {r.doc_id: r.licences for r in licenses.scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(own)], "doc_id long, text string")).collect()}
    assert got == {i: n for i, (n, _) in enumerate(own)}
    assert licenses.identify("a\n# SPDX-License-Identifier: MIT\nReleased under the MIT License.") == ["spdx:MIT", "mit-released"]


def slotted(text, sentences):
    """brute() where <n> stands for one to n words."""
    out = []
    for block in re.split(r"\n\s*\n", text):
        pieces = [" ".join(re.findall("[a-z0-9]+", p.lower())) for p in re.split(r"(?<=[.;:!?])\s+|\n+", block)]
        pieces = [p for p in pieces if p]
        for i in range(len(pieces)):
            for j in range(i + 1, len(pieces) + 1):
                here = " ".join(pieces[i:j])
                out += [(i, j, k) for k, v in sentences.items() if re.fullmatch(re.sub(r"<(\d+)>", lambda m: rf"[a-z0-9]+(?: [a-z0-9]+){{0,{int(m[1]) - 1}}}", v), here)]
    return sorted(k for *_, k in out)


def test_slots_against_brute_force():
    rnd = random.Random(16)
    sentences = {"s1": "a <2> b", "s2": "<3> c", "s3": "a <1> <2> a", "s4": "a <4>", "s5": "a b", "s6": "b <2> b <1> c"}
    book = licenses.Rulebook(sentences, [])
    for _ in range(400):
        text = "".join(rnd.choice(["a", "b", "c", "d"]) + rnd.choice([" ", " ", ". ", "\n", "\n\n"]) for _ in range(rnd.randrange(1, 12)))
        assert sorted(book.identify(text)) == slotted(text, sentences), text


def brute(text, sentences):
    """Each known sentence at each run of whole pieces that spells it."""
    out = []
    for block in re.split(r"\n\s*\n", text):
        pieces = [" ".join(re.findall("[a-z0-9]+", p.lower())) for p in re.split(r"(?<=[.;:!?])\s+|\n+", block)]
        pieces = [p for p in pieces if p]
        for i in range(len(pieces)):
            for j in range(i + 1, len(pieces) + 1):
                out += [k for k, v in sentences.items() if v == " ".join(pieces[i:j])]
    return out


def test_sentences_against_brute_force():
    rnd = random.Random(6)
    sentences = {"s1": "a b", "s2": "a b a", "s3": "b", "s4": "c a b c", "s5": "a b a b c"}
    book = licenses.Rulebook(sentences, [])
    for _ in range(400):
        text = "".join(rnd.choice(["a", "b", "c", "A", "d"]) + rnd.choice([" ", ". ", ": ", "\n", "\n# ", "\n\n", "-", "  "]) for _ in range(rnd.randrange(1, 14)))
        assert book.identify(text) == brute(text, sentences), text


def test_rules_against_brute_force():
    rnd = random.Random(7)
    rules = [("X", ("a", "b", "c")), ("Y", ("a", "a")), ("Z", ("c", "b"), "X"), ("Z", ("d",))]
    book = licenses.Rulebook({}, rules)

    def holds(ids, rule, at):
        return not rule or any(ids[j] == rule[0] and holds(ids, rule[1:], j) for j in range(at + 1, min(len(ids), at + 2 + licenses.SPREAD)))

    for _ in range(300):
        ids = [rnd.choice("abcxxxxxxd" if rnd.random() < 0.3 else "abxxxxxxxxxc") for _ in range(rnd.randrange(0, 40))]
        true = lambda rule: any(ids[i] == rule[0] and holds(ids, rule[1:], i) for i in range(len(ids)))
        want = {n for n, r, *_ in rules[:2] if true(r)} | ({"Z"} if "d" in ids or (true(("c", "b")) and not true(rules[0][1])) else set())
        assert book.licences(ids) == sorted(want)


def test_other_tables(spark):
    sentences = spark.createDataFrame([("one", "Do as you like."), ("two", "But tell us!"), (None, "x"), ("none", None)], "id string, text string")
    rules = spark.createDataFrame([("Like-1", ["one", "two"], None), ("Like-0", ["one"], "Like-1"), ("Empty", [], None)], "licence string, sentences array<string>, unless string")
    docs = spark.createDataFrame([(1, "# Do as\n# you like. But\n# tell us!"), (2, "do as you like"), (3, "MIT License. Released under the MIT License."), (4, None)], "doc_id long, text string")
    book = licenses.rulebook(sentences, rules)
    assert {r.doc_id: r.licences for r in licenses.scan(docs, book).collect()} == {1: "Like-1", 2: "Like-0", 3: "", 4: ""}
    assert {r.licences for r in licenses.scan(docs, licenses.rulebook(sentences.where("false"), rules.where("false"))).collect()} == {""}
    monkey = pytest.MonkeyPatch()
    monkey.setattr(licenses, "MAX_BYTES", 3)
    with pytest.raises(ValueError, match="bytes"):
        licenses.rulebook(sentences, rules)
    monkey.undo()


def test_repeats_long_texts_and_clashing_columns(spark):
    long = "plain words about notice and warranty. " * 30_000 + "\n\n" + MIT
    rows = [(1, long, "x", 1), (1, long, "x", 1), (2, "", "x", 1), (None, MIT, "y", 2)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, licences string, _f int")).collect()
    assert sorted((r.doc_id or 0, r.licences) for r in got) == [(0, "MIT"), (1, "MIT"), (1, "MIT"), (2, "")]
    assert licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, licences string, _f int").where(F.lit(False))).count() == 0
