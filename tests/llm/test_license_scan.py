import re

from relcheck.llm.license_scan import RULES, SENTENCES, SPDX, license_scan
from tests.llm.helpers import docs_of, edge_docs, edge_rows, no_docs

MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files. "
       "Do as you like. The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
       "THE SOFTWARE IS PROVIDED \"AS IS\", without warranty of any kind!")

# headers as files have them, wrapped
WRAPPED_MIT = """Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY."""
WRAPPED_GPL = """/*
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
 */"""
WRAPPED_BSD = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
#
# 1. Redistributions of source code must retain the above copyright notice,
#    this list of conditions and the following disclaimer.
#
# 2. Redistributions in binary form must reproduce the above copyright notice,
#    this list of conditions and the following disclaimer in the documentation
#    and/or other materials provided with the distribution.
#
# 3. Neither the name of the copyright holder nor the names of its
#    contributors may be used to endorse or promote products derived from
#    this software without specific prior written permission."""
WRAPPED_APACHE = """// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
// You may obtain a copy of the License at
//
//     http://www.apache.org/licenses/LICENSE-2.0"""


def brute(text):
    parts = [re.sub(r"[^\w]+|_", " ", s).strip() for s in re.split(r"[\n\r]+|[.!?]+(?=\s|$)", (text or "").lower())]
    parts = [re.sub(" +", " ", p) for p in parts if p]
    order = sorted(SENTENCES, key=lambda k: (-len(SENTENCES[k]), k))
    ids = [next((k for k in order if f" {SENTENCES[k]} " in f" {p} "), "-") for p in parts]
    found = {}
    for name, lic, want, gap in RULES:
        for i, x in enumerate(ids):
            at, ok = i, x == want[0]
            for nxt in want[1:]:
                j = at + 1
                while ok and j < len(ids) and ids[j] == "-" and j - at <= gap:
                    j += 1
                ok = ok and j < len(ids) and ids[j] == nxt
                at = j
            if ok:
                found[name] = lic
    return len(parts), ",".join(f"{i}:{x}" for i, x in enumerate(ids) if x != "-"), sorted(found), sorted(set(found.values()))


def test_equals_brute_force(spark):
    texts = ["Released under the MIT License.", "x\nLicensed under the Apache License, Version 2.0.\ny", MIT, MIT.replace("Do as you like.", "A. B. C. D. E."),
             "This work is licensed under the GNU General Public License, version 3. Licensed under CC BY-NC 4.0.", "no notice here", None, "",
             "Neither here. All rights reserved!", "the mit licenses", "Released under the MIT License. Released under the MIT License."]
    out = {r.doc_id: (r.n_sentences, r.sentence_ids, sorted(r["rules"]), r.licenses) for r in license_scan(docs_of(spark, texts)).select("row.doc_id", "n_sentences", "sentence_ids", "rules", "licenses").collect()}
    for i, t in enumerate(texts):
        assert out[i] == brute(t), t
    assert out[2][3] == ["MIT"] and out[3][3] == [] and out[4][3] == ["CC-BY-NC-4.0", "GPL-3.0"]


def test_wrapped_headers(spark):
    texts = [WRAPPED_MIT, WRAPPED_GPL, WRAPPED_BSD, WRAPPED_APACHE]
    for end in ("\n", "\r\n", "\r"):
        out = license_scan(docs_of(spark, [t.replace("\n", end) for t in texts])).orderBy("row.doc_id").collect()
        assert [[r for r in o.rules if r.endswith(("_full", "_3"))] for o in out] == [["mit_full"], ["gpl_full"], ["bsd_3"], ["apache_full"]]
        assert [len(o.licenses) for o in out] == [1] * 4
    assert [r.n_sentences for r in out] == [brute(t)[0] for t in texts]
    assert out[3].sentence_ids == "0:apache_line,1:apache_may,2:apache_copy"


def test_sentences_end_at_marks_and_blank_lines(spark):
    texts = ["Released under\nthe MIT License", "Released under\n\nthe MIT License", "Released under\n * \nthe MIT License", "Released under. The MIT License",
             "Released under\x01the MIT License", "a\nb\nreleased\nunder the\n// MIT License c", "Released under \n the MIT\r\nLicense", "Released under!\nthe MIT License"]
    out = license_scan(docs_of(spark, texts)).orderBy("row.doc_id").collect()
    assert ["mit_released" in r.sentence_ids for r in out] == [True, False, False, False, False, True, True, False]
    assert out[5].sentence_ids == "2:mit_released" and [r.n_sentences for r in out] == [2, 2, 2, 2, 2, 5, 3, 2]


def test_spdx_expressions_of_any_length(spark):
    names = [x for x in SPDX if x not in ("MIT-0",)] * 4
    texts = ["SPDX-License-Identifier: " + " OR ".join(names), "a MIT OR x\n# SPDX-License-Identifier: ISC AND Zlib\nGPL-2.0 or MPL-1.1 or EPL-2.0",
             "SPDX-License-Identifier: MIT OR ISC\nSPDX-License-Identifier: Zlib AND (BSL-1.0 OR WTFPL)"]
    out = license_scan(docs_of(spark, texts)).orderBy("row.doc_id").collect()
    assert set(names) <= set(out[0].licenses)
    assert {x for x in out[1].licenses if x in SPDX} >= {"ISC", "Zlib"} and not {"MPL-1.1", "EPL-2.0"} & set(out[1].licenses)
    assert out[2].licenses == ["BSL-1.0", "ISC", "MIT", "WTFPL", "Zlib"]


def test_short_forms(spark):
    cases = {"Licensed under the MIT License": ["MIT"], "MIT License\n\nCopyright": ["MIT"], "// SPDX-License-Identifier: MIT": ["MIT"],
             "SPDX-License-Identifier: MIT-0": ["MIT-0"], "# SPDX-License-Identifier: GPL-2.0-or-later\nx": ["GPL-2.0"], "SPDX-License-Identifier: BSD-3-Clause-Clear": ["BSD-3-Clause-Clear"],
             "/* SPDX-License-Identifier: (MIT OR Apache-2.0) AND ISC */\nand gpl": ["Apache-2.0", "ISC", "MIT"], "SPDX-License-Identifier: CC-BY-NC-SA-4.0": ["CC-BY-NC-SA-4.0"],
             "licensed under the GNU General Public License, version 2.": ["GPL-2.0"], "under the GNU Lesser General Public\nLicense v2.1 or later": ["LGPL-2.1"],
             "GNU Affero General Public License": ["AGPL"], "AGPLv3": ["AGPL-3.0"], "see the GNU GPL": ["GPL"], "Apache License\nVersion 2.0, January 2004": ["Apache-2.0"],
             "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not": ["MPL-2.0"],
             "This is free and unencumbered software released into the public domain.": ["Unlicense"], "the BSD 2-Clause License": ["BSD-2-Clause"],
             "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.": ["ISC"],
             "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.": ["0BSD"],
             WRAPPED_BSD.replace("# 3. Neither the name of the copyright holder nor the names of its", "# 3. Neither the name of Some Firm nor the names of its"): ["BSD-3-Clause"],
             WRAPPED_BSD[:WRAPPED_BSD.index("# 3.")] + "# THIS SOFTWARE IS PROVIDED BY X \"AS IS\" AND\n# ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED\n"
             "# WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.": ["BSD-2-Clause"],
             "permit licenses, limit license and smit license": []}
    out = license_scan(docs_of(spark, list(cases))).orderBy("row.doc_id").collect()
    assert {t: r.licenses for t, r in zip(cases, out, strict=True)} == cases
    assert len(set(SENTENCES.values())) == len(SENTENCES) and all(set(ids) <= set(SENTENCES) for _, _, ids, _ in RULES)
    assert len({name for name, *_ in RULES}) == len(RULES) and {x for _, _, ids, _ in RULES for x in ids} == set(SENTENCES)


def test_several_notices_in_one_sentence(spark):
    texts = ["Released under the MIT License, documentation licensed under CC BY 4.0.", "Released under the MIT License, all rights reserved",
             "x. All rights reserved, released under the MIT License, all rights reserved. y",
             MIT.replace("Do as you like. ", "").replace(". ", ", ").replace("\n", " ")]
    out = license_scan(docs_of(spark, texts)).orderBy("row.doc_id").collect()
    assert [r.licenses for r in out] == [["CC-BY-4.0", "MIT"], ["MIT", "Proprietary"], ["MIT", "Proprietary"], ["MIT"]]
    assert out[2].sentence_ids == "1:all_rights,1:mit_released,1:all_rights" and out[2].n_matches == 3 and out[3].rules == ["mit_full"]


def test_only_what_lies_inside_a_longer_one_is_left_out(spark):
    known = {"ab": "a b", "b": "b", "bc": "b c", "xabc": "x a b c", "cd": "c d"}
    rules = (("two", "L", ("ab", "bc"), 0),)
    out = license_scan(docs_of(spark, ["a b c", "x a b c d", "x a b", "b a b c d b", "xa b c"]), known=known, rules=rules).orderBy("row.doc_id").collect()
    assert [r.sentence_ids for r in out] == ["0:ab,0:bc", "0:xabc,0:cd", "0:ab", "0:b,0:ab,0:bc,0:cd,0:b", "0:bc"]
    assert [r.n_matches for r in out] == [1, 0, 0, 1, 0]


def test_counts_and_edges(spark):
    assert license_scan(docs_of(spark, ["Released under the MIT License. Released under the MIT License."])).first().n_matches == 2
    out = license_scan(edge_docs(spark)).collect()
    assert len(out) == len(edge_rows()) and all(r.licenses == [] for r in out)
    assert license_scan(no_docs(spark)).count() == 0


def test_native(spark):
    plan = license_scan(edge_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
