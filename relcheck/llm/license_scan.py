"""Operator 3 [native]: licence notices by sentence rules.

Method: texts are cut into sentences, sentences are normalised (small letters,
only letters and digits, single spaces; a sentence may be wrapped over lines,
and the marks of a comment are no letters), each is mapped to the identifier of a
known licence sentence or to none, and the document's sequence of identifiers
is matched against ordered licence rules: a rule holds when its sentences
follow each other, with nothing but unknown sentences between them that the
rule allows. All in column expressions inside the document: no shuffle, no
join, no explode.

A sentence may hold notices among other words, so all known sentences that
stand in it as runs of whole words count, in the order they begin; only what
lies inside a longer one is left out. They are found by one pass of one
expression, a tree of their words, over the whole text. Known sentences and
rules are parameters with the defaults below; both are literals in the plan,
so their size is bounded by what a caller writes.

Defined results: null and empty texts have no sentences and no licence; the
same rule matched twice counts twice in n_matches but once in ``licenses``;
rows are treated one by one, so repeats, ties and empty tables need no
care; the caller's columns travel in one struct, so none can clash.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relcheck.llm.shared import row_of

#: Known licence sentences (normalised), by identifier.
SENTENCES = {
    "mit_name": "the mit license",
    "mit_released": "released under the mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as_is": "the software is provided as is without warranty of any kind",
    "apache_line": "licensed under the apache license version 2 0",
    "apache_may": "you may not use this file except in compliance with the license",
    "apache_copy": "you may obtain a copy of the license at",
    "gpl3_line": "this work is licensed under the gnu general public license version 3",
    "gpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "bsd_redistribute": "redistribution and use in source and binary forms with or without modification are permitted",
    "bsd_endorse": "used to endorse or promote products",
    "bsd_advertising": "all advertising materials mentioning features or use of this software must display the following",
    "bsd_disclaim": "any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "apache_end_user": "the end user documentation included with the redistribution if any must include the following",
    "bsd_no_endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
    "cc_by_nc_line": "licensed under cc by nc 4 0",
    "cc_by_sa_line": "licensed under cc by sa 4 0",
    "cc_by_line": "licensed under cc by 4 0",
    "all_rights": "all rights reserved",
}
#: Rules as (rule, licence, sentences in order, unknown sentences
#: allowed between two of them).
RULES = (
    ("mit_short", "MIT", ("mit_released",), 0),
    ("mit_full", "MIT", ("mit_grant", "mit_notice", "as_is"), 3),
    ("apache_full", "Apache-2.0", ("apache_line", "apache_may", "apache_copy"), 3),
    ("apache_short", "Apache-2.0", ("apache_line",), 0),
    ("gpl3_short", "GPL-3.0", ("gpl3_line",), 0),
    ("gpl_full", "GPL", ("gpl_free", "gpl_hope"), 3),
    ("bsd_3", "BSD-3-Clause", ("bsd_redistribute", "bsd_no_endorse"), 6),
    ("bsd_3_other", "BSD-3-Clause", ("bsd_redistribute", "bsd_endorse"), 6),
    ("bsd_2", "BSD-2-Clause", ("bsd_redistribute", "bsd_disclaim"), 6),
    ("bsd_4", "BSD-4-Clause", ("bsd_redistribute", "bsd_advertising"), 6),
    ("apache_1_1", "Apache-1.1", ("bsd_redistribute", "apache_end_user"), 6),
    ("cc_by_nc", "CC-BY-NC-4.0", ("cc_by_nc_line",), 0),
    ("cc_by_sa", "CC-BY-SA-4.0", ("cc_by_sa_line",), 0),
    ("cc_by", "CC-BY-4.0", ("cc_by_line",), 0),
    ("reserved", "Proprietary", ("all_rights",), 0),
)
#: Short forms by licence, each a known sentence and a rule of its
#: own. A name without version gives the family (GPL, BSD, ...).
SHORT = {
    "MIT": ("the mit license", "mit license", "mit licence", "mit licensed"),
    "Apache-2.0": ("apache license version 2 0", "apache license 2 0", "apache license v2 0", "apache 2 0 license", "apache 2 0 licence"),
    "Apache": ("apache license",),
    "GPL-2.0": ("gnu general public license version 2", "gnu general public license v2", "version 2 of the gnu general public license",
                "gnu gpl version 2", "gpl version 2", "gpl v2", "gplv2", "gpl 2 0"),
    "GPL-3.0": ("gnu general public license version 3", "gnu general public license v3", "version 3 of the gnu general public license",
                "gnu gpl version 3", "gpl version 3", "gpl v3", "gplv3", "gpl 3 0"),
    "GPL": ("gnu general public license", "gnu gpl"),
    "LGPL-2.1": ("gnu lesser general public license version 2 1", "gnu lesser general public license v2 1", "lgpl version 2 1", "lgpl v2 1", "lgplv2 1", "lgpl 2 1"),
    "LGPL-3.0": ("gnu lesser general public license version 3", "gnu lesser general public license v3", "lgpl version 3", "lgpl v3", "lgplv3", "lgpl 3 0"),
    "LGPL": ("gnu lesser general public license", "gnu library general public license", "gnu lgpl"),
    "AGPL-3.0": ("gnu affero general public license version 3", "gnu affero general public license v3", "agpl version 3", "agpl v3", "agplv3", "agpl 3 0"),
    "AGPL": ("gnu affero general public license", "gnu agpl"),
    "MPL-2.0": ("this source code form is subject to the terms of the mozilla public license", "mozilla public license version 2 0",
                "mozilla public license 2 0", "mozilla public license v2 0", "mpl 2 0"),
    "MPL": ("mozilla public license",),
    "ISC": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
            "isc license", "isc licence"),
    "0BSD": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",),
    "BSD-2-Clause": ("bsd 2 clause", "2 clause bsd license", "simplified bsd license"),
    "BSD-3-Clause": ("bsd 3 clause", "3 clause bsd license", "new bsd license", "revised bsd license", "modified bsd license"),
    "BSD": ("bsd license", "bsd licence"),
    "Unlicense": ("this is free and unencumbered software released into the public domain", "the unlicense"),
    "CC0-1.0": ("cc0 1 0", "cc0"),
    "CC-BY-4.0": ("cc by 4 0", "creative commons attribution 4 0"),
    "CC-BY-SA-4.0": ("cc by sa 4 0", "creative commons attribution sharealike 4 0"),
    "CC-BY-NC-4.0": ("cc by nc 4 0", "creative commons attribution noncommercial 4 0"),
}
#: Identifiers behind SPDX-License-Identifier. One that goes on
#: ("-only", "-or-later") counts as its beginning, unless it is listed too.
SPDX_MARK = "spdx license identifier"
SPDX = ("MIT", "MIT-0", "MIT-CMU", "MIT-Modern-Variant", "Apache-1.1", "Apache-2.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0",
        "AGPL-1.0", "AGPL-3.0", "MPL-1.1", "MPL-2.0", "ISC", "0BSD", "BSD-2-Clause", "BSD-2-Clause-Patent", "BSD-3-Clause", "BSD-3-Clause-Clear",
        "BSD-4-Clause", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0",
        "EPL-1.0", "EPL-2.0", "BSL-1.0", "Zlib", "WTFPL")


def short_rules() -> tuple[dict[str, str], tuple]:
    """Known sentences and rules of SHORT and SPDX; a sentence that SENTENCES
    has already keeps its identifier."""
    known, rules, names = {}, [], {t: k for k, t in SENTENCES.items()}
    forms = [(t, lic, f"{re.sub('[^a-z0-9]+', '_', lic.lower())}_name{i}") for lic, all_ in SHORT.items() for i, t in enumerate(all_)]
    forms += [(f"{SPDX_MARK} {re.sub('[^a-z0-9]+', ' ', s.lower())}", s, f"spdx_{re.sub('[^a-z0-9]+', '_', s.lower())}") for s in SPDX]
    for t, lic, name in forms:
        k = names.get(t, name)
        known[k] = t
        rules.append((k, lic, (k,), 0))
    return known, tuple(rules)


SENTENCES |= short_rules()[0]
RULES += short_rules()[1]
#: A mark that ends a sentence: white space follows. A blank line (one without
#: letters and digits, as in a framed comment) ends one too; a single line break
#: does not, but it does end a part: parts are what is counted and numbered.
MARK = r"[.!?]+(?=\s|$)"
#: A run of spaces, line breaks (\n) and marks (\x01) that ends a sentence.
STOP = "[ \n\x01]*(?:\x01|\n ?\n)[ \n\x01]*"
#: What stands between two words, between two words of one sentence, and
#: between two parts.
EDGE, GLUE, BREAK = "[ \n\x01]", "[ \n]", "[\n\x01]"
#: Around what ``marked`` puts in; a normalised text has neither.
OPEN, CLOSE = "\x03", "\x04"


def normalised(text: str = "text") -> Column:
    """The words of a text, with one character between two: \\x01 where a
    sentence ends, \\n at any other line break, a space elsewhere."""
    low = F.regexp_replace(F.lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))), MARK, "\x01")
    plain = F.regexp_replace(F.regexp_replace(low, "\r\n?", "\n"), r"[^\p{L}\p{N}\n\x01]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, STOP, "\x01"), " ?\n ?", "\n"), F.lit(" \n\x01"))


def each_spdx(plain: Column) -> Column:
    """SPDX_MARK set again before what follows an 'or' or 'and' on its line,
    however long, so that every licence of an expression counts: the text is cut
    at the marks, and of each part the first line is rewritten."""
    parts = F.split(plain, SPDX_MARK)

    def again(part: Column, i: Column) -> Column:
        line = F.regexp_extract(part, "^[^\n\x01]*", 0)
        return F.when(i == 0, part).otherwise(F.concat(F.regexp_replace(line, " (?:or|and) ", f"$0{SPDX_MARK} "), F.substring(part, F.length(line) + 1, F.length(part))))

    return F.when(F.contains(plain, F.lit(SPDX_MARK)), F.array_join(F.transform(parts, again), SPDX_MARK)).otherwise(plain)


def any_known(known: dict[str, str]) -> str:
    """An expression for the place before a known sentence, in group 1 its
    words: the longest that begins there, none that lies inside a longer one."""
    glued = {t: t.replace(" ", GLUE) for t in known.values()}
    tree: dict = {}
    for t in glued:
        node = tree
        for word in t.split(" "):
            node = node.setdefault(word, {})
        node[""] = t

    def outside(t: str) -> str:
        out = f"(?={EDGE})"
        for longer in glued:
            at = f" {longer} ".find(f" {t} ", 1)
            while at > 0:
                head, tail = longer[:at].replace(" ", GLUE), longer[at + len(t):].replace(" ", GLUE)
                out += f"(?!(?<={EDGE}{head}{glued[t]}){tail}{EDGE})"
                at = f" {longer} ".find(f" {t} ", at + 1)
        return out

    def after(node: dict) -> str:
        ways = [f"{GLUE}{w}{after(n)}" for w, n in sorted(node.items()) if w]
        return "(?:" + "|".join(ways + ([outside(node[""])] if "" in node else [])) + ")"

    return f"(?<={EDGE})(?=(" + "|".join(w + after(n) for w, n in sorted(tree.items())) + "))"


def marked(plain: Column, known: dict[str, str]) -> Column:
    """The text with OPEN identifier CLOSE before every known sentence."""
    names = {t: k for k, t in sorted(known.items(), reverse=True)}
    of = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    parts = F.split(F.regexp_replace(F.concat(F.lit(" "), plain, F.lit(" ")), any_known(known), f"{OPEN}$1{CLOSE}"), OPEN)

    def named(part: Column) -> Column:
        end = F.instr(part, CLOSE)
        return F.when(end > 0, F.concat(F.lit(OPEN), of[F.translate(F.substring(part, 1, end - 1), "\n", " ")], F.substring(part, end, F.length(part)))).otherwise(part)

    return F.when(F.size(parts) == 1, plain).otherwise(F.array_join(F.transform(parts, named), ""))


def identifiers(sentence: Column) -> Column:
    """The identifiers that ``marked`` put into this part of a text, in order."""
    return F.regexp_extract_all(sentence, F.lit(f"{OPEN}([^{CLOSE}]+)"), F.lit(1))


def license_scan(docs: DataFrame, text: str = "text", known: dict[str, str] | None = None, rules: tuple | None = None,
                 carry: list[str] | None = None) -> DataFrame:
    """(row, n_sentences long, sentence_ids string, rules array<string>,
    licenses array<string>, n_matches long). ``sentence_ids``: place:identifier
    of the known sentences, from 0. Places and ``n_sentences`` count parts, which
    every line break ends; a known sentence has the place where it begins."""
    known, rules = known or SENTENCES, rules or RULES
    rows = docs.select(row_of(docs, carry), normalised(text).alias("plain"))
    rows = rows.select("row", "plain", marked(each_spdx(F.col("plain")), known).alias("text"))
    n = F.when(F.col("plain") == "", 0).otherwise(F.regexp_count("plain", F.lit(BREAK)) + 1)
    places = F.flatten(F.transform(F.split("text", BREAK), lambda s, i: F.transform(identifiers(s), lambda x: F.concat(i.cast("string"), F.lit(":"), x))))
    seq = F.transform(F.split("text", "\x01"), lambda s: F.coalesce(F.nullif(F.array_join(identifiers(s), " "), F.lit("")), F.lit("-")))
    some = F.contains("text", F.lit(OPEN))
    rows = rows.select("row", n.cast("long").alias("n_sentences"), F.when(some, F.concat_ws(",", places)).otherwise("").alias("sentence_ids"),
                       F.when(some, F.concat(F.lit(" "), F.concat_ws(" ", seq), F.lit(" "))).otherwise("").alias("line"))
    line = F.col("line")
    matches = [(name, licence, F.regexp_count(line, F.lit(rule_pattern(ids, gap)))) for name, licence, ids, gap in rules]
    found = F.array(*[F.when(n > 0, F.lit(name)) for name, _, n in matches])
    of = F.array(*[F.when(n > 0, F.lit(licence)) for _, licence, n in matches])
    return rows.select("row", "n_sentences", "sentence_ids",
                       F.array_compact(found).alias("rules"), F.array_sort(F.array_distinct(F.array_compact(of))).alias("licenses"),
                       reduce(lambda a, b: a + b, [n.cast("long") for _, _, n in matches]).alias("n_matches"))


def rule_pattern(ids: tuple[str, ...], gap: int) -> str:
    """A rule over the line of identifiers, each between single spaces."""
    return f"(?<= )" + f" (?:- ){{0,{gap}}}".join(ids) + "(?= )"
