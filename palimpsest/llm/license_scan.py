"""Recognise licences by sentences and by rules over sequences of them, with built-in expressions only.

A text is lower-cased and reduced to words of a-z and 0-9. It is cut at blank lines and at ``. ! ?`` before white space
or the end, but for ``v.`` before a number. A single line feed, ``;`` or ``:`` before white space may end a sentence or
stand in it: a known sentence is found from cut to cut of either kind, over as many lines as it takes, the longest first.
Known sentences map to identifiers. A rule is an ordered list of identifiers; it matches where these stand next to each
other among the text's recognised sentences. One projection does all of it: there is no shuffle, and a document of any
source or size is a row of its own. The sentences form one pattern factored by common beginnings, so a text costs its length
and not the catalogue's.

The catalogue has sentences of licences' own texts and headers, and short notices, which are made of names and of the forms in
which authors write them; callers may pass their own. A name alone on a line is no notice, as it may end a sentence that wraps.

Edge cases: a null or empty text has no sentences; sentences that repeat are recognised each time; rows that repeat give
rows that repeat; an empty table gives an empty result; of other columns only ``carry`` is kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.lexicon import trie_regex

#: Sentences of public licence texts and notices, in lower-case words.
SENTENCES: dict[str, str] = {
    "mit-line": "released under the mit license",
    "mit-line-2": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-name": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "apache-line": "licensed under the apache license version 2 0",
    "apache-notice": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "gpl-3-line": "this work is licensed under the gnu general public license version 3",
    "gpl-grant": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-2-grant": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by-line": "licensed under cc by 4 0",
    "cc-by-sa-line": "licensed under cc by sa 4 0",
    "cc-by-nc-line": "licensed under cc by nc 4 0",
    "cc0-line": "licensed under cc0 1 0",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc-liability": "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "bsd-as-is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "apache-basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl-see": "see the gnu general public license for more details",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "lgpl-21-grant": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl-3-grant": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-3-grant": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "unlicense-line": "this is free and unencumbered software released into the public domain",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "bsl-line": "distributed under the boost software license version 1 0",
}
#: Identifiers that a line ``SPDX-License-Identifier:`` may name.
SPDX = ["0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-2.0", "Unlicense", "WTFPL", "Zlib"]
SENTENCES |= {f"spdx-{x.lower()}": "spdx license identifier " + re.sub("[^a-z0-9]+", " ", x.lower()) for x in SPDX}
#: A rule's name, the licence it finds, and its sentences in order.
RULES: list[tuple[str, str, list[str]]] = [
    ("mit-short", "MIT", ["mit-line"]),
    ("mit-short-2", "MIT", ["mit-line-2"]),
    ("mit-full", "MIT", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("isc-full", "ISC", ["isc-grant", "isc-as-is"]),
    ("bsd-2-full", "BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("bsd-3-full", "BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name"]),
    ("apache-short", "Apache-2.0", ["apache-line"]),
    ("apache-header", "Apache-2.0", ["apache-notice", "apache-use", "apache-copy"]),
    ("gpl-3-short", "GPL-3.0-only", ["gpl-3-line"]),
    ("gpl-3-header", "GPL-3.0-or-later", ["gpl-grant", "gpl-warranty"]),
    ("gpl-2-header", "GPL-2.0-or-later", ["gpl-2-grant", "gpl-warranty"]),
    ("mpl-header", "MPL-2.0", ["mpl-notice"]),
    ("cc-by-short", "CC-BY-4.0", ["cc-by-line"]),
    ("cc-by-sa-short", "CC-BY-SA-4.0", ["cc-by-sa-line"]),
    ("cc-by-nc-short", "CC-BY-NC-4.0", ["cc-by-nc-line"]),
    ("cc0-short", "CC0-1.0", ["cc0-line"]),
    ("lgpl-21-short", "LGPL-2.1-or-later", ["lgpl-21-grant"]),
    ("lgpl-3-short", "LGPL-3.0-or-later", ["lgpl-3-grant"]),
    ("agpl-3-short", "AGPL-3.0-or-later", ["agpl-3-grant"]),
    ("unlicense-short", "Unlicense", ["unlicense-line"]),
    ("zlib-short", "Zlib", ["zlib-grant"]),
    ("bsl-short", "BSL-1.0", ["bsl-line"]),
]
RULES += [(f"spdx-{x.lower()}-short", x, [f"spdx-{x.lower()}"]) for x in SPDX]


#: How notices name a licence, by the licence.
NAMES: dict[str, list[str]] = {
    "MIT": ["mit", "mit license", "expat license"],
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache 2 0", "apache version 2 0 license"],
    "GPL-2.0-only": ["gnu general public license version 2", "gnu general public license v2 0", "gnu gpl v2", "gpl v2", "gplv2", "gpl 2 0"],
    "GPL-3.0-only": ["gnu general public license version 3", "gnu general public license v3 0", "gnu gpl v3", "gpl v3", "gplv3", "gpl 3 0"],
    "LGPL-2.1-only": ["gnu lesser general public license version 2 1", "gnu lgpl v2 1", "lgpl v2 1", "lgplv2 1"],
    "LGPL-3.0-only": ["gnu lesser general public license version 3", "gnu lgpl v3", "lgpl v3", "lgplv3"],
    "AGPL-3.0-only": ["gnu affero general public license version 3", "gnu affero general public license v3 0", "gnu agpl v3", "agpl v3", "agplv3"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "freebsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license"],
    "ISC": ["isc license", "isc"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license 2 0", "mpl 2 0", "mpl v2 0"],
    "EPL-2.0": ["eclipse public license version 2 0", "eclipse public license 2 0", "epl 2 0"],
    "EUPL-1.2": ["european union public licence version 1 2", "eupl 1 2", "eupl v1 2"],
    "BSL-1.0": ["boost software license version 1 0", "boost software license 1 0"],
    "Zlib": ["zlib license"],
    "Unlicense": ["unlicense"],
    "WTFPL": ["wtfpl", "do what the fuck you want to public license"],
    "Artistic-2.0": ["artistic license 2 0", "artistic license version 2 0"],
    "CC0-1.0": ["creative commons zero v1 0 universal", "cc0 1 0 universal", "cc0 1 0", "cc0"],
    "CC-BY-4.0": ["creative commons attribution 4 0 international license", "creative commons attribution 4 0 license", "cc by 4 0 license", "cc by 4 0"],
    "CC-BY-SA-4.0": ["creative commons attribution sharealike 4 0 international license", "creative commons attribution share alike 4 0 international license", "cc by sa 4 0 license", "cc by sa 4 0"],
    "CC-BY-NC-4.0": ["creative commons attribution noncommercial 4 0 international license", "cc by nc 4 0 license", "cc by nc 4 0"],
    "CC-BY-ND-4.0": ["creative commons attribution noderivatives 4 0 international license", "cc by nd 4 0 license", "cc by nd 4 0"],
}
#: Forms of notices around a name, and the addresses that stand for a licence.
FORMS: list[str] = [
    "licensed under the {}", "licensed under {}", "released under the {}", "distributed under the {}", "published under the {}", "code is licensed under the {}",
    "this project is licensed under the {}", "this project is licensed under the {} see the license file for details", "this project is licensed under the {} see the license md file for details",
    "this software is licensed under the {}", "this software is released under the {}", "this work is licensed under a {}", "this work is licensed under the {}", "this code is released under the {}",
    "the source code is licensed under the {}", "the gem is available as open source under the terms of the {}", "available as open source under the terms of the {}", "open source under the terms of the {}",
    "use of this source code is governed by a {} that can be found in the license file", "this program is made available under the terms of the {}", "license {}",
]
ADDRESSES: dict[str, list[str]] = {
    "CC-BY-4.0": ["creativecommons org licenses by 4 0"], "CC-BY-SA-4.0": ["creativecommons org licenses by sa 4 0"], "CC-BY-NC-4.0": ["creativecommons org licenses by nc 4 0"],
    "CC0-1.0": ["creativecommons org publicdomain zero 1 0"], "Apache-2.0": ["www apache org licenses license 2 0", "www apache org licenses license 2 0 txt"], "MIT": ["opensource org licenses mit"],
    "MPL-2.0": ["mozilla org mpl 2 0"], "GPL-3.0-only": ["www gnu org licenses gpl 3 0 html"],
}
#: Headings and notices of one form each.
OTHERS: list[tuple[str, str]] = [
    ("MIT", "the gem is available as open source under the terms of the mit license https opensource org licenses mit"),
    ("Apache-2.0", "apache license version 2 0 january 2004"),
    ("GPL-3.0-only", "gnu general public license version 3 29 june 2007"),
    ("GPL-2.0-only", "gnu general public license version 2 june 1991"),
    ("LGPL-3.0-only", "gnu lesser general public license version 3 29 june 2007"),
    ("LGPL-2.1-only", "gnu lesser general public license version 2 1 february 1999"),
    ("AGPL-3.0-only", "gnu affero general public license version 3 19 november 2007"),
    ("BSD-3-Clause", "use of this source code is governed by a bsd style license that can be found in the license file"),
    ("BSL-1.0", "see accompanying file license 1 0 txt or copy at http www boost org license 1 0 txt"),
]


NOTICE = "notice-"
#: Further texts of sentences, by text: the identifier that they stand for.
NOTICES: dict[str, str] = {}


def _catalogue() -> None:
    """Short notices of every name in every form; a licence's all have one identifier and one rule. What is known already stays."""
    known = set(SENTENCES.values())
    made = [(lic, form.format(name)) for lic, names in NAMES.items() for name in names for form in FORMS]
    made += [(lic, form.format(address)) for lic, addresses in ADDRESSES.items() for address in addresses for form in ("http {}", "https {}")]
    for lic, text in [*made, *OTHERS]:
        name = f"{NOTICE}{lic.lower()}"
        if text not in known:
            if name not in SENTENCES:
                SENTENCES[name] = text
                RULES.append((f"{name}-short", lic, [name]))
            NOTICES[text] = name


_catalogue()

#: White space that ends no line.
_BLANK = r"[\x20\x09\x0B-\x0D]"


def normalised(text: Column) -> Column:
    """A text's words, divided by a blank, by ``|`` where a sentence may end, and by a line feed where it does."""
    marked = F.lower(F.translate(F.coalesce(text, F.lit("")), "|", " "))
    marked = F.regexp_replace(marked, r"(?!(?<=\bv)\.[\x20\x09-\x0D]+[0-9])[.!?]+(?:[\x20\x09-\x0D]|\z)", "\n\n")
    marked = F.regexp_replace(marked, rf"[;:](?={_BLANK})", "\n")
    plain = F.regexp_replace(marked, r"[^a-z0-9\n]+", " ")
    plain = F.regexp_replace(plain, r" ?\n ?(?:\n ?)+", "||")
    plain = F.regexp_replace(plain, r" ?\n ?", "|")
    return F.trim(F.replace(plain, F.lit("||"), F.lit("\n")))


def sentences(text: Column, known: Iterable[str]) -> Column:
    """The known sentences of a text, in order."""
    alternatives = trie_regex(known).replace("\\ ", "[ |]")
    found = F.regexp_extract_all(normalised(text), F.lit(rf"(?<![a-z0-9 ])(?:{alternatives})(?![a-z0-9 ])"), F.lit(0))
    return F.transform(found, lambda s: F.translate(s, "|", " "))


def identifiers() -> dict[str, str]:
    """The catalogue: each known sentence's identifier."""
    return {text: name for name, text in SENTENCES.items()} | NOTICES


def license_scan(docs: DataFrame, known: dict[str, str] | None = None, rules: list[tuple[str, str, list[str]]] | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_recognised, sentence_ids, rules, licenses`` of each row: the number of recognised sentences, their
    identifiers in order, the names of the rules that match and the licences they find (sorted; a longer rule hides the
    rules whose sequences it contains, and any other rule the notices of its licence). Lists are joined by commas."""
    named = {text: name for name, text in known.items()} if known else identifiers()
    rules = rules or RULES
    ids = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
    found = docs.select("doc_id", F.transform(sentences(F.col("text"), named), lambda s: F.element_at(ids, s)).alias("_ids"), *carry)
    found = found.withColumn("_sequence", F.concat(F.lit(","), F.array_join("_ids", ","), F.lit(",")))
    sequence = {name: f",{','.join(parts)}," for name, _, parts in rules}
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(lic).alias("license"), F.lit(sequence[name]).alias("sequence"), F.array(*[F.lit(n) for n, s in sequence.items() if n != name and sequence[name] in s]).cast("array<string>").alias("inside")) for name, lic, _ in rules])
    matched = F.when(F.size("_ids") > 0, F.filter(table, lambda r: F.contains(F.col("_sequence"), r["sequence"])))
    found = found.withColumn("_all", F.coalesce(matched, F.slice(table, 1, 0)))
    said = lambda r: F.startswith(r["name"], F.lit(NOTICE)) & F.exists("_all", lambda x: (x["license"] == r["license"]) & ~F.startswith(x["name"], F.lit(NOTICE)))
    shown = F.filter("_all", lambda r: ~F.arrays_overlap(r["inside"], F.transform("_all", lambda x: x["name"])) & ~said(r))
    found = found.withColumn("_shown", shown)
    joined = lambda field: F.array_join(F.sort_array(F.array_distinct(F.transform("_shown", lambda r: r[field]))), ",")
    return found.select("doc_id", F.size("_ids").cast("long").alias("n_recognised"), F.array_join("_ids", ",").alias("sentence_ids"), joined("name").alias("rules"), joined("license").alias("licenses"), *carry)


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def oracle() -> str:
    """The same in DuckDB: cuts stand between brackets, so that a sentence is what brackets enclose, and rules are joined."""
    known = ", ".join(f"({_quoted(text)}, {_quoted(name)})" for text, name in identifiers().items())
    sequence = {name: f",{','.join(parts)}," for name, _, parts in RULES}
    rules = ", ".join(f"({_quoted(n)}, {_quoted(lic)}, {_quoted(sequence[n])})" for n, lic, _ in RULES)
    steps = "replace(lower(coalesce(text, '')), '|', ' ')"
    for pattern, by in (
        (r"\bv\.([\x20\x09-\x0D]+[0-9])", r"v \1"), (r"[.!?]+(?:[\x20\x09-\x0D]|\z)", r"\n\n"), (r"[;:]([\x20\x09\x0B-\x0D])", r"\n\1"),
        (r"[^a-z0-9\n]+", " "), (r" ?\n ?(?:\n ?)+", ">#<"), (r" ?\n ?", "><"),
    ):
        by = by.replace(r"\n", "' || chr(10) || '")
        steps = f"regexp_replace({steps}, '{pattern}', '{by}', 'g')"
    alternatives = "|".join(s.replace(" ", "(?: |><)") for s in sorted(identifiers(), key=len, reverse=True))
    return f"""
WITH k(sentence, id) AS (VALUES {known}), r(name, license, seq) AS (VALUES {rules}),
t AS (SELECT doc_id, regexp_extract_all('<' || trim({steps}) || '>', '<(?:{alternatives})>') AS parts FROM documents),
u AS (SELECT doc_id, replace(substr(part, 2, length(part) - 2), '><', ' ') AS sentence, i FROM (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM t)),
f AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY i) AS ids FROM u JOIN k USING (sentence) GROUP BY doc_id),
m AS (SELECT doc_id, name, license, seq FROM f JOIN r ON contains(',' || ids || ',', seq)),
s AS (SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.doc_id = m.doc_id AND o.name <> m.name AND contains(o.seq, m.seq))
  AND NOT (starts_with(m.name, '{NOTICE}') AND EXISTS (SELECT 1 FROM m o WHERE o.doc_id = m.doc_id AND o.license = m.license AND NOT starts_with(o.name, '{NOTICE}')))),
a AS (SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS rules, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM s GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_recognised, coalesce(ids, '') AS sentence_ids, coalesce(rules, '') AS rules, coalesce(licenses, '') AS licenses
FROM documents d LEFT JOIN f ON f.doc_id = d.doc_id LEFT JOIN a ON a.doc_id = d.doc_id
"""
