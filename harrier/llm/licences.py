"""Licence scan by sentence rules, with DataFrame functions only.

A text is normalised (lower case, everything but letters and digits to one space) with its sentence ends and line breaks
marked. Known licence sentences are looked up from any mark to any later one: a whole sentence, a line, or a run of lines;
each place counts once, for the longest. Some notices have a sentence end inside a known sentence. Sentences that only name a
licence ("This file is licensed under the MIT License") follow a small grammar; the name alone on its line, as in a heading,
counts too. An identifier line may hold an expression: each licence of ``MIT OR Apache-2.0`` is named, exceptions behind
WITH are passed over, and a plus stands for "or later". The identifiers of a document, in
order, are then matched against licence rules, which are sequences of identifiers; longer rules are tried first and take
their sentences away from shorter ones. A line break inside a known sentence is a space; an empty line ends a sentence.

Defined cases: a null or empty text has no sentence and no licence. A licence found twice is named once; n_matches counts both.
Known sentences that complete no rule are listed in ``unmatched``. Repeated rows each give a row; very long texts are
scanned whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import plain

#: Sentences of public licence texts and notices, normalised. Their notices have a sentence end or an empty
#: line at "|"; "*" is one to twenty words, the name of a holder.
SENTENCES = {
    "apache-the": "licensed under the apache license version 2 0 the license",
    "apache-may": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at | http www apache org licenses license 2 0",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "gpl-redistribute": "this program is free software | you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-redistribute": "this program is free software | you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation | either version 2 of the license or at your option any later version",
    "lgpl3-redistribute": "this program is free software | you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl21-redistribute": "this library is free software | you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation | either version 2 1 of the license or at your option any later version",
    "agpl-redistribute": "this program is free software | you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty | without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty | without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-received": "you should have received a copy of the gnu general public license along with this program",
    "lgpl3-received": "you should have received a copy of the gnu lesser general public license along with this program",
    "lgpl-received": "you should have received a copy of the gnu lesser general public license along with this library",
    "agpl-received": "you should have received a copy of the gnu affero general public license along with this program",
    "mpl-form": "this source code form is subject to the terms of the mozilla public license v | 2 0",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-advert": "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-liable": "in no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "boost-the": "distributed under the boost software license version 1 0",
    "epl-made": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "epl1-made": "all rights reserved | this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",
    "eupl-the": "licensed under the eupl version 1 2 or | as soon they will be approved by the european commission | subsequent versions of the eupl the licence",
    "eupl-may": "you may not use this work except in compliance with the licence",
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "postgres-grant": "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies",
    "mit0-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so",
    "wtfpl-do": "you just do what the fuck you want to",
    "cc0-waived": "to the extent possible under law * has waived all copyright and related or neighboring rights to this work",
    "ofl-the": "this font software is licensed under the sil open font license version 1 1",
    "cddl-subject": "the contents of this file are subject to the terms of the common development and distribution license the license",
    "mpl11-subject": "the contents of this file are subject to the mozilla public license version 1 1 the license",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "bsd-name": "neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
}
#: Licences as an identifier line names them.
SPDX = """
0BSD AFL-3.0 AGPL-1.0-only AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0 Artistic-2.0 BlueOak-1.0.0
BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0
CC-BY-4.0 CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-2.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0
CDDL-1.0 CDDL-1.1 CECILL-2.1 CECILL-B CECILL-C CPL-1.0 curl ECL-2.0 EFL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 FTL GFDL-1.2-only
GFDL-1.2-or-later GFDL-1.3-only GFDL-1.3-or-later GPL-1.0-only GPL-1.0-or-later GPL-2.0-only GPL-2.0-or-later GPL-3.0-only
GPL-3.0-or-later HPND ICU IJG IPL-1.0 ISC JSON LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only
LGPL-3.0-or-later libpng-2.0 LPPL-1.3c MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 ODC-By-1.0 OFL-1.1
OpenSSL OSL-3.0 PDDL-1.0 PHP-3.01 PostgreSQL Python-2.0 QPL-1.0 Ruby Sleepycat TCL Unicode-DFS-2016 Unlicense UPL-1.0 Vim W3C WTFPL
X11 Zlib ZPL-2.1
""".split()
#: Exceptions that may follow WITH.
EXCEPTIONS = "Classpath-exception-2.0 GCC-exception-3.1 LLVM-exception Autoconf-exception-3.0 Bison-exception-2.2 Font-exception-2.0 Linux-syscall-note OpenSSL-exception".split()
#: How prose names a licence, as in "this work is licensed under ..", by the identifier of such a sentence.
NAMES = {
    "apache-ref": ["apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache license v2 0", "apache 2 0", "apache license | version 2 0"],
    "mit-ref": ["mit license", "mit licence", "expat license"],
    "isc-ref": ["isc license"],
    "bsd2-ref": ["bsd 2 clause license", "simplified bsd license", "2 clause bsd license"],
    "bsd3-ref": ["bsd 3 clause license", "new bsd license", "3 clause bsd license", "modified bsd license"],
    "mpl-ref": ["mozilla public license 2 0", "mozilla public license version 2 0", "mpl 2 0", "mozilla public license v2 0"],
    "gpl2-ref": ["gnu general public license version 2", "gnu general public license v2 0", "gplv2", "gpl v2", "gnu gpl v2", "gnu gplv2"],
    "gpl3-ref": ["gnu general public license version 3", "gnu general public license v3 0", "gplv3", "gpl v3", "gnu gpl v3", "gnu gplv3"],
    "lgpl21-ref": ["gnu lesser general public license version 2 1", "gnu lesser general public license v2 1", "lgplv2 1", "lgpl v2 1"],
    "lgpl3-ref": ["gnu lesser general public license version 3", "gnu lesser general public license v3 0", "lgplv3", "lgpl v3"],
    "agpl3-ref": ["gnu affero general public license version 3", "gnu affero general public license v3 0", "agplv3", "agpl v3"],
    "ccbync4-ref": ["cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"],
    "ccbysa4-ref": ["cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"],
    "ccby4-ref": ["cc by 4 0", "creative commons attribution 4 0 international license"],
    "cc0-ref": ["cc0 1 0", "cc0 1 0 universal"],
    "boost-ref": ["boost software license version 1 0", "boost software license 1 0", "boost software license | version 1 0", "boost software license"],
    "epl2-ref": ["eclipse public license 2 0", "eclipse public license v2 0", "eclipse public license | v 2 0", "eclipse public license version 2 0"],
    "epl1-ref": ["eclipse public license 1 0", "eclipse public license v1 0", "eclipse public license version 1 0"],
    "eupl12-ref": ["european union public licence v | 1 2", "european union public licence version 1 2", "european union public licence 1 2", "eupl 1 2", "eupl v1 2", "eupl version 1 2"],
    "zlib-ref": ["zlib license"],
    "unlicense-ref": ["unlicense"],
    "wtfpl-ref": ["wtfpl", "do what the fuck you want to public license"],
    "postgres-ref": ["postgresql license", "postgresql licence"],
    "artistic2-ref": ["artistic license 2 0"],
    "ofl-ref": ["sil open font license version 1 1", "sil open font license 1 1", "open font license 1 1"],
    "odbl-ref": ["open database license v1 0", "odc open database license odbl", "open database license 1 0"],
    "cddl-ref": ["common development and distribution license 1 0", "cddl 1 0"],
    "upl-ref": ["universal permissive license v 1 0", "universal permissive license | version 1 0"],
    "0bsd-ref": ["zero clause bsd license", "bsd zero clause license"],
    "mulan-ref": ["mulan psl v2", "mulan permissive software license | version 2"],
}


def _plain(spdx: str) -> str:
    return spdx.lower().replace("-", " ").replace(".", " ")


#: Words of an identifier line and the licence they name. Old forms without "only" stand for it; exceptions name none.
LINE = {_plain(x): x for x in SPDX} | {_plain(x.removesuffix("-only")): x for x in SPDX if x.endswith("-only")}
LINE_EXCEPTIONS = [_plain(x) for x in EXCEPTIONS]
#: Licence and its sentences, in order.
RULES = [
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-name"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name"]),
    ("Apache-2.0", ["apache-the", "apache-may", "apache-copy"]),
    ("GPL-3.0-or-later", ["gpl-redistribute", "gpl-hope", "gpl-received"]),
    ("GPL-2.0-or-later", ["gpl2-redistribute", "gpl-hope", "gpl-received"]),
    ("LGPL-3.0-or-later", ["lgpl3-redistribute", "gpl-hope", "lgpl3-received"]),
    ("LGPL-2.1-or-later", ["lgpl21-redistribute", "lgpl-hope", "lgpl-received"]),
    ("AGPL-3.0-or-later", ["agpl-redistribute", "gpl-hope", "agpl-received"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("MIT", ["mit-notice", "mit-as-is"]),
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("MIT-0", ["mit0-grant", "mit-as-is"]),
    ("MPL-2.0", ["mpl-form", "mpl-copy"]),
    ("MPL-1.1", ["mpl11-subject"]),
    ("CDDL-1.0", ["cddl-subject"]),
    ("Unlicense", ["unlicense-free", "unlicense-anyone"]),
    ("Unlicense", ["unlicense-free"]),
    ("Zlib", ["zlib-as-is", "zlib-liable", "zlib-grant"]),
    ("Zlib", ["zlib-as-is", "zlib-liable"]),
    ("BSL-1.0", ["boost-grant"]),
    ("BSL-1.0", ["boost-the"]),
    ("EPL-2.0", ["epl-made"]),
    ("EPL-1.0", ["epl1-made"]),
    ("EUPL-1.2", ["eupl-the", "eupl-may"]),
    ("EUPL-1.2", ["eupl-the"]),
    ("0BSD", ["0bsd-grant", "isc-as-is"]),
    ("PostgreSQL", ["postgres-grant"]),
    ("WTFPL", ["wtfpl-do"]),
    ("CC0-1.0", ["cc0-waived"]),
    ("OFL-1.1", ["ofl-the"]),
    ("Apache-2.0", ["apache-the"]),
    ("Apache-2.0", ["apache-ref"]),
    ("MIT", ["mit-ref"]),
    ("ISC", ["isc-ref"]),
    ("BSD-2-Clause", ["bsd2-ref"]),
    ("BSD-3-Clause", ["bsd3-ref"]),
    ("MPL-2.0", ["mpl-ref"]),
    ("GPL-2.0-only", ["gpl2-ref"]),
    ("GPL-3.0-only", ["gpl3-ref"]),
    ("LGPL-3.0-only", ["lgpl3-ref"]),
    ("AGPL-3.0-only", ["agpl3-ref"]),
    ("CC-BY-NC-4.0", ["ccbync4-ref"]),
    ("CC-BY-4.0", ["ccby4-ref"]),
    ("CC-BY-SA-4.0", ["ccbysa4-ref"]),
    ("CC0-1.0", ["cc0-ref"]),
    *[("LGPL-2.1-only", ["lgpl21-ref"]), ("BSL-1.0", ["boost-ref"]), ("EPL-2.0", ["epl2-ref"]), ("EPL-1.0", ["epl1-ref"]), ("EUPL-1.2", ["eupl12-ref"]), ("Zlib", ["zlib-ref"])],
    *[("Unlicense", ["unlicense-ref"]), ("WTFPL", ["wtfpl-ref"]), ("PostgreSQL", ["postgres-ref"]), ("Artistic-2.0", ["artistic2-ref"]), ("OFL-1.1", ["ofl-ref"]), ("ODbL-1.0", ["odbl-ref"])],
    *[("CDDL-1.0", ["cddl-ref"]), ("UPL-1.0", ["upl-ref"]), ("0BSD", ["0bsd-ref"]), ("MulanPSL-2.0", ["mulan-ref"])],
    *[(x, [f"spdx-{x}"]) for x in SPDX],
]
#: Sentence ends; as the pattern is also DuckDB's, it looks neither ahead nor back.
ENDS = r"[.!?;:]+[ \t\r\n]+|[.!?;:]+$|\n[ \t\r]*\n"
#: A dash between words ends a sentence as well, for the look-up.
MARKS = rf"{ENDS}|[ \t][-–—]+[ \t]"
#: A sentence that names a licence, up to the name.
_UNDER = "(?:(?:this|the) [a-z]+ is )?(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?"
#: What stands on both sides of a holder's name.
_HOLDERS = [("neither the name of ", " nor the names of its "), ("to the extent possible under law ", " has waived all ")]
_IDENTIFIER = "spdx license identifier "


def _places(line: str, end: str) -> str:
    """A known sentence, the longest first; its words may stand on several lines. ``line`` and ``end``: what may lie between words."""

    def words(x: str) -> str:
        return x.replace("*", "@").replace(" | ", "~").replace(" ", f" {line}").replace("~", f" {end}").replace("@", f"[a-z0-9]+(?: {line}[a-z0-9]+){{0,19}}?")

    by_length = lambda some: sorted(some, key=len, reverse=True)
    known = "|".join(words(x) for x in by_length(SENTENCES.values()))
    named = "|".join(words(n) for n in by_length(n for names in NAMES.values() for n in names))
    # an expression stands on one line; a plus has become "or later" before
    one = "(?:" + "|".join(by_length([*LINE, *LINE_EXCEPTIONS])) + ")"
    expression = words(f"spdx license identifier | {one}") + f"(?: (?:or|and|with) {one})*"
    # the grammar's own spaces, as words of a run of lines too
    return f"(?:{known}|{expression}|{_UNDER.replace(' ', f' {line}')}(?:{named})|(?:the {line})?(?:{named}))"


def _named() -> dict[str, str]:
    return {n.replace(" | ", " "): k for k, names in NAMES.items() for n in names}


def _line() -> dict[str, str]:
    return {n.replace(" or later", "-or-later"): f"spdx-{k}" for n, k in LINE.items()}


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_sentences, sentence_ids, licences, n_matches, unmatched; lists joined by commas."""
    known = F.create_map(*[F.lit(x) for k, v in SENTENCES.items() for x in (v.replace(" | ", " "), k)])
    named = F.create_map(*[F.lit(x) for n, k in _named().items() for x in (n, k)])
    line = F.create_map(*[F.lit(x) for n, k in _line().items() for x in (n, k)])
    d = plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    d = d.withColumn("sentences", F.filter(F.split(F.coalesce("text", F.lit("")), ENDS), lambda s: F.length(F.trim(s)) > 0))
    # lower case leaves S and L free as marks of sentence ends and line breaks
    marked = F.regexp_replace(F.lower("text"), r"([0-9])\+", "$1 or later")
    marked = F.regexp_replace(F.regexp_replace(marked, MARKS, " S "), r"[\r\n]+", " L ")
    marked = F.regexp_replace(F.concat(F.lit(" S "), marked, F.lit(" S ")), "[^a-z0-9SL]+", " ")
    places = F.regexp_extract_all(marked, F.lit(f"(?<= [SL] ){_places('(?:L )*+', '(?:[SL] )*+')}(?= [SL] )"), F.lit(0))

    def name(place: Column) -> Column:
        """The identifiers of a place: one, or those of an expression."""
        plainly = F.regexp_replace(place, " [SL](?= )", "")
        for before, behind in _HOLDERS:
            plainly = F.regexp_replace(plainly, f"(?<=^{before}).*(?={behind})", "*")
        one = F.coalesce(F.try_element_at(known, plainly), F.try_element_at(named, F.regexp_replace(plainly, f"^(?:{_UNDER}|the )", "")))
        parts = F.split(F.replace(F.substring(plainly, len(_IDENTIFIER) + 1, 1 << 30), F.lit(" or later"), F.lit("-or-later")), " (?:or|and|with) ")
        return F.when(plainly.startswith(_IDENTIFIER), F.array_compact(F.transform(parts, lambda x: F.try_element_at(line, x)))).otherwise(F.array(one))

    # only texts with one of the words every known sentence has are normalised
    ids = F.when(F.rlike("text", F.lit(HINT)), F.flatten(F.transform(places, name))).otherwise(F.array().cast("array<string>"))
    d = d.select("doc_id", F.size("sentences").cast("long").alias("n_sentences"), ids.alias("ids"))
    # identifiers stand in angles and licences in brackets, so neither is part of another nor of a later rule
    found = F.array_join(F.transform("ids", lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")
    for licence, rule in RULES:
        found = F.replace(found, F.lit("".join(f"<{x}>" for x in rule)), F.lit(f"[{licence}]"))
    d = d.withColumn("found", found)
    d = d.withColumn("names", F.regexp_extract_all("found", F.lit(r"\[([^\]]*)\]"), F.lit(1)))
    return d.select(
        "doc_id",
        "n_sentences",
        F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join(F.array_sort(F.array_distinct("names")), ",").alias("licences"),
        F.size("names").cast("long").alias("n_matches"),
        F.array_join(F.regexp_extract_all("found", F.lit("<([^>]*)>"), F.lit(1)), ",").alias("unmatched"),
    )


#: Every known sentence has one of these words.
HINT = "(?i)licen|copyright|software|redistribut|permitted|program|under|mpl|gpl|eupl|wtfpl|mulan|apache|fuck|cddl|anyone|cc[ 0-]|any purpose"


def _oracle() -> str:
    """The same rules in DuckDB, whose patterns cannot look around: every mark is doubled, and a place takes one on each side."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    case = lambda some: " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in some.items())
    known = case({v.replace(" | ", " "): k for k, v in SENTENCES.items()})
    plainly = "regexp_replace(x, '( [SL])+ ', ' ', 'g')"
    for before, behind in _HOLDERS:
        plainly = f"regexp_replace({plainly}, '^{before}.*{behind}', '{before}*{behind}')"
    found = "array_to_string(list_transform(ids, lambda x: '<' || x || '>'), '')"
    for licence, rule in RULES:
        found = f"replace({found}, {quote(''.join(f'<{x}>' for x in rule))}, {quote(f'[{licence}]')})"
    return rf"""
WITH m AS (
  SELECT doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '{ENDS}'), lambda x: length(trim(x, ' ')) > 0)) AS n_sentences,
    regexp_replace(regexp_replace(' S ' || regexp_replace(regexp_replace(regexp_replace(lower(coalesce(text, '')), '([0-9])\+', '\1 or later', 'g'), '{MARKS}', ' S ', 'g'), '[\r\n]+', ' L ', 'g') || ' S ',
      '[^a-z0-9SL]+', ' ', 'g'), '([SL]) ', '\1 \1 ', 'g') AS marked
  FROM documents
), p AS (
  SELECT doc_id, n_sentences, list_transform(regexp_extract_all(marked, '[SL] ({_places('(?:L )*', '(?:[SL] )*')}) [SL]', 1), lambda x: {plainly}) AS places FROM m
), i AS (
  SELECT doc_id, n_sentences, coalesce(flatten(list_transform(places, lambda x: CASE WHEN starts_with(x, '{_IDENTIFIER}')
    THEN list_filter(list_transform(regexp_split_to_array(replace(substring(x, {len(_IDENTIFIER) + 1}), ' or later', '-or-later'), ' (?:or|and|with) '), lambda y: CASE y {case(_line())} END), lambda z: z IS NOT NULL)
    ELSE [CASE x {known} ELSE CASE regexp_replace(x, '^(?:{_UNDER}|the )', '') {case(_named())} END END] END)), []) AS ids FROM p
), f AS (
  SELECT *, {found} AS found FROM i
), n AS (
  SELECT *, regexp_extract_all(found, '\[([^\]]*)\]', 1) AS names FROM f
)
SELECT doc_id, CAST(n_sentences AS BIGINT) AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(list_sort(list_distinct(names)), ',') AS licences, CAST(len(names) AS BIGINT) AS n_matches,
  array_to_string(regexp_extract_all(found, '<([^>]*)>', 1), ',') AS unmatched
FROM n
"""


ORACLE = _oracle()
