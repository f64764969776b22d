"""License scans (operator 2): sentence-rule recognition with built-in expressions only.

A text is cut at line ends and sentence ends and normalised (ASCII lower case, other characters than letters and digits as one
space). A known licence sentence is found where it begins and ends at such cuts; it may go over further cuts, as in hard-wrapped
notices, but not over a blank line. What is found is written as one character for each sentence, other lines and sentences as
"-", blank ones and bare list numbers as nothing; ordered rules are matched against that string, longer rules before shorter ones, leftmost first.

Defined cases: null or empty text has no licence; repeated rows each get a row; a null id stays;
further columns are ignored.
"""

from __future__ import annotations

import re
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text

#: Licence sentences as normalised, under identifiers; sentences that say the same share one.
SENTENCES = {
    "A": ("released under the mit license", "this work is licensed under the mit license", "licensed under the mit license", "mit license", "the mit license", "the mit license mit"),
    "B": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",),
    "C": ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",),
    "D": ("licensed under the apache license version 2 0", "released under the apache license version 2 0", "this work is licensed under the apache license version 2 0", "apache license version 2 0 january 2004"),
    "E": ("licensed under the apache license version 2 0 the license",),
    "F": ("you may not use this file except in compliance with the license",),
    "G": ("you may obtain a copy of the license at",),
    "H": ("this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "released under the gnu general public license version 3"),
    "I": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "J": ("licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    "K": ("licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"),
    "L": ("licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    "M": ("all rights reserved",),
    "N": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "O": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",),
    "P": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",),
    "Q": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
    "R": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",),
    "S": ("this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2", "released under the gnu general public license version 2"),
    "T": ("this is free and unencumbered software released into the public domain",),
    "U": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "V": ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",),
    "W": ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",),
    "X": ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "Y": ("this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "Z": ("permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",),
    "\u0393": ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at",),
    "\u0394": ("to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",),
}
#: Ordered rules: the identifiers' sequence, in which any unknown sentences may stand where "*" is, and the licence it means. A notice of all
#: rights just before a licence's conditions is part of it.
RULES = (
    ("A*B*C", "MIT"), ("B*C", "MIT"), ("D*E*F*G", "Apache-2.0"), ("E*F*G", "Apache-2.0"), ("MN*U*V*O", "BSD-3-Clause"), ("N*U*V*O", "BSD-3-Clause"), ("MN*U*V", "BSD-2-Clause"), ("N*U*V", "BSD-2-Clause"), ("N*O", "BSD-3-Clause"),
    ("A", "MIT"), ("B", "MIT"), ("D", "Apache-2.0"), ("E", "Apache-2.0"), ("H", "GPL-3.0"), ("I", "GPL-3.0-or-later"), ("J", "CC-BY-NC-4.0"), ("K", "CC-BY-4.0"), ("L", "CC-BY-SA-4.0"), ("N", "BSD-2-Clause"), ("P", "ISC"), ("Q", "MPL-2.0"),
    ("R", "GPL-2.0-or-later"), ("S", "GPL-2.0"), ("T", "Unlicense"), ("W", "LGPL-2.1-or-later"), ("X", "LGPL-3.0-or-later"), ("Y", "AGPL-3.0-or-later"), ("Z", "BSL-1.0"), ("\u0393", "EPL-2.0"), ("\u0394", "CC0-1.0"), ("M", "All-Rights-Reserved"),
)


def _words(text: str) -> str:
    return re.sub("[^a-z0-9]+", " ", text.lower()).strip()


def known_sentences() -> list[tuple[str, str]]:
    """(sentence, identifier): the table above, and for each licence that an identifier alone means, its SPDX line."""
    alone = {name: mark for mark, name in reversed(RULES) if len(mark) == 1 and mark != "M"}
    return [(s, mark) for mark, some in SENTENCES.items() for s in some] + [(f"spdx license identifier {_words(name)}", mark) for name, mark in alone.items()]


BREAK = r"[.!?;:][ \t]+\n?|\n"
#: Each sentence above holds one of these, so a text without any has none of them and isn't cut.
ANCHOR = "(?i)licens|permission|redistribut|unencumbered|copyright|rights reserved"
MATCH = "|".join(rule.replace("*", "-*") for rule, _ in RULES)


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_known, licenses, matched): licences in the order of the text, comma-joined, each as often as it is
    found; matched is what stood for each, unknown sentences left out."""
    rows = id_and_text(docs, id_col, text_col)
    lines = F.when(F.col("text").rlike(ANCHOR), F.regexp_replace("text", BREAK, "\n")).otherwise("")
    lines = F.regexp_replace(F.regexp_replace(F.lower(lines), "[^a-z0-9\n]+", " "), "(?m)^ +| +$", "")
    # the longest first, as one may begin with another
    for mark, some in groupby(sorted(known_sentences(), key=lambda x: -len(x[0])), key=lambda x: x[1]):
        either = "|".join(sentence.replace(" ", "[ \n]") for sentence, _ in some)
        lines = F.regexp_replace(lines, f"(?m)^(?:{either})$", mark)
    lines = F.regexp_replace(lines, "(?m)^[0-9]{1,2}$", "")
    marks = F.regexp_replace(F.regexp_replace(lines, "(?m)^(?![A-Z\u0391-\u03a9]$).+$", "-"), "\n", "")
    rows = rows.select("doc_id", marks.alias("_marks"))
    found = F.transform(F.expr(f"regexp_extract_all(_marks, '{MATCH}', 0)"), lambda m: F.replace(m, F.lit("-"), F.lit("")))
    names = F.create_map(*[F.lit(x) for rule, name in RULES for x in (rule.replace("*", ""), name)])
    rows = rows.withColumns({"n_known": F.length(F.replace("_marks", F.lit("-"), F.lit(""))).cast("long"), "_found": found})
    return rows.select("doc_id", "n_known", F.array_join(F.transform("_found", lambda m: F.element_at(names, m)), ",").alias("licenses"), F.array_join("_found", ",").alias("matched"))
