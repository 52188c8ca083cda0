"""Licence scans by sentence rules, in DataFrame functions only.

A text is cut into sentences, each sentence is normalised (lower case, only
letters, digits and single spaces) and looked up among the known licence
sentences, a fixed list below. The identifiers found in a document, in their
order, are matched against ordered rules: a rule is a sequence of sentence
identifiers that must follow one another (other sentences may lie between).
Where rules overlap, the one listed first wins its sentences.

The list of sentences and rules is part of the code, so its broadcast is
bounded. Only sentences that are known leave the scan; per document they are
grouped as (place, identifier) pairs.

Defined results: null and empty texts, and texts without a known sentence,
give no row. Repeated rows are scanned as one text each and give equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Normalised sentences of public licence texts and notices,
#: with the identifier each stands for.
SENTENCES = {
    "mit.grant": "permission is hereby granted free of charge to any person obtaining a copy of this software "
                 "and associated documentation files the software to deal in the software without restriction "
                 "including without limitation the rights to use copy modify merge publish distribute sublicense "
                 "and or sell copies of the software and to permit persons to whom the software is furnished to do "
                 "so subject to the following conditions",
    "mit.notice": "the above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the software",
    "mit.short": "released under the mit license",
    "mit.short2": "licensed under the mit license",
    "mit.short3": "this project is licensed under the mit license",
    "apache.short": "licensed under the apache license version 2 0",
    "apache.header": "licensed under the apache license version 2 0 the license",
    "apache.use": "you may not use this file except in compliance with the license",
    "apache.copy": "you may obtain a copy of the license at",
    "apache.asis": "unless required by applicable law or agreed to in writing software distributed under the license "
                   "is distributed on an as is basis without warranties or conditions of any kind either express or "
                   "implied",
    "gpl3.short": "this work is licensed under the gnu general public license version 3",
    "gpl2.short": "this work is licensed under the gnu general public license version 2",
    # the notices' own marks (: and ;) cut them into these pieces ...
    "gpl.program": "this program is free software",
    "gpl3.redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license as "
                         "published by the free software foundation either version 3 of the license or at your option "
                         "any later version",
    "gpl2.redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license as "
                         "published by the free software foundation either version 2 of the license or at your option "
                         "any later version",
    "gpl.redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license as "
                        "published by the free software foundation",
    "gpl3.either": "either version 3 of the license or at your option any later version",
    "gpl2.either": "either version 2 of the license or at your option any later version",
    "gpl.useful": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl.implied": "without even the implied warranty of merchantability or fitness for a particular purpose",
    # ... and with commas in their places they stay whole
    "gpl.free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                "general public license as published by the free software foundation either version 3 of the "
                "license or at your option any later version",
    "gpl2.free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                 "general public license as published by the free software foundation either version 2 of the "
                 "license or at your option any later version",
    "gpl.warranty": "this program is distributed in the hope that it will be useful but without any warranty without "
                    "even the implied warranty of merchantability or fitness for a particular purpose",
    "bsd.redistribute": "redistribution and use in source and binary forms with or without modification are permitted "
                        "provided that the following conditions are met",
    "bsd.source": "redistributions of source code must retain the above copyright notice this list of conditions and "
                  "the following disclaimer",
    "bsd.endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                   "or promote products derived from this software without specific prior written permission",
    "ccbync4.short": "licensed under cc by nc 4 0",
    "ccby4.short": "licensed under cc by 4 0",
    "ccbysa4.short": "licensed under cc by sa 4 0",
    "ccby4.long": "this work is licensed under the creative commons attribution 4 0 international license",
    "cc0.short": "this work is dedicated to the public domain under cc0 1 0",
    "mpl2.short": "this source code form is subject to the terms of the mozilla public license v",
    "unlicense.short": "this is free and unencumbered software released into the public domain",
    "lgpl.library": "this library is free software",
    "lgpl.redistribute": "you can redistribute it and or modify it under the terms of the gnu lesser general public "
                         "license as published by the free software foundation",
    "lgpl2.either": "either version 2 1 of the license or at your option any later version",
    "lgpl.useful": "this library is distributed in the hope that it will be useful but without any warranty",
    "agpl.redistribute": "you can redistribute it and or modify it under the terms of the gnu affero general public license "
                         "as published by the free software foundation either version 3 of the license or at your "
                         "option any later version",
    "zlib.asis": "this software is provided as is without any express or implied warranty",
    "zlib.grant": "permission is granted to anyone to use this software for any purpose including commercial applications "
                  "and to alter it and redistribute it freely subject to the following restrictions",
    "boost.short": "distributed under the boost software license version 1 0",
    "epl2.header": "this program and the accompanying materials are made available under the terms of the eclipse public "
                   "license 2 0 which is available at https www eclipse org legal epl 2 0",
    "ccbysa4.long": "this work is licensed under the creative commons attribution sharealike 4 0 international license",
    "ccbync4.long": "this work is licensed under the creative commons attribution noncommercial 4 0 international license",
    "ccbynd4.long": "this work is licensed under the creative commons attribution noderivatives 4 0 international license",
    "ccbyncsa4.long": "this work is licensed under the creative commons attribution noncommercial sharealike 4 0 "
                      "international license",
    "isc.grant": "permission to use copy modify and or distribute this software for any purpose with or without fee "
                 "is hereby granted provided that the above copyright notice and this permission notice appear in "
                 "all copies",
}

#: Licence and the sentence identifiers that name it, in order
#: of precedence (longer rules before the shorter ones they contain).
RULES = [
    ("MIT", ["mit.grant", "mit.notice"]),
    ("Apache-2.0", ["apache.header", "apache.use", "apache.copy", "apache.asis"]),
    *((name, [*grant, *warranty])
      for name, whole, pieces in (("GPL-3.0-or-later", "gpl.free", "gpl3"), ("GPL-2.0-or-later", "gpl2.free", "gpl2"))
      for grant in (["gpl.program", f"{pieces}.redistribute"],
                    ["gpl.program", "gpl.redistribute", f"{pieces}.either"], [whole])
      for warranty in (["gpl.useful", "gpl.implied"], ["gpl.warranty"])),
    ("BSD-3-Clause", ["bsd.redistribute", "bsd.source", "bsd.endorse"]),
    ("BSD-2-Clause", ["bsd.redistribute", "bsd.source"]),
    ("MIT", ["mit.short"]),
    ("MIT", ["mit.short2"]),
    ("MIT", ["mit.short3"]),
    ("Apache-2.0", ["apache.short"]),
    ("Apache-2.0", ["apache.header"]),
    ("GPL-3.0-only", ["gpl3.short"]),
    ("GPL-2.0-only", ["gpl2.short"]),
    ("CC-BY-NC-4.0", ["ccbync4.short"]),
    ("CC-BY-SA-4.0", ["ccbysa4.short"]),
    ("CC-BY-4.0", ["ccby4.short"]),
    ("CC-BY-4.0", ["ccby4.long"]),
    ("CC0-1.0", ["cc0.short"]),
    ("MPL-2.0", ["mpl2.short"]),
    ("Unlicense", ["unlicense.short"]),
    ("ISC", ["isc.grant"]),
    ("LGPL-2.1-or-later", ["lgpl.library", "lgpl.redistribute", "lgpl2.either", "lgpl.useful", "gpl.implied"]),
    ("LGPL-3.0-or-later", ["lgpl.library", "lgpl.redistribute", "gpl3.either", "lgpl.useful", "gpl.implied"]),
    ("AGPL-3.0-or-later", ["gpl.program", "agpl.redistribute", "gpl.useful", "gpl.implied"]),
    ("Zlib", ["zlib.asis", "zlib.grant"]),
    ("BSL-1.0", ["boost.short"]),
    ("EPL-2.0", ["epl2.header"]),
    ("CC-BY-SA-4.0", ["ccbysa4.long"]),
    ("CC-BY-NC-4.0", ["ccbync4.long"]),
    ("CC-BY-ND-4.0", ["ccbynd4.long"]),
    ("CC-BY-NC-SA-4.0", ["ccbyncsa4.long"]),
]

#: A sentence ends at a line break between blank lines, or at . ! ? : ; before
#: white space; a single line break inside a sentence is a space.
BREAK = r"(?<=[.!?:;])\s+|\n\s*\n"
#: Words that every known sentence has at least one of; a cheap first filter.
HINT = r"(?i)licen[sc]e|permission|redistribut|warranty|public\s+domain|endorse|free\s+software"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def known_sentences(docs: DataFrame) -> DataFrame:
    """``row_key, doc_id, place, sentence_id`` for each known sentence, also
    where a line holds it alone without a full stop."""
    spark = docs.sparkSession
    known = spark.createDataFrame(list(SENTENCES.items()), "sentence_id string, sentence string")
    # the key is made before the texts are exploded, one for each row
    hinted = (docs.select("doc_id", "text").where(F.col("text").rlike(HINT))
              .withColumn("row_key", F.monotonically_increasing_id()))
    # each sentence as it stands and, where it spans lines, its single lines
    parts = hinted.select(
        "row_key", "doc_id",
        F.posexplode(F.transform(F.split("text", BREAK), lambda s: F.array_distinct(
            F.concat(F.array(F.regexp_replace(s, r"\s+", " ")), F.split(s, r"\n"))))).alias("place", "forms"))
    forms = parts.select("row_key", "doc_id", "place", F.posexplode("forms").alias("line", "form"))
    return (forms.where(F.col("form").rlike(HINT))
            .withColumn("sentence", normalised(F.col("form"))).join(F.broadcast(known), "sentence")
            .select("row_key", "doc_id", "place", "line", "sentence_id"))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, license, rule, n_matches`` for each licence of each document
    of ``docs`` (``doc_id, text``)."""
    ids = list(SENTENCES)
    found = known_sentences(docs).groupBy("row_key", "doc_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "line", "sentence_id"))),
                    lambda s: s["sentence_id"]).alias("sequence"))
    # one character per identifier, so that a rule is a pattern over a string
    letter = {s: chr(0x100 + k) for k, s in enumerate(ids)}
    code = F.create_map(*[F.lit(x) for pair in letter.items() for x in pair])
    coded = F.array_join(F.transform("sequence", lambda s: code[s]), "")
    rows = found.withColumn("left", coded)
    for k, (_, sequence) in enumerate(RULES):
        # other sentences may lie between, so they stay for the rules below
        pattern = "([^{0}]*)".join(letter[s] for s in sequence).replace("{0}", letter[sequence[0]])
        kept = "".join(f"${i + 1}" for i in range(len(sequence) - 1))
        rows = rows.withColumn(f"n{k}", F.regexp_count("left", F.lit(pattern)))
        rows = rows.withColumn("left", F.regexp_replace("left", pattern, kept))
    hits = F.array(*(F.struct(F.lit(name).alias("license"), F.lit("+".join(seq)).alias("rule"),
                              F.col(f"n{k}").cast("long").alias("n_matches"))
                     for k, (name, seq) in enumerate(RULES)))
    return (rows.select("doc_id", F.explode(F.filter(hits, lambda h: h["n_matches"] > 0)).alias("h"))
            .select("doc_id", "h.license", "h.rule", "h.n_matches"))
