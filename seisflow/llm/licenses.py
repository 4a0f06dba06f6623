"""Licence scans (1) by sentence rules, in DataFrame functions only.

A text is normalised (ASCII lower case, runs of other characters as one blank). A known sentence may begin and end
at a line end, after ``. ! ?`` and a blank, at ``; :`` and after a bracketed bullet. It may run on over all of these
(texts are wrapped, and a header may be one line), but not over a line without words, nor over an end mark that no
digit follows (``v. 2.0``); of two that begin at one place the longer is found. Each is mapped to an identifier. The
identifiers of a document, in order, are matched against ordered rules: the first rule takes the runs
it matches out of the sequence, then the next rule looks at what is left. Identifiers that no rule takes
are reported as ``unmatched``.

Everything happens inside the row, against constants: no shuffle, and a text of any length or a
source of any size stays where it was read.

Defined results: a null or empty text, or one without known sentences, has no licences (empty
strings); a licence found several times is named once, in rule order; repeated rows are each scanned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Normalised sentences of public licences and notices, by identifier.
SENTENCES = {
    "MIT_NOTICE": "released under the mit license",
    "MIT_LICENSED": "licensed under the mit license",
    "MIT_GRANT": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "MIT_KEEP": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "APACHE2_NOTICE": "licensed under the apache license version 2 0",
    "APACHE2_THE_LICENSE": "licensed under the apache license version 2 0 the license",
    "APACHE2_COMPLY": "you may not use this file except in compliance with the license",
    "APACHE2_COPY": "you may obtain a copy of the license at",
    "GPL3_NOTICE": "this work is licensed under the gnu general public license version 3",
    "GPL2_NOTICE": "this work is licensed under the gnu general public license version 2",
    "GPL_FREE": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "GPL_HOPE": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "LGPL3_NOTICE": "this work is licensed under the gnu lesser general public license version 3",
    "CC_BY_4": "licensed under cc by 4 0",
    "CC_BY_SA_4": "licensed under cc by sa 4 0",
    "CC_BY_NC_4": "licensed under cc by nc 4 0",
    "CC0": "licensed under cc0 1 0",
    "BSD_NOTICE": "released under the bsd license",
    "BSD_USE": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "BSD_SOURCE": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "BSD_BINARY": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "MPL2_NOTICE": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "PUBLIC_DOMAIN": "this work is in the public domain",
    "ALL_RIGHTS": "all rights reserved",
}

# Rules in the order they are tried; longer sequences come before their parts.
RULES = [
    ("MIT", ["MIT_GRANT", "MIT_KEEP"]),
    ("MIT", ["MIT_NOTICE"]),
    ("MIT", ["MIT_LICENSED"]),
    ("Apache-2.0", ["APACHE2_THE_LICENSE", "APACHE2_COMPLY", "APACHE2_COPY"]),
    ("Apache-2.0", ["APACHE2_THE_LICENSE", "APACHE2_COMPLY"]),
    ("Apache-2.0", ["APACHE2_NOTICE"]),
    ("Apache-2.0", ["APACHE2_THE_LICENSE"]),
    ("GPL-3.0-or-later", ["GPL_FREE", "GPL_HOPE"]),
    ("GPL-3.0-or-later", ["GPL_FREE"]),
    ("GPL-3.0", ["GPL3_NOTICE"]),
    ("GPL-2.0", ["GPL2_NOTICE"]),
    ("LGPL-3.0", ["LGPL3_NOTICE"]),
    ("CC-BY-NC-4.0", ["CC_BY_NC_4"]),
    ("CC-BY-SA-4.0", ["CC_BY_SA_4"]),
    ("CC-BY-4.0", ["CC_BY_4"]),
    ("CC0-1.0", ["CC0"]),
    ("BSD-2-Clause", ["BSD_USE", "BSD_SOURCE", "BSD_BINARY"]),
    ("BSD", ["BSD_NOTICE"]),
    ("MPL-2.0", ["MPL2_NOTICE"]),
    ("Public-Domain", ["PUBLIC_DOMAIN"]),
    ("Proprietary", ["ALL_RIGHTS"]),
]

# What the SQL below does not know. Further wordings, and rules that are tried before the others.
MORE_SENTENCES = {
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "APACHE2_COPY",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "APACHE2_COPY",
    SENTENCES["GPL_FREE"].replace("version 3", "version 2"): "GPL2_FREE",
    SENTENCES["GPL_FREE"].replace("gnu general", "gnu affero general"): "AGPL3_FREE",
    **{SENTENCES["GPL_FREE"].replace("this program", f"this {what}").replace("gnu general", "gnu lesser general").replace("version 3", f"version {v}"): i
       for what in ("program", "library") for v, i in (("3", "LGPL3_FREE"), ("2 1", "LGPL21_FREE"))},
    SENTENCES["GPL_HOPE"].replace("this program", "this library"): "GPL_HOPE",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSD_NAMES",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISC_GRANT",
    "this is free and unencumbered software released into the public domain": "UNLICENSE",
}
MORE_RULES = [
    ("BSD-3-Clause", ["ALL_RIGHTS", "BSD_USE", "BSD_SOURCE", "BSD_BINARY", "BSD_NAMES"]),
    ("BSD-3-Clause", ["BSD_USE", "BSD_SOURCE", "BSD_BINARY", "BSD_NAMES"]),
    ("BSD-2-Clause", ["ALL_RIGHTS", "BSD_USE", "BSD_SOURCE", "BSD_BINARY"]),
    *[(name, ids) for name, first in (("AGPL-3.0-or-later", "AGPL3_FREE"), ("LGPL-3.0-or-later", "LGPL3_FREE"), ("LGPL-2.1-or-later", "LGPL21_FREE"), ("GPL-2.0-or-later", "GPL2_FREE"))
      for ids in ([first, "GPL_HOPE"], [first])],
    ("ISC", ["ISC_GRANT"]),
    ("Unlicense", ["UNLICENSE"]),
]
# The holder's name stands in this one.
_HOLDER, _ANY_HOLDER = "of the copyright holder nor the names of its ", "of (?:[a-z0-9]+ ){1,20}nor the names of (?:its|the|their) "

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Marks, in order; upper case is free after folding: H ends a sentence, S may end one or be run over.
_MARKS = [
    (r"[.!?][ \t\n\r\f]++(?![0-9])", "H"),
    (r"\n(?:[^a-z0-9HS\n]*+\n)++", "H"),
    (r"[;:\n]|\)[ \t]|[.!?][ \t\r\f]", "S"),
    ("[^a-z0-9HS]+", " "),
    ("[ S]*+H[ HS]*+", "H"),
    (" *+S[ S]*+", "S"),
]


def _sequence(ids: list[str]) -> str:
    return "".join(f"<{i}>" for i in ids)


def _sentences() -> dict[str, str]:
    """Identifiers by sentence, the longer sentences first."""
    return dict(sorted([*((s, i) for i, s in SENTENCES.items()), *MORE_SENTENCES.items()], key=lambda x: -len(x[0])))


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    cut = F.translate(text, _UPPER, _LOWER)
    for pattern, mark in _MARKS:
        cut = F.regexp_replace(cut, pattern, mark)
    ids = _sentences()
    wanted = "|".join(s.replace(_HOLDER, _ANY_HOLDER).replace(" ", "[ S]") for s in ids)
    found = F.regexp_extract_all(F.concat(F.lit("H"), F.trim(cut), F.lit("H")), F.lit(f"(?<=[HS])(?:{wanted})(?=[HS])"), F.lit(0))
    known = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])
    return F.transform(found, lambda s: F.try_element_at(known, F.regexp_replace(F.translate(s, "S", " "), _ANY_HOLDER, _HOLDER)))


def apply_rules(ids: Column) -> Column:
    """struct(left, found): what no rule took, and the licences found, in rule order."""
    rules = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(_sequence(s)).alias("take")) for n, s in [*MORE_RULES, *RULES]])
    start = F.struct(F.array_join(F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "").alias("left"),
                     F.array().cast("array<string>").alias("found"))

    def step(acc: Column, rule: Column) -> Column:
        return F.struct(F.replace(acc["left"], rule["take"], F.lit("|")).alias("left"),
                        F.when(F.contains(acc["left"], rule["take"]), F.array_union(acc["found"], F.array(rule["name"]))).otherwise(acc["found"]).alias("found"))

    return F.when(F.size(ids) > 0, F.aggregate(rules, start, step))


def scan_licenses(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``sentence_ids`` (array), ``licenses`` (array) and ``unmatched`` (identifiers that no rule took)."""
    found = docs.withColumn("sentence_ids", sentence_ids(F.coalesce(F.col(text_col), F.lit("")))).withColumn("__found", apply_rules(F.col("sentence_ids")))
    left = F.coalesce(F.col("__found.left"), F.lit(""))
    return (found.withColumn("licenses", F.coalesce(F.col("__found.found"), F.array().cast("array<string>")))
            .withColumn("unmatched", F.regexp_extract_all(left, F.lit("<([A-Z0-9_]+)>"), F.lit(1))).drop("__found"))


def license_rows(docs: DataFrame) -> DataFrame:
    """One row per document."""
    found = scan_licenses(docs.select("doc_id", "text"))
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.array_join("sentence_ids", ",").alias("sentence_ids"),
                        F.size("sentence_ids").cast("long").alias("n_sentences"), F.array_join("unmatched", ",").alias("unmatched"))


def oracle() -> str:
    """SQL for texts with one sentence a line or after an end mark, of the first tables: sentences unnested and joined, rules applied one by one."""
    known = ", ".join(f"('{s}', '{i}')" for i, s in SENTENCES.items())
    sql = [f"""WITH known(sentence, id) AS (VALUES {known}),
docs AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (SELECT k, unnest(l) AS s, generate_subscripts(l, 1) AS pos FROM (SELECT k, string_split(regexp_replace(translate(text, '{_UPPER}', '{_LOWER}'), '([.!?])[ \\t\\n\\r\\f]+', '\\1' || chr(10), 'g'), chr(10)) AS l FROM docs)),
hit AS (SELECT k, pos, id FROM cut JOIN known ON trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')) = sentence),
seq AS (SELECT k, string_agg(id, ',' ORDER BY pos) AS ids, count(*) AS n, string_agg('<' || id || '>', '' ORDER BY pos) AS left0 FROM hit GROUP BY k)"""]
    for i, (_, ids) in enumerate(RULES):
        take = _sequence(ids)
        sql.append(f"r{i} AS (SELECT *, contains(left{i}, '{take}') AS h{i}, replace(left{i}, '{take}', '|') AS left{i + 1} FROM {'seq' if not i else f'r{i - 1}'})")
    names = dict.fromkeys(n for n, _ in RULES)
    any_of = [f"CASE WHEN {' OR '.join(f'h{i}' for i, (m, _) in enumerate(RULES) if m == n)} THEN '{n}' END" for n in names]
    last = len(RULES)
    return ",\n".join(sql) + f"""
SELECT d.doc_id, coalesce(concat_ws(',', {', '.join(any_of)}), '') AS licenses, coalesce(ids, '') AS sentence_ids,
 coalesce(n, 0)::BIGINT AS n_sentences, coalesce(array_to_string(regexp_extract_all(left{last}, '<([A-Z0-9_]+)>', 1), ','), '') AS unmatched
FROM docs d LEFT JOIN r{last - 1} USING (k)"""
