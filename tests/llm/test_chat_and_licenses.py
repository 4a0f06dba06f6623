import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_harness import compare, duck  # noqa: E402

from seisflow.llm import chat, licenses
from seisflow.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_with_sql(spark, name):
    problems, _ = compare(spark, name, QUERIES[name], ORACLE[name], SF, duck(SF))
    assert not problems


def plan_text(df):
    return df._jdf.queryExecution().toString()


def test_native_plans(spark):
    for name in ("op1_license_scan", "op8_chat_windows"):
        text = plan_text(QUERIES[name](spark, SF))
        assert not any(x in text for x in ("Python", "Pandas", "Arrow"))
    assert plan_text(QUERIES["op8_chat_windows"](spark, SF)).split("== Physical Plan ==")[1].count("hashpartitioning") == 1
    assert "hashpartitioning" not in plan_text(QUERIES["op1_license_scan"](spark, SF))


TURNS = "conv_id long, turn long, role string, text string"


def test_windows_hold_turns_history_and_targets_once(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, i, "user" if i % 2 else "assistant", f"turn {i} " * 20) for i in range(1, 40)]
    made = chat.format_conversations(spark.createDataFrame(rows, TURNS), budget=200, history=60).orderBy("window").collect()
    assert len(made) > 5
    read = spark.createDataFrame(made).select("window", chat.read_turns(F.col("formatted")).alias("t"), "n_repeated",
                                              chat.read_loss(F.col("formatted"), F.col("loss")).alias("loss")).orderBy("window").collect()
    fresh = [(t.role, t.text) for r in read for t in r.t[r.n_repeated:]]
    assert fresh == [(r, t) for _, _, r, t in rows]
    assert [x for r in read for x in r.loss] == [t for _, _, r, t in rows if r == "assistant"]
    for r in read[1:]:
        assert r.t[0].role == "system" and r.n_repeated >= 1
        tokens = lambda ts: sum(-(-len(t.text) // chat.CHARS_PER_TOKEN) + chat.TURN_TOKENS for t in ts)
        assert tokens(r.t) <= 200 and tokens(r.t[1:r.n_repeated]) <= 60


def test_control_strings_come_back(spark):
    texts = ["<|user|>\n<|end|>\n", "&lt; &amp;lt; [INST]", "a|>\nb", "", None, "é\n\n"]
    rows = [(None, i if i else None, r, t) for i, (t, r) in enumerate(zip(texts, ["user", "assistant", "a|b\n<c>", None, "assistant", "system"]))]
    made = chat.format_conversations(spark.createDataFrame(rows, TURNS))
    assert made.where("formatted like '%[INST]%'").count() == 0
    turns = made.select(F.explode(F.filter(chat.read_turns(F.col("formatted")), lambda _, i: i >= F.col("n_repeated"))).alias("t")).select("t.*").collect()
    assert [(t.role, t.text) for t in turns] == [(r or "", t or "") for _, _, r, t in rows]


def test_chat_edges(spark):
    assert [r.conv_id for r in chat.chat_digests(spark.createDataFrame([], TURNS)).collect()] == [-7]
    one = chat.format_conversations(spark.createDataFrame([(1, 0, "system", "x"), (1, 0, "system", "x")], TURNS)).collect()
    assert len(one) == 1 and one[0].loss == [] and one[0].n_repeated == 0
    extra = spark.createDataFrame([(1, 0, "user", "x", 5, "y")], TURNS + ", tokens int, bucket string")
    assert chat.format_conversations(extra).count() == 1


def test_license_rules(frame):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    rows = [(1, mit), (2, "Released under the MIT License. All rights reserved."), (3, "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
            (4, None), (5, ""), (6, "x\nLicensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.\nlicensed under the apache license, version 2.0")]
    got = {r.doc_id: (r.licenses, r.unmatched) for r in licenses.license_rows(frame(rows)).collect()}
    assert got == {1: ("MIT", ""), 2: ("MIT,Proprietary", ""), 3: ("", "BSD_SOURCE"), 4: ("", ""), 5: ("", ""), 6: ("Apache-2.0,CC-BY-NC-4.0", "")}


def test_licenses_as_they_are_wrapped(frame):
    mit = ('Copyright (c) 2020 A\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\n'
           "in the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\n"
           "furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\nTHE SOFTWARE IS")
    gpl = ("This program is free software{0} you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation{0} either version {1} of the License, or\n(at your option) any later version.\n\n"
           "This program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details.")
    bsd = ("Copyright (c) 2001, A\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n"
           "1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n2{0} Redistributions in binary form must reproduce the above copyright notice,\n"
           "   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n\n")
    names = "3. Neither the name of Example Labs, Inc nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n"
    apache = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless'
    texts = {mit: "MIT", mit.replace("\n", "\r\n"): "MIT", "\n".join(f" * {x}" for x in mit.split("\n")): "MIT", gpl.format(",", 3): "GPL-3.0-or-later", gpl.format(";", 2): "GPL-2.0-or-later",
             bsd.format("."): "BSD-2-Clause", bsd.format(")") + names: "BSD-3-Clause", apache: "Apache-2.0", "x. This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy": "MPL-2.0",
             "Licensed under the\n\nMIT License": "", "Licensed under the Apache. License Version 2.0": "", "not licensed under the MIT license": "", "licensed under the MIT license now": ""}
    got = {r.doc_id: r for r in licenses.license_rows(frame(list(enumerate(texts)))).collect()}
    assert [got[i].licenses for i in range(len(texts))] == list(texts.values())
    assert got[7].sentence_ids == "APACHE2_THE_LICENSE,APACHE2_COMPLY"
    assert {r.unmatched for r in got.values()} == {""}


def test_no_license_sentence_ends_or_lies_in_another():
    known = list(licenses._sentences())
    assert not [(a, b) for a in known for b in known if a != b and f" {a} " in f" {b} " and not b.startswith(a)]


def test_license_edges(frame, odd):
    assert licenses.license_rows(frame([])).count() == 0
    assert licenses.scan_licenses(odd).where("size(licenses) = 0").count() == odd.count()
