"""Notices by plain cosine; inheritance against a walk up the directories."""
import math
import re
from collections import Counter

from meterflow.llm import licenses as lic


def brute_best(words, templates):
    rows = [(n, Counter(lic.tokens(t))) for n, ts in templates.items() for t in ts]
    df = Counter(w for _, c in rows for w in c)
    idf = lambda w: math.log((1 + len(rows)) / (1 + df[w])) + 1 if w in df else math.log(1 + len(rows)) + 1
    vec = lambda c: {w: (1 + math.log(n)) * idf(w) for w, n in c.items()}
    q = vec(Counter(words))
    cos = lambda a, b: sum(x * b.get(w, 0) for w, x in a.items()) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    return max(((round(cos(q, vec(c)), 12), -i, n) for i, (n, c) in enumerate(rows)))[::2]


def test_templates_find_themselves():
    t = lic.Templates.build()
    for name, texts in lic.TEMPLATES.items():
        for text in texts:
            got = t.best(lic.tokens(text))
            assert got[0] == name and abs(got[1] - 1) < 1e-9
            words = lic.tokens("see the file " + text)[:9]
            assert abs(t.best(words)[1] - brute_best(words, lic.TEMPLATES)[0]) < 1e-9


def test_notices_in_texts():
    t = lic.Templates.build()
    body = "Some prose stands here.\n" * 3
    assert lic.notices(body + "Licensed under the Apache License, Version 2.0.\n" + body, t)[0] == "Apache-2.0"
    assert lic.notices(body + "Licensed under CC BY-NC 4.0.", t)[0] == "CC-BY-NC-4.0"
    assert lic.notices("# SPDX-License-Identifier: MIT\n" + body, t)[:2] == ("MIT", 1.0)
    two = "This program is free software: you can redistribute it and/or modify it under the terms of the\nGNU General Public License as published by the Free Software Foundation, either version 3 of the License."
    assert lic.notices(body + two, t)[0] == "GPL-3.0"
    assert lic.notices(body + "A driving licence is needed for the car in the yard.", t)[0] is None
    assert lic.notices(None, t)[0] is None and lic.notices("", t)[0] is None


def test_nearest_ancestor(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    files = {"p/LICENSE": mit, "p/a/b/COPYING.txt": apache, "p/a/x.py": "code", "p/a/b/c/y.py": "code", "p/a/b/z.py": mit + "\nprint(1)\n" + "word " * 50,
             "q/x.py": "code", "p/readme.md": "text", "top.txt": "text", "pa/x.py": None, "p/a/e.txt": "", "r/about.txt": apache, "r/s/t.py": "code"}
    rows = [(i, p, t, "clash") for i, (p, t) in enumerate(files.items())] + [(99, None, "code", "c"), (100, None, mit, "c"), (3, "p/a/b/c/y.py", "code", "c")]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string, license string").repartition(3)
    got = lic.scan(df).collect()
    assert len(got) == len(rows)
    t = lic.Templates.build()
    own = {p: lic.notices(x, t) for p, x in files.items()}

    def walk(path):
        parts = path.split("/")[:-1]
        for n in range(len(parts), -1, -1):
            here = "/".join(parts[:n])
            for p, (name, _, _, share, _) in own.items():
                if name and p.rpartition("/")[0] == here and (re.search(r"(^|/)(LICENSE|COPYING)", p) or share >= lic.MAINLY):
                    return name, here
        return None, None
    for r in got:
        if r.path is None:
            assert (r.license, r.via) == (("MIT", "own") if r.doc_id == 100 else (None, "none"))
        elif own[r.path][0]:
            assert (r.license, r.via, r.inherited_from) == (own[r.path][0], "own", None)
        else:
            name, here = walk(r.path)
            assert (r.license, r.inherited_from, r.via) == (name, here, "inherited" if name else "none"), r
    assert {r.path: r.license for r in got}["r/s/t.py"] == "Apache-2.0"
    assert lic.scan(df.limit(0)).count() == 0


def test_notices_amid_other_text():
    t = lic.Templates.build()
    prose = "the harvest came early that year and every cart on the road was full of apples while boats waited below the mill " * 40
    for name, texts in lic.TEMPLATES.items():
        for text in texts:
            for spot in (prose + text + " " + prose, "one two three " + text + " four five six", prose[:60] + text.replace(", ", ",\n") + "\n" + prose):
                got = lic.notices(spot, t)
                assert got[0] == name and got[1] > 0.99 and (got[3] < 0.1 or len(spot) < 2000), (name, spot[:200], got)
    footer = "Copyright (c) 2020 Acme Corp. All rights reserved."
    assert lic.notices(prose + footer + " " + prose, t)[0] == lic.notices(footer, t)[0] == "LicenseRef-Proprietary"
    assert lic.notices(footer + " Licensed under the Apache License, Version 2.0.", t)[0] == "Apache-2.0"
    assert lic.notices(prose + "this tool is distributed under the MIT License, " + prose, t)[0] == "MIT"
    for other in ("all rights and duties of the tenants are listed below ", "we ask for permission to use the source of this river ",
                  "a licence under the law of the harbour is needed ", "licensed under the Foo License by its makers "):
        assert lic.notices(prose + other + prose, t)[0] is None
    assert lic.notices("\u0130stanbul \u0130zmir " + footer, t)[2] == "All rights reserved"


def test_expressions_full_texts_and_several_notices(spark):
    t = lic.Templates.build()
    name = lambda x: lic.notices(x, t)[0]
    every = lambda x: lic.notices(x, t)[4]
    assert name("// SPDX-License-Identifier: MIT OR Apache-2.0\ncode") == "MIT OR Apache-2.0" and every("# SPDX-License-Identifier: MIT OR Apache-2.0") == ["MIT", "Apache-2.0"]
    assert name("SPDX-License-Identifier: (MIT AND BSD-3-Clause)") == "MIT AND BSD-3-Clause"
    assert name("/* SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note */") == "GPL-2.0 WITH Linux-syscall-note"
    assert every("SPDX-License-Identifier: (GPL-2.0 WITH Linux-syscall-note) OR MIT)") == ["GPL-2.0", "MIT"]
    assert name(lic.TEMPLATES["LGPL-2.1"][0]) == "LGPL-2.1" and name(lic.TEMPLATES["GPL-3.0"][0]) == "GPL-3.0"
    for x in ("ISC", "BSL-1.0", "EPL-2.0", "0BSD"):
        assert name("Some words before it. " + lic.TEMPLATES[x][0] + " And after it.") == x
    both = lic.TEMPLATES["Apache-2.0"][0] + "\nPlain words about the project.\n" + lic.TEMPLATES["MIT"][1]
    assert every(both) == ["Apache-2.0", "MIT"]
    for x, text in lic.FULL_TEXTS.items():
        found = lic.notices(f"The {x} thing\nCopyright (c) 2021 Somebody Else\n\n" + text, t)
        assert found[0] == x and found[3] == 1.0
    assert lic.notices(lic.FULL_TEXTS["MIT"] + " unlike words" * 400, t)[3] < 0.5
    files = spark.createDataFrame([(1, "a/terms.txt", lic.FULL_TEXTS["ISC"]), (2, "a/b/code.c", "int x;"), (3, "c/code.c", "int y;")], "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.via, r.inherited_from, r.licenses) for r in lic.scan(files).collect()}
    assert got == {1: ("ISC", "own", None, ["ISC"]), 2: ("ISC", "inherited", "a", []), 3: (None, "none", None, [])}
