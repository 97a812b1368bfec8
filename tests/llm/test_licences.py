import random
import re

from helpers_llm import DOCS, SF01
from interlens.llm import licences as lc

WORDS = re.compile(r"[A-Za-z0-9\u0080-\U0010ffff]+")


def bigrams(t):
    w = [x.lower() if x.isascii() else "".join(c.lower() if c.isascii() else c for c in x) for x in WORDS.findall(t)]
    return set(zip(w, w[1:]))


def brute(text, threshold=0.8):
    t = text or ""
    spans = {(m.start(), m.end()) for m in re.finditer(r"[^\n]+", t)}
    spans |= {(m.start(), m.end()) for m in re.finditer(r"[^\n]+(?:\n[^\n]+)*", t)}
    out = []
    for a, b in sorted(spans):
        s, best = bigrams(t[a:b]), (0.0, None)
        table = [(len(bigrams(x)), k, name, x) for k, (name, x) in
                 enumerate((n, x) for n, xs in lc.TEMPLATES.items() for x in xs)]
        for size, _, name, x in sorted(table, key=lambda r: (r[0], r[1])):
            d = 2 * len(s & bigrams(x)) / (len(s) + size) if s else 0
            if d > best[0]:
                best = (d, name)
        if best[0] >= threshold:
            out.append((a, b, best[1], best[0]))
    return (",".join(sorted({x[2] for x in out})), len(out), max((x[3] for x in out), default=0.0),
            ",".join(f"{a}:{b}:{n}" for a, b, n, _ in out))


def rows(df):
    return {r.doc_id: (r.licences, r.n_passages, r.best_dice, r.spans) for r in df.collect()}


def test_equals_brute_force(frame):
    rnd = random.Random(8)
    every = [x for xs in lc.TEMPLATES.values() for x in xs]
    texts = [None, "", "\n\n", "MIT", "é released UNDER the mit licence", *every]
    for _ in range(120):
        parts = []
        for _ in range(rnd.randint(1, 5)):
            w = rnd.choice(every).split()
            for _ in range(rnd.randint(0, 4)):
                w[rnd.randrange(len(w))] = rnd.choice(["É", "the", "code"])
            parts.append(rnd.choice([" ", "\n", " * "]).join(w) if rnd.random() < .5 else " ".join(w))
        texts.append(rnd.choice(["\n", "\n\n"]).join(parts) + rnd.choice(["", "\nother text"]))
    got = rows(lc.scan(frame(texts)))
    for i, t in enumerate(texts):
        assert got[i] == brute(t), t


def test_documents(spark):
    d = spark.read.parquet(f"{SF01}/documents.parquet")
    got = rows(lc.scan(d))
    assert got == {r.doc_id: brute(r.text) for r in d.collect()}
    assert sum(bool(x[0]) for x in got.values()) > 20


def test_empty_table(spark):
    assert lc.scan(spark.createDataFrame([], DOCS)).collect() == []


def brute_windows(text, table, threshold=0.8):
    """Every run of words against every template, the best ones that share no word."""
    t = text or ""
    at = [m.span() for m in WORDS.finditer(t)]
    w = [t[a:b].lower() for a, b in at]
    pairs = list(zip(w, w[1:]))
    ordered = sorted(((n, x) for n, xs in table.items() for x in xs), key=lambda r: len(bigrams(r[1])))
    found = []
    for k, (_, x) in enumerate(ordered):
        s, most = bigrams(x), int((len(WORDS.findall(x)) - 1) * (2 - threshold) / threshold + 1e-9)
        for i in range(len(pairs)):
            for j in range(i, min(len(pairs), i + most)):
                if pairs[i] in s and pairs[j] in s:
                    run = set(pairs[i:j + 1])
                    hit = len(run & s)
                    dice = 2 * hit / (len(run) + len(s))
                    if dice >= threshold:
                        found.append((-(hit * dice), -dice, i, j + 1, k))
    taken, out = set(), []
    for _, d, i, j, k in sorted(found):
        if not taken & set(range(i, j + 1)):
            taken |= set(range(i, j + 1))
            out.append((at[i][0], at[j][1], ordered[k][0], -d))
    out.sort()
    return (",".join(sorted({x[2] for x in out})), len(out), max((x[3] for x in out), default=0.0),
            ",".join(f"{a}:{b}:{n}" for a, b, n, _ in out))


def test_windows_equal_brute_force(frame):
    rnd = random.Random(5)
    table = {"A": ["one two three four five six seven", "one two three four five nine"], "B": ["six seven eight one two three"],
             "C": ["two three two three four"]}
    some = "one two three four five six seven eight nine x".split()
    texts = [None, "", "one", " ".join(rnd.choices(some[1:3], k=60))]
    for _ in range(150):
        parts = [rnd.choice([x for xs in table.values() for x in xs]) if rnd.random() < .6
                 else " ".join(rnd.choices(some, k=rnd.randint(1, 8))) for _ in range(rnd.randint(1, 7))]
        texts.append("".join(rnd.choice([" ", "\n", "\n\n", ", é ", "\r\n * "]) + x for x in " ".join(parts).split(" ")))
    got = rows(lc.scan(frame(texts), templates=table, windows=True))
    for i, t in enumerate(texts):
        assert got[i] == brute_windows(t, table), t


def test_notices_inside_texts(frame):
    import textwrap
    fill = " ".join(f"word{i} and{i}" for i in range(400))
    mit, apache, gpl = lc.TEMPLATES["MIT"][2], lc.TEMPLATES["Apache-2.0"][1], lc.TEMPLATES["GPL-3.0"][1]
    jane = "Copyright 2020 Jane Doe and contributors. Released under the MIT License. See LICENSE for details."
    wrap = lambda t, mark="", end="\n": end.join(mark + x for x in textwrap.wrap(t, 60))
    texts = [jane, f"{fill} {jane} {fill}", f"{fill} {gpl} {fill}", f"{wrap(mit)}\nimport os\n{wrap(fill)}",
             "/*\r\n" + wrap(mit.replace(", to deal", "\n\nto deal"), " * ", "\r\n") + "\r\n */\r\n" + fill,
             "\n".join(["# Copyright 1999 X", "#", wrap(gpl, "# "), "#", "# more of it", "import os"]),
             "// (c) Y\n//\n" + wrap(apache, "// ").replace("obtain a copy", "obtain a\n//\n// copy") + "\nint main() {}",
             f"{jane} {fill} Licensed under the Apache License, Version 2.0. {fill}", fill]
    got = rows(lc.scan(frame(texts), windows=True))
    want = ["MIT", "MIT", "GPL-3.0", "MIT", "MIT", "GPL-3.0", "Apache-2.0", "Apache-2.0,MIT", ""]
    assert [got[i][0] for i in range(len(texts))] == want
    a = jane.index("Released")
    assert got[0] == ("MIT", 1, 1.0, f"{a}:{a + 30}:MIT")


def test_query_finds_all_that_lines_and_blocks_hold(spark):
    from interlens.llm import catalog
    d = spark.read.parquet(f"{SF01}/documents.parquet")
    plain, whole = rows(lc.scan(d)), rows(catalog.QUERIES["op4_licences"](spark, SF01))
    assert all(set(plain[i][0].split(",")) - {""} <= set(whole[i][0].split(",")) for i in plain)


GNU = ("This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {} Public License as "
       "published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version.")
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
       "following conditions are met:\n\n")
BSD12 = ("1. Redistributions of source code must retain the above copyright notice, this list of conditions and the\n   following "
         "disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions\n   "
         "and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n")
BSD3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote\n   "
        "products derived from this software without specific prior written permission.\n\n")
AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES'
STANDARD = [
    ("GPL-2.0", GNU.format("program", ";", "General", ";", 2)), ("GPL-3.0", GNU.format("program", ":", "General", ",", 3)),
    ("LGPL-2.1", GNU.format("library", ";", "Lesser General", ";", 2.1)),
    ("LGPL-3.0", GNU.format("program", ":", "Lesser General", ",", 3)),
    ("LGPL-3.0", GNU.format("library", ":", "Lesser General", ",", 3)),
    ("LGPL-2.0", GNU.format("library", ";", "Library General", ";", 2)),
    ("AGPL-3.0", GNU.format("program", ":", "Affero General", ",", 3)),
    ("BSD-2-Clause", BSD + BSD12 + AS_IS), ("BSD-3-Clause", BSD + BSD12 + BSD3 + AS_IS), ("BSD", BSD),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + AS_IS),
    ("CC0-1.0", "To the extent possible under law, Jane Doe has waived all copyright and related or neighboring rights to "
                "This Work."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."), ("CC-BY-NC-3.0", "Licensed under CC BY-NC 3.0."),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution license."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("GPL", "This work is licensed under the GNU General Public License."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991\n\nCopyright (C) 1989, 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nCopyright (C) 2007"),
]


def test_standard_notices_have_their_own_names(frame):
    own = [(n, x) for n, xs in lc.TEMPLATES.items() for x in xs]
    cases = STANDARD + own + [(n, f"Some words before it. {x}\nint main() {{}}") for n, x in STANDARD + own]
    got = rows(lc.scan(frame([x for _, x in cases]), windows=True))
    assert [(n, x, got[i][0]) for i, (n, x) in enumerate(cases) if got[i][0] != n] == []
    single = [(n, " ".join(x.split())) for n, x in STANDARD if len(x) < 400]
    got = rows(lc.scan(frame([x for _, x in single])))
    assert [(n, x, got[i][0]) for i, (n, x) in enumerate(single) if got[i][0] not in (n, "")] == []


def test_whole_texts_under_their_own_names(frame):
    """LICENSE files of the short licences, with a copyright line, wrapped, inside other text."""
    import textwrap
    whole = {}
    for name in ("MIT", "MIT-0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "ISC", "0BSD", "Zlib", "Unlicense"):
        whole[name] = max(lc.TEMPLATES[name], key=len)
    assert all(len(t) > 600 for t in whole.values())
    texts = []
    for t in whole.values():
        texts.append("Copyright (c) 2021 Jane Doe\n\n" + textwrap.fill(t, 72))
        texts.append("/*\n" + textwrap.indent(textwrap.fill(t, 60), " * ") + "\n */\nint main() { return 0; }\n" * 1)
        texts.append("some words before it " * 20 + t + " and more words after it" * 20)
    got = {r.doc_id: r for r in lc.scan(frame(texts), windows=True).collect()}
    for i, name in enumerate(n for n in whole for _ in range(3)):
        assert got[i].licences == name and got[i].n_passages == 1 and got[i].best_dice > 0.95, (name, got[i])


def test_rows_without_id_repeats_and_long_text(spark):
    notice = "Released under the MIT License."
    long = "word " * 400_000 + notice + " word" * 10
    d = spark.createDataFrame([(None, notice), (1, notice), (1, notice), (2, None), (3, long)], "doc_id long, text string")
    got = sorted((r.doc_id, r.licences, r.n_passages) for r in lc.scan(d, windows=True).collect())
    assert got == [(1, "MIT", 1), (1, "MIT", 1), (2, "", 0), (3, "MIT", 1)]
