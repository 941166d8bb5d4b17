import hashlib
import math
import random
import re
import struct
import time
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
import xxhash
import zstandard
from pyspark.sql import functions as F

from lodestar.llm import bpe_pieces, chat_collapse, compression_quality, license_rules, packing, pii

RANKS, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "Hello, world! It's 42.", "é" * 3000, "a" * 20000, "naïve 日本語 \t\n\n x  ", "<|endoftext|> ▁ \x00", "word " * 3000]


def docs(spark, texts, **more):
    extra = ", ".join(f"{k} string" for k in more)
    return spark.createDataFrame([(i, t, *more.values()) for i, t in enumerate(texts)], "doc_id long, text string" + (", " + extra if extra else ""))


# ---- personal data ----

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    out = {}
    for kind, pattern in BASE.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")) or kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)) or kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out[kind].append(m.span())
    return out


@pytest.mark.parametrize("alphabet", ["a@.-b ", "0123456789.", "+0 ()-1.", "4 1-0", "a@.-+ 0123456789()%b[]\né"])
def test_base_spans_against_brute_force(alphabet):
    r = random.Random(alphabet)
    for _ in range(3000):
        text = "".join(r.choices(alphabet, k=r.randrange(70)))
        assert pii.detect(text) == brute(text), text


@pytest.mark.parametrize(
    "text, kind, span",
    [
        ("x jane dot doe at example dot com y", "email", "jane dot doe at example dot com"),
        ("x jane [at] mail (dot) example {dot} org!", "email", "jane [at] mail (dot) example {dot} org"),
        ("x jоhn@exаmple.com y", "email", "jоhn@exаmple.com"),
        ("x ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ y", "email", "ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
        ("x a​b@ex​ample.com y", "email", "a​b@ex​ample.com"),
        ("x plus one five five five one two three four five six seven y", "phone", "plus one five five five one two three four five six seven"),
        ("x four one one one one one one one one one one one one one one one y", "card", "four one one one one one one one one one one one one one one one"),
        ("x 4111 1111‑1111 1111 y", "card", "4111 1111‑1111 1111"),
        ("x 192[.]168[.]1[.]10 y", "ip", "192[.]168[.]1[.]10"),
        ("x 192 dot 168 dot 1 dot 10 y", "ip", "192 dot 168 dot 1 dot 10"),
        ("x １９２．１６８．０．１ y", "ip", "１９２．１６８．０．１"),
        ("x a1 dot b dot c dot d dot e dot f dot g dot h at host dot com y", "email", "a1 dot b dot c dot d dot e dot f dot g dot h at host dot com"),
        ("x " + "n" * 81 + " dot b at host dot com y", "email", "n" * 81 + " dot b at host dot com"),
        ("x " + "nam3 dot " * 400 + "b at host dot com y", "email", "nam3 dot " * 400 + "b at host dot com"),
        ("x 192.168.l.1 y", "ip", "192.168.l.1"),
        ("x jane @example.com y", "email", "jane @example.com"),
        ("x jane @ example . com y", "email", "jane @ example . com"),
        ("x j.doe@example·com y", "email", "j.doe@example·com"),
        ("x of j a n e @ example.com y", "email", "j a n e @ example.com"),
    ],
)
def test_disguises(spark, text, kind, span):
    row = pii.pii_spans(docs(spark, [text])).first()
    assert row.n_added == 1
    name, lo, hi = row.spans.split(":")
    assert (name, text[int(lo) : int(hi)]) == (kind, span)


@pytest.mark.parametrize("text", ["look at example.com", "the dot is at home", "one two three", "почта@example.com", "he was at one. Two of it", "at 5 dot 3", "he said so @ home. Then", "a·b 2·3·5·7", "so l.O.I.l is"])
def test_plain_words_stay(spark, text):
    assert pii.pii_spans(docs(spark, [text])).first().spans == ""


def disguised(r):
    """An identifier, written in one of many disguises, with its kind: a plain model of what the transducers undo."""
    word = lambda: "".join(r.choices("bcdfghkmnpqrstvwz", k=r.randint(4, 9)))
    names = dict(zip("0123456789", "zero one two three four five six seven eight nine".split(), strict=True))
    like = {"a": "а", "c": "с", "p": "р", "o": "о", "x": "х"}
    wide = lambda t: "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in t)
    kind = r.choice(["email", "phone", "card", "ip"])
    if kind == "email":
        plain = f"{word()}{r.randrange(10)}@{word()}p.com"
        at, dot = r.choice([(" at ", " dot "), ("[at]", "[dot]"), (" (at) ", " (dot) "), ("{@}", "."), (" @ ", "."), ("_at_", "_dot_")])
        forms = [plain.replace("@", at).replace(".", dot), wide(plain), plain[:-4] + "\u200b" + plain[-4:], "".join(like.get(c, c) for c in plain)]
    elif kind == "ip":
        plain = ".".join(str(r.randint(1, 255)) for _ in range(4))
        forms = [plain.replace(".", r.choice(["[.]", " dot ", "(dot)", " . "])), wide(plain)]
    elif kind == "card":
        body = "4" + "".join(r.choices("0123456789", k=14))
        plain = next(body + d for d in "0123456789" if luhn(body + d))
        forms = [" ".join(names[d] for d in plain), wide(plain), "‑".join(plain[k : k + 4] for k in range(0, 16, 4))]
    else:
        plain = "+1" + "".join(r.choices("0123456789", k=10))
        forms = ["plus " + " ".join(names[d] for d in plain[1:]), wide(plain), plain[:2] + "\u00a0" + plain[2:]]
    return kind, plain, r.choice(forms)


@pytest.mark.parametrize("seed", range(4))
def test_added_spans_against_planted_ones(spark, seed):
    r = random.Random(seed)
    texts, want = [], []
    for _ in range(300):
        text, spans = "", []
        for _ in range(r.randint(0, 4)):
            text += " ".join(r.choices("some plain, words; that. stand\nbetween them all".split(" "), k=r.randint(1, 30))) + " so: "
            kind, plain, form = disguised(r)
            spans.append((kind, len(text), len(text) + len(form), plain))
            text += form + " - then "
        texts.append(text)
        want.append(spans)
    for row in pii.pii_spans(docs(spark, texts)).collect():
        got = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in row.spans.split(",") if x)]
        for kind, lo, hi, plain in want[row.doc_id]:
            assert (kind, lo, hi) in got, (texts[row.doc_id][lo:hi], plain)
        assert len(got) == len(want[row.doc_id]), texts[row.doc_id]


def test_pii_takes_time_in_proportion():
    for unit in ("a at b.c ", "x dot ", "j ", "at a dot ", "a @ ", "@a . b", "one ", "1.l."):
        began = time.time()
        pii.find(pa.array([unit * 60_000]))
        assert time.time() - began < 15, unit


def test_pii_edges_and_redaction(spark):
    df = docs(spark, [*TEXTS, "mail a@b.cd, again a@b.cd"], spans="s", n_email="n")
    rows = {r.doc_id: r for r in pii.pii_spans(df).collect()}
    assert len(rows) == len(TEXTS) + 1 and rows[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert rows[len(TEXTS)].n_email == 2
    assert pii.pii_spans(df.limit(0)).count() == 0
    out = {r.doc_id: r for r in pii.redact(df).collect()}
    assert out[len(TEXTS)].text == "mail [EMAIL], again [EMAIL]" and out[0].text is None and out[3].spans == "s"


# ---- byte-level BPE ----


def test_bpe_equals_tiktoken_and_round_trips(spark):
    r = random.Random(4)
    texts = TEXTS + ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(0x300), r.randrange(0xD000), 32, 10])) for _ in range(r.randrange(80))) for _ in range(300)]
    ranks = {piece: i for i, piece in enumerate(bpe_pieces.read_ranks(RANKS))}
    reference = tiktoken.Encoding("reference", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {row.doc_id: row for row in bpe_pieces.encode_digests(docs(spark, texts, n_tokens="x"), RANKS, P.PATTERN).collect()}
    full = {row.doc_id: row for row in bpe_pieces.encode(docs(spark, texts), RANKS, P.PATTERN).collect()}
    for i, text in enumerate(texts):
        ids = reference.encode_ordinary(text or "")
        assert full[i].ids == ids and bytes(full[i].decoded) == (text or "").encode()
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


# ---- packing ----


def test_packing_covers_every_id_once(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(JSON)
    texts = TEXTS + ["some words to pack " * k for k in range(1, 120)]
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    rows = packing.pack_documents(docs(spark, texts, length="clash"), JSON, P.PATTERN, capacity=64, window_tokens=4000).collect()
    per_doc, per_sequence = {}, {}
    for r in rows:
        per_doc.setdefault(r.doc_id, []).append(r)
        per_sequence.setdefault(r.sequence_id, []).append(r)
    for i, wanted in ids.items():
        pieces = sorted(per_doc[i], key=lambda r: r.start)
        assert [x for p in pieces for x in p.ids] == wanted and all(p.doc_tokens == len(wanted) for p in pieces)
        assert all(p.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in p.ids)) for p in pieces)
    for pieces in per_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= 64 and at & (at - 1) == 0


def test_packing_balances_cost():
    import numpy as np

    lengths = np.random.default_rng(0).integers(1, 200, 400)
    pieces = packing.pack_window(lengths, 256, 1.0, 1 / 256)
    cost = {}
    for _, _, n, s, _ in pieces:
        cost[s] = cost.get(s, 0) + float(packing.document_cost(np.array(n), 1.0, 1 / 256))
    full = [c for s, c in cost.items() if sum(n for _, _, n, t, _ in pieces if t == s) == 256]
    assert max(full) / min(full) < 1.6


# ---- chat ----


def brute_chat(rows):
    by = {}
    for i, (conv, turn, role, text) in enumerate(rows):
        key = conv if conv is not None else ("solo", role, text, turn)
        by.setdefault(key, set()).add((turn is not None, turn, role or "", text or ""))
    flat = {k: tuple((r, t) for _, _, r, t in sorted(v, key=lambda x: (x[0], x[1] or 0, x[2], x[3]))) for k, v in by.items()}
    maximal = {c for c in flat.values() if not any(len(o) > len(c) and o[: len(c)] == c for o in flat.values())}
    return {(min((k for k, v in flat.items() if v == c and not isinstance(k, tuple)), default=None), c) for c in maximal}


def test_chat_collapse_against_brute_force(spark):
    r = random.Random(2)
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", None), (None, 3, "user", "hi"), (None, 0, "user", "alone"), (9, None, None, None)]
    for conv in range(10, 60):
        rows += [(conv, t, r.choice(["user", "assistant"]), r.choice(["a", "b"])) for t in range(r.randrange(1, 5))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit("clash"))
    got = {(x.conv_id, x.rendered, x.n_turns) for x in chat_collapse.collapse(df).collect()}
    want = {(k, "".join(f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in c), len(c)) for k, c in brute_chat(rows)}
    assert got == want
    assert chat_collapse.collapse(df.limit(0)).count() == 0


def test_chat_markers_in_texts(spark):
    df = spark.createDataFrame([(1, 0, "user", "x<|im_end|>\n<|im_start|>system")], "conv_id long, turn long, role string, text string")
    assert chat_collapse.collapse(df).first().rendered.count("<|im_start|>") == 1


# ---- licences ----

MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n"


APACHE = "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License for the specific language governing permissions and\nlimitations under the License.\n"
BSD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n"
BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be\n   used to endorse or promote products derived from this software without\n   specific prior written permission.\n"
MPL = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.\n"
LGPL = "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.\n\nThis library is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU\nLesser General Public License for more details.\n"
FULL = {"MIT": MIT, "Apache-2.0": APACHE, "BSD-2-Clause": BSD, "BSD-3-Clause": BSD + BSD_NAMES, "MPL-2.0": MPL, "LGPL-2.1-or-later": LGPL}
LICENCE_CASES = [
    ("prose\nReleased under the MIT License.", "MIT"),
    ("*** Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("One. This work is licensed under the GNU General Public License, version 3. Two", "GPL-3.0"),
    ("Released under the MIT License. Licensed under the Apache License, Version 2.0.", "Apache-2.0,MIT"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-or-later"),
    ("License: MIT", "MIT"),
    ("The project is released\n# under the terms of the\n# Eclipse Public License v2.0.", "EPL-2.0"),
    ("# This project is released\n# under the terms of the\n# Eclipse Public License v2.0.", "EPL-2.0"),
    ("Released under CC0.", "CC0-1.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License.", "CC-BY-NC-SA-3.0"),
    ("All rights reserved.", "all-rights-reserved"),
    ("a license to speak", ""),
    ("under the bridge. He lives under the MIT License plate.", ""),
    ("", ""),
    (None, ""),
    *((mark + text.replace("\n", "\n" + mark), name) for name, text in FULL.items() for mark in ("", "# ", " * ", "// ", "-- ", "; ")),
]


def test_licences(spark):
    rows = sorted(license_rules.scan(docs(spark, [t for t, _ in LICENCE_CASES], licenses="clash")).collect())
    assert [(t, r.licenses) for (t, _), r in zip(LICENCE_CASES, rows)] == LICENCE_CASES
    assert all((r.n_sentences > 0) == (r.sentences != "") == (r.licenses != "") for r in rows)  # no licence without a sentence


#: Sentences with the identifier each must get, whatever its line breaks, comment marks and neighbours.
SPOKEN = {
    "Released under the MIT License.": "@MIT",
    "Licensed under the Apache License, Version 2.0!": "@Apache-2.0",
    "This software is available under the terms of the Boost Software License, Version 1.0.": "@BSL-1.0",
    "All rights reserved.": "s",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.": "b1",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.": "b2",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.": "b3",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.": "b4",
    "He asked for permission.": None,
    "The license was lost, and so was é.": None,
}
PLAIN_RUNS = {"BSD-3-Clause": ["b1", "b2", "b3", "b4"], "BSD-2-Clause": ["b1", "b2", "b3"], "all-rights-reserved": ["s"]}


def recognise(text):
    """The rule, word by word: sentences of lines and of paragraphs, known ones, runs."""
    words = lambda s: tuple("".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)).split())
    known = {words(s): n for s, n in SPOKEN.items() if n} | {words("Released under the MIT"): "@MIT", words("available under the terms of the Boost Software License, Version 1.0."): "@BSL-1.0"}  # what a line break may leave
    lines, paragraphs = text.split("\n"), [""]
    for line in lines:
        if not words(line):
            paragraphs.append("")
        else:
            paragraphs[-1] += " " + line
            if line.rstrip(" \t\r").endswith(":"):
                paragraphs.append("")
    cuts = []
    for blocks in (lines, paragraphs):
        names = []
        for block in blocks:
            sentence = ""
            for c, then in zip(block, block[1:] + " "):
                sentence += c
                if c in ".!?" and then in " \t\r":
                    names.append(known.get(words(sentence)))
                    sentence = ""
            names.append(known.get(words(sentence)))
        cuts.append([n for n in names if n])
    has = lambda run: any(cut[k : k + len(run)] == run for cut in cuts for k in range(len(cut)))
    licences = {n[1:] for cut in cuts for n in cut if n[0] == "@"} | {n for n, run in PLAIN_RUNS.items() if has(run)}
    if has(PLAIN_RUNS["BSD-3-Clause"]):
        licences.discard("BSD-2-Clause")
    seen = cuts[0] + [n for n in cuts[1] if n not in cuts[0]]
    return ",".join(sorted(licences)), len(seen), ",".join(seen)


def test_licences_against_a_plain_recogniser(spark):
    r = random.Random(7)
    texts = []
    for _ in range(400):
        parts = r.choices(list(SPOKEN), k=r.randint(1, 7))
        if r.random() < 0.5:
            at = r.randint(0, len(parts))
            parts[at:at] = list(SPOKEN)[4 : 7 + r.randint(0, 1)]
        mark, breaks = r.choice(["", "# ", "// ", " * "]), r.random()
        text = "".join(p.replace(" ", " \0") + r.choice([" \0", "\n", "\n\n", "  "]) for p in parts)
        text = "".join(("\n" if r.random() < 0.15 * breaks else "") if c == "\0" else c for c in text)
        texts.append(mark + text.replace("\n", "\n" + mark))
    rows = sorted(license_rules.scan(docs(spark, texts)).collect())
    expected = [recognise(t) for t in texts]
    assert [(x.licenses, x.n_sentences, x.sentences) for x in rows] == expected
    assert {"MIT", "BSD-2-Clause", "BSD-3-Clause"} <= {n for e in expected for n in e[0].split(",")}


def test_licence_statement_gives_the_same(spark):
    import duckdb

    texts = [t for t, _ in LICENCE_CASES] + TEXTS
    df = docs(spark, texts)
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    assert sorted(map(tuple, license_rules.scan(df).collect())) == sorted(con.sql("SELECT doc_id, licenses, n_sentences, sentences FROM (" + license_rules.oracle_sql() + ")").fetchall())


def test_licence_plan_is_native(spark):
    plan = license_rules.scan(docs(spark, ["x"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- quality ----


def labelled(spark, n=900):
    r = random.Random(1)
    good = ["the river", "bright house", "quiet garden", "morning light", "an old road", "children sang", "letters from", "stone bridge"]
    bad = ["BUY NOW!!!", "click $$$", "free @@@ win", "%%% deal", "cheap ### pills"]
    rows = [(i, " ".join(r.choices(good if i % 3 else bad, k=r.randint(8, 60))), int(i % 3 > 0)) for i in range(n)]
    return spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string"), spark.createDataFrame([(a, c) for a, _, c in rows], "doc_id long, quality int")


def test_quality_on_held_out_rows(spark):
    df, labels = labelled(spark)
    model = compression_quality.fit(df, labels)
    out = compression_quality.score(df, model).join(labels, "doc_id").where("held_out").collect()
    assert len(out) > 100 and sum((r.score >= 0.7) == (r.quality == 1) for r in out) / len(out) > 0.97
    assert all(r.predicted == int(r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    kept = compression_quality.keep_good(df, model)
    assert kept.columns == df.columns and 0.5 * 900 < kept.count() < 0.8 * 900


def test_quality_never_learns_held_out_labels(spark):
    df, labels = labelled(spark)
    flipped = labels.withColumn("quality", F.when(compression_quality.is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert compression_quality.fit(df, labels) == compression_quality.fit(df, flipped)


def brute_quality(texts, labels):
    """Scores by the stated rule in plain Python: texts {id: [text]}, labels [(id, label)]."""
    by = {}
    for i, label in labels:
        if zlib.crc32(str(i).encode()) % 4 != 2:
            by.setdefault(i, set()).add(label)
    known = {i: min(x) for i, x in by.items() if len(x) == 1}
    hashed = lambda i: xxhash.xxh64_intdigest(struct.pack("<q", i), 42)
    order = lambda i: (hashed(i) - (1 << 64) if hashed(i) >> 63 else hashed(i), i)
    ranked = [sorted((i for i, x in known.items() if x == label), key=order) for label in (0, 1)]
    cut = [min(2000, (len(x) + 1) // 2) for x in ranked]
    text_of = lambda i: min((t for t in texts.get(i, []) if t), default=None)
    first = sorted((i for x, n in zip(ranked, cut) for i in x[:n] if text_of(i)), key=lambda i: (zlib.crc32(f"order {i}".encode()), str(i)))
    dictionaries = [compression_quality.build_dictionary([b for i in first if known[i] == label for b in compression_quality.spread_blocks(text_of(i), 32)], 1 << 17) for label in (0, 1)]
    pair = [zstandard.ZstdCompressor(level=1, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False) for d in dictionaries]

    def numbers(text):
        raw = (text or "").encode()
        sizes = [sum(len(c.compress(raw[k : k + 1024])) - 6 for k in range(0, len(raw), 1024)) for c in pair]
        return [(sizes[0] - sizes[1]) / (len(raw) + 16), math.log((sizes[1] + 1) / (len(raw) + 1) + 0.01), math.log(len(raw) + 1)]

    rest = [i for x, n in zip(ranked, cut) for i in x[n:] if text_of(i)]
    centre, scale, w = compression_quality.fit_logistic(np.array([numbers(text_of(i)) for i in rest]), np.array([known[i] for i in rest], float))
    return {(i, t): 1 / (1 + math.exp(-(w[0] + ((np.array(numbers(t)) - centre) / scale) @ w[1:]))) for i, x in texts.items() for t in x}


def test_quality_against_brute_force(spark):
    df, labels = labelled(spark)
    long = " ".join(["the river bright house"] * 9000)
    assert len(long) > 1 << 16
    more = spark.createDataFrame([(1, "another text of a known id"), (1, "another text of a known id"), (2, long), (901, long), (902, None), (903, "")], "doc_id long, text string")
    df = df.where("doc_id <> 2").unionByName(more).withColumn("label", F.lit("clash"))
    labels = labels.unionByName(spark.createDataFrame([(5, 1), (5, 0), (6, 7), (None, 1), (8, None)], "doc_id long, quality int"))
    texts = {}
    for r in df.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    want = brute_quality(texts, [(r.doc_id, r.quality) for r in labels.collect() if r.doc_id is not None and r.quality in (0, 1)])
    got = compression_quality.score(df, compression_quality.fit(df, labels))
    pairs = got.join(df.withColumnRenamed("text", "own").select("doc_id", "own"), "doc_id").collect()
    assert got.count() == df.count()
    assert all(any(abs(r.score - want[r.doc_id, t]) < 1e-9 for t in texts[r.doc_id]) for r in pairs)


def test_long_labelled_texts_teach(spark):
    r = random.Random(5)
    rows = [(i, " ".join(r.choices(["river", "garden", "stone"] if i % 2 else ["BUY!", "###", "deal$"], k=12_000)), i % 2) for i in range(60)]
    assert min(len(t) for _, t, _ in rows) > 1 << 16 - 1
    df = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    model = compression_quality.fit(df, spark.createDataFrame([(a, c) for a, _, c in rows], "doc_id long, quality int"))
    out = compression_quality.score(df, model).collect()
    assert all((x.score > 0.5) == bool(x.doc_id % 2) for x in out)
    assert len(compression_quality.spread_blocks("x" * 10_000, 4)) == 4


def test_empty_tables_and_repeated_rows(spark):
    none = docs(spark, ["x"]).limit(0)
    assert packing.pack_documents(none, JSON, P.PATTERN).collect() == []
    assert bpe_pieces.encode_digests(none, RANKS, P.PATTERN).collect() == [] and bpe_pieces.encode(none, RANKS, P.PATTERN).collect() == []
    assert license_rules.scan(none).collect() == []
    twice = spark.createDataFrame([(1, "Released under the MIT License. a@b.cd"), (1, "Released under the MIT License. a@b.cd"), (None, None)], "doc_id long, text string")
    pieces = packing.pack_documents(twice, JSON, P.PATTERN).collect()
    assert sum(r.length for r in pieces if r.doc_id == 1) == 2 * next(r.doc_tokens for r in pieces if r.doc_id == 1)
    for out in (bpe_pieces.encode_digests(twice, RANKS, P.PATTERN), license_rules.scan(twice), pii.pii_spans(twice)):
        assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 1]


def test_quality_edges(spark):
    df, labels = labelled(spark, 60)
    only = compression_quality.fit(df, labels.where("quality = 1"))
    none = compression_quality.fit(df, labels.limit(0))
    rows = compression_quality.score(docs(spark, TEXTS, score="clash"), none).collect()
    assert len(rows) == len(TEXTS) and {r.score for r in rows} == {0.5}
    assert all(r.score > 0.9 for r in compression_quality.score(docs(spark, TEXTS), only).collect())
    assert compression_quality.score(df.limit(0), only).count() == 0
