"""The training-data operators on a small table with awkward rows, against brute force where SQL has no counterpart."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from duelake.llm import (
    byte_bpe,
    components,
    fingerprints,
    language_model,
    licences,
    mixing,
    near_duplicates,
    pii,
    quality,
    token_files,
    toxicity,
)

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, base string, score string, kept string"
LONG = " ".join(f"word{i % 997} and{i}" for i in range(4_000))
BASE = " ".join(f"token{i}" for i in range(60))
TEXTS = {
    1: None,
    2: "",
    3: "one two",
    4: BASE,
    5: BASE,
    6: BASE.replace("token59", "other"),
    7: "a  b \n\n c\t d'll  it's  ",
    8: LONG,
    9: "mail me.x@mail.example.com at 10.0.0.255 or 300.1.1.1, 4111 1111 1111 1111, +1 (212) 555-0100",
    10: "日本語 é ñ 🎉 <|endoftext|> naïve",
    11: "x" * 5_000,
    12: 'key token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" end',
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "src0" if i % 3 else None, len(t or ""), "x", "y", "z", "w") for i, t in TEXTS.items()]
    return spark.createDataFrame([*rows, (None, "no id here", "en", "s", 1, "", "", "", "")], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_byte_bpe_equals_the_library_and_round_trips(docs, empty):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )
    out = by_id(byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS))
    for i, text in TEXTS.items():
        assert np.frombuffer(out[i].ids, "<u4").tolist() == library.encode_ordinary(text or "")
        assert bytes(out[i].decoded).decode() == (text or "")
    assert out[4].base == "y"
    assert byte_bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_merge_replay_takes_the_lowest_rank_first():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"aa": 259, b"aaa": 260}
    replay = byte_bpe.MergeReplay(ranks)
    library = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    words = [b"abc", b"abcabc", b"aaaaa", b"aaaaaaaab", b"bcabca", b"z", b"cab"]
    found = replay.encode(words)
    for word in words:
        assert np.frombuffer(found[word], "<u4").tolist() == library.encode_ordinary(word.decode())


def test_token_files_round_trip_and_partial_reads(spark, docs, empty, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    folder = str(tmp_path / "files")
    files = token_files.write(docs, folder, WORDS, end_id=1, shards=3)
    out = by_id(token_files.read(files, folder))
    start = 0
    for i in [None, *TEXTS]:
        text = "no id here" if i is None else TEXTS[i] or ""
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert out[i].start == start and np.frombuffer(out[i].ids, "<u4").tolist() == ids
        start += len(ids)
    assert set(by_id(token_files.read(files, folder, wanted=[4, 9]))) == {4, 9}
    none = str(tmp_path / "none")
    assert token_files.read(token_files.write(empty, none, WORDS, 1, shards=2), none).count() == 0


def test_word_encoder_equals_the_plain_library():
    """Also with special tokens, letters that change their number in lower case, unknown letters and other forms."""
    import random

    from tokenizers import Tokenizer

    numbers = random.Random(3)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "İstanbul", "ß", "ﬁ", "e\u0301", "日本", "don't", "x2y", "A.", "b,", "(c)", "\u200b", "ǅ", "ſ", "ʼn", "𐐀", "١٢", "naïve", "..", "\t", "\x1f", "a" * 300]
    texts = ["".join(numbers.choice(parts) + numbers.choice(["", " ", "  ", "\n"]) for _ in range(numbers.randint(0, 12))) for _ in range(3_000)]
    library = Tokenizer.from_file(WORDS)
    encoder = token_files.WordEncoder(WORDS)
    for start in range(0, len(texts), 500):
        part = texts[start : start + 500]
        for text, ids in zip(part, encoder.block(part), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
    encoder.forget()
    assert not encoder.chunks and not encoder.words


def test_token_file_reader_finds_damage(tmp_path):
    from pyarrow import fs

    path = str(tmp_path / "one.ids.zst")
    with open(path, "wb") as out:
        writer = token_files.TokenFileWriter(out, wide=False, frame_bytes=64)
        for i in range(20):
            writer.add(i, np.arange(i, i + 20))
        writer.close()
    data = bytearray(open(path, "rb").read())
    with fs.LocalFileSystem().open_input_file(path) as source:
        reader = token_files.TokenFileReader(source)
        assert [d[2].tolist() for d in reader.documents([3, 19])] == [list(range(3, 23)), list(range(19, 39))]
        assert len(reader.table) > 5
    data[10] ^= 0xFF
    open(path, "wb").write(bytes(data))
    with fs.LocalFileSystem().open_input_file(path) as source, pytest.raises(Exception):  # noqa: B017
        list(token_files.TokenFileReader(source).documents([0]))


def test_near_duplicates(docs, empty, spark):
    out = by_id(near_duplicates.deduplicate(docs))
    for i, text in TEXTS.items():
        assert out[i].n_shingles == len(shingle_set(text))
    assert [out[i].component_id for i in (4, 5, 6)] == [4, 4, 4]
    assert all(out[i].kept for i in TEXTS if i not in (5, 6)) and not out[5].kept and not out[6].kept
    assert out[None].component_id is None and out[None].kept
    assert near_duplicates.deduplicate(empty).count() == 0
    same = spark.createDataFrame([(1, BASE), (1, BASE), (2, "other words here")], "doc_id long, text string")
    assert sorted((r.doc_id, r.kept) for r in near_duplicates.deduplicate(same).collect()) == [(1, False), (1, True), (2, True)]


def test_near_duplicates_between_two_families_that_share_a_passage(spark):
    passage = " ".join(f"p{i}" for i in range(100))
    rows = [(i, passage + " " + " ".join(f"w{i}x{k}" for k in range(i % 14))) for i in range(60)]
    out = by_id(near_duplicates.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")))
    parent = {i: i for i, _ in rows}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    sets = {i: shingle_set(t) for i, t in rows}
    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and 100 * len(x & y) >= 85 * len(x | y):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {i: out[i].component_id for i in sets} == {i: root(i) for i in sets}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 130)]
    out = by_id(components.components(spark.createDataFrame(edges, "a long, b long")), "id")
    assert {r.component for i, r in out.items() if i < 100} == {10}
    assert {r.component for i, r in out.items() if i >= 100} == {100}


def test_personal_data(docs, empty):
    out = by_id(pii.annotate(docs))
    found = [(s.kind, TEXTS[9][s.start : s.end]) for s in out[9].base]
    assert found == [
        ("email", "me.x@mail.example.com"),
        ("ip", "10.0.0.255"),
        ("card", "4111 1111 1111 1111"),
        ("phone", "+1 (212) 555-0100"),
    ]
    assert out[1].spans == [] and out[2].spans == []
    assert pii.annotate(empty).count() == 0
    redacted = by_id(pii.redact(pii.annotate(docs, keep_text=True)))
    assert redacted[9].text == "mail <EMAIL> at <IP> or 300.1.1.1, <CARD>, <PHONE>"
    assert redacted[8].text == LONG and redacted[1].text is None


def test_numbers_at_the_end_of_a_sentence(spark):
    texts = {
        1: ("Call 555-123-4567.", ["555-123-4567"]),
        2: ("SSN 123-45-6789. Next", ["123-45-6789"]),
        3: ("Call (555) 123-4567- or not", ["(555) 123-4567"]),
        4: ("Call 555-123-4567", ["555-123-4567"]),
        5: ("no 555-123-4567.8 and 555-123-4567-8 and 555-123-45678", []),
    }
    rows = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string")
    out = by_id(pii.find(rows))
    assert {i: [c.value for c in out[i].candidates] for i in texts} == {i: found for i, (_, found) in texts.items()}
    redacted = by_id(pii.redact(pii.annotate(rows, keep_text=True)))
    assert redacted[1].text == "Call <NUMBER>." and redacted[2].text == "SSN <NUMBER>. Next"


@pytest.mark.parametrize(
    "text",
    [
        "a@b.co_x@d.e f@g",
        "1.2.3.4.5 1.2.3.4 999.1.1.1 1.2.3",
        "++1 234 567 890 12- +49(0)30 1234567",
        "4111-1111-1111-1111 4111 1111 1111 1112 12345678901234567890",
        "é@x.y ü+1 555 0100 200 日本 1.2.3.4",
        "..@a.b a@-.- " + "9" * 3_000,
    ],
)
def test_base_spans_equal_plain_matching(spark, text):
    import re

    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    frame = spark.createDataFrame([(text,)], "text string")
    for kind, pattern in plain.items():
        fast = {"email": pii.EMAIL, "ip": pii.IP, "card": pii.CARD, "phone": pii.PHONE}[kind]
        spans = frame.select(pii._matches(F.col("text"), fast, kind).alias("s")).first().s
        assert [(s.start, s.end) for s in spans] == [m.span() for m in re.finditer(pattern, text)]


def test_fingerprints(docs, empty, spark):
    out = by_id(fingerprints.with_edited(docs))
    order = sorted(TEXTS, reverse=True)
    for i, following in zip(order, [*order[1:], order[0]], strict=True):
        text, after = TEXTS[i] or "", TEXTS[following] or ""
        cut = len(text) // 3
        assert out[i].edited == text[: len(text) - cut] + after[:cut]
    assert out[4].sketch == out[5].sketch and out[1].sketch == []
    assert fingerprints.with_edited(empty).count() == 0
    parts = spark.createDataFrame([(1, [1, 5, 9]), (1, [2, 5, 7]), (2, [])], "k int, sketch array<bigint>")
    assert by_id(fingerprints.merge_all(parts, ["k"], size=4), "k")[1].sketch == [1, 2, 5, 7]
    two = spark.createDataFrame([(BASE, BASE + " and more words at the end")], "a string, b string")
    a, b = fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b"))
    row = two.select(fingerprints.containment(a, b).alias("c"), fingerprints.distinct_shingles(a).alias("n")).first()
    assert row.c == pytest.approx(1.0) and row.n == len(shingle_set(BASE))


def test_sketches_hold_128_hashes(spark):
    # 124 words give 120 shingles: all of them fit in a sketch, so they are counted exactly.
    rows = spark.createDataFrame([(" ".join(f"w{i}" for i in range(124)), LONG)], "short string, long string")
    short, long = fingerprints.sketch(F.col("short")), fingerprints.sketch(F.col("long"))
    row = rows.select(fingerprints.distinct_shingles(short).alias("n"), F.size(long).alias("held")).first()
    assert row.n == 120 and row.held == 128


def test_lowest_of_a_long_array_equals_sorting(spark):
    row = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda i: F.xxhash64(i)).alias("h"))
    found = row.select(fingerprints.lowest(F.col("h"), 64).alias("low"), "h").first()
    assert found.low == sorted(found.h)[:64]


def test_quality(docs, empty, spark):
    repeated = "go now " * 40
    more = docs.unionByName(spark.createDataFrame([(50, repeated, "", "", 0, "", "", "", "")], SCHEMA))
    labels = spark.createDataFrame([(4, 1, 0), (8, 1, 0), (50, 0, 0), (3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = by_id(quality.judge(more, labels))
    assert out[50].n_repeat_words == 80 and out[50].base_failed and not out[50].kept
    assert out[1].n_words == 0 and out[1].base_failed and out[8].n_words == 8_000 and not out[8].base_failed
    assert out[10].word_chars == len("".join(TEXTS[10].split())) and out[10].n_symbols == 4
    assert quality.judge(empty, labels).count() == 0
    assert {r.kept for r in quality.judge(docs, labels.limit(0)).where("not base_failed").collect()} == {True}


def test_toxicity(docs, empty, spark):
    calm = [f"plain text number {i} about rivers hills and w{i} trees" for i in range(60)]
    rude = [f"plain text {i} you dreadful blockhead w{i} dreadful" for i in range(60)]
    rows = [(i, t) for i, t in enumerate(calm + rude)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 60)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.train(table, labels, "doc_id", "text", "toxic")
    out = by_id(toxicity.score(table, model))
    assert np.mean([(out[i].score >= 0.5) == (i >= 60) for i, _ in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, model).collect())
    assert toxicity.keep_ordinary(table, model).where("doc_id >= 60").count() < 6
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.train(docs, labels.limit(0), "doc_id", "text", "toxic") == {"constant": 0.0}


def test_language_model(docs, empty):
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    out = by_id(language_model.score(docs, ~held_out))
    tokens = {i: [*(t or "").encode().lower().split(), b""] for i, t in {**TEXTS, None: "no id here"}.items()}
    counts = Counter(w for i, ws in tokens.items() if i is None or zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        assert out[i].train_tokens == total and out[i].n_tokens == len(ws)
        assert out[i].n_known == sum(counts[w] > 0 for w in ws)
        assert out[i].base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in ws))
        assert out[i].score < 0
    assert language_model.score(empty, F.lit(True)).count() == 0


def test_log_bilinear_probabilities_add_up_and_training_helps():
    numbers = np.random.default_rng(3)
    word = np.tile([0, 1, 2], 4_000)
    first, second = np.roll(word, 1), np.roll(word, 2)
    trainer = language_model.Trainer(np.array([0.3, 0.3, 0.3, 0.1]), seed=1)
    before = trainer.weights.log_probabilities(first, second, word).mean()
    for _ in range(60):
        at = numbers.permutation(len(word))[:4_096]
        trainer.batch(first[at], second[at], word[at])
    assert trainer.weights.log_probabilities(first, second, word).mean() > before + 0.1
    total = sum(np.exp(trainer.weights.log_probabilities(np.array([1]), np.array([2]), np.array([w])))[0] for w in range(4))
    assert total == pytest.approx(1, abs=1e-5)


def test_mixing(docs, empty, spark):
    rows = [(i, "w " * (i % 7 + 1), "big" if i < 300 else f"s{i % 3}") for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(table, entropy=1.0, repeats=3.0).collect()
    tokens, weights = Counter(), {}
    for r in out:
        tokens[r.source] += r.tokens
        weights[r.source] = r.weight
    total = sum(tokens.values())
    assert sum(weights.values()) == pytest.approx(1)
    assert all(abs(tokens[s] - weights[s] * total) <= 30 for s in tokens)
    times = Counter(r.doc_id for r in out)
    assert min(times.values()) == 1 and max(times.values()) <= 4 and len(times) == 400
    small = mixing.mix(table, budget=200).collect()
    assert abs(sum(r.tokens for r in small) - 200) <= 4 * 8 and len({(r.doc_id, r.epoch) for r in small}) == len(small)
    assert mixing.mix(docs).select("doc_id").distinct().count() == len(TEXTS) + 1
    assert mixing.mix(empty).count() == 0


def test_licences(docs, empty, spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License."),
        ("a/b/c/x.py", "no statement at all"),
        ("a/b/LICENSE.txt", "This work is licensed under the GNU General Public License, version 3."),
        ("a/b/y.py", "header\nLicensed under the Apache License, Version 2.0.\n" + "code " * 50),
        ("z/q.py", None),
        ("top.py", "plain"),
        (None, "Licensed under CC BY-NC 4.0."),
        ("a/b/c/x.py", "no statement at all"),
    ]
    out = [r for r in licences.scan(spark.createDataFrame(rows, "path string, text string")).collect()]
    found = {(r.path, r.licence, r.origin, r.directory) for r in out}
    assert len(out) == len(rows)
    assert found == {
        ("a/LICENSE", "MIT", "own", None),
        ("a/b/c/x.py", "GPL-3.0", "inherited", "a/b"),
        ("a/b/LICENSE.txt", "GPL-3.0", "own", None),
        ("a/b/y.py", "Apache-2.0", "own", None),
        ("z/q.py", None, "none", None),
        ("top.py", None, "none", None),
        (None, "CC-BY-NC-4.0", "own", None),
    }
    assert licences.scan(empty.withColumn("path", F.col("lang"))).count() == 0


LICENCE_LINES = [
    ("GNU General Public License, version 2", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("licensed under the GNU Lesser General Public License version 3", "LGPL-3.0"),
    ("This file is licensed under GPLv2", "GPL-2.0"),
    ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("# SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"),
    ("// SPDX-License-Identifier: AGPL-3.0-or-later", "AGPL-3.0"),
    ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
    ("SPDX-License-Identifier: MPL-2.0", "MPL-2.0"),
    ("Released under the ISC license.", "ISC"),
    ("Copyright 2020 X. All rights reserved.", "Proprietary"),
    (
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files "
        '(the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, '
        "merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\n"
        "furnished to do so, subject to the following conditions:",
        "MIT",
    ),
    ("he lost his driver license", None),
    ("licence plates are issued by the office every year in spring", None),
]


def test_licences_by_version_variant_and_tag(spark):
    rows = [(i, f"d{i}/f.py", line + "\n" + "code word here " * 30) for i, (line, _) in enumerate(LICENCE_LINES)]
    out = by_id(licences.scan(spark.createDataFrame(rows, "doc_id int, path string, text string")))
    assert {i: out[i].licence for i in out} == {i: name for i, (_, name) in enumerate(LICENCE_LINES)}


def test_licence_similarity_equals_brute_force(spark):
    """One line a file: the cosine of weighed words with the best template, lowered for every deciding word of one side."""
    lines = [line for line, _ in LICENCE_LINES if "\n" not in line]
    files = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "row long, text string")
    texts = [s for _, s in licences.TEMPLATES]
    frame = spark.createDataFrame([(t,) for t in [*lines, *texts]], "t string").select(licences.terms(F.col("t")).alias("w"))
    words = [r.w for r in frame.collect()]
    docs, templates = words[: len(lines)], words[len(lines) :]
    known = {w for ws in templates for w in ws}
    idf = {w: math.log((len(docs) + 1) / (sum(w in d for d in docs) + 1)) + 0.1 for w in known}
    best = {}
    for i, doc in enumerate(docs):
        weights = {w: n * idf.get(w, math.log(len(docs) + 1) + 0.1) for w, n in Counter(doc).items()}
        norm = math.sqrt(sum(x * x / (1 if w in known else 4) for w, x in weights.items()))
        for (name, _), template in zip(licences.TEMPLATES, templates, strict=True):
            own = {w: n * idf[w] for w, n in Counter(template).items()}
            dot = sum(x * own.get(w, 0) for w, x in weights.items()) / math.sqrt(sum(x * x for x in own.values()))
            apart = len({w for w in doc if w in licences.DECIDING} ^ {w for w in template if w in licences.DECIDING})
            similarity = dot / norm * licences.DISAGREED**apart
            if similarity >= licences.LEAST and similarity > best.get(i, (0, ""))[0] + 1e-9:
                best[i] = (similarity, name)
    found = {r.row: (r.similarity, r.licence) for r in licences.matches(files, "text").collect()}
    assert found.keys() == best.keys() and len(found) >= 14
    for i, (similarity, name) in best.items():
        assert found[i] == (pytest.approx(similarity, abs=2e-6), name)


def test_licence_scan_keeps_columns_of_any_name(spark):
    names = "parent passage inherited words row part file depth template term w told own turn best unit tf df idf dot norm".split()
    frame = spark.createDataFrame([("a/LICENSE", "Released under the MIT License."), ("a/b.py", "x"), ("a/b.py", "x")], "path string, text string")
    frame = frame.withColumns({n: F.lit(n) for n in names})
    out = licences.scan(frame).collect()
    assert len(out) == 3 and all(r[n] == n for r in out for n in names)
    assert sorted((r.path, r.licence, r.origin) for r in out) == [("a/LICENSE", "MIT", "own")] + [("a/b.py", "MIT", "inherited")] * 2


def test_pipeline_stages_keep_columns_and_clean_documents(docs, spark, tmp_path):
    import corpus_pipeline

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs.select(columns).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, str(tmp_path))
        if name != "tokens":
            assert at.columns == columns
    assert {r.doc_id for r in at.select("doc_id").collect()} == set(TEXTS) - {5, 6} | {None}
    digest = {r.doc_id: hashlib.sha256(bytes(r.ids)).hexdigest() for r in at.collect()}
    assert digest[1] == hashlib.sha256(b"").hexdigest()


def test_pipeline_stages_keep_columns_of_any_name(spark, tmp_path):
    import corpus_pipeline

    names = (
        "candidates base spans times copy row kept id key signature a b component taken_id taken_hash taken_source text_hash epoch "
        "position tokens weight _id _labelled _order toxic score windows"
    ).split()
    rows = [(i, f"{LONG[: 400 + 40 * i]} mail me.x@mail.example.com {i}", "en", f"src{i % 2}", 0) for i in range(8)]
    rows += [(20, "b text of two rows", "en", "src0", 0), (20, "a text of two rows", "en", "src0", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({n: F.lit(n) for n in names})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, str(tmp_path))
        at.write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        if name != "tokens":
            assert at.columns == docs.columns
        if name == "near_duplicates":
            assert [r.text for r in at.where("doc_id = 20").collect()] == ["a text of two rows"]
        if name == "personal_data":
            assert at.where("text like '%<EMAIL>%'").count() > 0 and at.where("n_chars <> length(text)").count() == 0
    assert all(r[n] == n for r in at.collect() for n in names)


def test_quality_uses_every_label(spark):
    from duelake.llm.quality import known_labels

    labels = spark.range(40_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    twice = labels.unionByName(labels.limit(10).withColumn("quality", F.lit(0).cast("long")))
    known = known_labels(twice, "doc_id", "quality")
    assert known.count() == 40_000  # it was 20,000, whatever the table's size
    assert 15_000 < known.where("_fit").count() < 25_000


def test_quality_moves_only_texts_that_may_be_trusted(spark):
    from duelake.llm.quality import log_ratios, maybe_in, trusted_texts

    docs = spark.createDataFrame([(i if i % 50 else None, f"word{i % 7} word{i % 3} end") for i in range(1000)], "doc_id long, text string")
    docs = docs.unionByName(docs.where("doc_id = 7"))
    known = spark.createDataFrame([(7, 1, True), (8, 1, False), (9, 0, True), (77, 1, True), (5000, 1, True)], "_labelled long, _good int, _fit boolean")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are too large for it
    try:
        found = maybe_in(docs, known.where("_fit and _good = 1"), "doc_id", "_labelled")
        assert {7, 77} <= {r.doc_id for r in found.collect()} and found.count() < 10
        assert "SortMergeJoin" not in found._jdf.queryExecution().toString()
        moved = trusted_texts(docs.withColumnsRenamed({"doc_id": "_id", "text": "_text"}), known.where("_fit and _good = 1").select("_labelled"))
        plan = moved._jdf.queryExecution().executedPlan().toString()
        assert plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")  # the texts are filtered before they are moved
        assert sorted(r._id for r in moved.collect()) == [7, 7, 77]
        ratios = log_ratios(docs, known, "doc_id", "text", 16)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    texts = spark.createDataFrame([("a", t) for t in ["word0 word1 end"] * 2 + ["word0 word2 end"]], "k string, text string")
    wide = quality.with_words(texts, "text").select(F.explode(quality.buckets(F.col("hashes"), 16)).alias("b"))
    trusted = {r.b: r["count"] for r in wide.groupBy("b").count().collect()}
    wide = quality.with_words(docs, "text").select(F.explode(quality.buckets(F.col("hashes"), 16)).alias("b"))
    raw = {r.b: r["count"] for r in wide.groupBy("b").count().collect()}
    shift = math.log((sum(raw.values()) + 16) / (sum(trusted.values()) + 16))
    assert ratios == pytest.approx([math.log((trusted.get(b, 0) + 1) / (raw.get(b, 0) + 1)) + shift for b in range(16)])
