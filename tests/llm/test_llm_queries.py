"""The registered queries on a small table with nulls, empty and long texts, ties and repeated rows, against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from duelake.llm import byte_bpe
from duelake.llm.queries import QUERIES

LINES = "first line here\nsecond one\nfirst line here\n \nsecond one\nlast # * $"
WORDY = " ".join(f"w{i % 9}" for i in range(60))
TEXTS = {
    1: None,
    2: "",
    3: LINES,
    4: "mail a.b@c.example x 10.0.0.255 300.1.1.1 4111 1111 1111 1111 4111 1111 1111 1112 +1 (212) 555-0100 +123",
    5: " ".join(f"token{i}" for i in range(60)),
    6: " ".join(f"token{i}" for i in range(60)),
    7: " ".join(f"token{i}" for i in range(59)) + " other",
    8: WORDY,
    9: "日本語 é ñ 🎉 <|endoftext|> naïve don't A.B, \t\x0b x\r\n",
    10: "x" * 4_000 + " " + "word " * 3_000,
    11: "one two three four",
    12: "One Two three FOUR",
    14: "a@b.c a@b.c 1.2.3.4.5 +49 (30) 12 34-567 0000000000000",
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("queries")
    rows = [(i, t, "en", f"src{i % 2}", len(t or "")) for i, t in TEXTS.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{at}/documents.parquet")
    labels = [(i, int(i % 2), int(i in (4, 8))) for i in TEXTS]
    spark.createDataFrame([*labels, (None, 1, 1)], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{at}/labels.parquet")
    return str(at)


def result(spark, folder, name, columns):
    out = QUERIES[name](spark, folder)
    assert set(columns.split()) <= set(out.columns)
    rows = out.collect()
    assert sorted(r.doc_id for r in rows) == sorted(TEXTS)
    return {r.doc_id: r for r in rows}


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def folded(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def luhn(digits):
    total = 0
    for turn, d in enumerate(reversed(digits)):
        x = int(d) * (1 + turn % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in kinds.items() for m in re.finditer(p, text or "") if ok(m[0])]


def test_op1(spark, folder):
    out = result(spark, folder, "op1_pii", "n_email n_ip n_card n_phone base_sha256 spans")
    for i, text in TEXTS.items():
        spans = personal(text)
        counts = Counter(k for k, _, _ in spans)
        assert (out[i].n_email, out[i].n_ip, out[i].n_card, out[i].n_phone) == tuple(counts[k] for k in ("email", "ip", "card", "phone"))
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert out[i].base_sha256 == sha(listed)
        assert set(listed.split(",")) - {""} <= set(out[i].spans.split(","))


def test_op2(spark, folder):
    out = result(spark, folder, "op2_toxicity", "held_out score predicted")
    for i in TEXTS:
        assert out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= out[i].score <= 1 and out[i].predicted == int(out[i].score >= 0.5)


def test_op3(spark, folder):
    out = result(spark, folder, "op3_near_duplicates", "n_shingles component_id kept")
    sets = {}
    for i, text in TEXTS.items():
        words = words_of(folded(text))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    parent = {i: i for i in TEXTS}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for a in TEXTS:
        for b in TEXTS:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    for i in TEXTS:
        assert (out[i].n_shingles, out[i].component_id, out[i].kept) == (len(sets[i]), root(i), root(i) == i)


def test_op5(spark, folder):
    out = result(spark, folder, "op5_quality", "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept")
    for i, text in TEXTS.items():
        words, lines = words_of(text), (text or "").split("\n")
        windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        repeated = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
        dup = sum(bool(words_of(line)) and line in lines[:k] for k, line in enumerate(lines))
        failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated), failed)
        assert (out[i].n_words, out[i].word_chars, out[i].n_symbols, out[i].n_dup_lines, out[i].n_repeat_words, out[i].base_failed) == expected
        assert not (failed and out[i].kept)


def test_op7(spark, folder):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = result(spark, folder, "op7_byte_bpe", "n_tokens ids_sha256 decoded_sha256")
    for i, text in TEXTS.items():
        ids = library.encode_ordinary(text or "")
        assert (out[i].n_tokens, out[i].ids_sha256, out[i].decoded_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text or ""))


def test_op8(spark, folder):
    out = result(spark, folder, "op8_language_model", "held_out n_tokens n_known train_tokens base_score score")
    tokens = {i: [*words_of(folded(t)), None] for i, t in TEXTS.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in TEXTS}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total = sum(counts.values())
    for i, ws in tokens.items():
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in ws)
        got = out[i]
        assert (got.held_out, got.n_tokens, got.n_known, got.train_tokens) == (held[i], len(ws), sum(counts[w] > 0 for w in ws), total)
        assert got.base_score == pytest.approx(base) and math.isfinite(got.score) and got.score < 0


def test_op9(spark, folder):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = result(spark, folder, "op9_token_files", "start n_tokens ids_crc32")
    start = 0
    for i in sorted(TEXTS):
        ids = [*library.encode(TEXTS[i] or "", add_special_tokens=False).ids, 1]
        assert (out[i].start, out[i].n_tokens, out[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op10(spark, folder):
    out = result(spark, folder, "op10_fingerprints", "n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next")
    order = sorted(TEXTS, reverse=True)
    for i, following in zip(order, [*order[1:], order[0]], strict=True):
        text, after = TEXTS[i] or "", TEXTS[following] or ""
        cut = len(text) // 3
        assert (out[i].n_chars, out[i].edited_sha256) == (len(text), sha(text[: len(text) - cut] + after[:cut]))
        assert 0 <= out[i].near_edited <= 1 and 0 <= out[i].near_next <= 1
    assert out[5].fingerprint == out[6].fingerprint != out[7].fingerprint
    assert out[6].near_next == 1.0


@pytest.mark.parametrize("name", ["op4_licences", "op6_mixing"])
def test_every_document_is_reported(spark, folder, name):
    rows = QUERIES[name](spark, folder).collect()
    assert {r.doc_id for r in rows} == set(TEXTS)
