"""Line dedup, conversation repair and collocations against brute force on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest

from duelake.llm import collocations, conversations, line_dedup
from duelake.llm.queries import ORACLES, QUERIES

SPACE = " \t\n\x0b\x0c\r"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, line string, filter string, phrase string, f string"
COMMON = "The Same Footer"


def doc_rows():
    rows = [(i, f"own line {i}\n{COMMON if i % 2 else '  ' + COMMON.upper() + chr(13)}\n\nend {i % 3}") for i in range(24)]
    rows += [(24, None), (25, ""), (26, COMMON), (26, COMMON), (None, f"é\n{COMMON}\t"), (27, "w " * 30_000 + "\nend 1"), (28, "\n\n")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None, "s", 0, "x", "y", "z", "w") for i, t in doc_rows()], DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def key(line):
    return line.strip(SPACE).translate({c: c + 32 for c in range(65, 91)})


def cleaned(rows, threshold=10, least=1):
    counts = Counter(k for _, t in rows for k in {key(line) for line in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [line for line in lines if len(key(line)) < least or counts[key(line)] < threshold]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("least", [1, 6])
def test_lines_of_many_documents_go(spark, docs, empty, tmp_path, least):
    index = line_dedup.LineIndex(spark, str(tmp_path), least=least, shards=3).insert(docs)
    assert collected(index.clean(docs)) == cleaned(doc_rows(), least=least)
    assert collected(index.clean(docs, most=-1)) == cleaned(doc_rows(), least=least)
    nothing = line_dedup.LineIndex(spark, str(tmp_path), shards=2)
    assert nothing.clean(docs).where("n_dropped > 0").count() == 0
    assert nothing.insert(empty).clean(empty).count() == 0


def test_deletions_undo_insertions(spark, docs, tmp_path):
    part, rest = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1 or doc_id is null")
    first = line_dedup.LineIndex(spark, str(tmp_path), threshold=14, shards=3).insert(rest)
    both = first.insert(part)
    back = both.delete(part)
    assert collected(both.clean(docs)) == cleaned(doc_rows(), 14) and both.clean(docs).where("n_dropped > 0").count() > 20
    assert collected(back.counts()) == collected(first.counts())
    assert collected(back.clean(rest)) == collected(first.clean(rest))
    with pytest.raises(ValueError, match="does not hold"):
        first.delete(part)


def test_cuckoo_filter_holds_what_it_was_given_and_forgets_what_it_lost():
    numbers = np.random.default_rng(1)
    keys = numbers.integers(-(1 << 62), 1 << 62, (20_000, 2))
    made = line_dedup.CuckooFilter.holding(keys)
    again = line_dedup.CuckooFilter.loaded(made.saved())
    assert again.has(keys).all() and made.table.size < 3 * len(keys)
    again.delete(keys[:12_000])
    assert again.has(keys[12_000:]).all() and again.has(keys[:12_000]).sum() <= 2
    assert again.insert(keys[:12_000]) and again.has(keys).all()
    with pytest.raises(KeyError):
        made.delete(numbers.integers(0, 1 << 62, (1, 2)))
    full = line_dedup.CuckooFilter(4)
    assert not full.insert(keys[:200])


def test_false_positives_are_listed(spark, docs, tmp_path, monkeypatch):
    """With fingerprints of one value every probe of a bucket in use is positive; the list makes the answer right."""
    places = line_dedup.CuckooFilter._places

    def coarse(self, keys):
        prints, first, _ = places(self, keys)
        return np.ones_like(prints), first & np.uint64(0), (first & np.uint64(0)) ^ (line_dedup.mixed(np.uint64([1])) & np.uint64(len(self.table) - 1))

    update = line_dedup.ShardUpdate(0, 2)
    monkeypatch.setattr(line_dedup.CuckooFilter, "_places", coarse)
    update.common(np.array([[5, 6, 2, 0]]))
    update.rare(np.array([[7, 8, 1, 0], [9, 9, 1, 0]]))
    assert update.finished().column("exceptions")[0].as_py() == np.array([[7, 8], [9, 9]], "<i8").tobytes()


# Conversations

LEGAL = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def faults(rows):
    """(initial, fault) of rows in order."""
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role[:1], fault))
    return out


def cheapest(rows):
    """(cost, audit) from the end of the conversation to its beginning, on plain strings."""
    found = faults(rows)

    @lru_cache(None)
    def rest(i, state, inserts):
        ways = [(0, "")] if i == len(found) and state in ("", "a") else []
        other = "a" if state == "u" else "u"

        def way(cost, edit, *to):
            if (tail := rest(*to)) is not None:
                ways.append((cost + tail[0], edit + tail[1]))

        if inserts:
            way(2, "I", i, other, inserts - 1)
        if i < len(found):
            initial, fault = found[i]
            way(3, "D", i + 1, state, 3)
            if fault not in ("blank", "duplicate"):
                if (state, initial) in LEGAL:
                    way(fault == "truncated", "K", i + 1, LEGAL[state, initial], 3)
                way(2 + (fault == "truncated"), "R", i + 1, other, 3)
        return min(ways, default=None)

    return rest(0, "", 3)


def rebuilt(rows, audit):
    queue, out, state = iter(rows), [], ""
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(queue)[1:]
        if edit == "D":
            continue
        state = LEGAL[state, role[:1]] if edit == "K" else "a" if state == "u" else "u"
        out.append((role if edit == "K" else {"u": "user", "a": "assistant"}[state], text))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in out))
    return out


def report(rows):
    found = faults(rows)
    pairs = [a + b for (a, _), (b, _) in zip(found, found[1:], strict=False)]
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit = cheapest(rows)
    lines = "\n".join(f"{r}:{t}" for r, t in rebuilt(rows, audit))
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(sum(f == kind for _, f in found) for kind in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs),
        int(cost),
        audit,
        hashlib.sha256(lines.encode()).hexdigest(),
    )


def random_conversations(seed, count, longest):
    numbers = random.Random(seed)
    texts = ["a.", "b", "c?", " \t", "", "d! ", None, "long text " * 50 + "."]
    for conv in range(count):
        for turn in range(numbers.randint(0, longest)):
            text = numbers.choice([*texts, f"e{numbers.random()}.", f"f{numbers.random()}"])
            role = numbers.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            yield conv, numbers.choice([turn, turn, turn, turn + 1, None]), role, text


def expected_audits(rows):
    shown = lambda x: " " if x is None else str(x)
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = "user" if fault == 4 else shown(role), "" if fault == 1 else shown(text)
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        convs[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {conv: report(sorted(messages, key=order)) for conv, messages in convs.items()}


def audit_row(r):
    return r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256


CONVERSATIONS = "conv_id long, turn long, role string, text string, copies string, duplicate string"


@pytest.mark.parametrize("limits", [(), (6, 8)])
def test_conversations_are_repaired_for_the_least_cost(spark, limits):
    rows = [*random_conversations(3, 120, 12), *((None, t, "user", f"x{t}.") for t in range(5)), *((7, t, "user", "z") for t in range(40))]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], CONVERSATIONS).repartition(4)
    out = {r.conv_id: audit_row(r) for r in conversations.audits(conversations.damaged(table), *limits).collect()}
    assert out == expected_audits(rows)


def test_repaired_messages_and_empty_input(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Again."), (2, 0, "assistant", None), (3, 0, "system", "Be kind.")]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], CONVERSATIONS)
    out = conversations.repaired(conversations.undamaged(table)).orderBy("conv_id", "position").collect()
    found = defaultdict(list)
    for r in out:
        found[r.conv_id].append((r.role, r.text))
    for conv in (1, 2, 3):
        mine = sorted((t, r, x or " ") for c, t, r, x in rows if c == conv)
        assert found[conv] == rebuilt(mine, cheapest(mine)[1])
    assert conversations.audits(conversations.damaged(table.limit(0))).count() == 0


def test_a_conversation_that_loses_all_rows_keeps_its_row(spark):
    conv = next(c for c in range(1_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(conv, 0, "user", "Gone.")], "conv_id long, turn long, role string, text string")
    (row,) = conversations.audits(conversations.damaged(table)).collect()
    assert audit_row(row) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_edit_strings_compare_as_text_even_if_all_hashes_collide(monkeypatch):
    numbers = random.Random(8)
    for modulus in ((1 << 61) - 1, 3, 1):
        monkeypatch.setattr(conversations.EditLog, "MODULUS", modulus)
        log, names = conversations.EditLog(), {0: b""}
        children = {}
        for _ in range(400):
            parent, edit = numbers.choice([*names][-30:]), numbers.choice(b"DIKR")
            if (parent, edit) not in children:
                children[parent, edit] = log.add(parent, edit)
                names[children[parent, edit]] = names[parent] + bytes([edit])
        for _ in range(500):
            x, y = numbers.choice([*names]), numbers.choice([*names])
            assert log.less(x, y) == (names[x] < names[y]) and log.text(x) == names[x]


def test_the_agreed_part_is_settled_early():
    repair = conversations.Repair(200, 1 << 20)
    for turn in range(5_000):
        repair.row(turn, [b"user", b"assistant"][turn % 2], b"text %d." % turn, False)
        assert len(repair.rows) < 200 and len(repair.log.edit) <= 220
    assert repair.finish()["audit"] == "K" * 5_000


# Collocations


def brute_collocations(rows, least, share, top):
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode().lower()):
            words = [w for w in re.split(rb"[\x20\x09]+", piece) if w]
            sizes[lang] += len(words)
            for size in range(1, 5):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, found in counts.items():
        able = {p: f for p, f in found.items() if len(p) > 1 and f >= least}
        inside = {
            q[i : i + n] for q, f in able.items() for n in range(2, len(q)) for i in range(len(q) - n + 1) if 100 * f >= share * able[q[i : i + n]]
        }
        rows = []
        for p, a in able.items():
            if p not in inside:
                cuts = [(2_000_000 * a // (found[p[:k]] + found[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows.append((-score, -a, b" ".join(p), found[p[:k]], found[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def phrase_rows(seed=2):
    numbers = random.Random(seed)
    words = ["the", "The", "of", "a\x01b", "a", "é", "日本", "x1", "new", "york", "city", "\x1f"]
    rows = []
    for i in range(150):
        text = "".join(numbers.choice(words) + numbers.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\r\n"]) for _ in range(60))
        rows.append((numbers.choice(["en", "de", None, "und"]), text + " new york city hall"))
    return [*rows, ("en", None), ("en", ""), ("fr", "only few"), ("en", "the of " * 4_000)]


@pytest.mark.parametrize(("least", "share", "top", "ranges"), [(30, 80, 2_000, None), (5, 60, 40, 1), (3, 80, 2_000, 23)])
def test_collocations_equal_brute_force(spark, least, share, top, ranges):
    rows = phrase_rows()
    table = spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], "doc_id long, lang string, text string, f string").repartition(5)
    out = collocations.collocations(table, least, share, top, ranges=ranges)
    expected = brute_collocations(rows, least, share, top)
    assert sorted(map(tuple, out.collect())) == expected and expected
    assert collocations.collocations(table.limit(0)).count() == 0


def test_small_blocks_and_a_full_bitmap_change_nothing(spark, monkeypatch):
    rows = phrase_rows(4)
    table = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    expected, _ = collocations.frequent_phrases(table, 10)
    expected = collected(expected)
    full = np.full(1 << 10, 255, np.uint8).tobytes()
    monkeypatch.setattr(collocations, "admission", lambda frequent, bits=0: spark.sparkContext.broadcast([(1 + i, full * 4) for i in range(2_048)]))
    found, _ = collocations.frequent_phrases(table, 10)
    assert collected(found) == expected


def test_score_products_beyond_64_bits(spark):
    big = 1 << 61
    rows = [("en", "a", big), ("en", "b", big + 5), ("en", "a b", big - 3), ("en", "c", 2 * big - 1), ("en", "b c", big - 4), ("en", "a b c", 40)]
    found = {r.phrase: r for r in collocations.candidates(spark.createDataFrame(rows, "lang string, phrase string, f long"), 80, 3).collect()}
    assert found["a b"].score == 2_000_000 * (big - 3) // (2 * big + 5)
    assert found["b c"].score == 2_000_000 * (big - 4) // (3 * big + 4)
    assert (found["a b c"].l, found["a b c"].r, found["a b c"].score) == (big, big - 4, 0)


@pytest.mark.parametrize("name", ["op11_line_dedup", "op12_conversations", "op13_collocations"])
def test_queries_equal_their_sql_on_awkward_rows(spark, tmp_path, name):
    import duckdb

    numbers = [(*r, "x") for r in random_conversations(9, 60, 9)]
    docs = [(i, t and t[-900:], None, "s", 0) for i, t in doc_rows()] + [(100 + i, t and t[:900], lang, "s", 0) for i, (lang, t) in enumerate(phrase_rows(6))]
    tables = {
        "conversations": spark.createDataFrame(numbers, "conv_id long, turn long, role string, text string, audit string"),
        "documents": spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"),
    }
    con = duckdb.connect()
    for table, frame in tables.items():
        frame.coalesce(1).write.parquet(str(tmp_path / f"{table}.parquet"))
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path / table}.parquet/*.parquet'")
    out = QUERIES[name](spark, str(tmp_path))
    theirs = con.execute(ORACLES[name])
    names = [d[0] for d in theirs.description]
    assert sorted(names) == sorted(out.columns)
    assert collected(out.select(names)) == sorted(theirs.fetchall(), key=str)
