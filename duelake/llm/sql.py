"""SQL for DuckDB that gives the rows of the queries that SQL can express."""

from __future__ import annotations

#: The white space that separates words, for the trim functions.
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = f"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
    SELECT row, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs
), keyed AS (
    SELECT *, {_FOLD.format(f"trim(line, {_SPACE})")} AS key FROM lines
), common AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT row) >= 10
), marked AS (
    SELECT k.*, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row
"""


def _then(state: str, cost: str, edit: str, when: str = "true") -> str:
    """A state's (cost, edits) with one more edit, null where it cannot be taken."""
    return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 't': {state}.t || '{edit}'}} END"


def _least(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


_STATE = "STRUCT(c BIGINT, t VARCHAR)"
# The CRC's fixed values: the reversed polynomial and the start value.
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(named, ''), lambda x: ascii(x)::BIGINT)), "
    "lambda x, b: list_reduce(list_prepend(xor(x, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
    "lambda y, z: CASE WHEN (y & 1) = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END)), 4294967295::BIGINT)"
)

CONVERSATIONS = f"""
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS named
    FROM conversations
), dealt AS (
    SELECT *, {_CRC} % 20 AS fault FROM named
), damaged AS (
    SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM dealt WHERE fault <> 0
    UNION ALL
    SELECT conv_id, turn, role, text FROM dealt WHERE fault = 3
), placed_rows AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
        trim(text, {_SPACE}) AS body, substr(role, 1, 1) AS initial
    FROM placed_rows
), rows AS (
    SELECT *, CASE WHEN body = '' THEN 'blank' WHEN again THEN 'duplicate'
            WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
    FROM ordered
), convs AS (
    SELECT DISTINCT conv_id FROM conversations
), walk AS (
    SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 't': ''}}::{_STATE} AS e, NULL::{_STATE} AS s, NULL::{_STATE} AS u, NULL::{_STATE} AS a
    FROM convs
    UNION ALL
    SELECT conv_id, n, {_then("e", "3", "D")},
        {_least(_then("s", "3", "D"), _then("e", "extra", "K", "stays AND initial = 's'"))},
        {_least(_then("u1", "3", "D"), *(_then(x, "extra", "K", "stays AND initial = 'u'") for x in ("e", "s", "a1")),
                *(_then(x, "extra + 2", "R", "stays") for x in ("e", "s", "a1")))},
        {_least(_then("a1", "3", "D"), _then("u1", "extra", "K", "stays AND initial = 'a'"), _then("u1", "extra + 2", "R", "stays"))}
    FROM (
        SELECT *, {_least("a", _then("u1", "2", "I"))} AS a1 FROM (
            SELECT w.conv_id, r.i AS n, w.e, w.s, w.a, r.initial, r.fault NOT IN ('blank', 'duplicate') AS stays,
                CASE r.fault WHEN 'truncated' THEN 1 ELSE 0 END AS extra,
                {_least("w.u", *(_then(f"w.{x}", "2", "I") for x in "esa"))} AS u1
            FROM walk w JOIN rows r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
        )
    )
), ends AS (
    SELECT conv_id, {_least("e", "a", _then("u1", "2", "I"))} AS best FROM (
        SELECT *, {_least("u", *(_then(x, "2", "I") for x in "esa"))} AS u1 FROM walk
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
    )
), edits AS (
    SELECT conv_id, unnest(string_split(best.t, '')) AS edit, generate_subscripts(string_split(best.t, ''), 1) AS j
    FROM ends WHERE best.t <> ''
), placed AS (
    SELECT *, count(*) FILTER (edit <> 'I') OVER before AS i, count(*) FILTER (edit <> 'D') OVER before AS m
    FROM edits WINDOW before AS (PARTITION BY conv_id ORDER BY j)
), filled AS (
    SELECT p.conv_id, p.edit, p.j, p.m, r.role, r.text,
        bool_or(p.m = 1 AND p.edit = 'K' AND r.initial = 's') OVER (PARTITION BY p.conv_id) AS led
    FROM placed p LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i AND p.edit <> 'I'
), repaired AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (m - led::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS body
    FROM filled WHERE edit <> 'D' GROUP BY conv_id
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM rows GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.t AS audit,
    sha256(coalesce(body, '')) AS repaired_sha256
FROM ends e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
    LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM e.conv_id
"""

COLLOCATIONS = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex({_FOLD.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words FROM pieces
), phrases AS (
    SELECT lang, array_to_string(list_slice(words, i, i + size - 1), ' ') AS phrase, size
    FROM (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded), (SELECT unnest([1, 2, 3, 4]) AS size)
    WHERE i + size - 1 <= len(words)
), counts AS (
    SELECT lang, phrase, size, count(*) AS f FROM phrases GROUP BY ALL
), sizes AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS words FROM counts WHERE size > 1 AND f >= 30
), cuts AS (
    SELECT *, array_to_string(words[:k], ' ') AS head, array_to_string(words[k + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, h.f AS l, t.f AS r, ((2000000::HUGEINT * c.a) // (h.f + t.f)::HUGEINT)::BIGINT AS score
    FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = c.head JOIN counts t ON t.lang = c.lang AND t.phrase = c.tail
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
    SELECT lang, array_to_string(words[i:i + part - 1], ' ') AS phrase, max(a) AS around
    FROM (SELECT lang, words, a, size, part, unnest(range(1, size - part + 2)) AS i
        FROM candidates, (SELECT unnest([2, 3]) AS part) WHERE part < size)
    GROUP BY ALL
), kept AS (
    SELECT b.* FROM best b LEFT JOIN inner_phrases i USING (lang, phrase)
    WHERE around IS NULL OR 100::HUGEINT * around < 80::HUGEINT * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
) JOIN sizes USING (lang) WHERE rank <= 2000
"""
