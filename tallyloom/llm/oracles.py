"""SQL for the queries that SQL can express, for whole tables."""

from __future__ import annotations

from tallyloom.llm.license_scan import K, NEAR, PHRASES, SHARE, TEMPLATES


def _lists(rows) -> str:
    return ", ".join(f"({i}, string_split('{text}', ' '), '{label}')" for i, (text, label) in enumerate(rows))


# crc32 of a text as SQL: the table of 256 remainders, then one look-up per byte.
_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc_of
  FROM range(256) AS b(i)
)"""


def _crc32(text: str) -> str:
    byte = f"list_transform(range(0, octet_length(encode({text})), 1), lambda i: ('0x' || substr(hex(encode({text})), 2 * i::INTEGER + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte}), lambda c, b: xor(crc_of[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT)"


def _words(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"list_filter(string_split_regex({lower}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"


def _way(state: str, cost: str, letter: str, row: str = "") -> str:
    """The ways of edits of a state with one edit more; null where there is none."""
    out = f"list_append({state}.o, {row})" if row else f"{state}.o"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {out}}} END"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _kept(state: str, initial: str) -> str:
    return f"CASE WHEN NOT gone AND initial = '{initial}' THEN {_way(state, 'cut', 'K', 'role || chr(58) || text')} END"


def _renamed(state: str, role: str) -> str:
    return f"CASE WHEN NOT gone THEN {_way(state, '2 + cut', 'R', f'{chr(39)}{role}:{chr(39)} || text')} END"


_NEW_USER = _least("u", *[_way(x, "2", "I", "'user:'") for x in ("z", "s", "a")])
_NEW_ASSISTANT = _least("a", _way("u1", "2", "I", "'assistant:'"))

ORACLES: dict[str, str] = {
    "op2_suffix_array_dedup": """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents
), w AS (
  SELECT doc_id, pos, md5_number(substr(hx, 2 * pos + 1, 200)) AS span
  FROM (SELECT doc_id, hx, unnest(range(0, greatest(length(hx) // 2 - 99, 0))) AS pos FROM d)
), r AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY span ORDER BY doc_id, pos) AS nth FROM w
), g AS (
  SELECT doc_id, pos, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS run
  FROM (SELECT doc_id, pos, CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 100 THEN 0 ELSE 1 END AS fresh FROM r WHERE nth > 1)
), runs AS (
  SELECT doc_id, min(pos) AS a, max(pos) + 100 AS b FROM g GROUP BY doc_id, run
), cut AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs
), k AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
         string_agg(substr(hx, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM cut JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, length(hx) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(hx, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
""",
    "op6_url_filters": """
WITH a AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), b AS (
  SELECT page_id, coalesce(rest, '') AS rest, regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1) AS raw FROM a
), u AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) AS path FROM b
), r(rule, h, p, v) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), f AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS v
  FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
)
SELECT page_id, host, path, f.rule AS rule, coalesce(f.v, 'allow') AS verdict FROM u LEFT JOIN f USING (page_id)
""",
    "op7_jaccard_join": r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM t WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 5 * common >= 4 * (x.size + y.size - common)
), reach AS (
  SELECT u, v FROM e UNION SELECT reach.u, e.v FROM reach JOIN e ON reach.v = e.u
), c AS (
  SELECT u AS doc_id, min(least(u, v)) AS class_id FROM reach GROUP BY u
), l AS (
  SELECT u AS doc_id, count(*) AS n_links FROM e GROUP BY u
)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0) AS n_links FROM t LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id)
""",
    "op9_license_scans": rf"""
WITH t AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), places AS (
  SELECT doc_id, w, unnest(range(len(w))) AS i FROM t
), phrase(id, words, label) AS (VALUES {_lists(PHRASES)}),
base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS own
  FROM places JOIN phrase ON w[i + 1] = words[1] AND w[i + 1 : i + len(words)] = words GROUP BY doc_id
), template(id, words, label) AS (VALUES {_lists(TEMPLATES)}),
grams AS (
  SELECT id, label, len(words) - {K - 1} AS n_grams, j AS t_pos, words[j + 1 : j + {K}] AS gram
  FROM (SELECT *, unnest(range(len(words) - {K - 1})) AS j FROM template)
), hits AS (
  SELECT doc_id, id, label, n_grams, i AS pos, t_pos, i - t_pos AS diagonal
  FROM places JOIN grams ON w[i + 1 : i + {K}] = gram WHERE i <= len(w) - {K}
), diagonals AS (
  SELECT doc_id, id, diagonal, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, id ORDER BY diagonal) <= {NEAR} THEN 0 ELSE 1 END AS fresh
  FROM (SELECT DISTINCT doc_id, id, diagonal FROM hits)
), merged AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id, id ORDER BY diagonal) AS span FROM diagonals
), spans AS (
  SELECT doc_id, label, count(DISTINCT t_pos) / n_grams AS share, max(pos) - min(pos) + 1 <= 2 * n_grams + {K} AS fits
  FROM hits JOIN merged USING (doc_id, id, diagonal) GROUP BY doc_id, id, label, n_grams, span
), found AS (
  SELECT doc_id, max(share) AS share, list(DISTINCT label) FILTER (WHERE share >= {SHARE} AND fits) AS labels FROM spans GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(own), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(labels, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM t LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)
""",
    "op12_importance_resampling": f"""
WITH {_CRC_TABLE}, t AS (
  SELECT doc_id, {_words("text")} AS w FROM documents
), b AS (
  SELECT {_words("text")} AS w FROM benchmark
), words AS (
  SELECT DISTINCT unnest(w) AS word FROM (SELECT w FROM t UNION ALL SELECT w FROM b)
), coded AS (
  SELECT word, {_crc32("word")} % 10000 AS bucket FROM words, crc_table
), f AS (
  SELECT doc_id, bucket FROM (SELECT doc_id, unnest(w) AS word FROM t) JOIN coded USING (word)
), s AS (
  SELECT bucket, count(*)::DOUBLE AS s FROM f GROUP BY bucket
), g AS (
  SELECT bucket, count(*)::DOUBLE AS t FROM (SELECT unnest(w) AS word FROM b) JOIN coded USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000) / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM g) + 10000))))::BIGINT AS gain
  FROM s FULL JOIN g USING (bucket)
), w AS (
  SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS weight FROM f JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM t LEFT JOIN w USING (doc_id)
), drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN (SELECT doc_id, rank FROM drawn WHERE rank <= 10 * n // 100) USING (doc_id)
""",
    "op11_conversation_repair": f"""
WITH RECURSIVE {_CRC_TABLE}, raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place FROM conversations
), coded AS (
  SELECT conv_id, turn, role, text, {_crc32("place")} % 20 AS kind FROM raw, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM coded, (SELECT unnest([1, 2]) AS copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown, left(role, 1) AS initial FROM damaged
), faulty AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS two FROM placed
), r AS (
  SELECT conv_id, pos, role, text, turn, initial, two, shown = '' AS blank, shown <> '' AND again AS duplicate, shown = '' OR again AS gone,
         (shown <> '' AND NOT again AND right(shown, 1) NOT IN ('.', '!', '?'))::BIGINT AS cut FROM faulty
), dp AS (
  SELECT conv_id, 0::BIGINT AS pos, {{'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]}} AS z, NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR[]) AS s,
         NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR[]) AS u, NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR[]) AS a
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, pos, {_way("z", "3", "D")}, {_least(_way("s", "3", "D"), _kept("z", "s"))},
         {_least(_way("u1", "3", "D"), *[f(x, y) for x in ("z", "s", "a1") for f, y in ((_kept, "u"), (_renamed, "user"))])},
         {_least(_way("a1", "3", "D"), _kept("u1", "a"), _renamed("u1", "assistant"))}
  FROM (SELECT *, {_NEW_ASSISTANT} AS a1 FROM (
          SELECT dp.conv_id, r.pos, z, s, u, a, role, text, initial, gone, cut, {_NEW_USER} AS u1
          FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.pos = dp.pos + 1))
), last AS (
  SELECT conv_id, unnest(arg_max([{{'z': z, 's': s, 'u': u, 'a': a}}], pos)) AS v FROM dp GROUP BY conv_id
), ended AS (
  SELECT conv_id, {_least("z", "a1")} AS best FROM (
    SELECT *, {_NEW_ASSISTANT} AS a1 FROM (SELECT conv_id, z, a, {_NEW_USER} AS u1 FROM (SELECT conv_id, v.z AS z, v.s AS s, v.u AS u, v.a AS a FROM last)))
), facts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
         sum(cut)::BIGINT AS truncated, count(*) FILTER (WHERE two NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, best.c AS cost, best.a AS audit, sha256(array_to_string(best.o, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN facts f ON e.conv_id IS NOT DISTINCT FROM f.conv_id
""",
}
