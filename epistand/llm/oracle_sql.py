"""DuckDB SQL of the spelling and conversation queries."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """crc32 of a text's UTF-8 bytes: half a byte a step, the lower half first."""
    table = []
    for i in range(16):
        for _ in range(4):
            i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
        table.append(i)
    halves = (f"flatten(list_transform(range(0, length(hex({text})) // 2), lambda i: "
              f"[instr('123456789ABCDEF', substr(hex({text}), 2 * i + 2, 1)), instr('123456789ABCDEF', substr(hex({text}), 2 * i + 1, 1))]))")
    step = f"lambda s, x: xor(({table})[(xor(s, x) & 15) + 1], s >> 4)"
    return f"xor(list_reduce(list_concat([4294967295::bigint], list_transform({halves}, lambda x: x::bigint)), {step}), 4294967295)"


OP12 = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') run
  FROM documents),
hashed AS (SELECT run, c, {crc32_sql("coalesce(doc_id::varchar, '') || ':' || run")} h
  FROM (SELECT doc_id, run, count(*) c FROM runs GROUP BY ALL) WHERE length(run) >= 5),
vocabulary AS (SELECT word, sum(c)::bigint n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) ELSE run END word, c FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
less AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i::int - 1) || substr(word, i::int + 1) m
  FROM (SELECT *, unnest(range(1, length(word) + 1)) i FROM vocabulary)),
near AS MATERIALIZED (
  SELECT a.word, a.n, b.word near, b.n near_n FROM less a JOIN less b ON a.i = b.i AND a.m = b.m AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN vocabulary b ON a.m = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN vocabulary b ON a.m = b.word),
best AS (SELECT word, count(*) OVER (PARTITION BY word) n_near, near, near_n, n FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
forms AS MATERIALIZED (SELECT v.word, v.n, coalesce(b.n_near, 0) n_near, CASE WHEN b.near_n >= 2 * v.n THEN b.near END form,
    CASE WHEN b.near_n >= 2 * v.n THEN b.near_n END form_n
  FROM vocabulary v LEFT JOIN best b ON v.word = b.word),
chain AS (SELECT word, word root, 0 depth FROM forms
  UNION ALL SELECT c.word, f.form, c.depth + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n
FROM forms f JOIN (SELECT word, max_by(root, depth) root FROM chain GROUP BY word) c ON f.word = c.word"""


def _op13() -> str:
    space = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    item = lambda c, a, lines: f"{{'c': ({c})::bigint, 'a': {a}, 'l': {lines}}}"
    after = lambda state, price, edit, line: item(f"p.{state}.c + {price}", f"'{edit}' || p.{state}.a", f"list_concat([{line}], p.{state}.l)")
    gone = lambda state: item(f"p.{state}.c + 4", f"'D' || p.{state}.a", f"p.{state}.l")
    kept_line = "r.role || ':' || r.text"

    # role turn: kept if the row has that initial, else reroled; dropped where the row must go
    def turn(to, initial, name):
        kept = after(to, "r.more", "K", kept_line)
        changed = after(to, "r.more + 3", "R", f"'{name}:' || r.text")
        return f"CASE WHEN r.must THEN NULL WHEN r.initial = '{initial}' THEN {kept} ELSE {changed} END"

    best = lambda *options: f"list_min(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))"
    put = lambda frm, name: item(f"{frm}.c + 3", f"'I' || {frm}.a", f"list_concat(['{name}:'], {frm}.l)")
    system = f"CASE WHEN NOT r.must AND r.initial = 's' THEN {after('s', 'r.more', 'K', kept_line)} END"
    no = "[]::varchar[]"
    return f"""
WITH RECURSIVE hashed AS (SELECT conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') body,
    {crc32_sql("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 k FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(body, '.!?', '') ELSE body END text,
    unnest(range(CASE WHEN k = 0 THEN 0 WHEN k = 3 THEN 2 ELSE 1 END)) copy FROM hashed),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) pos FROM damaged),
faults AS (SELECT *, substr(role, 1, 1) initial, rtrim(text, {space}) solid,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 again,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) before FROM placed),
marked AS MATERIALIZED (SELECT *, solid = '' blank, solid <> '' AND again duplicate,
    solid <> '' AND NOT again AND right(solid, 1) NOT IN ('.', '!', '?') truncated, solid = '' OR again must,
    CASE WHEN solid <> '' AND NOT again AND right(solid, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END more FROM faults),
path AS (
  SELECT conv_id, max(pos) + 1 pos, {item(0, "''", no)} o, {item(6, "'II'", "['user:', 'assistant:']")} s,
    {item(3, "'I'", "['assistant:']")} u, {item(0, "''", no)} a FROM marked GROUP BY conv_id
  UNION ALL
  SELECT conv_id, pos, {best('o', put('u', 'user'))}, {best('s', put('u', 'user'))}, u, a FROM (
    SELECT conv_id, pos, o, s, {best('u', put('a', 'assistant'))} u, {best('a', put('u', 'user'))} a FROM (
      SELECT p.conv_id, r.pos, {best(gone('o'), turn('u', 'u', 'user'), system)} o, {best(gone('s'), turn('u', 'u', 'user'))} s,
        {best(gone('u'), turn('a', 'a', 'assistant'))} u, {best(gone('a'), turn('u', 'u', 'user'))} a
      FROM path p JOIN marked r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.pos = p.pos - 1))),
found AS (SELECT conv_id, o FROM path WHERE pos = 1),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) gaps, count(*) FILTER (WHERE blank) blank,
    count(*) FILTER (WHERE duplicate) duplicate, count(*) FILTER (WHERE truncated) truncated,
    count(*) FILTER (WHERE pos > 1 AND before || initial NOT IN ('su', 'ua', 'au')) illegal FROM marked GROUP BY conv_id)
SELECT i.conv_id, coalesce(gaps, 0)::bigint gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated,
  coalesce(illegal, 0) illegal, coalesce(o.c, 0) AS cost, coalesce(o.a, '') audit,
  sha256(coalesce(array_to_string(o.l, chr(10)), '')) repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM i.conv_id"""


OP13 = _op13()
