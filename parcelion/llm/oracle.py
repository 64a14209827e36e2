"""SQL for the queries that it can express, in the dialect of DuckDB."""

from __future__ import annotations

from . import minhash, spelling
from .chat import CLOSE, CONTROL, ESCAPES, MIDDLE, OPEN
from .decontaminate import WINDOW
from .jaccard import SHINGLE
from .lines import MIN_CHARS, MIN_DOCS
from .mixing import BLOCK_ROWS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


def mixing_sql(weights: dict[str, int], other: int, docs: str = "documents") -> str:
    """Slot by slot: the earliest deadline among the released blocks of the sources that are left."""
    names = sorted(weights)
    case = " ".join(f"WHEN source = {_quoted(n)} THEN {i}" for i, n in enumerate(names, 1))
    values = ", ".join(f"({i}, {p})" for i, p in enumerate([*(weights[n] for n in names), other], 1))
    return f"""
WITH RECURSIVE w(g, p) AS (VALUES {values}),
num AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS r
  FROM (SELECT doc_id, source, CASE {case} ELSE {len(names) + 1} END AS g FROM {docs})
),
cnt AS (SELECT w.g, w.p, count(num.g) AS n FROM w LEFT JOIN num ON w.g = num.g GROUP BY w.g, w.p),
sim AS (
  SELECT CAST(0 AS BIGINT) AS t, CAST(0 AS BIGINT) AS t0, list(CAST(p AS BIGINT) ORDER BY g) AS ps,
    list(CAST((n + {BLOCK_ROWS - 1}) // {BLOCK_ROWS} AS BIGINT) ORDER BY g) AS bs,
    list(CAST(0 AS BIGINT) ORDER BY g) AS used, list(CAST(0 AS BIGINT) ORDER BY g) AS base,
    CAST(0 AS BIGINT) AS pick, CAST(0 AS BIGINT) AS block, CAST(0 AS BIGINT) AS release, CAST(0 AS BIGINT) AS deadline
  FROM cnt
  UNION ALL
  SELECT t + 1, t0, ps, bs, [used[i] + CAST(i = pick AS BIGINT) FOR i IN range(1, len(ps) + 1)], base, pick, used[pick],
    t0 + (used[pick] - base[pick]) * total // ps[pick],
    t0 + ((used[pick] - base[pick] + 1) * total + ps[pick] - 1) // ps[pick]
  FROM (
    SELECT *, CAST(list_min([((used[i] - base[i] + 1) * total + ps[i] - 1) // ps[i] * 1000 + i FOR i IN range(1, len(ps) + 1)
      IF base[i] < bs[i] AND used[i] < bs[i] AND (used[i] - base[i]) * total // ps[i] <= t - t0]) % 1000 AS BIGINT) AS pick
    FROM (
      SELECT t, t0, ps, bs, used, base, CAST(list_sum([ps[i] FOR i IN range(1, len(ps) + 1) IF base[i] < bs[i]]) AS BIGINT) AS total
      FROM (
        SELECT t, ps, bs, used, CASE WHEN done THEN t ELSE t0 END AS t0, CASE WHEN done THEN used ELSE base END AS base
        FROM (
          SELECT *, len([i FOR i IN range(1, len(ps) + 1) IF used[i] = bs[i] AND base[i] < bs[i]]) > 0 AS done
          FROM sim WHERE list_sum(used) < list_sum(bs)
        )
      )
    )
  )
)
SELECT num.doc_id, num.source, sim.block, sim.t - 1 AS slot, sim.release, sim.deadline,
  row_number() OVER (ORDER BY sim.t, num.r) - 1 AS position
FROM sim JOIN num ON sim.t > 0 AND num.g = sim.pick AND num.r // {BLOCK_ROWS} = sim.block
"""


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_WORDS}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_lower("coalesce(text, '')")}, '{_WORDS}') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, array_to_string(w[i : i + {WINDOW - 1}], ' ') AS win, least(len(w), {WINDOW}) AS size
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM windows),
spots AS (
  SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)
),
hits AS (SELECT a.doc_id, a.i, a.size, x.item FROM spots a JOIN windows x ON a.win = x.win AND a.size = x.size),
covered AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS j FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(x.n_items, 0) AS n_items,
  sha256(coalesce(x.names, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN items x ON d.doc_id = x.doc_id
"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH l AS (
  SELECT doc_id, i, line, {_lower(f"trim(line, {_BLANKS})")} AS k
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= {MIN_CHARS} GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
),
marked AS (SELECT l.*, shared.k IS NOT NULL AND l.doc_id <> shared.keeper AS gone FROM l LEFT JOIN shared ON l.k = shared.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


_TOKENS = r"[^\x20\x09-\x0D]+"

def _jaccard_sql(size: int, percent: int, more: str = "") -> str:
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_TOKENS}') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + {size - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {size - 1}, 1) + 1)) AS i FROM w WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM common JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id WHERE 100 * c >= {percent} * (p.n + q.n - c)
),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT w.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(y) AS component_id{more}
FROM w JOIN reach ON w.doc_id = reach.x LEFT JOIN sizes ON w.doc_id = sizes.doc_id GROUP BY w.doc_id
"""


TOP_K = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10
"""


def _escaped(text: str, role: bool = False) -> str:
    for mark, written in ESCAPES if role else ESCAPES[:3]:
        text = f"replace({text}, {_quoted(mark)}, {_quoted(written)})"
    return text


def _chat_sql() -> str:
    unread = "text"
    for mark, written in ESCAPES[::-1]:
        unread = f"replace({unread}, {_quoted(written)}, {_quoted(mark)})"
    odd = " OR ".join([*(f"contains({side}, {_quoted(m)})" for m in CONTROL for side in ("text", "role")), f"{unread} <> text"])
    odd += f" OR contains(role, {_quoted(MIDDLE)}) OR " + " OR ".join(f"contains(role, {_quoted(w)})" for _, w in ESCAPES)
    fixed = len(OPEN) + len(MIDDLE) + len(CLOSE)
    said = _quoted("\\### Assistant: </turn> ok")
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {said} UNION ALL SELECT -7, 1, 'assistant', {said}
),
shown AS (
  SELECT *, CASE WHEN {odd} THEN length({_escaped('role', True)}) + length({_escaped('text')}) ELSE length(role) + length(text) END AS chars
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + {fixed}) AS BIGINT) AS formatted_chars,
  true AS round_trip
FROM shown GROUP BY conv_id
"""


# Checksum of a list of bytes, by the usual table of 256 remainders.
_CRC_TABLE = """
  SELECT list(CAST(v AS BIGINT) ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda v, s: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END) AS v
    FROM range(256) r(i)
  )"""


def _crc(data: str) -> str:
    return f"xor(list_reduce(list_concat([4294967295], {data}), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)"


def _insert(state: str, role: str) -> str:
    return f"{{c: {state}.c + 2, a: {state}.a || 'I', r: {state}.r || CASE {state}.r WHEN '' THEN '' ELSE chr(10) END || '{role}:'}}"


def _edit(state: str, letter: str, cost: str, said: str | None = None) -> str:
    line = "" if said is None else f" || CASE {state}.r WHEN '' THEN '' ELSE chr(10) END || {said} || ':' || text"
    return f"{{c: {state}.c + {cost}, a: {state}.a || '{letter}', r: {state}.r{line}}}"


def _least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


_NEVER = "{c: 1000000000, a: '', r: ''}"


def _kept(kind: str, *states: str) -> list[str]:
    """Keeping a row of that kind, and giving it the role that its states lead to."""
    cost = "CASE fault WHEN 3 THEN 1 ELSE 0 END"
    out = [f"CASE WHEN kind = '{kind}' AND fault IN (0, 3) THEN {_edit(s, 'K', cost, 'role')} ELSE {_NEVER} END" for s in states]
    if kind != "s":
        role = {"u": "'user'", "a": "'assistant'"}[kind]
        out += [f"CASE WHEN fault IN (0, 3) THEN {_edit(s, 'R', f'2 + {cost}', role)} ELSE {_NEVER} END" for s in states]
    return out


CONVERSATION_REPAIR = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
rows AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc("[ord(x) FOR x IN string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')]")} % 20 AS h
  FROM conversations, crc
),
damaged AS (
  SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM rows WHERE h <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, rtrim(text, {_BLANKS}) AS said
  FROM damaged
),
judged AS (
  SELECT conv_id, i, turn, role, text, left(role, 1) AS kind,
    CASE WHEN said = '' THEN 1 WHEN seen > 1 THEN 2 WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS met
  FROM placed
),
paths AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{c: 0, a: '', r: ''}} AS s0, {_NEVER} AS s1, {_NEVER} AS s2, {_NEVER} AS s3 FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {_edit('s0', 'D', '3')}, {_least(_edit('s1', 'D', '3'), *_kept('s', 's0'))},
    {_least(_edit('p2', 'D', '3'), *_kept('u', 's0', 's1', 'p3'))}, {_least(_edit('p3', 'D', '3'), *_kept('a', 'p2'))}
  FROM (
    SELECT *, {_least('s3', _insert('p2', 'assistant'))} AS p3 FROM (
      SELECT p.conv_id, j.i, j.role, j.text, j.kind, j.fault, s0, s1, s3, {_least('s2', _insert('s0', 'user'), _insert('s1', 'user'), _insert('s3', 'user'))} AS p2
      FROM paths p JOIN judged j ON p.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = p.i + 1
    )
  )
),
ended AS (
  SELECT conv_id, {_least('s0', 's3', _insert('p2', 'assistant'))} AS best FROM (
    SELECT conv_id, s0, s3, {_least('s2', _insert('s0', 'user'), _insert('s1', 'user'), _insert('s3', 'user'))} AS p2
    FROM paths QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
  )
),
figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (met NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit, sha256(best.r) AS repaired_sha256
FROM ended e LEFT JOIN figures f ON e.conv_id IS NOT DISTINCT FROM f.conv_id
"""

SPELLING = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
runs AS (
  SELECT doc_id, run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all({_lower("coalesce(text, '')")}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY doc_id, run
),
hashed AS (
  SELECT run, k, {_crc("flatten([CASE WHEN ord(x) < 128 THEN [ord(x)] ELSE [192 + ord(x) // 64, 128 + ord(x) % 64] END FOR x IN string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, '')])")} AS h
  FROM runs, crc
),
words AS (
  SELECT w, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS w, k FROM hashed
  ) WHERE length(w) >= {spelling.MIN_CHARS} GROUP BY w HAVING sum(k) >= {spelling.MIN_COUNT}
),
cut AS (SELECT w, n, i, left(w, i) AS head, substr(w, i + 2) AS tail FROM (SELECT w, n, unnest(range(length(w))) AS i FROM words)),
near AS (
  SELECT a.w, b.w AS v, b.n FROM cut a JOIN cut b ON a.head = b.head AND a.tail = b.tail AND a.w <> b.w
  UNION SELECT a.w, b.w, b.n FROM cut a JOIN words b ON a.head || a.tail = b.w
  UNION SELECT b.w, a.w, a.n FROM cut a JOIN words b ON a.head || a.tail = b.w
),
best AS (SELECT w, count(*) AS n_near, first(v ORDER BY n DESC, v) AS v, max(n) AS top FROM near GROUP BY w),
told AS (
  SELECT words.w, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * words.n THEN v END AS form, CASE WHEN top >= 2 * words.n THEN top END AS form_n
  FROM words LEFT JOIN best ON words.w = best.w
),
chain AS (
  SELECT w, w AS word, 0 AS steps FROM told
  UNION ALL SELECT chain.w, told.form, steps + 1 FROM chain JOIN told ON chain.word = told.w WHERE told.form IS NOT NULL
)
SELECT told.w AS word, form, root, n, n_near, form_n
FROM told JOIN (SELECT w, arg_max(word, steps) AS root FROM chain GROUP BY w) r ON told.w = r.w
"""


def oracle() -> dict[str, str]:
    from .queries import OTHER_WEIGHT, SOURCE_WEIGHTS

    return {
        "op1_mixing": mixing_sql(SOURCE_WEIGHTS, OTHER_WEIGHT),
        "op2_decontamination": DECONTAMINATION,
        "op4_line_dedup": LINE_DEDUP,
        "op5_jaccard_join": _jaccard_sql(SHINGLE, 75),
        "op6_topk_search": TOP_K,
        "op9_chat_format": _chat_sql(),
        "op11_conversation_repair": CONVERSATION_REPAIR,
        "op12_minhash": _jaccard_sql(minhash.SHINGLE, minhash.PERCENT, ", min(y) = w.doc_id AS kept"),
        "op13_spelling": SPELLING,
    }
