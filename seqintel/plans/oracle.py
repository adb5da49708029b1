"""DuckDB twins of our queries (the correctness oracle).

SQL fragments mirror :mod:`seqintel.functions.text` one for one. DuckDB's
regex engine (RE2) has ASCII ``\\b``; where that matters the note says so.
"""

from __future__ import annotations

from .. import dictionaries as D
from ..functions.text import ANON_TOKEN_PATTERN, WS, WS_RUN


def q(s: str) -> str:
    """SQL string literal (DuckDB standard strings: backslashes are literal)."""
    return "'" + s.replace("'", "''") + "'"


def fp(x: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({x}, '')), {q(WS_RUN)}, ' ', 'g'))"


def fingerprint(body: str, title: str, user: str, thread: str) -> str:
    return (f"sha1({fp(body)} || '|' || {fp(title)} || '|' || {fp(user)} || '|' || "
            f"coalesce({thread}, ''))")


def _re2(p: str) -> str:
    # Java inline flag (?i) is also RE2 syntax; nothing else to translate.
    return p


def anonymize(x: str, salt: str = D.ANON_SALT) -> str:
    out = x
    for label, pat in D.PII_PATTERNS:
        token = f"'{label.upper()}_' || substr(sha256({q(salt + ':')} || m), 1, 16)"
        out = (f"list_reduce(regexp_extract_all({out}, {q(_re2(pat))}), "
               f"lambda acc, m: replace(acc, m, {token}), {out})")
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN {x} ELSE {out} END"


def clean(x: str) -> str:
    t = f"regexp_replace(coalesce({x}, ''), {q(WS_RUN)}, ' ', 'g')"
    t = f"regexp_replace({t}, '[^\\p{{L}}\\p{{N}}_ ]', ' ', 'g')"
    t = f"regexp_replace({t}, {q(ANON_TOKEN_PATTERN)}, {q(D.ANON_TOKEN_REPLACEMENT)}, 'g')"
    return f"lower(trim({t}))"


def normalize_term(x: str) -> str:
    t = f"regexp_replace(lower({x}), {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"
    t = f"regexp_replace({t}, {q('(?:' + WS + '|[-_./])+')}, ' ', 'g')"
    return f"regexp_replace({t}, {q(WS_RUN)}, ' ', 'g')"


def squash(x: str) -> str:
    return f"replace({normalize_term(x)}, ' ', '')"


def squash_fast(x: str) -> str:
    from ..functions.text import SEPARATORS
    return f"regexp_replace(lower({x}), {q(SEPARATORS + '+')}, '', 'g')"


FX_POSTS = f"""
fx_posts_base AS (
  SELECT 'msg_' || CAST(doc_id AS VARCHAR) AS message_id,
         'thread_' || lang AS thread_id,
         CAST(NULL AS VARCHAR) AS parent_id,
         min(source) OVER (PARTITION BY text) AS author,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id AS INTEGER)) AS ts,
         substr(text, 1, 40) AS title,
         text AS body,
         CAST(NULL AS VARCHAR) AS quoted,
         'http://' || source || '.onion/thread/' || CAST(doc_id // 20 AS VARCHAR) AS url,
         doc_id
  FROM documents),
fx_posts AS (
  SELECT *, {fingerprint('body', 'title', 'author', 'thread_id')} AS fingerprint FROM fx_posts_base)
"""


def dbl(v: float) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def phase_of_tech(t: str) -> str:
    exact = "CASE " + t + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in D.TECHNIQUE_PHASE.items()) + " END"
    base_expr = f"CASE WHEN instr({t}, '.') > 0 THEN regexp_extract({t}, '^(.*)\\.[^.]*$', 1) ELSE {t} END"
    base = "CASE " + base_expr + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in D.TECHNIQUE_PHASE.items()) + " END"
    return f"coalesce({exact}, {base})"


def phase_of_list(lst: str) -> str:
    return (f"CAST(coalesce(list_max(list_transform({lst}, lambda t: {phase_of_tech('t')})), "
            f"{D.DEFAULT_PHASE}) AS INTEGER)")


def _tech_arr(*xs) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]::VARCHAR[]"


FX_TECH = f"""
fx_events AS (
  SELECT CAST(user_id AS VARCHAR) AS author, ts, event_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
fx_tech AS (
  SELECT author, ts, event_id, CAST(event_id AS VARCHAR) AS message_id, event_type, value,
    CASE
      WHEN event_type = 'view' THEN CASE WHEN k % 3 = 2 THEN {_tech_arr('T1583.001')} ELSE {_tech_arr('T1046')} END
      WHEN event_type = 'signup' THEN CASE WHEN k % 3 = 0 THEN {_tech_arr('T1566')}
           WHEN k % 3 = 1 THEN {_tech_arr('T1566', 'T1190')} ELSE {_tech_arr('T1189')} END
      WHEN event_type = 'click' THEN CASE WHEN k % 3 = 0 THEN {_tech_arr('T1190')}
           WHEN k % 3 = 1 THEN {_tech_arr('T1547.001', 'T1190')} ELSE {_tech_arr('T1059.001')} END
      WHEN event_type = 'purchase' THEN CASE WHEN k % 3 = 0 THEN {_tech_arr('T1071.001')}
           WHEN k % 3 = 1 THEN {_tech_arr('T1003.003')} ELSE {_tech_arr('T1005')} END
      WHEN event_type = 'error' THEN CASE WHEN k % 3 = 2 THEN {_tech_arr('T1005', 'T1046')} ELSE {_tech_arr()} END
      ELSE {_tech_arr()} END AS techniques
  FROM fx_events),
fx_phase AS (
  SELECT *, {phase_of_list('techniques')} AS phase FROM fx_tech),
fx_seq AS (
  SELECT author, list(phase ORDER BY ts, event_id) FILTER (WHERE len(techniques) > 0) AS seq,
         CAST(count(*) FILTER (WHERE len(techniques) = 0) AS BIGINT) AS n_dropped
  FROM fx_phase GROUP BY author HAVING count(*) FILTER (WHERE len(techniques) > 0) > 0)
"""


def _sum(terms: list[str]) -> str:
    out = "CAST(0.0 AS DOUBLE)"
    for t in terms:
        out = f"({out} + {t})"
    return out


def forward_sql(seq: str, m) -> str:
    S = m.n_states
    B = [[dbl(x) for x in r] for r in m.emit]
    A = [[dbl(x) for x in r] for r in m.trans]
    brow = [f"[{', '.join(B[j])}][o + 1]" for j in range(S)]
    a1 = [f"({dbl(m.start[j])} * [{', '.join(B[j])}][{seq}[1] + 1])" for j in range(S)]
    c1 = _sum(a1)
    init = ("{'a': [" + ", ".join(f"{a1[j]} / {c1}" for j in range(S)) + "], 'll': ln(" + c1 + ")}")
    nxt = [f"({_sum([f'(acc.a[{i + 1}] * {A[i][j]})' for i in range(S)])} * {brow[j]})" for j in range(S)]
    c = _sum(nxt)
    step = ("{'a': [" + ", ".join(f"{nxt[j]} / {c}" for j in range(S)) + "], 'll': acc.ll + ln(" + c + ")}")
    return (f"CASE WHEN len({seq}) > 0 THEN list_reduce({seq}[2:], lambda acc, o: {step}, {init}).ll END")


def em_step_sql(seqs: str, m) -> str:
    """CTEs of one EM step over a table (author, seq): ``em`` holds (kind, i, j, expected, p).

    Forward and backward vectors come from two recursions over the places."""
    S, M = m.n_states, m.n_symbols
    A, B = [[dbl(x) for x in r] for r in m.trans], [[dbl(x) for x in r] for r in m.emit]

    def at(j, o):
        return f"[{', '.join(B[j])}][{o} + 1]"

    def scaled(exprs, name):
        return ", ".join(f"{x} AS u{j}" for j, x in enumerate(exprs)), ", ".join(f"u{j} / ({' + '.join(f'u{i}' for i in range(S))}) AS {name}{j}"
                                                                                for j in range(S))
    total = " + ".join(f"u{j}" for j in range(S))
    first, a_cols = scaled([f"{dbl(m.start[j])} * {at(j, 'seq[1]')}" for j in range(S)], "a")
    ahead, _ = scaled([f"({' + '.join(f'a{i} * {A[i][j]}' for i in range(S))}) * {at(j, 'seq[t + 1]')}" for j in range(S)], "a")
    back, b_cols = scaled([" + ".join(f"{A[i][j]} * {at(j, 'seq[t]')} * b{j}" for j in range(S)) for i in range(S)], "b")
    gamma = " + ".join(f"a{i} * b{i}" for i in range(S))
    joint = [[f"f.a{i} * {A[i][j]} * {at(j, 'f.seq[f.t + 1]')} * b.b{j}" for j in range(S)] for i in range(S)]
    every = " + ".join(x for row in joint for x in row)
    rows = ([f"SELECT 'start' AS kind, {i} AS i, NULL::INTEGER AS j, sum(a{i} * b{i} / ({gamma})) AS expected FROM g WHERE t = 1" for i in range(S)]
            + [f"SELECT 'emit', {i}, {k}, sum(CASE WHEN seq[t] = {k} THEN a{i} * b{i} / ({gamma}) ELSE 0 END) FROM g" for i in range(S) for k in range(M)]
            + [f"SELECT 'trans', {i}, {j}, sum(x[{i * S + j + 1}]) FROM x" for i in range(S) for j in range(S)]
            + ["SELECT 'loglik', 0, NULL, sum(ln(c)) FROM f"])
    cells = ", ".join(f"({x}) / z" for row in joint for x in row)
    return f"""
f AS (SELECT author, seq, 1 AS t, {total} AS c, {a_cols} FROM (SELECT author, seq, {first} FROM {seqs} WHERE len(seq) >= 2)
      UNION ALL SELECT author, seq, t + 1, {total}, {a_cols} FROM (SELECT author, seq, t, {ahead} FROM f WHERE t < len(seq))),
b AS (SELECT author, seq, len(seq) AS t, {', '.join(f'1.0 / {S} AS b{i}' for i in range(S))} FROM {seqs} WHERE len(seq) >= 2
      UNION ALL SELECT author, seq, t - 1, {b_cols} FROM (SELECT author, seq, t, {back} FROM b WHERE t > 1)),
g AS (SELECT f.*, {', '.join(f'b{i}' for i in range(S))} FROM f JOIN b ON f.author = b.author AND f.t = b.t),
x AS (SELECT [{cells}] AS x FROM (SELECT f.*, {every} AS z FROM f JOIN b ON f.author = b.author AND f.t + 1 = b.t) f
      JOIN b ON f.author = b.author AND f.t + 1 = b.t),
em0 AS ({' UNION ALL '.join(rows)}),
em AS (SELECT *, CASE WHEN kind <> 'loglik' THEN expected / nullif(sum(expected) OVER (PARTITION BY kind, CASE WHEN kind <> 'start' THEN i END), 0) END AS p
       FROM em0)"""


def viterbi_sql(seq: str, m) -> str:
    """struct {d: last deltas, p: paths}; best path = p[argmax d]."""
    import math
    S = m.n_states

    def lg(p):
        return dbl(math.log(p)) if p > 0 else "CAST('-inf' AS DOUBLE)"
    lA = [[lg(x) for x in r] for r in m.trans]
    lB = [[lg(x) for x in r] for r in m.emit]
    init = ("{'d': [" + ", ".join(f"({lg(m.start[j])} + [{', '.join(lB[j])}][{seq}[1] + 1])" for j in range(S))
            + "], 'p': [" + ", ".join(f"[{j}]" for j in range(S)) + "]}")
    cands = [f"[{', '.join(f'(acc.d[{i + 1}] + {lA[i][j]})' for i in range(S))}]" for j in range(S)]
    d = [f"(list_max({cands[j]}) + [{', '.join(lB[j])}][o + 1])" for j in range(S)]
    p = [f"list_append(acc.p[list_position({cands[j]}, list_max({cands[j]}))], {j})" for j in range(S)]
    step = "{'d': [" + ", ".join(d) + "], 'p': [" + ", ".join(p) + "]}"
    return f"list_reduce({seq}[2:], lambda acc, o: {step}, {init})"


def vit_path(v: str) -> str:
    return f"{v}.p[list_position({v}.d, list_max({v}.d))]"


def next_table_sql(m) -> str:
    rows = m.next_table()
    return "[" + ", ".join("[" + ", ".join(dbl(x) for x in r) + "]" for r in rows) + "]"


PHASE_NAMES_SQL = "[" + ", ".join(q(n) for _, n, _ in D.PHASES) + "]"


def normalize_url(u: str, marker: str = ".onion") -> str:
    x = f"trim(regexp_replace(split_part(split_part({u}, '#', 1), '?', 1), {q('^' + WS + '+|' + WS + '+$')}, '', 'g'))"
    suffix = " OR ".join(f"ends_with({x}, {q(s)})" for s in D.SKIPPED_URL_SUFFIXES)
    return (f"CASE WHEN NOT contains({x}, {q(marker)}) OR {suffix} THEN NULL "
            f"WHEN starts_with({x}, 'http://') OR starts_with({x}, 'https://') THEN {x} ELSE 'http://' || {x} END")


def resolve(h: str, base: str) -> str:
    from ..operators.extract import ORIGIN
    origin = f"regexp_extract({base}, {q(ORIGIN)}, 1)"
    return (f"CASE WHEN regexp_matches({h}, '(?i)^https?://') THEN {h} "
            f"WHEN starts_with({h}, '//') THEN 'http:' || {h} "
            f"WHEN starts_with({h}, '/') AND {origin} <> '' THEN {origin} || {h} ELSE {h} END")


def visible_text(h: str) -> str:
    from ..operators.extract import VISIBLE_DROP
    t = f"regexp_replace({h}, {q(VISIBLE_DROP)}, ' ', 'g')"
    t = f"regexp_replace({t}, '(?s)<[^>]*>', ' ', 'g')"
    return f"trim(regexp_replace({t}, {q(WS_RUN)}, ' ', 'g'))"


def attr_links(h: str) -> str:
    from ..operators.extract import ATTR_LINK
    return (f"list_concat(regexp_extract_all({h}, {q(ATTR_LINK.format(attr='href'))}, 1), "
            f"regexp_extract_all({h}, {q(ATTR_LINK.format(attr='src'))}, 1))")


def text_links(h: str) -> str:
    from ..operators.extract import TEXT_ONION_URL
    return f"regexp_extract_all({visible_text(h)}, {q(TEXT_ONION_URL)})"


def thread_id(url: str, html: str) -> str:
    parts = [f"nullif(regexp_extract({url}, {q(D.THREAD_URL_PATTERN)}, 1), '')"]
    for a in D.THREAD_ATTRIBUTES:
        pat = r"(?i)[\s'\"]" + a.replace("-", r"\-") + r"\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
        parts.append(f"CASE WHEN regexp_extract({html}, {q(pat)}, 0) = '' THEN NULL ELSE "
                     f"coalesce(nullif(regexp_extract({html}, {q(pat)}, 1), ''), "
                     f"nullif(regexp_extract({html}, {q(pat)}, 2), ''), regexp_extract({html}, {q(pat)}, 3)) END")
    parts.append(f"substr(sha1({url}), 1, 16)")
    return "'thread_' || coalesce(" + ", ".join(parts) + ")"


def fetch_outcome(status: str, req: str, fin: str) -> str:
    from ..operators.report import URL_AUTHORITY, URL_PATH
    ra, fa = f"regexp_extract({req}, {q(URL_AUTHORITY)}, 1)", f"regexp_extract({fin}, {q(URL_AUTHORITY)}, 1)"
    rp, fp_ = f"lower(regexp_extract({req}, {q(URL_PATH)}, 1))", f"lower(regexp_extract({fin}, {q(URL_PATH)}, 1))"
    words = " OR ".join(f"contains({rp}, {q(w)})" for w in D.BAN_REQUEST_WORDS)
    land = ", ".join(q(p) for p in D.BAN_LANDING_PATHS)
    ban = f"({req} <> {fin} AND {ra} = {fa} AND ({words}) AND {fp_} IN ({land}))"
    return (f"CASE WHEN {status} = 403 OR {ban} THEN 'blocked' WHEN {status} >= 500 THEN 'server_error' "
            f"WHEN {status} <> 200 THEN 'http_error' ELSE 'ok' END")


FX_FETCH = """
fx_fetch_base AS (
  SELECT event_id, ts, event_type, 'http://h' || CAST(user_id AS VARCHAR) || '.onion' AS host,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
fx_fetch AS (
  SELECT event_id, ts, host, host || '/thread/' || CAST(k AS VARCHAR) AS requested_url,
         CASE WHEN event_type = 'click' AND k % 25 = 0 THEN host || '/login' ELSE host || '/thread/' || CAST(k AS VARCHAR) END AS final_url,
         CASE WHEN event_type = 'error' THEN 503 WHEN event_type = 'signup' THEN 403
              WHEN event_type = 'view' AND k % 10 = 0 THEN 404 ELSE 200 END AS status
  FROM fx_fetch_base)
"""

FX_REPLIES = """
fx_replies AS (
  SELECT CAST(conv_id AS VARCHAR) AS url, CAST(turn AS VARCHAR) AS raw_id, turn AS idx,
         CASE WHEN turn > 0 THEN CAST(turn - 1 AS VARCHAR) END AS parent_raw, role AS author, text AS body
  FROM conversations)
"""


def message_id(url: str, raw: str, idx: str) -> str:
    return f"'msg_' || substr(sha1({url} || '|' || {raw} || '|' || CAST({idx} AS VARCHAR)), 1, 16)"


def parent_id(url: str, parent_raw: str) -> str:
    return (f"CASE WHEN {parent_raw} IS NOT NULL AND {parent_raw} <> '' THEN "
            f"'msg_' || substr(sha1({url} || '|' || {parent_raw}), 1, 16) END")
