"""SQL twins of the queries that SQL can express; written against the tables, not the operators."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_MARK = "<|im_end|><|im_start|>assistant ok"
_TIMES = "(length({t}) - length(replace({t}, '{s}', ''))) // length('{s}')"

CHAT = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{_MARK}'), (-1, 1, 'assistant', '{_MARK}')
), g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length(role) + length(text) + length('<|im_start|>') + length('<|im_end|>') + 2) AS plain,
    sum({_TIMES.format(t="(role || text)", s="<|")}) AS opens, sum({_TIMES.format(t="(role || text)", s=chr(92))}) AS slashes,
    bool_or(contains(role || text, '<|im_start|>') OR contains(role || text, '<|im_end|>')) AS marked,
    bool_or(contains(role || text, '\\\\') OR contains(role || text, '<\\|') OR contains(role, chr(10)) OR contains(role, '\\n')) AS escaped
  FROM c GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  cast(plain + CASE WHEN escaped THEN opens + slashes WHEN marked THEN opens ELSE 0 END AS bigint) AS formatted_chars
FROM g"""

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
 b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
 bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS k
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
 sizes AS (SELECT DISTINCT n FROM bw),
 dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS k
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN sizes)),
 occ AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON bw.n = dw.n AND bw.k = dw.k),
 hits AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM occ) GROUP BY doc_id),
 items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
           FROM (SELECT DISTINCT doc_id, cast(item_id AS varchar) AS item FROM occ) GROUP BY doc_id),
 dt AS (SELECT doc_id, unnest(w) AS term, unnest(range(len(w))) AS pos FROM d),
 counts AS (SELECT term, count(*) AS c FROM dt GROUP BY term),
 wt AS (SELECT k, n, unnest(string_split(k, ' ')) AS term, unnest(range(n)) AS off FROM (SELECT DISTINCT k, n FROM bw)),
 ranked AS (SELECT k, n, wt.term, off, row_number() OVER (PARTITION BY k, n ORDER BY c, off) AS r FROM wt JOIN counts ON counts.term = wt.term),
 places AS (SELECT doc_id, k, n, r, pos - off AS s FROM ranked JOIN dt ON dt.term = ranked.term WHERE r <= 2),
 near AS (SELECT DISTINCT a.doc_id, a.k, a.n FROM places a JOIN places b ON b.doc_id = a.doc_id AND b.k = a.k AND b.n = a.n AND abs(a.s - b.s) <= 5 WHERE a.r = 1 AND (b.r = 2 OR a.n = 1)),
 nears AS (SELECT doc_id, count(*) AS n_near, string_agg(item, ',' ORDER BY item) AS listed
           FROM (SELECT DISTINCT doc_id, cast(item_id AS varchar) AS item FROM near JOIN bw ON bw.n = near.n AND bw.k = near.k) GROUP BY doc_id)
SELECT d.doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items.listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(n_near, 0) AS n_near, sha256(coalesce(nears.listed, '')) AS near_sha256
FROM d LEFT JOIN hits ON hits.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id LEFT JOIN nears ON nears.doc_id = d.doc_id"""

# The base kinds as the contract states them, with the order in which they are listed.
_KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[ -]?[0-9])+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_LOCAL = r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"
_CALL = r"(^|[^\pL])(phone|call|tel|fax|mobile)"
_PROPOSED = " UNION ALL ".join(f"SELECT doc_id, {k} AS rank, '{name}' AS kind, regexp_extract_all(t, '{p}') AS m, regexp_split_to_array(t, '{p}') AS parts FROM docs" for k, (name, p) in enumerate([*_KINDS.items(), ("iban", ""), ("local", _LOCAL)]) if p)

PII = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
 proposed AS ({_PROPOSED}),
 each AS (SELECT doc_id, rank, kind, i, m[i] AS v, length(parts[i]) AS gap, right(parts[i], 40) AS before, left(parts[i + 1], 40) AS after FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM proposed)),
 placed AS (SELECT doc_id, rank, kind, v, before, after, sum(gap + length(v)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS stop FROM each),
 found AS (SELECT *, stop - length(v) AS start, regexp_replace(v, '[^0-9]', '', 'g') AS d FROM placed),
 summed AS (SELECT *, list_sum(list_transform(range(1, length(d) + 1), lambda j: CASE WHEN (length(d) - j) % 2 = 1 THEN
     CASE WHEN cast(d[j] AS int) > 4 THEN cast(d[j] AS int) * 2 - 9 ELSE cast(d[j] AS int) * 2 END ELSE cast(d[j] AS int) END)) AS luhn FROM found),
 kept AS (SELECT * FROM summed WHERE CASE kind WHEN 'email' THEN true
     WHEN 'ip' THEN len(list_filter(string_split(v, '.'), lambda x: length(ltrim(x, '0')) > 3 OR try_cast(x AS int) > 255)) = 0
     WHEN 'card' THEN length(d) BETWEEN 12 AND 19 AND luhn % 10 = 0
     WHEN 'local' THEN NOT regexp_matches(before, '[0-9][ ().-]*$') AND NOT regexp_matches(after, '^[ .-]?[0-9]')
       AND (regexp_matches(lower(before), '{_CALL}') OR regexp_matches(lower(after), '{_CALL}')) ELSE length(d) BETWEEN 9 AND 15 END),
 listed AS (SELECT doc_id, string_agg(kind || ':' || cast(start AS bigint) || ':' || cast(stop AS bigint), ',' ORDER BY start, rank) AS spans,
     string_agg(kind || ':' || cast(start AS bigint) || ':' || cast(stop AS bigint), ',' ORDER BY start, rank) FILTER (WHERE kind <> 'local') AS base,
     count(*) FILTER (WHERE kind = 'email') AS n_email, count(*) FILTER (WHERE kind = 'ip') AS n_ip,
     count(*) FILTER (WHERE kind = 'card') AS n_card, count(*) FILTER (WHERE kind = 'phone') AS n_phone FROM kept GROUP BY doc_id)
SELECT docs.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed ON listed.doc_id = docs.doc_id"""

REPEATS = """
WITH h AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
 w AS (SELECT r, i, hash(substring(x, 2 * i + 1, 400)) AS k FROM (SELECT r, x, unnest(range(0, length(x) // 2 - 199)) AS i FROM h WHERE length(x) >= 400)),
 twice AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
 hit AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM w JOIN twice ON twice.k = w.k),
 runs AS (SELECT r, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run FROM hit),
 spans AS (SELECT r, run, min(i) AS s, max(i) + 200 AS e FROM runs GROUP BY r, run),
 gaps AS (SELECT r, run, s, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY run), 0) AS f FROM spans),
 kept AS (SELECT g.r, string_agg(substring(x, 2 * f + 1, 2 * (s - f)), '' ORDER BY run) AS head, max(e) AS e, sum(e - s) AS gone, count(*) AS n FROM gaps g JOIN h ON h.r = g.r GROUP BY g.r)
SELECT doc_id, cast(length(x) // 2 AS bigint) AS n_bytes, cast(coalesce(gone, 0) AS bigint) AS n_removed, coalesce(n, 0) AS n_spans,
  sha256(unhex(CASE WHEN kept.r IS NULL THEN x ELSE head || substring(x, 2 * kept.e + 1) END)) AS kept_sha256
FROM h LEFT JOIN kept ON kept.r = h.r"""
