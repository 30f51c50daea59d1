"""DuckDB SQL for the queries of this subpackage that SQL can express. The others need a hash
function, a tokenizer or a random projection that SQL lacks; they are tested against brute
force instead. Values are written out here on their own, not taken from the operators."""

#: Words of a text: maximal runs of anything but space, tab, LF, VT, FF and CR.
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP4 = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN coalesce(position('://' IN url), 0) > 0
                       THEN substr(url, position('://' IN url) + 3) ELSE '' END AS c FROM pages),
judged AS (
  SELECT page_id, regexp_extract(c, '^[^/?#]*([^?#]*)', 1) AS path,
         translate(regexp_extract(c, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host FROM cut),
named AS (
  SELECT *, regexp_replace(host, ':[0-9]*$', '') AS name FROM judged),
zoned AS (
  SELECT *, CASE WHEN regexp_matches(name, '(^|\.)example\.(com|net|org)$')
                 THEN regexp_extract(name, 'example\.(com|net|org)$')
                 ELSE regexp_extract(name, '[^.]*$') END AS suffix FROM named),
domains AS (
  SELECT *, CASE WHEN length(name) <= length(suffix) + 1 THEN name ELSE regexp_extract(
      substr(name, 1, length(name) - length(suffix) - 1), '[^.]*$') || '.' || suffix END AS domain FROM zoned),
outcomes AS (
  SELECT doc_id AS page_id, bool_or(quality = 0 OR toxic = 1) AS bad FROM labels
  WHERE doc_id IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, any_value(domain) AS domain, any_value(suffix) AS suffix, count(bad) AS n,
         count(*) FILTER (bad) AS k
  FROM domains LEFT JOIN outcomes USING (page_id) GROUP BY host),
doms AS (SELECT suffix, domain, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM hosts GROUP BY suffix, domain),
zones AS (SELECT suffix, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM doms GROUP BY suffix),
root AS (SELECT (coalesce(sum(k), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1.0::DOUBLE) AS m FROM zones),
levels AS (
  SELECT 'zone' AS l, n, k FROM zones UNION ALL SELECT 'domain', n, k FROM doms
  UNION ALL SELECT 'host', n, k FROM hosts),
rhos AS (
  SELECT l, (sum(n * pow(k / n - m, 2)) / max(m * (1 - m)) - (count(*) - 1))
            / nullif(sum(n) - sum(n * n) / sum(n) - (count(*) - 1), 0) AS rho
  FROM levels, root WHERE n > 0 GROUP BY l),
strength AS (
  SELECT x.l, CASE WHEN rho > 0 THEN greatest(2.0::DOUBLE, least(1000.0::DOUBLE, 1 / rho - 1))
                   ELSE 1000.0::DOUBLE END AS s
  FROM (VALUES ('zone'), ('domain'), ('host')) x(l) LEFT JOIN rhos USING (l)),
s AS (SELECT max(s) FILTER (l = 'zone') AS z, max(s) FILTER (l = 'domain') AS d,
             max(s) FILTER (l = 'host') AS h FROM strength),
means AS (
  SELECT host, hosts.n, s.h AS sh, (hosts.k + s.h * ((doms.k + s.d * ((zones.k + s.z * m) / (zones.n + s.z)))
         / (doms.n + s.d))) / (hosts.n + s.h) AS mean
  FROM hosts JOIN doms USING (suffix, domain) JOIN zones USING (suffix), s, root),
bounds AS (SELECT host, mean - sqrt(mean * (1 - mean) / (n + sh + 1)) AS lower FROM means),
rules AS (
  SELECT * FROM (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
    ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'),
    ('net/fr/', 'net', '/fr/', 'block')) r(rule, rhost, rpath, says)),
fits AS (
  SELECT j.page_id, j.host, j.path, max_by(rule, length(rule)) AS rule, max_by(says, length(rule)) AS says
  FROM judged j LEFT JOIN rules ON (j.host = rhost OR ends_with(j.host, '.' || rhost)) AND starts_with(j.path, rpath)
  GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN lower > 0.3 THEN 'block' ELSE 'allow' END) AS verdict
FROM fits JOIN bounds USING (host)
"""

OP5 = rf"""
WITH docs AS (SELECT doc_id, text, md5(text) AS t FROM documents),
lines AS (
  SELECT doc_id, t, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs WHERE text IS NOT NULL),
hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h, len({_WORDS.format('line')}) AS nw FROM lines),
rolled AS (
  SELECT *, (h * 1000003 + coalesce(lead(h) OVER w, 0)) % 2147483647 AS r, lag(nw) OVER w AS nw0
  FROM hashed WINDOW w AS (PARTITION BY doc_id, t ORDER BY i)),
starts AS (
  SELECT *, i = 1 OR nw >= 50 OR nw0 >= 50 OR (r < lag(r) OVER w AND coalesce(r <= lead(r) OVER w, true)) AS s
  FROM rolled WINDOW w AS (PARTITION BY doc_id, t ORDER BY i)),
numbered AS (
  SELECT *, sum(s::INT) OVER (PARTITION BY doc_id, t ORDER BY i) AS place FROM starts),
chunks AS (
  SELECT doc_id, t, place, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk,
         count(*) FILTER (nw > 0) >= 2 OR max(nw) >= 50 AS whole
  FROM numbered GROUP BY doc_id, t, place),
ranked AS (
  SELECT *, whole AND row_number() OVER (PARTITION BY chunk, whole ORDER BY doc_id, t, place) > 1 AS gone FROM chunks)
SELECT doc_id, sum(n)::BIGINT AS n_lines, coalesce(sum(n) FILTER (gone), 0)::BIGINT AS n_removed_lines,
       count(*) FILTER (gone) AS n_removed_chunks,
       md5(coalesce(string_agg(chunk, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS text_md5
FROM ranked GROUP BY doc_id, t
UNION ALL SELECT doc_id, 0, 0, 0, md5('') FROM documents WHERE text IS NULL
"""

OP7 = r"""
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
convs AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS ts
  FROM turns GROUP BY conv_id),
one AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies, ts FROM convs GROUP BY ts)
SELECT conv_id, len(ts)::BIGINT AS n_turns, n_copies, list_aggregate(list_transform(ts, lambda x:
  '<|im_start|>' || replace(coalesce(x.r, 'unknown'), '<|', '< |') || chr(10)
  || replace(coalesce(x.t, ''), '<|', '< |') || '<|im_end|>' || chr(10)), 'string_agg', '') AS rendered
FROM one a WHERE NOT EXISTS (
  SELECT 1 FROM one b WHERE b.ts[1] = a.ts[1] AND len(b.ts) > len(a.ts) AND b.ts[1:len(a.ts)] = a.ts)
"""

OP9 = rf"""
WITH sized AS (SELECT doc_id, source, md5(coalesce(text, '')) AS h, coalesce(len({_WORDS.format('text')}), 0)::BIGINT AS size FROM documents),
named AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS sid
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3.0, 1.0, 2.0][(sid - 1) % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS most FROM named),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (
      ORDER BY most / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT sid, source, source_size, CASE WHEN level >= most / weight THEN most ELSE
    max(level) FILTER (level < most / weight) OVER () * weight END AS target FROM levels),
blocks AS (
  SELECT *, least(round(target)::BIGINT, 2 * source_size) % source_size AS rest,
         least(round(target)::BIGINT, 2 * source_size) // source_size AS epochs,
         source_size // n_blocks AS width, source_size % n_blocks AS n_wide
  FROM (SELECT *, ceil(source_size / 128)::BIGINT AS n_blocks FROM targets WHERE source_size > 0)),
counted AS (
  SELECT *, epochs * n_blocks + CASE WHEN rest = 0 THEN 0 WHEN rest - 1 < n_wide * (width + 1) THEN (rest - 1) // (width + 1) + 1
                                     ELSE n_wide + (rest - 1 - n_wide * (width + 1)) // width + 1 END AS n_slots FROM blocks),
total AS (SELECT sum(n_slots) AS t, max(sid) AS n FROM counted),
ends AS (
  SELECT *, CASE WHEN sid = n THEN 4294967296 WHEN t = 0 THEN 0
    ELSE floor(sum(n_slots) OVER (ORDER BY sid) / t * 4294967296)::BIGINT END AS high FROM counted, total),
spans AS (SELECT *, lag(high, 1, 0) OVER (ORDER BY sid) AS low FROM ends),
points AS (
  SELECT slot, ((((slot + 1) * (2654435769 >> 16)) % 65536) * 65536 + (slot + 1) * (2654435769 & 65535)) % 4294967296 AS u
  FROM (SELECT unnest(range(t::BIGINT)) AS slot FROM total)),
drawn AS (
  SELECT sid, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS rank FROM points JOIN spans ON u >= low AND u < high),
slots AS (
  SELECT sid, rank FROM drawn JOIN counted USING (sid) WHERE rank < n_slots
  UNION ALL
  SELECT sid, unnest(range(found, n_slots::BIGINT)) FROM (
    SELECT c.sid, n_slots, count(d.rank) AS found FROM counted c LEFT JOIN drawn d ON d.sid = c.sid GROUP BY c.sid, n_slots)
  WHERE found < n_slots),
uses AS (
  SELECT sid, rank % n_blocks AS block, count(*) FILTER (rest = 0 OR rank < n_slots - 1) AS n,
         max(rest) FILTER (rest > 0 AND rank = n_slots - 1) AS upto
  FROM slots JOIN counted USING (sid) GROUP BY ALL),
placed AS (
  SELECT doc_id, size, h, sid, source_size, target, coalesce(sum(size) OVER (
      PARTITION BY sid ORDER BY md5(concat_ws('|', 'mix', doc_id, h)), doc_id, h, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
words AS (SELECT doc_id, h, sid, base, width, n_wide, unnest(range(base, base + size)) AS word FROM placed JOIN counted USING (sid)),
takes AS (
  SELECT doc_id, h, sid, base, sum(n + CASE WHEN word < upto THEN 1 ELSE 0 END)::BIGINT AS taken
  FROM (SELECT *, CASE WHEN word < n_wide * (width + 1) THEN word // (width + 1)
                       ELSE n_wide + (word - n_wide * (width + 1)) // width END AS block FROM words)
  JOIN uses USING (sid, block) GROUP BY ALL)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN coalesce(taken, 0) ELSE 0 END::BIGINT AS taken
FROM placed LEFT JOIN takes USING (doc_id, h, sid, base)
"""

#: Unsigned CRC-32 of an ASCII text, bit by bit.
_CRC32 = ("xor(list_reduce(list_transform(range(8 * length({0})), lambda i: CASE WHEN i % 8 = 0 THEN "
          "ord(substr({0}, i // 8 + 1, 1))::BIGINT ELSE 0::BIGINT END), lambda c, b: "
          "xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384), 4294967295::BIGINT), 4294967295::BIGINT)")


def _least(*options: tuple) -> str:
    """The least (cost, audit) of some (condition, cost, audit) as a struct."""
    some = ", ".join(f"CASE WHEN {w} THEN {{'c': {c}, 'a': {a}}} END" for w, c, a in options)
    return f"list_sort(list_filter([{some}], lambda x: x IS NOT NULL))[1]"


def _base(state: str, expected: str) -> str:
    """The least cost to go from a state before a row, without an insert before the row."""
    kept = [("low = 's'", "t + s.c", "'K' || s.a")] if state == "q" else []
    return _least(("true", f"4 + {state}.c", f"'D' || {state}.a"),
                  (f"low = '{expected}'", f"t + {expected}.c", f"'K' || {expected}.a"),
                  ("low <> 'x'", f"3 + t + {expected}.c", f"'R' || {expected}.a"), *kept)


def _inserted(own: str, after: str) -> str:
    return _least(("true", f"{own}.c", f"{own}.a"), ("true", f"3 + {after}.c", f"'I' || {after}.a"))


OP11 = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
faults AS (SELECT *, {_CRC32.format('k')} % 20 AS f FROM keyed),
rows AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE WHEN f = 1 THEN ''
         WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN f = 0 THEN [] WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy FROM faults),
placed AS (
  SELECT *, row_number() OVER w - 1 AS pos, substr(role, 1, 1) AS i, lag(substr(role, 1, 1)) OVER w AS i0,
         regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS solid
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
marked AS (
  SELECT *, CASE WHEN solid = '' THEN 'blank' WHEN seen THEN 'duplicate'
         WHEN substr(solid, -1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS seen FROM placed)),
signs AS (
  SELECT conv_id, pos, role, text, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS t,
         CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' WHEN i IN ('s', 'u', 'a') THEN i ELSE 'o' END AS low FROM marked),
facts AS (
  SELECT ids.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pos > 0 AND i0 || i NOT IN ('su', 'ua', 'au')) AS illegal, count(pos) AS n
  FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN marked ON marked.conv_id IS NOT DISTINCT FROM ids.conv_id
  GROUP BY ids.conv_id),
togo AS (
  SELECT conv_id, n AS here, {{'c': 0, 'a': ''}} AS q, {{'c': 6, 'a': 'II'}} AS s, {{'c': 3, 'a': 'I'}} AS u, {{'c': 0, 'a': ''}} AS a
  FROM facts
  UNION ALL
  SELECT conv_id, here, {_inserted('bq', 'u')} AS q, {_inserted('bs', 'u')} AS s, u, a FROM (
    SELECT *, {_inserted('bu', 'ba')} AS u, {_inserted('ba', 'bu')} AS a FROM (
      SELECT g.conv_id, here - 1 AS here, {_base('q', 'u')} AS bq, {_base('s', 'u')} AS bs, {_base('u', 'a')} AS bu,
             {_base('a', 'u')} AS ba
      FROM togo g JOIN signs r ON r.conv_id IS NOT DISTINCT FROM g.conv_id AND r.pos = g.here - 1 WHERE here > 0))),
best AS (SELECT conv_id, q.c::BIGINT AS cost, q.a AS audit FROM togo WHERE here = 0),
walk AS (
  SELECT conv_id, audit, 1 AS k, 0 AS here, 'q' AS state, []::VARCHAR[] AS lines FROM best
  UNION ALL
  SELECT conv_id, audit, k + 1, here + (e <> 'I')::INT, CASE WHEN e = 'D' THEN state ELSE substr(line, 1, 1) END,
         CASE WHEN e = 'D' THEN lines ELSE list_append(lines, line) END
  FROM (SELECT w.*, substr(audit, k, 1) AS e, CASE
          WHEN substr(audit, k, 1) = 'K' THEN r.role || ':' || r.text
          WHEN state = 'u' THEN 'assistant:' || CASE WHEN substr(audit, k, 1) = 'I' THEN '' ELSE r.text END
          ELSE 'user:' || CASE WHEN substr(audit, k, 1) = 'I' THEN '' ELSE r.text END END AS line
        FROM walk w LEFT JOIN signs r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.here WHERE k <= length(audit)))
SELECT f.conv_id, gaps, blank, duplicate, truncated, illegal, cost, b.audit, sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM facts f JOIN best b ON b.conv_id IS NOT DISTINCT FROM f.conv_id
JOIN walk w ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.k = length(w.audit) + 1
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text"]
    return f"sha256({' || '.join(map(_field, fields))})"


OP12 = rf"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, {_leaf('n_chars')} AS d, CASE WHEN {_CRC32.format('doc_id::VARCHAR')} % 7 = 0
         THEN {_leaf('n_chars + 1')} END AS seen FROM documents),
leaves AS (
  SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM hashed WINDOW w AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, d)),
nodes AS (
  SELECT 0 AS l, lang, pos, d, n FROM leaves
  UNION ALL
  SELECT l + 1, lang, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (max(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY l, lang, pos // 2),
subroots AS (
  SELECT lang, d, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS l, pos, d, n FROM subroots
  UNION ALL
  SELECT l + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (max(n) + 1) // 2
  FROM tops WHERE n > 1 GROUP BY l, pos // 2),
root AS (SELECT d AS root FROM tops WHERE n = 1),
up AS (
  SELECT doc_id, lang, pos AS leaf_pos, 0 AS l, pos, d, n, coalesce(seen, d) AS cur, '' AS path FROM leaves
  UNION ALL
  SELECT u.doc_id, u.lang, leaf_pos, u.l + 1, u.pos // 2, u.d, (u.n + 1) // 2, sha256(
           CASE WHEN u.pos % 2 = 1 THEN s.d || cur ELSE cur || coalesce(s.d, '') END), path || coalesce(s.d, '')
  FROM up u LEFT JOIN nodes s ON s.l = u.l AND s.lang IS NOT DISTINCT FROM u.lang AND s.pos = xor(u.pos, 1)
  WHERE u.n > 1),
over AS (
  SELECT doc_id, u.lang, leaf_pos, 0 AS l, t.pos, u.d, t.n, cur, path, t.d AS subroot
  FROM up u JOIN subroots t ON t.lang IS NOT DISTINCT FROM u.lang WHERE u.n = 1
  UNION ALL
  SELECT doc_id, lang, leaf_pos, u.l + 1, u.pos // 2, u.d, (u.n + 1) // 2, sha256(
           CASE WHEN u.pos % 2 = 1 THEN s.d || cur ELSE cur || coalesce(s.d, '') END), path || coalesce(s.d, ''), subroot
  FROM over u LEFT JOIN tops s ON s.l = u.l AND s.pos = xor(u.pos, 1) WHERE u.n > 1)
SELECT doc_id, d AS leaf, subroot, root, sha256(path) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM over, root WHERE n = 1
"""

OP13 = """
WITH RECURSIVE numbered AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
usable AS (
  SELECT * FROM numbered WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0 AND len(v) = len(list_filter(v, lambda x: isfinite(x)))
    AND list_bool_or(list_transform(v, lambda x: x <> 0))),
links AS (
  SELECT a.r AS a, b.r AS b FROM usable a JOIN usable b
  ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.93),
reach AS (
  SELECT r, r AS other FROM numbered
  UNION
  SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT vec_id, n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM (
  SELECT s.r, any_value(s.vec_id) AS vec_id, min(o.vec_id) AS component_id FROM reach JOIN numbered s ON s.r = reach.r
  JOIN numbered o ON o.r = reach.other GROUP BY s.r)
JOIN (SELECT numbered.r, count(links.b) AS n_links FROM numbered LEFT JOIN links ON links.a = numbered.r GROUP BY numbered.r) USING (r)
"""

ORACLES: dict[str, str] = {
    "op4_url_reputation": OP4, "op5_line_chunk_dedup": OP5, "op7_chat_snapshots": OP7,
    "op9_low_discrepancy_mix": OP9,
    "op11_structure_repair": OP11,
    "op12_merkle_manifest": OP12,
    "op13_embedding_near_dedup": OP13}
