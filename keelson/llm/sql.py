"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from keelson.llm.link_graph import DAMPING, LINK, RULES, THRESHOLD, UNIT

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP2 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER.format('text')}, {_PLAIN}) AS w
           FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER.format('text')}, {_PLAIN}) AS w FROM benchmark),
g AS (SELECT DISTINCT item, least(len(w), 13) AS size, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS gram
      FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
windows AS (SELECT rid, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram
            FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i
                  FROM d, (SELECT DISTINCT size FROM g) WHERE len(w) >= size)),
hits AS (SELECT rid, i, g.size, item FROM windows JOIN g USING (size, gram)),
n AS (SELECT rid, count(DISTINCT spot) AS n_hit
      FROM (SELECT rid, unnest(range(i, i + size)) AS spot FROM hits) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT rid, item FROM hits WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN items USING (rid)
"""


OP6 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT rid, doc_id, i, array_to_string(w[i:i + 19], ' ') AS gram
            FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
ranked AS (SELECT rid, i, (doc_id, i) <> min((doc_id, i)) OVER (PARTITION BY gram) AS later FROM windows),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 20)) AS spot FROM ranked WHERE later),
lists AS (SELECT rid, list(spot) AS spots FROM gone GROUP BY rid),
kept AS (SELECT doc_id, w, spots, CASE WHEN spots IS NULL THEN w ELSE
                list_filter(w, lambda x, k: NOT list_contains(spots, k)) END AS words FROM d LEFT JOIN lists USING (rid))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(words) AS BIGINT) AS n_removed,
       sha256(array_to_string(words, ' ')) AS kept_sha256
FROM kept
"""

_BITS = ", ".join(f"'{i:04b}'" for i in range(16))
OP7 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
bits AS (SELECT page_id, html, array_to_string(list_transform(regexp_extract_all(sha1(html), '.'),
                lambda c: list_extract([{_BITS}], strpos('0123456789abcdef', c))), '') AS b FROM p),
digests AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, array_to_string(list_transform(range(0, 32),
                lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
                    16 * CAST(substr(b, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(b, 5 * i + 2, 1) AS INT)
                    + 4 * CAST(substr(b, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(b, 5 * i + 4, 1) AS INT)
                    + CAST(substr(b, 5 * i + 5, 1) AS INT) + 1 AS INT), 1)), '') AS payload_digest FROM bits),
firsts AS (SELECT payload_digest, max(page_id) AS first FROM digests GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NULL OR page_id = first THEN NULL ELSE first END AS refers_to
FROM digests JOIN firsts USING (payload_digest)
"""


def _op1() -> str:
    """The link graph, step by step until no whole unit moves."""
    rest = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    link = LINK.replace("'", "''")
    fits = {f"{h}{p}": (f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", v) for v, h, p in RULES}
    longest = sorted(fits, key=lambda r: -len(r))
    case = lambda value: "CASE " + " ".join(f"WHEN {fits[r][0]} THEN '{value(r)}'" for r in longest) + " END"
    return f"""
WITH RECURSIVE rest AS (SELECT page_id, html, coalesce({rest}, '') AS rest FROM pages),
parts AS (SELECT page_id, html,
                 translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS MATERIALIZED (SELECT page_id, host, path, {case(lambda r: r)} AS rule, {case(lambda r: fits[r][1])} AS said FROM parts),
links AS (SELECT src, dst, count(*) AS n FROM (
    SELECT host AS src, unnest(list_distinct(list_transform(regexp_extract_all(html, '{link}', 1), lambda x:
           translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')))) AS dst FROM parts)
    WHERE src <> '' AND src <> dst GROUP BY ALL),
ways AS (SELECT 'trust' AS kind, src AS host, dst AS next, n FROM links UNION ALL SELECT 'distrust', dst, src, n FROM links),
arcs AS MATERIALIZED (SELECT kind, host, next, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY kind, host) AS part FROM ways),
counts AS (SELECT CASE WHEN said = 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n
           FROM ruled WHERE rule IS NOT NULL GROUP BY ALL),
m0 AS MATERIALIZED (SELECT kind, host, CAST(floor(CAST({UNIT} AS DOUBLE) * n / sum(n) OVER (PARTITION BY kind)) AS BIGINT) AS mass
                    FROM counts),
moved(step, kind, host, mass) AS (
    SELECT 0, kind, host, CAST(floor(CAST(mass AS DOUBLE) * (CAST(1 AS DOUBLE) - CAST({DAMPING} AS DOUBLE))) AS BIGINT) FROM m0
    UNION ALL
    SELECT step + 1, kind, next, CAST(sum(
        CAST(floor(CAST(mass AS DOUBLE) * CAST({DAMPING} AS DOUBLE) * part) AS BIGINT)) AS BIGINT) AS came
    FROM moved JOIN arcs USING (kind, host) GROUP BY step, kind, next HAVING came > 0),
hosts AS (SELECT host, CAST(sum(CASE WHEN kind = 'trust' THEN mass ELSE 0 END) AS BIGINT) AS trust,
                 CAST(sum(CASE WHEN kind = 'distrust' THEN mass ELSE 0 END) AS BIGINT) AS distrust FROM moved GROUP BY host)
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) * CAST({THRESHOLD} AS DOUBLE) THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust
FROM ruled LEFT JOIN hosts USING (host)
"""


def _tree(leaves: str, name: str, levels: int) -> tuple[str, str]:
    """Common table expressions of a forest over ``leaves`` (grp, id, h, pos):
    one pair a level, and the columns (l0, r0, ...) that flank each leaf's ancestors."""
    parts, last = [f"{name}0 AS MATERIALIZED (SELECT grp, pos, h, count(*) OVER (PARTITION BY grp) AS n FROM {leaves})"], ""
    for k in range(levels):
        run = "PARTITION BY grp, pos // 8 ORDER BY pos"
        parts += [f"""{name}s{k} AS MATERIALIZED (SELECT grp, pos, n > 1 AS more,
    coalesce(string_agg(h, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""",
                  f"""{name}{k + 1} AS MATERIALIZED (SELECT grp, pos // 8 AS pos, CASE WHEN any_value(n) > 1
    THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h, (any_value(n) + 7) // 8 AS n
    FROM {name}{k} GROUP BY grp, pos // 8)"""]
        last += (f" JOIN {name}s{k} ON a.grp IS NOT DISTINCT FROM {name}s{k}.grp"
                 f" AND a.pos // {8 ** k} = {name}s{k}.pos")
    return ",\n".join(parts), last


def _op11(levels: int = 8, tops: int = 3) -> str:
    """The manifest for up to 8^levels documents a language and 8^tops languages."""
    field = lambda c: f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"
    names = ["doc_id", "source", "lang", "n_chars"]
    head = " || ".join(map(field, names))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    halve = ("list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT) FOR i IN range(8)]), "
             "lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END)")
    crc = (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(x) AS BIGINT) FOR x IN "
           f"regexp_extract_all(CAST(doc_id AS VARCHAR), '.')]), lambda c, b: {halve}), CAST(4294967295 AS BIGINT))")
    below, paths = _tree("leaves", "t", levels)
    above, top_paths = _tree("subroots", "u", tops)
    both = [("t", k) for k in range(levels)] + [("u", k) for k in range(tops)]
    folds, siblings = "", []
    for i, (t, k) in enumerate(both):
        folds += f""",
f{i + 1} AS (SELECT * EXCLUDE (f), CASE WHEN {t}m{k} THEN sha256({t}l{k} || f || {t}r{k}) ELSE f END AS f FROM f{i})"""
        siblings.append(f"CASE WHEN {t}m{k} THEN {t}l{k} || {t}r{k} ELSE '' END")
    columns = lambda t, n: ", ".join(f"{t}s{k}.more AS {t}m{k}, {t}s{k}.l AS {t}l{k}, {t}s{k}.r AS {t}r{k}" for k in range(n))
    held = ", ".join(f"p.{t}{c}{k}" for t, n in (("u", tops),) for k in range(n) for c in "mlr")
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, lang AS grp, sha256({head} || {field('text')}) AS h,
    CASE WHEN {crc} % 3 = 0 THEN sha256({head} || {field(lower)}) END AS seen FROM documents),
leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM d),
{below},
subroots AS MATERIALIZED (SELECT 0 AS grp, grp AS lang, h, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos FROM t{levels}),
{above},
tops AS MATERIALIZED (SELECT a.lang, a.h AS subroot, (SELECT h FROM u{tops}) AS root, {columns('u', tops)} FROM subroots a{top_paths}),
f0 AS (SELECT a.doc_id, a.h AS leaf, p.subroot, p.root, coalesce(a.seen, a.h) AS f, {columns('t', levels)}, {held}
       FROM leaves a{paths} JOIN tops p ON a.grp IS NOT DISTINCT FROM p.lang){folds}
SELECT doc_id, leaf, subroot, root, sha256({' || '.join(siblings)}) AS proof_sha256, f AS folded_root, f = root AS verified
FROM f{len(both)}
"""


_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
OP13 = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER.format('text')}, {_TERM}) AS w
                        FROM documents),
totals AS MATERIALIZED (SELECT count(*) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM d WHERE len(w) > 0),
b AS MATERIALIZED (SELECT iid, item_id, term, count(*) AS times FROM (
    SELECT row_number() OVER () AS iid, item_id, unnest(regexp_extract_all({_LOWER.format('text')}, {_TERM})) AS term
    FROM benchmark) GROUP BY ALL),
tf AS MATERIALIZED (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d)
                    WHERE term IN (SELECT term FROM b) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), totals),
ms AS (SELECT rid, doc_id, 25 + (75 * len(w) * big_n) // big_l AS m FROM d, totals),
scores AS (SELECT iid, item_id, rid, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
           FROM tf JOIN weights USING (term) JOIN ms USING (rid) JOIN b USING (term) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
           FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE: dict[str, str] = {"op1_link_graph": _op1(), "op2_decontaminate": OP2, "op6_substring_dedup": OP6,
                          "op7_arc_to_warc": OP7, "op11_merkle_manifest": _op11(), "op13_bag_search": OP13}
