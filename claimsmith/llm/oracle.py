"""DuckDB SQL for those training-data queries that SQL can express."""

from __future__ import annotations

from claimsmith.llm import secret_scan, spherical_dedup, url_templates

# Of the contracts of op11 to op13.
MERKLE_RUN, CODE_SCALE, CODE_ENTRIES, CODE_ROUNDS, LINE_DOCUMENTS = 3, 1024, 256, 4, 10


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def secret_scan_sql() -> str:
    """Matches by splitting at each pattern; weak parts by the nearest complement before and after."""
    parts, ranks = [], []
    for rank, (kind, role, pattern, group, least) in enumerate(secret_scan.STRONG + secret_scan.WEAK):
        p, weak = _q(pattern), rank >= len(secret_scan.STRONG)
        value = f"regexp_extract(m[i], {p}, {group})" if group else "m[i]"
        parts.append(f"""SELECT doc_id, {_q(kind)} AS kind, {_q(role)} AS role, {rank} AS rank, {weak} AS weak, i,
            length(g[i]) + length(m[i]) AS step, length(m[i]) AS len, length({value}) >= {least} AS ok
          FROM (SELECT doc_id, m, g, unnest(generate_series(1, len(m))) AS i FROM (
            SELECT doc_id, regexp_extract_all(text, {p}) AS m, regexp_split_to_array(text, {p}) AS g
            FROM documents WHERE regexp_matches(text, {p})))""")
        ranks.append(kind)
    reach = secret_scan.SCOPE
    near = lambda r: f"""(coalesce(max(CASE WHEN role = '{r}' THEN e END) OVER before >= s - {reach}, FALSE)
        OR coalesce(min(CASE WHEN role = '{r}' THEN s END) OVER after <= e + {reach}, FALSE)) AS near_{r}"""  # noqa: E731
    count = lambda k: f"coalesce(count(*) FILTER (WHERE kind = '{k}'), 0)"
    told = "kind || ':' || s || ':' || e"
    return f"""WITH parts AS ({" UNION ALL ".join(parts)}),
placed AS (SELECT *, CAST(sum(step) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS e FROM parts),
spans AS (SELECT *, e - len AS s FROM placed WHERE ok),
reach AS (SELECT *, {near("identifier")}, {near("secret")},
    coalesce(max(CASE WHEN NOT weak THEN e END) OVER before > s, FALSE)
      OR coalesce(min(CASE WHEN NOT weak THEN s END) OVER after < e, FALSE) AS covered
  FROM spans WINDOW before AS (PARTITION BY doc_id ORDER BY s, e, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    after AS (PARTITION BY doc_id ORDER BY s, e, kind ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
kept AS (SELECT * FROM reach WHERE NOT weak OR (NOT covered AND CASE role WHEN 'identifier' THEN near_secret
    WHEN 'secret' THEN near_identifier ELSE near_identifier AND near_secret END)),
told AS (SELECT doc_id, {", ".join(f"{count(k)} AS n_{k}" for k in ranks[:3])},
    coalesce(string_agg({told}, ',' ORDER BY s, rank) FILTER (WHERE NOT weak), '') AS base,
    string_agg({told}, ',' ORDER BY s, rank) AS spans FROM kept GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in ranks[:3])}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans FROM documents d LEFT JOIN told t ON d.doc_id = t.doc_id"""


SQL_LEVELS = 6  # the SQL is written out for paths of so many segments; the operator has no such bound


def url_filter_sql() -> str:
    u = url_templates
    rules, verdicts = [], []
    for action, text in sorted(u.RULES, key=lambda r: -len(r[1])):
        h, slash, p = text.partition("/")
        fits = f"((host = {_q(h)} OR ends_with(host, {_q('.' + h)})) AND starts_with(path, {_q(slash + p)}))"
        rules.append(f"WHEN {fits} THEN {_q(text)}")
        verdicts.append(f"WHEN {fits} THEN {_q(action)}")
    differs = lambda n, g, of_n, of_g: (f"({n} > 0 AND abs({g} / greatest({n}, 1) - {of_g} / greatest({of_n}, 1)) > {u.Z} * "  # noqa: E731
                                        f"sqrt({of_g} / greatest({of_n}, 1) * (1 - {of_g} / greatest({of_n}, 1)) / greatest({n}, 1)))")
    levels = ["tree0 AS (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS seg, '' AS template FROM base)"]
    for i in range(SQL_LEVELS):
        own, shape = f"(c >= {u.MIN_COUNT} AND NOT regexp_full_match(own, '[0-9]+'))", f"(shaped >= {u.MIN_COUNT} AND contains(shape, '*'))"
        # A value's c pages each count c in the sum of squares.
        varies = lambda of, c: f"pow(sum(CASE WHEN {of} THEN 1 ELSE 0 END) OVER node, 2) > {u.VARIED} * sum(CASE WHEN {of} THEN {c} ELSE 0 END) OVER node"
        levels.append(f"""here{i} AS (SELECT *, seg[{i + 1}] AS own, regexp_replace(seg[{i + 1}], '[0-9]+', '*', 'g') AS shape FROM tree{i}),
counted{i} AS (SELECT *, count(*) OVER value AS c, count(good) OVER value AS n, coalesce(sum(good) OVER value, 0) AS g,
    count(*) OVER (PARTITION BY host, template, own IS NULL, shape) AS shaped FROM here{i}
    WINDOW value AS (PARTITION BY host, template, own IS NULL, own)),
noded{i} AS (SELECT *, count(good) OVER node AS nn, coalesce(sum(good) OVER node, 0) AS ng, {varies(own, "c")} AS vary, {varies(shape, "shaped")} AS shapes_vary
    FROM counted{i} WINDOW node AS (PARTITION BY host, template, own IS NULL)),
tree{i + 1} AS (SELECT page_id, host, path, good, seg, template || CASE WHEN own IS NULL THEN ''
    WHEN {own} AND (NOT vary OR {differs("n", "g", "nn", "ng")}) THEN '/' || own
    WHEN {shape} AND NOT shapes_vary THEN '/' || shape ELSE '/**' END AS template FROM noded{i})""")
    merges = ["merge0 AS (SELECT host, template, template AS merged, count(good) AS n, coalesce(sum(good), 0) AS g FROM tree GROUP BY host, template)"]
    for i in range(SQL_LEVELS):
        at = SQL_LEVELS - i
        merges.append(f"""parts{i} AS (SELECT *, string_split(merged, '/') AS parts, coalesce(NOT contains(parts[{at + 1}], '*') AND parts[{at + 1}] <> '{{}}', false) AS literal FROM merge{i}),
family{i} AS (SELECT *, CASE WHEN literal THEN array_to_string(parts[1:{at}] || ['{{}}'] || parts[{at + 2}:], '/') ELSE merged END AS family,
    sum(n) OVER own AS cn, sum(g) OVER own AS cg FROM parts{i} WINDOW own AS (PARTITION BY host, merged)),
pool{i} AS (SELECT *, sum(n) OVER kin AS fn, sum(g) OVER kin AS fg, min(merged) OVER kin <> max(merged) OVER kin AS several
    FROM family{i} WINDOW kin AS (PARTITION BY host, literal, family)),
merge{i + 1} AS (SELECT host, template, n, g, CASE WHEN literal AND several AND NOT {differs("cn", "cg", "fn", "fg")} THEN family ELSE merged END AS merged FROM pool{i})""")
    prior = f"((ag + 0.5 * {u.SMOOTHING}) / (an + {u.SMOOTHING}))"
    host_prior = f"((hg + {u.SMOOTHING} * {prior}) / (hn + {u.SMOOTHING}))"
    return f"""WITH split AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
parsed AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{u._UPPER}', '{u._LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
marks AS (SELECT p.page_id, min(CAST(l.quality = 1 AND l.toxic = 0 AS INTEGER)) AS good FROM parsed p
  JOIN labels l ON l.doc_id = TRY_CAST(regexp_extract(p.path, '/([0-9]+)', 1) AS BIGINT) GROUP BY p.page_id),
base AS (SELECT p.*, m.good FROM parsed p LEFT JOIN marks m ON p.page_id = m.page_id),
{", ".join(levels)},
tree AS (SELECT page_id, host, path, good, template FROM tree{SQL_LEVELS}),
{", ".join(merges)},
branch AS (SELECT *, sum(n) OVER (PARTITION BY host) AS hn, sum(g) OVER (PARTITION BY host) AS hg, sum(n) OVER () AS an, sum(g) OVER () AS ag FROM merge{SQL_LEVELS}),
judged AS (SELECT host, template, (sum(g) OVER w + {u.SMOOTHING} * {host_prior}) / (sum(n) OVER w + {u.SMOOTHING}) AS purity
  FROM branch WINDOW w AS (PARTITION BY host, merged))
SELECT page_id, host, path, CASE {" ".join(rules)} END AS rule,
  CASE {" ".join(verdicts)} ELSE CASE WHEN purity < {u.MIN_PURITY} THEN 'block' ELSE 'allow' END END AS verdict,
  template, CAST(purity AS DOUBLE) AS purity
FROM tree t JOIN (SELECT DISTINCT host AS jh, template AS jt, purity FROM judged) j ON t.host = jh AND t.template = jt"""


def embedding_sql() -> str:
    return f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
usable AS (SELECT *, sqrt(list_dot_product(x, x)) AS size FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL
  AND len(list_filter(x, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0 AND len(list_filter(x, lambda e: e <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.x) = len(b.x) WHERE list_dot_product(a.x, b.x) / (a.size * b.size) >= {spherical_dedup.THRESHOLD}),
reach AS (SELECT vec_id AS id, vec_id AS low FROM usable UNION SELECT l.a, r.low FROM reach r JOIN links l ON l.b = r.id WHERE r.low < l.a),
lows AS (SELECT id, min(low) AS low FROM reach GROUP BY id), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, coalesce(l.low, v.vec_id) AS component_id, coalesce(l.low, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN lows l ON v.vec_id = l.id LEFT JOIN counts c ON v.vec_id = c.a"""


def merkle_sql() -> str:
    """Level by level with window-numbered rows; proofs and folding by joins on the levels."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    leaf = lambda text: "sha256(concat(" + ", ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + "))"
    crc = """list_reduce(list_transform(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x))),
      lambda x: CAST(x AS BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT) FOR i IN range(8)]),
      lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""
    up = lambda name, start: f"""{name} AS (SELECT 0 AS level, tree, pos, digest, n FROM {start} UNION ALL
  SELECT level + 1, tree, pos // {MERKLE_RUN}, sha256(string_agg(digest, '' ORDER BY pos)), (n + {MERKLE_RUN - 1}) // {MERKLE_RUN}
  FROM {name} WHERE n > 1 GROUP BY level, tree, pos // {MERKLE_RUN}, n)"""  # noqa: E731
    sides = lambda nodes, node: f"""coalesce(string_agg({nodes}.digest, '' ORDER BY {nodes}.pos) FILTER (WHERE {nodes}.pos < {node}), '') AS before,
    coalesce(string_agg({nodes}.digest, '' ORDER BY {nodes}.pos) FILTER (WHERE {nodes}.pos > {node}), '') AS after"""  # noqa: E731
    place = f"(l.pos // CAST(power({MERKLE_RUN}, u.level) AS BIGINT))"
    top = f"(t.pos // CAST(power({MERKLE_RUN}, v.level) AS BIGINT))"
    return f"""WITH RECURSIVE leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS row, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS tree
  FROM (SELECT doc_id, source, {leaf("text")} AS leaf, CASE WHEN {crc} % 2 = 1 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS claim
    FROM documents)),
start AS (SELECT tree, pos, leaf AS digest, n FROM leaves),
{up("nodes", "start")},
trees AS (SELECT tree AS name, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, digest, count(*) OVER () AS n FROM nodes WHERE n = 1),
{up("tops", "trees")},
steps AS (SELECT l.row, 0 AS part, u.level, {sides("u", place)} FROM leaves l
    JOIN nodes u ON u.tree = l.tree AND u.n > 1 AND u.pos // {MERKLE_RUN} = {place} // {MERKLE_RUN} GROUP BY l.row, u.level, {place}
  UNION ALL SELECT l.row, 1, v.level, {sides("v", top)} FROM leaves l JOIN trees t ON t.name = l.tree
    JOIN tops v ON v.n > 1 AND v.pos // {MERKLE_RUN} = {top} // {MERKLE_RUN} GROUP BY l.row, v.level, {top}),
numbered AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY part, level) AS i FROM steps),
proofs AS (SELECT row, sha256(string_agg(before || after, '' ORDER BY i)) AS proof, count(*) AS steps FROM numbered GROUP BY row),
folds AS (SELECT row, CAST(0 AS BIGINT) AS i, claim AS digest FROM leaves UNION ALL
  SELECT f.row, s.i, sha256(s.before || f.digest || s.after) FROM folds f JOIN numbered s ON s.row = f.row AND s.i = f.i + 1)
SELECT l.doc_id, l.leaf, t.digest AS subroot, r.digest AS root, coalesce(p.proof, sha256('')) AS proof_sha256, f.digest AS folded_root,
  f.digest = r.digest AS verified
FROM leaves l JOIN trees t ON t.name = l.tree CROSS JOIN (SELECT digest FROM tops WHERE n = 1) r LEFT JOIN proofs p ON p.row = l.row
JOIN folds f ON f.row = l.row AND f.i = coalesce(p.steps, 0)"""


def vector_codes_sql() -> str:
    """Every sub-vector against every entry, in exact doubles."""
    ctes = [f"""kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label,
    list_transform(embedding, lambda e: floor({CODE_SCALE} * CAST(e AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0)""",
            """subs AS MATERIALIZED (SELECT *, list_inner_product(v, v) AS vv FROM
    (SELECT row, part, list_slice(x, part * len(x) // 4 + 1, (part + 1) * len(x) // 4) AS v FROM kept, range(4) AS r(part)))""",
            f"book0 AS MATERIALIZED (SELECT part, row - 1 AS entry, v AS c, vv AS cc FROM subs WHERE row <= {CODE_ENTRIES})"]
    for i in range(CODE_ROUNDS + 1):
        ctes.append(f"""near{i} AS MATERIALIZED (SELECT row, part, arg_min(entry, (d, entry)) AS entry, min(d) AS error
  FROM (SELECT s.row, s.part, b.entry, s.vv - 2 * list_inner_product(s.v, b.c) + b.cc AS d FROM subs s JOIN book{i} b ON s.part = b.part) s
  GROUP BY row, part)""")
        if i < CODE_ROUNDS:
            ctes.append(f"""book{i + 1} AS MATERIALIZED (SELECT *, list_inner_product(c, c) AS cc FROM (
  SELECT part, entry, coalesce(mean, c) AS c FROM book{i} LEFT JOIN (
    SELECT part, entry, list(m ORDER BY place) AS mean FROM (SELECT part, entry, place, floor(sum(e) / count(*)) AS m FROM (
      SELECT n.part, n.entry, generate_subscripts(s.v, 1) AS place, unnest(s.v) AS e FROM near{i} n JOIN subs s ON s.row = n.row AND s.part = n.part)
    GROUP BY part, entry, place) GROUP BY part, entry) USING (part, entry)))""")
    last = CODE_ROUNDS
    return f"""WITH {", ".join(ctes)},
coded AS (SELECT row, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(error) AS BIGINT) AS error FROM near{last} GROUP BY row),
books AS (SELECT sha256(string_agg(list_aggregate(list_transform(c, lambda e: CAST(CAST(e AS BIGINT) AS VARCHAR)), 'string_agg', ','), ',' ORDER BY part, entry)) AS h FROM book{last})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM kept JOIN coded USING (row) CROSS JOIN books"""


def line_dedup_sql() -> str:
    key = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH docs AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT row, i, line, {key} AS key FROM (SELECT row, generate_subscripts(parts, 1) AS i, unnest(parts) AS line FROM docs)),
shared AS (SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT row) >= {LINE_DOCUMENTS}),
kept AS (SELECT row, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS text FROM lines WHERE key NOT IN (SELECT key FROM shared) GROUP BY row)
SELECT doc_id, CAST(len(parts) AS BIGINT) AS n_lines, len(parts) - coalesce(n, 0) AS n_dropped, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.row = k.row"""


def oracle_sql() -> dict[str, str]:
    return {"op1_secret_scan": secret_scan_sql(), "op3_url_filter": url_filter_sql(), "op4_embedding_near_dedup": embedding_sql(),
            "op11_merkle_manifest": merkle_sql(), "op12_vector_codes": vector_codes_sql(), "op13_line_dedup": line_dedup_sql()}
