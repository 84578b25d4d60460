"""SQL for the queries that SQL can express (DuckDB's dialect)."""

from __future__ import annotations

from .queries import URL_RULES

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)

OP3 = f"""WITH rules(verdict, host, path) AS (VALUES {_RULES}),
cut AS (SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN NULL ELSE substr(url, position('://' IN url) + 3) END AS rest FROM pages),
parts AS (SELECT page_id, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS host0, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
low AS (SELECT page_id, translate(host0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts),
best AS (SELECT l.page_id, l.host, l.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM low l LEFT JOIN rules r ON (l.host = r.host OR ends_with(l.host, '.' || r.host)) AND starts_with(l.path, r.path) GROUP BY l.page_id, l.host, l.path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best"""

_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP6 = f"""WITH d AS (SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
i AS (SELECT item_id, coalesce({_WORDS.format("text")}, []) AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[p : p + least(13, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS p FROM i WHERE len(w) > 0) x),
sizes AS (SELECT DISTINCT m FROM g),
dw AS (SELECT doc_id, p, m, array_to_string(w[p : p + m - 1], ' ') AS s
  FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS p FROM d, sizes WHERE len(w) >= m) x),
h AS (SELECT dw.doc_id, dw.p, dw.m, g.item_id FROM dw JOIN g ON g.m = dw.m AND g.s = dw.s),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + m - 1)) AS q FROM h) x GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM h) x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


def _crc32(text: str) -> str:
    """The CRC-32 of ASCII text: each byte is mixed in and shifted out bit by bit."""
    steps = f"flatten([[ascii({text}[k]), -1, -1, -1, -1, -1, -1, -1, -1] FOR k IN generate_series(1, length({text}))])"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"


def _merkle(levels: int = 5, fanout: int = 16) -> str:
    """Trees of up to fanout ** levels leaves, level by level."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda t: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", t))) + ")"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def up(name: str, group: str) -> list[str]:
        """Of name0 (group, pos, n, h): the tables name1 ... with the levels above, and path: each name0 node's siblings and its place in each run."""
        out = []
        for k in range(levels):
            out.append(f"""{name}{k + 1} AS (SELECT {group}, pos // {fanout} AS pos, (max(n) + {fanout - 1}) // {fanout} AS n,
  CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM {name}{k} GROUP BY {group}, pos // {fanout})""")
            out.append(f"""{name}s{k} AS (SELECT a.{group}, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r,
  any_value(a.n) = 1 AS top FROM {name}{k} a JOIN {name}{k} b ON a.{group} = b.{group} AND a.pos // {fanout} = b.pos // {fanout} GROUP BY a.{group}, a.pos)""")
        return out

    parts = [
        f"d AS (SELECT doc_id, source, {leaf('text')} AS leaf, {leaf(low)} AS low, {_crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 AS hit FROM documents)",
        "g AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS grp FROM d GROUP BY source)",
        "x AS (SELECT d.*, g.grp, g.n, row_number() OVER (PARTITION BY g.grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)",
        "a0 AS (SELECT grp, pos, n, leaf AS h FROM x)",
        *up("a", "grp"),
        f"b0 AS (SELECT 0 AS one, grp AS pos, (SELECT count(*) FROM g) AS n, h FROM a{levels})",
        *up("b", "one"),
    ]
    folds, last = [], "f0"
    for k, (name, level) in enumerate([(n, k) for n in "ab" for k in range(levels)], 1):
        s = f"{name}s{level}"
        here = f"{s}.pos = f.{'pos' if name == 'a' else 'grp'} // {fanout**level}" + (f" AND {s}.grp = f.grp" if name == "a" else "")
        folds.append(f"""f{k} AS (SELECT f.* EXCLUDE (h, proof), CASE WHEN {s}.top THEN f.h ELSE sha256({s}.l || f.h || {s}.r) END AS h,
  proof || {s}.l || {s}.r AS proof FROM {last} f JOIN {s} ON {here})""")
        last = f"f{k}"
    parts += ["f0 AS (SELECT doc_id, leaf, grp, pos, CASE WHEN hit THEN low ELSE leaf END AS h, '' AS proof FROM x)", *folds]
    return f"""WITH {", ".join(parts)}
SELECT f.doc_id, f.leaf, a.h AS subroot, b.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = b.h AS verified
FROM {last} f JOIN a{levels} a ON a.grp = f.grp, b{levels} b"""


OP11 = _merkle()


def _encoding() -> str:
    """Running sums by key and time, less those of the own fold."""
    keys = {"all": "0", "segment": "segment", "client": "client_id", "kind": "kind", "item": "item_id", "nation": "nation_id", "vendor": "vendor_id"}
    ctes, joins = [], []
    for level, key in keys.items():
        ctes.append(f"""{level}_t AS (SELECT k, tm, sum(n) OVER w AS n, sum(s) OVER w AS s FROM (SELECT {key} AS k, tm, count(*) AS n, count(*) FILTER (back) AS s FROM e GROUP BY ALL) x
  WINDOW w AS (PARTITION BY k ORDER BY tm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{level}_f AS (SELECT k, tm, fold, sum(n) OVER w AS n, sum(s) OVER w AS s FROM (SELECT {key} AS k, tm, fold, count(*) AS n, count(*) FILTER (back) AS s FROM e GROUP BY ALL) x
  WINDOW w AS (PARTITION BY k, fold ORDER BY tm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{level}_h AS (SELECT f.k, f.tm, f.fold, CAST(coalesce(t.n, 0) - coalesce(f.n, 0) AS BIGINT) AS n, CAST(coalesce(t.s, 0) - coalesce(f.s, 0) AS BIGINT) AS s
  FROM {level}_f f JOIN {level}_t t ON f.k IS NOT DISTINCT FROM t.k AND f.tm = t.tm)""")
        joins.append(f"JOIN {level}_h AS h_{level} ON h_{level}.k IS NOT DISTINCT FROM g.{'zero' if level == 'all' else key} AND h_{level}.tm = g.tm AND h_{level}.fold = g.fold")
    rate = lambda h, p: f"CASE WHEN {h}.n < 1 THEN {p} ELSE (1000000 * {h}.s + 50 * {p}) // ({h}.n + 50) END"
    return f"""WITH i AS (SELECT item_id, min(kind) AS kind FROM items GROUP BY item_id), v AS (SELECT vendor_id, min(nation_id) AS nation_id FROM vendors GROUP BY vendor_id),
c AS (SELECT client_id, min(segment) AS segment FROM clients GROUP BY client_id),
sold AS MATERIALIZED (SELECT sale_id, coalesce(client_id, -1) AS client_id, sold_at AS tm, {_crc32('CAST(sale_id AS VARCHAR)')} % 5 AS fold FROM sales WHERE sold_at IS NOT NULL AND sale_id IS NOT NULL),
e AS MATERIALIZED (SELECT l.sale_id, coalesce(l.item_id, -1) AS item_id, l.vendor_id, coalesce(l.flag = 'returned', FALSE) AS back, s.client_id, s.tm, s.fold, i.kind, v.nation_id, c.segment
  FROM sale_lines l JOIN sold s ON l.sale_id = s.sale_id LEFT JOIN i ON i.item_id = coalesce(l.item_id, -1) LEFT JOIN v ON v.vendor_id = l.vendor_id LEFT JOIN c ON c.client_id = s.client_id),
{", ".join(ctes)},
g AS (SELECT sale_id, item_id, vendor_id, client_id, tm, fold, kind, nation_id, segment, 0 AS zero, count(*) AS n_lines, count(*) FILTER (back) AS n_returned FROM e GROUP BY ALL),
r AS (SELECT g.*, h_item.n AS item_n, h_vendor.n AS vendor_n, h_client.n AS client_n, {rate("h_all", "500000")} AS r0,
  {rate("h_kind", "r0")} AS r_kind, {rate("h_nation", "r0")} AS r_nation, {rate("h_segment", "r0")} AS r_segment,
  {rate("h_item", "r_kind")} AS item_rate, {rate("h_vendor", "r_nation")} AS vendor_rate, {rate("h_client", "r_segment")} AS client_rate FROM g {" ".join(joins)})
SELECT sale_id, item_id, vendor_id, n_lines, n_returned, item_n, item_rate, vendor_n, vendor_rate, client_n, client_rate FROM r"""


OP12 = _encoding()


def oracle_sql() -> dict[str, str]:
    return {"op3_url_rules": OP3, "op6_decontamination": OP6, "op11_merkle": OP11, "op12_target_encoding": OP12}
