"""The derived input tables as SQL, for the checks. Same rules as inputs.py."""

from __future__ import annotations

WS = r"[\s\x{00A0}]"


def nrm(x: str) -> str:
    """Text normalisation in the checking dialect."""
    return (
        f"trim(regexp_replace(regexp_replace(regexp_replace({x}, "
        r"'([,;:!?.)}\]])([^\s\x{00A0}])', '\1 \2', 'g'), "
        r"'[\s\x{00A0}]+([,;:!?.])', '\1', 'g'), '[\s\x{00A0}]+', ' ', 'g'))"
    )


CELEX = r"^[0-9CE][0-9]{4}[A-Z]{1,3}[0-9]{4,6}[A-Z]{0,3}[_\-]?[0-9]{0,9}$"
CONSOLIDATED = r"^0[0-9]{4}[RLD][0-9]{4}-[0-9]{8}$"

CTES: dict[str, tuple[str, str]] = {}


def cte(name: str, sql: str, needs: str = "") -> None:
    CTES[name] = (needs, sql)


def with_ctes(names: list[str], sql: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in CTES[n][0].split():
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    if not order:
        return sql.strip()
    heads = ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in order)
    return f"WITH {heads}\n{sql.strip()}"


cte("base_src", """
SELECT o_orderkey AS k, o_custkey AS ck, CAST(o_orderdate AS date) AS d,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'R' WHEN '2' THEN 'L' WHEN '3' THEN 'D'
            WHEN '4' THEN 'PC' ELSE 'X' END AS ty,
       CAST(1950 + o_orderkey // 10000 AS varchar) AS y4,
       lpad(CAST(o_orderkey % 10000 AS varchar), 4, '0') AS num
FROM orders""")
cte("works_src", """
SELECT k, ck, d, ty, sector, sector || y4 || ty || num || CASE WHEN k % 17 = 0 THEN 'R(01)' ELSE '' END AS celex_id
FROM (SELECT *, CASE WHEN ty = 'PC' THEN '5' WHEN k % 11 = 0 THEN '7' ELSE '3' END AS sector FROM base_src)
UNION ALL
SELECT -1 - k, ck, d, ty, '0', '0' || y4 || ty || num || '-' || strftime(d + to_days(n), '%Y%m%d')
FROM base_src, (VALUES (30), (60)) v(n)
WHERE k % 10 = 0 AND ty IN ('R', 'L', 'D') AND (n = 30 OR k % 20 = 0)""", "base_src")
cte("relations_src", """
SELECT s.celex_id AS celex_source,
       CASE WHEN (l_orderkey + l_partkey) % 13 = 0 THEN '' ELSE t.celex_id END AS celex_target,
       CASE l_linenumber % 6 WHEN 0 THEN 'cites' WHEN 1 THEN 'amends' WHEN 2 THEN 'adopts' WHEN 3 THEN 'based_on'
            WHEN 4 THEN 'proposes_to_amend' ELSE 'consolidates' END AS relation_type,
       l_linenumber AS pos, l_orderkey AS sk, l_partkey AS tk
FROM lineitem JOIN works_src s ON s.k = l_orderkey JOIN works_src t ON t.k = l_partkey""", "works_src")
cte("labels_src", """
SELECT 'http://example.org/concept/' || p_partkey AS uri, 'pref' AS kind, p_name AS label,
       CASE p_size % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'en-GB' ELSE 'fr' END AS lang, p_size % 2 AS scheme
FROM part
UNION ALL
SELECT 'http://example.org/concept/' || p_partkey, 'alt', lower(p_type) || ' ' || p_brand,
       CASE p_size % 3 WHEN 0 THEN 'EN' WHEN 1 THEN 'enx' ELSE 'fr' END, p_size % 2
FROM part WHERE p_partkey % 2 = 0""")
cte("tags_src", """
SELECT celex_id, 'http://example.org/concept/' || l_partkey AS uri
FROM lineitem JOIN works_src ON k = l_orderkey""", "works_src")
cte("keywords", "SELECT * FROM (VALUES ('RED'), ('Economy'), ('ring'), ('zzz')) v(keyword)")
cte("matches_src", """
SELECT keyword, uri, kind, label FROM labels_src, keywords
WHERE contains(lower(label), lower(keyword))""", "labels_src keywords")
cte("dossiers_src", """
SELECT 'http://example.org/procedure/' || year(d) || '/' || lpad(CAST(ck % 10000 AS varchar), 4, '0') || '/COD' AS ref,
       celex_id AS proposal
FROM works_src WHERE ty = 'PC'""", "works_src")
cte("adopts_src", """
SELECT celex_source AS work, celex_target AS proposal FROM relations_src
WHERE relation_type = 'adopts' AND celex_target <> ''""", "relations_src")
cte("notices_src", """
SELECT celex_id, k, CASE WHEN k % 5 = 0 THEN NULL ELSE 'Notice ,of ' || celex_id || ' ' END AS notice_title,
       CASE WHEN k % 7 = 0 THEN NULL ELSE d END AS notice_date
FROM works_src WHERE k >= 0""", "works_src")
cte("graph_src", """
SELECT celex_id, k, CASE WHEN k % 3 = 0 THEN NULL ELSE 'Graph title ;of ' || celex_id END AS title,
       CASE WHEN k % 2 = 0 THEN NULL ELSE d END AS date
FROM works_src WHERE k >= 0""", "works_src")
cte("months", """SELECT * FROM (VALUES (1,'January'),(2,'February'),(3,'March'),(4,'April'),(5,'May'),(6,'June'),
(7,'July'),(8,'August'),(9,'September'),(10,'October'),(11,'November'),(12,'December')) v(m, month_name)""")
cte("titles_src", """
SELECT k, celex_id, d, 'Regulation of ' || day(d) || ' '
       || CASE WHEN k % 9 = 0 THEN 'Smarch' ELSE month_name END || ' ' || year(d) || ' on ' || o_orderpriority AS title
FROM works_src JOIN months ON m = month(d) JOIN orders ON o_orderkey = k""", "works_src months")

# ---- lines of the documents and the units they stand for --------------------
cte("lines", """
SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS x
FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)""")
cte("std_units", f"""
SELECT doc_id, 0 AS kind, CASE i % 3 WHEN 0 THEN 'recital' WHEN 1 THEN 'article' ELSE 'annex' END AS type,
       CAST(i AS varchar) AS number, CASE WHEN i % 3 = 0 THEN NULL ELSE {nrm('substr(x, 1, 20)')} END AS title,
       {nrm('x')} AS text
FROM lines""", "lines")
_REC = "'(' || i || ') ' || x"
cte("man_rows", f"""
SELECT doc_id, i, i % 7 AS j, x, substr(x, 1, 20) AS t,
       CASE WHEN i % 7 IN (0, 1) THEN {nrm(_REC)} ELSE {nrm('x')} END AS n
FROM lines""", "lines")
cte("man_units", f"""
SELECT doc_id, 1 AS kind, 'recital' AS type, CAST(i AS varchar) AS number, NULL AS title, {nrm('n')} AS text
FROM man_rows WHERE j IN (0, 1)
UNION ALL
SELECT a.doc_id, 1, 'article', CAST(a.i AS varchar),
       CASE WHEN a.j = 2 THEN {nrm('a.t')} ELSE {nrm(nrm('a.t'))} END, {nrm("coalesce(b.n, '')")}
FROM man_rows a LEFT JOIN man_rows b ON b.doc_id = a.doc_id AND b.i = a.i + 1 WHERE a.j IN (2, 4)
UNION ALL
SELECT a.doc_id, 1, 'annex', 'IV',
       CASE WHEN a.i % 2 = 0 THEN {nrm('a.t')} ELSE trim(substr({nrm("'ANNEX IV ' || a.t")}, 9)) END,
       trim(a.n || coalesce(' ' || b.n, '') || coalesce(' ' || c.n, ''))
FROM man_rows a LEFT JOIN man_rows b ON b.doc_id = a.doc_id AND b.i = a.i + 1
     LEFT JOIN man_rows c ON c.doc_id = a.doc_id AND c.i = a.i + 2 WHERE a.j = 6""", "man_rows")
cte("plain_rows", f"""
SELECT doc_id, i, i * 3 + 2 AS ord, 'line' AS kind,
       {nrm("CASE WHEN i % 4 = 0 THEN 'Whereas ' || x ELSE x END")} AS n FROM lines
UNION ALL SELECT doc_id, i, i * 3 + 1, 'article', 'Article ' || i FROM lines WHERE i % 5 = 0
UNION ALL SELECT doc_id, i, i * 3, 'annex', 'ANNEX ' || i FROM lines WHERE i % 11 = 0""", "lines")
cte("plain_marks", """
SELECT *, max(CASE WHEN kind <> 'line' THEN ord END) OVER w AS any_head,
       max(CASE WHEN kind = 'annex' THEN ord END) OVER w AS annex_head
FROM plain_rows WINDOW w AS (PARTITION BY doc_id ORDER BY ord)""", "plain_rows")
cte("plain_units", f"""
SELECT doc_id, 2 AS kind, 'recital' AS type, CAST(i // 4 + 1 AS varchar) AS number, NULL AS title, {nrm('n')} AS text
FROM plain_rows WHERE kind = 'line' AND i % 4 = 0
UNION ALL
SELECT doc_id, 2, 'article', CAST(any_head // 3 AS varchar), '',
       {nrm("coalesce(string_agg(n, ' ' ORDER BY ord) FILTER (kind = 'line'), '')")}
FROM plain_marks WHERE any_head % 3 = 1 GROUP BY doc_id, any_head
UNION ALL
SELECT doc_id, 2, 'annex', CAST(annex_head // 3 AS varchar), '',
       {nrm("coalesce(string_agg(n, ' ' ORDER BY ord) FILTER (kind <> 'annex'), '')")}
FROM plain_marks WHERE annex_head IS NOT NULL GROUP BY doc_id, annex_head""", "plain_marks")
cte("all_units", """
SELECT * FROM std_units UNION ALL SELECT * FROM man_units UNION ALL SELECT * FROM plain_units""",
    "std_units man_units plain_units")

# ---- which bodies exist, by the rule of inputs.manifestations ----------------
cte("body_facts", """
SELECT celex_id, 'main' AS role, 'xhtml' AS fmt, doc_id, doc_id % 3 AS kind, k % 7 <> 1 AS ok,
       CASE WHEN k % 7 = 1 THEN '<br><p>' WHEN k % 7 = 3 AND k % 3 <> 1 THEN '</i><p>' ELSE '' END AS tail
FROM works_src JOIN documents ON doc_id = k WHERE k % 4 <> 0
UNION ALL
SELECT celex_id, 'main', 'html', doc_id, doc_id % 3, true, '' FROM works_src JOIN documents ON doc_id = k WHERE k % 5 <> 0
UNION ALL
SELECT celex_id, 'annex', 'xhtml', doc_id, (doc_id + 1) % 3, k % 8 <> 2, CASE k % 8 WHEN 2 THEN '<br><p>' ELSE '' END
FROM works_src JOIN documents ON doc_id = k WHERE ty = 'PC' AND k % 2 = 0
UNION ALL
SELECT celex_id, 'main', 'html', doc_id, (doc_id + 1) % 3, true, '' FROM works_src JOIN documents ON doc_id = -1 - k""",
    "works_src")
cte("own_choice", f"""
SELECT celex_id, role, fmt, doc_id, kind FROM body_facts WHERE ok AND regexp_matches(celex_id, '{CELEX}')
QUALIFY row_number() OVER (PARTITION BY celex_id, role ORDER BY CASE fmt WHEN 'xhtml' THEN 0 ELSE 1 END) = 1""",
    "body_facts")
cte("routes", f"""
SELECT m.celex_id, m.doc_id, m.kind, u.type,
       CASE WHEN u.type = 'recital' AND o.celex_id IS NOT NULL THEN 'original'
            WHEN u.type = 'annex' AND a.celex_id IS NOT NULL THEN 'annex' ELSE 'own' END AS source,
       CASE WHEN u.type = 'recital' AND o.celex_id IS NOT NULL THEN o.doc_id
            WHEN u.type = 'annex' AND a.celex_id IS NOT NULL THEN a.doc_id ELSE m.doc_id END AS src_doc,
       CASE WHEN u.type = 'recital' AND o.celex_id IS NOT NULL THEN o.kind
            WHEN u.type = 'annex' AND a.celex_id IS NOT NULL THEN a.kind ELSE m.kind END AS src_kind
FROM (SELECT * FROM own_choice WHERE role = 'main') m
CROSS JOIN (VALUES ('recital'), ('article'), ('annex')) u(type)
LEFT JOIN (SELECT * FROM own_choice WHERE role = 'main') o
       ON regexp_matches(m.celex_id, '{CONSOLIDATED}') AND o.celex_id = '3' || substr(m.celex_id, 2, 9)
LEFT JOIN (SELECT * FROM own_choice WHERE role = 'annex') a
       ON a.celex_id = m.celex_id AND substr(m.celex_id, 6, 2) = 'PC'""", "own_choice")
cte("built_units", """
SELECT r.celex_id, u.type, u.number, u.title, u.text
FROM routes r JOIN all_units u ON u.doc_id = r.src_doc AND u.kind = r.src_kind AND u.type = r.type""",
    "routes all_units")
cte("man_paragraphs", """
SELECT doc_id, -2 AS i, 0 AS o, '' AS class FROM documents UNION ALL SELECT doc_id, -1, 0, '' FROM documents
UNION ALL SELECT doc_id, max(i) + 1, 0, 'Fait' FROM lines GROUP BY doc_id
UNION ALL
SELECT doc_id, i, unnest(range(len(c))), unnest(c) FROM (SELECT doc_id, i,
  CASE WHEN i % 7 < 2 THEN ['li ManualConsidrant'] WHEN i % 7 = 2 THEN ['Titrearticle']
       WHEN i % 7 = 4 THEN ['Titrearticle', 'Titrearticle']
       WHEN i % 7 = 6 AND i % 2 = 0 THEN ['Annexetitre', 'NormalCentered', 'Normal']
       WHEN i % 7 = 6 THEN ['Annexetitre', 'Normal'] ELSE ['Normal'] END AS c FROM lines)""", "lines")

# ---- the pages themselves, by the rule of inputs.page; flat: without the wrappers and the text that goes with them
_B = "replace(replace(replace(x, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_S = _B.replace("(x,", "(substr(x, 1, 20),")
cte("page_lines", f"""
SELECT doc_id, i, kind, i = max(i) OVER (PARTITION BY doc_id, kind) AS is_last, kind = 0 AND i % 12 = 0 AS wrapped,
       CASE kind
       WHEN 0 THEN CASE i % 3
         WHEN 0 THEN '<div id="rct_' || i || '"><p>' || b || '</p></div>'
         WHEN 1 THEN '<div id="art_' || i || '"><p class="oj-ti-art">Article ' || i || '</p><div class="eli-title"><p>' || s
           || '</p></div><div><p>' || b || '</p></div></div>'
         ELSE '<div id="anx_' || i || '"><p class="oj-doc-ti">ANNEX ' || i || '</p><p class="oj-doc-ti">' || s
           || '</p><p>' || b || '</p></div>' END
       WHEN 1 THEN CASE
         WHEN i % 7 < 2 THEN '<p class="li ManualConsidrant"><span class="num">(' || i || ')</span> ' || b || '</p>'
         WHEN i % 7 = 2 THEN '<p class="Titrearticle">Article ' || i || '<br/>' || s || '</p>'
         WHEN i % 7 = 4 THEN '<p class="Titrearticle"><span>Article ' || i || '</span></p><p class="Titrearticle"><span>' || s || '</span></p>'
         WHEN i % 7 = 6 AND i % 2 = 0 THEN '<p class="Annexetitre">ANNEX IV</p><p class="NormalCentered"><b>' || s || '</b></p>'
         WHEN i % 7 = 6 THEN '<p class="Annexetitre">ANNEX IV ' || s || '</p>' ELSE '' END
         || CASE WHEN i % 7 IN (3, 5, 6) THEN '<p class="Normal">' || b || '</p>' ELSE '' END
       ELSE CASE WHEN i % 11 = 0 THEN '<p>ANNEX ' || i || '</p>' ELSE '' END
         || CASE WHEN i % 5 = 0 THEN '<p>Article ' || i || '</p>' ELSE '' END
         || '<p>' || CASE WHEN i % 4 = 0 THEN 'Whereas ' ELSE '' END || b || '</p>' END AS line
FROM (SELECT doc_id, i, {_B} AS b, {_S} AS s FROM lines), (SELECT unnest([0, 1, 2]) AS kind)""", "lines")
cte("page_html", """
SELECT doc_id, kind, head || html || tail AS html, head || flat || tail AS flat FROM (
  SELECT doc_id, kind, '<html><body><div class="eli-main-title"><p>Page ' || doc_id || '</p><p>title</p></div>'
           || CASE kind WHEN 2 THEN '<div id="TexteOnly">' ELSE '' END AS head,
         CASE kind WHEN 1 THEN '<p class="Fait">Done</p>' WHEN 2 THEN '</div>' ELSE '' END || '</body></html>' AS tail,
         string_agg(CASE WHEN wrapped THEN '<div class="content">lost' || line || '</div>lost too' ELSE line END, chr(10) ORDER BY i) AS html,
         string_agg(line || CASE WHEN is_last OR wrapped THEN '' ELSE chr(10) END, '' ORDER BY i) AS flat
  FROM page_lines GROUP BY doc_id, kind)""", "page_lines")
