"""SQL of the general table problems."""

from __future__ import annotations

from strandloom.plans.attributes_sql import first_value, with_pairs

_QUOTED = r"""(?:"(?:[^"\\]|\\.|"")*"|''(?:[^''\\]|\\.|'''')*'')[ ]*"""
#: A piece whose quoting is whole: a word, an equals sign, blanks, then a quoted or a plain value; each of them may lack.
_WHOLE = rf"""[ ]*(?:[^;,|= "''][^;,|= ]*(?:[ ]*=[ ]*(?:{_QUOTED}|[^;,| "''][^;,|]*)?|[ ]+(?:{_QUOTED}|[^;,|= "''][^;,|]*)?)?|=[ ]*(?:{_QUOTED}|[^;,| "''][^;,|]*)?|{_QUOTED})?"""

#: One feature of each set of equals, its link to its parent, and root and depth of those that hang from a root.
_LINKED = f"""WITH RECURSIVE {with_pairs("gff_features", "pz")},
        o AS (SELECT min(feat_id) AS node, species, type, any_value({first_value("ID")}) AS i, any_value({first_value("Parent")}) AS p, any_value({first_value("gene_id")}) AS g, any_value({first_value("transcript_id")}) AS t
              FROM pz GROUP BY species, chr, source, type, start, "end", score, strand, phase, attributes),
        l AS (SELECT node, species, CASE WHEN i IS NOT NULL OR p IS NOT NULL THEN i WHEN g IS NULL THEN NULL WHEN type = 'gene' THEN g WHEN type IN ('mRNA', 'transcript') THEN t END AS own,
                     CASE WHEN i IS NOT NULL OR p IS NOT NULL THEN p WHEN g IS NULL OR type = 'gene' THEN NULL WHEN type IN ('mRNA', 'transcript') THEN g ELSE t END AS up FROM o),
        w AS (SELECT species, own, min(node) AS parent FROM l WHERE own IS NOT NULL GROUP BY ALL),
        e AS (SELECT l.node, w.parent FROM l LEFT JOIN w ON w.species = l.species AND w.own = l.up),
        r(node, root, depth) AS (SELECT node, node, 0 FROM e WHERE parent IS NULL UNION ALL SELECT e.node, r.root, r.depth + 1 FROM r JOIN e ON e.parent = r.node)"""

SQL = {
    "p1_found": """
        SELECT species, chrom FROM chunks WHERE species IS NOT NULL AND chrom IS NOT NULL
        GROUP BY species, chrom HAVING count(*) * 25 >= (SELECT count(*) FROM chunks)""",
    "p1_key_stats": """
        SELECT species, chrom, count(*) AS n_rows, count(seq) AS n_seq, CAST(sum(length(seq)) AS BIGINT) AS n_bases,
               min("begin") AS first_begin, max("end") AS last_end, count(DISTINCT "begin") AS n_begins
        FROM chunks GROUP BY species, chrom""",
    "p2_found": f"""
        WITH {with_pairs("gff_features", "pz")},
        u AS (SELECT feat_id, unnest(ps) AS x, generate_subscripts(ps, 1) AS i FROM pz WHERE type = 'gene'),
        c AS (SELECT feat_id, i, x.v AS val, last_value(nullif(x.k, '') IGNORE NULLS) OVER (PARTITION BY feat_id ORDER BY i) AS attr_key FROM u)
        SELECT feat_id, CAST(row_number() OVER (PARTITION BY feat_id ORDER BY i) AS INT) AS pos, attr_key, val FROM c WHERE val <> '' AND attr_key IS NOT NULL""",
    "p3_found": f"""
        {_LINKED},
        a(node, anc) AS (SELECT node, parent FROM e WHERE parent IS NOT NULL UNION SELECT a.node, e.parent FROM a JOIN e ON e.node = a.anc WHERE e.parent IS NOT NULL),
        n AS (SELECT anc, count(*) AS n FROM a WHERE node <> anc GROUP BY anc)
        SELECT e.node AS feat_id, coalesce(root, -1) AS root_feat_id, CAST(coalesce(depth, -1) AS INT) AS depth, coalesce(n, 0) AS n_desc
        FROM e LEFT JOIN r ON r.node = e.node LEFT JOIN n ON n.anc = e.node""",
    "p3_descendants": f"""
        {_LINKED},
        a(node, anc, distance) AS (SELECT e.node, e.parent, 1 FROM e JOIN r ON r.node = e.node WHERE e.parent IS NOT NULL UNION ALL SELECT a.node, e.parent, a.distance + 1 FROM a JOIN e ON e.node = a.anc WHERE e.parent IS NOT NULL)
        SELECT anc AS feat_id, node AS desc_feat_id, CAST(distance AS INT) AS distance FROM a""",
    "p5_found": rf"""
        WITH x AS (SELECT line_id, regexp_replace(line, '\r$', '') AS s FROM gff_lines),
        y AS (SELECT line_id, string_split(s, chr(9)) AS f FROM x WHERE regexp_matches(s, '[^ \t\n\r\x0b\f]') AND NOT starts_with(s, '#') AND NOT starts_with(s, 'track')),
        z AS (SELECT line_id, f, f[9] AS attributes FROM y),
        {with_pairs("z", "pz")},
        k AS (SELECT line_id, f, attributes, len(list_filter(ps, lambda q: q.k <> '' AND q.v <> '')) > 0 AS has FROM pz),
        j AS (SELECT line_id, CASE WHEN len(f) <> 9 THEN 'columns' WHEN NOT regexp_full_match(attributes, '{_WHOLE}(?:[;,|]{_WHOLE})*') THEN 'quoting'
                    WHEN NOT regexp_full_match(f[1], '[A-Za-z0-9_.-]*[A-Za-z0-9][A-Za-z0-9_.-]*') OR NOT regexp_full_match(f[4], '[0-9]+') OR NOT regexp_full_match(f[5], '[0-9]+')
                         OR NOT coalesce(TRY_CAST(f[4] AS BIGINT) BETWEEN 1 AND TRY_CAST(f[5] AS BIGINT), false) OR NOT (has OR attributes = '.') THEN 'value' END AS reason FROM k)
        SELECT line_id, reason FROM j WHERE reason IS NOT NULL""",
    "p6_found": """
        WITH x AS (SELECT species, chr, strand, start AS s, "end" AS e FROM gff_features
                   WHERE type = 'exon' AND strand IN ('+', '-') AND chr IS NOT NULL AND start <= "end"),
        m AS (SELECT *, max(e) OVER (PARTITION BY species, chr, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM x),
        g AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY species, chr, strand ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM m),
        p AS (SELECT species, chr, strand, k, min(s) AS s, max(e) AS e FROM g GROUP BY ALL),
        n AS (SELECT *, lead(s) OVER (PARTITION BY species, chr, strand ORDER BY s) AS ns FROM p)
        SELECT species, chr, strand, 'period' AS kind, s AS seg_start, e AS seg_end FROM p
        UNION ALL SELECT species, chr, strand, 'gap', e + 1, ns - 1 FROM n WHERE ns - e - 1 BETWEEN 1 AND 10000""",
}
