"""SQL of the training-data queries where SQL can express them."""

SQL = {
    "p4_found": """
        WITH f AS (SELECT chunk_id, c.species, c.chrom,
                          CASE WHEN strand = 'backward' THEN length - c."end" ELSE c."begin" END AS b,
                          CASE WHEN strand = 'backward' THEN length - c."begin" ELSE c."end" END AS e
                   FROM chunks c LEFT JOIN (SELECT species, chrom, max(length) AS length FROM sequences GROUP BY ALL) s USING (species, chrom)
                   WHERE c.species IS NOT NULL AND c.chrom IS NOT NULL AND c."begin" IS NOT NULL),
        m AS (SELECT *, max(e) OVER (PARTITION BY species, chrom ORDER BY b, e, chunk_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM f WHERE b < e),
        g AS (SELECT *, sum(CASE WHEN pe IS NULL OR b >= pe THEN 1 ELSE 0 END) OVER (PARTITION BY species, chrom ORDER BY b, e, chunk_id ROWS UNBOUNDED PRECEDING) AS k FROM m),
        n AS (SELECT species, chrom, k, min(chunk_id) AS group_id FROM g GROUP BY ALL HAVING count(*) > 1)
        SELECT chunk_id, group_id FROM g JOIN n USING (species, chrom, k)""",
    # with many groups of one row both tenths can be met exactly, and no group may be divided
    "p4_balance": """
        WITH n AS (SELECT count(*) AS n, CAST(round_even(count(*) * 0.1, 0) AS BIGINT) AS tenth FROM chunks)
        SELECT split, CASE split WHEN 'train' THEN n - 2 * tenth ELSE tenth END AS n_rows, CAST(0 AS BIGINT) AS n_divided
        FROM n, (VALUES ('train'), ('validation'), ('test')) v(split)""",
}
