"""SQL for queries whose rounds or levels repeat: each is a chain of common table expressions."""

from __future__ import annotations

from tidemark.llm import centroids, mixture

WORDS = r"[^\x20\x09-\x0D]+"


def clustering() -> str:
    """Lloyd's rounds, each a chain of three expressions."""
    ctes = [
        f"""kept AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: CAST(floor(
                least(greatest({centroids.SCALE} * CAST(c AS DOUBLE), -134217728), 134217728))
                AS BIGINT)) AS x
            FROM embeddings
            WHERE len(embedding) = {centroids.DIMENSIONS} AND len(list_filter(embedding,
                lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0)""",
        f"""c0 AS (
            SELECT row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id) NULLS LAST, x)
                   - 1 AS c, x
            FROM kept QUALIFY c < {centroids.CLUSTERS})""",
    ]
    for i in range(centroids.ROUNDS + 1):
        ctes.append(f"""a{i} AS (
            SELECT r, any_value(kept.vec_id) AS vec_id, any_value(kept.x) AS x, min({{
                'd': CAST(list_sum(list_transform(list_zip(kept.x, c{i}.x),
                    lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT), 'c': c}}) AS near
            FROM kept, c{i} GROUP BY r)""")
        ctes.append(f"""s{i} AS (
            SELECT c, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS n
            FROM (SELECT near.c AS c, unnest(x) AS v, unnest(range(len(x))) AS i FROM a{i})
            GROUP BY c, i)""")
        ctes.append(f"""c{i + 1} AS (
            SELECT c, coalesce(m.x, c{i}.x) AS x
            FROM c{i} LEFT JOIN (
                SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s{i} GROUP BY c
            ) m USING (c))""")
    last = centroids.ROUNDS
    return f"""
    WITH {", ".join(ctes[:-2])}
    SELECT vec_id, CAST(near.c AS INTEGER) AS cluster, near.d AS distance,
           CAST(sum(near.d) OVER (PARTITION BY near.c) AS BIGINT) AS cluster_inertia,
           CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(c{last}.x, ',')) AS centroid_sha256
    FROM a{last} JOIN c{last} ON c = near.c
    """


def _snapped(p: str) -> str:
    return f"CASE WHEN {p} < 1e-9 THEN 0.0::DOUBLE WHEN {p} > 1 - 1e-9::DOUBLE THEN 1.0::DOUBLE ELSE {p} END"


def _number(digest: str) -> str:
    return f"CAST('0x' || substr(md5({digest}), 1, 13) AS BIGINT)"


def _item(of: str, p: str) -> str:
    return f"{{'id': {of}.id, 'h': {of}.h, 'size': {of}.size, 'copies': {of}.copies, 'p': {p}}}"


def mixing(levels: int = 5) -> str:
    """Five levels of blocks hold 64^5 documents a source; a level too many changes nothing."""
    p, q, v, w = "a.open.p", "e.open.p", "CAST(a.open.size AS DOUBLE)", "CAST(e.open.size AS DOUBLE)"
    up, down = f"least((1 - {p}) * {v}, {q} * {w})", f"least({p} * {v}, (1 - {q}) * {w})"
    draw = _number(f"'{mixture.SEED}|' || a.open.h || '|' || e.open.h")
    moved = f"""(CASE WHEN CAST({draw} AS DOUBLE) / CAST({16**13} AS DOUBLE) * ({up} + {down}) < {down}
                 THEN {up} ELSE -({down}) END)"""
    both = f"""[{_item("a.open", _snapped(f"({p} + {moved} / {v})"))},
                {_item("e.open", _snapped(f"({q} - {moved} / {w})"))}]"""
    settle = f"""CASE WHEN a.open IS NULL THEN {{'open': e.open, 'done': a.done}} ELSE {{
        'open': list_filter({both}, lambda y: y.p > 0 AND y.p < 1)[1],
        'done': list_concat(a.done, list_filter({both}, lambda y: y.p <= 0 OR y.p >= 1))}} END"""
    ctes = [
        f"""grouped AS (
            SELECT source, doc_id AS id, CAST(coalesce(len(regexp_extract_all(text, '{WORDS}')), 0)
                   AS BIGINT) AS size, count(*) AS m
            FROM documents GROUP BY ALL)""",
        """totals AS (
            SELECT source, CAST(sum(size * m) AS BIGINT) AS words,
                   count(*) FILTER (size > 0) AS documents
            FROM grouped GROUP BY source)""",
        f"""weighed AS (
            SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE)
                   AS weight, words * CAST({mixture.MOST} AS DOUBLE) AS most
            FROM totals)""",
        """shared AS (
            SELECT *, row_number() OVER o AS k,
                   (CAST(sum(words) OVER () AS DOUBLE) - coalesce(sum(most) OVER (
                        o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
            FROM weighed WINDOW o AS (ORDER BY most / weight, source NULLS LAST))""",
        """settled_rate AS (
            SELECT min(k) AS first_below, arg_min(rate, k) AS rate
            FROM shared WHERE most > rate * weight)""",
        """targets AS (
            SELECT source, words, documents,
                   CASE WHEN k >= first_below THEN s.rate * weight ELSE most END AS target
            FROM shared, (SELECT (SELECT first_below FROM settled_rate) AS first_below,
                                 (SELECT rate FROM settled_rate) AS rate) s)""",
        f"""spread AS (
            SELECT g.source, id, size, m, target, words,
                   {_snapped("(rate - floor(rate))")} AS p, CAST(floor(rate) AS BIGINT) AS copies,
                   {_number(f"'{mixture.SEED}|' || coalesce(CAST(id AS VARCHAR), 'null') || '|' || size")} AS h,
                   greatest(1, CAST(ceil(documents / {mixture.BLOCK}) AS BIGINT)) AS blocks
            FROM grouped g JOIN (SELECT *, CASE WHEN words > 0 THEN target / words ELSE 0 END AS rate
                                 FROM targets) t ON g.source IS NOT DISTINCT FROM t.source)""",
        f"""split AS (
            SELECT *, CAST(floor(m * p + 1e-9) AS BIGINT) AS high,
                   {_snapped("greatest(m * p - floor(m * p + 1e-9), 0)")} AS rest,
                   ((h >> 20) * blocks) >> 32 AS block
            FROM spread)""",
        """b0 AS (
            SELECT source, block, {'open': {'id': id, 'h': h, 'size': size, 'copies': copies, 'p': rest},
                'done': CAST([] AS STRUCT(id BIGINT, h BIGINT, size BIGINT, copies BIGINT, p DOUBLE)[])} AS x
            FROM split WHERE size > 0 AND rest > 0)""",
    ]
    for i in range(levels):
        ctes.append(f"""r{i} AS (
            SELECT source, block, list_reduce(list(x ORDER BY x.open.size DESC, x.open.h,
                x.open.id NULLS FIRST), lambda a, e: {settle}) AS s
            FROM b{i} GROUP BY source, block)""")
        ctes.append(f"""b{i + 1} AS (
            SELECT source, block // {mixture.BLOCK} AS block, {{'open': s.open,
                'done': CAST([] AS STRUCT(id BIGINT, h BIGINT, size BIGINT, copies BIGINT, p DOUBLE)[])}} AS x
            FROM r{i} WHERE s.open IS NOT NULL)""")
    done = " UNION ALL ".join(
        f"SELECT source, y.id AS id, y.size AS size, y.copies + CAST(y.p AS BIGINT) AS copies, 1 AS m"
        f" FROM (SELECT source, unnest(s.done) AS y FROM r{i})"
        for i in range(levels)
    )
    return f"""
    WITH {", ".join(ctes)},
    chosen AS (
        SELECT source, id, size, copies + 1 AS copies, high AS m FROM split
        UNION ALL
        SELECT source, id, size, copies,
               m - high - CASE WHEN size > 0 AND rest > 0 THEN 1 ELSE 0 END FROM split
        UNION ALL {done}
        UNION ALL
        SELECT source, x.open.id, x.open.size, x.open.copies + CAST(round(x.open.p) AS BIGINT), 1
        FROM b{levels})
    SELECT id AS doc_id, size, words AS source_size, target, copies * size AS taken
    FROM (SELECT *, unnest(range(m)) AS nth FROM chosen WHERE m > 0) c
    JOIN targets t ON c.source IS NOT DISTINCT FROM t.source
    """
