"""SQL that gives the rows of those queries that SQL can express, over whole tables."""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(pattern: str) -> str:
    return f"ifnull(regexp_extract_all({_LOWER}, '{pattern}'), [])"


_ALPHANUMERIC = _words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BLANK_SEPARATED = _words(r"[^\x20\x09-\x0D]+")

CONTAMINATION = f"""
    WITH d AS (SELECT doc_id, {_ALPHANUMERIC} AS ws FROM documents),
      b AS (SELECT item_id, ws, least(10, len(ws)) AS width
            FROM (SELECT item_id, {_ALPHANUMERIC} AS ws FROM benchmark) WHERE len(ws) > 0),
      item_run AS (
        SELECT DISTINCT item_id, array_to_string(ws[i:i + width - 1], ' ') AS run
        FROM (SELECT *, unnest(range(1, len(ws) - width + 2)) AS i FROM b)),
      doc_run AS (
        SELECT doc_id, i, width, array_to_string(ws[i:i + width - 1], ' ') AS run
        FROM (SELECT doc_id, ws, width, unnest(range(1, len(ws) - width + 2)) AS i
              FROM d, (SELECT DISTINCT width FROM b) WHERE len(ws) >= width)),
      hit AS (SELECT * FROM doc_run WHERE run IN (SELECT run FROM item_run)),
      hit_words AS (SELECT doc_id, count(DISTINCT p) AS n
                    FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM hit) GROUP BY doc_id),
      hit_items AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items
                    FROM hit JOIN item_run USING (run) GROUP BY doc_id)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, ifnull(n, 0) AS n_hit,
           CAST(ifnull(len(items), 0) AS BIGINT) AS n_items,
           sha256(ifnull(array_to_string(items, ','), '')) AS items_sha256, n IS NOT NULL AS contaminated
    FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

_REACHED = """
      edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
      reach AS (SELECT x, y FROM edge UNION SELECT reach.x, edge.y FROM reach JOIN edge ON edge.x = reach.y),
      least_one AS (SELECT x, min(y) AS y FROM reach GROUP BY x)"""

NEAR_DUPLICATES = f"""
    WITH RECURSIVE d AS (SELECT doc_id, {_BLANK_SEPARATED} AS ws FROM documents),
      shingle AS (
        SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM d WHERE len(ws) > 0)),
      size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
      pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
               FROM shingle AS a JOIN shingle AS b ON a.s = b.s AND a.doc_id < b.doc_id
               GROUP BY a.doc_id, b.doc_id),
      link AS (SELECT x, y FROM pair JOIN size AS p ON p.doc_id = x JOIN size AS q ON q.doc_id = y
               WHERE 100 * c >= 80 * (p.n + q.n - c)),{_REACHED}
    SELECT d.doc_id, ifnull(n, 0) AS n_shingles, least(d.doc_id, ifnull(y, d.doc_id)) AS component_id,
           d.doc_id <= ifnull(y, d.doc_id) AS kept
    FROM d LEFT JOIN size ON size.doc_id = d.doc_id LEFT JOIN least_one ON x = d.doc_id"""

NEAR_VECTORS = f"""
    WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
      link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v AS a JOIN v AS b ON a.vec_id < b.vec_id
               WHERE list_cosine_similarity(a.e, b.e) >= 0.9),{_REACHED},
      degree AS (SELECT x, count(*) AS n FROM edge GROUP BY x)
    SELECT vec_id, ifnull(n, 0) AS n_links, least(vec_id, ifnull(y, vec_id)) AS component_id,
           vec_id <= ifnull(y, vec_id) AS kept
    FROM v LEFT JOIN least_one ON least_one.x = vec_id LEFT JOIN degree ON degree.x = vec_id"""


def _clusters(rounds: int) -> str:
    """Each assignment and update written out."""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""
      a{t} AS (SELECT n, any_value(v.e) AS e, min({{'d': list_inner_product(v.e, v.e)
                 - 2 * list_inner_product(v.e, c{t}.e) + list_inner_product(c{t}.e, c{t}.e), 'c': c}}) AS best
               FROM v, c{t} GROUP BY n)""")
        if t < rounds:
            steps.append(f"""
      s{t} AS (SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS m
               FROM (SELECT best.c AS c, unnest(e) AS x, unnest(range(64)) AS i FROM a{t}) GROUP BY c, i),
      c{t + 1} AS (SELECT c, ifnull(means.e, c{t}.e) AS e
                   FROM c{t} LEFT JOIN (
                     SELECT c, list(CAST((s - ((s % m) + m) % m) // m AS DOUBLE) ORDER BY i) AS e
                     FROM s{t} GROUP BY c) AS means USING (c))""")
    return ",".join(steps)


_WHOLE = "[floor(256 * CAST(x AS DOUBLE)) for x in embedding]"
_FINITE = "embedding IS NOT NULL AND len([x for x in embedding if isfinite(x)]) = len(embedding)"

CLUSTERS = f"""
    WITH v AS (SELECT vec_id, row_number() OVER () AS n, {_WHOLE} AS e
               FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
      c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), e) - 1 AS c, e FROM v QUALIFY c < 40),
      {_clusters(5)},
      total AS (SELECT best.c AS c, sum(best.d) AS d FROM a5 GROUP BY 1)
    SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
           CAST(total.d AS BIGINT) AS cluster_inertia,
           CAST((SELECT sum(d) FROM total) AS BIGINT) AS inertia,
           sha256(array_to_string(CAST(c5.e AS BIGINT[]), ',')) AS centroid_sha256
    FROM a5 JOIN v USING (n) JOIN total ON total.c = best.c JOIN c5 ON c5.c = best.c"""

HARD_NEGATIVES = f"""
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_WHOLE} AS e
               FROM embeddings WHERE label IS NOT NULL AND {_FINITE}),
      score AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                       CAST(list_inner_product(a.e, b.e) AS BIGINT) AS s
                FROM v AS a JOIN v AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
      positive AS (SELECT anchor_id, other_id AS positive_id, s AS positive_score FROM score WHERE same
                   QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, other_id) <= 5)
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, other_id) AS INTEGER) AS rank,
           other_id AS negative_id, positive_score, s AS negative_score
    FROM positive JOIN score USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * s AND 100 * s <= 100 * positive_score
    QUALIFY rank <= 5"""

_TO_VALUE = """["'']?\\x20*[:=]\\x20*["'']?"""


def _any_case(*names: str) -> str:
    """The names in either case of A-Z, which (?i) would widen to other letters."""
    return "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in n) for n in names)


_NAMES = _any_case("password", "passwd", "secret", "token", "api_?key")
_ACCOUNTS = _any_case("access_?key_?id", "client_?id", "account", "username", "user", "login")
_SECRET_KINDS = [
    # kind, pattern, least length of the value, number of the group that is the value
    ("assign", f"({_NAMES}){_TO_VALUE}([A-Za-z0-9+/_.=-]+)", 8, 2),
    ("access", "AKIA[A-Z0-9]+", 16, 0),
    ("hex", "[0-9a-f]+", 32, 0),
    ("account", f"({_ACCOUNTS}){_TO_VALUE}([A-Za-z0-9@._+-]{{3,}})", 0, 2),
    ("key", "[A-Za-z0-9+/_=-]{20,}", 0, 0),
    ("endpoint", """(https?|ftp|s3|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\\x00-\\x20"''<>\\x7F]+""", 0, 0),
]


def _spans() -> str:
    """Matches of each kind with offsets, from the pieces between them."""
    return " UNION ALL ".join(
        f"""
        SELECT doc_id, {order} AS kind, begin AS start, begin + length(found) AS stop, found
        FROM (SELECT doc_id, unnest(found) AS found, unnest(value) AS value,
                     unnest([CAST(list_sum([length(p) for p in pieces[:i]])
                                  + ifnull(list_sum([length(f) for f in found[:i - 1]]), 0) AS BIGINT)
                             for i in range(1, len(found) + 1)]) AS begin
              FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS found,
                           regexp_extract_all(text, '{pattern}', {group}) AS value,
                           string_split_regex(text, '{pattern}') AS pieces FROM documents))
        WHERE length(value) >= {least}"""
        for order, (_, pattern, least, group) in enumerate(_SECRET_KINDS)
    )


_KIND_NAMES = "[" + ", ".join(f"'{k}'" for k, *_ in _SECRET_KINDS) + "]"


def _joined(where: str = "true") -> str:
    return f"ifnull(string_agg({_KIND_NAMES}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER ({where}), '')"


def _near(role: str) -> str:
    """Whether a part of these kinds is at most 200 code points away, without a blank line between."""
    return f"""EXISTS (SELECT 1 FROM part AS o WHERE o.doc_id = w.doc_id AND o.kind IN ({role})
                AND w.start < o.stop + 200 AND w.stop > o.start - 200
                AND NOT regexp_matches(substring(w.text, least(w.stop, o.stop) + 1,
                                       greatest(greatest(w.start, o.start) - least(w.stop, o.stop), 0)),
                                       '\\n[\\x20\\t\\r]*\\n'))"""


CREDENTIALS = f"""
    WITH span AS ({_spans()}),
      part AS (
        SELECT doc_id, kind, start, stop FROM span AS s
        WHERE kind < 3 OR (
          (kind <> 4 OR (regexp_matches(found, '[0-9]') AND regexp_matches(found, '[a-z]') AND regexp_matches(found, '[A-Z]')))
          AND NOT EXISTS (SELECT 1 FROM span AS b WHERE b.doc_id = s.doc_id AND b.kind < 3
                          AND b.start < s.stop AND b.stop > s.start))),
      w AS (SELECT part.*, text FROM part JOIN documents USING (doc_id)),
      told AS (
        SELECT doc_id, kind, start, stop FROM w
        WHERE kind < 3
           OR ((kind = 4 OR {_near("0, 2, 4")}) AND (kind = 3 OR {_near("1, 3")})))
    SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
           count(*) FILTER (kind = 2) AS n_hex, sha256({_joined("kind < 3")}) AS base_sha256, {_joined()} AS spans
    FROM documents LEFT JOIN told USING (doc_id) GROUP BY doc_id"""
