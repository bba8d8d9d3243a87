"""The results of some corpus queries in DuckDB SQL."""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = rf"""
WITH lines AS (
    SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS position
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT *, {_LOWER.format(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} AS key
    FROM lines
), repeated AS (
    SELECT key, max(doc_id) AS last
    FROM keyed
    WHERE length(key) >= 40
    GROUP BY key
    HAVING count(DISTINCT doc_id) >= 5
), judged AS (
    SELECT k.*, r.key IS NOT NULL AND k.doc_id < r.last AS dropped
    FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT
    doc_id,
    count(*) AS n_lines,
    count(*) FILTER (WHERE dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT dropped), ''))
        AS kept_sha256
FROM judged
GROUP BY doc_id
"""

_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER.format("text"))

DECONTAMINATION = rf"""
WITH items AS (
    SELECT item_id, {_WORDS} AS words FROM benchmark WHERE text IS NOT NULL
), item_windows AS (
    SELECT DISTINCT item_id, array_to_string(words[s : s + 12], ' ') AS phrase,
        least(len(words), 13) AS size
    FROM (
        SELECT *, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS s
        FROM items WHERE len(words) > 0
    )
), texts AS (
    SELECT doc_id, coalesce({_WORDS}, []) AS words FROM documents
), sizes AS (
    SELECT DISTINCT size FROM item_windows
), starts AS (
    SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS s
    FROM texts, sizes WHERE len(words) >= size
), hits AS (
    SELECT doc_id, s, w.size, item_id
    FROM (SELECT doc_id, s, size, array_to_string(words[s : s + size - 1], ' ') AS phrase FROM starts) d
    JOIN item_windows w ON d.phrase = w.phrase AND d.size = w.size
), covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + size)) AS place FROM hits)
    GROUP BY doc_id
), found AS (
    SELECT doc_id, count(DISTINCT item_id::VARCHAR) AS n_items,
        string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM hits GROUP BY doc_id
)
SELECT
    t.doc_id,
    len(words) AS n_words,
    coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM texts t
LEFT JOIN covered c ON t.doc_id = c.doc_id
LEFT JOIN found f ON t.doc_id = f.doc_id
"""


def _host_quality() -> str:
    """Measures and base rules in plain SQL; each host rule with its own shrinkage."""
    rules = {
        "few_words": "n_words < 10",
        "repeated_words": "100 * n_repeat_words > 20 * n_words",
        "many_symbols": "10 * n_symbols > n_words",
        "dup_lines": "10 * n_dup_lines > 3 * n_lines",
        "word_length": "NOT word_chars BETWEEN 3 * n_words AND 12 * n_words",
    }
    counted = ", ".join(f"count(*) FILTER ({rule}) AS {k}" for k, rule in rules.items())
    sums = ", ".join(
        f"sum({k}) / sum(n) AS mean_{k}, sum({k}::DOUBLE * {k} / n) AS spread_{k}" for k in rules
    )
    alike = (
        "coalesce((spread_{0} - total * mean_{0} * mean_{0} - (hosts - 1) * mean_{0} * (1 - mean_{0}))"
        " / nullif(total - squares / total, 0) / nullif(mean_{0} * (1 - mean_{0}), 0), 0)"
    )
    strengths = ", ".join(
        f"1 / least(greatest({alike.format(k)}, 1 / (total + 1)), 0.5) - 1 AS strength_{k}"
        for k in rules
    )
    rates = ", ".join(
        f"({k} + mean_{k} * strength_{k}) / (n + strength_{k})" for k in rules
    )
    return rf"""
WITH texts AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)),
            lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, s, array_to_string(words[s : s + 4], ' ') AS phrase
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS s FROM texts)
), repeated AS (
    SELECT doc_id, s
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, phrase) AS times FROM windows)
    WHERE times > 1
), covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(s, s + 5)) AS place FROM repeated)
    GROUP BY doc_id
), sizes AS (
    SELECT t.doc_id, source, len(words)::BIGINT AS n_words,
        length(array_to_string(words, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        len(lines)::BIGINT AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM texts t LEFT JOIN covered c ON t.doc_id = c.doc_id
), hosts AS (
    SELECT source, count(*) AS n, {counted}
    FROM sizes WHERE source IS NOT NULL GROUP BY source
), sums AS (
    SELECT count(*) AS hosts, sum(n)::DOUBLE AS total, sum(n::DOUBLE * n) AS squares, {sums}
    FROM hosts
), prior AS (
    SELECT *, {strengths} FROM sums
), failed AS (
    SELECT source FROM hosts, prior WHERE greatest({rates}) > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    f.source IS NOT NULL AS host_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND f.source IS NULL AS kept
FROM sizes s LEFT JOIN failed f ON s.source = f.source
"""


HOST_QUALITY = _host_quality()


def _centroids(k: int = 16, rounds: int = 3, width: int = 64) -> str:
    """Each round written out: all distances, the least one, the means."""
    order = "sha256('1:' || vec_id), v"
    steps = [
        f"""
kept AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}
        AND len(embedding) = {width}
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY {order}) - 1 AS c, v AS m
    FROM (SELECT vec_id, v FROM kept ORDER BY {order} LIMIT {k})
)"""
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""
a{r} AS MATERIALIZED (
    SELECT vec_id, v, min({{'d': d, 'c': c}}) AS best
    FROM (
        SELECT vec_id, v, c, list_sum(list_transform(list_zip(v, m),
            lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM kept, c{r}
    )
    GROUP BY vec_id, v
)"""
        )
        if r < rounds:
            steps.append(
                f"""
m{r} AS (
    SELECT c, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY place) AS m
    FROM (
        SELECT best.c AS c, place, sum(v[place]) AS s, count(*) AS n
        FROM a{r}, range(1, {width + 1}) places(place)
        GROUP BY ALL
    )
    GROUP BY c
), c{r + 1} AS MATERIALIZED (
    SELECT o.c, coalesce(n.m, o.m) AS m FROM c{r} o LEFT JOIN m{r} n ON o.c = n.c
)"""
            )
    return (
        "WITH"
        + ",".join(steps)
        + f"""
SELECT vec_id, c.c::INTEGER AS cluster, best.d AS distance,
    (sum(best.d) OVER (PARTITION BY c.c))::BIGINT AS cluster_inertia,
    (sum(best.d) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.best.c = c.c
"""
    )


CENTROIDS = _centroids()

PREFIX_TRIE = """
WITH own AS (
    SELECT conv_id, list(
        {'k': sha256(coalesce(role, '') || chr(0) || coalesce(text, '')),
         'b': strlen(coalesce(text, ''))}
        ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS t
    FROM conversations
    WHERE conv_id IS NOT NULL
    GROUP BY conv_id
), heads AS (
    -- CRC-32 of the decimal id, bit by bit.
    SELECT conv_id, t, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT,
            list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
        lambda c, b: list_reduce(
            list_prepend(xor(c, b), range(8)),
            lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
        )) % 9 AS h
    FROM own
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.t, [])[1 : h], c.t[h + 1 :]) AS t
    FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
), prefixes AS MATERIALIZED (
    SELECT conv_id, d, d = len(t) AS ends, coalesce(t[d].b, 0) AS bytes,
        sha256(array_to_string(list_transform(t[1 : d], lambda x: x.k), ',')) AS node,
        CASE WHEN d > 0
            THEN sha256(array_to_string(list_transform(t[1 : d - 1], lambda x: x.k), ','))
        END AS parent
    FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)
), nodes AS MATERIALIZED (
    SELECT node, d, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
        any_value(bytes) AS bytes,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ids
    FROM prefixes
    GROUP BY node, d
), children AS (
    SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY 1
), below AS (
    SELECT p.node, p.d, count(*) FILTER (c.node IS NULL) AS n_leaves,
        sum((n.n_convs - 1) * n.bytes)::BIGINT AS saved_tokens
    FROM nodes n
    LEFT JOIN children c ON c.node = n.node
    JOIN prefixes p ON p.conv_id = n.conv_id AND p.d <= n.d
    GROUP BY p.node, p.d
)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs,
    coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, sha256(n.ids) AS ends_sha256
FROM nodes n
JOIN below b ON b.node = n.node AND b.d = n.d
LEFT JOIN children c ON c.node = n.node
LEFT JOIN nodes u ON u.node = n.parent
"""

_SPACED = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

_COMPONENTS = """
reached(id, node) AS (
    SELECT id, id FROM ids
    UNION
    SELECT r.id, l.v FROM reached r JOIN links l ON r.node = l.u
), components AS (
    SELECT id, min(node) AS component_id FROM reached GROUP BY id
)"""

# Each pair of documents with a common shingle, judged by full sets.
NEAR_DUPLICATES = rf"""
WITH RECURSIVE ids AS (SELECT doc_id AS id FROM documents),
texts AS (
    SELECT doc_id, coalesce({_SPACED.format(_LOWER.format("text"))}, []) AS words FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(words[s : s + 4], ' ') AS shingle
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS s FROM texts WHERE len(words) > 0)
), sizes AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS MATERIALIZED (
    SELECT a.doc_id AS u, b.doc_id AS v
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY u, v
    HAVING 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))
), {_COMPONENTS}
SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, id = component_id AS kept
FROM components LEFT JOIN sizes ON id = doc_id
"""

# All pairs of a label.
EMBEDDINGS = f"""
WITH RECURSIVE ids AS (SELECT vec_id AS id FROM embeddings),
vectors AS MATERIALIZED (
    SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_dot_product(e, e)) AS norm
    FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), links AS MATERIALIZED (
    SELECT a.vec_id AS u, b.vec_id AS v
    FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
        AND len(a.e) = len(b.e) AND a.norm > 0 AND b.norm > 0
    WHERE list_dot_product(a.e, b.e) >= 0.98 * a.norm * b.norm
), {_COMPONENTS}
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept
FROM components LEFT JOIN (SELECT u, count(*) AS n FROM links GROUP BY u) ON id = u
"""

# Every window of 50 words, and the first document that holds it.
PASSAGES = f"""
WITH texts AS (
    SELECT doc_id, coalesce({_SPACED.format("text")}, []) AS words FROM documents
), windows AS MATERIALIZED (
    SELECT doc_id, s, sha256(array_to_string(words[s : s + 49], ' ')) AS passage
    FROM (SELECT *, unnest(range(1, len(words) - 48)) AS s FROM texts)
), firsts AS (
    SELECT passage, min(doc_id) AS first FROM windows GROUP BY passage HAVING count(*) > 1
), covered AS MATERIALIZED (
    SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS place
    FROM windows JOIN firsts USING (passage) WHERE doc_id > first
), placed AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text
    FROM placed ANTI JOIN covered USING (doc_id, place)
    GROUP BY doc_id
), removed AS (
    SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id
)
SELECT t.doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0) AS n_removed,
    sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON k.doc_id = t.doc_id LEFT JOIN removed r ON r.doc_id = t.doc_id
"""
