"""DuckDB SQL with the same results as the registered queries, where SQL can express them."""

OP1 = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS size,
    CAST('0x' || substr(md5('17:' || doc_id), 1, 15) AS BIGINT) AS draw
  FROM documents
),
sources AS (
  SELECT *, 3.0 * size AS cap, 1.0 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS size FROM d GROUP BY source)
),
-- sources by what they can give for their weight: the first ones are clamped
ordered AS (
  SELECT *, row_number() OVER w AS place, lead(cap / weight) OVER w AS next_ratio,
    (sum(size) OVER () - sum(cap) OVER upto) / nullif(sum(weight) OVER () - sum(weight) OVER upto, 0) AS level
  FROM sources
  WINDOW w AS (ORDER BY cap / weight, source),
    upto AS (ORDER BY cap / weight, source ROWS UNBOUNDED PRECEDING)
),
final AS (
  SELECT coalesce(
    (SELECT sum(size) / sum(weight) FROM sources
     HAVING min(cap / weight) >= sum(size) / sum(weight)),
    (SELECT level FROM ordered WHERE next_ratio >= level ORDER BY place LIMIT 1)) AS level
),
goals AS (
  SELECT source, size AS source_size, least(weight * level, cap) AS target FROM sources, final
),
placed AS (
  SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS epochs,
    sum(size) OVER (PARTITION BY g.source ORDER BY draw % 1024, draw, doc_id, size
                    ROWS UNBOUNDED PRECEDING) - size / 2.0 AS middle
  FROM d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (epochs + CASE WHEN middle < target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT)
    AS taken
FROM placed
"""

OP3 = """
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS no
  FROM documents WHERE text IS NOT NULL
),
places AS (SELECT * FROM split WHERE length(line) >= 20),
lines AS (
  SELECT line, length(line) AS size, min({'doc': doc_id, 'no': no}) AS first FROM places GROUP BY line
),
-- lines at most one edit apart share their first or their last half, by the shorter one's length
longer AS (SELECT *, size - unnest([0, 1]) AS other FROM lines),
candidates AS (
  SELECT a.line AS a, b.line AS b, a.first AS first_a, b.first AS first_b
  FROM lines a JOIN longer b ON b.other = a.size AND left(a.line, a.size // 2) = left(b.line, b.other // 2)
  UNION
  SELECT a.line, b.line, a.first, b.first
  FROM lines a JOIN longer b
    ON b.other = a.size AND right(a.line, a.size - a.size // 2) = right(b.line, b.other - b.other // 2)
),
near AS (
  SELECT DISTINCT CASE WHEN first_a > first_b THEN a ELSE b END AS line
  FROM candidates
  WHERE a <> b AND CASE
    WHEN length(a) = length(b) THEN 1 = len(list_filter(range(1, length(a) + 1),
      lambda i: substr(a, i, 1) <> substr(b, i, 1)))
    ELSE 0 < len(list_filter(range(0, length(a) + 1),
      lambda i: left(a, i) = left(b, i) AND substr(a, i + 1) = substr(b, i + 2))) END
),
gone AS (
  SELECT doc_id, no, {'doc': doc_id, 'no': no} > first AS later
  FROM places JOIN lines USING (line)
  WHERE {'doc': doc_id, 'no': no} > first OR line IN (SELECT line FROM near)
),
per_document AS (
  SELECT doc_id, count(*) FILTER (WHERE later) AS n_exact, count(*) FILTER (WHERE NOT later) AS n_near,
    string_agg(CAST(no AS VARCHAR), ',' ORDER BY no) AS removed
  FROM gone GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines,
  coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near, coalesce(removed, '') AS removed
FROM documents LEFT JOIN per_document USING (doc_id)
"""

OP6 = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
    regexp_replace(coalesce(text, ''), '[ \\t-\\r]', '', 'g') AS body
  FROM documents
)
SELECT doc_id,
  first_value(doc_id) OVER best AS keep_id,
  count(*) OVER (PARTITION BY body) AS group_size,
  doc_id = first_value(doc_id) OVER best AS kept,
  sha256(body) AS text_sha256
FROM d
WINDOW best AS (PARTITION BY body ORDER BY size DESC, doc_id)
"""

OP7 = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+') AS words FROM documents
),
windows AS (
  SELECT doc_id, start, array_to_string(list_slice(words, start, start + 34), ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS start FROM d)
),
starts AS (
  SELECT doc_id, start FROM windows
  WHERE run IN (SELECT run FROM windows GROUP BY run HAVING count(*) > 1)
),
covered AS (
  SELECT DISTINCT doc_id, start + step AS place FROM starts, (SELECT unnest(range(35)) AS step)
),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS body, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM d) w
  WHERE NOT EXISTS (
    SELECT 1 FROM covered c WHERE c.doc_id = w.doc_id AND c.place = w.place
  )
  GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

#: Measure of the quality rules, and whether it can be too low.
MEASURES = (
    ("(n_symbols + 1) / (word_chars + 100)", False),
    ("(n_exclamations + 1) / (n_words + 20)", False),
    ("(n_dup_lines + 1) / (n_lines + 5)", False),
    ("(n_repeat_words + 1) / (n_words + 20)", False),
    ("(n_stutters + 1) / (n_words + 20)", False),
    ("word_chars / n_words", True),
)

OP8 = f"""
WITH d AS (
  SELECT *, regexp_extract_all(body, '[^ \\t-\\r]+') AS words,
    list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS lines
  FROM (SELECT doc_id, lang, source, coalesce(text, '') AS body FROM documents)
),
runs AS (
  SELECT doc_id, start, array_to_string(list_slice(words, start, start + 7), ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS start FROM d)
),
again AS (
  SELECT doc_id, count(DISTINCT start + step) AS n
  FROM (SELECT doc_id, start FROM runs QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1),
    (SELECT unnest(range(8)) AS step)
  GROUP BY doc_id
),
counts AS (
  SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(body) - length(replace(body, '!', '')) AS BIGINT) AS n_exclamations,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(list_filter(range(1, len(words)), lambda i: words[i] = words[i + 1])) AS BIGINT) AS n_stutters
  FROM d LEFT JOIN again USING (doc_id)
),
measured AS (
  SELECT doc_id, lang, source, measure, CAST(ceil(ln(value) / ln(1.005)) AS INTEGER) AS bin
  FROM (
    SELECT doc_id, lang, source, unnest(range({len(MEASURES)})) AS measure,
      unnest([{", ".join(m for m, _ in MEASURES)}]) AS value
    FROM counts WHERE n_words > 0)
),
sizes AS (
  SELECT lang, source, n_docs, sum(n_docs) OVER (PARTITION BY lang) AS n_lang
  FROM (SELECT lang, source, count(*) AS n_docs FROM counts WHERE n_words > 0 GROUP BY lang, source)
),
levels AS (
  SELECT lang, source, CASE WHEN n_docs >= 50 THEN 0 WHEN n_lang >= 50 THEN 1 ELSE 2 END AS level FROM sizes
),
quartiles AS (
  SELECT 0 AS level, lang, source, measure, quantile_disc(bin, [0.25, 0.75]) AS q
  FROM measured GROUP BY lang, source, measure
  UNION ALL
  SELECT 1, lang, NULL, measure, quantile_disc(bin, [0.25, 0.75]) FROM measured GROUP BY lang, measure
  UNION ALL
  SELECT 2, NULL, NULL, measure, quantile_disc(bin, [0.25, 0.75]) FROM measured GROUP BY measure
),
fences AS (
  SELECT g.lang, g.source, measure, q[1] - 3 * (q[2] - q[1]) AS low, q[2] + 3 * (q[2] - q[1]) AS high,
    list_extract([{", ".join(str(low).lower() for _, low in MEASURES)}], measure + 1) AS has_low
  FROM levels g JOIN quartiles f ON f.level = g.level
    AND CASE WHEN g.level < 2 THEN g.lang END IS NOT DISTINCT FROM f.lang
    AND CASE WHEN g.level < 1 THEN g.source END IS NOT DISTINCT FROM f.source
),
outside AS (
  SELECT DISTINCT doc_id
  FROM measured m JOIN fences f ON m.measure = f.measure
    AND m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source
  WHERE bin > high OR has_low AND bin < low
)
SELECT counts.* EXCLUDE (lang, source),
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
    AND doc_id NOT IN (SELECT doc_id FROM outside WHERE doc_id IS NOT NULL) AS kept
FROM counts
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# CRC-32 of texts, byte by byte, as macros over a table of 256 numbers
CRC = """
crc_table AS (
  SELECT list(c ORDER BY i) AS steps FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))
)"""


def _crc(text):
    """CRC-32 of a text column beside `steps`."""
    octets = (
        f"list_transform(range(0, CAST(octet_length(encode({text})) AS BIGINT)), lambda i: CAST('0x' ||"
        f" substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    )
    return (
        f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}),"
        " lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8)), CAST(4294967295 AS BIGINT))"
    )


OP11 = f"""
WITH {CRC.strip()},
texts AS (
  SELECT true AS corpus, doc_id AS id, text FROM documents
  UNION ALL SELECT false, item_id, text FROM benchmark
),
split AS (
  SELECT corpus, id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM texts
),
features AS (
  SELECT corpus, id, unnest(words) AS feature FROM split
  UNION ALL
  SELECT corpus, id, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))
  FROM split
),
hashed AS (
  SELECT feature, {_crc("feature")} % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM features), crc_table
),
placed AS (SELECT corpus, id, bucket FROM features JOIN hashed USING (feature)),
counts AS (
  SELECT bucket, count(*) FILTER (WHERE corpus) AS s, count(*) FILTER (WHERE NOT corpus) AS t
  FROM placed GROUP BY bucket
),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * ((SELECT sum(s) FROM counts) + 10000)
    / (CAST(s + 1 AS DOUBLE) * ((SELECT sum(t) FROM counts) + 10000)))) AS BIGINT) AS gain
  FROM counts
),
sums AS (
  SELECT id AS doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total
  FROM placed JOIN gains USING (bucket) WHERE corpus GROUP BY id
),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, len(words) AS n_words,
    CASE WHEN n > 0 THEN (total - ((total % n) + n) % n) // n ELSE 0 END AS weight,
    CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM (SELECT id AS doc_id, words FROM split WHERE corpus) LEFT JOIN sums USING (doc_id)
),
ranked AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
  FROM scored
),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM ranked WHERE n_words >= 20
  QUALIFY rank <= 25 * count(*) OVER () // 100
)
SELECT doc_id, n_features, weight, score, rank FROM ranked LEFT JOIN drawn USING (doc_id)
"""


def _merkle_tree(leaves, name, levels):
    """Levels of the trees of a table (tree, position, digest), as common table expressions.

    A level has the nodes of the trees that are not finished below it, and the finished ones as they are.
    """
    parts, last = [], leaves
    for level in range(1, levels + 1):
        here = f"{name}{level}"
        parts.append(f"""
{here} AS (
  SELECT tree, position // 16 AS position,
    CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY position)) END
      AS digest
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {last})
  GROUP BY tree, position // 16
)""")
        last = here
    return parts, last


def _merkle_steps(of, name, leaves, levels):
    """Digests left and right of a node's ancestors, as columns l1, r1, l2, ..., null where the tree is done."""
    parts, last = [], of
    for level in range(1, levels + 1):
        nodes = leaves if level == 1 else f"{name}{level - 1}"
        here = f"{name}_way{level}"
        at = f"(f.{name}_position // {16 ** (level - 1)})"
        parts.append(f"""
{here} AS (
  SELECT f.*, x.l AS {name}_l{level}, x.r AS {name}_r{level}
  FROM {last} f LEFT JOIN (
    SELECT tree AS t, position AS p,
      coalesce(string_agg(digest, '') OVER (PARTITION BY tree, position // 16 ORDER BY position
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
      coalesce(string_agg(digest, '') OVER (PARTITION BY tree, position // 16 ORDER BY position
        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM {nodes} QUALIFY count(*) OVER (PARTITION BY tree) > 1
  ) x ON x.t = f.{name}_tree AND x.p = {at}
)""")
        last = here
    return parts, last


#: Levels that the SQL looks at: sources of up to 65,536 rows, and up to 256 sources.
LEAF_LEVELS, TOP_LEVELS = 4, 2


def _op12():
    def field(column):
        return f"coalesce(octet_length(encode(CAST({column} AS VARCHAR))) || ':' || {column}, '-')"

    fields = [field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = [field("text"), field(f"translate(text, '{UPPER}', '{LOWER}')")]
    plain, changed = (" || ".join([*fields, t]) for t in text)
    up, subroots = _merkle_tree("leaves", "low", LEAF_LEVELS)
    top, roots = _merkle_tree("subroots", "top", TOP_LEVELS)
    ways, last = _merkle_steps("begun", "low", "leaves", LEAF_LEVELS)
    more, last = _merkle_steps(last, "top", "subroots", TOP_LEVELS) if TOP_LEVELS else ([], last)
    steps = [f"low_{{}}{i}" for i in range(1, LEAF_LEVELS + 1)] + [f"top_{{}}{i}" for i in range(1, TOP_LEVELS + 1)]
    proof = " || ".join(f"coalesce({s.format('l')}, '') || coalesce({s.format('r')}, '')" for s in steps)
    folds, value, table = [], "start", last
    for i, s in enumerate(steps):
        left, right = s.format("l"), s.format("r")
        folds.append(f"""
fold{i} AS (
  SELECT *, CASE WHEN {left} IS NULL THEN {value} ELSE sha256({left} || {value} || {right}) END AS v{i}
  FROM {table}
)""")
        value, table = f"v{i}", f"fold{i}"
    parts = [
        CRC.strip(),
        f"""
hashed AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({plain}) AS digest,
    CASE WHEN {_crc("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN sha256({changed}) END AS changed
  FROM documents, crc_table
)""",
        """
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS position FROM hashed
)""",
        *up,
        f"""
subroots AS (
  SELECT '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS position, digest, tree AS source_tree
  FROM {subroots}
)""",
        *top,
        f"""
begun AS (
  SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, r.digest AS root, coalesce(l.changed, l.digest) AS start,
    l.tree AS low_tree, l.position AS low_position, '' AS top_tree, s.position AS top_position
  FROM leaves l JOIN subroots s ON s.source_tree = l.tree, {roots} r
)""",
        *ways,
        *more,
        *folds,
    ]
    return "WITH " + ",".join(parts) + f"""
SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, {value} AS folded_root,
  {value} = root AS verified
FROM {table}
"""


SQL = {
    "op1_mixing": OP1,
    "op3_line_dedup": OP3,
    "op6_exact_dedup": OP6,
    "op7_substring_dedup": OP7,
    "op8_quality_rules": OP8,
    "op11_importance_resampling": OP11,
    "op12_merkle_manifest": _op12(),
}
