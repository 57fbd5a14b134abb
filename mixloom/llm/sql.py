"""The queries in SQL (DuckDB) where SQL can state them."""

from mixloom.llm.urls import LINK, MASS

# On these pages no link leaves its host, so ranks stand still after two rounds; SQL makes a few more.
ROUNDS = 12

_ESCAPED = (
    "(length({0}) + length({0}) - length(replace({0}, chr(92), ''))"
    " + (length({0}) - length(replace({0}, '<s>', ''))) // 3 + (length({0}) - length(replace({0}, '</s>', ''))) // 4"
    " + (length({0}) - length(replace({0}, '[INST]', ''))) // 6"
    " + (length({0}) - length(replace({0}, '[/INST]', ''))) // 7)"
)

CHATS = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce("text", '') AS said FROM conversations
    UNION ALL
    SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || said || chr(10), '' ORDER BY turn NULLS FIRST, role, said)) AS turns_sha256,
       CAST(coalesce(sum(length(said)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(said, '' ORDER BY turn NULLS FIRST, role, said) FILTER (role = 'assistant'), ''))
           AS loss_sha256,
       CAST(sum({_ESCAPED.format("role")} + length(role) - length(replace(role, chr(10), '')) + 1
                + {_ESCAPED.format("said")} + CASE WHEN role = 'assistant' THEN 9 ELSE 15 END) AS BIGINT)
           AS formatted_chars
FROM turns GROUP BY conv_id"""


def url_filter(iterations: int = ROUNDS) -> str:
    """Every round of the propagation is one step of the statement."""
    link = LINK.replace("'", "''")
    steps = [
        """parsed AS (
    SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages)""",
        """judged AS (
    SELECT page_id, html, host, path, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
    FROM parsed)""",
        """ruled AS (
    SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'trust' WHEN rule IS NOT NULL THEN 'distrust' END AS kind
    FROM judged)""",
        f"""linked AS (
    SELECT host AS src, translate(unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM ruled)""",
        "edges AS (SELECT src, dst, count(*) AS weight FROM linked WHERE src <> dst AND src <> '' GROUP BY 1, 2)",
        """both_ways AS (
    SELECT 'trust' AS kind, src, dst, weight FROM edges
    UNION ALL SELECT 'distrust', dst, src, weight FROM edges)""",
        """ways AS (
    SELECT kind, src, dst, weight::DOUBLE / CAST(sum(weight) OVER (PARTITION BY kind, src) AS DOUBLE) AS share
    FROM both_ways)""",
        "seeded AS (SELECT kind, host, count(*) AS n FROM ruled WHERE kind IS NOT NULL GROUP BY 1, 2)",
        f"""base AS (
    SELECT kind, host, CAST(floor({MASS}::DOUBLE * (n::DOUBLE / CAST(sum(n) OVER (PARTITION BY kind) AS DOUBLE)))
               AS BIGINT) AS seed FROM seeded)""",
        "rank0 AS (SELECT kind, host, seed AS rank FROM base)",
    ]
    for n in range(1, iterations + 1):
        steps.append(f"""rank{n} AS (
    SELECT kind, host, CAST(sum(part) AS BIGINT) AS rank FROM (
        SELECT kind, host, CAST(floor(seed * (1::DOUBLE - 0.85::DOUBLE)) AS BIGINT) AS part FROM base
        UNION ALL
        SELECT kind, dst, CAST(floor(CAST(sum(CAST(floor(rank * share) AS BIGINT)) AS BIGINT) * 0.85::DOUBLE) AS BIGINT)
        FROM (SELECT w.kind, w.dst, r.rank, w.share FROM ways w JOIN rank{n - 1} r ON w.kind = r.kind AND w.src = r.host)
        GROUP BY kind, dst)
    GROUP BY kind, host)""")
    steps.append(f"""parts AS (
    SELECT kind, host, CAST(floor(rank::DOUBLE * ({MASS}::DOUBLE / CAST(sum(rank) OVER (PARTITION BY kind) AS DOUBLE)))
               AS BIGINT) AS rank FROM rank{iterations})""")
    steps.append("""hosts AS (
    SELECT host, CAST(coalesce(sum(rank) FILTER (kind = 'trust'), 0) AS BIGINT) AS trust,
           CAST(coalesce(sum(rank) FILTER (kind = 'distrust'), 0) AS BIGINT) AS distrust
    FROM parts GROUP BY host)""")
    return "WITH " + ",\n".join(steps) + """
SELECT p.page_id, p.host, p.path, p.rule,
       CASE WHEN p.kind = 'trust' THEN 'allow' WHEN p.kind = 'distrust' THEN 'block'
            WHEN coalesce(h.distrust, 0) > coalesce(h.trust, 0) THEN 'block' ELSE 'allow' END AS verdict,
       coalesce(h.trust, 0) AS trust, coalesce(h.distrust, 0) AS distrust
FROM ruled p LEFT JOIN hosts h ON p.host = h.host"""


NEAREST = """
WITH whole AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
    FROM whole q JOIN whole d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5"""

NEGATIVES = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same,
           CAST(list_inner_product(a.v, d.v) AS BIGINT) AS score
    FROM whole a JOIN whole d ON a.vec_id <> d.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
    SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS rank
    FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
     AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 10"""

_CRC = (
    "xor(list_reduce([4294967295::BIGINT] || [ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')],"
    " lambda crc, byte: list_reduce([xor(crc, byte)] || [0::BIGINT FOR i IN range(8)],"
    " lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)"
)

TRIE = f"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce("text", '') AS said FROM conversations
    WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list(role || chr(10) || said ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || said)) AS turns
    FROM given GROUP BY conv_id
), headed AS (
    SELECT conv_id, turns, conv_id - conv_id % 100 AS base, CAST({_CRC} % 6 AS BIGINT) AS heads FROM own
), rebuilt AS (
    SELECT h.conv_id, coalesce(b.turns, [])[1:h.heads] || h.turns[h.heads + 1:] AS turns
    FROM headed h LEFT JOIN own b ON h.base = b.conv_id
), sized AS (SELECT conv_id, turns, len(turns) AS n FROM rebuilt),
prefixes AS (
    SELECT conv_id, n, depth, CASE WHEN depth > 0 THEN turns[:depth] ELSE [] END AS path
    FROM (SELECT conv_id, turns, n, unnest(range(n + 1)) AS depth FROM sized)
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
    FROM prefixes GROUP BY path, depth
), children AS (
    SELECT path[:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), weighed AS (
    SELECT n.*, coalesce(c.n_children, 0) AS n_children,
           CASE WHEN n.depth = 0 THEN 0
                ELSE (n.n_convs - 1) * (length(n.path[n.depth]) - instr(n.path[n.depth], chr(10))) END AS saved
    FROM nodes n LEFT JOIN children c ON n.path = c.path
), above AS (
    SELECT CASE WHEN up > 0 THEN path[:up] ELSE [] END AS path, sum(saved) AS saved,
           count(*) FILTER (n_children = 0) AS n_leaves
    FROM (SELECT path, saved, n_children, unnest(range(depth + 1)) AS up FROM weighed) GROUP BY 1
)
SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, a.n_leaves,
       CAST(a.saved AS BIGINT) AS saved_tokens, w.ends_sha256
FROM weighed w JOIN above a ON w.path = a.path
LEFT JOIN nodes p ON w.depth > 0 AND p.path = w.path[:w.depth - 1]"""

QUERIES = {
    "op1_chat_formatting": CHATS,
    "op3_url_filters": url_filter(),
    "op5_exact_top_k": NEAREST,
    "op12_hard_negatives": NEGATIVES,
    "op13_conversation_prefix_trie": TRIE,
}
