"""Independent SQL text (DuckDB dialect) for the value check of each query.

Each oracle is one statement over the driver's raw views; canonical tables are
rebuilt as CTEs from the same definitions as ``sources.tables``.
"""

from __future__ import annotations

from recsift.functions.text import english_stop_words

CTES: dict[str, str] = {
    "interactions": """
        SELECT o_custkey AS user_id, l_partkey AS item_id,
               CAST(ceil(avg(l_quantity) / 5.0) / 2.0 AS DOUBLE) AS rating, max(o_orderdate) AS ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey""",
    "items_raw": """
        SELECT p_partkey AS item_id,
               CASE WHEN p_partkey % 7 = 0 THEN p_name
                    ELSE concat(p_name, ' (', CAST(1970 + p_size AS VARCHAR), ')') END AS title,
               concat(p_type, '|', replace(p_brand, '#', '')) AS genres_raw FROM part""",
    "items": r"""
        SELECT item_id, title, string_split(genres_raw, '|') AS genres,
               CASE WHEN regexp_matches(title, '.*\((\d{4})\)$')
                    THEN CAST(regexp_extract(title, '.*\((\d{4})\)$', 1) AS INTEGER) END AS year
        FROM items_raw""",
    "tags": """
        SELECT o_custkey AS user_id, l_partkey AS item_id, lower(o_orderpriority) AS tag, o_orderdate AS ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND l_quantity > 45""",
    "tag_scores": """
        SELECT l_partkey AS item_id, l_suppkey AS tag_id, round(avg(l_discount) * 10, 6) AS relevance
        FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "tag_names": "SELECT s_suppkey AS tag_id, replace(s_name, '#', '') AS tag FROM supplier",
    "split": """
        SELECT user_id, item_id, rating, ts,
               CASE WHEN ((user_id * 7919 + item_id * 104729) % 1000003) % 10 < 8 THEN 'train' ELSE 'test' END AS split
        FROM interactions""",
    "gappy": """
        SELECT user_id, item_id, CASE WHEN (user_id + item_id) % 10 = 0 THEN NULL ELSE rating END AS rating, ts
        FROM interactions""",
    "train": "SELECT user_id, item_id, rating FROM split WHERE split = 'train'",
    "test": "SELECT user_id, item_id, rating FROM split WHERE split = 'test'",
    # ---- content model (T1-T6): tokenise the concatenated documents, term self-join
    "doc_tags": """
        SELECT item_id, string_agg(tag, ' ' ORDER BY tag) AS tag_text FROM tags
        WHERE tag IS NOT NULL GROUP BY item_id""",
    "doc_genome": """
        SELECT s.item_id, string_agg(coalesce(n.tag, ''), ' ' ORDER BY coalesce(n.tag, '')) AS genome_text
        FROM tag_scores s LEFT JOIN tag_names n ON s.tag_id = n.tag_id WHERE s.relevance > 0.5
        GROUP BY s.item_id""",
    "doc": """
        SELECT i.item_id, concat_ws(' ', i.title, array_to_string(i.genres, ' '), coalesce(t.tag_text, ''),
                                    coalesce(g.genome_text, '')) AS document
        FROM items i LEFT JOIN doc_tags t ON i.item_id = t.item_id LEFT JOIN doc_genome g ON i.item_id = g.item_id""",
    "doc_simple": """
        SELECT item_id, concat_ws(' ', title, array_to_string(genres, ' ')) AS document FROM items""",
    "stop_words": "__STOP_WORDS__",
    "toks": r"""
        SELECT item_id, term, count(*) AS tf FROM (
            SELECT item_id, unnest(regexp_extract_all(lower(document), '[\p{L}\p{N}_]{2,}')) AS term FROM doc)
        WHERE term NOT IN (SELECT term FROM stop_words) GROUP BY item_id, term""",
    "vocab": """
        SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf_total,
               ln((1.0 + (SELECT count(*) FROM items)) / (1.0 + count(*))) + 1 AS idf
        FROM toks GROUP BY term ORDER BY tf_total DESC, term LIMIT 5000""",
    "vec": """
        SELECT item_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS weight FROM (
            SELECT t.item_id, t.term, t.tf, t.tf * v.idf AS w FROM toks t JOIN vocab v ON t.term = v.term)""",
    "neighbours": """
        SELECT seed_id, item_id, similarity, CAST(rank AS INTEGER) AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY similarity DESC, item_id) AS rank FROM (
                SELECT a.item_id AS seed_id, b.item_id AS item_id, round(sum(a.weight * b.weight), 9) AS similarity
                FROM vec a JOIN vec b ON a.term = b.term AND a.item_id <> b.item_id
                GROUP BY a.item_id, b.item_id) WHERE similarity > 0)
        WHERE rank <= 10""",
    "user_top": """
        SELECT user_id, item_id, rating FROM (
            SELECT user_id, item_id, rating,
                   row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rn
            FROM interactions) WHERE rn = 1""",
}

DEPS: dict[str, list[str]] = {
    "items": ["items_raw"],
    "split": ["interactions"],
    "gappy": ["interactions"],
    "train": ["split"],
    "test": ["split"],
    "doc_tags": ["tags"],
    "doc_genome": ["tag_scores", "tag_names"],
    "doc": ["items", "doc_tags", "doc_genome"],
    "doc_simple": ["items"],
    "toks": ["doc", "stop_words"],
    "vocab": ["toks", "items"],
    "vec": ["toks", "vocab"],
    "neighbours": ["vec"],
    "user_top": ["interactions"],
    "toks_simple": ["doc_simple", "stop_words"],
    "vocab_simple": ["toks_simple", "items"],
}

CTES["toks_simple"] = CTES["toks"].replace("FROM doc)", "FROM doc_simple)")
CTES["vocab_simple"] = CTES["vocab"].replace("FROM toks ", "FROM toks_simple ").replace("LIMIT 5000", "LIMIT 1000")


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in DEPS.get(n, []):
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def _cte(name: str) -> str:
    return stop_words_values() if name == "stop_words" else CTES[name]


def with_tables(body: str, *needs: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` clause holding the canonical tables ``needs`` (+ extra CTEs)."""
    parts = [f"{n} AS ({_cte(n)})" for n in _order(needs)]
    parts += [f"{n} AS ({q})" for n, q in (extra or [])]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


def stop_words_values() -> str:
    """The stop-word list as an inline VALUES table ``stop_words(term)``."""
    rows = ", ".join("('" + w.replace("'", "''") + "')" for w in english_stop_words())
    return f"SELECT * FROM (VALUES {rows}) AS v(term)"
