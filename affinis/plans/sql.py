"""Shared common table expressions of the oracle queries, in DuckDB's dialect."""

from __future__ import annotations

ITEM = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

CTES: dict[str, str] = {
    "pref_events": f"""
        SELECT event_id, ts, user_id, event_type, {ITEM} AS item_id,
               5e-1 * (1 + event_id % 10) AS rating FROM events""",
    "ratings": """
        SELECT user_id, item_id, rating FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, event_id DESC) AS rn
          FROM pref_events) WHERE rn = 1""",
    "train": "SELECT * FROM ratings WHERE substr(md5(user_id || ':' || item_id), 1, 8) < 'b3333333'",
    "heldout": "SELECT * FROM ratings WHERE NOT substr(md5(user_id || ':' || item_id), 1, 8) < 'b3333333'",
    "means": "SELECT user_id, avg(rating) AS mean_rating FROM ratings GROUP BY 1",
    "centred": """
        SELECT r.user_id, r.item_id, r.rating, m.mean_rating, r.rating - m.mean_rating AS cr
        FROM ratings r JOIN means m USING (user_id)""",
    "item_sizes": "SELECT item_id AS id, count(*) AS n FROM ratings GROUP BY 1",
    "user_sizes": "SELECT user_id AS id, count(*) AS n FROM ratings GROUP BY 1",
    "item_pairs": """
        SELECT a.item_id AS a, b.item_id AS b, count(*) AS n,
               sum(a.rating) AS sa, sum(b.rating) AS sb, sum(a.rating * a.rating) AS saa,
               sum(b.rating * b.rating) AS sbb, sum(a.rating * b.rating) AS sab
        FROM ratings a JOIN ratings b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1, 2""",
    "user_pairs": """
        SELECT a.user_id AS a, b.user_id AS b, count(*) AS n,
               sum(a.rating) AS sa, sum(b.rating) AS sb, sum(a.rating * a.rating) AS saa,
               sum(b.rating * b.rating) AS sbb, sum(a.rating * b.rating) AS sab
        FROM ratings a JOIN ratings b ON a.item_id = b.item_id AND a.user_id < b.user_id GROUP BY 1, 2""",
    "item_stats": """
        SELECT p.*, x.n AS n_a, y.n AS n_b, (SELECT count(DISTINCT user_id) FROM ratings) AS total
        FROM item_pairs p JOIN item_sizes x ON x.id = p.a JOIN item_sizes y ON y.id = p.b""",
    "user_stats": """
        SELECT p.*, x.n AS n_a, y.n AS n_b, (SELECT count(DISTINCT item_id) FROM ratings) AS total
        FROM user_pairs p JOIN user_sizes x ON x.id = p.a JOIN user_sizes y ON y.id = p.b""",
    "item_stats2": """
        SELECT a, b, n, sa, sb, saa, sbb, sab, n_a, n_b, total FROM item_stats UNION ALL
        SELECT b, a, n, sb, sa, sbb, saa, sab, n_b, n_a, total FROM item_stats""",
    "user_stats2": """
        SELECT a, b, n, sa, sb, saa, sbb, sab, n_a, n_b, total FROM user_stats UNION ALL
        SELECT b, a, n, sb, sa, sbb, saa, sab, n_b, n_a, total FROM user_stats""",
}

DEPENDS: dict[str, list[str]] = {
    "ratings": ["pref_events"],
    "train": ["ratings"], "heldout": ["ratings"], "means": ["ratings"], "centred": ["ratings", "means"],
    "item_sizes": ["ratings"], "user_sizes": ["ratings"], "item_pairs": ["ratings"], "user_pairs": ["ratings"],
    "item_stats": ["item_pairs", "item_sizes", "ratings"], "user_stats": ["user_pairs", "user_sizes", "ratings"],
    "item_stats2": ["item_stats"], "user_stats2": ["user_stats"],
}


def define(name: str, body: str, *needs: str) -> None:
    CTES[name] = body
    DEPENDS[name] = list(needs)


def with_(needs: list[str], query: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """The query behind the named expressions and everything they rest on, then ``extra``."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in DEPENDS.get(name, []):
            visit(need)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    parts = [f"{name} AS ({CTES[name].strip()})" for name in order]
    parts += [f"{name} AS ({body.strip()})" for name, body in (extra or {}).items()]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ",\n".join(parts) + "\n" if parts else "") + query.strip()


def xlogx(x: str) -> str:
    return f"(CASE WHEN ({x}) > 0 THEN ({x}) * ln(CAST(({x}) AS DOUBLE)) ELSE 0e0 END)"


def g2(k11: str, k12: str, k21: str, k22: str) -> str:
    """Dunning's G2 of four count expressions."""
    a, b, c, d = (f"({k})" for k in (k11, k12, k21, k22))
    matrix = f"{xlogx(a)} + {xlogx(b)} + {xlogx(c)} + {xlogx(d)}"
    total = xlogx(f"{a} + {b} + {c} + {d}")
    rows = f"{xlogx(f'{a} + {b}')} + {xlogx(f'{c} + {d}')}"
    columns = f"{xlogx(f'{a} + {c}')} + {xlogx(f'{b} + {d}')}"
    return f"greatest(0e0, 2e0 * ({matrix} + {total} - ({rows}) - ({columns})))"


def r6(x: str, name: str, digits: int = 6) -> str:
    return f"round(CAST({x} AS DOUBLE), {digits}) + 0e0 AS {name}"


PEARSON = (
    "CASE WHEN n * saa - sa * sa > 0 AND n * sbb - sb * sb > 0 THEN "
    "(n * sab - sa * sb) / (sqrt(n * saa - sa * sa) * sqrt(n * sbb - sb * sb)) END"
)
COSINE = "sab / nullif(sqrt(saa) * sqrt(sbb), 0)"


def weighted(score: str) -> str:
    w = "(1e0 - n / CAST(total + 1 AS DOUBLE))"
    return f"CASE WHEN ({score}) < 0 THEN -1e0 + {w} * (1e0 + ({score})) ELSE 1e0 - {w} * (1e0 - ({score})) END"


SCORES: dict[str, str] = {
    "assoc_basic": "n / CAST(n_a AS DOUBLE)",
    "assoc_advanced": (
        "CASE WHEN total = n_a THEN NULL WHEN n_b = n THEN CAST('Infinity' AS DOUBLE) "
        "ELSE n / CAST(n_a AS DOUBLE) * (total - n_a) / CAST(n_b - n AS DOUBLE) END"
    ),
    "pearson": PEARSON,
    "pearson_w": f"CASE WHEN ({PEARSON}) IS NOT NULL THEN {weighted(PEARSON)} END",
    "euclidean": "1e0 / (1e0 + sqrt(greatest(0e0, saa - 2 * sab + sbb)) / sqrt(CAST(n AS DOUBLE)))",
    "cosine": COSINE,
    "cosine_w": f"CASE WHEN ({COSINE}) IS NOT NULL THEN {weighted(COSINE)} END",
    "manhattan": "1e0 / (1e0 + CAST(n_a + n_b - 2 * n AS DOUBLE))",
    "tanimoto": "n / CAST(n_a + n_b - n AS DOUBLE)",
    "llr": f"1e0 - 1e0 / (1e0 + {g2('n', 'n_a - n', 'n_b - n', 'total - n_a - n_b + n')})",
}


def top(source: str, by: str, score: str, tie: str, k: int | str, columns: str) -> str:
    """``columns`` and ``rank`` of the best k rows per key."""
    return f"""
        SELECT {columns}, rank FROM (
          SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY round({score}, 9) DESC, {tie}) AS rank
          FROM {source} WHERE {score} IS NOT NULL) WHERE rank <= {k}"""
