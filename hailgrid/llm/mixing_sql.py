"""DuckDB SQL for the rows of ``mixing.choose``."""

from __future__ import annotations


def _cases(weights: dict[str, int], path: str, own: str) -> str:
    cases = [f"WHEN {path} = '{k}' THEN {v}" for k, v in weights.items()]
    cases += [f"WHEN {own} = '{k}' THEN {v}" for k, v in weights.items()]
    return f"CASE {' '.join(cases)} ELSE 1 END" if cases else "1"


def choose_sql(
    table: str, keys: list[tuple[str, str]], tokens: str, weights: dict[str, int], fraction: tuple[int, int],
    max_epochs: int, seed: int, out: str,
) -> str:
    """``keys``: names and expressions of the levels; ``out``: what to return of each row taken."""
    names = [k for k, _ in keys]
    leaf = ", ".join(names)
    steps = [
        "rows_ AS (SELECT *, " + ", ".join(f"coalesce({e}, '(none)') AS k_{k}" for k, e in keys)
        + f", greatest(coalesce({tokens}, 0), 0) AS t_ FROM {table})",
        "leaves AS (SELECT " + ", ".join(f"k_{k} AS {k}" for k in names)
        + f", sum(t_)::HUGEINT AS available, sum(t_)::HUGEINT * {max_epochs} AS most FROM rows_ GROUP BY ALL)",
    ]
    for depth in range(1, len(names) + 1):
        path, parent = names[:depth], names[: depth - 1]
        part = f"PARTITION BY {', '.join(parent)}" if parent else ""
        weight = _cases(weights, "concat_ws('/', " + ", ".join(path) + ")", path[-1])
        given = (
            f"JOIN level{depth - 1} USING ({', '.join(parent)})" if parent
            else f"CROSS JOIN (SELECT coalesce(sum(available), 0) * {fraction[0]} // {fraction[1]} AS take FROM leaves)"
        )
        steps.append(f"""level{depth} AS (
            WITH nodes AS (SELECT {', '.join(path)}, sum(most)::HUGEINT AS most FROM leaves GROUP BY ALL),
            a AS (SELECT nodes.*, take::HUGEINT AS given, ({weight})::HUGEINT AS w FROM nodes {given}),
            b AS (SELECT *, CASE WHEN w > 0 THEN most::DOUBLE / w::DOUBLE END AS ratio FROM a),
            c AS (SELECT *,
                coalesce(sum(most) OVER ({part} ORDER BY ratio NULLS LAST, {path[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_,
                sum(w) OVER ({part} ORDER BY ratio NULLS LAST, {path[-1]} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS onward FROM b),
            d AS (SELECT *, w > 0 AND most * onward <= (given - before_) * w AS full_ FROM c),
            e AS (SELECT *, coalesce(sum(CASE WHEN full_ THEN most END) OVER ({part}), 0) AS spent,
                coalesce(sum(CASE WHEN NOT full_ THEN w END) OVER ({part}), 0) AS open_ FROM d),
            f AS (SELECT *, CASE WHEN full_ THEN most WHEN open_ = 0 OR w = 0 THEN 0
                ELSE ((given - spent) * w)::HUGEINT // open_::HUGEINT END AS share FROM e),
            g AS (SELECT *, given - sum(share) OVER ({part}) AS rest_,
                sum(CASE WHEN NOT full_ AND w > 0 THEN 1 ELSE 0 END)
                OVER ({part} ORDER BY {path[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS place FROM f)
            SELECT {', '.join(path)}, share + CASE WHEN NOT full_ AND w > 0 AND place <= rest_ THEN 1 ELSE 0 END AS take FROM g)""")
    steps.append(f"""takes AS (SELECT {leaf},
            CASE WHEN available > 0 THEN take // available ELSE 0 END AS whole,
            CASE WHEN available > 0 THEN take % available ELSE 0 END AS rest
        FROM level{len(names)} JOIN leaves USING ({leaf}))""")
    match = " AND ".join(f"k_{k} = takes.{k}" for k in names)
    steps.append(f"""placed AS (SELECT rows_.*, whole, rest, sum(t_) OVER (
            PARTITION BY {', '.join('k_' + k for k in names)}
            ORDER BY md5(concat_ws('|', '{seed}', whole + 1, coalesce(doc_id::VARCHAR, ''))), doc_id, t_
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_
        FROM rows_ JOIN takes ON {match})""")
    return f"""WITH {', '.join(steps)},
        chosen AS (SELECT *, (whole + CASE WHEN rest > 0 AND run_ <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM placed)
        SELECT {out} FROM chosen WHERE copies > 0"""
