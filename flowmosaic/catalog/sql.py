"""Common table expressions of the SQL side."""

from __future__ import annotations

_CTES = {
    "cells": (
        (),
        """SELECT strftime(ts, '%Y%m%d') AS date, CAST(extract(day FROM ts) AS INTEGER) AS dom,
        CAST(floor((extract(hour FROM ts) * 60 + extract(minute FROM ts)) / 30) AS INTEGER) + 1 AS slot,
        CAST(floor((user_id % 16) / 4) AS INTEGER) AS grid_row, CAST(user_id % 4 AS INTEGER) AS grid_col,
        CASE WHEN event_type IN ('click', 'view', 'signup') THEN value ELSE 0 END AS inflow,
        CASE WHEN event_type IN ('purchase', 'error') THEN value ELSE 0 END AS outflow,
        event_type FROM events""",
    ),
    "flow": (
        ("cells",),
        """SELECT date, slot, grid_row, grid_col, SUM(inflow) AS inflow, SUM(outflow) AS outflow
        FROM cells GROUP BY date, slot, grid_row, grid_col""",
    ),
    "complete": (
        ("flow",),
        """SELECT date FROM flow GROUP BY date
        HAVING count(DISTINCT slot) = 48 AND min(slot) >= 1 AND max(slot) <= 48""",
    ),
    "weather": (
        ("cells",),
        """SELECT date, slot, CAST((dom * 7 + slot * 3) % 400 - 100 AS DOUBLE) AS temperature,
        CAST((dom * 5 + slot) % 120 AS DOUBLE) AS windspeed,
        CAST((dom * 48 + slot) % 17 AS INTEGER) AS weather_code
        FROM (SELECT DISTINCT date, dom, slot FROM cells WHERE event_type = 'purchase') r""",
    ),
    "days": (
        ("complete",),
        """SELECT date, CASE WHEN isodow(strptime(date, '%Y%m%d')) >= 6 THEN 1 ELSE 0 END AS label
        FROM complete""",
    ),
    # Dense day tensor in long form, unit scale.
    "tensor": (
        ("flow", "days"),
        """SELECT d.date, d.label, r.v AS grid_row, c.v AS grid_col, s.v AS slot, h.v AS chan,
        CAST((r.v * 4 + c.v) * 96 + 2 * (s.v - 1) + h.v AS INTEGER) AS pos,
        coalesce(CASE WHEN h.v = 0 THEN f.inflow ELSE f.outflow END, 0) / 100 AS value
        FROM days d CROSS JOIN (SELECT unnest(range(4)) AS v) r CROSS JOIN (SELECT unnest(range(4)) AS v) c
        CROSS JOIN (SELECT unnest(range(1, 49)) AS v) s CROSS JOIN (SELECT unnest(range(2)) AS v) h
        LEFT JOIN flow f ON f.date = d.date AND f.slot = s.v AND f.grid_row = r.v AND f.grid_col = c.v""",
    ),
    # Weather of the day's first flow slot that has a reading, as 19 long rows, unit scale.
    "others": (
        ("flow", "weather", "days"),
        """SELECT w.date, CAST(i.v AS INTEGER) AS i,
        CASE i.v WHEN 0 THEN temperature / 10 WHEN 1 THEN windspeed / 10
             ELSE CAST(weather_code = i.v - 2 AS DOUBLE) END AS value
        FROM (SELECT w.date, w.slot, temperature, windspeed, weather_code,
                     row_number() OVER (PARTITION BY w.date ORDER BY w.slot) AS nth
              FROM weather w SEMI JOIN flow f ON f.date = w.date AND f.slot = w.slot) w
        JOIN days USING (date) CROSS JOIN (SELECT unnest(range(19)) AS v) i WHERE nth = 1""",
    ),
    "batches": (
        (),
        "SELECT unnest(range(5)) AS batch, unnest([20.0, 10.0, 10.0, 10.0, 10.0]::DOUBLE[]) AS lim",
    ),
    "vec": (
        (),
        """SELECT vec_id, CAST(label >= 5 AS INTEGER) AS label, CAST(embedding AS DOUBLE[]) AS features
        FROM embeddings""",
    ),
    "vec_long": (
        ("vec",),
        """SELECT vec_id, label, CAST(i AS INTEGER) AS i, features[i + 1] AS x
        FROM (SELECT vec_id, label, features, unnest(range(len(features))) AS i FROM vec) v""",
    ),
    "pred": (
        (),
        """SELECT doc_id, CAST(n_chars AS DOUBLE) AS score,
        CASE WHEN n_chars > 1000 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
        CAST(quality AS DOUBLE) AS label FROM documents JOIN labels USING (doc_id)""",
    ),
    "counts": (
        ("pred",),
        """SELECT count(*) FILTER (WHERE prediction = 1 AND label = 1) AS tp,
        count(*) FILTER (WHERE prediction = 1 AND label = 0) AS fp,
        count(*) FILTER (WHERE prediction = 0 AND label = 0) AS tn,
        count(*) FILTER (WHERE prediction = 0 AND label = 1) AS fn FROM pred""",
    ),
    "stats": (
        ("vec_long",),
        "SELECT i, avg(x) AS mean, stddev_samp(x) AS std FROM vec_long GROUP BY i",
    ),
}


def with_ctes(names: str, body: str, extra: str = "") -> str:
    """``WITH RECURSIVE`` the named expressions and everything they need, ``extra`` ones, then ``body``."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for inner in _CTES[name][0]:
            need(inner)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        need(name)
    parts = [f"{name} AS (\n        {_CTES[name][1]})" for name in ordered]
    if extra:
        parts.append(extra)
    return "WITH RECURSIVE " + ",\n".join(parts) + f"\n{body}"


def uniform_sql(purpose: str, *key: str, seed: int = 7, word: int = 0) -> str:
    """Keyed uniform draw of one md5 word."""
    parts = ", ".join([f"'{seed}'", f"'{purpose}'", *key])
    return (
        f"(CAST('0x' || substr(md5(concat_ws('|', {parts})), {word * 8 + 1}, 8) AS BIGINT)"
        " / CAST(4294967296 AS DOUBLE))"
    )


def fine_uniform_sql(purpose: str, *key: str, seed: int = 7) -> str:
    """Keyed uniform draw of 52 bits."""
    parts = ", ".join([f"'{seed}'", f"'{purpose}'", *key])
    return (
        f"(CAST('0x' || substr(md5(concat_ws('|', {parts})), 1, 13) AS BIGINT)"
        " / CAST(4503599627370496 AS DOUBLE))"
    )


def jitter_sql(u: str, lim: str) -> str:
    return f"(1 + (2 * {u} - 1) * {lim} / 100)"


# Needs tensor and batches: every generated batch of every day in long form.
JITTERED = f"""jittered AS (SELECT date, label, batch, pos, value * CASE WHEN chan = 0
        THEN {jitter_sql(uniform_sql('flow', 'date', 'batch', 'pos // 2'), 'lim')}
        ELSE {jitter_sql(uniform_sql('flow', 'date', 'batch', 'pos // 2', word=1), 'lim')} END AS value
        FROM tensor CROSS JOIN batches)"""
# Needs others and batches.
JITTERED_OTHERS = f"""jittered_others AS (SELECT date, batch, i,
        value * {jitter_sql(uniform_sql('others', 'date', 'batch', 'i'), 'lim')} AS value
        FROM others CROSS JOIN batches)"""


def weight_sql(i: str, j: str) -> str:
    return f"((({i} * 7 + {j} * 13) % 11 - 5) / CAST(10 AS DOUBLE))"


def descent_sql(
    points: str, width: int, l2: float, out: str, steps: int = 120, rate: float = 3.0, momentum: float = 0.0,
    logistic: bool = True,
) -> str:
    """CTEs ``{out}_fit``/``{out}``: logistic (or linear) regression through the origin by gradient descent.

    ``points`` has (id, y, f LIST). On the test vectors the objective is well conditioned (Hessian
    between 0.07 and 0.5), so 120 plain steps reach machine precision; where it is not, a smaller
    rate and (Nesterov's) momentum get there in some hundred steps.
    """
    score = "list_inner_product(ahead, f)"
    expected = f"1 / (1 + exp(-{score}))" if logistic else score
    return f"""{out}_fit(it, w, ahead) AS (
        SELECT 0, CAST(list_transform(range({width}), lambda k: 0.0) AS DOUBLE[]),
                  CAST(list_transform(range({width}), lambda k: 0.0) AS DOUBLE[])
        UNION ALL
        SELECT it + 1, list(next ORDER BY k), list(next + {momentum} * (next - wk) ORDER BY k) FROM (
            SELECT it, k, any_value(w[k + 1]) AS wk,
                   any_value(ahead[k + 1]) - {rate} * (avg(miss * f[k + 1]) + {l2} * any_value(ahead[k + 1])) AS next
            FROM (
                SELECT it, w, ahead, f, {expected} - y AS miss
                FROM {out}_fit CROSS JOIN {points} WHERE it < {steps}) r
            CROSS JOIN (SELECT unnest(range({width})) AS k) ks GROUP BY it, k) g GROUP BY it),
    {out} AS (SELECT w FROM {out}_fit WHERE it = {steps})"""


def components_sql(covariance: str, k: int, out: str, doublings: int = 13) -> str:
    """CTEs ending in ``{out}`` (c, i, v, eigenvalue): leading eigenvectors of ``covariance`` (i, j, v).

    A matrix squared 13 times is its 8192nd power, in which the leading direction is all that is
    left; its column of largest diagonal is the eigenvector, signed so that the entry of largest
    size is positive. Each component found is subtracted before the next.
    """
    parts = []
    source = covariance
    for c in range(k):
        power = source
        for t in range(doublings):
            parts.append(f"""{out}_m{c}_{t} AS MATERIALIZED (SELECT i, j, v / sum(v) FILTER (WHERE i = j) OVER () AS v
        FROM (SELECT a.i AS i, b.j AS j, sum(a.v * b.v) AS v FROM {power} a JOIN {power} b ON a.j = b.i
              GROUP BY a.i, b.j) s)""")
            power = f"{out}_m{c}_{t}"
        parts.append(f"""{out}_v{c} AS MATERIALIZED (SELECT i, v / sqrt(sum(v * v) OVER ()) AS v FROM {power}
        WHERE j = (SELECT arg_max(i, v) FROM {power} WHERE i = j))""")
        parts.append(f"""{out}_e{c} AS MATERIALIZED (SELECT sum(a.v * m.v * b.v) AS e FROM {source} m
        JOIN {out}_v{c} a ON a.i = m.i JOIN {out}_v{c} b ON b.i = m.j)""")
        parts.append(f"""{out}_d{c} AS MATERIALIZED (SELECT m.i, m.j, m.v - e * a.v * b.v AS v FROM {source} m
        JOIN {out}_v{c} a ON a.i = m.i JOIN {out}_v{c} b ON b.i = m.j CROSS JOIN {out}_e{c})""")
        source = f"{out}_d{c}"
    union = " UNION ALL ".join(
        f"SELECT {c} AS c, i, v, e AS eigenvalue FROM {out}_v{c} CROSS JOIN {out}_e{c}" for c in range(k)
    )
    return ",\n".join([*parts, f"{out} AS ({union})"])
