"""DuckDB spellings of the selection operators (used as correctness oracles).

They state the semantics with windows and joins over the whole table, the
slow-but-obvious way, so they can check the distributed implementation.
"""

from __future__ import annotations

from ..functions.bits import sql_getbit, sql_keyed_hash, sql_random_masks, sql_seeded_hash
from ..operators.population import _dbl

EMBEDDINGS_BASE = "SELECT vec_id AS row_id, label, CAST(embedding AS DOUBLE[]) AS features FROM embeddings"


def population_sql(seed: int, population: int, base: str = EMBEDDINGS_BASE) -> str:
    masks = ", ".join(sql_random_masks(seed, population))
    return f"SELECT b.*, {masks} FROM ({base}) b"


def fitness_knn_sql(pop_sql: str, population: int, *, seed: int = 42, k: int = 5,
                    min_rows: int = 20, train_cap: int = 1000, alpha: float = 0.7, kept: str | None = None) -> str:
    """Fitness of every solution of the population table given by ``pop_sql``
    (columns row_id, label, features DOUBLE[], mask_0..). ``kept`` may give the rows that each solution keeps
    (solution, row_id, label, features)."""
    bit = " ".join(f"WHEN {s} THEN {sql_getbit(s, 'p')}" for s in range(population))
    h = sql_seeded_hash(seed, "split", "row_id")
    kept = kept or f"""SELECT s.solution, p.row_id, p.label, p.features
  FROM pop p JOIN (SELECT CAST(range AS INTEGER) AS solution FROM range(0, {population})) s ON (CASE s.solution {bit} END) = 1"""
    beta = round(1.0 - alpha, 12)
    return f"""
WITH pop AS ({pop_sql}),
tot AS (SELECT count(*) AS n FROM pop),
sel AS (
  SELECT *, {h} AS h FROM ({kept})),
cls AS (SELECT solution, label, count(*) AS c FROM sel GROUP BY solution, label),
agg AS (SELECT solution, sum(c) AS n_sel, count(*) AS ncls, min(c) AS minc
        FROM cls GROUP BY solution),
plan AS (
  SELECT s.solution, coalesce(a.n_sel, 0) AS n_sel, coalesce(a.ncls, 0) AS ncls, a.minc,
         least({train_cap}, (3 * coalesce(a.n_sel, 0)) // 4) AS t
  FROM (SELECT CAST(range AS INTEGER) AS solution FROM range(0, {population})) s
  LEFT JOIN agg a USING (solution)),
plan2 AS (
  SELECT *, (n_sel >= {min_rows} AND ncls >= 2 AND t >= 2) AS eligible,
         (minc >= 2 AND t >= ncls AND n_sel - t >= ncls) AS strat
  FROM plan),
alloc AS (
  SELECT c.solution, c.label, (p.t * c.c) // p.n_sel AS fl, (p.t * c.c) % p.n_sel AS rem, p.t
  FROM cls c JOIN plan2 p USING (solution) WHERE p.eligible AND p.strat),
alloc2 AS (
  SELECT solution, label,
         fl + CASE WHEN row_number() OVER (PARTITION BY solution ORDER BY rem DESC, label)
                        <= t - sum(fl) OVER (PARTITION BY solution) THEN 1 ELSE 0 END AS a
  FROM alloc),
ranked AS (
  SELECT s.solution, s.row_id, s.label, s.features,
         row_number() OVER (PARTITION BY s.solution, CASE WHEN p.strat THEN s.label END
                            ORDER BY s.h, s.row_id) AS rn,
         CASE WHEN p.strat THEN a.a ELSE p.t END AS lim
  FROM sel s JOIN plan2 p USING (solution)
  LEFT JOIN alloc2 a ON a.solution = s.solution AND a.label = s.label
  WHERE p.eligible),
train AS (SELECT solution, row_id, label, features FROM ranked WHERE rn <= lim),
nearest AS (
  SELECT q.solution, q.row_id AS qid, any_value(q.label) AS qlabel,
         unnest(min(struct_pack(dist := list_distance(q.features, t.features), id := t.row_id, label := t.label), {k})) AS x
  FROM sel q JOIN train t ON q.solution = t.solution GROUP BY q.solution, q.row_id),
votes AS (
  SELECT solution, qid, qlabel, x.label AS tlabel, count(*) AS v FROM nearest GROUP BY ALL),
pred AS (
  SELECT *, row_number() OVER (PARTITION BY solution, qid ORDER BY v DESC, tlabel) AS pr
  FROM votes),
acc AS (
  SELECT solution, CAST(sum(CASE WHEN tlabel = qlabel THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS accuracy
  FROM pred WHERE pr = 1 GROUP BY solution)
SELECT p.solution AS solution, CAST(p.n_sel AS BIGINT) AS n_selected,
       CASE WHEN p.eligible THEN round(coalesce(a.accuracy, 0.0), 6) END AS accuracy,
       round(CASE WHEN p.eligible
                  THEN {alpha} * coalesce(a.accuracy, 0.0) + {beta} * (1 - p.n_sel / tot.n)
                  ELSE 0.0 END, 6) AS fitness
FROM plan2 p CROSS JOIN tot LEFT JOIN acc a USING (solution)
"""


def fitness_table_sql(pop_sql: str, population: int, seed: int = 42, kept: str | None = None) -> str:
    """Unrounded fitness (for rankings inside other oracles)."""
    return fitness_knn_sql(pop_sql, population, seed=seed, kept=kept).replace(
        "CASE WHEN p.eligible THEN round(coalesce(a.accuracy, 0.0), 6) END AS accuracy",
        "CASE WHEN p.eligible THEN coalesce(a.accuracy, 0.0) END AS accuracy").replace(
        "round(CASE WHEN p.eligible", "(CASE WHEN p.eligible").replace(
        "ELSE 0.0 END, 6) AS fitness", "ELSE 0.0 END) AS fitness")


def next_population_sql(pop_sql: str, slots, population: int, seed: int, generation: int,
                        parent_sql: dict | None = None, parent_row: str = "") -> str:
    """Population built from ``slots``; ``parent_sql`` maps a solution id used in the slots to a
    column of the one-row table ``parent_row`` that holds the actual solution."""
    from ..functions.bits import WORD_BITS
    from ..operators.population import sql_slot_bit
    if population > WORD_BITS:
        raise ValueError("oracle supports one mask word")
    n = "n_rows"
    ps = parent_sql or {}
    bits = [sql_slot_bit(sl, n, seed, generation, "row_id", ps.get(sl.p0), ps.get(sl.p1))
            for sl in slots]
    packed = " | ".join(f"({b} << {i})" for i, b in enumerate(bits))
    return (f"SELECT row_id, label, features, CAST({packed} AS BIGINT) AS mask_0 "
            f"FROM (SELECT *, count(*) OVER () AS n_rows FROM ({pop_sql})){parent_row and ', ' + parent_row}")


def _search_sql(seed: int, population: int, generations: int, plans: list, parent_order: str, best_last: bool,
                base: str) -> str:
    """The CTEs of a search, one recursive step per generation: ``search`` (g, row_id, mask_0) and ``every``, the
    fitness of all solutions of all generations. ``plans`` hold the slots for the parents' ranks, in
    ``parent_order`` (with ``best_last`` the last ranks of the order)."""
    rows = []
    for g, plan in enumerate(plans):
        for i, sl in enumerate(plan):
            mu = sl.mutation
            k0, k1 = mu.keys() if mu else (0, 0)
            m = ("0" if mu is None else f"floor(n * {_dbl(mu.rate)})" if mu.rate is not None
                 else f"greatest(1, floor({_dbl(float(mu.percent))} * n / 100))")
            rows.append(f"({g}, {i}, '{sl.kind}', {sl.p0}, {max(sl.p1, 0)}, {_dbl(sl.u_cut)}, {max(sl.coin, 0)}, {k0}, {k1}, CAST({m} AS BIGINT))")
    coin = f"CAST(('0x' || substr(md5('{seed}:coin' || c.g || '.0:' || CAST(c.row_id AS VARCHAR)), 1, 15)) AS BIGINT)"
    place = f"row_number() OVER (ORDER BY {parent_order}) - 1" + (f" - {population - 1 - max(sl.p0 for p in plans for sl in p)}" if best_last else "")
    one = fitness_table_sql("SELECT row_id, b.label, b.features, p.mask_0 FROM now p JOIN base b USING (row_id)", population, seed)
    return f"""WITH RECURSIVE base AS MATERIALIZED ({base}),
n AS MATERIALIZED (SELECT count(*) AS n FROM base),
slots(g, i, kind, p0, p1, u_cut, coin, k0, k1, m) AS MATERIALIZED (SELECT t.* FROM n, LATERAL (VALUES {", ".join(rows)}) t),
steps AS (
  SELECT 0 AS g, row_id, mask_0, NULL::INTEGER AS solution, NULL::BIGINT AS n_selected, NULL::DOUBLE AS accuracy, NULL::DOUBLE AS fitness
  FROM ({population_sql(seed, population, 'SELECT * FROM base')})
  UNION ALL
  (WITH now AS MATERIALIZED (SELECT g, row_id, mask_0 FROM steps WHERE solution IS NULL),
  scored AS MATERIALIZED ({one}),
  r AS MATERIALIZED (SELECT list(solution ORDER BY place) AS parents FROM (SELECT solution, {place} AS place FROM scored) WHERE place >= 0)
  SELECT (SELECT max(g) FROM now) AS g, NULL, NULL, solution, n_selected, accuracy, fitness FROM scored WHERE (SELECT count(*) FROM now) > 0
  UNION ALL
  SELECT g + 1, row_id, CAST(sum((CASE WHEN place <= m THEN 1 - bit ELSE bit END) << i) AS BIGINT), NULL, NULL, NULL, NULL FROM (
    SELECT c.g, c.row_id, s.i, s.m,
           row_number() OVER (PARTITION BY s.i ORDER BY {sql_keyed_hash('c.row_id', 's.k0', 's.k1')}, c.row_id) AS place,
           (c.mask_0 >> CASE WHEN s.kind = 'copy' OR (s.kind = 'one_point' AND c.row_id < 1 + CAST(floor(s.u_cut * (n.n - 2)) AS BIGINT))
                                  OR (s.kind = 'uniform' AND ({coin} >> s.coin) & 1 = 0)
                             THEN r.parents[s.p0 + 1] ELSE r.parents[s.p1 + 1] END) & 1 AS bit
    FROM now c JOIN slots s ON s.g = c.g, n, r)
  GROUP BY g, row_id)),
search AS MATERIALIZED (SELECT g, row_id, mask_0 FROM steps WHERE solution IS NULL),
every AS MATERIALIZED (SELECT g AS generation, solution, n_selected, accuracy, fitness FROM steps WHERE solution IS NOT NULL)"""


ROWS_OF_BEST = """SELECT s.row_id, b.label FROM search s JOIN base b USING (row_id) JOIN best t ON s.g = t.generation
WHERE (s.mask_0 >> t.solution) & 1 = 1"""
FITNESS_OF_SEARCH = """
SELECT generation, solution, n_selected, round(accuracy, 6) AS accuracy, round(fitness, 6) AS fitness FROM every"""


def evolve_parallel_sql(seed: int, population: int, parents: int, rate: float, generations: int,
                        base: str = EMBEDDINGS_BASE) -> dict[str, str]:
    """Oracles of a parallel search of any length: the fitness of all solutions, the history, the best-ever
    solution (the first generation and the first index that reach the highest fitness) and its rows.
    The driver-side draws are replayed here."""
    import numpy as np

    from ..operators.population import parallel_plan
    rng = np.random.default_rng(seed)
    plans = [parallel_plan(rng, list(range(parents)), population, rate) for _ in range(generations - 1)]
    best = """,
best AS MATERIALIZED (SELECT generation, solution, fitness FROM every ORDER BY fitness DESC, generation, solution LIMIT 1)"""
    head = _search_sql(seed, population, generations, plans, "fitness, solution", True, base) + best
    rows = f"{head}\n{ROWS_OF_BEST}"
    history = head + """,
top AS (SELECT generation, max(fitness) AS best FROM every GROUP BY generation),
run AS (SELECT *, max(best) OVER (ORDER BY generation) AS best_so_far FROM top),
new AS (SELECT *, best_so_far > coalesce(lag(best_so_far) OVER (ORDER BY generation), -1) AS better FROM run)
SELECT generation, round(best, 6) AS best, round(best_so_far, 6) AS best_so_far,
       generation - max(CASE WHEN better THEN generation END) OVER (ORDER BY generation) AS stall FROM new"""
    of_generation = f"""{head}
SELECT generation, arg_max(solution, (fitness, -solution)) AS solution, max(fitness) AS fitness
FROM ({FITNESS_OF_SEARCH}) GROUP BY generation"""
    return {"search": head.removesuffix(best), "fitness": head + FITNESS_OF_SEARCH, "history": history, "rows": rows, "of_generation": of_generation,
            "best": f"{head}\nSELECT generation, solution, round(fitness, 6) AS fitness FROM best"}


def evolve_sequential_sql(seed: int, population: int, parents: int, rate: float,
                          generations: int, base: str = EMBEDDINGS_BASE) -> dict[str, str]:
    """Oracles of the sequential variant with 5-NN fitness: ``generations + 1``
    evaluated populations; one elite (the best parent), uniform children of
    parents (i, i+1) in descending fitness, at least one flipped gene; the
    chosen rows are those of the best solution of the last population."""
    import numpy as np

    from ..operators.population import steady_state_plan
    rng = np.random.default_rng(seed)
    plans = [steady_state_plan(rng, list(range(parents)), population, rate * 100) for _ in range(generations)]
    head = _search_sql(seed, population, generations + 1, plans, "fitness DESC, solution DESC", False, base)
    rows = head + f""",
best AS (SELECT generation, solution FROM every WHERE generation = {generations} ORDER BY fitness DESC, solution LIMIT 1)
{ROWS_OF_BEST}"""
    return {"search": head, "fitness": head + FITNESS_OF_SEARCH, "rows": rows}
