"""DuckDB SQL twins of the registered queries (same column names).

Tables are the pre-registered views named after the parquet files.
"""

from __future__ import annotations

from roundstats.plans.catalog import (
    CLUSTER_ITERS,
    CLUSTER_K,
    MR_ITERS,
    MR_K,
    MR_PARTS,
    N_CENTERS,
    PICK_AT,
    SEED,
    WORD_PARTS,
    WORD_SEED,
)


def java_split_sql(t: str) -> str:
    """Java ``split(" ")`` in DuckDB: trailing empties dropped, ``''`` kept."""
    return (f"CASE WHEN {t} = '' THEN ['']::VARCHAR[] "
            f"WHEN rtrim({t}, ' ') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim({t}, ' '), ' ') END")


def salt_sql(k: int, seed: int, *cols: str) -> str:
    parts = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return (f"CAST((('0x' || substr(md5(concat_ws(':', '{seed}', {parts})), 1, 15))::BIGINT"
            f" % {k}) AS INTEGER)")


_TOKENS = f"SELECT doc_id, unnest({java_split_sql('text')}) AS word FROM documents"

_NONNEG = ("SELECT c_custkey AS id, c_acctbal AS v FROM customer "
           "WHERE c_acctbal >= 0 AND NOT isnan(c_acctbal)")

_NORM = (f"WITH t AS ({_NONNEG}), s AS (SELECT min(v) lo, max(v) hi FROM t) "
         "SELECT id, v, (v - lo) / nullif(hi - lo, 0) AS nv FROM t, s")

_WORD_COUNT = f"SELECT word, count(*) AS n FROM ({_TOKENS}) GROUP BY word"

_STATS = "SELECT count(*) AS n_words, sum(length(word)) / count(*) AS avg_len FROM ({wc})"

_PART_LINES = ("SELECT p_partkey AS id, concat_ws(' ', CAST(p_size AS VARCHAR), p_name, "
               "CAST(p_retailprice AS VARCHAR)) AS line FROM part")

# Plain decimal numbers: the only numeric spellings in the part rows.
_DECIMAL_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

_LINES = (r"SELECT doc_id, unnest(CASE WHEN text = '' THEN []::VARCHAR[] ELSE "
          r"regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n') END)"
          r" AS text FROM documents")


ORACLE_SQL: dict[str, str] = {
    "nonneg_filter": _NONNEG,
    "parse_number_tokens": f"""
        WITH l AS ({_PART_LINES}),
        t AS (SELECT id, unnest(regexp_split_to_array(line, '\\s+')) AS tok,
                     unnest(range(0, len(regexp_split_to_array(line, '\\s+')))) AS pos0
              FROM l),
        k AS (SELECT id, tok, row_number() OVER (PARTITION BY id ORDER BY pos0) - 1 AS pos
              FROM t WHERE tok <> '')
        SELECT id, CAST(pos AS INTEGER) AS pos, CAST(tok AS DOUBLE) AS v FROM k
        WHERE regexp_matches(tok, '{_DECIMAL_RE}') AND CAST(tok AS DOUBLE) >= 0""",
    "parse_numbers_strict": """
        WITH l AS (SELECT l_orderkey * 100 + l_linenumber AS id,
                          [CAST(l_orderkey AS DOUBLE), CAST(l_linenumber AS DOUBLE), l_quantity, l_discount] AS xs
                   FROM lineitem)
        SELECT id, CAST(pos - 1 AS INTEGER) AS pos, xs[pos] AS v
        FROM (SELECT id, xs, unnest(range(1, 5)) AS pos FROM l)""",
    "squares": "SELECT c_custkey AS id, c_acctbal AS v, c_acctbal * c_acctbal AS sq FROM customer",
    "sum_of_squares": "SELECT sum(l_quantity * l_quantity) AS sum_sq FROM lineitem",
    "max_value": "SELECT max(c_acctbal) AS max_v FROM customer",
    "min_value": "SELECT min(c_acctbal) AS min_v FROM customer",
    "mean_value": "SELECT round(avg(c_acctbal), 6) AS mean_v FROM customer",
    "row_count": "SELECT count(*) AS n FROM lineitem",
    "max_by_key": ("SELECT c_custkey AS id, c_acctbal AS v FROM customer "
                   "ORDER BY c_acctbal DESC, c_custkey DESC LIMIT 1"),
    "min_by_key": ("SELECT c_custkey AS id, c_acctbal AS v FROM customer "
                   "ORDER BY c_acctbal ASC, c_custkey ASC LIMIT 1"),
    "minmax_normalize": _NORM,
    "sort_with_index": f"SELECT id, v, row_number() OVER (ORDER BY v, id) - 1 AS idx FROM ({_NONNEG})",
    "pick_at": (f"SELECT * FROM (SELECT id, v, row_number() OVER (ORDER BY v, id) - 1 AS idx "
                f"FROM ({_NONNEG})) WHERE idx = {PICK_AT}"),
    "lower_median": f"SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY nv) AS median FROM ({_NORM})",
    "lower_median_sorted": f"SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY nv) AS median FROM ({_NORM})",
    "lower_median_quantity": ("SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY l_quantity) AS median "
                              "FROM lineitem WHERE l_quantity IS NOT NULL"),
    "merge_means": ("SELECT round(sum(a * n) / sum(n), 6) AS avg, CAST(sum(n) AS BIGINT) AS n FROM "
                    "(SELECT avg(c_acctbal) AS a, count(*) AS n FROM customer GROUP BY c_nationkey)"),
    "number_report": f"""
        WITH v AS ({_NONNEG}),
        s AS (SELECT count(*) AS n, max(v) AS max_v, max(v) AS max_by_order, min(v) AS min_v,
                     avg(v) AS a FROM v),
        m AS (SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY v) AS med FROM v)
        SELECT n, max_v, max_by_order, min_v, (med - min_v) / nullif(max_v - min_v, 0) AS median_nv,
               round((a - min_v) / nullif(max_v - min_v, 0), 6) AS mean_nv FROM s, m""",
    "tokens": _TOKENS,
    "doc_word_counts": f"SELECT doc_id, word, count(*) AS c FROM ({_TOKENS}) GROUP BY doc_id, word",
    "word_count": _WORD_COUNT,
    "group_word_counts": (f"SELECT {salt_sql(WORD_PARTS, WORD_SEED, 'doc_id', 'word')} AS group_id, "
                          f"word, count(*) AS c FROM ({_TOKENS}) GROUP BY ALL"),
    "word_count_salted": _WORD_COUNT,
    "partition_word_counts": (f"SELECT CAST(((doc_id % {WORD_PARTS}) + {WORD_PARTS}) % {WORD_PARTS} AS INTEGER)"
                              f" AS part, word, count(*) AS c FROM ({_TOKENS}) GROUP BY ALL"),
    "word_count_by_part": _WORD_COUNT,
    "word_count_by_part_local": _WORD_COUNT,
    "distinct_words": f"SELECT DISTINCT word FROM ({_TOKENS})",
    "word_count_lines": (f"SELECT word, count(*) AS n FROM (SELECT unnest({java_split_sql('text')}) AS word "
                         f"FROM ({_LINES})) GROUP BY word"),
    "avg_word_length": _STATS.format(wc=_WORD_COUNT),
    "word_lengths": f"SELECT word, CAST(length(word) AS BIGINT) AS len FROM ({_WORD_COUNT})",
    "word_report": " UNION ALL ".join(
        f"SELECT '{m}' AS method, (SELECT count(*) FROM documents) AS n_docs, * "
        f"FROM ({_STATS.format(wc=_WORD_COUNT)})"
        for m in ("one_round", "random_keys", "by_partition")),
    "compare_word_counts": " UNION ALL ".join(
        f"SELECT '{m}' AS method, * FROM ({_STATS.format(wc=_WORD_COUNT)})"
        for m in ("one_round", "random_keys", "by_partition")),
}


# ------------------------------------------------------------- clustering --

UNIFORM_DIV = "CAST(4503599627370497 AS DOUBLE)"


def uniform_sql(seed: int, step: int, id_expr: str = "id") -> str:
    """The shared draw u(seed, step, id) in (0, 1]."""
    return (f"(CAST(('0x' || substr(md5(concat_ws(':', '{seed}', '{step}', CAST({id_expr} AS VARCHAR))),"
            f" 1, 13))::BIGINT + 1 AS DOUBLE) / {UNIFORM_DIV})")


def seeding_ctes(pfx: str, points: str, k: int, seed: int) -> tuple[list[str], str]:
    """CTEs choosing k seeds per part from ``points(part, id, v, w)``.
    Returns (ctes, name of the seeds CTE ``part, i, id, v``)."""
    ctes = [f"{pfx}s0 AS (SELECT part, 0 AS i, id, v FROM {points} "
            f"QUALIFY row_number() OVER (PARTITION BY part ORDER BY {uniform_sql(seed, 0)}, id) = 1)"]
    for t in range(1, k):
        chosen = " UNION ALL ".join(f"SELECT * FROM {pfx}s{j}" for j in range(t))
        ctes.append(f"{pfx}c{t} AS MATERIALIZED ({chosen})")
        ctes.append(
            f"{pfx}d{t} AS MATERIALIZED (SELECT p.part, p.id, any_value(p.v) AS v, any_value(p.w) AS w, "
            f"min(list_distance(p.v, c.v)) AS d FROM {points} p JOIN {pfx}c{t} c ON p.part = c.part "
            f"WHERE p.id NOT IN (SELECT id FROM {pfx}c{t}) GROUP BY p.part, p.id)")
        u = uniform_sql(seed, t)
        ctes.append(
            f"{pfx}s{t} AS MATERIALIZED (SELECT part, {t} AS i, id, v FROM {pfx}d{t} QUALIFY row_number() OVER "
            f"(PARTITION BY part ORDER BY (w * d > 0) DESC, "
            f"CASE WHEN w * d > 0 THEN -ln({u}) / (w * d) ELSE {u} END, id) = 1)")
    seeds = " UNION ALL ".join(f"SELECT * FROM {pfx}s{j}" for j in range(k))
    ctes.append(f"{pfx}seeds AS MATERIALIZED ({seeds})")
    return ctes, f"{pfx}seeds"


def assign_sql(points: str, centers: str, by_part: bool = True) -> str:
    """``part, id, v, w, i, d`` -- nearest center, first index on ties."""
    on = "p.part = c.part" if by_part else "TRUE"
    return (f"SELECT p.part, p.id, any_value(p.v) AS v, any_value(p.w) AS w, "
            f"arg_min(c.i, {{'d': list_distance(p.v, c.v), 'i': c.i}}) AS i, "
            f"min(list_distance(p.v, c.v)) AS d FROM {points} p JOIN {centers} c ON {on} "
            f"GROUP BY p.part, p.id")


def lloyd_ctes(pfx: str, points: str, start: str, iters: int) -> tuple[list[str], str]:
    """Weighted Lloyd rounds from centers ``start(part, i, v)``; an empty
    cluster keeps its center. Returns (ctes, final centers CTE)."""
    ctes = [f"{pfx}m0 AS MATERIALIZED (SELECT part, i, v FROM {start})"]
    for j in range(1, iters + 1):
        ctes.append(f"{pfx}a{j} AS MATERIALIZED ({assign_sql(points, f'{pfx}m{j - 1}')})")
        ctes.append(
            f"{pfx}x{j} AS (SELECT part, i, pos, sum(w * x) / sum(w) AS x FROM "
            f"(SELECT part, i, w, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM {pfx}a{j}) "
            f"GROUP BY part, i, pos)")
        ctes.append(f"{pfx}n{j} AS (SELECT part, i, list(x ORDER BY pos) AS v FROM {pfx}x{j} GROUP BY part, i)")
        ctes.append(
            f"{pfx}m{j} AS MATERIALIZED (SELECT c.part, c.i, coalesce(n.v, c.v) AS v FROM {pfx}m{j - 1} c "
            f"LEFT JOIN {pfx}n{j} n ON c.part = n.part AND c.i = n.i)")
    return ctes, f"{pfx}m{iters}"


def clustering_ctes(pfx: str, points: str, k: int, iters: int, seed: int) -> tuple[list[str], str]:
    s, seeds = seeding_ctes(pfx, points, k, seed)
    ll, final = lloyd_ctes(pfx, points, seeds, iters)
    return s + ll, final


def coreset_ctes(pfx: str, points: str, k: int, iters: int, seed: int) -> tuple[list[str], str]:
    """Round 1: ``part, i, id, v, w`` with w = points nearest to the center."""
    ctes, final = clustering_ctes(pfx, points, k, iters, seed)
    ctes.append(f"{pfx}fa AS MATERIALIZED ({assign_sql(points, final)})")
    ctes.append(
        f"{pfx}core AS MATERIALIZED (SELECT c.part, c.i, c.part * {k} + c.i AS id, any_value(c.v) AS v, "
        f"count(a.id) AS w FROM {final} c LEFT JOIN {pfx}fa a ON c.part = a.part AND c.i = a.i "
        f"GROUP BY c.part, c.i)")
    return ctes, f"{pfx}core"


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# Points of the clustering queries: part, id, v, w.
_PTS = "SELECT 0 AS part, vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, 1.0 AS w FROM embeddings"
_WPTS = ("SELECT 0 AS part, vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, CAST(label + 1 AS DOUBLE) AS w "
         "FROM embeddings")
_FIXED = f"SELECT 0 AS part, CAST(id AS INTEGER) AS i, v FROM pts WHERE id < {N_CENTERS}"


def _round_list(v: str, places: int = 6) -> str:
    return f"list_transform({v}, lambda x: round(x, {places}))"


def _cluster_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["parse_points"] = (
        "SELECT id, list_transform(string_split(line, ' '), lambda x: CAST(x AS DOUBLE)) AS v, "
        "CAST(1 AS BIGINT) AS w FROM (SELECT vec_id AS id, list_aggregate(list_transform("
        "CAST(embedding AS DOUBLE[]), lambda x: CAST(x AS VARCHAR)), 'string_agg', ' ') AS line FROM embeddings)")
    q["pair_distance"] = (
        f"WITH pts AS ({_PTS}) SELECT id, round(list_distance(v, (SELECT v FROM pts WHERE id = 0)), 9) AS d "
        f"FROM pts")
    base = [f"pts AS ({_PTS})", f"fc AS ({_FIXED})"]
    q["assign"] = with_ctes(base, "SELECT id, CAST(i AS INTEGER) AS center_id, round(d, 9) AS d FROM "
                                  "(" + assign_sql("pts", "fc") + ")")
    q["nearest_distance"] = with_ctes(base, "SELECT id, round(d, 9) AS d FROM (" + assign_sql("pts", "fc") + ")")
    q["cluster_weights"] = with_ctes(
        base + [f"a AS ({assign_sql('pts', 'fc')})"],
        "SELECT CAST(fc.i AS INTEGER) AS center_id, CAST(count(a.id) AS BIGINT) AS n FROM fc "
        "LEFT JOIN a ON fc.i = a.i GROUP BY fc.i")
    q["avg_distance"] = with_ctes(base, "SELECT round(avg(d), 6) AS objective FROM (" + assign_sql("pts", "fc") + ")")
    wbase = [f"pts AS ({_WPTS})", f"fc AS ({_FIXED})"]
    q["weighted_centroids"] = with_ctes(
        wbase + [f"a AS ({assign_sql('pts', 'fc')})",
                 "x AS (SELECT i, pos, sum(w) AS sw, sum(w * x) / sum(w) AS x FROM "
                 "(SELECT i, w, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a) GROUP BY i, pos)"],
        f"SELECT CAST(i AS INTEGER) AS center_id, max(sw) AS w, {_round_list('list(x ORDER BY pos)')} AS v "
        f"FROM x GROUP BY i")
    q["pick_uniform"] = (f"WITH pts AS ({_PTS}) SELECT id FROM pts "
                         f"ORDER BY {uniform_sql(SEED, 0)}, id LIMIT 1")
    q["pick_weighted"] = (f"WITH pts AS ({_WPTS}) SELECT id FROM pts WHERE w > 0 "
                          f"ORDER BY -ln({uniform_sql(SEED, 1)}) / w, id LIMIT 1")
    s2, seeds2 = seeding_ctes("u_", "pts", 2, SEED)
    q["update_nearest"] = with_ctes(
        [f"pts AS ({_PTS})"] + s2,
        f"SELECT p.id, round(min(list_distance(p.v, c.v)), 9) AS d, "
        f"bool_or(p.id = c.id) AS chosen FROM pts p JOIN {seeds2} c ON p.part = c.part GROUP BY p.id")
    sk, seedsk = seeding_ctes("s_", "pts", CLUSTER_K, SEED)
    q["seed_centers"] = with_ctes([f"pts AS ({_PTS})"] + sk,
                                  f"SELECT CAST(i AS INTEGER) AS center_id, id FROM {seedsk}")
    cl, fin = clustering_ctes("l_", "pts", CLUSTER_K, CLUSTER_ITERS, SEED)
    q["lloyd"] = with_ctes([f"pts AS ({_WPTS})"] + cl,
                           f"SELECT CAST(i AS INTEGER) AS center_id, {_round_list('v')} AS v FROM {fin}")
    co, fin2 = clustering_ctes("o_", "pts", CLUSTER_K, CLUSTER_ITERS, SEED)
    q["cluster_objective"] = with_ctes(
        [f"pts AS ({_PTS})"] + co,
        f"SELECT round(avg(d), 6) AS objective FROM ({assign_sql('pts', fin2)})")
    mpts = (f"SELECT CAST(vec_id % {MR_PARTS} AS INTEGER) AS part, vec_id AS id, "
            f"CAST(embedding AS DOUBLE[]) AS v, 1.0 AS w FROM embeddings")
    cs, core = coreset_ctes("r1_", "mpts", MR_K, MR_ITERS, SEED)
    q["coreset"] = with_ctes(
        [f"mpts AS ({mpts})"] + cs,
        f"SELECT CAST(part AS INTEGER) AS part, CAST(i AS INTEGER) AS center_id, CAST(id AS BIGINT) AS id, "
        f"CAST(w AS BIGINT) AS w, {_round_list('v')} AS v FROM {core}")
    c0, core0 = coreset_ctes("z_", "mpts", MR_K, 0, SEED)
    q["coreset_iter0"] = with_ctes(
        [f"mpts AS ({mpts})"] + c0,
        f"SELECT CAST(part AS INTEGER) AS part, CAST(i AS INTEGER) AS center_id, CAST(id AS BIGINT) AS id, "
        f"CAST(w AS BIGINT) AS w, {_round_list('v')} AS v FROM {core0}")
    r2c, fin2c = clustering_ctes("c2_", "cpts", MR_K, MR_ITERS, SEED)
    q["recluster_coreset"] = with_ctes(
        [f"mpts AS ({mpts})"] + cs
        + [f"cpts AS MATERIALIZED (SELECT 0 AS part, id, v, CAST(w AS DOUBLE) AS w FROM {core} WHERE w > 0)"]
        + r2c, f"SELECT CAST(i AS INTEGER) AS center_id, {_round_list('v')} AS v FROM {fin2c}")
    q["objective_by_part"] = with_ctes(
        [f"pts AS ({_PTS})", f"fc AS ({_FIXED})",
         f"mp AS (SELECT CAST(id % {MR_PARTS} AS INTEGER) AS part, id, v, w FROM pts)",
         f"a AS ({assign_sql('mp', 'fc', by_part=False)})",
         "per AS (SELECT part, avg(d) AS a, count(*) AS n FROM a GROUP BY part)"],
        "SELECT round(sum(a * n) / sum(n), 6) AS objective, CAST(sum(n) AS BIGINT) AS n FROM per")
    r2, fin3 = clustering_ctes("r2_", "cpts", MR_K, MR_ITERS, SEED)
    q["mr_cluster"] = with_ctes(
        [f"mpts AS ({mpts})"] + cs
        + [f"cpts AS MATERIALIZED (SELECT 0 AS part, id, v, CAST(w AS DOUBLE) AS w FROM {core} WHERE w > 0)"]
        + r2 + [f"r3 AS ({assign_sql('mpts', fin3, by_part=False)})"],
        f"SELECT CAST(count(*) AS BIGINT) AS n_points, {MR_K} AS k, {MR_PARTS} AS parts, {MR_ITERS} AS iters, "
        f"round(avg(d), 6) AS objective FROM r3")
    return q


ORACLE_SQL.update(_cluster_queries())
