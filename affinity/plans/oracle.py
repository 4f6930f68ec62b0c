"""DuckDB SQL equivalents of the catalogue queries (the correctness oracle).

The SQL is written in the reference's own formulation wherever that differs
from the Spark plan (raw-row self-joins, full matrices, level-wise itemset
counting, recursive Lloyd iterations), so it checks the plan rewrites rather
than repeating them. Views ``lineitem orders part ...`` are pre-registered.
"""

from __future__ import annotations

from affinity.plans.params import (  # noqa: F401
    BOOST_SUPPORT,
    BOOST_WEIGHT,
    EPSILON,
    HOLDOUT,
    LLOYD_K,
    LOW_THRESHOLD,
    MIN_CONFIDENCE,
    MIN_SUPPORT,
    ORDER_MIN_CONFIDENCE,
    ORDER_MIN_SUPPORT,
    PREVIEW_CUT,
    TOP_N,
    THRESHOLD,
    TRAIN_CUT,
    KMAX_MICRO,
    KMEANS_K,
    TERM,
)

MAX_LEVEL = 6  # itemset sizes enumerated by the SQL (the data has none above 4)
TOP_VALUE = 100.0  # microaggregation: the top band trains on values below this


def _scores(item: str = "brand") -> str:
    if item == "brand":
        cno, join = "p.p_brand", "JOIN part p ON l.l_partkey = p.p_partkey"
    else:
        cno, join = "CAST(l.l_partkey AS VARCHAR)", ""
    return f"""
    SELECT CAST(o.o_custkey AS VARCHAR) AS sno, {cno} AS cno,
           50.0 + l.l_quantity AS score,
           CAST(year(o.o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o.o_orderdate) AS VARCHAR) AS term,
           CAST(year(o.o_orderdate) AS VARCHAR) AS cohort
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey {join}"""


def _train(item: str = "brand") -> str:
    return (f"SELECT sno, cno, score FROM ({_scores(item)}) s "
            f"WHERE score < {TRAIN_CUT} AND cohort <> '{HOLDOUT}'")


def _preview(item: str = "brand") -> str:
    return (f"SELECT sno, cno, score FROM ({_scores(item)}) s "
            f"WHERE score < {PREVIEW_CUT} AND cohort = '{HOLDOUT}'")


def _cosine_full(src: str, weight: str) -> str:
    """Reference formulation: raw-row self-join, all ordered pairs, diagonal split."""
    return f"""
    SELECT p.i AS item1, p.j AS item2, p.d / sqrt(a.d * b.d) AS sim
    FROM (SELECT x.cno AS i, y.cno AS j, sum({weight.replace('@', 'x')} * {weight.replace('@', 'y')}) AS d
          FROM ({src}) x JOIN ({src}) y ON x.sno = y.sno GROUP BY 1, 2) p
    JOIN (SELECT x.cno AS i, sum({weight.replace('@', 'x')} * {weight.replace('@', 'y')}) AS d
          FROM ({src}) x JOIN ({src}) y ON x.sno = y.sno AND x.cno = y.cno GROUP BY 1) a ON a.i = p.i
    JOIN (SELECT x.cno AS i, sum({weight.replace('@', 'x')} * {weight.replace('@', 'y')}) AS d
          FROM ({src}) x JOIN ({src}) y ON x.sno = y.sno AND x.cno = y.cno GROUP BY 1) b ON b.i = p.j
    WHERE p.i <> p.j AND a.d * b.d > 0"""


def _train_cosine(item: str = "brand") -> str:
    return _cosine_full(_train(item), f"({TRAIN_CUT} - @.score)")


def _recommend(sim_sql: str, threshold: float | None = THRESHOLD, item: str = "brand", score: str = "s / len") -> str:
    where = f"WHERE s / len > {threshold} AND NOT isnan(s / len)" if threshold is not None else ""
    return f"""
    WITH sim AS ({sim_sql}),
    perf AS (SELECT sno, cno AS item2, {PREVIEW_CUT} - score AS w FROM ({_preview(item)}) p),
    j AS (SELECT perf.sno, perf.item2, perf.w, sim.item1, sim.sim FROM perf JOIN sim ON sim.item2 = perf.item2),
    r AS (SELECT *, row_number() OVER (PARTITION BY sno ORDER BY w DESC, sim DESC, item1, item2) AS rn FROM j),
    k AS (SELECT *, count(*) OVER (PARTITION BY sno) AS len FROM r WHERE rn <= {TOP_N}),
    agg AS (SELECT sno, item1, sum(sim * w) AS s, max(len) AS len FROM k GROUP BY sno, item1)
    SELECT sno, item1 AS cno, round({score}, 6) AS pre_score FROM agg {where}"""


# ----------------------------------------------------------------- itemsets

def _baskets_items(train_sql: str) -> str:
    return f"SELECT DISTINCT sno AS basket, cno AS item FROM ({train_sql}) t"


def _itemsets(bi_sql: str, support: float, levels: int = MAX_LEVEL) -> str:
    """Apriori: candidates of size k from two frequent (k-1)-sets sharing a
    prefix, support counted by list containment in each basket. Returns the
    CTE list ending in ``fi(k, i1..i{levels}, key, freq)``."""
    ctes = [
        f"bi AS ({bi_sql})",
        "bl AS (SELECT basket, list(item) AS items FROM bi GROUP BY basket)",
        "nb AS (SELECT count(*) AS n FROM bl)",
        f"thr AS (SELECT ceil(CAST({support} AS DOUBLE) * n) AS t, n FROM nb)",
        "f1 AS (SELECT [item] AS items, count(*) AS freq FROM bi GROUP BY item "
        "HAVING count(*) >= (SELECT t FROM thr))",
    ]
    for k in range(2, levels + 1):
        prefix = (f"a.items[1:{k - 2}] = b.items[1:{k - 2}] AND " if k > 2 else "")
        ctes.append(
            f"c{k} AS (SELECT list_concat(a.items, [b.items[{k - 1}]]) AS items FROM f{k - 1} a "
            f"JOIN f{k - 1} b ON {prefix}a.items[{k - 1}] < b.items[{k - 1}])")
        ctes.append(
            f"f{k} AS (SELECT c.items, count(*) AS freq FROM c{k} c JOIN bl ON list_has_all(bl.items, c.items) "
            f"GROUP BY c.items HAVING count(*) >= (SELECT t FROM thr))")
    sel = ", ".join(f"items[{m}] AS i{m}" for m in range(1, levels + 1))
    parts = [f"SELECT {k} AS k, {sel}, array_to_string(items, ',') AS key, freq FROM f{k}"
             for k in range(1, levels + 1)]
    ctes.append("fi AS (" + " UNION ALL ".join(parts) + ")")
    return ",\n".join(ctes)


def _rules(levels: int = MAX_LEVEL) -> str:
    """Rules with one consequent from ``fi``: CTE ``ru(ante_key, ante_k, a1..a{L-1}, consequent, fu, fa, fc)``."""
    parts = []
    for k in range(2, levels + 1):
        for j in range(1, k + 1):
            ante = [m for m in range(1, k + 1) if m != j]
            key = " || ',' || ".join(f"x.i{m}" for m in ante)
            slots = ", ".join(
                (f"x.i{ante[s]}" if s < len(ante) else "CAST(NULL AS VARCHAR)") + f" AS a{s + 1}"
                for s in range(levels - 1))
            parts.append(f"SELECT {key} AS ante_key, {k - 1} AS ante_k, {slots}, x.i{j} AS consequent, "
                         f"x.freq AS fu FROM fi x WHERE x.k = {k}")
    return ("ru0 AS (" + " UNION ALL ".join(parts) + "),\n"
            "ru AS (SELECT ru0.*, a.freq AS fa, c.freq AS fc FROM ru0 "
            "JOIN fi a ON a.key = ru0.ante_key JOIN fi c ON c.k = 1 AND c.i1 = ru0.consequent)")


def _frequent_itemsets(support: float) -> str:
    ctes = _itemsets(_baskets_items(_train()), support)
    return f"WITH {ctes}\nSELECT key AS items, k AS size, freq FROM fi"


def _itemsets_wide(support: float) -> str:
    ctes = _itemsets(_baskets_items(_train()), support)
    return f"WITH {ctes}\nSELECT i1 AS item1, i2 AS item2, i3 AS item3, i4 AS item4, key AS items, freq FROM fi"


def _itemset_summary(support: float) -> str:
    ctes = _itemsets(_baskets_items(_train()), support)
    return (f"WITH {ctes}\nSELECT k AS size, count(*) AS n_itemsets, CAST(sum(freq) AS BIGINT) AS total_freq "
            f"FROM fi GROUP BY k")


def _association_rules(support: float, confidence: float) -> str:
    ctes = _itemsets(_baskets_items(_train()), support)
    return f"""WITH {ctes},
    {_rules()}
    SELECT ante_key AS antecedent, consequent,
           round(CAST(fu AS DOUBLE) / fa, 6) AS confidence,
           round((CAST(fu AS DOUBLE) / fa) / (CAST(fc AS DOUBLE) / (SELECT n FROM thr)), 6) AS lift,
           round(CAST(fu AS DOUBLE) / (SELECT n FROM thr), 6) AS support
    FROM ru WHERE CAST(fu AS DOUBLE) / fa >= {confidence}"""


def _rules_wide(support: float, confidence: float) -> str:
    ctes = _itemsets(_baskets_items(_train()), support)
    return f"""WITH {ctes},
    {_rules()}
    SELECT a1 AS antecedent1, a2 AS antecedent2, a3 AS antecedent3, a4 AS antecedent4,
           consequent, round(CAST(fu AS DOUBLE) / fa, 6) AS confidence, ante_key AS antecedent
    FROM ru WHERE CAST(fu AS DOUBLE) / fa >= {confidence}"""


def _recommend_from_rules(support: float, confidence: float) -> str:
    ctes = _itemsets(_baskets_items(_train()), support)
    return f"""WITH {ctes},
    {_rules()},
    fired AS (SELECT * FROM ru WHERE CAST(fu AS DOUBLE) / fa >= {confidence}),
    ante AS (SELECT DISTINCT ante_key, ante_k, unnest(string_split(ante_key, ',')) AS a_item,
                    consequent FROM fired),
    hit AS (SELECT bi.basket, ante.ante_key, ante.consequent FROM ante JOIN bi ON bi.item = ante.a_item
            GROUP BY bi.basket, ante.ante_key, ante.ante_k, ante.consequent
            HAVING count(*) = ante.ante_k)
    SELECT DISTINCT h.basket AS sno, h.consequent AS cno FROM hit h
    WHERE NOT EXISTS (SELECT 1 FROM bi WHERE bi.basket = h.basket AND bi.item = h.consequent)"""


def _boosted_sim() -> str:
    ctes = _itemsets(_baskets_items(_train()), BOOST_SUPPORT)
    # Reference formulation: every (pair, itemset) combination tested for
    # containment of both items, then cnt / total added with weight.
    return f"""WITH {ctes},
    sets AS (SELECT key, string_split(key, ',') AS members, freq FROM fi),
    total AS (SELECT sum(CAST(freq AS DOUBLE)) AS s FROM sets),
    sim AS ({_train_cosine()}),
    cnt AS (SELECT sim.item1, sim.item2, sum(CASE WHEN list_contains(sets.members, sim.item1)
                 AND list_contains(sets.members, sim.item2) THEN CAST(sets.freq AS DOUBLE) ELSE 0 END) AS c
            FROM sim, sets GROUP BY sim.item1, sim.item2)
    SELECT sim.item1, sim.item2,
           sim.sim + coalesce(cnt.c / nullif((SELECT s FROM total), 0), 0) * {BOOST_WEIGHT} AS sim
    FROM sim LEFT JOIN cnt ON cnt.item1 = sim.item1 AND cnt.item2 = sim.item2"""


def _pair_boost() -> str:
    ctes = _itemsets(_baskets_items(_train()), MIN_SUPPORT)
    return f"""WITH {ctes},
    pairs AS (SELECT i1 AS a, i2 AS b, CAST(freq AS DOUBLE) AS v FROM fi WHERE k = 2),
    sim AS ({_train_cosine()})
    SELECT sim.item1, sim.item2, sim.sim + coalesce((SELECT sum(v) FROM pairs
           WHERE (pairs.a = sim.item1 AND pairs.b = sim.item2)
              OR (pairs.a = sim.item2 AND pairs.b = sim.item1)), 0) AS sim
    FROM sim"""


def _order_itemsets() -> str:
    bi = ("SELECT DISTINCT CAST(l.l_orderkey AS VARCHAR) AS basket, p.p_type AS item "
          "FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey")
    ctes = _itemsets(bi, ORDER_MIN_SUPPORT)
    return f"WITH {ctes}\nSELECT key AS items, k AS size, freq FROM fi"


def _recommend_boosted() -> str:
    """Boosted-similarity predictions with the reference threshold."""
    return _recommend(f"SELECT * FROM ({_boosted_sim().strip()}) bs")


def _recommend_boosted_scores() -> str:
    """Scores with the itemset-boosted similarity, before the threshold."""
    return _recommend(f"SELECT * FROM ({_boosted_sim().strip()}) bs", None)


def _order_rules() -> str:
    bi = ("SELECT DISTINCT CAST(l.l_orderkey AS VARCHAR) AS basket, p.p_type AS item "
          "FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey")
    ctes = _itemsets(bi, ORDER_MIN_SUPPORT)
    return f"""WITH {ctes},
    {_rules()}
    SELECT ante_key AS antecedent, consequent,
           round(CAST(fu AS DOUBLE) / fa, 6) AS confidence,
           round((CAST(fu AS DOUBLE) / fa) / (CAST(fc AS DOUBLE) / (SELECT n FROM thr)), 6) AS lift,
           round(CAST(fu AS DOUBLE) / (SELECT n FROM thr), 6) AS support
    FROM ru WHERE CAST(fu AS DOUBLE) / fa >= {ORDER_MIN_CONFIDENCE}"""


# ------------------------------------------------------------------ profile

def _profile(where: str = "") -> str:
    one = "CAST(1 AS DOUBLE)"
    zero = "CAST(0 AS DOUBLE)"
    return f"""
    SELECT trim(cno) AS cno,
           sum(CASE WHEN score > 0 THEN score ELSE {zero} END) / count(*) AS avg,
           sum(CASE WHEN score >= 60 THEN {one} ELSE {zero} END) / count(*) AS pass,
           sum(CASE WHEN score >= 80 THEN {one} ELSE {zero} END) / count(*) AS good,
           sum(CASE WHEN score >= 90 THEN {one} ELSE {zero} END) / count(*) AS great,
           count(*) AS n
    FROM ({_scores('part')}) s {where} GROUP BY trim(cno)"""


def _course_profile() -> str:
    return f"""SELECT cno, round(avg, 6) AS avg, round(pass, 6) AS pass, round(good, 6) AS good,
       round(great, 6) AS great, n FROM ({_profile()}) p"""


def _nearest_sql(kmax: int, v: str, tbl: str) -> str:
    """Index of the nearest non-NULL centre ``{tbl}.c0..``; ties to the later one."""
    expr = "NULL"
    for i in range(kmax):
        ci = f"{tbl}.c{i}"
        cond = " AND ".join(
            [f"{ci} IS NOT NULL"]
            + [f"({tbl}.c{j} IS NULL OR abs({v} - {ci}) < abs({v} - {tbl}.c{j}))" for j in range(i + 1, kmax)]
            + [f"({tbl}.c{j} IS NULL OR abs({v} - {ci}) <= abs({v} - {tbl}.c{j}))" for j in range(0, i)])
        expr = f"CASE WHEN {cond} THEN {i} ELSE {expr} END"
    return expr


def _lloyd_sql(hist_sql: str, k_expr: str, kmax: int, group_cols: list[str], epsilon: float) -> str:
    """Recursive Lloyd iterations per group over ``hist(g.., v, n)``.

    Equal-width start ``lo + (hi - lo) * (2i + 1) / (2k)``; nearest centre
    with ties to the later index; empty clusters keep their centre; a group
    stops once no centre moves by more than epsilon. Returns CTEs ending in
    ``fin(g.., kk, c0..c{kmax-1})``.
    """
    g = ", ".join(group_cols)
    keys = g + ", " if g else ""
    pre = lambda t: "".join(f"{t}.{c}, " for c in group_cols)
    gjoin = " AND ".join(f"h.{c} = s.{c}" for c in group_cols) or "TRUE"
    cs = ", ".join(f"c{i}" for i in range(kmax))
    init = ", ".join(
        f"CASE WHEN {i} < {k_expr} THEN lo + (hi - lo) * (2 * {i} + 1) / CAST(2 * {k_expr} AS DOUBLE) END AS c{i}"
        for i in range(kmax))
    rng = f"SELECT {keys}min(v) AS lo, max(v) AS hi FROM hist"
    new_c = ", ".join(
        f"coalesce(sum(CASE WHEN a.idx = {i} THEN a.n * a.v END) / sum(CASE WHEN a.idx = {i} THEN a.n END), "
        f"a.c{i}) AS c{i}" for i in range(kmax))
    olds = ", ".join(f"a.c{i} AS o{i}" for i in range(kmax))
    moved = " OR ".join(f"coalesce(abs(x.c{i} - x.o{i}) > {epsilon}, FALSE)" for i in range(kmax))
    return f"""
    hist AS ({hist_sql}),
    rng AS ({rng} {"GROUP BY " + g if g else ""}),
    it AS (
      SELECT 0 AS step, {keys}{k_expr} AS kk, {init}, FALSE AS done FROM rng
      UNION ALL
      SELECT x.step, {pre("x")}x.kk, {", ".join("x.c" + str(i) for i in range(kmax))}, NOT ({moved}) AS done
      FROM (
        SELECT a.step + 1 AS step, {pre("a")}a.kk, {new_c}, {olds}
        FROM (SELECT s.step, {pre("s")}s.kk, {", ".join("s.c" + str(i) for i in range(kmax))},
                     h.v, h.n, {_nearest_sql(kmax, "h.v", "s")} AS idx
              FROM it s JOIN hist h ON {gjoin} WHERE NOT s.done) a
        GROUP BY a.step, {pre("a")}a.kk, {", ".join("a.c" + str(i) for i in range(kmax))}
      ) x
    ),
    fin AS (SELECT {keys}kk, {cs} FROM it WHERE done)"""


TIER_SQL = "CASE r.tier_rank WHEN 0 THEN 'easy' WHEN 1 THEN 'middle' WHEN 2 THEN 'hard' END"


def _tiers(train_where: str, apply_where: str, with_rank: bool) -> str:
    hist = f"SELECT avg AS v, count(*) AS n FROM ({_profile(train_where)}) p GROUP BY avg"
    ctes = _lloyd_sql(hist, str(LLOYD_K), LLOYD_K, [], EPSILON)
    cvals = ", ".join(f"f.c{i}" for i in range(LLOYD_K))
    rank_col = "CAST(r.tier_rank AS INTEGER) AS tier_rank, " if with_rank else ""
    return f"""WITH RECURSIVE {ctes.strip()},
    cent AS (SELECT unnest(range({LLOYD_K})) AS idx, unnest([{cvals}]) AS c FROM fin f),
    ranked AS (SELECT idx, c, row_number() OVER (ORDER BY c, idx) - 1 AS tier_rank FROM cent),
    pts AS (SELECT p.cno, p.avg AS v, f.* FROM ({_profile(apply_where)}) p, fin f),
    asg AS (SELECT cno, v, {_nearest_sql(LLOYD_K, "v", "pts")} AS idx FROM pts)
    SELECT asg.cno, round(asg.v, 6) AS avg, round(r.c, 6) AS center, {rank_col}{TIER_SQL} AS tier
    FROM asg JOIN ranked r ON r.idx = asg.idx"""


def _lloyd_tiers() -> str:
    return _tiers("", "", True)


def _forecast_tier() -> str:
    return _tiers(f"WHERE cohort <> '{HOLDOUT}'", f"WHERE cohort = '{HOLDOUT}'", False)


# ---------------------------------------------------------- microaggregation

def _micro_common() -> str:
    kmax = KMAX_MICRO
    cuts = [60, 70, 80, 90]
    band = "CASE " + " ".join(f"WHEN v < {c} THEN {i}" for i, c in enumerate(cuts)) + " ELSE 4 END"
    cs = ", ".join(f"c{i}" for i in range(3))
    return f"""
    cells AS (
      SELECT id, attr, v AS q, {band} AS band, v < {TOP_VALUE} AS in_range
      FROM (SELECT sno AS id, cno AS attr, sum(score) / count(*) AS v
            FROM ({_scores('brand')}) s GROUP BY sno, cno) c0),
    trainable AS (SELECT attr, band, bool_or(band < 4 OR in_range) AS has_train
                  FROM cells GROUP BY attr, band),
    hist AS (
      SELECT c.attr, c.band, c.q AS v, CAST(count(*) AS DOUBLE) AS n FROM cells c
      JOIN trainable tr ON tr.attr = c.attr AND tr.band = c.band
      WHERE c.band < 4 OR c.in_range OR NOT tr.has_train GROUP BY c.attr, c.band, c.q),
    low AS (SELECT *, v - min(v) OVER (PARTITION BY attr, band) AS x, min(v) OVER (PARTITION BY attr, band) AS lo FROM hist),
    pre AS (
      SELECT attr, band, lo, count(*) OVER (PARTITION BY attr, band) AS m, row_number() OVER w AS pos,
             sum(n) OVER w AS n, sum(n * x) OVER w AS s, sum(n * x * x) OVER w AS q
      FROM low WINDOW w AS (PARTITION BY attr, band ORDER BY v)),
    -- every pair of cuts is tried
    two AS (
      SELECT a.attr, a.band, b.pos, a.q - a.s * a.s / a.n + b.q - a.q - (b.s - a.s) * (b.s - a.s) / (b.n - a.n) AS err,
             a.n AS n0, b.n - a.n AS n1, a.s / a.n + a.lo AS c0, (b.s - a.s) / (b.n - a.n) + a.lo AS c1
      FROM pre a JOIN pre b ON a.attr = b.attr AND a.band = b.band AND a.pos < b.pos
      QUALIFY row_number() OVER (PARTITION BY a.attr, a.band, b.pos ORDER BY round(err / b.n, 9), a.pos) = 1),
    three AS (
      SELECT t.attr, t.band, t.n0, t.n1, e.n - a.n AS n2, t.c0, t.c1, (e.s - a.s) / (e.n - a.n) + a.lo AS c2
      FROM two t JOIN pre a ON a.attr = t.attr AND a.band = t.band AND a.pos = t.pos
      JOIN pre e ON e.attr = a.attr AND e.band = a.band AND e.pos = e.m AND a.pos < e.pos
      QUALIFY row_number() OVER (PARTITION BY t.attr, t.band
                                 ORDER BY round((t.err + e.q - a.q - (e.s - a.s) * (e.s - a.s) / (e.n - a.n)) / e.n, 9), a.pos) = 1),
    splits AS (
      SELECT attr, band, 3 AS kk, least(n0, n1, n2) AS smallest, {cs} FROM three
      UNION ALL SELECT t.attr, t.band, 2, least(n0, n1), c0, c1, NULL FROM two t JOIN pre e
        ON e.attr = t.attr AND e.band = t.band AND e.pos = e.m AND e.m = t.pos
      UNION ALL SELECT attr, band, 1, 2, s / n + lo, NULL, NULL FROM pre WHERE pos = m),
    chosen AS (
      SELECT attr, band, kk, {cs} FROM splits WHERE smallest >= 2
      QUALIFY row_number() OVER (PARTITION BY attr, band ORDER BY kk DESC) = 1),
    centred AS (
      SELECT c.id, c.attr, c.q, c.band, ch.kk,
             {_nearest_sql(kmax, "CAST(c.q AS DOUBLE)", "ch")} AS idx,
             CASE {_nearest_sql(kmax, "CAST(c.q AS DOUBLE)", "ch")}
               {" ".join(f"WHEN {i} THEN ch.c{i}" for i in range(kmax))} END AS center
      FROM cells c JOIN chosen ch ON ch.attr = c.attr AND ch.band = c.band)"""


def _microaggregate_detail() -> str:
    return f"""WITH {_micro_common().strip()}
    SELECT c.id, c.attr, round(c.q, 6) AS value, CAST(c.band AS INTEGER) AS band,
           CAST(c.kk AS INTEGER) AS k, CAST(c.idx AS INTEGER) AS cluster,
           round(c.center, 6) AS center,
           count(*) OVER (PARTITION BY c.attr, c.band, c.idx) AS cluster_size
    FROM centred c"""


def _microaggregate() -> str:
    return f"""WITH {_micro_common().strip()}
    SELECT id, attr, round(round(center, 9), 3) AS value FROM centred"""


def _anonymised_sheet() -> str:
    names = sorted(f"Brand#{i}" for i in range(1, 26))
    cells = " || ".join(f"coalesce(printf('%.3f', max(CASE WHEN attr = '{x}' THEN value END)), '') || chr(9)" for x in names)
    return f"""WITH {_micro_common().strip()},
    long AS (SELECT id, attr, round(round(center, 9), 3) AS value FROM centred)
    SELECT id, {cells} AS value FROM long GROUP BY id"""


def _rule_text(support: float, confidence: float) -> str:
    ctes = _itemsets(_baskets_items(_train()), support)
    return f"""WITH {ctes},
    {_rules()},
    r AS (SELECT ante_key AS a, consequent AS c, printf('%.6f', round(CAST(fu AS DOUBLE) / fa, 6)) AS p
          FROM ru WHERE CAST(fu AS DOUBLE) / fa >= {confidence})
    SELECT '[' || a || ']-->[' || c || '],' || p AS value FROM r
    UNION ALL SELECT a || '-->' || c || '-->' || p FROM r"""


def _microaggregate_wide() -> str:
    # the 25 brands of the part table
    names = [f"Brand#{i}" for i in range(1, 26)]
    cols = ", ".join(f"max(CASE WHEN attr = '{x}' THEN value END) AS \"{x}\"" for x in names)
    return f"""WITH {_micro_common().strip()},
    long AS (SELECT id, attr, round(round(center, 9), 3) AS value FROM centred)
    SELECT id, {cols} FROM long GROUP BY id"""


# ----------------------------------------------------------------- catalogue

def oracle_sql() -> dict[str, str]:
    cos_brand = _train_cosine("brand")
    return {
        "train_scores": _train("brand"),
        "preview_scores": _preview("brand"),
        "basket_pairs": f"SELECT sno, cno FROM ({_train('brand')}) t",
        "cooccurrence": _cosine_full(_train("brand"), "1.0"),
        "cosine": _train_cosine("part"),
        "recommend": _recommend(cos_brand),
        "recommend_scores": _recommend(cos_brand, None),
        "seen_items": f"SELECT DISTINCT cno FROM ({_preview('brand')}) p",
        "recommend_unseen": f"""SELECT r.* FROM ({_recommend(cos_brand, None)}) r
            WHERE NOT EXISTS (SELECT 1 FROM ({_preview('brand')}) p WHERE p.sno = r.sno AND p.cno = r.cno)""",
        "frequent_itemsets": _frequent_itemsets(MIN_SUPPORT),
        "itemsets_wide": _itemsets_wide(MIN_SUPPORT),
        "itemset_summary": _itemset_summary(MIN_SUPPORT),
        "association_rules": _association_rules(MIN_SUPPORT, MIN_CONFIDENCE),
        "rules_wide": _rules_wide(MIN_SUPPORT, MIN_CONFIDENCE),
        "recommend_from_rules": _recommend_from_rules(MIN_SUPPORT, MIN_CONFIDENCE),
        "order_itemsets": _order_itemsets(),
        "order_rules": _order_rules(),
        "cosine_boosted": _boosted_sim(),
        "recommend_boosted": _recommend_boosted(),
        "recommend_boosted_scores": _recommend_boosted_scores(),
        "pair_boost": _pair_boost(),
        "course_profile": _course_profile(),
        "lloyd_tiers": _lloyd_tiers(),
        "forecast_tier": _forecast_tier(),
        "microaggregate": _microaggregate(),
        "microaggregate_wide": _microaggregate_wide(),
        "microaggregate_detail": _microaggregate_detail(),
        "read_write_roundtrip": _train("brand"),
        "recommend_low_threshold": _recommend(cos_brand, LOW_THRESHOLD),
        "read_pairs": f"SELECT sno, cno FROM ({_train('brand')}) t",
        "read_scores_csv": _train("brand"),
        "read_baskets": f"""SELECT items, count(*) AS n FROM (
            SELECT string_agg(item, ',' ORDER BY item) AS items FROM ({_baskets_items(_train())}) b GROUP BY basket) l
            GROUP BY items""",
        "read_wide_scores": f"SELECT sno AS id, cno AS attr, max(score) AS value FROM ({_train('brand')}) t GROUP BY sno, cno",
        "sink_labels": f"SELECT cno, tier AS label FROM ({_lloyd_tiers()}) t",
        "sink_predictions": _recommend(cos_brand, None),
        "sink_rules": _rules_wide(MIN_SUPPORT, MIN_CONFIDENCE),
        "sink_itemsets": _itemsets_wide(MIN_SUPPORT),
        "ordered_scores": f"SELECT *, row_number() OVER (ORDER BY sno, pre_score, cno) AS position FROM ({_recommend(cos_brand, None)}) t",
        "recommend_unseen_by_anyone": f"""SELECT r.* FROM ({_recommend(_train_cosine("part"), None, "part")}) r
            WHERE r.cno NOT IN (SELECT cno FROM ({_preview("part")}) p)""",
        "recommend_atan": _recommend(cos_brand, None, score="atan(s / len)"),
        "train_scores_term": f"""SELECT sno, cno, score FROM ({_scores("brand")}) s
            WHERE score < {TRAIN_CUT} AND cohort <> '{HOLDOUT}' AND term = '{TERM}'""",
        "itemset_pairs": f"SELECT * FROM ({_frequent_itemsets(MIN_SUPPORT)}) t WHERE size = 2",
        "rule_summary": f"""SELECT CAST(len(string_split(antecedent, ',')) AS INTEGER) AS size, count(*) AS n_rules
            FROM ({_rules_wide(MIN_SUPPORT, MIN_CONFIDENCE)}) t GROUP BY 1""",
        "rule_text": _rule_text(MIN_SUPPORT, MIN_CONFIDENCE),
        "course_count": f"SELECT count(*) AS n_courses, CAST(sum(n) AS BIGINT) AS n_scores FROM ({_profile()}) p",
        "read_features": f"""SELECT cno, round(avg, 6) AS avg, round(pass, 6) AS pass, round(good, 6) AS good,
            round(great, 6) AS great FROM ({_profile()}) p""",
        "kmeans_centres": f"""SELECT CAST(unnest(range({KMEANS_K})) AS INTEGER) AS label, TRUE AS avg, TRUE AS pass,
            TRUE AS good, TRUE AS great""",
        "anonymised_sheet": _anonymised_sheet(),
        "kmeans_check": f"SELECT cno, TRUE AS is_nearest, TRUE AS in_range FROM ({_profile()}) p",
    }
