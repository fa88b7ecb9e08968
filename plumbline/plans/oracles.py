"""DuckDB SQL giving the same rows as each query expressible in SQL.

Written from the operators' definitions, not from the Spark plans: window
functions, subqueries and correlated tests are used freely here.
"""

from __future__ import annotations

from itertools import combinations, combinations_with_replacement

ORACLES: dict[str, str] = {}

ROW_ID = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
ROW_ORDER = f"{ROW_ID}, l_extendedprice"
NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
Y = "3 * l_quantity + 400 * l_discount"


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ---- sources and cleaning -----------------------------------------------------

ORACLES["csv_roundtrip"] = """
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
       l_extendedprice, l_discount, CASE WHEN l_tax > 0 THEN l_tax END AS l_tax, l_returnflag, l_linestatus,
       strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate,
       1234567890123456789 + l_orderkey * 1000 + l_linenumber AS long_id,
       '"' || l_returnflag || '", said' || chr(10) || l_linestatus || chr(10) AS note
FROM lineitem"""

ORACLES["csv_split"] = "SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5 FROM documents"

ORACLES["named_sample"] = "SELECT * FROM part"

ORACLES["parquet_stages"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(trunc(o_totalprice) AS BIGINT) AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders"""


def _feature_set(name: str, n_cols: int, last: str, expr: str) -> str:
    return f"""SELECT '{name}' AS name, CAST({n_cols} AS BIGINT) AS n_cols, '{last}' AS last_column,
       count(*) AS n_rows, round(sum({expr}), 2) AS last_sum FROM lineitem"""


ORACLES["feature_sets_written"] = union(
    [
        _feature_set("base", 8, "l_tax", "l_tax"),
        _feature_set("poly1", 11, "l_discount l_tax", "l_discount * l_tax"),
        _feature_set("poly2", 14, "l_tax^2", "l_tax * l_tax"),
    ]
)

ORACLES["mapping_roundtrip"] = union(
    [
        f"""SELECT '{c}' AS "column", {c} AS category,
       CAST(row_number() OVER (ORDER BY min(p_partkey)) AS INTEGER) AS code
FROM part GROUP BY {c}"""
        for c in ("p_brand", "p_type")
    ]
)

ORACLES["drop_columns"] = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"

ORACLES["drop_unlabeled"] = f"""
SELECT {ROW_ID}, l_returnflag AS label FROM lineitem WHERE l_linenumber <> 7"""

ORACLES["dropna_keys"] = f"""
SELECT {ROW_ID}, l_tax AS a, l_discount AS b FROM lineitem WHERE l_tax > 0 AND l_discount > 0"""

_RANK = """CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE substr(o_orderpriority, 1, 1) END"""

ORACLES["clean_join"] = f"""
SELECT o_orderkey, TRY_CAST({_RANK} AS INTEGER) AS rank, c_mktsegment, c_acctbal, n_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"""

ORACLES["failed_cast_counts"] = f"""
SELECT 'rank' AS "column", count(*) FILTER (TRY_CAST({_RANK} AS INTEGER) IS NULL) AS failed FROM orders
UNION ALL SELECT 'o_totalprice', count(*) FILTER (o_totalprice >= 2147483648) FROM orders
UNION ALL SELECT 'o_orderstatus', count(*) FILTER (TRY_CAST(o_orderstatus AS DOUBLE) IS NULL) FROM orders"""

ORACLES["feature_chain"] = """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag, l_linestatus, l_quantity, l_discount, l_tax,
       unit_price, unit_price * (1 - l_discount) AS net_price
FROM (SELECT *, l_extendedprice / l_quantity AS unit_price FROM lineitem)"""

ORACLES["select_features"] = "SELECT l_quantity, l_discount, l_tax FROM lineitem"

_ALL = "l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate"
_KEPT = "l_orderkey,l_partkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus"
ORACLES["stage_audit"] = union(
    [
        f"""SELECT '{stage}' AS stage, count(*) AS n_rows, CAST({len(cols.split(","))} AS BIGINT) AS n_cols,
       '{cols}' AS columns FROM lineitem WHERE {test}"""
        for stage, cols, test in (
            ("read", _ALL, "true"),
            ("drop_columns", _KEPT, "true"),
            ("drop_unlabeled", _KEPT, "l_linenumber <> 7"),
            ("unit_price", _KEPT + ",unit_price", "l_linenumber <> 7"),
        )
    ]
)

# ---- transforms ----------------------------------------------------------------


def quartiles(table: str, *cols: str) -> str:
    parts = [
        f"quantile_cont({c}, 0.25) AS {c}_25, quantile_cont({c}, 0.75) AS {c}_75" for c in cols
    ]
    return f"SELECT {', '.join(parts)} FROM {table}"


def banded(c: str) -> str:
    return f"CASE WHEN {c} >= {c}_75 THEN 'q75' WHEN {c} >= {c}_25 THEN 'q25-75' WHEN {c} < {c}_25 THEN 'q25' END"


ORACLES["quantile_band"] = f"""
WITH q AS ({quartiles("lineitem", "l_extendedprice", "l_quantity")})
SELECT l_orderkey, l_linenumber, l_partkey, {banded("l_extendedprice")} AS l_extendedprice,
       {banded("l_quantity")} AS l_quantity
FROM lineitem, q"""


def first_seen(name: str, table: str, c: str, order: str) -> str:
    """CTE: category and its code by first appearance."""
    return f"""{name}_rows AS (SELECT {c} AS category, row_number() OVER (ORDER BY {order}) AS rn FROM {table}),
{name} AS (SELECT category, CAST(row_number() OVER (ORDER BY min(rn)) AS INTEGER) AS code
           FROM {name}_rows GROUP BY category)"""


ORACLES["ordinal_encode"] = f"""
WITH {first_seen("flags", "lineitem", "l_returnflag", ROW_ORDER)},
{first_seen("states", "lineitem", "l_linestatus", ROW_ORDER)}
SELECT {ROW_ORDER}, flags.code AS l_returnflag, states.code AS l_linestatus
FROM lineitem JOIN flags ON l_returnflag = flags.category JOIN states ON l_linestatus = states.category"""

_TYPES = first_seen("types", "part", "p_type", "p_partkey")
_BRANDS = first_seen("brands", "part", "p_brand", "p_partkey")


def type_flags(prefix: str) -> str:
    return ", ".join(f"CAST(types.code = {i} AS INTEGER) AS {prefix}p_type_{i}" for i in range(1, 7))


ORACLES["onehot_encode"] = f"""
WITH {_TYPES}
SELECT p_partkey, {type_flags("")} FROM part JOIN types ON p_type = types.category"""

ORACLES["base_n_encode"] = f"""
WITH {_BRANDS}
SELECT p_partkey, CAST(code // 9 % 3 AS INTEGER) AS p_brand_0, CAST(code // 3 % 3 AS INTEGER) AS p_brand_1,
       CAST(code % 3 AS INTEGER) AS p_brand_2
FROM part JOIN brands ON p_brand = category"""

ORACLES["auto_encode"] = f"""
WITH {_BRANDS}, {_TYPES}
SELECT p_partkey, p_retailprice, brands.code AS ord__p_brand, {type_flags("oh__")}
FROM part JOIN brands ON p_brand = brands.category JOIN types ON p_type = types.category"""

_INTERACTIONS = [f'{a} * {b} AS "{a} {b}"' for a, b in combinations(NUMBERS, 2)]
_FULL = [
    f'{a} * {b} AS "{a}^2"' if a == b else f'{a} * {b} AS "{a} {b}"'
    for a, b in combinations_with_replacement(NUMBERS, 2)
]
ORACLES["poly_interactions"] = f"SELECT {ROW_ID}, {', '.join([*NUMBERS, *_INTERACTIONS])} FROM lineitem"
ORACLES["poly_full"] = f"SELECT {ROW_ID}, {', '.join([*NUMBERS, *_FULL])} FROM lineitem"

ORACLES["standardize"] = f"""
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_discount) AS md,
                  stddev_pop(l_discount) AS sd FROM lineitem)
SELECT {ROW_ID}, round((l_quantity - mq) / sq, 6) AS l_quantity, round((l_discount - md) / sd, 6) AS l_discount
FROM lineitem, s"""

ORACLES["preprocess"] = f"""
WITH {_BRANDS}, {_TYPES}, s AS (SELECT avg(p_size) AS m, stddev_pop(p_size) AS d FROM part)
SELECT p_partkey, round((p_size - m) / d, 6) AS st__p_size, brands.code AS ord__p_brand, {type_flags("oh__")}
FROM part JOIN brands ON p_brand = brands.category JOIN types ON p_type = types.category, s"""

ORACLES["preprocess_plain"] = """
SELECT p_partkey, p_size AS dm__p_size, p_brand AS dm__p_brand, p_type AS dm__p_type FROM part"""

ORACLES["decode_classes"] = f"""
WITH {first_seen("ranks", "orders", "o_orderpriority", "o_orderkey")}
SELECT o_orderkey, code, category AS name FROM orders JOIN ranks ON o_orderpriority = category"""

ORACLES["distinct_values"] = "SELECT DISTINCT event_type FROM events"

# ---- profiling -------------------------------------------------------------------

ORACLES["mean_by"] = """
SELECT l_returnflag, round(avg(l_extendedprice), 6) AS mean FROM lineitem GROUP BY l_returnflag"""

ORACLES["count_by"] = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"

_LOCATED = "located AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey)"


def dense(table: str, x: str, hue: str, value: str, name: str, cte: str) -> str:
    return f"""
WITH {cte},
g AS (SELECT {x}, {hue}, {value} AS v FROM {table} GROUP BY {x}, {hue})
SELECT a.{x}, b.{hue}, coalesce(g.v, 0) AS {name}
FROM (SELECT DISTINCT {x} FROM g) a CROSS JOIN (SELECT DISTINCT {hue} FROM g) b
LEFT JOIN g ON g.{x} = a.{x} AND g.{hue} = b.{hue}"""


ORACLES["mean_by_hue"] = dense("located", "n_name", "n_regionkey", "round(avg(c_acctbal), 6)", "mean", _LOCATED)
ORACLES["count_by_hue"] = dense("located", "n_name", "n_regionkey", "count(*)", "n", _LOCATED)
ORACLES["band_count_dense"] = dense(
    "b", "l_extendedprice", "l_returnflag", "count(*)", "n",
    f"""q AS ({quartiles("lineitem", "l_extendedprice")}),
b AS (SELECT {banded("l_extendedprice")} AS l_extendedprice, l_returnflag FROM lineitem, q)""",
)


ORACLES["count_by_many"] = """
WITH x AS (SELECT DISTINCT l_orderkey FROM lineitem), h AS (SELECT DISTINCT l_returnflag FROM lineitem),
n AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT x.l_orderkey, h.l_returnflag, coalesce(n.n, 0) AS n
FROM x CROSS JOIN h LEFT JOIN n ON x.l_orderkey = n.l_orderkey AND h.l_returnflag = n.l_returnflag"""

ORACLES["mean_by_sparse"] = """
SELECT l_partkey, l_linenumber, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY ALL"""

ORACLES["ordinal_many"] = f"""
SELECT {ROW_ID}, CAST(dense_rank() OVER (ORDER BY strftime(l_shipdate, '%Y-%m-%d')) AS INTEGER) AS day,
  CAST(dense_rank() OVER (ORDER BY l_orderkey || '/' || l_linenumber) AS INTEGER) AS line,
  CAST(dense_rank() OVER (ORDER BY l_returnflag) AS INTEGER) AS l_returnflag
FROM lineitem"""


def edge(i: str, bins: int, lo: str = "lo", hi: str = "hi") -> str:
    return f"(CASE WHEN {i} >= {bins} THEN {hi} ELSE {i} * (({hi} - {lo}) / {float(bins)}) + {lo} END)"


def bin_of(v: str, bins: int, lo: str = "lo", hi: str = "hi") -> str:
    """Largest i below ``bins`` whose left edge is not above the value."""
    guess = f"least(CAST(floor(({v} - {lo}) / ({hi} - {lo}) * {float(bins)}) AS INTEGER), {bins - 1})"
    return f"""CAST(CASE WHEN {v} < {edge(guess, bins, lo, hi)} THEN {guess} - 1
     WHEN {guess} < {bins - 1} AND {v} >= {edge(f"({guess} + 1)", bins, lo, hi)} THEN {guess} + 1
     ELSE {guess} END AS INTEGER)"""


def span(c: str) -> str:
    """Range of a column, one wide around a single value."""
    flat = f"min({c}) = max({c})"
    return (
        f"min({c}) - CASE WHEN {flat} THEN 0.5 ELSE 0 END AS lo, "
        f"max({c}) + CASE WHEN {flat} THEN 0.5 ELSE 0 END AS hi"
    )


def hist(table: str, c: str, bins: int, hue: str | None = None, cte: str = "") -> str:
    """Body of a histogram: CTEs ends, counts, grid, and the joined result ``h``."""
    key, keys = (f"{hue}, ", f"GROUP BY {hue}") if hue else ("", "")
    on = f"USING ({hue})" if hue else "ON true"
    same = f"AND grid.{hue} = counts.{hue}" if hue else ""
    pick = f"grid.{hue}, " if hue else ""
    share = f"OVER (PARTITION BY grid.{hue})" if hue else "OVER ()"
    return f"""{cte}
ends AS (SELECT {key}{span(c)} FROM {table} {keys}),
counts AS (SELECT {key}{bin_of(c, bins)} AS bin, count(*) AS n FROM {table} JOIN ends {on}
           GROUP BY {key} bin),
grid AS (SELECT *, CAST(i AS INTEGER) AS bin FROM ends, range({bins}) r(i)),
h AS (SELECT {pick}grid.bin, {edge("grid.bin", bins)} AS "left", {edge("(grid.bin + 1)", bins)} AS "right",
             coalesce(counts.n, 0) AS n, sum(coalesce(counts.n, 0)) {share} AS total
      FROM grid LEFT JOIN counts ON grid.bin = counts.bin {same})"""


_HEIGHT = 'n / (total * ("right" - "left"))'
ORACLES["histogram"] = f"""
WITH {hist("lineitem", "l_extendedprice", 30)}
SELECT bin, round("left", 6) AS "left", round("right", 6) AS "right", n, round({_HEIGHT} * 1e6, 6) AS height FROM h"""
ORACLES["histogram_counts"] = f"""
WITH {hist("lineitem", "l_discount", 10)}
SELECT bin, round("left", 6) AS "left", round("right", 6) AS "right", n, CAST(n AS DOUBLE) AS height FROM h"""
ORACLES["histogram_hue"] = f"""
WITH {hist("events", "value", 30, "event_type")}
SELECT event_type, bin, round("left", 6) AS "left", round("right", 6) AS "right", n,
       round({_HEIGHT}, 6) AS height FROM h"""


def cells(x: str, y: str, bins: int, keys: str = "", table: str = "lineitem") -> str:
    """Occupied cells of x against y, grouped by further key expressions."""
    return f"""SELECT {keys}{bin_of(x, bins, "xl", "xh")} AS bx, {bin_of(y, bins, "yl", "yh")} AS by_, count(*) AS n
FROM {table}, (SELECT min({x}) AS xl, max({x}) AS xh, min({y}) AS yl, max({y}) AS yh FROM {table}) e
GROUP BY ALL"""


ORACLES["scatter_bins"] = f"""
SELECT l_returnflag, bx AS bin_x, by_ AS bin_y, n
FROM ({cells("l_quantity", "l_extendedprice", 20, "l_returnflag, ")})"""

ORACLES["scatter_stats"] = """
SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS mean_x, round(avg(l_extendedprice), 6) AS mean_y,
       round(stddev_pop(l_quantity), 6) AS sd_x, round(stddev_pop(l_extendedprice), 6) AS sd_y,
       round(corr(l_quantity, l_extendedprice), 6) AS corr
FROM lineitem GROUP BY l_returnflag"""

ORACLES["facet_bins"] = f"""
SELECT facet, bx AS bin_x, by_ AS bin_y, n
FROM ({cells("l_quantity", "l_extendedprice", 10, "l_returnflag || ' | ' || l_linestatus AS facet, ")})"""

ORACLES["facet_grid_width"] = "SELECT count(DISTINCT l_linestatus) AS n_cols FROM lineitem"

ORACLES["pairwise_scatter"] = union(
    [
        f"""SELECT '{a}' AS col1, '{b}' AS col2, l_returnflag, bx AS bin1, by_ AS bin2, n
FROM ({cells(a, b, 8, "l_returnflag, ")})"""
        for a, b in combinations(NUMBERS, 2)
    ]
)

ORACLES["pairwise_stats"] = union(
    [
        f"""SELECT '{a}' AS col1, '{b}' AS col2, l_returnflag, count(*) AS n, round(corr({a}, {b}), 6) AS corr
FROM lineitem GROUP BY l_returnflag"""
        for a, b in combinations(NUMBERS, 2)
    ]
)

_PLANTED = f"planted AS (SELECT *, {Y} AS y FROM lineitem)"
_FEATURES = ("l_quantity", "l_discount", "l_tax", "l_linenumber")

ORACLES["target_correlation"] = f"WITH {_PLANTED}\n" + union(
    [f"SELECT '{c}' AS variable, round(corr({c}, y), 6) AS corr FROM planted" for c in ("y", *_FEATURES)]
)


def _ratio(cat: str, num: str) -> str:
    return f"""SELECT '{cat}' AS col1, '{num}' AS col2, 'correlation_ratio' AS kind,
  round(sqrt(sum((gm - m) ** 2) / sum((v - m) ** 2)), 6) AS value
FROM (SELECT {num} AS v, avg({num}) OVER (PARTITION BY {cat}) AS gm, avg({num}) OVER () AS m FROM planted)"""


def _uncertain(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS col1, '{b}' AS col2, 'uncertainty' AS kind,
  round((ha + hb - hab) / ha, 6) AS value
FROM (SELECT (SELECT entropy({a}) FROM planted) AS ha, (SELECT entropy({b}) FROM planted) AS hb,
             (SELECT entropy({a} || '/' || {b}) FROM planted) AS hab)"""


ORACLES["associations"] = f"WITH {_PLANTED}\n" + union(
    [
        f"SELECT '{a}' AS col1, '{b}' AS col2, 'pearson' AS kind, round(corr({a}, {b}), 6) AS value FROM planted"
        for a, b in combinations(("y", *_FEATURES), 2)
    ]
    + [_ratio(c, n) for c in ("l_returnflag", "l_linestatus") for n in ("y", *_FEATURES)]
    + [_uncertain("l_returnflag", "l_linestatus"), _uncertain("l_linestatus", "l_returnflag")]
)


def summary(c: str, table: str) -> str:
    """One row of moments, quartiles and extremes of a column."""
    return f"""SELECT '{c}' AS variable, count({c}) AS n, count(*) - count({c}) AS n_missing, avg({c}) AS mean,
  stddev_samp({c}) AS sd, CAST(min({c}) AS DOUBLE) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25,
  quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75,
  CAST(max({c}) AS DOUBLE) AS max, avg(({c} - m) ** 3) / avg(({c} - m) ** 2) ** 1.5 AS skew,
  avg(({c} - m) ** 4) / avg(({c} - m) ** 2) ** 2 - 3 AS kurtosis, count(DISTINCT {c}) AS n_distinct
FROM {table}, (SELECT avg({c}) AS m FROM {table})"""


_FIELDS = ("mean", "sd", "min", "q25", "q50", "q75", "max", "skew", "kurtosis")
ORACLES["profile_numeric"] = f"""
SELECT variable, n, n_missing, n_distinct, {", ".join(f"round({f}, 5) AS {f}" for f in _FIELDS)}
FROM ({union([summary(c, "lineitem") for c in NUMBERS])})"""

_PART_CATS = ("p_brand", "p_type", "p_name")
ORACLES["profile_categorical"] = union(
    [
        f"""SELECT '{c}' AS variable, count({c}) AS n, count(*) - count({c}) AS n_missing,
       count(DISTINCT {c}) AS n_distinct FROM part"""
        for c in _PART_CATS
    ]
)


def top(c: str, k: int) -> str:
    return f"""SELECT '{c}' AS variable, category, n, rank FROM (
  SELECT {c} AS category, count(*) AS n,
         CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) AS INTEGER) AS rank
  FROM part GROUP BY {c}) WHERE rank <= {k}"""


ORACLES["profile_top_values"] = union([top(c, 5) for c in _PART_CATS])

ORACLES["profile_report"] = f"""
WITH s AS (SELECT * FROM ({union([summary(c, "part") for c in ("p_size", "p_retailprice")])}))
""" + union(
    [
        f"SELECT variable, 'numerical' AS kind, '{f}' AS field, round(CAST({f} AS DOUBLE), 5) AS value FROM s"
        for f in ("n", "n_missing", "n_distinct", *_FIELDS)
    ]
    + [
        f"SELECT '{c}', 'categorical', '{f}', CAST({e} AS DOUBLE) FROM part"
        for c in ("p_brand", "p_type")
        for f, e in (
            ("n", f"count({c})"),
            ("n_missing", f"count(*) - count({c})"),
            ("n_distinct", f"count(DISTINCT {c})"),
        )
    ]
    + [
        f"SELECT variable, 'categorical', 'top:' || category, CAST(n AS DOUBLE) FROM ({top(c, 3)})"
        for c in ("p_brand", "p_type")
    ]
)

_SIDES = """early AS (SELECT * FROM lineitem WHERE l_linestatus = 'F'),
late AS (SELECT * FROM lineitem WHERE NOT l_linestatus = 'F')"""
ORACLES["compare_segments"] = f"""
WITH {_SIDES},
a AS ({union([summary(c, "early") for c in ("l_quantity", "l_extendedprice")])}),
b AS ({union([summary(c, "late") for c in ("l_quantity", "l_extendedprice")])})
""" + union(
    [
        f"""SELECT a.variable, '{f}' AS field, round(CAST(a.{f} AS DOUBLE), 4) AS inside,
       round(CAST(b.{f} AS DOUBLE), 4) AS outside, round(CAST(a.{f} AS DOUBLE) - b.{f}, 4) AS difference
FROM a JOIN b ON a.variable = b.variable"""
        for f in ("n", *_FIELDS)
    ]
)


def _profile_row(kind: str, variable: str, source: str, **given: str) -> str:
    types = {
        "hue": "VARCHAR", "category": "VARCHAR", "bin_x": "INTEGER", "bin_y": "INTEGER",
        "left": "DOUBLE", "right": "DOUBLE", "n": "BIGINT", "value": "DOUBLE",
    }
    fields = ", ".join(f'CAST({given.get(f, "NULL")} AS {t}) AS "{f}"' for f, t in types.items())
    return f"SELECT '{variable}' AS variable, '{kind}' AS kind, {fields} FROM ({source})"


def _profile_hist(table: str, c: str, hue: str, bins: int) -> str:
    source = f"WITH {hist(table, c, bins, hue)} SELECT * FROM h"
    return _profile_row(
        "hist", c, source, hue=hue, bin_x="bin", left='round("left", 5)', right='round("right", 5)',
        n="n", value=f"round({_HEIGHT}, 5)",
    )


def _profile_count(table: str, c: str, hue: str) -> str:
    source = f"""SELECT a.{c}, b.{hue}, coalesce(g.n, 0) AS n
FROM (SELECT DISTINCT {c} FROM {table}) a CROSS JOIN (SELECT DISTINCT {hue} FROM {table}) b
LEFT JOIN (SELECT {c}, {hue}, count(*) AS n FROM {table} GROUP BY ALL) g ON g.{c} = a.{c} AND g.{hue} = b.{hue}"""
    return _profile_row("count", c, source, hue=hue, category=c, n="n")


_BANDED_LINES = f"""q AS ({quartiles("lineitem", "l_extendedprice")}),
banded AS (SELECT * REPLACE ({banded("l_extendedprice")} AS l_extendedprice) FROM lineitem, q)"""
ORACLES["univariate_numeric_target"] = f"WITH {_BANDED_LINES}\n" + union(
    [
        _profile_row("scatter", c, cells(c, "l_extendedprice", 10), bin_x="bx", bin_y="by_", n="n")
        for c in ("l_quantity", "l_discount", "l_tax")
    ]
    + [
        _profile_row(
            "mean", c,
            f"SELECT {c}, count(*) AS n, round(avg(l_extendedprice), 5) AS v FROM lineitem GROUP BY {c}",
            category=c, n="n", value="v",
        )
        for c in ("l_returnflag", "l_linestatus")
    ]
    + [_profile_hist("banded", c, "l_extendedprice", 10) for c in ("l_quantity", "l_discount", "l_tax")]
    + [_profile_count("banded", c, "l_extendedprice") for c in ("l_returnflag", "l_linestatus")]
)
ORACLES["univariate_class_target"] = union(
    [_profile_hist("lineitem", c, "l_returnflag", 10) for c in NUMBERS]
    + [_profile_count("lineitem", "l_linestatus", "l_returnflag")]
)

ORACLES["cardinality"] = union(
    [
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM lineitem"
        for c in ("l_partkey", "l_quantity", "l_returnflag", "l_shipdate")
    ]
)

# ---- splits and scores -------------------------------------------------------------


def folded(k: int, y: str = "l_extendedprice") -> str:
    """CTE: lineitem with contiguous folds of the key order and a target y."""
    return f"""placed AS (SELECT *, {y} AS y, row_number() OVER (ORDER BY {ROW_ORDER}) - 1 AS rid,
                  count(*) OVER () AS n_all FROM lineitem),
folded AS (SELECT *, CAST(CASE WHEN rid < (n_all % {k}) * (n_all // {k} + 1) THEN rid // (n_all // {k} + 1)
    ELSE (rid - n_all % {k}) // (n_all // {k}) END AS INTEGER) AS fold FROM placed)"""


ORACLES["kfold"] = f"WITH {folded(5)} SELECT {ROW_ORDER}, fold FROM folded"
ORACLES["kfold_sizes"] = f"WITH {folded(7)} SELECT fold, count(*) AS n_rows FROM folded GROUP BY fold"

ORACLES["repeated_kfold_sizes"] = """
SELECT CAST(i AS INTEGER) AS rep, (SELECT count(*) FROM lineitem) AS n_rows, CAST(3 AS BIGINT) AS n_folds,
       CAST(1 AS INTEGER) AS is_even
FROM range(10) r(i)"""

ORACLES["holdout_sizes"] = """
SELECT CAST(i AS INTEGER) AS rep, (SELECT count(*) FROM labels) AS n_rows, CAST(1 AS INTEGER) AS is_near
FROM range(30) r(i)"""

ORACLES["repeated_kfold_rows"] = f"""
SELECT {ROW_ORDER}, CAST(10 AS BIGINT) AS tests, CAST(10 AS BIGINT) AS reps, CAST(10 AS BIGINT) AS in_range,
  CAST(1 AS INTEGER) AS varies FROM lineitem"""

ORACLES["holdout_rows"] = """
SELECT doc_id, CAST(30 AS BIGINT) AS rows, CAST(30 AS BIGINT) AS reps, CAST(1 AS INTEGER) AS both FROM labels"""

ORACLES["score_metrics"] = """
WITH d AS (SELECT l_returnflag AS g, l_linenumber AS y, CAST(floor(l_quantity / 8) AS INTEGER) AS p FROM lineitem),
m AS (SELECT g, avg(y) AS ym FROM d GROUP BY g),
s AS (SELECT g, count(*) AS s, sum(CAST(y = p AS INTEGER)) AS c FROM d GROUP BY g),
t AS (SELECT g, y AS k, count(*) AS t FROM d GROUP BY g, y),
q AS (SELECT g, p AS k, count(*) AS q FROM d GROUP BY g, p),
tq AS (SELECT coalesce(t.g, q.g) AS g, sum(coalesce(t, 0) * coalesce(q, 0)) AS tq,
              sum(coalesce(t, 0) ** 2) AS tt, sum(coalesce(q, 0) ** 2) AS qq
       FROM t FULL JOIN q ON t.g = q.g AND t.k = q.k GROUP BY 1)
SELECT g AS l_returnflag, 'mse' AS metric, round(avg((y - p) ** 2), 6) AS score FROM d GROUP BY g
UNION ALL SELECT d.g, 'r2', round(1 - sum((y - p) ** 2) / sum((y - ym) ** 2), 6) FROM d JOIN m ON d.g = m.g GROUP BY d.g
UNION ALL SELECT g, 'accuracy', round(avg(CAST(y = p AS INTEGER)), 6) FROM d GROUP BY g
UNION ALL SELECT s.g, 'matthews',
  round((CAST(c AS DOUBLE) * s - tq) / sqrt((CAST(s AS DOUBLE) * s - qq) * (CAST(s AS DOUBLE) * s - tt)), 6)
FROM s JOIN tq ON s.g = tq.g"""

ORACLES["mean_fold_score"] = f"""
WITH {folded(5)},
f AS (SELECT fold, avg(abs(y - l_quantity * 1500)) AS score FROM folded GROUP BY fold)
SELECT 'mae' AS metric, round(avg(score), 4) AS score, count(*) AS n_splits FROM f"""

ORACLES["pareto_front"] = """
SELECT p_partkey, p_size, p_retailprice FROM part a WHERE NOT EXISTS (
  SELECT 1 FROM part b WHERE b.p_size <= a.p_size AND b.p_retailprice >= a.p_retailprice
    AND (b.p_size < a.p_size OR b.p_retailprice > a.p_retailprice))"""

ORACLES["pareto_front_lines"] = f"""
WITH l AS (SELECT *, l_quantity * (1 - l_discount) - l_tax AS gain FROM lineitem),
r AS (SELECT *, max(gain) OVER (ORDER BY l_extendedprice RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best,
             min(l_extendedprice) OVER (PARTITION BY gain) AS cheapest FROM l)
SELECT {ROW_ID}, l_extendedprice, gain FROM r WHERE gain = best AND l_extendedprice = cheapest"""

# The best price of each pair of the other two is compared with the pairs that are as good.
ORACLES["pareto_front_three"] = f"""
WITH least AS (SELECT l_quantity AS q, l_discount AS d, min(l_extendedprice) AS p FROM lineitem GROUP BY ALL),
front AS (
  SELECT q, d, p FROM least a WHERE NOT EXISTS (
    SELECT 1 FROM least b WHERE b.q >= a.q AND b.d >= a.d AND b.p <= a.p AND (b.q > a.q OR b.d > a.d OR b.p < a.p)))
SELECT {ROW_ID}, l_extendedprice, l_quantity, l_discount
FROM lineitem JOIN front ON l_quantity = q AND l_discount = d AND l_extendedprice = p"""

# ---- ridge ---------------------------------------------------------------------------

_TWO = """c AS (SELECT l_quantity - avg(l_quantity) OVER () AS a, l_discount - avg(l_discount) OVER () AS b,
             l_extendedprice - avg(l_extendedprice) OVER () AS y FROM lineitem),
s AS (SELECT sum(a * a) + 10 AS aa, sum(a * b) AS ab, sum(b * b) + 10 AS bb, sum(a * y) AS ay, sum(b * y) AS by_ FROM c),
w AS (SELECT (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS wa, (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM s),
m AS (SELECT avg(l_quantity) AS ma, avg(l_discount) AS mb, avg(l_extendedprice) AS my FROM lineitem)"""
ORACLES["ridge_fit"] = f"""
WITH {_TWO}
SELECT 'intercept' AS term, round(my - wa * ma - wb * mb, 4) AS value FROM w, m
UNION ALL SELECT 'l_quantity', round(wa, 4) FROM w
UNION ALL SELECT 'l_discount', round(wb, 4) FROM w"""
ORACLES["ridge_predict"] = f"""
WITH {_TWO}
SELECT 'mse' AS metric, round(avg((y - wa * a - wb * b) ** 2), 3) AS score FROM c, w
UNION ALL SELECT 'r2', round(1 - sum((y - wa * a - wb * b) ** 2) / sum(y * y), 3) FROM c, w"""


def _subsets() -> str:
    """One or two features, ridge with alpha 1, mean r2 over five folds."""
    masks = [(f, None) for f in _FEATURES] + list(combinations(_FEATURES, 2))
    rows = union(
        [
            f"""SELECT {1 if b is None else 2} AS n, '{a if b is None else a + "," + b}' AS selected, fold,
       CAST({a} AS DOUBLE) AS a, CAST({b or 0} AS DOUBLE) AS b, y FROM folded"""
            for a, b in masks
        ]
    )
    names = ("a", "b", "y", "aa", "ab", "bb", "ay", "by_", "yy")
    products = {"aa": "a * a", "ab": "a * b", "bb": "b * b", "ay": "a * y", "by_": "b * y", "yy": "y * y"}
    sums = ", ".join(f"sum({products.get(v, v)}) AS {v}" for v in names)
    rest = ", ".join(f"sum({v}) OVER w - {v} AS {v}" for v in names)
    return f"""
WITH {folded(5, Y)},
shifted AS (SELECT n, selected, fold, a - avg(a) OVER w AS a, b - avg(b) OVER w AS b, y - avg(y) OVER w AS y
            FROM ({rows}) WINDOW w AS (PARTITION BY selected)),
part_sums AS (SELECT n, selected, fold, count(*) AS k, {sums} FROM shifted GROUP BY n, selected, fold),
train AS (SELECT n, selected, fold, sum(k) OVER w - k AS k, {rest} FROM part_sums WINDOW w AS (PARTITION BY selected)),
centred AS (SELECT *, aa - a * a / k + 1 AS caa, bb - b * b / k + 1 AS cbb, ab - a * b / k AS cab,
                   ay - a * y / k AS cay, by_ - b * y / k AS cby FROM train),
coef AS (SELECT *, (cay * cbb - cby * cab) / (caa * cbb - cab * cab) AS wa,
                   (cby * caa - cay * cab) / (caa * cbb - cab * cab) AS wb FROM centred),
ready AS (SELECT selected, fold, wa, wb, (y - wa * a - wb * b) / k AS w0 FROM coef),
fold_score AS (SELECT s.n, selected, fold, 1 - sum((y - w0 - wa * a - wb * b) ** 2) / (sum(y * y) - sum(y) ** 2 / count(*)) AS r2
          FROM shifted s JOIN ready USING (selected, fold) GROUP BY s.n, selected, fold),
scored AS (SELECT n, selected, avg(r2) AS score FROM fold_score GROUP BY n, selected)
"""


ORACLES["subset_search_ridge"] = f"""{_subsets()}
SELECT CAST(n AS INTEGER) AS n, round(score, 6) AS score, selected FROM scored a
WHERE NOT EXISTS (SELECT 1 FROM scored b WHERE b.n <= a.n AND b.score >= a.score AND (b.n < a.n OR b.score > a.score))"""

ORACLES["compare_subsets"] = f"""{_subsets()}
SELECT CASE WHEN n = 1 THEN 'reduced' ELSE 'both' END AS name, CAST(n AS INTEGER) AS n, round(score, 6) AS score
FROM scored WHERE selected IN ('l_quantity', 'l_quantity,l_discount')"""

_MADE = """d AS (SELECT n_chars, quality, 2 * n_chars + 100 * quality AS y FROM documents JOIN labels USING (doc_id)),
r AS (SELECT round(corr(y, 2 * n_chars + 100 * quality) ** 2, 4) AS score FROM d)"""
ORACLES["subset_splits"] = f"WITH {_MADE}\n" + union(
    [f"SELECT '{name}' AS splits, CAST(2 AS INTEGER) AS n, score FROM r" for name in ("text key", "no key", "holdouts")]
)


def _wide(width: int) -> str:
    """Products of centred places, as the operator centres them."""
    cast = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(width))
    centred = ", ".join(f"e{i} - avg(e{i}) OVER () AS e{i}" for i in range(width))
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    sums = ", ".join(f"{{'i': {i}, 'j': {j}, 'p': sum(e{i} * e{j})}}" for i, j in pairs)
    return f"""
WITH raw AS (SELECT label, {cast} FROM embeddings), c AS (SELECT label, {centred} FROM raw),
s AS (SELECT label, unnest([{sums}]) AS x FROM c GROUP BY label)
SELECT label, CAST(x.i AS INTEGER) AS i, CAST(x.j AS INTEGER) AS j, round(x.p, 4) AS product FROM s"""


ORACLES["wide_products"] = _wide(16)


def _wide_pairs(width: int) -> str:
    def place(i):
        value = f"CAST(embedding[{i + 1}] AS DOUBLE)"
        return f"CASE WHEN {value} > -0.1 THEN {value} END AS e{i:02d}" if i == 3 else f"{value} AS e{i:02d}"

    names = [f"e{i:02d}" for i in range(width)]
    sums = ", ".join(
        f"{{'a': '{a}', 'b': '{b}', 'n': count({a} + {b}), 'r': corr({a}, {b})}}" for a, b in combinations(names, 2)
    )
    return f"""
WITH r AS (SELECT label % 2 AS half, {", ".join(map(place, range(width)))} FROM embeddings),
s AS (SELECT half, unnest([{sums}]) AS x FROM r GROUP BY half)
SELECT x.a AS col1, x.b AS col2, half, x.n AS n, round(x.r, 6) AS corr FROM s"""


ORACLES["pairwise_wide"] = _wide_pairs(16)

# ---- trees ---------------------------------------------------------------------------



def stump(table: str) -> str:
    """CTEs: best split of y by l_discount, and the rows with their leaf."""
    return f"""g AS (SELECT l_discount AS x, count(*) AS n, sum(y) AS s FROM {table} GROUP BY l_discount),
c AS (SELECT x, lead(x) OVER (ORDER BY x) AS nx, sum(n) OVER w AS n1, sum(s) OVER w AS s1,
             sum(n) OVER () AS n, sum(s) OVER () AS s FROM g WINDOW w AS (ORDER BY x)),
best AS (SELECT (x + nx) / 2 AS t FROM c WHERE nx IS NOT NULL
         ORDER BY s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) DESC LIMIT 1),
leaves AS (SELECT CASE WHEN l_discount <= t THEN 0 ELSE 1 END AS leaf, t, l_discount AS x, y FROM {table}, best)"""


ORACLES["tree_stump"] = f"""
WITH {_PLANTED}, {stump("planted")}
SELECT CAST(leaf AS INTEGER) AS leaf, 'l_discount ' || CASE WHEN leaf = 0 THEN '<= ' ELSE '> ' END || round(t, 6) AS rule,
       count(*) AS n, round(count(*) / (SELECT count(*) FROM planted), 6) AS share, round(avg(y), 6) AS mean
FROM leaves GROUP BY leaf, t"""

ORACLES["stump_nodes"] = f"""
WITH {_PLANTED}, {stump("planted")},
ends AS (SELECT min(y) AS lo, max(y) AS hi FROM planted),
placed AS (SELECT leaf, {bin_of("y", 30)} AS bin FROM leaves, ends)
SELECT CAST(leaf + 2 AS INTEGER) AS node, bin, count(*) AS n FROM placed GROUP BY leaf, bin
UNION ALL SELECT CAST(1 AS INTEGER), bin, count(*) FROM placed GROUP BY bin"""


def _best_split(name: str, rows: str, columns: tuple[str, str] = ("l_discount", "l_linenumber")) -> str:
    """CTE: per side, the column and threshold of least squared error."""
    sides = union(
        [
            f"SELECT side, '{c}' AS f, CAST({c} AS DOUBLE) AS x, count(*) AS n, sum(y) AS s FROM {rows} GROUP BY side, {c}"
            for c in columns
        ]
    )
    return f"""{name}_steps AS (
  SELECT side, f, x, lead(x) OVER w AS nx, sum(n) OVER w AS n1, sum(s) OVER w AS s1,
         sum(n) OVER (PARTITION BY side, f) AS n, sum(s) OVER (PARTITION BY side, f) AS s
  FROM ({sides}) WINDOW w AS (PARTITION BY side, f ORDER BY x)),
{name} AS (SELECT side, f, (x + nx) / 2 AS t FROM {name}_steps WHERE nx IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY side ORDER BY s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) DESC) = 1)"""


def _goes_right(split: str, columns: tuple[str, str] = ("l_discount", "l_linenumber")) -> str:
    one, other = columns
    return f"CAST(CASE WHEN {split}.f = '{one}' THEN {one} ELSE {other} END > {split}.t AS INTEGER)"


ORACLES["tree_two_levels"] = f"""
WITH {_PLANTED},
whole AS (SELECT 0 AS side, * FROM planted),
{_best_split("first_split", "whole")},
halves AS (SELECT {_goes_right("first_split")} AS side, l_discount, l_linenumber, y
           FROM whole JOIN first_split ON whole.side = first_split.side),
{_best_split("second_split", "halves")}
SELECT CAST(2 * halves.side + {_goes_right("second_split")} AS INTEGER) AS leaf, count(*) AS n, round(avg(y), 6) AS mean
FROM halves JOIN second_split ON halves.side = second_split.side GROUP BY 1"""

_PRICE_TAX = ("l_extendedprice", "l_tax")
ORACLES["exact_tree"] = f"""
WITH whole AS (SELECT 0 AS side, l_quantity AS y, * FROM lineitem),
{_best_split("first_split", "whole", _PRICE_TAX)},
halves AS (SELECT {_goes_right("first_split", _PRICE_TAX)} AS side, l_extendedprice, l_tax, y
           FROM whole JOIN first_split ON whole.side = first_split.side),
{_best_split("second_split", "halves", _PRICE_TAX)}
SELECT CAST(2 * halves.side + {_goes_right("second_split", _PRICE_TAX)} AS INTEGER) AS leaf, count(*) AS n,
       round(avg(y), 6) AS mean
FROM halves JOIN second_split ON halves.side = second_split.side GROUP BY 1"""


def _grown(depth: int, table: str, weights: dict[str, str], gain: str) -> str:
    """CTEs of a greedy tree: ``split_k`` has the split of each node of level k,
    ``level_k`` the cells of both columns with the node (1, then 2i and 2i + 1).

    ``weights`` are what a cell adds up; ``gain`` compares the left part (``_1``)
    with the rest and the whole.
    """
    names = list(weights)
    sums = ", ".join(f"{e} AS {n}" for n, e in weights.items())
    out = [f"level_0 AS (SELECT 1 AS node, l_discount, l_linenumber, {sums} FROM {table} GROUP BY ALL)"]
    goes = "CASE WHEN f = 'l_discount' THEN l_discount ELSE l_linenumber END > t"
    for k in range(depth):
        added = ", ".join(f"sum({n}) AS {n}" for n in names)
        both = union(
            [
                f"SELECT node, {i} AS spot, '{c}' AS f, CAST({c} AS DOUBLE) AS x, {added} FROM level_{k} GROUP BY node, {c}"
                for i, c in enumerate(("l_discount", "l_linenumber"))
            ]
        )
        left = ", ".join(f"sum({n}) OVER w AS {n}_1, sum({n}) OVER (PARTITION BY node, f) AS {n}" for n in names)
        kept = ", ".join(f"l.{n}" for n in names)
        out.append(f"""steps_{k} AS (SELECT node, spot, f, x, lead(x) OVER w AS nx, {left}
  FROM ({both}) WINDOW w AS (PARTITION BY node, f ORDER BY x)),
split_{k} AS (SELECT node, f, (x + nx) / 2 AS t, {gain} AS gain FROM steps_{k} WHERE nx IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, spot, x) = 1),
level_{k + 1} AS (SELECT 2 * l.node + CAST({goes} AS INTEGER) AS node, l_discount, l_linenumber, {kept}
  FROM level_{k} l JOIN split_{k} s ON l.node = s.node)""")
    return ",\n".join(out)


_SQUARES = {"n": "count(*)", "s": "sum(y)"}
_LESS_ERROR = "s_1 * s_1 / n_1 + (s - s_1) * (s - s_1) / (n - n_1) - s * s / n"
ORACLES["tree_rules"] = f"""
WITH {_PLANTED},
{_grown(3, "planted", _SQUARES, _LESS_ERROR)}
SELECT CAST(row_number() OVER (ORDER BY node) - 1 AS INTEGER) AS leaf, CAST(sum(n) AS BIGINT) AS n,
  round(sum(n) / (SELECT count(*) FROM planted), 6) AS share, round(sum(s) / sum(n), 6) AS mean
FROM level_3 GROUP BY node"""

ORACLES["feature_importance"] = f"""
WITH {_PLANTED},
{_grown(3, "planted", _SQUARES, _LESS_ERROR)},
gains AS (SELECT f, sum(gain) AS gain FROM (SELECT f, gain FROM split_0 UNION ALL SELECT f, gain FROM split_1
  UNION ALL SELECT f, gain FROM split_2 UNION ALL SELECT 'l_discount', 0 UNION ALL SELECT 'l_linenumber', 0) GROUP BY f)
SELECT f AS feature, round(gain / sum(gain) OVER (), 6) AS importance,
  CAST(row_number() OVER (ORDER BY gain DESC) AS INTEGER) AS rank FROM gains"""

ORACLES["tree_nodes"] = f"""
WITH {_PLANTED},
{_grown(2, "planted", _SQUARES, _LESS_ERROR)},
sizes AS (SELECT node, sum(n) AS n FROM level_0 GROUP BY node UNION ALL SELECT node, sum(n) FROM level_1 GROUP BY node
  UNION ALL SELECT node, sum(n) FROM level_2 GROUP BY node),
splits AS (SELECT * FROM split_0 UNION ALL SELECT * FROM split_1)
SELECT CAST(z.node AS INTEGER) AS node, f AS feature, round(t, 6) AS threshold, CAST(n AS BIGINT) AS n, CAST(n AS BIGINT) AS in_bins
FROM sizes z LEFT JOIN splits p ON z.node = p.node"""

_CLASSES = {"n": "count(*)"} | {f"c{i}": f"count_if(y = '{b}')" for i, b in enumerate(("q25", "q25-75", "q75"))}
_PURER = " + ".join(f"c{i}_1 * c{i}_1 / n_1 + (c{i} - c{i}_1) * (c{i} - c{i}_1) / (n - n_1)" for i in range(3))
ORACLES["tree_rules_classes"] = f"""
WITH summed AS (SELECT *, 10 * l_linenumber + l_quantity AS z FROM lineitem),
cuts AS (SELECT quantile_cont(z, 0.25) AS a, quantile_cont(z, 0.75) AS b FROM summed),
banded AS (SELECT l_discount, l_linenumber,
  CASE WHEN z >= b THEN 'q75' WHEN z >= a THEN 'q25-75' ELSE 'q25' END AS y FROM summed, cuts),
{_grown(2, "banded", _CLASSES, _PURER)},
ends AS (SELECT node, sum(n) AS n, sum(c0) AS c0, sum(c1) AS c1, sum(c2) AS c2,
  CASE WHEN sum(c0) >= greatest(sum(c1), sum(c2)) THEN 0 WHEN sum(c1) >= sum(c2) THEN 1 ELSE 2 END AS says FROM level_2 GROUP BY node),
-- branches that say the same are one leaf
same AS (SELECT *, min(says) OVER (PARTITION BY node // 2) = max(says) OVER (PARTITION BY node // 2) AS half,
  min(says) OVER () = max(says) OVER () AS whole FROM ends),
pruned AS (SELECT CASE WHEN whole THEN 1 WHEN half THEN 2 * (node // 2) ELSE node END AS node, n, c0, c1, c2 FROM same),
leaves AS (SELECT CAST(row_number() OVER (ORDER BY node) - 1 AS INTEGER) AS leaf, sum(n) AS n, sum(c0) AS c0, sum(c1) AS c1,
  sum(c2) AS c2 FROM pruned GROUP BY node),
counts AS (SELECT leaf, n, 'q25' AS class, c0 AS class_n FROM leaves UNION ALL SELECT leaf, n, 'q25-75', c1 FROM leaves
  UNION ALL SELECT leaf, n, 'q75', c2 FROM leaves)
SELECT leaf, CAST(n AS BIGINT) AS n, class, CAST(class_n AS BIGINT) AS class_n FROM counts WHERE class_n > 0"""


def _decided(family: str, value: str) -> str:
    return f"""SELECT l_linenumber, CAST({value} AS VARCHAR) AS prediction, count(*) AS n, '{family}' AS family
FROM lineitem GROUP BY l_linenumber"""


_SQUARE = "CAST(l_linenumber * l_linenumber AS DOUBLE)"
_NAME = "['one', 'two', 'three'][l_linenumber % 3 + 1]"
ORACLES["forest_fit"] = union([_decided("forest_reg", _SQUARE), _decided("forest_clf", _NAME)])
ORACLES["gbt_reg"] = _decided("gbt_reg", _SQUARE)
ORACLES["gbt_clf"] = _decided("gbt_clf", _NAME)

# The score of the rule that made the class, on each hashed fold.
ORACLES["tune_boosted_trees"] = """
WITH halves AS (SELECT CAST(l_linenumber >= 4 AS INTEGER) AS made, CAST(l_linenumber > 3.5 AS INTEGER) AS said FROM lineitem)
SELECT CAST(t AS INTEGER) AS trial, CAST(0 AS INTEGER) AS rep, CAST(f AS INTEGER) AS fold,
  round((SELECT corr(made, said) FROM halves), 6) AS score
FROM range(2) a(t), range(3) b(f)"""

# The columns explain next to nothing, whatever the penalty: their own fits say so.
ORACLES["tune_ridge"] = """
SELECT CAST(i AS INTEGER) AS trial,
  round(1 - (SELECT regr_r2(l_extendedprice, l_quantity) + regr_r2(l_extendedprice, l_discount)
             + regr_r2(l_extendedprice, l_tax) + regr_r2(l_extendedprice, l_linenumber) FROM lineitem), 2) AS left_over
FROM range(10) r(i)"""

# The strongest columns by squared correlation.
ORACLES["subset_search_tree"] = f"""
WITH {_PLANTED},
strength AS (
  SELECT 'l_quantity' AS f, 0 AS spot, corr(l_quantity, y) ** 2 AS r FROM planted
  UNION ALL SELECT 'l_discount', 1, corr(l_discount, y) ** 2 FROM planted
  UNION ALL SELECT 'l_tax', 2, corr(l_tax, y) ** 2 FROM planted
  UNION ALL SELECT 'l_linenumber', 3, corr(l_linenumber, y) ** 2 FROM planted
  UNION ALL SELECT 'l_partkey', 4, corr(l_partkey, y) ** 2 FROM planted
  UNION ALL SELECT 'l_suppkey', 5, corr(l_suppkey, y) ** 2 FROM planted
  UNION ALL SELECT 'l_extendedprice', 6, corr(l_extendedprice, y) ** 2 FROM planted),
ranked AS (SELECT *, row_number() OVER (ORDER BY r DESC) AS place FROM strength)
SELECT CAST(i AS INTEGER) AS n, string_agg(f, ',' ORDER BY spot) AS selected
FROM range(1, 3) r(i) JOIN ranked ON place <= i GROUP BY i"""

ORACLES["subset_search_log"] = f"""{_subsets()}
SELECT CAST(501 AS BIGINT) AS n, round(max(score), 6) AS best, CAST(max_by(n, score) AS INTEGER) AS max_n,
  CAST(0 AS BIGINT) AS falls FROM scored"""

ORACLES["cluster_profile"] = union(
    [
        f"""SELECT '{c}' AS variable, count(*) AS n, CAST(3 AS BIGINT) AS clusters, round(avg({c}), 3) AS mean FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice")
    ]
)

ORACLES["custom_family"] = f"""
WITH {_PLANTED},
g AS (SELECT l_linenumber AS x, count(*) AS n, sum(l_linenumber) AS s, sum(l_linenumber ** 2) AS q FROM planted GROUP BY 1),
c AS (SELECT sum(n) OVER w AS n1, sum(s) OVER w AS s1, sum(n) OVER () AS n, sum(s) OVER () AS s, sum(q) OVER () AS q
      FROM g WINDOW w AS (ORDER BY x))
SELECT 'stump' AS name, round(max((s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) - s * s / n) / (q - s * s / n)), 6) AS score
FROM c WHERE n > n1
UNION ALL SELECT 'l_quantity', round(greatest(corr(l_quantity, y) ** 2, corr(l_discount, y) ** 2), 6) FROM planted"""

# A linear target leaves ridge no error; one split leaves the spread within its halves.
ORACLES["leaderboard"] = f"""
WITH {_PLANTED},
g AS (SELECT l_quantity AS x, count(*) AS n, sum(y) AS s, sum(y * y) AS q FROM planted GROUP BY 1),
c AS (SELECT sum(n) OVER w AS n1, sum(s) OVER w AS s1, sum(n) OVER () AS n, sum(s) OVER () AS s, sum(q) OVER () AS q
      FROM g WINDOW w AS (ORDER BY x)),
best AS (SELECT min(q - s1 * s1 / n1 - (s - s1) * (s - s1) / (n - n1)) / any_value(n) AS mse FROM c WHERE n > n1)
SELECT 'ridge' AS family, round(sqrt((SELECT 1 - regr_r2(y, 3 * l_quantity + 400 * l_discount) FROM planted)), 0) AS error, true AS below_one_split
UNION ALL SELECT 'tree_reg', round(sqrt(mse), 0), false FROM best
UNION ALL SELECT 'gbt_reg', NULL, true"""

# The target is made of the two columns, so their sum of squares explains it.
ORACLES["svr_kernel"] = f"""
WITH {_PLANTED}
SELECT round(corr(y, l_quantity) ** 2 + corr(y, l_discount) ** 2, 1) AS explained,
  corr(y, l_quantity) ** 2 + corr(y, l_discount) ** 2 > greatest(corr(y, l_quantity) ** 2, corr(y, l_discount) ** 2) AS above_one_column
FROM planted"""

# The target is a function of the two columns, so a curve through it leaves nothing beyond the band.
ORACLES["svr_tube"] = f"""
WITH {_PLANTED},
scaled AS (SELECT (y - avg(y) OVER ()) / stddev_pop(y) OVER () AS y FROM planted)
SELECT epsilon, count(*) AS n, round(1 - (SELECT regr_r2(y, 3 * l_quantity + 400 * l_discount) FROM planted), 2) AS beyond,
  avg(greatest(abs(y) - epsilon, 0)) > 0 AS below_constant
FROM scaled, (SELECT CAST(unnest([0.2, 0.8]) AS DOUBLE) AS epsilon) GROUP BY epsilon"""

ORACLES["svc_kernel"] = f"""
WITH {_PLANTED},
cuts AS (SELECT quantile_cont(y, 0.25) AS a, quantile_cont(y, 0.75) AS b FROM planted),
banded AS (SELECT CASE WHEN y >= b THEN 'q75' WHEN y >= a THEN 'q25-75' ELSE 'q25' END AS band FROM planted, cuts)
SELECT band, count(*) AS n, true AS better_than_share FROM banded GROUP BY band"""


def _signals(*families: str) -> str:
    """Two columns are correlated with the target, the others are not; both are needed to tell it."""
    return f"WITH {_PLANTED}\n" + union(
        [
            f"""SELECT '{f}' AS family, corr(y, l_discount) ** 2 > 0.01 AS above_one_split,
  least(abs(corr(y, l_quantity)), abs(corr(y, l_discount))) > greatest(abs(corr(y, l_tax)), abs(corr(y, l_linenumber))) AS signals_first
FROM planted"""
            for f in families
        ]
    )


ORACLES["forest_signals"] = _signals("forest_reg", "forest_clf")
ORACLES["gbt_signals"] = _signals("gbt_reg", "gbt_clf")
ORACLES["leaf_signals"] = _signals("leaf_reg", "leaf_clf")


def _leaf_round(at: int, rate: float, alpha: float, ridge: float) -> str:
    """One stump on the sums of gradients per cell: thresholded sums over penalised counts."""

    def pull(g: str) -> str:
        return f"sign({g}) * greatest(abs({g}) - {alpha}, 0)"

    return f"""
sides{at} AS (SELECT 'q' AS f, q AS x, sum(n) AS n, sum(g) AS g FROM cells{at} GROUP BY q
              UNION ALL SELECT 'd', d, sum(n), sum(g) FROM cells{at} GROUP BY d),
sums{at} AS (SELECT f, x, sum(n) OVER w AS n1, sum(g) OVER w AS g1,
               sum(n) OVER (PARTITION BY f) AS n, sum(g) OVER (PARTITION BY f) AS g
             FROM sides{at} WINDOW w AS (PARTITION BY f ORDER BY x)),
stump{at} AS (SELECT f, x, -{rate} * {pull("g1")} / (n1 + {ridge}) AS a, -{rate} * {pull("(g - g1)")} / (n - n1 + {ridge}) AS b
              FROM sums{at} WHERE n > n1
              ORDER BY ({pull("g1")}) ** 2 / (n1 + {ridge}) + ({pull("(g - g1)")}) ** 2 / (n - n1 + {ridge}) DESC LIMIT 1),
moved{at} AS (SELECT cells{at}.q, cells{at}.d, cells{at}.n, cells{at}.g, said,
                CASE WHEN CASE f WHEN 'q' THEN q ELSE d END <= x THEN a ELSE b END AS v FROM cells{at}, stump{at}),
cells{at + 1} AS (SELECT q, d, n, g + n * v AS g, said + v AS said FROM moved{at})"""


ORACLES["leaf_rounds"] = f"""
WITH {_PLANTED},
m AS (SELECT avg(y) AS m FROM planted),
cells0 AS (SELECT l_quantity AS q, l_discount AS d, count(*) AS n, sum(m - y) AS g, any_value(m) AS said
           FROM planted, m GROUP BY 1, 2),{_leaf_round(0, 0.5, 5000.0, 1000.0)},{_leaf_round(1, 0.5, 5000.0, 1000.0)}
SELECT q AS l_quantity, d AS l_discount, n, round(said, 4) AS prediction FROM cells2"""

ORACLES["leaf_classes"] = _decided("leaf_clf", _NAME)

# Each of the four trials meets the rule on each of the thirty folds.
ORACLES["tune_leaf_trees"] = """
WITH halves AS (SELECT CAST(l_linenumber >= 4 AS INTEGER) AS made, CAST(l_linenumber > 3.5 AS INTEGER) AS said FROM lineitem)
SELECT CAST(t AS INTEGER) AS trial, CAST(r AS INTEGER) AS rep, CAST(f AS INTEGER) AS fold,
  round((SELECT corr(made, said) FROM halves), 6) AS score
FROM range(4) a(t), range(10) c(r), range(3) b(f)"""

# y is made of the columns it is correlated with; the others must be rejected.
ORACLES["boruta"] = f"WITH {_PLANTED}\n" + union(
    [
        f"""SELECT '{c}' AS feature, CASE WHEN abs(corr({c}, y)) > 0.1 THEN 'confirmed' ELSE 'rejected' END AS decision
FROM planted"""
        for c in _FEATURES
    ]
)

ORACLES["segment_ridge"] = f"""
WITH priced AS (SELECT *, l_extendedprice AS y FROM lineitem), {stump("priced")},
m AS (SELECT leaf, count(*) AS n, avg(x) AS mx, avg(y) AS my FROM leaves GROUP BY leaf),
s AS (SELECT leaf, any_value(m.n) AS n, any_value(mx) AS mx, any_value(my) AS my,
             sum((x - mx) * (y - my)) / (sum((x - mx) ** 2) + 1) AS slope
      FROM leaves JOIN m USING (leaf) GROUP BY leaf)
SELECT CAST(leaf AS INTEGER) AS leaf, n, round(slope, 3) AS slope, round(my - slope * mx, 3) AS intercept FROM s"""

ORACLES["useful_segments"] = f"""
WITH {_PLANTED}, {stump("planted")},
w AS (SELECT avg(y) AS m, stddev_pop(y) AS d, count(*) AS k FROM planted),
s AS (SELECT leaf, count(*) AS n, avg(y) AS mean FROM leaves GROUP BY leaf)
SELECT CAST(leaf AS INTEGER) AS leaf, n, round((mean - m) / d, 6) AS lift, round(abs(mean - m) / d * n / k, 6) AS weight
FROM s, w"""

# Errors of a ridge on one column from sums of products, on both sides of every cut.
ORACLES["ridge_tree"] = """
WITH bent AS (SELECT l_tax AS t, CAST(l_quantity AS DOUBLE) AS x,
                     CASE WHEN l_tax > 0.035 THEN 7 * l_quantity ELSE 180 - 7 * l_quantity END + 100 * l_discount AS y
              FROM lineitem),
g AS (SELECT t, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS xx, sum(x * y) AS xy, sum(y * y) AS yy
      FROM bent GROUP BY t),
sides AS (SELECT c.t AS cut, CAST(g.t > c.t AS INTEGER) AS leaf, sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy,
                 sum(xx) AS xx, sum(xy) AS xy, sum(yy) AS yy
          FROM g CROSS JOIN (SELECT t FROM g) c GROUP BY ALL),
spread AS (SELECT cut, leaf, n, sx / n AS mx, sy / n AS my, xx - sx * sx / n AS sxx, xy - sx * sy / n AS sxy,
                  yy - sy * sy / n AS syy FROM sides),
fits AS (SELECT *, sxy / (sxx + 1) AS slope FROM spread),
errors AS (SELECT *, syy - 2 * slope * sxy + slope * slope * sxx AS error FROM fits),
best AS (SELECT cut FROM errors GROUP BY cut HAVING count(*) = 2 ORDER BY sum(error), cut LIMIT 1)
SELECT leaf, CAST(n AS BIGINT) AS n, round(slope, 3) AS slope, round(my - slope * mx, 3) AS intercept, round(1 - error / syy, 6) AS r2
FROM errors JOIN best USING (cut)"""

ORACLES["product_stage"] = ORACLES["preprocess"].replace("SELECT p_partkey,", "SELECT p_partkey, p_retailprice,")


def _eighths(c: str) -> str:
    cuts = [f"quantile_cont(CAST({c} AS DOUBLE), {i / 8})" for i in range(1, 8)]
    return f"[{', '.join(cuts)}] AS cuts"


def _cut(c: str, table: str) -> str:
    return "(" + " + ".join(f"CAST({c} >= {table}.cuts[{i}] AS INTEGER)" for i in range(1, 8)) + ")"


_EIGHTHS = union(
    [
        f"""SELECT '{c}' AS variable, {_cut(c, "e")} AS x, {_cut("y", "t")} AS z
FROM planted, (SELECT {_eighths(c)} FROM planted) e, (SELECT {_eighths("y")} FROM planted) t"""
        for c in _FEATURES
    ]
)
ORACLES["binned_mi"] = f"""
WITH {_PLANTED},
fine AS ({_EIGHTHS}),
grid AS (SELECT variable, 2 ** a AS gx, 2 ** b AS gz, CAST(floor(x / 2 ** (3 - a)) AS INTEGER) AS x,
                CAST(floor(z / 2 ** (3 - b)) AS INTEGER) AS z
         FROM fine, range(1, 4) r(a), range(1, 4) s(b)),
cells AS (SELECT variable, gx, gz, x, z, count(*) AS n FROM grid GROUP BY ALL),
parts AS (SELECT *, sum(n) OVER (PARTITION BY variable, gx, gz) AS t, sum(n) OVER (PARTITION BY variable, gx, gz, x) AS nx,
                 sum(n) OVER (PARTITION BY variable, gx, gz, z) AS nz FROM cells),
scores AS (SELECT variable, gx, gz, round(sum(n / t * ln(CAST(n AS DOUBLE) * t / (CAST(nx AS DOUBLE) * nz))) / ln(least(gx, gz)), 12) AS score
           FROM parts GROUP BY variable, gx, gz),
ranked AS (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY score DESC, gx, gz) AS place FROM scores)
SELECT variable, round(score, 6) AS score, CAST(gx AS INTEGER) AS bins_x, CAST(gz AS INTEGER) AS bins_y
FROM ranked WHERE place = 1"""

# Two classes of target: the finest cut of a column with few values holds all it can say.
ORACLES["maximal_information"] = f"WITH {_PLANTED},\nrows_of AS (" + union(
    [f"SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS x, y > 93 AS big FROM planted" for c in _FEATURES]
) + """),
cells AS (SELECT variable, x, big, CAST(count(*) AS DOUBLE) AS n FROM rows_of GROUP BY ALL),
parts AS (SELECT *, sum(n) OVER (PARTITION BY variable) AS t, sum(n) OVER (PARTITION BY variable, x) AS nx,
                 sum(n) OVER (PARTITION BY variable, big) AS nb FROM cells)
SELECT variable, CAST(any_value(t) AS BIGINT) AS n, round(sum(n / t * ln(n * t / (nx * nb))) / ln(2), 6) AS score
FROM parts GROUP BY variable"""
